"""DuckDB twins of the queries that SQL can express."""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages
), g as (
  select html, max(page_id) as last from p group by html
), d as (
  select p.page_id, strlen(p.html) as payload_bytes, g.last,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + (((
      (instr('0123456789abcdef', substr(h, cast(5 * i // 4 + 1 as int), 1)) - 1) * 16
      + instr('0123456789abcdef', substr(h, cast(5 * i // 4 + 2 as int), 1)) - 1)
      >> cast(3 - (5 * i) % 4 as int)) & 31) as int), 1)), '') as payload_digest
  from p join g using (html)
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when page_id = last then 'response' else 'revisit' end as record_type,
  case when page_id <> last then last end as refers_to
from d
"""

OP6 = f"""
with recursive w as (
  select doc_id, {_WORDS.format(_LOWER)} as w from documents
), s as (
  select doc_id, case when len(w) = 0 then cast([] as varchar[]) when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from w
), e as (
  select doc_id, len(s) as n, unnest(s) as x from s
), links as (
  select a.doc_id as a, b.doc_id as b from e a join e b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach as (
  select doc_id as a, doc_id as b from s union select r.a, l.b from reach r join links l on r.b = l.a
), c as (
  select a, min(b) as component_id from reach group by a
)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from s join c on doc_id = a
"""

OP8 = f"""
with w as (
  select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents
), v as (
  select doc_id, unnest(range(1, len(w) - 48)) as i, w from w where len(w) >= 50
), x as (
  select doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) as h from v
), f as (
  select h, min(doc_id) as first from x group by h
), r as (
  select distinct doc_id, unnest(range(i, i + 50)) as k from x join f using (h) where doc_id > first
), g as (
  select doc_id, list(k) as gone from r group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(coalesce(case when gone is null then array_to_string(w, ' ')
    else array_to_string(list_filter(w, lambda t, k: not list_contains(gone, k)), ' ') end, '')) as kept_sha256
from w left join g using (doc_id)
"""

OP10 = r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
), g as (
  select t, min(doc_id) as keep_id, count(*) as group_size from t group by t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from t join g using (t)
"""

OP13 = """
with d as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents
), c as (
  select doc_id, t, cast(length(t) as bigint) as n,
    ('0x' || substr(h, 1, 8))::bigint as h1, ('0x' || substr(h, 9, 8))::bigint as h2,
    ('0x' || substr(h, 17, 8))::bigint as h3, ('0x' || substr(h, 25, 8))::bigint as h4
  from d
), f as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from c
)
select doc_id, n, form,
  case when form <> 'plain' then a end as prefix_chars,
  case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t
    when 'psm' then '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
    else '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) end) as output_sha256,
  sha256(t) as restored_sha256
from f
"""

SQL = {"op1_warc": OP1, "op6_minhash": OP6, "op8_substring": OP8, "op10_exact": OP10, "op13_fim": OP13}
