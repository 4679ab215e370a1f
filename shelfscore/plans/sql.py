"""SQL pieces shared by the queries' twins, for an engine of its own."""

from __future__ import annotations

# Short list used by the registered queries and by their twins. Any other list
# can be passed to the operators.
STOPWORDS = ["a", "an", "and", "as", "at", "by", "der", "die", "en", "for", "from", "in", "is", "it", "la", "le", "no", "none", "not", "of", "on", "or", "que", "some", "that", "the", "to", "und", "was", "with"]

TRAIN = """
train as (
  select c.conv_id || '-' || c.turn as id, c.conv_id as product_uid, p.p_name as title, c.text as search_term,
    round(cast(1 + coalesce(l.quality, 0) as double) + cast(0.33 as double) * (c.turn % 3), 2) as relevance
  from conversations c join part p on p.p_partkey = c.conv_id
  left join labels l on l.doc_id = c.conv_id
  where c.role = 'user')"""

ATTRIBUTES = """
attributes as (
  select p_partkey as product_uid, 'brand' as name, p_brand as value from part
  union all select p_partkey, 'type', p_type from part
  union all select p_partkey, 'size', cast(p_size as varchar) from part)"""

_LISTED = ", ".join(f"'{w}'" for w in STOPWORDS)


def clean(text: str) -> str:
    no_some = f"regexp_replace(coalesce({text}, ''), '\\bSome.\\b', ' ', 'g')"
    return f"regexp_replace(replace({no_some}, '°', 'degrees'), '[!-\\-/:-@\\[-`{{-~]', '', 'g')"


def tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({text}, '')), '[\\W_]+'), lambda t: t <> '')"


def keep(array: str) -> str:
    return f"list_filter({array}, lambda t: t not in ({_LISTED}))"


def joined(array: str) -> str:
    return f"array_to_string({array}, ' ')"


DESCRIPTION = f"""
description_tokens as (
  select doc_id as product_uid, {keep(tokens(clean("text")))} as tokens from documents)"""

TRAINING = f"""
training_tokens as (
  select id, product_uid, {keep(tokens("title || ' ' || search_term"))} as tokens, relevance from train)"""

SEARCH = f"""
search_tokens as (select id, product_uid, search_term, {tokens("search_term")} as tokens from train)"""

ATTRIBUTE_BAG = f"""
attribute_bag as (
  select product_uid, term, count(*) as tf
  from (select product_uid, unnest({keep(tokens(clean("name || ' ' || value")))}) as term from attributes)
  group by all)"""

SHARED = """
shared as (
  select product_uid, term, sum(tf) as tf
  from (select * from attribute_bag
        union all select product_uid, unnest(tokens), 1 from description_tokens)
  group by all)"""

# Training rows with the terms of their product; null terms where it has none.
BUNDLE = """
bundle as (
  select id, product_uid, relevance, term, cast(sum(tf) as bigint) as tf
  from (select id, product_uid, relevance, unnest(tokens) as term, 1 as tf from training_tokens
        union all
        select t.id, t.product_uid, t.relevance, s.term, coalesce(s.tf, 0)
        from training_tokens t left join shared s on s.product_uid = t.product_uid)
  group by all)"""

DOC_BAG = """
doc_bag as (
  select product_uid as id, term, count(*) as tf
  from (select product_uid, unnest(tokens) as term from description_tokens) group by all)"""

SEARCH_BAG = """
search_bag as (
  select id, term, count(*) as tf from (select id, unnest(tokens) as term from search_tokens) group by all)"""

FULL_BUNDLE = [TRAIN, ATTRIBUTES, TRAINING, DESCRIPTION, ATTRIBUTE_BAG, SHARED, BUNDLE]

_M = 4294967296


def _rotate(x: str, bits: int) -> str:
    return f"((({x} << {bits}) % {_M}) | ({x} >> {32 - bits}))"


def _mix(k: str) -> str:
    scrambled = f"(({k} * 3432918353) % {_M})"
    return f"(({_rotate(scrambled, 15)} * 461845907) % {_M})"


def _byte(term: str, place: str) -> str:
    return f"ascii(substr({term}, cast({place} as bigint), 1))::ubigint"


def bucketed(vocabulary: str) -> str:
    """CTE buckets(term, bucket): MurmurHash3 (x86, 32 bit, seed 42) of each
    ASCII term modulo 20,000, from its published definition."""
    block = " | ".join(f"({_byte('term', f'4 * b + {i + 1}')} << {8 * i})" for i in range(4))
    step = f"xor(h, {_mix('k')})"
    rest = " | ".join(
        f"(case when length(term) % 4 > {i} then {_byte('term', f'length(term) - length(term) % 4 + {i + 1}')} << {8 * i}"
        f" else 0::ubigint end)"
        for i in range(3)
    )
    return f"""
vocabulary as ({vocabulary}),
hash_blocks as (
  select term, list_transform(range(length(term) // 4), lambda b: {block}) as ks, {rest} as rest from vocabulary),
hash_body as (
  select term, rest, list_reduce(ks, lambda h, k: ({_rotate(step, 13)} * 5 + 3864292196) % {_M}, 42::ubigint) as h
  from hash_blocks),
hash_tail as (select term, xor(xor(h, {_mix("rest")}), length(term)::ubigint) as h from hash_body),
hash_mix1 as (select term, (xor(h, h >> 16) * 2246822507) % {_M} as h from hash_tail),
hash_mix2 as (select term, (xor(h, h >> 13) * 3266489909) % {_M} as h from hash_mix1),
hash_mix3 as (select term, xor(h, h >> 16)::bigint as h from hash_mix2),
buckets as (
  select term, cast((((case when h >= 2147483648 then h - {_M} else h end) % 20000) + 20000) % 20000 as integer) as bucket
  from hash_mix3)"""


def query(ctes: list[str], body: str) -> str:
    return "with" + ",".join(ctes) + "\n" + body
