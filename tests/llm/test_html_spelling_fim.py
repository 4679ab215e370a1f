"""HTML extraction, spelling variants and fill-in-middle against brute force."""

import hashlib
import html as H
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from shelfscore.llm import fim, html, spelling

# ---- fill-in-middle ----


def brute_fim(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    plain = n == 0 or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if plain:
        form, out = "plain", text
    elif h4 % 100 < 20:
        form, out = "spm", f"<S>{suf}<P>{pre}<M>{mid}"
    else:
        form, out = "psm", f"<P>{pre}<S>{suf}<M>{mid}"
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id,
        n,
        form,
        None if plain else a,
        None if plain else b - a,
        sha(out),
        sha(text),
    )


@pytest.mark.parametrize("unit", [7, fim.UNIT])
def test_fim_equals_brute_force(cases, unit):
    rows = [(r["doc_id"], r["text"]) for r in cases.select("doc_id", "text").collect()]
    expected = sorted((brute_fim(i, t) for i, t in rows), key=repr)
    found = fim.fill_in_middle(cases, unit=unit)
    cols = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted((tuple(r) for r in found.select(*cols).collect()), key=repr) == expected


def test_fim_restores_every_text_and_has_all_forms(spark):
    docs = spark.createDataFrame([(k, "abc <P> x" if k == 3 else "word " * k) for k in range(300)], "doc_id long, text string")
    found = fim.fill_in_middle(docs, unit=5).collect()
    assert len(found) == 300
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[3]["form"] == "plain" and by_id[0]["form"] == "plain"
    for k in range(300):
        text = "abc <P> x" if k == 3 else "word " * k
        assert by_id[k]["restored_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_fim_empty_table(no_rows):
    assert fim.fill_in_middle(no_rows).count() == 0


# ---- spelling variants ----


def brute_spelling(rows):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{low}".encode())
                if h % 199 == 0:
                    p = h % len(low)
                    low = low[:p] + low[p + 1 :]
            counts[low] = counts.get(low, 0) + 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        s, t = (a, b) if len(a) < len(b) else (b, a)
        return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))

    out = {}
    for w, n in vocab.items():
        ns = [v for v in vocab if near(w, v)]
        best = min(ns, key=lambda v: (-vocab[v], v)) if ns else None
        form = best if best is not None and vocab[best] >= 5 * n else None
        out[w] = [form, n, len(ns), vocab[form] if form else None]
    result = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        result.append((w, form, root, n, n_near, form_n))
    return sorted(result)


def variants_fixture(spark):
    words = {"colour": 40, "color": 9, "colours": 30, "coloor": 6, "kolour": 5, "sttar": 3, "wwaterr": 7, "waterr": 50,
             "wateer": 6, "water": 8, "aaabbb": 10, "aabbb": 60, "aaabb": 60, "Ärger": 2, "ärgern": 9, "ärgern": 9}
    rows, k = [], 0
    for w, n in words.items():
        for i in range(n):
            rows.append((k, f"{w} x{i} {w.upper() if i % 4 == 0 else w}, {w}"))
            k += 1
    rows += [(None, "colour colour"), (k, None), (k + 1, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_spelling_equals_brute_force(spark):
    docs = variants_fixture(spark)
    expected = brute_spelling([(r["doc_id"], r["text"]) for r in docs.collect()])
    found = spelling.spelling_variants(docs)
    cols = ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in found.select(*cols).collect())
    assert got == expected
    assert any(r[1] is not None for r in got)


def test_spelling_on_cases_and_empty(cases, no_rows):
    cols = ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [(r["doc_id"], r["text"]) for r in cases.select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in spelling.spelling_variants(cases).select(*cols).collect())
    assert got == brute_spelling(rows)
    assert spelling.spelling_variants(no_rows).count() == 0


def test_spelling_of_the_small_table_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = duckdb.sql(f"select doc_id, text from '{sf_dir}/documents.parquet'").fetchall()
    cols = ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted(tuple(r) for r in spelling.spelling_variants(docs).select(*cols).collect())
    assert got == brute_spelling(rows)


# ---- html ----


def article_text(page):
    """Brute force for pages whose main text is one article element without
    furniture inside."""
    inner = page[page.index("<article>") : page.index("</article>")]
    return " ".join(H.unescape(re.sub(r"<[^>]+>", " ", inner)).split())


def test_html_equals_article_text_of_the_small_tables(spark):
    for folder in ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]:
        pages = spark.read.parquet(f"{folder}/pages.parquet")
        found = {r["page_id"]: r for r in html.extract_main_text(pages, ["page_id", "url"]).collect()}
        raw = duckdb.sql(f"select page_id, html from '{folder}/pages.parquet'").fetchall()
        assert len(found) == len(raw)
        for page_id, page in raw:
            assert found[page_id]["text"] == article_text(page), page_id
            assert found[page_id]["n_chars"] == len(found[page_id]["text"])


MADE = [
    (1, None),
    (2, ""),
    (3, "<p>Only a short line.</p>"),
    (
        4,
        "<html><head><title>T</title><script>var a = '<p>no</p>';</script></head><body>"
        "<nav><a href='/'>Home</a> <a href='/x'>X</a></nav><div class='cookie-notice'>We use cookies here, accept them.</div>"
        "<article><h1>Caf&eacute; &amp; tea</h1><p>The caf&#233; opened   in\n 1901 and still\tserves tea today.</p>"
        "<form><p>Sign up for our letter now please</p></form>"
        "<section class='comments'><p>First! Great post about the cafe.</p></section></article>"
        "<aside><p>Related stories you may like to read later on.</p></aside><footer>(c) 2024</footer></body></html>",
    ),
    (5, "<p>unclosed <b>bold " + "word " * 5000),
]


def test_html_made_pages(spark):
    pages = spark.createDataFrame(MADE, "page_id long, html string").withColumns({"text": F.lit("clash"), "url": F.lit("u")})
    found = {r["page_id"]: r for r in html.extract_main_text(pages, ["page_id", "url"]).collect()}
    assert found[1]["text"] == "" and found[2]["text"] == ""
    assert found[4]["text"] == "Café & tea The café opened in 1901 and still serves tea today."
    assert found[5]["text"] == "unclosed bold " + " ".join(["word"] * 5000)
    assert found[3]["n_chars"] == len(found[3]["text"])


def test_html_tree_is_one_expression_and_learns_furniture(spark):
    model = html.train_tree(spark)
    blocks = html._labelled_blocks(spark)
    judged = blocks.select("label", html.tree_column(model, F.struct(*html.FEATURES)).alias("main")).collect()
    right = sum(float(r["main"]) == r["label"] for r in judged)
    assert right / len(judged) >= 0.9
    pages = spark.createDataFrame(MADE[3:4], "page_id long, html string")
    plan = html.extract_main_text(pages, ["page_id"], model=model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_html_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, html string")
    assert html.extract_main_text(pages, ["page_id"]).count() == 0
