"""Toxicity, quality rules, url filters and quotes."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfscore.llm import quality, queries, quotes, toxicity, urls
from shelfscore.llm.storage import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- toxicity ----


def test_machine_learns_a_pair_that_single_terms_do_not_tell():
    """Toxic if and only if both of two terms occur, each of which occurs as
    often in clean texts."""
    rng, docs, y = np.random.default_rng(1), [], []
    for k in range(3_000):
        words = [f"w{j}" for j in rng.integers(0, 60, 8)]
        both = k % 4
        words += [["insult"], ["group"], ["insult", "group"], []][both]
        docs.append(toxicity.terms(" ".join(words).encode()))
        y.append(float(both == 2))
    y = np.array(y)
    machine = toxicity.fit(docs[:2_400], y[:2_400], np.ones(2_400))
    right = [(machine.score(d) >= 0.5) == bool(t) for d, t in zip(docs[2_400:], y[2_400:], strict=True)]
    assert np.mean(right) > 0.97
    weights = machine.weight[machine.places(toxicity.terms(b"insult"))]
    assert len(weights)


def test_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    known = np.sort(rng.integers(0, 2**64, 9, dtype=np.uint64))
    m = toxicity.Machine(0.3, known, rng.normal(size=9), rng.normal(size=(9, 4)))
    found = np.sort(np.append(known[[1, 4, 7]], rng.integers(0, 2**64, 3, dtype=np.uint64)))
    at = [1, 4, 7]
    z = 0.3 + m.weight[at].sum() + sum(m.vectors[i] @ m.vectors[j] for i in at for j in at if i < j)
    assert abs(m.score(found) - 1 / (1 + np.exp(-z))) < 1e-12


def test_held_out_fold_is_the_crc_of_the_id(spark):
    rows = spark.range(300).select("id", toxicity.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (toxicity.learn(docs, x, "doc_id", "text", "toxic") for x in (labels, turned))
    assert one.bias == two.bias and (one.weight == two.weight).all() and (one.vectors == two.vectors).all()


def test_toxic_documents_are_found_and_clean_ones_kept(spark):
    found = queries.op2_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    hits = Counter((r["toxic"], r["predicted"]) for r in rows)
    assert hits[1, 1] / (hits[1, 0] + hits[1, 1]) > 0.9
    assert hits[0, 1] / (hits[0, 0] + hits[0, 1]) < 0.01


def test_toxicity_of_odd_rows(spark, cases, no_rows):
    schema = "doc_id long, toxic int, quality int, extra string"
    labels = spark.createDataFrame([(0, 1, 1, "a"), (0, 0, 1, "a"), (7, 0, 1, None), (8, None, None, None), (None, 1, 0, "b")], schema)
    scored = toxicity.toxicity(cases, labels)
    rows = scored.select("doc_id", "text", "toxic_score").collect()
    assert scored.columns == [*cases.columns, "toxic_score"] and len(rows) == cases.count()
    assert all(0 <= r["toxic_score"] <= 1 for r in rows)
    assert len({r["toxic_score"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert toxicity.toxicity(no_rows, labels).count() == 0
    assert toxicity.toxicity(cases, labels.limit(0)).select("toxic_score").distinct().count() == 1


# ---- quality ----


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    cover = {k + j for k, g in enumerate(grams) if g in twice for j in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    n = len(words)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(cover), n < 10 or 100 * len(cover) > 20 * n


_COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@pytest.fixture()
def good(spark):
    return spark.createDataFrame([(0, 1, 0), (9, 1, 0), (None, 1, 1), (4, None, None), (11, 0, 0)], "doc_id long, quality int, toxic int")


def test_base_counts_equal_brute_force(spark, cases, good, sf_dir):
    extra = spark.createDataFrame(
        [(200 + k, t) for k, t in enumerate(["a b c d e " * 30, "x\n" * 40 + "y # $", "p q r s t p q r s t u v w x", "😀 é\u00a0b|<>" * 5, "a b c d e f a b c d e g a b c d e"])],
        "doc_id long, text string",
    )
    docs = cases.select("doc_id", "text", "words", "score").unionByName(extra, allowMissingColumns=True)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for df, labels in ((docs, good), (documents, spark.read.parquet(f"{sf_dir}/labels.parquet"))):
        found = quality.judged(df, labels).select("id", *_COUNTS).collect()
        want = [(r["doc_id"], *brute_quality(r["text"])) for r in df.select("doc_id", "text").collect()]
        assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))


def test_ratios_equal_brute_force(spark, cases, good):
    """The hash is the engine's; counts, ratios and means are done again."""
    buckets = F.explode(quality.gram_buckets("w", quality.BUCKETS)).alias("b")
    rows = cases.select("doc_id", quality.content_words(F.col("text")).alias("w")).select("doc_id", buckets).collect()
    corpus, trusted = Counter(r["b"] for r in rows), Counter(r["b"] for r in rows if r["doc_id"] in (0, 9))
    prior = quality.PRIOR * quality.BUCKETS
    n, m = sum(corpus.values()), sum(trusted.values())
    ratio = {b: np.log((trusted[b] / (c / n) + prior) / (m + prior)) for b, c in corpus.items()}
    found = quality.judged(cases, good).where("id is not null").collect()
    for r in found:
        own = [ratio[x["b"]] for x in rows if x["doc_id"] == r["id"]]
        copies = sum(f["id"] == r["id"] for f in found)
        assert abs(r["score"] - (np.mean(own) if own else 0)) < 1e-5, (r["id"], copies)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality.THRESHOLD)


def test_quality_scores_follow_exact_counts(spark, cases, good):
    """The 20,000 words of one text fill any small number of places."""
    texts = [(r["doc_id"], WORD.findall(r["text"] or "")) for r in cases.select("doc_id", "text").collect()]
    grams = [(i, [*words, *zip(words, words[1:], strict=False)]) for i, words in texts]
    corpus, trusted = (Counter(g for i, own in grams if all_ or i in (0, 9) for g in own) for all_ in (True, False))
    n, m = sum(corpus.values()), sum(trusted.values())
    want = {i: np.mean([np.log((trusted[g] / (corpus[g] / n) + 327_680) / (m + 327_680)) for g in own]) if own else 0 for i, own in grams}
    for r in quality.judged(cases, good).where("id is not null").collect():
        assert abs(r["score"] - want[r["id"]]) < 1e-6


def test_ratios_are_listed_for_trusted_ngrams_only(spark):
    """What no trusted document has was listed and joined as well."""
    docs = spark.createDataFrame([(1, "a b"), (2, "a b c d"), (3, "c d e"), (4, "c d e"), (5, "b f")], "id long, text string")
    trusted = spark.createDataFrame([(1,), (5,)], "id long")
    listed = quality.gram_ratios(docs, trusted, 20, 6).collect()
    want = spark.createDataFrame([("a",), ("b",)], "w string").select(F.xxhash64("w").alias("g")).unionByName(
        spark.sql("select xxhash64('a', 'b') as g")
    )
    assert sorted(r["gram"] for r in listed) == sorted(r["g"] for r in want.collect())
    sums = quality.gram_sums(docs, quality.gram_ratios(docs, trusted, 20, 6)).collect()
    # Repeated texts share a key: (3, 4) have 10 n-grams, none of them trusted.
    assert sorted((r["alone"], r["n_grams"]) for r in sums) == [(0, 3), (2, 3), (4, 7), (10, 10)]


def test_ngrams_are_shuffled_in_parts(spark, cases, good, monkeypatch):
    """All n-grams of all texts lay in the shuffles of one query, and stayed on
    disk until the next one was done."""
    plans, dropped = [], []

    def seen(df, label):
        plans.append((label, df._jdf.queryExecution().optimizedPlan().toString()))
        dropped.append((label, spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")))
        return written(df, label)

    monkeypatch.setattr(quality, "written", seen)
    scores = {str(r) for r in quality.judged(cases, good).collect()}
    texts = [label for label, plan in plans if "pmod" in plan]
    assert (texts.count("gram-ratios"), texts.count("gram-sums")) == (quality.COUNT_ROUNDS, quality.JOIN_ROUNDS)
    assert all(on == "true" for label, on in dropped if label.startswith("gram-"))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    # Whatever number of n-grams is sent to the texts, and of parts.
    for head, rounds in ((0, 1), (3, 2)):
        monkeypatch.setattr(quality, "HEAD", head)
        monkeypatch.setattr(quality, "JOIN_ROUNDS", rounds)
        assert {str(r) for r in quality.judged(cases, good).collect()} == scores


@pytest.mark.parametrize("share", [4, 1])
def test_junk_of_held_out_labels_goes_at_two_sizes(spark, share):
    d = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{d}/documents.parquet").where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    labels = spark.read.parquet(f"{d}/labels.parquet")
    held = toxicity.held_out("doc_id")
    found = written(quality.judged(docs, labels.where(~held)), "judged").join(labels.where(held), F.col("id") == F.col("doc_id"))
    found = found.where("not base_failed and quality = 0").agg(F.avg(F.col("kept").cast("int")), F.count("*")).first()
    assert found[1] > 10 and found[0] < 0.1


def test_junk_goes_and_clean_text_stays(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").withColumnRenamed("doc_id", "id")
    # Written first: a filter would be pushed below the counts and repeat them.
    judged = written(queries.op3_quality(spark, d).withColumnRenamed("doc_id", "id"), "judged")
    found = judged.join(labels, "id").where("not base_failed")
    share = {r["quality"]: r["kept"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.999 and share[0] < 0.1


def test_quality_of_nothing(no_rows, good, cases):
    assert quality.judged(no_rows, good).count() == 0
    assert all(abs(r["score"]) < 1e-5 for r in quality.judged(cases, good.limit(0)).collect())


# ---- urls ----


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in queries.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


_URLS = [
    None, "", "no scheme", "http://", "http://A.ORG", "http://a.org/", "HTTPS://Example.Org/es/x?q=/en/1#f", "http://example.org/en/12/",
    "http://sub.example.org/en/1", "http://notexample.org/es/1", "http://x.com/fr/", "http://x.com/frx", "ftp://com/de/a", "http://x.com?/de/",
    "http://x.net#/de/", "a://b://c.org/d", "http://ÄÖ.org/é", "http://x.org:80/es/", "http://org/",
]


def test_hosts_paths_and_rules_equal_brute_force(spark):
    rows = [(k, u, "x", "y") for k, u in enumerate([*_URLS, *_URLS])] + [(None, "http://a.com/de/1", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, score string")
    for r in urls.filtered(pages, queries.RULES).collect():
        host, path, rule, verdict = brute_rule(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")


def test_url_scores_equal_brute_force(spark):
    rng = random.Random(2)
    made = [f"http://{rng.choice('ab')}{rng.randint(0, 99)}.{t}/{p}/{rng.randint(0, 9)}" for t, p in (("org", "x"), ("com", "de"), ("net", "y")) for _ in range(30)]
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, url string")
    found = urls.filtered(pages, queries.RULES).collect()
    accepted, rejected = Counter(), Counter()

    def slot(text, order, context):
        """The engine's 64-bit hash of the part's number and the characters."""
        part = 2 * order + context
        seed = xxhash.xxh64(part.to_bytes(4, "little"), seed=42).intdigest()
        h = xxhash.xxh64(text.encode(), seed=seed).intdigest()
        return (h - 2**64 if h >= 2**63 else h) % urls.BUCKETS + part * urls.BUCKETS

    for url in made:
        verdict = brute_rule(url)[3]
        padded = "\x02" * 4 + url
        for i in range(4, len(padded)) if verdict else ():
            side = accepted if verdict == "allow" else rejected
            side.update([slot(padded[i - k : i + 1], k, 0) for k in range(5)] + [slot(padded[i - k : i], k, 1) for k in range(5)])

    def probability(side, padded, i):
        p = 1 / 256
        for k in range(5):
            p = (side[slot(padded[i - k : i + 1], k, 0)] + urls.BACKOFF * p) / (side[slot(padded[i - k : i], k, 1)] + urls.BACKOFF)
        return p

    for r in found:
        padded = "\x02" * 4 + r["url"]
        ratios = [np.log(probability(accepted, padded, i) / probability(rejected, padded, i)) for i in range(4, len(padded))]
        assert abs(r["score"] - np.mean(ratios)) < 1e-9
    good, bad = ([r["score"] for r in found if brute_rule(r["url"])[3] == v] for v in ("allow", "block"))
    cut = (np.mean(good) * np.std(bad) + np.mean(bad) * np.std(good)) / (np.std(good) + np.std(bad))
    for r in (r for r in found if r["rule"] is None):
        assert r["verdict"] == ("block" if r["score"] < cut else "allow") or abs(r["score"] - cut) < 1e-6


def test_url_verdicts_follow_exact_counts(spark):
    """So many runs of characters that any fixed number of places would mix them."""
    rng = random.Random(4)
    syllable = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5))
    one, two = ([syllable() for _ in range(400)] for _ in range(2))
    kinds = [("a.org/", one), ("b.com/de/", two), ("c.net/", one), ("c.net/", two), ("c.net/", one + two)]
    made = [f"http://{host}{''.join(rng.choices(of, k=6))}" for host, of in kinds for _ in range(600)]
    found = {r["url"]: r for r in urls.filtered(spark.createDataFrame(list(enumerate(made)), "page_id long, url string"), queries.RULES).collect()}
    grams = {v: Counter() for v in ("allow", "block")}
    contexts = {v: Counter() for v in ("allow", "block")}
    runs = lambda url: [("\x02" * 4 + url)[i : i + 5] for i in range(len(url))]
    for url in made:
        if verdict := brute_rule(url)[3]:
            for g in runs(url):
                grams[verdict].update(g[4 - k :] for k in range(5))
                contexts[verdict].update(g[4 - k : 4] for k in range(5))

    def log_p(verdict, g):
        p = 1 / 256
        for k in range(5):
            p = (grams[verdict][g[4 - k :]] + urls.BACKOFF * p) / (contexts[verdict][g[4 - k : 4]] + urls.BACKOFF)
        return np.log(p)

    want = {u: np.mean([log_p("allow", g) - log_p("block", g) for g in runs(u)]) for u in made}
    assert all(abs(found[u]["score"] - want[u]) < 1e-9 for u in made)
    good, bad = ([want[u] for u in made if brute_rule(u)[3] == v] for v in ("allow", "block"))
    cut = (np.mean(good) * np.std(bad) + np.mean(bad) * np.std(good)) / (np.std(good) + np.std(bad))
    unruled = [u for u in made if brute_rule(u)[3] is None]
    assert {found[u]["verdict"] for u in unruled} == {"allow", "block"}
    assert all(found[u]["verdict"] == ("block" if want[u] < cut else "allow") or abs(want[u] - cut) < 1e-6 for u in unruled)


def test_urls_of_nothing_and_without_training(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert urls.filtered(pages.limit(0), queries.RULES).count() == 0
    assert [r["verdict"] for r in urls.filtered(pages, []).collect()] == ["allow"]


# ---- quotes ----


def test_passages_and_levels():
    text = "top\n\n> one\n> two\n>> deep\n> > also\n\n>\n> three\n  > four\nend > not"
    assert quotes.passages(text) == [(0, "top"), (1, "one\ntwo"), (2, "deep\nalso"), (1, "three\nfour"), (0, "end > not")]
    assert quotes.passages(None) == [] == quotes.passages(" \n ")
    assert quotes.passage_hash("A  b\nc") == quotes.passage_hash("a b C")


def test_replies_are_linked_and_ordered(spark):
    mails = [
        ("a", 1, 0, "first mail here"),
        ("b", 1, 1, "answer to it\n\n> First   mail\n> here"),
        ("c", 1, 2, "third\n\n> answer to it\n>> first mail here"),
        ("d", 1, 3, "> first mail\n> here\n\nbelow"),
        ("e", 2, 5, "first mail here"),
        ("f", 2, 6, "> unknown words\n\nnew"),
        ("g", None, 1, None),
        ("h", 1, None, "> first mail here\nx"),
        (None, 1, 9, "> first mail here\nno id"),
        ("b", 1, 1, "answer to it\n\n> First   mail\n> here"),
    ]
    df = spark.createDataFrame(mails, "m string, t long, p long, text string").withColumn("id", F.lit("clash"))
    rows = quotes.linked(df, "m", "t", "p", "text").collect()
    found = {r["id"]: (r["reply_to"], r["conversation"], r["depth"], r["own_text"], r["n_quoted"]) for r in rows}
    assert len(rows) == len(mails)
    assert found["a"] == (None, "a", 0, "first mail here", 0)
    assert found["b"] == ("a", "a", 1, "answer to it", 1)
    assert found["c"] == ("b", "a", 2, "third", 2)
    assert found["d"] == ("a", "a", 1, "below", 1)
    assert found["e"][:3] == (None, "e", 0) and found["f"][:3] == (None, "f", 0)
    assert found["g"] == (None, "g", 0, "", 0) and found["h"][:2] == (None, "h")
    assert found[None] == (None, None, None, "no id", 1)
    apart = {r["id"]: r["reply_to"] for r in quotes.linked(df, "m", None, "p", "text").collect()}
    assert apart["b"] == "a" and apart["e"] is None
    assert quotes.linked(df.limit(0), "m", "t", "p", "text").count() == 0


def test_long_chains_of_replies(spark):
    mails = [(k, 1, k, f"mail number {k}" + (f"\n\n> mail number {k - 1}" if k else "")) for k in range(200)]
    df = spark.createDataFrame(mails, "m long, t long, p long, text string")
    found = quotes.linked(df, "m", "t", "p", "text").collect()
    assert all((r["conversation"], r["depth"]) == (0, r["id"]) for r in found) and len(found) == 200


def test_a_quote_belongs_to_the_latest_original(spark):
    """One long thread in which everybody says the same now and then, so the
    sequence of that passage is cut into several ranges."""
    mails = [(k, k, f"mail {k}" if k % 7 else "Thanks") for k in range(300)]
    mails += [(1000 + k, k, f"own {k}\n\n> thanks") for k in range(300)]
    df = spark.createDataFrame(mails, "m long, p long, text string").withColumn("t", F.lit(None).cast("long"))
    found = {r["id"]: (r["reply_to"], r["n_linked"]) for r in quotes.linked(df, "m", "t", "p", "text").collect()}
    assert len(found) == 600
    for k in range(300):
        # Strictly before: at its own position a quote means the one before that.
        want = (k - 1) // 7 * 7
        assert found[1000 + k] == ((want, 1) if k else (None, 0))


def test_conversation_quotes_equal_brute_force(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
    texts = {(r["conv_id"], r["turn"]): r["text"] or "" for r in turns}
    norm = lambda t: " ".join(t.split()).lower()
    found = queries.op4_quotes(spark, sf_dir).collect()
    assert len(found) == len(turns)
    for r in found:
        c, t = r["conv_id"], r["turn"]
        parts = [norm(p) for _, p in quotes.passages(texts.get((c, t - 1)))]
        votes = Counter()
        for p in parts:
            for k in sorted(x for cc, x in texts if cc == c and x < t):
                if p in [norm(q) for _, q in quotes.passages(texts[c, k])]:
                    votes[k] += 1
                    break
        want = max(votes, key=lambda k: (votes[k], k)) if votes else None
        assert r["reply_to"] == (None if want is None else f"{c}-{want}")


def test_repeated_turns_are_not_multiplied(spark, tmp_path):
    """3 turns, each 30 times: 90 rows in, 90 rows out."""
    from shelfscore.llm import queries

    rows = [(7, t, "user", f"turn number {t} says hello") for t in range(3) for _ in range(30)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    mails = queries.replies(spark.read.parquet(str(tmp_path / "conversations.parquet")))
    assert mails.count() == 90
    found = queries.op4_quotes(spark, str(tmp_path))
    assert found.count() == 90
    assert {r["reply_to"] for r in found.where("turn = 2").collect()} == {"7-1"}
