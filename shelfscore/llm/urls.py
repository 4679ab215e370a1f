"""URL filters: host and path rules, and a character language-model ratio.

Two smoothed Markov models of variable order learn how accepted and rejected
addresses are spelt. An order that has not seen the last characters hands over
to the next lower one; counts are exact and lie in a table that grows with the
input, which the characters of every address join. The score of an address is its mean log ratio per
character; the threshold lies between the means of both training sets, nearer
to the one that varies less. Addresses with a rule are the training sets, and
only those without one are judged by the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscore.llm.storage import written

ORDER = 4
# Counts are kept under the characters themselves. Whoever hashes them must keep
# the whole 64-bit hash to find the same counts.
BUCKETS = 1 << 64
BACKOFF = 2.0
# Parts of 1 in which log ratios are summed.
_UNITS = 10**10
_PAD = "\u0002"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# (host, path, verdict)
Rule = tuple[str, str, str]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty without a scheme mark."""
    known = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(known, F.lit("://")), F.substr(known, F.instr(known, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for of, begin, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == of) | F.endswith(host, F.lit("." + of))) & F.startswith(path, F.lit(begin))
        name = F.when(fits, F.lit(of + begin)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _grams(urls: DataFrame, *keys: str) -> DataFrame:
    """keys and g, one row per character of a url: the ORDER characters before
    it and itself. g holds what every lower order looks at."""
    padded = F.concat(F.lit(_PAD * ORDER), F.col("url"))
    known = urls.where("length(url) > 0").select(*keys, padded.alias("p"), F.length("url").alias("n"))
    places = known.select(*keys, "p", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    return places.select(*keys, F.substr("p", F.col("i"), F.lit(ORDER + 1)).alias("g"))


def _parts(grams: DataFrame, *keys: str) -> DataFrame:
    """keys, part and text: for each order k the characters up to a position,
    with it (part 2 k) and before it (part 2 k + 1, the context)."""
    parts = [
        F.struct(F.lit(2 * k + c).alias("part"), F.substr("g", F.lit(ORDER + 1 - k), F.lit(k if c else k + 1)).alias("text"))
        for k in range(ORDER + 1)
        for c in (0, 1)
    ]
    return grams.select(*keys, F.explode(F.array(*parts)).alias("x")).select(*keys, "x.part", "x.text")


def character_counts(urls: DataFrame) -> DataFrame:
    """(g, a, r): how often accepted and rejected urls hold each run of
    ORDER + 1 characters, in a written table that grows with the input. Runs of
    other urls are listed with counts of 0. urls is (url, verdict)."""
    counts = _grams(urls, "verdict").groupBy("g").agg(
        F.count_if(F.col("verdict") == "allow").alias("a"), F.count_if(F.col("verdict") == "block").alias("r")
    )
    return written(counts, "url-grams")


def gram_ratios(grams: DataFrame) -> DataFrame:
    """(g, ratio): log(p_accepted / p_rejected) of the last character of each
    run after the others, from exact counts of all orders."""
    seen = _parts(grams.where("a + r > 0"), "a", "r").groupBy("part", "text").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    seen = written(seen, "url-counts")
    met = _parts(grams, "g").join(seen, ["part", "text"], "left")
    wide = met.groupBy("g").agg(
        *[F.coalesce(F.max(F.when(F.col("part") == k, F.col(c))), F.lit(0)).alias(f"{c}{k}") for c in "ar" for k in range(2 * ORDER + 2)]
    )
    return written(wide.select("g", (_log_probability("a") - _log_probability("r")).alias("ratio")), "url-ratios")


def _log_probability(side: str) -> Column:
    """Interpolated from order 0 up; an unseen context changes nothing."""
    p = F.lit(1 / 256)
    for k in range(ORDER + 1):
        p = (F.col(f"{side}{2 * k}") + BACKOFF * p) / (F.col(f"{side}{2 * k + 1}") + BACKOFF)
    return F.log(p)


def log_ratio(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(key, score): mean over the characters of log(p_accepted / p_rejected).
    Whole numbers are summed, so that no order of the rows changes a score."""
    places = _grams(urls, "key").groupBy("key", "g").agg(F.count("*").alias("n"))
    met = places.join(ratios, "g").select("key", "n", F.round(F.col("ratio") * _UNITS).cast("long").alias("units"))
    return met.groupBy("key").agg((F.sum(F.col("n") * F.col("units")) / F.sum("n") / _UNITS).alias("score"))


def filtered(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, url, host, path, rule, score, verdict.

    Defined cases: a null or empty url has a score of 0. If the rules accept or
    reject no address at all, there is no second model, and addresses without a
    rule are allowed. Repeated rows get equal verdicts. A null id is carried
    along. An empty table gives an empty result. Other columns of the input are
    not read."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    host, path = split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": name, "ruled": verdict})
    # The key is written with the rows, so that every reader sees the same one.
    rows = written(rows.withColumn("key", F.monotonically_increasing_id()), "url-rows")
    ratios = gram_ratios(character_counts(rows.select("url", F.col("ruled").alias("verdict"))))
    scores = written(log_ratio(rows, ratios), "url-scores")
    rows = rows.join(scores, "key", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    rows = written(rows.drop("key"), "url-scored")
    good, bad = F.col("ruled") == "allow", F.col("ruled") == "block"
    stats = rows.agg(
        *[F.avg(F.when(c, F.col("score"))).alias(f"{n}_mean") for n, c in (("good", good), ("bad", bad))],
        *[F.coalesce(F.stddev_pop(F.when(c, F.col("score"))), F.lit(0.0)).alias(f"{n}_dev") for n, c in (("good", good), ("bad", bad))],
    )
    dev = F.col("good_dev") + F.col("bad_dev") + 1e-9
    cut = (F.col("good_mean") * (F.col("bad_dev") + 5e-10) + F.col("bad_mean") * (F.col("good_dev") + 5e-10)) / dev
    threshold = stats.select(cut.alias("cut")).scalar()
    judged = F.when(F.coalesce(F.col("score") < threshold, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select("id", "url", "host", "path", "rule", "score", F.coalesce("ruled", judged).alias("verdict"))
