"""Fill-in-middle transformation by secondary-sort assembly.

Every text is cut into unit chunks of code points, and each chunk into the
pieces that fall into prefix, middle and suffix. A piece is keyed by its row
and its place in the output; the three sentinels are pieces of their own. The
pieces are partitioned by row and sorted within the partitions by that key, so
one pass streams them into an incremental SHA-256 of the output without ever
building the output as one string. For restoration the output stream is parsed
again: each piece takes the segment of the last sentinel before it, the pieces
are sorted anew into the order prefix, middle, suffix, and a second streaming
pass digests the rebuilt text.

Defined cases: a null text is empty; an empty text, or one that contains
``<P>``, ``<S>`` or ``<M>``, is plain and comes out unchanged; a null doc_id
is hashed as the empty id (``1:``); repeated rows are rows of their own and
each gets its own (equal) result; a very long text is many chunks, spread
over the sort and streamed, never held whole in a Python worker. Extra input
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscore.llm.storage import bounded_batches

__all__ = ["SENTINELS", "fill_in_middle", "split_points"]

# The sentinels, the hash prefix, the share of plain texts in
# percent and the share of spm among the rest in percent.
SENTINELS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
HASH_PREFIX = "1:"
PLAIN_PERCENT = 10
SPM_PERCENT = 20

# Code points of one unit chunk. Bounds the size of one row of the sort and
# of one value handed to Python.
UNIT = 16_384
# A piece's place: segment rank above this many code points of offset.
_SHIFT = 1 << 40


def _group(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def split_points(doc_id: Column, text: Column) -> dict[str, Column]:
    """n, the cut points and the form of one row as columns."""
    n = F.char_length(text).cast("long")
    digest = F.sha2(F.concat(F.lit(HASH_PREFIX), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h1, h2, h3, h4 = (_group(digest, k) for k in range(4))
    first, second = F.pmod(h1, n + 1), F.pmod(h2, n + 1)
    marked = F.lit(False)
    for mark in SENTINELS.values():
        marked = marked | F.contains(text, F.lit(mark))
    plain = (n == 0) | marked | (F.pmod(h3, F.lit(100)) >= 100 - PLAIN_PERCENT)
    form = F.when(plain, "plain").when(F.pmod(h4, F.lit(100)) < SPM_PERCENT, "spm").otherwise("psm")
    return {"n": n, "a": F.least(first, second), "b": F.greatest(first, second), "form": form}


def _out_ranks(form: Column) -> dict[str, Column]:
    """Rank in the output of each segment and sentinel: psm is <P> prefix
    <S> suffix <M> middle, spm is <S> suffix <P> prefix <M> middle."""
    spm = form == "spm"
    return {
        "prefix_mark": F.when(spm, 2).otherwise(0),
        "prefix": F.when(spm, 3).otherwise(1),
        "suffix_mark": F.when(spm, 0).otherwise(2),
        "suffix": F.when(spm, 1).otherwise(3),
        "middle_mark": F.lit(4),
        "middle": F.lit(5),
    }


_META = ["doc_id", "n", "form", "a", "b"]


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Streams rows sorted by (row, pass, key) into the digest of the output
    (pass 0) and of the restored text (pass 1) of every row."""
    current, meta, states = None, None, None
    done: list[tuple] = []

    def finish() -> None:
        done.append((current, *meta, states[0].hexdigest(), states[1].hexdigest()))

    for batch in batches:
        columns = [batch[c].tolist() for c in ["row", "pass", "piece", *_META]]
        for row, step, piece, *info in zip(*columns):
            if row != current:
                if states is not None:
                    finish()
                current, meta, states = row, info, (hashlib.sha256(), hashlib.sha256())
            states[step].update((piece or "").encode("utf-8"))
        if done:
            yield pd.DataFrame(done, columns=["row", *_META, "output_sha256", "restored_sha256"])
            done = []
    if states is not None:
        finish()
        yield pd.DataFrame(done, columns=["row", *_META, "output_sha256", "restored_sha256"])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = UNIT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256) for every row of docs. prefix_chars and middle_chars are
    null for plain rows. restored_sha256 is the digest of the text rebuilt from
    the output pieces and equals the SHA-256 of the input text.

    All pieces of a row, sentinels included, come from one pass over the row,
    so they share its key; the only shuffle is the partitioning by row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), text.alias("text"))
    cut = split_points(F.col("doc_id"), F.col("text"))
    base = base.select("row", "doc_id", "text", *[c.alias(k) for k, c in cut.items()])
    ranks = _out_ranks(F.col("form"))
    plain = F.col("form") == "plain"
    meta = ["row", *_META]

    item = lambda k, chunk, rank: F.struct(
        k.cast("long").alias("k"), chunk.alias("chunk"), rank.cast("long").alias("mark")
    )
    chunks = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{unit}}}"), 0)
    chunks = F.when(F.col("n") == 0, F.array(F.lit(""))).otherwise(chunks)
    chunk_items = F.transform(chunks, lambda c, k: item(k, c, F.lit(None)))
    mark_items = F.when(
        ~plain, F.array(*[item(F.lit(-1), F.lit(m), ranks[f"{name}_mark"]) for name, m in SENTINELS.items()])
    ).otherwise(F.array().cast("array<struct<k:bigint,chunk:string,mark:bigint>>"))
    items = base.select(*meta, F.explode(F.concat(mark_items, chunk_items)).alias("i"))

    start = F.col("i.k") * unit
    end = start + F.char_length("i.chunk")
    seg = lambda rank, lo, hi: F.struct(rank.cast("long").alias("rank"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))
    segments = (
        F.when(F.col("i.mark").isNotNull(), F.array(seg(F.col("i.mark"), F.lit(-1), F.lit(-1))))
        .when(plain, F.array(seg(F.lit(0), F.lit(0), F.col("n"))))
        .otherwise(
            F.array(
                seg(ranks["prefix"], F.lit(0), F.col("a")),
                seg(ranks["middle"], F.col("a"), F.col("b")),
                seg(ranks["suffix"], F.col("b"), F.col("n")),
            )
        )
    )
    spans = items.select(*meta, "i", start.alias("start"), end.alias("end"), F.explode(segments).alias("s"))
    lo = F.greatest(F.col("s.lo"), F.col("start"))
    hi = F.least(F.col("s.hi"), F.col("end"))
    is_mark = F.col("i.mark").isNotNull()
    stream = spans.where(is_mark | (hi > lo) | (F.col("n") == 0)).select(
        *meta,
        F.when(is_mark, F.col("s.rank") * F.lit(_SHIFT)).otherwise(F.col("s.rank") * F.lit(_SHIFT) + lo + 1).alias("out_key"),
        F.when(is_mark, F.col("i.chunk"))
        .otherwise(F.substring("i.chunk", (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int")))
        .alias("piece"),
    )

    # The output stream, parsed: each piece belongs to the last sentinel before it.
    in_order = Window.partitionBy("row").orderBy("out_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sentinel = (~plain) & F.col("piece").isin(*SENTINELS.values()) & (F.pmod("out_key", F.lit(_SHIFT)) == 0)
    labelled = stream.withColumn("sentinel", sentinel).withColumn(
        "segment", F.last(F.when(F.col("sentinel"), F.col("piece")), ignorenulls=True).over(in_order)
    )
    # Restoration: the parsed pieces without sentinels, in the order prefix, middle, suffix.
    restore_rank = (
        F.when(F.col("segment") == SENTINELS["middle"], 1).when(F.col("segment") == SENTINELS["suffix"], 2).otherwise(0)
    )
    passes = F.array(F.struct(F.lit(0).alias("pass"), F.col("out_key").alias("key")))
    both = F.array_union(passes, F.array(F.struct(F.lit(1).alias("pass"), (restore_rank * F.lit(_SHIFT) + F.pmod("out_key", F.lit(_SHIFT))).alias("key"))))
    steps = labelled.select(*meta, "piece", F.explode(F.when(F.col("sentinel"), passes).otherwise(both)).alias("p"))
    steps = steps.select(*meta, "piece", "p.pass", "p.key").sortWithinPartitions("row", "pass", "key")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"row long, doc_id {kind}, n long, form string, a long, b long, output_sha256 string, restored_sha256 string"
    found = steps.select("row", "pass", "piece", *_META).mapInPandas(_digests, schema)
    return found.select(
        "doc_id",
        "n",
        "form",
        F.when(F.col("form") != "plain", F.col("a")).alias("prefix_chars"),
        F.when(F.col("form") != "plain", F.col("b") - F.col("a")).alias("middle_chars"),
        "output_sha256",
        "restored_sha256",
    )
