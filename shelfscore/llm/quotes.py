"""Quotation linking: from messages with nested quotes to conversations.

A line's quote level is the number of marks it begins with. Neighbouring lines
of one level make a passage; its white space and case are normalised and it is
hashed. Own passages (level 0) of earlier messages are the originals, and a
quote belongs to the latest of them before it. A message answers the original that most of its passages of level 1 come from; deeper
levels must not decide. Conversations follow from the answers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfscore.llm.storage import bounded_batches, written

_MARKS = re.compile(r"((?:[ \t]*>)+) ?|")
# Spark cannot look ahead in a chain of answers without a join per doubling.
_MAX_DOUBLINGS = 40


def passages(text: str | None) -> list[tuple[int, str]]:
    """(level, text) of the passages of a message, in order. Blank lines part
    passages and are none themselves."""
    out: list[tuple[int, list[str]]] = []
    apart = True
    for line in (text or "").split("\n"):
        marks = _MARKS.match(line)
        level, rest = (marks[1] or "").count(">"), line[marks.end() :]
        if not rest.strip():
            apart = True
        elif apart or out[-1][0] != level:
            out.append((level, [rest]))
            apart = False
        else:
            out[-1][1].append(rest)
    return [(level, "\n".join(lines)) for level, lines in out]


def passage_hash(text: str) -> int:
    plain = " ".join(text.split()).lower()
    return int.from_bytes(hashlib.blake2b(plain.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _parsed(messages: DataFrame) -> DataFrame:
    """Adds own_text and quoted, a list of (level, hash), to the keys."""
    kinds = {f.name: f.dataType.simpleString() for f in messages.schema}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.int64())]))
        for batch in batches:
            own, quoted = [], []
            for text in batch["text"].to_pylist():
                found = passages(text)
                own.append("\n\n".join(p for level, p in found if level == 0))
                quoted.append([{"level": level, "hash": passage_hash(p)} for level, p in found])
            keys = [batch[c] for c in ("id", "thread", "position")]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(own, pa.string()), pa.array(quoted, item)], names=["id", "thread", "position", "own_text", "quoted"])

    keys = ", ".join(f"{c} {kinds[c]}" for c in ("id", "thread", "position"))
    return messages.mapInArrow(parse, f"{keys}, own_text string, quoted array<struct<level:int,hash:bigint>>")


def _originals(parts: DataFrame) -> DataFrame:
    """Quotes (id, level) with the latest original (at, original) before them.

    Originals and quotes of a passage stand in one sequence by position, quotes
    first where positions are equal. Sequences are cut into ranges, so that a
    passage in very many messages spreads over tasks; the last original of the
    ranges before is carried over. A cut parts one sequence at most, so there
    are no more rows to carry than ranges."""
    known = parts.where("position is not null")
    own = known.where("level = 0").groupBy("thread", "hash", "position").agg(F.min("id").alias("original"))
    own = own.select("thread", "hash", "position", F.lit(1).alias("kind"), F.struct(F.col("position").alias("at"), "original").alias("o"))
    rows = known.where("level > 0").select("thread", "hash", "position", F.lit(0).alias("kind"), "id", "level")
    rows = rows.unionByName(own, allowMissingColumns=True)
    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(tasks, "thread", "hash", "position").withColumn("part", F.spark_partition_id())
    rows = written(rows, "sequences")
    ends = rows.groupBy("thread", "hash", "part").agg(F.max("o").alias("end"))
    before = W.partitionBy("thread", "hash").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.withColumn("carried", F.last("end", ignorenulls=True).over(before)).where("carried is not null")
    carried = written(carried.select(F.col("thread").alias("t"), F.col("hash").alias("h"), F.col("part").alias("p"), "carried"), "carried")
    upto = W.partitionBy("part", "thread", "hash").orderBy("position", "kind").rowsBetween(W.unboundedPreceding, 0)
    met = rows.withColumn("last", F.last("o", ignorenulls=True).over(upto)).where("kind = 0")
    same = met["thread"].eqNullSafe(carried["t"]) & (met["hash"] == carried["h"]) & (met["part"] == carried["p"])
    met = met.join(carried, same, "left").withColumn("last", F.coalesce("last", "carried")).where("last is not null")
    return met.select("id", "level", "last.original", "last.at")


def _answers(parsed: DataFrame) -> DataFrame:
    """(id, reply_to, n_linked): the original that each message quotes."""
    parts = parsed.select("id", "thread", "position", F.explode("quoted").alias("q"))
    parts = parts.select("id", "thread", "position", F.col("q.level").alias("level"), F.col("q.hash").alias("hash"))
    met = _originals(parts)
    votes = met.groupBy("id", "level", "original", "at").agg(F.count("*").alias("votes"))
    # A message has few levels; the nearest level that is linked names its parent.
    best = votes.groupBy("id").agg(
        F.max(F.struct(-F.col("level"), "votes", "at", "original")).alias("best"), F.sum("votes").alias("n_linked")
    )
    return written(best.select("id", F.col("best.original").alias("reply_to"), "n_linked"), "answers")


def _rooted(parsed: DataFrame, answers: DataFrame) -> DataFrame:
    """(id, conversation, depth): chains of answers followed by doubling. Only
    messages that have not come to the first of their chain take another step."""
    rows = parsed.select("id").where(F.col("id").isNotNull()).distinct().join(answers, "id", "left")
    first = F.col("reply_to").isNull()
    depth = F.when(first, 0).otherwise(1).cast("long")
    rows = written(rows.select("id", F.coalesce("reply_to", "id").alias("up"), depth.alias("depth"), first.alias("done")), "chains")
    for _ in range(_MAX_DOUBLINGS):
        open_ = rows.where(~F.col("done"))
        if open_.isEmpty():
            break
        above = rows.select(F.col("id").alias("at"), F.col("up").alias("top"), F.col("depth").alias("more"), F.col("done").alias("ended"))
        step = open_.join(above, F.col("up") == F.col("at"), "left").select(
            "id",
            F.coalesce("top", "up").alias("up"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.coalesce("ended", F.lit(True)).alias("done"),
        )
        rows = written(rows.where("done").unionAll(step), "chains")
    return rows.select("id", F.col("up").alias("conversation"), "depth")


def linked(messages: DataFrame, id_col: str, thread_col: str | None, position_col: str, text_col: str) -> DataFrame:
    """One row per message: id, thread, position, reply_to, conversation (id of
    its first message), depth, own_text without quotes, n_quoted and n_linked
    passages. Sorted by conversation, depth and position, answers follow what
    they answer.

    Passages are looked for in messages of the same thread and of an earlier
    position; without a thread column, in all messages.

    Defined cases: a null text has no passages. A null thread is a thread of its
    own. Of equal originals the latest before the quote is meant, with ties by id. A message
    of a null position neither answers nor is answered. Repeated rows are one
    message and come out as often as they went in. A row without an id keeps its
    text and has no conversation. An empty table gives an empty result. Other
    columns of the input are not read."""
    bounded_batches(messages.sparkSession)
    thread = F.col(thread_col) if thread_col else F.lit(0)
    rows = messages.select(F.col(id_col).alias("id"), thread.alias("thread"), F.col(position_col).alias("position"), F.col(text_col).cast("string").alias("text"))
    parsed = written(_parsed(rows), "messages")
    answers = _answers(parsed)
    rooted = written(_rooted(parsed, answers), "rooted")
    quoted = F.size(F.filter("quoted", lambda q: q["level"] > 0)).cast("long").alias("n_quoted")
    out = parsed.select("id", "thread", "position", "own_text", quoted)
    return out.join(answers, "id", "left").join(rooted, "id", "left").withColumn("n_linked", F.coalesce("n_linked", F.lit(0).cast("long")))
