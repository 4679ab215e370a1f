"""Mixing sources to target weights by a temperature.

A source's weight is its share of tokens to the power of an exponent between 0
(all sources alike) and 1 (as they are). The exponent is found by bisection,
with many sections a round, on the table of sources. The weights times a budget
are each source's quota, which is realised epoch by epoch: a source's documents
lie in blocks, every epoch permutes the blocks and the documents in them, and
draws until the quota is used up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfscore.llm.storage import SPACE, written

# Tokens that a block should hold.
BLOCK_TOKENS = 1 << 18
_SECTIONS = 32
_ROUNDS = 6


def word_tokens(text: Column) -> Column:
    """Words of a text and one for its end; null counts as empty."""
    known = F.coalesce(text, F.lit(""))
    return (F.size(F.filter(F.split(known, SPACE), lambda w: w != "")) + 1).cast("long")


def _weighted(sources: DataFrame, exponent: Column, *by: str) -> DataFrame:
    """Adds weight: the normalised power of each source's share."""
    raised = sources.withColumn("raised", F.exp(exponent * F.log("share")))
    total = written(raised.groupBy(*by).agg(F.sum("raised").alias("total")), "totals") if by else None
    if total is None:
        return raised.withColumn("weight", F.col("raised") / raised.agg(F.sum("raised").alias("t")).scalar())
    return raised.join(F.broadcast(total), list(by)).withColumn("weight", F.col("raised") / F.col("total"))


def shares(rows: DataFrame) -> DataFrame:
    """(source, tokens, share) of rows (source, tokens)."""
    sums = written(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "sources")
    return sums.withColumn("share", F.col("tokens") / sums.agg(F.sum("tokens").alias("t")).scalar())


def find_exponent(
    sources: DataFrame, budget: float | None, target_entropy: float | None, max_repeats: float | None
) -> float:
    """The smallest exponent in [0, 1] that is allowed.

    target_entropy (nats): entropy falls as the exponent grows, so the exponent
    is the one that meets it. max_repeats: repetition of the most repeated
    source falls as well, so it is the first at which no source is drawn more
    often. With both, the larger exponent holds. Without a budget the repetition
    is counted at the budget that draws every document at least once."""
    low = [0.0, 0.0]
    high = [1.0, 1.0]
    for _ in range(_ROUNDS):
        grid = [[low[k] + (high[k] - low[k]) * i / _SECTIONS for i in range(_SECTIONS + 1)] for k in (0, 1)]
        points = F.array(*[F.lit(x) for x in sorted({*grid[0], *grid[1]})])
        tried = _weighted(sources.withColumn("exponent", F.explode(points)), F.col("exponent"), "exponent")
        repeats = F.max(F.col("weight") / F.col("tokens")) * (
            F.lit(float(budget)) if budget is not None else F.max(F.col("tokens") / F.col("weight"))
        )
        entropy = -F.sum(F.col("weight") * F.log("weight"))
        # One row per tried exponent.
        at = tried.groupBy("exponent").agg(entropy.alias("entropy"), repeats.alias("repeats")).orderBy("exponent").collect()
        for k, holds in (
            (0, lambda r: target_entropy is None or r["entropy"] <= target_entropy + 1e-12),
            (1, lambda r: max_repeats is None or r["repeats"] <= max_repeats + 1e-9),
        ):
            fits = [r["exponent"] for r in at if low[k] <= r["exponent"] <= high[k] and holds(r)]
            high[k] = min(fits, default=high[k])
            low[k] = max([r["exponent"] for r in at if low[k] <= r["exponent"] < high[k]], default=low[k])
    return max(high)


def mixture(
    rows: DataFrame, budget: float | None, target_entropy: float | None = None, max_repeats: float | None = None
) -> DataFrame:
    """(source, tokens, share, weight, quota): the target of each source.

    Without a budget the quotas draw every document at least once."""
    sources = shares(rows)
    if sources.isEmpty():
        return sources.select("source", "tokens", "share", F.lit(0.0).alias("weight"), F.lit(0.0).alias("quota"))
    exponent = find_exponent(sources, budget, target_entropy, max_repeats)
    weights = _weighted(sources, F.lit(exponent)).drop("raised")
    size = F.lit(float(budget)) if budget is not None else weights.agg(F.max(F.col("tokens") / F.col("weight")).alias("b")).scalar()
    return written(weights.withColumn("quota", F.col("weight") * size).withColumn("exponent", F.lit(exponent)), "mixture")


def _in_blocks(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Adds mix_block; a source's blocks are filled by a hash of the key."""
    counts = plan.select(F.col("mix_source").alias("mix_s"), F.col("blocks").alias("mix_blocks"))
    placed = rows.join(counts, rows["mix_source"].eqNullSafe(counts["mix_s"])).drop("mix_s")
    return placed.withColumn("mix_block", F.pmod(F.xxhash64(F.lit(seed), "mix_key"), F.col("mix_blocks"))).drop("mix_blocks")


def draw(
    docs: DataFrame, sizes: DataFrame, targets: DataFrame, seed: int = 7, block_tokens: int = BLOCK_TOKENS
) -> DataFrame:
    """docs (with mix_source, mix_tokens, mix_key) once per draw. sizes has
    these three columns of the same rows.

    Adds mix_epoch, mix_block and mix_slot: a place in (0, 1) of the mixed
    stream at which the draw belongs. The last document of a quota is drawn
    whole, so a source exceeds its quota by less than one document."""
    plan = targets.select(
        F.col("source").alias("mix_source"),
        "quota",
        F.col("tokens").alias("source_tokens"),
        F.ceil(F.col("tokens") / block_tokens).cast("long").alias("blocks"),
    )
    # One row per source: the join spreads it or broadcasts it by its size.
    plan = written(plan, "plan")
    placed = _in_blocks(docs, plan, seed)
    blocks = _in_blocks(sizes, plan, seed).groupBy("mix_source", "mix_block").agg(F.sum("mix_tokens").alias("block_tokens"))
    facts = plan.withColumnRenamed("mix_source", "s")
    blocks = blocks.join(facts, blocks["mix_source"].eqNullSafe(facts["s"])).drop("s")
    last = F.greatest(F.ceil(F.col("quota") / F.col("source_tokens") - F.lit(1e-9)), F.lit(1)).cast("int") - 1
    epochs = blocks.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), last)))
    # Blocks of one source and epoch, some bytes for each block of tokens.
    order = W.partitionBy("mix_source", "mix_epoch").orderBy(F.xxhash64(F.lit(seed), "mix_epoch", "mix_block"), "mix_block")
    epochs = epochs.withColumn("rank", F.row_number().over(order)).withColumn(
        "before", F.sum("block_tokens").over(order.rowsBetween(W.unboundedPreceding, -1))
    )
    left = F.col("quota") - F.col("mix_epoch") * F.col("source_tokens") - F.coalesce("before", F.lit(0))
    drawn = epochs.withColumn("left", left).where(F.col("left") > 1e-6)
    rounds = F.col("quota") / F.col("source_tokens")
    part = (F.col("mix_epoch") + F.col("rank") / (F.col("blocks") + 1)) / F.ceil(rounds)
    drawn = drawn.select(
        F.col("mix_source").alias("mix_s"),
        F.col("mix_block").alias("mix_k"),
        "mix_epoch",
        part.alias("mix_slot"),
        F.when(F.col("left") < F.col("block_tokens"), F.col("left")).alias("mix_left"),
    )
    drawn = written(drawn, "draws")
    same = placed["mix_source"].eqNullSafe(drawn["mix_s"]) & (placed["mix_block"] == drawn["mix_k"])
    out = placed.join(drawn.hint("merge"), same).drop("mix_s", "mix_k")
    whole = out.where(F.col("mix_left").isNull())
    # The one block of each source at which its quota ends.
    inner = W.partitionBy("mix_source", "mix_block").orderBy(F.xxhash64(F.lit(seed), "mix_epoch", "mix_key"), "mix_key")
    before = F.coalesce(F.sum("mix_tokens").over(inner.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = out.where(F.col("mix_left").isNotNull()).withColumn("mix_before", before)
    cut = cut.where(F.col("mix_before") < F.col("mix_left")).drop("mix_before")
    return whole.unionByName(cut).drop("mix_left")


def temperature_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    tokens: Column | None = None,
    budget: float | None = None,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    seed: int = 7,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """All columns of docs, one row per draw, and mix_epoch, mix_block,
    mix_slot, mix_source, mix_tokens, mix_key.

    Defined cases: a null source is a source. Every document has one token at
    least, so empty texts are drawn as well. Repeated rows are drawn together,
    each as a row of its own. A null id is a key like any other. An empty table
    gives an empty result. Columns that begin with mix_ are replaced."""
    plain = docs.drop(*[c for c in docs.columns if c.startswith("mix_")])
    size = tokens if tokens is not None else word_tokens(F.col("text"))
    keyed = plain.withColumns(
        {"mix_source": F.col(source_col), "mix_tokens": size, "mix_key": F.coalesce(F.xxhash64(id_col), F.lit(0))}
    )
    sizes = written(keyed.select("mix_source", "mix_tokens", "mix_key"), "sizes")
    rows = sizes.select(F.col("mix_source").alias("source"), F.col("mix_tokens").alias("tokens"))
    return draw(keyed, sizes, mixture(rows, budget, target_entropy, max_repeats), seed, block_tokens)
