"""Toxicity by a factorization machine over hashed terms.

A document's terms are its words and their beginnings, as 64-bit hashes. Each
term has a weight of its own and a short vector; two terms that occur together
add the product of their vectors, so an insult next to the mention of a group
can weigh more than the two do apart. The model is trained on a bounded sample
of labelled rows; scoring reads every whole text where it lies."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscore.llm.hashing import LOWER, mix, span_hashes, word_spans
from shelfscore.llm.storage import bounded_batches, written

# Labelled rows that the model is fitted on at most, toxic and other.
TOXIC_ROWS = 6_000
OTHER_ROWS = 14_000
# Terms in the model: those that tell the labels apart best in the sample.
# How many, and how many passes, is chosen on an inner fold of the training
# rows among these sizes and up to EPOCHS passes; the held-out fold is never
# looked at.
TERMS = 16_384
TERM_CHOICES = (64, 128, 256, 512, 1_024, 2_048, 4_096, 8_192, 16_384)
FACTORS = 6
EPOCHS = 12
FOLDS = 5
# One training row in INNER_FOLDS, by a hash of its id, judges the choices.
INNER_FOLDS = 4

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BEGINNINGS = (4, 5, 6)


def terms(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the words of a text and of their beginnings."""
    data = LOWER[np.frombuffer(text or b"", dtype=np.uint8)]
    starts, ends = word_spans(data, _LETTER)
    found = [span_hashes(data, starts, ends)]
    for n in _BEGINNINGS:
        longer = ends - starts >= n
        found.append(mix(span_hashes(data, starts[longer], starts[longer] + n) + np.uint64(n)))
    return np.unique(np.concatenate(found))


@dataclass
class Machine:
    """bias, and per known term (sorted hash) a weight and a vector."""

    bias: float
    known: np.ndarray
    weight: np.ndarray
    vectors: np.ndarray

    def places(self, found: np.ndarray) -> np.ndarray:
        """Which known terms a document has."""
        at = np.searchsorted(self.known, found)
        at[at == len(self.known)] = 0
        return at[self.known[at] == found] if len(self.known) else at[:0]

    def score(self, found: np.ndarray) -> float:
        at = self.places(found)
        v = self.vectors[at]
        pairs = 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        z = self.bias + float(self.weight[at].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(z, -35, 35))))


def _telling(docs: list[np.ndarray], toxic: np.ndarray, terms: int = TERMS) -> np.ndarray:
    """The terms with the largest chi-square statistic against the label."""
    known, counts = np.unique(np.concatenate(docs), return_counts=True)
    known, counts = known[counts >= 3], counts[counts >= 3]
    if not len(known):
        return known
    hits = np.zeros(len(known))
    for found in (d for d, t in zip(docs, toxic, strict=True) if t):
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        hits[at[known[at] == found]] += 1
    rate = max(toxic.mean(), 1e-9)
    chi = (hits - counts * rate) ** 2 / (counts * rate * (1 - rate) + 1e-9)
    best = np.lexsort((known, -chi))[:terms]
    return np.sort(known[best])


def fit(
    docs: list[np.ndarray],
    toxic: np.ndarray,
    row_weight: np.ndarray,
    seed: int = 5,
    terms: int = TERMS,
    epochs: int = EPOCHS,
    after_epoch=None,
) -> Machine:
    """Logistic loss, small batches, step sizes adapted to each parameter.
    after_epoch(machine, epoch) is called after each pass."""
    rng = np.random.default_rng(seed)
    rate = (float(toxic @ row_weight) + 0.5) / (float(row_weight.sum()) + 2)
    bias = float(np.log(rate / (1 - rate)))
    if not len(docs) or toxic.min() == toxic.max():
        return Machine(bias, np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, FACTORS)))
    known = _telling(docs, toxic, terms)
    machine = Machine(bias, known, np.zeros(len(known)), rng.normal(0, 0.01, (len(known), FACTORS)))
    places = [machine.places(d) for d in docs]
    slow = [np.zeros_like(machine.weight), np.zeros_like(machine.vectors)]
    fast = [np.zeros_like(machine.weight), np.zeros_like(machine.vectors)]
    step = 0
    for epoch in range(1, epochs + 1):
        order = rng.permutation(len(docs))
        for k in range(0, len(order), 256):
            rows = order[k : k + 256]
            sizes = np.array([len(places[r]) for r in rows])
            at = np.concatenate([places[r] for r in rows])
            of = np.repeat(np.arange(len(rows)), sizes)
            v = machine.vectors[at]
            total = np.stack([np.bincount(of, v[:, f], len(rows)) for f in range(FACTORS)], axis=1)
            squares = np.bincount(of, (v**2).sum(axis=1), len(rows))
            z = machine.bias + np.bincount(of, machine.weight[at], len(rows)) + 0.5 * ((total**2).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(z, -35, 35))) - toxic[rows]) * row_weight[rows] / len(rows)
            pull = error[of][:, None] * (total[of] - v)
            seen = np.bincount(at, minlength=len(known)) > 0
            grads = [
                np.bincount(at, error[of], len(known)) + 1e-4 * machine.weight * seen / 10,
                np.stack([np.bincount(at, pull[:, f], len(known)) for f in range(FACTORS)], axis=1)
                + 1e-3 * machine.vectors * seen[:, None] / 10,
            ]
            step += 1
            for parameter, grad, m, s in zip((machine.weight, machine.vectors), grads, slow, fast, strict=True):
                m += 0.1 * (grad - m)
                s += 0.001 * (grad**2 - s)
                size = 0.02 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                parameter -= size * m / (np.sqrt(s) + 1e-8)
            machine.bias -= 0.05 * float(error.sum())
        if after_epoch is not None:
            after_epoch(machine, epoch)
    return machine


def _loss(machine: Machine, docs: list[np.ndarray], toxic: np.ndarray, row_weight: np.ndarray) -> tuple[float, float]:
    """Weighted share of wrong verdicts at 0.5, as the scores are used there,
    then weighted log loss."""
    p = np.clip(np.array([machine.score(d) for d in docs]), 1e-9, 1 - 1e-9)
    total = max(row_weight.sum(), 1e-9)
    wrong = float((row_weight * ((p >= 0.5) != (toxic == 1))).sum() / total)
    return wrong, float(-(row_weight * (toxic * np.log(p) + (1 - toxic) * np.log(1 - p))).sum() / total)


def chosen_fit(docs: list[np.ndarray], toxic: np.ndarray, row_weight: np.ndarray, inner: np.ndarray) -> tuple[Machine, int, int]:
    """The machine refitted on all training rows with the number of terms and
    passes of fewest weighted wrong verdicts (then least log loss) on the inner
    fold (rows where inner is true), fitted on the rest. Ties go to fewer terms and passes. Without both
    labels in both parts the largest allowed choice is taken."""
    allowed = list(TERM_CHOICES)
    learn_on, judge_on = np.flatnonzero(~inner), np.flatnonzero(inner)
    both = lambda at: len(at) and 0 < toxic[at].sum() < len(at)
    if not (both(learn_on) and both(judge_on)):
        return fit(docs, toxic, row_weight, terms=allowed[-1]), allowed[-1], EPOCHS
    judged = [docs[k] for k in judge_on]
    losses: dict[tuple[int, int], tuple[float, float]] = {}
    for terms in allowed:

        def judge(machine: Machine, epoch: int, terms: int = terms) -> None:
            losses[(terms, epoch)] = _loss(machine, judged, toxic[judge_on], row_weight[judge_on])

        fit([docs[k] for k in learn_on], toxic[learn_on], row_weight[learn_on], terms=terms, after_epoch=judge)
    terms, epochs = min(losses, key=lambda key: (losses[key], key))
    return fit(docs, toxic, row_weight, terms=terms, epochs=epochs), terms, epochs


def held_out(id_col: str) -> Column:
    """Rows of one fold in FOLDS by the id's text; their labels are not learnt."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> Machine:
    """A model from the labelled rows outside the held-out fold. Repeated
    labels of a row count as toxic if one of them says so."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = written(known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y")), "labels")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("id"), F.col("id")]
    toxic = known.where("y = 1").orderBy(*order).limit(TOXIC_ROWS)
    other = known.where("y = 0").orderBy(*order).limit(OTHER_ROWS)
    # Bounded by the two limits above.
    sample = F.broadcast(written(toxic.unionAll(other), "sample"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(sample, "id")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [terms(t).view(np.int64) for t in batch["text"].cast(pa.binary()).to_pylist()]
            columns = [batch["id"], batch["y"], pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "y", "terms"])

    def train(table: pa.Table) -> pa.Table:
        # Views of the arrow buffers: terms are not made objects one by one.
        table = table.take(pc.sort_indices(table, [("id", "ascending")])).combine_chunks()
        column = table["terms"].chunk(0)
        ends, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
        lists = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        y = table["y"].to_numpy().astype(np.float64)
        drawn = {1: max(1, int(y.sum())), 0: max(1, int((1 - y).sum()))}
        scale = {k: counts.get(k, 0) / drawn[k] for k in drawn}
        weight = np.where(y == 1, scale[1], scale[0]).astype(np.float64)
        ids = table["id"].cast(pa.string()).to_pylist()
        inner = np.array([zlib.crc32(f"inner:{i}".encode()) % INNER_FOLDS == 0 for i in ids], dtype=bool)
        m, _, _ = chosen_fit(lists, y, weight / max(weight.mean(), 1e-9), inner)
        return pa.table({"bias": [m.bias], "known": [m.known.tobytes()], "weight": [m.weight.tobytes()], "vectors": [m.vectors.tobytes()]})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = texts.mapInArrow(found, f"id {kind}, y int, terms array<bigint>").groupBy(F.lit(0).alias("all"))
    model = rows.applyInArrow(train, "bias double, known binary, weight binary, vectors binary").first()
    if model is None:
        return fit([], np.zeros(0), np.zeros(0))
    weight = np.frombuffer(model["weight"], np.float64)
    vectors = np.frombuffer(model["vectors"], np.float64).reshape(len(weight), FACTORS)
    return Machine(model["bias"], np.frombuffer(model["known"], np.uint64), weight, vectors)


def scored(docs: DataFrame, machine: Machine, text_col: str = "text") -> DataFrame:
    """docs with a column toxic_score; any column of that name is replaced."""
    kept = docs.drop("toxic_score")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [machine.score(terms(t)) for t in batch[text_col].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "toxic_score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(score, f"{fields}, toxic_score double")


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """All columns of docs and toxic_score between 0 and 1.

    Defined cases: an empty or null text has the score of the bias alone, which
    is the share of toxic rows in training. Without labels of both kinds every
    document has that score. Null labels and labels of a null id are not read.
    Repeated rows get equal scores. An empty table gives an empty result."""
    bounded_batches(docs.sparkSession)
    return scored(docs, learn(docs, labels, id_col, text_col, label_col), text_col)
