"""Tokenising and best-fit-decreasing packing into sequences of fixed length.

Pieces are dealt to blocks of a bounded number by a hash of their document, and
each block is packed by itself, longest piece first. A segment tree over the
remaining capacities says which open sequence is the tightest fit, in a number
of steps that is the logarithm of the sequence length. Full pieces are whole
sequences and need no search. A block leaves at most its last sequences loose,
so blocks cost one part in some thousands."""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscore.llm.storage import bounded_batches, written

LENGTH = 4096
END_ID = 1
# Pieces that one packing task should take.
BLOCK_PIECES = 16_384
# Words, and as many pre-tokens, whose ids a worker keeps.
CACHE_PIECES = 400_000

_PIECES = "doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Pieces(dict):
    """Ids of pre-tokens, encoded when they are first met."""

    def __init__(self, tokenizer) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        self.model = tokenizer.model
        self.letters = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def __missing__(self, piece: str) -> bytes:
        shown = piece if piece.isascii() and piece.isprintable() else "".join(t for t, _ in self.letters(piece))
        ids = self[piece] = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids


class _Words(dict):
    """Ids of words between white space."""

    def __init__(self, pieces: _Pieces, cut: re.Pattern) -> None:
        self.pieces, self.cut = pieces, cut.findall

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = b"".join(map(self.pieces.__getitem__, self.cut(word)))
        return ids


class WordEncoder:
    """Token ids of a text by a tokenizer that encodes each pre-token apart.

    No pre-token holds white space, so texts in plain Latin letters are split at
    it and each distinct word and pre-token is encoded once; any other text goes
    through the tokenizer as a whole. Both ways give the same ids."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Letters whose lower case and composed form is one letter by any rule.
        plain = [chr(c) for c in range(0x180) if 9 <= c <= 13 or 32 <= c < 127 or (c > 0xA0 and c != 0x130)]
        letters = re.escape("".join(c for c in plain if unicodedata.category(c)[0] == "L"))
        digits = re.escape("".join(c for c in plain if unicodedata.category(c)[0] == "N"))
        self.other = re.compile("[^" + re.escape("".join(plain)) + "]|<\\|")
        # Fixed value: the pre-token pattern of this vocabulary, on plain letters.
        cut = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\s{letters}{digits}]+")
        self.pieces = _Pieces(self.tokenizer)
        self.words = _Words(self.pieces, cut)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for known in (self.words, self.pieces):
            if len(known) > CACHE_PIECES:
                known.clear()
        find = self.words.__getitem__
        return [self._whole(t) if self.other.search(t) else b"".join(map(find, t.lower().split())) for t in texts]

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids and the end
    id, cut into pieces of at most `length`."""
    end = array("I", [END_ID]).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordEncoder(tokenizer)
        for batch in batches:
            texts, rows = [t or "" for t in batch["text"].to_pylist()], []
            of, wide = batch["id"].to_pylist(), 4 * length
            for k in range(0, len(texts), 64):
                for doc, ids in zip(of[k : k + 64], encode(texts[k : k + 64]), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), wide)):
                        part = ids[at : at + wide]
                        rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [batch["id"].type, pa.int32(), *[pa.int64()] * 3], strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(cut, _PIECES.format(kind=kind))


class Capacities:
    """Open sequences by remaining capacity, under a segment tree that knows
    in which halves of the capacity range any are open."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        node = capacity + self.leaves
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove an open sequence of the smallest capacity of at least `least`."""
        tree, node = self.tree, least + self.leaves
        if not tree[node]:
            # Up to the first branch whose larger half has an open sequence.
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        while node:
            tree[node] -= 1
            node >>= 1
        return capacity, self.open[capacity].pop()


def best_fit(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each piece and the number of sequences. Equal
    lengths keep their order."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    spaces, used = Capacities(length), 0
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        found = spaces.take(need) if need < length else None
        if found is None:
            capacity, at, used = length, used, used + 1
        else:
            capacity, at = found
        sequence[k], offset[k] = at, length - capacity
        if capacity > need:
            spaces.add(capacity - need, at)
    return sequence, offset, used


def pack(pieces: DataFrame, length: int = LENGTH, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """Adds sequence_id and offset. Equal rows are packed apart from each other."""
    blocks = max(1, -(-pieces.count() // block_pieces))

    def fill(table: pa.Table) -> pa.Table:
        order = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("start", "ascending")]
        table = table.sort_by(order)
        sequence, offset, _ = best_fit(table["length"].to_numpy(), length)
        ids = sequence + (table["block"][0].as_py() << 40)
        return table.drop_columns(["block"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(blocks)).cast("long"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    packed = keyed.groupBy("block").applyInArrow(fill, f"{fields}, sequence_id bigint, offset bigint")
    return packed


def best_fit_packing(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset.

    Defined cases: a null or empty text is the end id alone. Repeated rows are
    packed as often as they occur. A null id is carried along. An empty table
    gives an empty result. Other columns of the input are not read."""
    bounded_batches(docs.sparkSession)
    return pack(written(token_pieces(docs, tokenizer, id_col, text_col, length), "pieces"), length, block_pieces)
