"""Parity sketches of sets, and the near pairs of a group by them.

A sketch holds for each of its places whether an odd number of the set's
elements fall there by their hash. An element that only one of two sets has
turns one place over, so the sketches differ in no more places than the sets
have such elements: a pair whose sketches differ more is not near, and no near
pair is lost. The number of places follows the set's size and is a power of
two; folding the halves onto each other gives the sketch of half as many."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Places of a sketch for each element, and the least and most places.
PLACES = 4
LEAST, MOST = 256, 2**15

# Rows whose sketches are made or compared at once.
_ROWS = 1_024
_LEFT, _RIGHT = 64, 2_048
# Found pairs leave a tile after so many steps, or a step with so many.
_PARTS, _PAIRS = 256, 10_000


def sketch_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the last column, a list of element hashes, by their sketch."""
    for batch in batches:
        lists = batch.column(batch.num_columns - 1)
        ends, marks = lists.offsets.to_numpy(), lists.values.to_numpy()
        made: list[bytes] = []
        for k in range(0, len(batch), _ROWS):
            cut = ends[k : k + _ROWS + 1]
            sizes = np.diff(cut)
            places = 2 ** np.ceil(np.log2(np.maximum(PLACES * sizes, 1))).astype(np.int64)
            places = np.clip(places, LEAST, MOST)
            starts = np.cumsum(places) - places
            row = np.repeat(np.arange(len(sizes)), sizes)
            at = starts[row] + (marks[cut[0] : cut[-1]] & (places[row] - 1))
            odd = (np.bincount(at, minlength=places.sum()) & 1).astype(np.uint8)
            packed = np.packbits(odd, bitorder="little").tobytes()
            made += [packed[i // 8 : (i + n) // 8] for i, n in zip(starts, places)]
        kept = [batch.column(c) for c in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.binary())], [*batch.schema.names[:-1], "sketch"])


# Rows of one width, smallest set first: their places in the group, their sizes
# and their sketches, one line per 64 places.
_Width = tuple[np.ndarray, np.ndarray, np.ndarray]


def _by_width(rows: np.ndarray, n: np.ndarray, ends: np.ndarray, data: np.ndarray) -> dict[int, _Width]:
    lengths = ends[rows + 1] - ends[rows]
    found = {}
    for length in np.unique(lengths):
        some = rows[lengths == length]
        some = some[np.argsort(n[some], kind="stable")]
        held = np.empty((len(some), length), np.uint8)
        for k in range(0, len(some), _ROWS):
            held[k : k + _ROWS] = data[ends[some[k : k + _ROWS]][:, None] + np.arange(length)]
        found[int(length)] = some, n[some].astype(np.int64), np.ascontiguousarray(held.view(np.uint64).T)
    return found


def _folded(words: np.ndarray, lines: int) -> np.ndarray:
    while len(words) > lines:
        half = len(words) // 2
        words = words[:half] ^ words[half:]
    return words


def _near(left: _Width, right: _Width, same: bool, least: float, share: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs whose sketches differ in at most `share` of both
    sizes. With same, both sides are the same rows, each pair taken once."""
    lines = min(len(left[2]), len(right[2]))
    (rows_l, n_l, _), (rows_r, n_r, _) = left, right
    words_l, words_r = _folded(left[2], lines), _folded(right[2], lines)
    for k in range(0, len(rows_l), _LEFT):
        some_n, some = n_l[k : k + _LEFT], words_l[:, k : k + _LEFT, None]
        low = np.searchsorted(n_r, least * some_n[0] - 1e-6)
        high = np.searchsorted(n_r, some_n[-1] / least + 1e-6, "right")
        for r in range(max(low, k + 1) if same else low, high, _RIGHT):
            end = min(r + _RIGHT, high)
            differ = np.zeros((len(some_n), end - r), np.uint16)
            buffer, counts = np.empty(differ.shape, np.uint64), np.empty(differ.shape, np.uint8)
            for line in range(lines):
                np.bitwise_xor(some[line], words_r[line, r:end], out=buffer)
                differ += np.bitwise_count(buffer, out=counts)
            near = differ <= share * (some_n[:, None] + n_r[r:end]) + 1e-6
            if same and r < k + _LEFT:
                near &= np.arange(r, end) > np.arange(k, k + len(some_n))[:, None]
            i, j = np.nonzero(near)
            if len(i):
                yield rows_l[k + i], rows_r[r + j]


def near_pairs(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """(a, b) of a tile (set_id, n, side, sketch) that may lie below a Jaccard
    distance. Rows of side 0 meet those of side 1; a tile with one side only
    holds all rows of its group, each pair of which meets once."""
    s = 1 - threshold
    share = (1 - s) / (1 + s)
    table = pa.Table.from_batches(batches)
    ids, n, side = table.column("set_id").combine_chunks(), table.column("n").to_numpy(), table.column("side").to_numpy()
    sketch = table.column("sketch").cast(pa.large_binary()).combine_chunks()
    ends = np.frombuffer(sketch.buffers()[1], np.int64)[sketch.offset : sketch.offset + len(sketch) + 1]
    data = np.frombuffer(sketch.buffers()[2], np.uint8)
    left = _by_width(np.flatnonzero(side == 0), n, ends, data)
    one = not (side == 1).any()
    right = left if one else _by_width(np.flatnonzero(side == 1), n, ends, data)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def batch() -> pa.RecordBatch:
        a, b = (ids.take(pa.array(np.concatenate(x))) for x in zip(*found))
        found.clear()
        return pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    for p in left:
        for q in right:
            if one and p > q:
                continue
            for pairs in _near(left[p], right[q], one and p == q, s, share):
                found.append(pairs)
                if len(found) >= _PARTS or len(pairs[0]) >= _PAIRS:
                    yield batch()
    if found:
        yield batch()
