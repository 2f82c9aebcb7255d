"""Content-defined cutting of token sequences into runs of windows.

Each window of ``width`` consecutive tokens has an anchor: the gram of
``gram`` tokens inside it with the least hash, the leftmost on ties. The
anchor depends on nothing but the window, so equal windows, wherever they
stand, have equal anchors at the same place inside them. Windows that follow
one another mostly share their anchor; such a run travels as one record, and
all windows equal to one another meet under their anchor's hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tokens in one numpy batch; a longer document is cut into pieces that
#: overlap by a window less one token, so no window is lost.
BATCH_TOKENS = 1 << 21
#: Positions inside a batch fit these bits.
_PLACE = np.uint64((1 << 24) - 1)
#: Anchors a task gathers before it passes on what it counted.
SKETCH_ANCHORS = 2_000_000
#: A hash is hot if it is more than this share of all counted (so there are at
#: most ``1 / HOT_SHARE`` in each row of a sketch), and more than ``HOT_LEAST``.
HOT_SHARE = 1e-5
HOT_LEAST = 256
#: Cells in one shard of a sketch.
SHARD_CELLS = 1 << 22
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    n, span, out = len(values) - width + 1, 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return out if span == width else np.minimum(out[:n], out[width - span : width - span + n])


def window_runs(grams: np.ndarray, ends: np.ndarray, width: int, gram: int):
    """``(start, count, hash)`` of each run: its first window, how many
    windows follow one another, and their anchor's hash.

    ``grams[i]`` is the hash of the gram at token ``i`` of the concatenated
    documents, ``ends`` the token after each document's last.
    """
    windows = len(grams) + gram - width
    none = np.empty(0, np.int64)
    if windows <= 0:
        return none, none, np.empty(0, np.uint64)
    keyed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(keyed, width - gram + 1)
    inside = np.ones(windows + width, bool)
    for k in range(1, width):  # the last width - 1 tokens of a document start no window
        cut = ends - k
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    starts = np.flatnonzero(inside[:windows])
    if not len(starts):
        return none, none, np.empty(0, np.uint64)
    anchor = (least[starts] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(starts) != 1)])
    return starts[first], np.diff(np.r_[first, len(starts)]), grams[anchor[first]]


def pieces(tokens: Iterable, width: int, most: int = BATCH_TOKENS) -> Iterator[list[tuple[int, int, object]]]:
    """Batches of ``(document, offset, tokens)`` of at most ``most`` tokens;
    ``tokens`` yields one sliceable sequence per document."""
    batch, size = [], 0
    for i, own in enumerate(tokens):
        at = 0
        while True:
            part = own[at : at + most] if at or len(own) > most else own
            if size and size + len(part) > most:
                yield batch
                batch, size = [], 0
            batch.append((i, at, part))
            size += len(part)
            if at + most >= len(own):
                break
            at += most - width + 1
    if batch:
        yield batch


def expected_anchors(tokens: int, width: int, gram: int) -> int:
    return 2 * tokens // (width - gram + 2)


def sketch_width(expected: int, max_cells: int) -> int:
    """Cells to count ``expected`` hashes with: four for each, a power of two
    between one shard and ``max_cells``."""
    return max(SHARD_CELLS, min(max_cells, 1 << math.ceil(math.log2(max(1.0, 4 * expected)))))


def cells_of(hashes: np.ndarray, row: int, cells: int) -> np.ndarray:
    """The cell of each hash in one row of the sketch."""
    salt = np.uint64((0xD6E8FEB86659FD93 * (2 * row + 1)) & (2**64 - 1))
    return (mixed(hashes ^ salt) >> np.uint64(64 - int(math.log2(cells)))).astype(np.int64)


def count_sketch(
    docs: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], expected: int, max_cells: int, rows: int = 2
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A count-min sketch of all ``hashes`` (about ``expected``), as one bit
    per cell: counted twice or more; and per row the hot cells, in order.
    Every partition counts its own hashes (sparse: the cells it touched, with
    their counts up to 255), shards of cells are merged by adding, and only
    the bits and the hot cells come back: ``rows * cells / 8`` bytes and at most
    ``1 / HOT_SHARE`` cells a row, whatever the input's size. Bits are never
    too few: a hash that occurs twice always has its bits set. (Hot cells
    only decide where windows meet; counts cut at 255 may miss some.)
    """
    cells = sketch_width(expected, max_cells)
    shards, limit = cells // SHARD_CELLS, max(HOT_LEAST, int(expected * HOT_SHARE))

    def partition_sketch(batches):
        pack = zstandard.ZstdCompressor(level=1)
        held: list[list[np.ndarray]] = [[] for _ in range(rows)]
        kept = 0

        def flush():
            for row in range(rows):
                cell, count = np.unique(np.concatenate(held[row]), return_counts=True)
                held[row].clear()
                count = np.minimum(count, 255).astype(np.uint8)
                cut = np.searchsorted(cell, np.arange(shards + 1) * SHARD_CELLS)
                for s in range(shards):
                    if cut[s] < cut[s + 1]:
                        low = (cell[cut[s] : cut[s + 1]] % SHARD_CELLS).astype(np.uint32)
                        steps = np.diff(low, prepend=np.uint32(0)).tobytes()
                        yield row * shards + s, pack.compress(steps + count[cut[s] : cut[s + 1]].tobytes())

        for batch in batches:
            for own in hashes(batch):
                for row in range(rows):
                    held[row].append(cells_of(own, row, cells))
                kept += len(own)
                if kept > SKETCH_ANCHORS:
                    yield _blobs(flush())
                    kept = 0
        if kept:
            yield _blobs(flush())

    def merge(batches):
        counts: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob"), strict=True):
                count = counts.setdefault(bucket, np.zeros(SHARD_CELLS, np.uint32))
                raw = unpack.decompress(blob.as_py())
                n = len(raw) // 5
                cell = np.cumsum(np.frombuffer(raw, np.uint32, n), dtype=np.uint32)  # each cell once
                count[cell] += np.frombuffer(raw, np.uint8, n, 4 * n)
        for bucket, count in counts.items():
            crowded = np.flatnonzero(count > limit).astype("<u4").tobytes()
            yield _blobs([(bucket, np.packbits(count > 1).tobytes() + crowded)])

    schema = "bucket int, blob binary"
    merged = docs.mapInArrow(partition_sketch, schema).repartition(rows * shards, "bucket").mapInArrow(merge, schema)
    bits = [np.zeros(cells // 8, np.uint8) for _ in range(rows)]
    hot: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in range(rows)]
    size = SHARD_CELLS // 8
    for shard in merged.toLocalIterator():
        row, s = divmod(shard["bucket"], shards)
        bits[row][s * size : (s + 1) * size] = np.frombuffer(shard["blob"], np.uint8, size)
        hot[row].append(np.frombuffer(shard["blob"], "<u4", -1, size).astype(np.int64) + s * SHARD_CELLS)
    return bits, [np.sort(np.concatenate(own)) for own in hot]


def _blobs(rows) -> pa.RecordBatch:
    buckets, blobs = [], []
    for bucket, blob in rows:
        buckets.append(bucket)
        blobs.append(blob)
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int32()), pa.array(blobs, pa.binary())], ["bucket", "blob"]
    )


def maybe_repeated(bits: list[np.ndarray], hashes: np.ndarray) -> np.ndarray:
    """Whether the sketch estimates each hash as counted twice or more."""
    cells = len(bits[0]) * 8
    out = np.ones(len(hashes), bool)
    for row, own in enumerate(bits):
        cell = cells_of(hashes, row, cells)
        out &= (own[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
    return out


def is_hot(hot: list[np.ndarray], cells: int, hashes: np.ndarray) -> np.ndarray:
    """Whether the sketch of ``cells`` cells a row counted each hash as hot."""
    out = np.ones(len(hashes), bool)
    for row, own in enumerate(hot):
        if not len(own):
            return np.zeros(len(hashes), bool)
        cell = cells_of(hashes, row, cells)
        out &= own[np.minimum(np.searchsorted(own, cell), len(own) - 1)] == cell
    return out


def text_size(docs: DataFrame) -> tuple[int, int]:
    """Rows and UTF-8 bytes of ``keyed_text``'s output."""
    row = docs.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    return row["n"], row["b"] or 0


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``keyed_text`` rows with ``spans``: the packed spans (start in the
    high bits, end in the low 31) of each document, NULL without any."""
    per_doc = spans.groupBy("id", "th").agg(F.collect_list("span").alias("spans"))
    return docs.join(per_doc, ["id", "th"], "left")


def packed(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (starts.astype(np.int64) << 31) | ends.astype(np.int64)


def merged_spans(spans) -> list[tuple[int, int]]:
    """Packed spans as disjoint, non-touching ``(start, end)`` in order."""
    if spans is None or not len(spans):
        return []
    own = np.sort(np.asarray(spans, np.int64))
    start, end = own >> 31, np.maximum.accumulate(own & ((1 << 31) - 1))
    first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    last = np.r_[first[1:], len(own)] - 1
    return list(zip(start[first].tolist(), end[last].tolist(), strict=True))
