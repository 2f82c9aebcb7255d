"""Substring dedup over bytes, by the common-prefix interval tree of an
enhanced suffix array.

Windows of ``width`` bytes meet by content: each run of windows that share an
anchor (see ``anchors``) travels as one segment of text to its anchor's
bucket, so a bucket holds every occurrence of its windows. Anchors that a
merged sketch counts once in the whole corpus are left out. Each bucket sorts
the suffixes of its segments, takes the common prefix of neighbours, and one
scan with a stack walks the tree of common-prefix intervals. An interval
whose occurrences are preceded by different bytes is a maximal repeat group;
it is delivered with all its occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.anchors import (
    count_sketch,
    expected_anchors,
    maybe_repeated,
    merged_spans,
    mixed,
    packed,
    pieces,
    text_size,
    window_runs,
    with_spans,
)
from ferryline.llm.common import keyed_text, restored_id

#: The sketch's two rows take at most twice this many bits (128 MB in all).
MAX_CELLS = 1 << 29
#: Text bytes whose segments one bucket gets, on average, before the sketch
#: takes out those that occur once.
BUCKET_BYTES = 6 << 20
#: Long enough that equal grams by chance are rare, short enough that a window
#: holds many grams to choose its anchor from.
_GRAM = 24


def _grams(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` (8 or more) bytes at each place."""
    n = len(data) - gram + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,))
    out = np.zeros(n, np.uint64)
    for k in (*range(0, gram - 8, 8), gram - 8):
        out = mixed(out ^ eight[k : k + n])
    return out


def _batches(texts: Iterable[str], width: int):
    """``(owner, offset, ends, bytes)`` per batch of pieces."""
    for batch in pieces((t.encode("utf-8", "surrogatepass") for t in texts), width):
        owner = np.array([i for i, _, _ in batch], np.int64)
        offset = np.array([at for _, at, _ in batch], np.int64)
        ends = np.cumsum([len(b) for _, _, b in batch])
        yield owner, offset, ends, np.frombuffer(b"".join(b for _, _, b in batch), np.uint8)


def _gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of all stretches, one after the other."""
    shift = start - np.r_[0, np.cumsum(length)[:-1]]
    return data[np.repeat(shift, length) + np.arange(length.sum())]


def _padded(data: np.ndarray, start: np.ndarray, length: np.ndarray, most: int) -> np.ndarray:
    """Stretches as rows of big-endian words, zero beyond their length."""
    most = -(-most // 8) * 8
    column = np.arange(most)
    place = start[:, None] + column
    rows = data[np.minimum(place, len(data) - 1)]
    rows[column >= length[:, None]] = 0
    return rows


def _first_equal(rows: np.ndarray, length: np.ndarray, rank: np.ndarray):
    """An order that puts rows of equal content together, by ``rank``; and
    where each new content begins. (Ordered by hash and told apart by
    content: two contents of one hash would only come in more groups.)"""
    words = rows.view("<u8")
    hashed = length.astype(np.uint64)
    for k in range(words.shape[1]):
        hashed = mixed(hashed ^ words[:, k])
    order = np.lexsort((rank, hashed))
    words, length = words[order], length[order]
    fresh = np.r_[True, (words[1:] != words[:-1]).any(1) | (length[1:] != length[:-1])]
    return order, np.flatnonzero(fresh)


def interval_groups(data: np.ndarray, seg_start: np.ndarray, seg_len: np.ndarray, ids: np.ndarray, width: int):
    """Maximal repeat groups of at least ``width`` bytes among segments.

    Returns ``(pos, seg, groups)``: suffixes in order (place in ``data``, and
    segment), and per group ``(first suffix, last suffix, length, least
    identifier)``. Segment starts count as preceded by a byte of their own.
    """
    nothing = np.empty(0, np.int64)
    count = seg_len - width + 1
    pos = np.repeat(seg_start - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
    seg = np.repeat(np.arange(len(seg_start)), count)
    if len(pos) < 2:
        return nothing, nothing, []
    # a window that no other equals can't be in a group; of those that have
    # equals, only the ones with different bytes before them can open one.
    # Equal hashes of unequal windows would only keep more suffixes.
    eight = np.ndarray((len(data) - 7,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    hashed = np.zeros(len(pos), np.uint64)
    for k in (*range(0, width - 7, 8), width - 8):
        hashed = mixed(hashed ^ eight[pos + k])
    before = np.where(pos == seg_start[seg], 256 + seg, data[np.maximum(pos - 1, 0)])
    order = np.argsort(hashed, kind="stable")
    head = np.flatnonzero(np.r_[True, np.diff(hashed[order]) != 0])
    size = np.diff(np.r_[head, len(order)])
    diverse = np.minimum.reduceat(before[order], head) != np.maximum.reduceat(before[order], head)
    order = order[np.repeat((size > 1) & diverse, size)]
    pos, seg, before = pos[order], seg[order], before[order]
    if not len(pos):
        return nothing, nothing, []
    length = seg_start[seg] + seg_len[seg] - pos
    rows = _padded(data, pos, length, int(length.max()))
    order = np.lexsort((length, *rows.view(">u8").astype(np.uint64).T[::-1]))
    pos, seg, before, length, rows = pos[order], seg[order], before[order], length[order], rows[order]
    same = rows[1:] == rows[:-1]
    common = np.where(same.all(1), rows.shape[1], (~same).argmax(1))
    common = np.minimum(common, np.minimum(length[1:], length[:-1]))
    # the scan: a stack of open intervals (length, first suffix, byte before
    # or -1 when they differ, least identifier)
    groups, stack = [], []
    least, left = ids[seg].tolist(), before.tolist()
    for i, lcp in enumerate([*common.tolist(), 0]):
        first, byte, low = i, left[i], least[i]
        while stack and stack[-1][0] > lcp:
            own, first, other, lower = stack.pop()
            byte, low = (byte if byte == other else -1), min(low, lower)
            if byte == -1:
                groups.append((first, i, own, low))
        if lcp >= width:
            if stack and stack[-1][0] == lcp:
                _, first, other, lower = stack.pop()
                byte, low = (byte if byte == other else -1), min(low, lower)
            stack.append((lcp, first, byte, low))
    return pos, seg, groups


def _segments(blobs) -> tuple:
    """Segments and followers of one bucket, from its blobs."""
    heads, starts, texts, followers, at = [], [], [], [], 0
    unpack = zstandard.ZstdDecompressor()
    for blob in blobs:
        raw = unpack.decompress(blob)
        n, m = np.frombuffer(raw, "<i8", 2)
        head = np.frombuffer(raw, "<i8", 4 * n, 16).reshape(4, n)
        more = np.frombuffer(raw, "<i8", 4 * m, 16 + 32 * n).reshape(4, m).copy()
        more[0] += sum(h.shape[1] for h in heads)
        text = np.frombuffer(raw, np.uint8, -1, 16 + 32 * (n + m))
        starts.append(at + np.r_[0, np.cumsum(head[3])[:-1]])
        at += len(text)
        heads.append(head)
        followers.append(more)
        texts.append(text)
    ids, ths, place, length = np.concatenate(heads, 1)
    return ids, ths, place, length, np.concatenate(starts), np.concatenate(texts), np.concatenate(followers, 1)


def _bucketed(docs: DataFrame, width: int, max_cells: int) -> DataFrame:
    """``bucket, blob``: the segments whose anchors may be repeated."""
    _, size = text_size(docs)
    buckets = max(16, size // BUCKET_BYTES)

    def anchors(batch: pa.RecordBatch):
        for _, _, ends, data in _batches((t.as_py() for t in batch.column("text")), width):
            yield window_runs(_grams(data, _GRAM), ends, width, _GRAM)[2]

    found, _ = count_sketch(docs, anchors, expected_anchors(size, width, _GRAM), max_cells)
    bits = docs.sparkSession.sparkContext.broadcast(found)

    def candidates(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, ths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "th"))
            for owner, offset, ends, data in _batches((t.as_py() for t in batch.column("text")), width):
                start, count, hashes = window_runs(_grams(data, _GRAM), ends, width, _GRAM)
                take = maybe_repeated(bits.value, hashes)
                start, length, bucket = start[take], count[take] + width - 1, hashes[take] % np.uint64(buckets)
                if not len(start):
                    continue
                piece = np.searchsorted(ends, start, "right")
                own, place = owner[piece], start - np.r_[0, ends[:-1]][piece] + offset[piece]
                # equal segments of this batch travel as one: those of larger
                # identifiers follow the one of the smallest
                order, head = _first_equal(_padded(data, start, length, 2 * width), length, ids[own])
                group = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(order)]))
                late = ids[own[order]] > ids[own[order[head]]][group]
                lead = order[head]
                rank = np.empty(len(order), np.int64)
                sent = order[~late]
                sent = sent[np.lexsort((sent, bucket[sent]))]  # in the order of the text, which packs well
                rank[sent] = np.arange(len(sent))
                follow, leader = order[late], lead[group[late]]
                by = np.argsort(rank[leader], kind="stable")
                follow, leader = follow[by], leader[by]
                names = bucket[sent]
                cut = np.flatnonzero(np.r_[True, names[1:] != names[:-1], True])
                behind = np.searchsorted(rank[leader], cut)
                rows = []
                for k in range(len(cut) - 1):
                    pick, tail = sent[cut[k] : cut[k + 1]], slice(behind[k], behind[k + 1])
                    head4 = np.stack([ids[own[pick]], ths[own[pick]], place[pick], length[pick]])
                    more = follow[tail]
                    tail4 = np.stack([rank[leader[tail]] - cut[k], ids[own[more]], ths[own[more]], place[more]])
                    text = _gathered(data, start[pick], length[pick])
                    count2 = np.array([len(pick), len(more)], "<i8")
                    rows.append(pack.compress(b"".join(x.tobytes() for x in (count2, head4, tail4, text))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[cut[:-1]].astype(np.int64)), pa.array(rows, pa.binary())], ["bucket", "blob"]
                )

    return docs.mapInArrow(candidates, "bucket long, blob binary")


def repeated_spans(docs: DataFrame, width: int = 50, max_cells: int = MAX_CELLS) -> DataFrame:
    """``id, th, span``: stretches of bytes (packed start and end) covered by
    ``width``-byte strings that also start in a document with a smaller
    identifier. ``docs`` is ``keyed_text`` output."""

    def spans(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, ths, place, length, start, data, more = _segments(pdf["blob"])
        pos, seg, groups = interval_groups(data, start, length, ids, width)
        best = np.zeros(len(pos), np.int64)
        if groups:
            lo, hi, deep, low = np.array(groups, np.int64).T
            size = hi - lo + 1
            member = np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            late = ids[seg[member]] > np.repeat(low, size)
            np.maximum.at(best, member[late], np.repeat(deep, size)[late])
        hit = np.flatnonzero(best)
        own, at = seg[hit], pos[hit]
        begin = place[own] + at - start[own]
        leader, fid, fth, fplace = more
        return pd.DataFrame(
            {
                "id": np.r_[ids[own], fid],
                "th": np.r_[ths[own], fth],
                "span": np.r_[packed(begin, begin + best[hit]), packed(fplace, fplace + length[leader])],
            }
        )

    return _bucketed(docs, width, max_cells).groupBy("bucket").applyInPandas(spans, "id long, th long, span long")


def repeat_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, max_cells: int = MAX_CELLS
) -> DataFrame:
    """Maximal repeat groups with all their occurrences: one row per
    occurrence, ``repeat_sha256`` (of the repeated bytes), ``n_bytes``,
    ``doc_id, start`` (in bytes).

    A repeat longer than a segment appears as the chain of its pieces, cut
    at content-defined places and overlapping by ``width - 1`` bytes or more.
    Repeats inside one document count too. Edge cases as in
    ``suffix_dedup``.
    """

    def groups(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, ths, place, length, start, data, more = _segments(pdf["blob"])
        # each follower stands beside its leader as a segment of the same bytes
        leader, fid, _, fplace = more
        ids, place = np.r_[ids, fid], np.r_[place, fplace]
        start, length = np.r_[start, start[leader]], np.r_[length, length[leader]]
        pos, seg, found = interval_groups(data, start, length, ids, width)
        digests, sizes, members, begins = [], [], [], []
        for lo, hi, deep, _ in found:
            own = seg[lo : hi + 1]
            digests += [hashlib.sha256(data[pos[lo] : pos[lo] + deep].tobytes()).hexdigest()] * len(own)
            sizes += [int(deep)] * len(own)
            members += ids[own].tolist()
            begins += (place[own] + pos[lo : hi + 1] - start[own]).tolist()
        digests = pd.Series(digests, dtype=object)
        return pd.DataFrame({"repeat_sha256": digests, "n_bytes": sizes, "id": members, "start": begins})

    found = (
        _bucketed(keyed_text(docs, id_col, text_col), width, max_cells)
        .groupBy("bucket")
        .applyInPandas(groups, "repeat_sha256 string, n_bytes long, id long, start long")
    )
    return found.select("repeat_sha256", "n_bytes", restored_id().alias("doc_id"), "start")


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, max_cells: int = MAX_CELLS
) -> DataFrame:
    """Documents without the bytes covered by a ``width``-byte string that
    also starts in a document with a smaller identifier. ``width`` is at
    least 24.

    Returns one row per input row: ``doc_id, n_bytes, n_removed, kept``
    (the remaining bytes: cut inside a character, it is no UTF-8) and
    ``spans`` (maximal removed stretches, ``array<struct<start, end>>``).
    NULL or empty text has no bytes. Rows that share an identifier never
    remove from one another; a NULL identifier counts as the largest. An
    empty table gives no rows; columns of ``docs`` other than the two named
    ones are not read.
    """
    keyed = keyed_text(docs, id_col, text_col)

    def cut(batches):
        for batch in batches:
            counts, removed, kept, spans = [], [], [], []
            for text, own in zip(
                batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True
            ):
                data, gone = text.encode("utf-8", "surrogatepass"), merged_spans(own)
                at, stay = 0, []
                for s, e in gone:
                    stay.append(data[at:s])
                    at = e
                stay.append(data[at:])
                counts.append(len(data))
                removed.append(sum(e - s for s, e in gone))
                kept.append(b"".join(stay))
                spans.append([{"start": s, "end": e} for s, e in gone])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()),
                    pa.array(spans, kind),
                ],
                ["id", "n_bytes", "n_removed", "kept", "spans"],
            )

    joined = with_spans(keyed, repeated_spans(keyed, width, max_cells)).select("id", "text", "spans")
    out = joined.mapInArrow(
        cut, "id long, n_bytes long, n_removed long, kept binary, spans array<struct<start: long, end: long>>"
    )
    return out.select(restored_id().alias("doc_id"), "n_bytes", "n_removed", "kept", "spans")


def digest(out: DataFrame) -> DataFrame:
    """The operator's output with the spans counted and the kept bytes as
    their SHA-256."""
    return out.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
