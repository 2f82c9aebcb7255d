"""Substring dedup over word windows, behind a count-min prefilter.

Every partition sketches its word windows, the sketches are merged, and one
bit per cell is sent out: a window counted once occurs once. As windows are
many, a sketch of their anchors (see ``anchors``) goes before: every window
holds its anchor, so an anchor's count is never below a window's, and windows
of anchors counted once need no cell of the windows' sketch. Last pass: only
windows estimated repeated travel, as 128-bit BLAKE2b digests of their words,
to be grouped exactly; each group keeps the window of the smallest identifier.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.anchors import (
    count_sketch,
    expected_anchors,
    is_hot,
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

#: Cells in a row of the anchors' sketch, at most; its two rows take twice as
#: many bits (128 MB). The windows' sketch has half as many at most.
MAX_CELLS = 1 << 29
#: Text bytes whose windows one bucket of the second pass gets, on average.
BUCKET_BYTES = 8 << 20
#: Words in one numpy batch (as Python objects they take some 100 bytes each).
BATCH_WORDS = 1 << 19
_GRAM = 3


def words_of(text: str) -> list[bytes]:
    """Maximal runs of characters other than U+0020 and U+0009 to U+000D."""
    return text.encode("utf-8", "surrogatepass").split()


def _word_keys(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


def _rolled(keys: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive keys, good for anchors only: grams
    of different words may share one, which costs work and loses nothing."""
    n = len(keys) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(width if n > 0 else 0):
        out += mixed(keys[j : j + n] + np.uint64((0x9E3779B97F4A7C15 * (j + 1)) & (2**64 - 1)))
    return out


def _digests(words: list[bytes], at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit halves of a strong digest of the ``width`` words from each
    place. Words hold no blank, so joined by one they tell windows apart."""
    joined = b" ".join(words)
    stop = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    first = np.r_[0, stop[:-1] + 1][at].tolist()
    last = stop[at + width - 1].tolist()
    found = b"".join([blake2b(joined[a:b], digest_size=16).digest() for a, b in zip(first, last, strict=True)])
    halves = np.frombuffer(found, "<u8").reshape(-1, 2)
    return np.ascontiguousarray(halves[:, 0]), np.ascontiguousarray(halves[:, 1])


def _batches(texts: Iterable[str], width: int):
    """``(owner, offset, ends, words, keys)`` per batch of pieces."""
    for batch in pieces(map(words_of, texts), width, BATCH_WORDS):
        owner = np.array([i for i, _, _ in batch], np.int64)
        offset = np.array([at for _, at, _ in batch], np.int64)
        ends = np.cumsum([len(w) for _, _, w in batch])
        words = [w for _, _, own in batch for w in own]
        yield owner, offset, ends, words, _word_keys(words)


def _bucketed(docs: DataFrame, width: int, max_cells: int) -> DataFrame:
    """``bucket, blob``: the windows estimated repeated."""
    gram = min(_GRAM, width)
    _, size = text_size(docs)
    buckets = max(16, size // BUCKET_BYTES)
    expected = expected_anchors(size // 5, width, gram)
    broadcast = docs.sparkSession.sparkContext.broadcast

    def anchors(batch: pa.RecordBatch):
        for _, _, ends, _, keys in _batches((t.as_py() for t in batch.column("text")), width):
            yield window_runs(mixed(_rolled(keys, gram)), ends, width, gram)[2]

    anchored = broadcast(count_sketch(docs, anchors, expected, max_cells))

    def windows_of(texts):
        """Batches with the windows whose anchors may be repeated: their
        first word, their hash, and the hash they are dealt by. That is the
        anchor's, which keeps neighbours together, or where the anchor is hot
        their own: a template with one changing word has as many different
        windows under one anchor as it has copies."""
        bits, hot = anchored.value
        for owner, offset, ends, words, keys in _batches(texts, width):
            start, count, anchor = window_runs(mixed(_rolled(keys, gram)), ends, width, gram)
            take = maybe_repeated(bits, anchor)
            start, count, anchor = start[take], count[take], anchor[take]
            at = np.repeat(start - np.cumsum(np.r_[0, count[:-1]]), count) + np.arange(count.sum())
            if len(at):
                own = mixed(_rolled(keys, width))[at]
                crowded = np.repeat(is_hot(hot, 8 * len(bits[0]), anchor), count)
                yield owner, offset, ends, words, at, own, np.where(crowded, own, np.repeat(anchor, count))

    def windows(batch: pa.RecordBatch):
        for *_, hashes, _ in windows_of(t.as_py() for t in batch.column("text")):
            yield hashes

    counted = broadcast(count_sketch(docs, windows, size // 15, max_cells // 2))

    def candidates(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, ths = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "th"))
            texts = (t.as_py() for t in batch.column("text"))
            for owner, offset, ends, words, at, hashes, deal in windows_of(texts):
                take = maybe_repeated(counted.value[0], hashes)
                at, bucket = at[take], (deal[take] % np.uint64(buckets)).astype(np.int64)
                if not len(at):
                    continue
                piece = np.searchsorted(ends, at, "right")
                key1, key2 = _digests(words, at, width)
                own = owner[piece]
                place = at - np.r_[0, ends[:-1]][piece] + offset[piece]
                # of the windows equal in this batch only those of the smallest
                # identifier travel: a common passage costs one record a batch
                order = np.lexsort((ids[own], key2, key1))
                head = np.flatnonzero(np.r_[True, (np.diff(key1[order]) != 0) | (np.diff(key2[order]) != 0)])
                least = np.repeat(ids[own[order[head]]], np.diff(np.r_[head, len(order)]))
                late = np.empty(len(order), bool)
                late[order] = ids[own[order]] > least
                yield _batch_of(pack, bucket, key1, key2, ids[own], ths[own], place, late)

    def _batch_of(pack, bucket, key1, key2, own, th, place, late):
        order = np.argsort(bucket, kind="stable")
        cut = np.r_[np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]), len(order)]
        rows, names = [], []
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            pick = order[a:b]
            settled, open_ = pick[late[pick]], pick[~late[pick]]
            # windows already settled here pass through as spans
            s, e = _runs(own[settled], th[settled], place[settled], width)
            parts = [np.array([len(open_), len(s[0])], "<i8")]
            parts += [x[open_].astype(x.dtype, copy=False) for x in (key1, key2, own, th, place)]
            # in the order of the text, so all but the keys packs to little
            rows.append(pack.compress(b"".join(np.ascontiguousarray(x).tobytes() for x in (*parts, *s, e))))
            names.append(int(bucket[pick[0]]))
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(rows, pa.binary())], ["bucket", "blob"]
        )

    return docs.mapInArrow(candidates, "bucket long, blob binary")


def repeated_windows(docs: DataFrame, width: int = 13, max_cells: int = MAX_CELLS) -> DataFrame:
    """``id, th, span``: stretches of words (packed start and end) covered by
    windows that also start in a document with a smaller identifier.

    ``docs`` is ``keyed_text`` output. A window of a document that occurs
    again in the same document only is not repeated. The sketches grow with
    the input up to ``max_cells`` cells a row; beyond, they filter less and
    the last pass groups more windows, with the same result.
    """

    def group(pdf: pd.DataFrame) -> pd.DataFrame:
        opened: list[list[np.ndarray]] = [[] for _ in range(5)]
        done: list[list[np.ndarray]] = [[] for _ in range(3)]
        unpack = zstandard.ZstdDecompressor()
        for blob in map(unpack.decompress, pdf["blob"]):
            n, m = np.frombuffer(blob, "<i8", 2)
            for k, kind in enumerate(("<u8", "<u8", "<i8", "<i8", "<i8")):
                opened[k].append(np.frombuffer(blob, kind, n, 16 + 8 * n * k))
            own, th, start, end = (np.frombuffer(blob, "<i8", m, 16 + 40 * n + 8 * m * k) for k in range(4))
            for x, y in zip(done, (own, th, packed(start, end)), strict=True):
                x.append(y)
        key1, key2, own, th, place = map(np.concatenate, opened)
        order = np.lexsort((own, key2, key1))
        key1, key2, own, th, place = (x[order] for x in (key1, key2, own, th, place))
        if len(order):
            head = np.flatnonzero(np.r_[True, (np.diff(key1) != 0) | (np.diff(key2) != 0)])
            late = own > np.repeat(own[head], np.diff(np.r_[head, len(order)]))
            (own, th, start), end = _runs(own[late], th[late], place[late], width)
            for x, y in zip(done, (own, th, packed(start, end)), strict=True):
                x.append(y)
        own, th, span = map(np.concatenate, done)
        return pd.DataFrame({"id": own, "th": th, "span": span})

    return _bucketed(docs, width, max_cells).groupBy("bucket").applyInPandas(group, "id long, th long, span long")


def _runs(own, th, place, width):
    """Windows that follow one another in a document, as one span each."""
    order = np.lexsort((place, th, own))
    own, th, place = own[order], th[order], place[order]
    if not len(own):
        return (own, th, place), place
    fresh = np.r_[True, (np.diff(own) != 0) | (np.diff(th) != 0) | (np.diff(place) > width)]
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(own)] - 1
    return (own[first], th[first], place[first]), place[last] + width


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13, max_cells: int = MAX_CELLS
) -> DataFrame:
    """Documents without the words covered by a ``width``-word window that
    also starts in a document with a smaller identifier.

    Returns one row per input row: ``doc_id, n_words, n_removed, kept_text``
    (the words that stay, joined by one space), ``spans`` (removed stretches
    of words as ``array<struct<start, end>>``). NULL or empty text has no
    words. Rows that share an identifier never remove from one another; a
    NULL identifier counts as the largest. An empty table gives no rows;
    columns of ``docs`` other than the two named ones are not read.
    """
    keyed = keyed_text(docs, id_col, text_col)

    def cut(batches):
        for batch in batches:
            counts, removed, kept, spans = [], [], [], []
            for text, own in zip(
                batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True
            ):
                words, gone = words_of(text), merged_spans(own)
                at, stay = 0, []
                for s, e in gone:
                    stay += words[at:s]
                    at = e
                stay += words[at:]
                counts.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(b" ".join(stay).decode("utf-8", "surrogatepass"))
                spans.append([{"start": s, "end": e} for s, e in gone])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                    pa.array(spans, kind),
                ],
                ["id", "n_words", "n_removed", "kept_text", "spans"],
            )

    joined = with_spans(keyed, repeated_windows(keyed, width, max_cells)).select("id", "text", "spans")
    out = joined.mapInArrow(
        cut,
        "id long, n_words long, n_removed long, kept_text string, spans array<struct<start: long, end: long>>",
    )
    return out.select(restored_id().alias("doc_id"), "n_words", "n_removed", "kept_text", "spans")


def digest(out: DataFrame) -> DataFrame:
    """The operator's output with the kept text as its SHA-256."""
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
