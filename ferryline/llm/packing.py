"""Best-fit packing of documents into sequences, certified by bounds.

Documents become token ids in Spark tasks; what is packed are slim records of
their pieces (a number and a length). The pieces are dealt to partitions of bounded size and packed
best-fit decreasing. Dual-feasible functions give a lower bound on the bins
of each partition and of the whole: a partition that meets its bound can't be
packed better. Partitions with gaps, and bins left loose at partitions' ends,
give their pieces to fewer, fresh partitions, which pack them again, until
the whole meets its bound, one partition is left or a round saves no bin.
"""

from __future__ import annotations

import re
import sys
import zlib
from functools import reduce
from itertools import accumulate, chain, count
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import checkpointed, quoted

#: Pieces in one partition, on average.
PARTITION_PIECES = 40_000
#: Words whose ids a task remembers; the memory starts anew beyond.
REMEMBERED_WORDS = 800_000
#: Text bytes encoded at once.
BATCH_BYTES = 8 << 20
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def worker_memory(path: str) -> tuple:
    """The tokenizer and the words known to it, kept by a Python worker from
    one task to the next (Spark reuses its workers): a task starts with what
    the tasks before it in the same process have met. Nothing depends on it
    but time; its size is bounded by REMEMBERED_WORDS."""
    from tokenizers import Tokenizer

    kept = sys.modules.setdefault("_ferryline_worker_memory", ModuleType("_ferryline_worker_memory")).__dict__
    if path not in kept:
        kept[path] = (Tokenizer.from_file(path), {})
    return kept[path]


class IdBytes:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    The tokenizer normalises and splits at white space before it merges, so
    the ids of a text are those of its stretches between blanks and line
    ends, one after the other, and a stretch seen before need not be encoded
    again. (A special token's string holds no white space, so it lies inside
    one stretch.) It also parts letters from the marks that follow them, so a
    blank put there changes no ids, and words with and without a full stop
    are one; and it lowers case, so of a word of plain letters only the lowered
    one is encoded."""

    #: Letters whose lower case and composition are the same everywhere.
    letters = "A-Za-zÀ-ÖØ-öø-ÿ"
    plain = re.compile(f"[{letters}]+")
    #: No apostrophe among the marks (contractions) and no ``<`` or ``|`` (special tokens).
    joint = f"([{letters}])([.,!?;:#$%&*()-])"

    def __init__(self, path: str):
        self.tokenizer, self.known = worker_memory(path)

    def _encode(self, words: list[str]) -> None:
        for k in range(0, len(words), 10_000):
            part = words[k : k + 10_000]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            flat = np.fromiter(chain.from_iterable(ids), "<u4").tobytes()
            edges = list(accumulate((4 * len(own) for own in ids), initial=0))
            self.known.update(zip(part, map(flat.__getitem__, map(slice, edges, edges[1:])), strict=True))

    def _learn(self, words: list[str]) -> None:
        known, plain = self.known, self.plain.fullmatch
        lowered = {w: low for w in words if (low := w.lower()) != w and plain(w)}
        own = {w for w in words if w not in lowered}
        self._encode([*own, *{low for low in lowered.values() if low not in own and low not in known}])
        for word, low in lowered.items():
            known[word] = known[low]

    def __call__(self, texts) -> list[bytes]:
        """The ids of each text of an Arrow array (or list) of strings."""
        lines = pc.replace_substring(pa.array(texts, pa.string()), "\n", " ")
        split = pc.split_pattern(pc.replace_substring_regex(lines, self.joint, r"\1 \2"), " ")
        words = split.flatten().dictionary_encode()
        distinct, known = words.dictionary.to_pylist(), self.known
        fresh = [w for w in distinct if w not in known]
        if len(known) + len(fresh) > REMEMBERED_WORDS:
            known.clear()
            fresh = distinct
        self._learn(fresh)
        found = [known[w] for w in distinct]
        # every word's ids, copied from where its distinct word's stand
        sizes = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), "<u4")
        word = words.indices.to_numpy()
        own = sizes[word]
        ends = np.cumsum(own)
        places = np.repeat(starts[word] - (ends - own), own) + np.arange(int(ends[-1]) if len(ends) else 0)
        data = ids[places].tobytes()
        cut = np.r_[0, ends][np.asarray(split.offsets) - split.offsets[0].as_py()] * 4
        return [data[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]


def stretches(texts: pa.Array, most: int):
    """Ranges of neighbouring texts of about ``most`` bytes (one at least)."""
    total = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
    at = 0
    while at < len(total):
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + most, "right")))
        yield at, end
        at = end


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length,
    ids_crc32``. A document's ids are its text's and ``end_id``; one longer
    than ``capacity`` is cut every ``capacity`` ids."""
    rows = docs.select(
        quoted(id_col).cast("long").alias("doc_id"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def cut(batches):
        import gc
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, end = IdBytes(tokenizer), int(end_id).to_bytes(4, "little")
        for batch in batches:
            gc.disable()  # millions of small lists and no cycle among them
            ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text")
            out = []
            for a, b in stretches(texts, BATCH_BYTES):
                for doc, data in zip(ids[a:b], encode(texts.slice(a, b - a)), strict=True):
                    data += end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[at : at + 4 * capacity]
                        out.append((doc, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            gc.enable()
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return rows.mapInArrow(cut, _PIECES)


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Least number of bins for ``counts`` items of each of ``sizes``, by two
    families of dual-feasible functions (no set that fits a bin is worth
    more than 1 under any of them)."""
    sizes, counts = sizes.astype(np.int64), counts.astype(np.int64)
    if not counts.sum():
        return 0
    best = -(-int((sizes * counts).sum()) // capacity)
    # small items count nothing, items that only they fit beside count whole
    for least in np.unique(np.minimum(sizes, capacity - sizes + 1)):
        if 0 < least <= capacity // 2:
            worth = np.where(sizes > capacity - least, capacity, np.where(sizes >= least, sizes, 0))
            best = max(best, -(-int((worth * counts).sum()) // capacity))
    # rounding: x counts as floor((k + 1) x) / k, or as x where that is whole
    for k in range(1, 25):
        scaled, off = np.divmod((k + 1) * sizes, capacity)
        worth = np.where(off == 0, k * sizes, scaled * capacity)
        best = max(best, -(-int((worth * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and each bin's fill."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by what still fits
    open_, n = 0, 0  # bit r of open_: some bin has room for r
    left: list[int] = []
    order = np.argsort(-lengths, kind="stable")
    for i, size in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fitting = open_ >> size
        if fitting:
            r = size + (fitting & -fitting).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                open_ &= ~(1 << r)
        else:
            b, r, n = n, capacity, n + 1
            left.append(capacity)
        bins[i], offsets[i] = b, capacity - r
        left[b] = r = r - size
        if r:
            room[r].append(b)
            open_ |= 1 << r
    return bins, offsets, capacity - np.array(left, np.int64)


def _packed(pieces: DataFrame, parts: int, capacity: int, turn: int) -> DataFrame:
    """``rid, length`` with ``sequence_id, offset`` of one round, and what
    decides the next: the fill of their sequence, and how many bins their
    partition has above its bound."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy()
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(*np.unique(lengths, return_counts=True), capacity)
        part = int(pdf["part"].iloc[0])
        return pdf.drop(columns="part").assign(
            sequence_id=(((turn << 32) + part) << 24) + bins, offset=offsets, fill=fill[bins], gap=len(fill) - bound
        )

    # salted by the round, so that each exchanges with other partitions
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(parts)).cast("int"))
    schema = "rid long, length long, sequence_id long, offset long, fill long, gap long"
    return dealt.groupBy("part").applyInPandas(pack, schema)


def pack_documents(
    docs: DataFrame,
    tokenizer: str | None = None,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: ``doc_id, piece`` (from 0), ``start`` (the
    document's ids before it), ``length, ids_crc32`` (of its ids as
    little-endian unsigned 32-bit), ``sequence_id, offset`` (its place
    there; every sequence is filled from 0 without gaps, to ``capacity`` at
    most).

    NULL and empty texts are one piece, ``end_id`` alone. Every row is a
    document of its own, so repeated rows are packed each; a NULL identifier
    stays NULL. Texts of any length are packed whole. An empty table gives
    no rows; columns other than the two named ones are not read.
    """
    tokenizer = tokenizer or default_tokenizer()
    found = pieces_of(docs, tokenizer, capacity, id_col, text_col, end_id)
    pieces = checkpointed(found.withColumn("rid", F.monotonically_increasing_id()))
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).toPandas()  # at most ``capacity`` rows
    bound = lower_bound(lengths["length"].to_numpy(np.int64), lengths["n"].to_numpy(np.int64), capacity)
    released, settled, bins, before = pieces.select("rid", "length"), [], 0, None
    for turn in count():
        parts = max(1, -(-released.count() // PARTITION_PIECES))
        packed = checkpointed(_packed(released, parts, capacity, turn))
        room = F.lit(capacity) - F.col("fill")
        loose = (room > 0) & ((F.col("gap") > 0) | (room > F.lit(capacity // 16)))
        total = packed.agg(F.countDistinct("sequence_id").alias("n")).first()["n"]
        if parts == 1 or bins + total <= bound or (before is not None and bins + total >= before):
            settled.append(packed)
            break
        before = bins + total
        settled.append(packed.where(~loose))
        bins += settled[-1].agg(F.countDistinct("sequence_id").alias("n")).first()["n"]
        released = packed.where(loose).select("rid", "length")
    places = reduce(DataFrame.union, settled).select("rid", "sequence_id", "offset")
    return pieces.join(places, "rid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
