"""Near dedup by SimHash: fingerprints within a Hamming radius are linked.

Distinct fingerprints are compared exactly, in tiles, by exclusive-or and bit
counts in numpy. Rows of a tile lie close in their number of bits set, and
tile pairs whose counts differ by more than the radius are skipped: the
distance can't be less. So that the tiles grow with the input and not with
its square, only fingerprints that agree in enough of their bits meet: cut
into more blocks than the radius has bits, two fingerprints within it agree
in all blocks but ``radius``, whichever they are; one group for each choice
of the agreeing blocks (and their value) misses no pair.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import LAST_ID, checkpointed, keyed_text, quoted, restored_id
from ferryline.llm.components import components

#: Rows and columns of a tile; groups are made to hold about two tiles.
TILE = 256
#: A group above this many distinct fingerprints is split by further bits.
LARGE_GROUP = 8192


def fingerprint_of(text: str, shingle: int = 3) -> int:
    """64 bits: each is set if it is set in over half of the XXH64 (seed 42)
    values of the text's word shingles, repeats included. A-Z are lowered;
    fewer words than a shingle count as one; no words give zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - shingle + 1)
    start = [0, *(ends[: n - 1] + 1).tolist()]
    stop = ends[min(shingle, len(words)) - 1 :].tolist()
    ones, step = np.zeros(64, np.int64), 1 << 16
    for k in range(0, n, step):
        places = zip(start[k : k + step], stop[k : k + step], strict=True)
        h = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in places]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(keyed: DataFrame, shingle: int = 3) -> DataFrame:
    """``id, th, fp`` of ``keyed_text`` rows (``fp`` as a signed long)."""

    def prints(batches):
        for batch in batches:
            found = np.array([fingerprint_of(t, shingle) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("th"), pa.array(found.view(np.int64))], ["id", "th", "fp"]
            )

    return keyed.mapInArrow(prints, "id long, th long, fp long")


def _cuts(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """The ways to agree: lists of ``(shift, bits)`` fields whose equality
    makes a group. Enough blocks, and bits of each, that a group of ``n``
    random fingerprints holds about two tiles."""
    wanted = max(0, math.ceil(math.log2(max(1, n / (2 * TILE)))))
    for blocks in range(radius + 1, radius + 4):
        kept, size = blocks - radius, 64 // blocks
        if kept * size >= wanted or blocks == radius + 3:
            break
    bits = min(size, -(-wanted // kept))
    return [[(b * size, bits) for b in chosen] for chosen in combinations(range(blocks), kept)]


def _key(fp: Column, way: int, fields: list[tuple[int, int]]) -> Column:
    """One long per group: the way's number above the agreeing bits."""
    key = F.lit(way).cast("long")
    for shift, bits in fields:
        own = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))
        key = F.shiftleft(key, bits).bitwiseOR(own)
    return key


def tile_links(fp: np.ndarray, radius: int):
    """Pairs ``(i, j)`` of rows within the radius, tile by tile."""
    count = np.bitwise_count(fp)
    order = np.argsort(count, kind="stable")
    fp, count = fp[order], count[order].astype(np.int64)
    for a in range(0, len(fp), TILE):
        own = fp[a : a + TILE, None]
        most = count[min(a + TILE, len(fp)) - 1]
        for b in range(a, len(fp), TILE):
            if count[b] - most > radius:
                break  # this tile and all after it have too many bits set
            i, j = np.nonzero(np.bitwise_count(own ^ fp[None, b : b + TILE]) <= radius)
            if a == b:
                i, j = i[i < j], j[i < j]
            if len(i):
                yield order[a + i], order[b + j]


def forest(n: int, links) -> np.ndarray:
    """Each row's least linked row, from pairs that come in parts."""
    label = np.arange(n)
    held, size = [], 0

    def settle():
        i, j = (np.concatenate(x) for x in zip(*held, strict=True))
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := label[label], label):
                label[:] = up

    for pair in links:
        held.append(pair)
        size += len(pair[0])
        if size > 1_000_000:
            settle()
            held, size = [], 0
    if held:
        settle()
    return label


def near_components(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``fp, component, root`` of every distinct fingerprint of ``id, fp``
    rows: the least identifier reachable over links of at most ``radius``
    bits, and the least fingerprint reached that has it. The root tells
    components apart, also those whose least identifiers are equal or NULL."""
    distinct = checkpointed(prints.groupBy("fp").agg(F.min("id").alias("rep")))
    ways = _cuts(distinct.count(), radius)
    keyed = distinct.select(
        F.posexplode(F.array(*[_key(F.col("fp"), w, f) for w, f in enumerate(ways)])).alias("way", "key"), "fp", "rep"
    )
    # groups that hold many fingerprints all the same (families of near
    # copies) are split by the bits their way has not used, in the same manner
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > LARGE_GROUP)
    parts = []
    for fields in ways:
        used = {s + k for s, bits in fields for k in range(bits)}
        rest = [k for k in range(64) if k not in used]
        size = len(rest) // (radius + 1)
        parts.append([sum(1 << k for k in rest[b * size : (b + 1) * size]) for b in range(radius + 1)])
    masks = [F.get(F.array(*[F.lit(_signed(p[b])) for p in parts]), F.col("way")) for b in range(radius + 1)]
    further = [F.xxhash64("key", F.lit(b), F.col("fp").bitwiseAND(mask)) for b, mask in enumerate(masks)]
    grouped = (
        keyed.join(large, "key", "left")
        .select(
            F.explode(F.when(F.col("n").isNull(), F.array("key")).otherwise(F.array(*further))).alias("key"),
            F.col("n").isNotNull().alias("split"),
            "fp",
            "rep",
        )
    )

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        rep, fp = pdf["rep"].to_numpy(), pdf["fp"].to_numpy()
        order = np.lexsort((fp, rep))  # the least row of a tree has its least identifier
        rep, fp = rep[order], fp[order]
        root = forest(len(rep), tile_links(fp.view(np.uint64), radius))
        tied = np.flatnonzero(root != np.arange(len(rep)))
        up = root[tied]
        return pd.DataFrame({"rep": rep[tied], "fp": fp[tied], "up_rep": rep[up], "up_fp": fp[up]})

    tied = grouped.groupBy("split", "key").applyInPandas(links, "rep long, fp long, up_rep long, up_fp long")
    # a node is a fingerprint, ordered by its least identifier first
    edges = tied.select(
        F.struct("rep", "fp").alias("a"), F.struct(F.col("up_rep").alias("rep"), F.col("up_fp").alias("fp")).alias("b")
    )
    # joined by node, so that the caller's join by fp shuffles anew and a hot
    # fingerprint can be split there
    return distinct.withColumn("node", F.struct("rep", "fp")).join(components(edges), "node", "left").select(
        "fp",
        F.coalesce("component.rep", "rep").alias("component"),
        F.coalesce("component.fp", "fp").alias("root"),
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> DataFrame:
    """``fp, id, th, component, root`` of every row."""
    prints = checkpointed(with_fingerprints(keyed_text(docs, id_col, text_col), shingle))
    return prints.join(near_components(prints, radius), "fp")


def simhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """``doc_id, th, fp, fingerprint, component_id`` of every row: the 64-bit
    fingerprint (signed, and as 16 hexadecimal digits) and the smallest
    identifier reachable over links between fingerprints that differ in at
    most ``radius`` bits.

    NULL and empty texts, and texts without words, have fingerprint zero,
    which links like any other. Equal fingerprints are one node, so exact
    copies cost one comparison. A NULL identifier counts as the largest (a
    component of nothing else is NULL, and so may be that of several
    components); repeated rows each get their row. An
    empty table gives no rows; columns other than the two named ones are not
    read. ``th`` is the XXH64 of the text, to tell rows of one identifier
    apart.
    """
    return _linked(docs, id_col, text_col, shingle, radius).select(
        restored_id().alias("doc_id"),
        "th",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        restored_id("component").alias("component_id"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """The rows of ``docs``, all columns untouched, of which one of each
    group of near duplicates stays: that of the smallest identifier, and of
    unlike texts that share it, that of the smallest fingerprint and ``th``
    (rows that share both identifier and text are the same document and stay
    together)."""
    found = _linked(docs, id_col, text_col, shingle, radius)
    least = found.where((F.col("fp") == F.col("root")) & (F.col("id") == F.col("component")))
    kept = least.groupBy("fp").agg(F.min("id").alias("kept_id"), F.min("th").alias("kept_th"))
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    same_row = (F.coalesce(quoted(id_col).cast("long"), F.lit(LAST_ID)) == F.col("kept_id")) & (
        F.xxhash64(text) == F.col("kept_th")
    )
    return docs.join(kept.select("kept_id", "kept_th"), same_row, "left_semi")


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "fingerprint", "component_id")
