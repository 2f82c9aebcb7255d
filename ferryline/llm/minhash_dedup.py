"""Near dedup by MinHash: a multi-index Hamming join of b-bit signatures.

A document's signature holds ``SYMBOLS`` numbers of 16 bits, each the end of
the least hash of its shingles under one hash function, so two documents
differ in a symbol with a chance of one less their similarity. Signatures are
compared by the number of symbols in which they differ. Cut into ``CHUNKS``
chunks, two signatures that differ in at most ``MOST_APART`` symbols differ in
at most ``CHUNK_ERRORS`` symbols of some chunk (pigeonhole). So every chunk
gives a key for each way to err in it: the chunk without the erring symbols.
All pairs within ``MOST_APART`` meet under a key, whatever the data. Pairs
that met are compared by their whole signatures and by a longer sketch (the
least hash in each of 512 parts of the hash range), and confirmed on full sets.

Pairs are not sought where they can't change the result. First every document
is tied to some that share its keys (stars, not pairs, however many share a
key), foremost to the one whose keys are shared most, the middle of a family
of copies; the links confirmed make groups. Where a key's documents are in different
groups still, those outside the key's main group are compared with all the
others: the likeliest pair of each is confirmed first, then all pairs left
between groups are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.anchors import mixed
from ferryline.llm.common import (
    checkpointed,
    hot_join,
    hot_limit,
    keyed_text,
    membership,
    release_shuffles,
    restored_id,
)
from ferryline.llm.components import components

#: Symbols of a signature, chunks of it, and errors allowed within a chunk.
SYMBOLS, CHUNKS, CHUNK_ERRORS = 32, 8, 1
#: All pairs of signatures this far apart or less meet under some key. Of the
#: pairs of similarity 0.85, 3 in a million lie farther apart, of those of 0.9
#: less than 1 in 10**8.
MOST_APART = CHUNKS * (CHUNK_ERRORS + 1) - 1
#: Bins of the sketch, and how many standard deviations below the similarity
#: asked for a pair may be estimated: 1 in 100,000 pairs at it lies below.
BINS, DEVIATIONS = 512, 4.5
#: Parts that the documents under one key are dealt over.
SALTS = 64
#: Documents under one key that are held at a time.
TILE = 2048
#: Words in one numpy batch, and pairs compared at a time.
BATCH_WORDS, BATCH_PAIRS = 1 << 19, 1 << 17
_PHI, _MASK = 0x9E3779B97F4A7C15, 2**64 - 1


def shingle_sets(texts: Iterable[str], shingle: int) -> Iterator[list[np.ndarray]]:
    """Each text's set of shingles as sorted 64-bit hashes, some texts at a
    time. (Two shingles of a pair of texts share a hash once in about 10**12
    pairs.)"""
    batch: list[list[bytes]] = []
    size = 0
    for text in texts:
        batch.append(text.encode("utf-8", "surrogatepass").lower().split())
        size += len(batch[-1])
        if size > BATCH_WORDS:
            yield _hashed_sets(batch, shingle)
            batch, size = [], 0
    if batch:
        yield _hashed_sets(batch, shingle)


def _hashed_sets(batch: list[list[bytes]], shingle: int) -> list[np.ndarray]:
    told = pa.array([w for own in batch for w in own], pa.binary()).dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w.as_py()) for w in told.dictionary], np.uint64)
    words = known[told.indices.to_numpy(zero_copy_only=False)] if len(known) else np.empty(0, np.uint64)
    n = max(len(words) - shingle + 1, 0)
    hashed = np.full(n, shingle, np.uint64)
    for j in range(shingle if n else 0):
        hashed = mixed((hashed ^ words[j : j + n]) * np.uint64(_PHI) + np.uint64(j))
    out, at = [], 0
    for own in batch:
        if len(own) >= shingle:
            out.append(np.unique(hashed[at : at + len(own) - shingle + 1]))
        else:  # the whole sequence, if any, as one
            whole = [xxhash.xxh3_64_intdigest(b" ".join(own), len(own))] if own else []
            out.append(np.array(whole, np.uint64))
        at += len(own)
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of symbols for each set; none may be empty."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    hashed = np.concatenate(sets)
    out = np.empty((len(sets), SYMBOLS), np.uint16)
    for k in range(SYMBOLS):
        turned = (hashed ^ np.uint64(_PHI * (2 * k + 1) & _MASK)) * np.uint64((0xC2B2AE3D27D4EB4F * (2 * k + 3)) & _MASK | 1)
        turned ^= turned >> np.uint64(32)
        turned *= np.uint64(_PHI)
        out[:, k] = (mixed(np.minimum.reduceat(turned, starts)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def sketch(hashed: np.ndarray) -> np.ndarray:
    """The least hash of a sorted set in each bin of the hash range, as 1 to
    255; 0 where there is none."""
    out = np.zeros(BINS, np.uint8)
    bins, first = np.unique(hashed >> np.uint64(64 - int(math.log2(BINS))), return_index=True)
    out[bins.astype(np.int64)] = (mixed(hashed[first]) % np.uint64(255)).astype(np.uint8) + 1
    return out


def likeness(one: np.ndarray, two: np.ndarray, size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity by the sketches, row by row, and whether it
    leaves it possible that the sets (of ``size`` in sum) are similar enough.
    The bins in use are a sample of the union, drawn without replacement: of
    a small union nearly all of it."""
    bins = ((one > 0) | (two > 0)).sum(1)
    equal = ((one == two) & (one > 0)).sum(1)
    share = percent / 100
    left_out = np.maximum(1 - bins * (1 + share) / size, 0)
    slack = DEVIATIONS * np.sqrt(bins * share * (1 - share) * left_out) + 2
    return equal / bins, equal >= bins * share - slack


def chunk_keys(signs: np.ndarray) -> np.ndarray:
    """The keys of each signature, one column for each chunk and way to err."""
    size = SYMBOLS // CHUNKS
    columns = []
    for c in range(CHUNKS):
        for wrong in combinations(range(size), CHUNK_ERRORS):
            key = np.full(len(signs), c * 64 + sum(1 << w for w in wrong), np.uint64)
            for i in range(size):
                if i not in wrong:
                    key = mixed(key * np.uint64(_PHI) + signs[:, c * size + i].astype(np.uint64))
            columns.append(key)
    return np.stack(columns, axis=1).view(np.int64)


def _documents(keyed: DataFrame, shingle: int) -> DataFrame:
    """``id, th, digest, n, sign, bins`` of every row: a digest of the set,
    its size, its signature and its sketch (NULL without words)."""

    def read(batches):
        for batch in batches:
            at = 0
            for sets in shingle_sets((t.as_py() for t in batch.column("text")), shingle):
                own = batch.slice(at, len(sets))
                at += len(sets)
                held = [s for s in sets if len(s)]
                signs = iter(signatures(held)) if held else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("id"),
                        own.column("th"),
                        pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([next(signs).tobytes() if len(s) else None for s in sets], pa.binary()),
                        pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["id", "th", "digest", "n", "sign", "bins"],
                )

    return keyed.mapInArrow(read, "id long, th long, digest binary, n long, sign binary, bins binary")


def _keys(nodes: DataFrame) -> DataFrame:
    """``node, key`` of every node, a row for each key."""

    def spread(batches):
        for batch in batches:
            if batch.num_rows:
                keys = chunk_keys(_signs(batch.column("sign")))
                node = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(keys.ravel())], ["node", "key"])

    return nodes.select("node", "sign").mapInArrow(spread, "node long, key long")


def _signs(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), SYMBOLS)


def _bins(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), BINS)


def _may_link(n1: Column, n2: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _most_rows(table: DataFrame) -> int:
    return table.agg(F.max("n_rows")).first()[0] or 0


def _shared_keys(keys: DataFrame, total: int) -> DataFrame:
    """``key, salt, node, n_key`` of the keys that several nodes have (of
    ``total`` rows in all), and how many. The nodes under a key of more than
    ``TILE`` are dealt over ``SALTS`` parts; no step gathers a key's nodes."""
    counts = keys.groupBy("key").agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    shared = hot_join(keys, counts.withColumn("n_key", F.col("n_rows")), "key", total)
    salt = F.when(F.col("n_key") > TILE, F.pmod(F.xxhash64("key", "node"), F.lit(SALTS))).otherwise(0)
    return shared.select("key", salt.cast("int").alias("salt"), "node", "n_key")


def _stars(shared: DataFrame) -> DataFrame:
    """``a, b``: every node with three others at most, where they are not
    itself: of the nodes that share its keys, those whose own keys are shared
    most (of all its keys, of one key, and of its part under one key)."""
    score = shared.groupBy("node").agg(F.sum("n_key").alias("score"))
    ranked = shared.join(score, "node").select("key", "salt", "node", F.struct("score", "node").alias("rank"))
    parts = ranked.groupBy("key", "salt").agg(F.max("rank").alias("sub"))
    parts = parts.withColumn("lead", F.max("sub").over(Window.partitionBy("key")))
    member = ranked.join(parts, ["key", "salt"]).groupBy("node").agg(
        F.max("lead").alias("best"),
        F.min_by("lead", F.xxhash64("key", F.lit(1))).alias("lead"),
        F.min_by("sub", F.xxhash64("key", F.lit(2))).alias("sub"),
    )
    others = F.array("best.node", "lead.node", "sub.node")
    return member.select(F.col("node").alias("a"), F.explode(F.array_distinct(others)).alias("b")).where("a <> b")


def _near(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs within ``MOST_APART``, of sizes that can reach the similarity."""
    one, two = (
        nodes.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "sign", "bins"))) for x in "ab"
    )

    def apart(batches):
        for batch in batches:
            if batch.num_rows:
                differ = (_signs(batch.column("sign_a")) != _signs(batch.column("sign_b"))).sum(1)
                size = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
                _, near = likeness(_bins(batch.column("bins_a")), _bins(batch.column("bins_b")), size, percent)
                yield batch.select(["a", "b"]).filter(pa.array((differ <= MOST_APART) & near))

    met = _attached(pairs, one, two).where(_may_link(F.col("n_a"), F.col("n_b"), percent))
    met = met.select("a", "b", "n_a", "n_b", "sign_a", "sign_b", "bins_a", "bins_b")
    return met.mapInArrow(apart, "a long, b long")


def _attached(pairs: DataFrame, one: DataFrame, two: DataFrame) -> DataFrame:
    """``pairs`` with what ``one`` tells of node ``a`` and ``two`` of ``b``. A
    node in many pairs stands ``SALTS`` times in what is told and its pairs
    are dealt over these; there are at most ``1 / HOT_SHARE`` such nodes."""

    def end(side: str) -> Column:
        return F.struct(F.lit(side).alias("side"), F.col(side).alias("node"))

    ends = pairs.select(F.explode(F.array(end("a"), end("b"))).alias("end")).select("end.*")
    degrees = ends.groupBy("side", "node").agg(F.count("*").alias("hub"))
    total, *most = degrees.agg(
        F.sum(F.when(F.col("side") == "a", F.col("hub"))), *(F.max(F.when(F.col("side") == x, F.col("hub"))) for x in "ab")
    ).first()
    many = hot_limit(total or 0)
    for side, told, top in zip("ab", (one, two), most, strict=True):
        if (top or 0) <= many:
            pairs = pairs.join(told, side)
            continue
        hubs = degrees.where((F.col("side") == side) & (F.col("hub") > many))
        hubs = F.broadcast(hubs.select(F.col("node").alias(side), F.lit(True).alias("hub")))
        dealt = F.when(F.col("hub"), F.pmod(F.xxhash64("a", "b"), F.lit(SALTS)).cast("int")).otherwise(0)
        every = F.when(F.col("hub"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        left = pairs.join(hubs, side, "left").withColumn("salt", dealt).drop("hub")
        right = told.join(hubs, side, "left").withColumn("salt", F.explode(every)).drop("hub")
        pairs = left.join(right, [side, "salt"]).drop("salt")
    return pairs


def _divided(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``shared`` of keys whose nodes are in several groups, with
    the node's group as ``component`` and one of them, the key's main one, as
    ``main`` (a vote of one node a part; any choice is right)."""
    rows = shared.join(groups, "node", "left")
    rows = rows.withColumn("component", F.coalesce("component", "node"))
    parts = rows.groupBy("key", "salt").agg(
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.min_by("component", F.xxhash64("node", "key")).alias("vote"),
    )
    several = parts.groupBy("key").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.mode("vote").alias("main")
    )
    several = several.where("lo < hi").select("key", "main")
    return rows.join(parts.select("key", "salt").join(several, "key"), ["key", "salt"])


def _outsiders(divided: DataFrame, nodes: DataFrame, percent: int, best: bool) -> DataFrame:
    """``a, b``: pairs within ``MOST_APART`` that share a key and are not in
    one group; of each outsider only the likeliest one in a tile, or all.

    Rows of a key's main group stand in one tile each; the others go to every
    tile, to be compared with what stands there, and to tiles of their own. A
    tile holds about ``TILE`` rows, the rows compared with them stream by.
    """
    rows = divided.join(nodes.select("node", "n", "sign", "bins"), "node")
    tiles = F.ceil(F.col("n_key") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(3)), tiles.cast("long")).cast("int")
    every = F.sequence(F.lit(0), tiles - 1)

    def place(group: Column, guest: int) -> Column:
        return F.struct(group.alias("tile"), F.lit(guest).alias("guest"))

    # even numbers are tiles of the main group, odd ones of the others
    inside = F.array(place(2 * own, 0))
    outside = F.concat(
        F.array(place(2 * own + 1, 0)),
        F.transform(every, lambda t: place(2 * t, 1)),
        F.transform(every, lambda t: place(2 * t + 1, 1)),
    )
    where = F.when(F.col("component") == F.col("main"), inside).otherwise(outside)
    dealt = rows.select("key", "node", "component", "n", "sign", "bins", F.explode(where).alias("at"))
    dealt = dealt.select("key", "at.tile", "at.guest", "node", "component", "n", "sign", "bins")
    ordered = dealt.repartition("key", "tile").sortWithinPartitions("key", "tile", "guest")

    def compare(batches):
        held: list | None = None  # of the last key and tile: their names and the rows that stand there
        for batch in batches:
            if not batch.num_rows:
                continue
            key, tile, guest, node, component, n = (
                batch.column(c).to_numpy(zero_copy_only=False)
                for c in ("key", "tile", "guest", "node", "component", "n")
            )
            sign, bins = _signs(batch.column("sign")), _bins(batch.column("bins"))
            if held is not None:
                key, tile, guest, node, component, n, sign, bins = (
                    np.concatenate(x)
                    for x in zip(held, (key, tile, guest, node, component, n, sign, bins), strict=True)
                )
            fresh = np.r_[True, (np.diff(key) != 0) | (np.diff(tile) != 0)]
            first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
            stand = np.add.reduceat(1 - guest, np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
            guests = np.flatnonzero(guest)
            counts = stand[guests]
            cut = np.searchsorted(np.cumsum(counts), np.arange(0, counts.sum(), BATCH_PAIRS), "right")
            for a, b in zip(cut, [*cut[1:], len(guests)], strict=True):
                part, many = guests[a:b], counts[a:b]
                j = np.repeat(part, many)
                i = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + first[j]
                less, more = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
                open_ = (component[i] != component[j]) & (100 * less >= percent * more)
                # outsiders of one key meet in both their tiles
                open_ &= (tile[i] % 2 == 0) | (node[i] < node[j])
                i, j = i[open_], j[open_]
                near = (sign[i] != sign[j]).sum(1) <= MOST_APART
                i, j = i[near], j[near]
                like, near = likeness(bins[i], bins[j], n[i] + n[j], percent)
                i, j, like = i[near], j[near], like[near]
                if best:
                    order = np.lexsort((-like, j))
                    order = order[np.r_[True, np.diff(j[order]) != 0][: len(order)]]
                    one, two = node[i[order]], node[j[order]]
                    yield _pairs(one, two)
                    continue
                # under the first of the keys that the two share
                met = chunk_keys(sign[i]) == chunk_keys(sign[j])
                once = chunk_keys(sign[i])[np.arange(len(i)), met.argmax(1)] == key[i]
                if once.any():
                    yield _pairs(node[i[once]], node[j[once]])
            last = np.arange(first[-1], len(key))
            last = last[guest[last] == 0]
            held = [x[last] for x in (key, tile, guest, node, component, n, sign, bins)] if len(last) else None

    found = ordered.mapInArrow(compare, "a long, b long")
    return found.distinct() if best else found


def _pairs(one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(one, two)), pa.array(np.minimum(one, two))], ["a", "b"])


def _confirmed(pairs: DataFrame, nodes: DataFrame, keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    paired = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    source = nodes.join(paired, "node").select("node", F.col("rep.id").alias("id"), F.col("rep.th").alias("th"))
    source = checkpointed(source)
    # rows equal in both are one document; only it travels
    wanted = membership(source, F.xxhash64("id", "th"))
    texts = keyed.where(wanted(F.xxhash64("id", "th"))).join(source, ["id", "th"])
    texts = texts.groupBy("node").agg(F.any_value("text").alias("text"))

    def read(batches):
        for batch in batches:
            at = 0
            for sets in shingle_sets((t.as_py() for t in batch.column("text")), shingle):
                own = [pa.array(s.view(np.int64)) for s in sets]
                offsets = np.cumsum([0, *map(len, own)]).astype(np.int32)
                held = pa.ListArray.from_arrays(pa.array(offsets), pa.concat_arrays(own))
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, len(sets)), held], ["node", "held"])
                at += len(sets)

    sets = checkpointed(texts.mapInArrow(read, "node long, held array<long>"))
    one = sets.select(F.col("node").alias("a"), F.col("held").alias("held_a"))
    two = sets.select(F.col("node").alias("b"), F.col("held").alias("held_b"))
    both = _attached(pairs, one, two)
    shared = F.size(F.array_intersect("held_a", "held_b"))
    both = both.select("a", "b", shared.alias("s"), (F.size("held_a") + F.size("held_b")).alias("n"))
    return both.where(100 * F.col("s") >= percent * (F.col("n") - F.col("s"))).select("a", "b")


def minhash_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 85
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row: the size of
    its set of distinct word shingles (A-Z lowered), and the smallest
    identifier reachable over links between sets whose common part is at
    least ``percent`` hundredths of their union.

    Texts of fewer words than a shingle have one, their whole sequence; NULL
    and empty texts, and texts without words, have none and link with
    nothing. Equal sets are one node, so exact copies cost one comparison. A
    NULL identifier counts as the largest: a component of nothing else is
    NULL and its rows are kept. Repeated rows, and rows that share an
    identifier, each get their row; such rows are all kept or all dropped
    unless their texts are in different components. An empty table gives no
    rows; columns other than the two named ones are not read.
    """
    keyed = keyed_text(docs, id_col, text_col)
    rows = checkpointed(_documents(keyed, shingle))
    classes = rows.where("n > 0").groupBy("digest").agg(
        F.min(F.struct("id", "th")).alias("rep"), F.any_value("n").alias("n"), F.any_value("sign").alias("sign"), F.any_value("bins").alias("bins"),
        F.count("*").alias("n_rows"),
    )
    nodes = checkpointed(classes.withColumn("node", F.monotonically_increasing_id()))
    # a set as small as this differs from every other one in too great a part
    able = nodes.where(100 * F.col("n") >= percent * (F.col("n") + 1))
    ways = CHUNKS * math.comb(SYMBOLS // CHUNKS, CHUNK_ERRORS)
    shared = checkpointed(_shared_keys(_keys(able), able.count() * ways))
    release_shuffles(docs.sparkSession)
    stars = checkpointed(_near(checkpointed(_stars(shared)), able, percent))
    release_shuffles(docs.sparkSession)
    links = checkpointed(_confirmed(stars, able, keyed, shingle, percent))
    release_shuffles(docs.sparkSession)
    groups = checkpointed(components(links))
    for best in (True, False):
        shared = checkpointed(_divided(shared, groups))  # groups only grow: no other key matters from here on
        others = checkpointed(_outsiders(shared, able, percent, best))
        release_shuffles(docs.sparkSession)
        links = checkpointed(_confirmed(others, able, keyed, shingle, percent))
        release_shuffles(docs.sparkSession)
        if not links.isEmpty():
            tied = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
            groups = checkpointed(components(tied.union(links)))
        shared = shared.select("key", "salt", "node", "n_key")
    least = nodes.select("node", F.col("rep.id").alias("id")).join(groups, "node")
    least = least.groupBy("component").agg(F.min("id").alias("least"), F.count("*").alias("n_rows"))
    least = checkpointed(least)
    grouped = hot_join(groups, least, "component", groups.count(), most=_most_rows(least)).select("node", "least")
    named = nodes.select("digest", "node", "n_rows", F.col("rep.id").alias("id")).join(grouped, "node", "left")
    named = named.select("digest", "n_rows", F.coalesce("least", "id").alias("component"))
    told = rows.select("id", "n", F.when(F.col("n") > 0, F.col("digest")).alias("digest"))
    told = hot_join(told, named, "digest", rows.count(), "left", most=_most_rows(nodes))
    component = F.coalesce("component", "id")
    return told.select(
        restored_id().alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(component != F.lit(2**63 - 1), component).alias("component_id"),
        (F.col("id") == component).alias("kept"),
    )
