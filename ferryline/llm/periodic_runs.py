"""Periodic runs of words, found in tiles that grow with the period.

A run of period ``q`` and of ``4 * q`` words or more holds some boundary of
any grid of spacing ``Q <= q`` with ``2 * Q`` words behind it that recur
``q`` words on. So each octave of periods (``Q <= q < 2 * Q``) has its own
tiles, one around each multiple of ``Q``, long enough that neighbouring tiles
overlap in all their runs. A tile is solved by itself: Z-functions of the
words from its boundary on, and of those before it read backwards, give how
far each period reaches to either side. What a tile finds is a fragment, an
interval of words that equal the words ``q`` on; fragments are shuffled by
document and period, and those that touch are stitched to runs.

A document is exploded into rows of tiles: small periods in short stretches
that overlap by some tiles, large ones in long stretches, so a long document
is many tasks' work; one within a stretch is a single row with all octaves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.anchors import mixed
from ferryline.llm.common import keyed_text, left_join_few, quoted, restored_id

#: Words in one stretch of the smallest octaves. Longer documents are
#: exploded into stretches.
STRETCH_WORDS = 4096
#: Each further band of octaves has stretches, and periods, this many times as long.
BAND = 16
#: The largest tile step of a band is this part of its stretch.
_STEP = 32
#: Words a task solves at a time (a longer row is solved alone).
BATCH_WORDS = 1 << 19
_PHI = np.uint64(0x9E3779B97F4A7C15)


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the start on."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(words: np.ndarray, at: int, step: int, periods: list[int]) -> list[tuple[int, int, int]]:
    """``(period, start, end)`` of the tile at boundary ``at``: the words of
    ``[start, end)`` equal those a period on. Only of ``periods``, within a
    step before the boundary and three after it, and only periods that are no
    power of a smaller one."""
    head = words[at : at + 5 * step].tolist()
    ahead = z_function(head)
    before = words[max(at - step, 0) : at].tolist()[::-1]
    around = words[max(at - step, 0) : at + 2 * step].tolist()[::-1]
    behind = z_function([*before, None, *around])
    out = []
    for q in periods:
        reach = min(ahead[q], 3 * step) if q < len(ahead) else 0
        if reach < 2 * step:
            continue
        if any(ahead[r] >= q - r for r in _divisors(q)):
            continue  # a power of a smaller period, which its own octave finds
        # the words before at + q, backwards, start here in `behind`
        place = len(before) + 1 + (len(around) - len(before) - q)
        out.append((q, at - min(behind[place], len(before)), at + reach))
    return out


def _divisors(q: int) -> Iterator[int]:
    """The largest proper divisors of ``q``: one for each of its primes."""
    rest, p = q, 2
    while p * p <= rest:
        if rest % p == 0:
            yield q // p
            while rest % p == 0:
                rest //= p
        p += 1
    if rest > 1:
        yield q // rest


def fragments(words: np.ndarray, first: int, last: int) -> Iterator[tuple[int, int, int]]:
    """Fragments ``(period, start, end)`` of the octaves ``first <= Q <=
    last``, joined where they touch. ``words`` are numbers, negative ones
    separate documents and each stands once."""
    n = len(words)
    reach = np.zeros(n, np.int64)  # up to where a smaller period is known to go on
    hashed, length = words.astype(np.uint64), 1  # of `length` words at each place
    step = 1
    while step <= last and 2 * step < n:
        hashed, length = mixed(hashed[: n - 2 * length + 1] * _PHI + hashed[length:]), 2 * length
        if step >= first:
            found = _octave(words, hashed, step, reach)
            for q, start, end in found:
                yield q, start, end
                np.maximum(reach[start : end + q], end + q, out=reach[start : end + q])
        step *= 2


def _octave(words: np.ndarray, hashed: np.ndarray, step: int, reach: np.ndarray) -> list[tuple[int, int, int]]:
    """Fragments of one octave. ``hashed`` tells ``2 * step`` words at each place."""
    rows = -(-len(hashed) // step)
    padded = np.zeros(rows * step, np.uint64)
    padded[: len(hashed)] = hashed
    grid = padded.reshape(rows, step)
    # a boundary's words against the words a step to two steps on: where no
    # hash is equal the tile holds no run
    tile, shift = np.nonzero(grid[1:] == grid[:-1, :1])
    first = np.flatnonzero(np.r_[True, np.diff(tile) != 0]) if len(tile) else []
    cut = np.r_[first, len(tile)].astype(np.int64)
    found: dict[int, list[tuple[int, int]]] = {}
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        at = int(tile[a]) * step
        begin, end = max(at - step, 0), min(at + 5 * step, len(words))
        if reach[begin] >= end:
            continue  # inside a run of a smaller period: whatever is found is a power of it
        for q, s, e in solve_tile(words, at, step, (shift[a:b] + step).tolist()):
            own = found.setdefault(q, [])
            if own and s <= own[-1][1]:
                own[-1] = (own[-1][0], max(own[-1][1], e))
            else:
                own.append((s, e))
    return [(q, s, e) for q, own in found.items() for s, e in own]


def stretches(n: int) -> Iterator[tuple[int, int, int, int]]:
    """The rows of a document of ``n`` words: ``(start, end, first octave,
    last octave)``. Neighbours in a band overlap by six of its largest steps,
    so a run that one sees in part the other sees whole."""
    size, first = STRETCH_WORDS, 1
    if n < 4:
        return
    while first <= n // 4:
        if n <= size:
            yield 0, n, first, n // 4
            return
        last = size // _STEP
        for start in range(0, n, size):
            yield start, min(start + size + 6 * last, n), first, last
            if start + size + 6 * last >= n:
                break
        size, first = size * BAND, last * 2


def _numbered(texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray]]:
    """``(text's place, numbers of its words)``; equal numbers are equal words."""
    for i, text in enumerate(texts):
        words = pa.array(text.encode("utf-8", "surrogatepass").split(), pa.binary())
        yield i, words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)


def _exploded(long: bool):
    """Documents as rows of stretches: those longer than one, or the others."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for i, words in _numbered(t.as_py() for t in batch.column("text")):
                if (len(words) > STRETCH_WORDS) != long:
                    continue
                for start, end, first, last in stretches(len(words)):
                    rows.append((i, start, len(words), first, last, words[start:end].tobytes()))
                    held += end - start
                if held > BATCH_WORDS:
                    yield _stretch_batch(batch, rows)
                    rows, held = [], 0
            if rows:
                yield _stretch_batch(batch, rows)

    return explode


def _stretch_batch(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    owner, start, n, first, last, words = zip(*rows, strict=True)
    take = pa.array(owner, pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            batch.column("id").take(take),
            batch.column("th").take(take),
            *(pa.array(x, pa.int64()) for x in (start, n, first, last)),
            pa.array(words, pa.binary()),
        ],
        ["id", "th", "start", "n", "first", "last", "words"],
    )


_STRETCH = "id long, th long, start long, n long, first long, last long, words binary"
_FRAGMENT = "id long, th long, period long, start long, end long"


def _solved(min_length: int, min_power: int):
    """Rows of stretches to fragments."""

    def together(rows):
        """Rows with the same octaves, up to a batch of words."""
        held: dict[tuple, list] = {}
        size: dict[tuple, int] = {}
        for row in rows:
            key = (row["first"], row["last"].bit_length())
            held.setdefault(key, []).append(row)
            size[key] = size.get(key, 0) + len(row["words"]) // 4
            if sum(size.values()) > BATCH_WORDS:
                key = max(size, key=size.get)
                del size[key]
                yield held.pop(key)
        yield from held.values()

    def solve(batches):
        for rows in together(row for batch in batches for row in batch.to_pylist()):
            parts, starts, at = [], [], 0
            for k, row in enumerate(rows):
                own = np.frombuffer(row["words"], np.int32).astype(np.int64)
                parts += [own, np.array([-1 - k])]
                starts.append(at)
                at += len(own) + 1
            first, last = rows[0]["first"], max(row["last"] for row in rows)
            out: list[tuple] = []
            for q, s, e in fragments(np.concatenate(parts), first, last):
                k = int(np.searchsorted(starts, s, "right")) - 1
                row, size = rows[k], len(rows[k]["words"]) // 4
                s, e = s - starts[k], e - starts[k]
                # one that ends inside the stretch on both sides is whole
                whole = (s > 0 or row["start"] == 0) and (e + q < size or row["start"] + size == row["n"])
                if whole and e - s + q < max(min_length, min_power * q):
                    continue
                out.append((row["id"], row["th"], q, row["start"] + s, row["start"] + e))
            if out:
                columns = [pa.array(x, pa.int64()) for x in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "th", "period", "start", "end"])

    return solve


def run_fragments(keyed: DataFrame, min_length: int = 6, min_power: int = 4) -> DataFrame:
    """``id, th, period, start, end`` of every fragment of ``keyed_text``
    rows. Texts of one stretch are solved where they are read; the stretches
    of longer ones are dealt over all tasks first."""
    solve = _solved(min_length, min_power)
    here = keyed.mapInArrow(_exploded(False), _STRETCH).mapInArrow(solve, _FRAGMENT)
    may_be_long = F.octet_length("text") > 2 * STRETCH_WORDS  # a word takes two bytes with its blank
    dealt = keyed.where(may_be_long).mapInArrow(_exploded(True), _STRETCH)
    dealt = dealt.repartition("id", "th", "start", "first").mapInArrow(solve, _FRAGMENT)
    return here.unionByName(dealt)


def stitched(found: DataFrame, min_length: int = 6, min_power: int = 4) -> DataFrame:
    """``id, th, start, length, period``: fragments of a document and period
    that touch, as one run each; runs too short are left out."""
    per = Window.partitionBy("id", "th", "period").orderBy("start", "end")
    before = F.max("end").over(per.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= F.col("before"), 0).otherwise(1)
    parts = found.distinct().withColumn("before", before).withColumn("run", F.sum(fresh).over(per))
    runs = parts.groupBy("id", "th", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    return runs.select("id", "th", "start", length.alias("length"), "period").where(
        F.col("length") >= F.greatest(F.lit(min_length), F.lit(min_power) * F.col("period"))
    )


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_power: int = 4
) -> DataFrame:
    """Documents with each periodic run cut to its first period.

    A run is a stretch of words with smallest period ``q`` (words ``q`` apart
    are equal), of at least ``max(min_length, min_power * q)`` words
    (``min_length`` 4 or more, ``min_power`` 4 or more), that neither
    neighbouring word continues. A word goes if a run holds it after that
    run's first ``q`` words.

    Returns one row per input row: ``doc_id, n_words``, ``runs`` (all of
    them, ``array<struct<start, length, period>>`` in that order, in words)
    and ``collapsed`` (the words that stay, joined by one space). NULL or
    empty text has no words and no runs. Repeated rows, and rows that share an
    identifier, each get their own; a NULL identifier stays NULL. An empty
    table gives no rows; columns other than the two named ones are not read.
    """
    keyed = keyed_text(docs, id_col, text_col)
    runs = stitched(run_fragments(keyed, min_length, min_power), min_length, min_power)
    per = runs.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def cut(batches):
        for batch in batches:
            counts, kept = [], []
            found = batch.column("runs").to_pylist()
            for text, own in zip(batch.column("text").to_pylist(), found, strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                counts.append(len(words))
                if own:
                    stay = np.ones(len(words), bool)
                    for run in own:
                        stay[run["start"] + run["period"] : run["start"] + run["length"]] = False
                    words = [words[i] for i in np.flatnonzero(stay)]
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts, pa.int64()),
                    pa.array([own or [] for own in found], kind),
                    pa.array(kept, pa.string()),
                ],
                ["id", "n_words", "runs", "collapsed"],
            )

    joined = left_join_few(keyed, per, ["id", "th"]).select("id", "text", "runs")
    schema = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return joined.mapInArrow(cut, schema).select(restored_id().alias("doc_id"), "n_words", "runs", "collapsed")


def with_planted_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` with the tails of one document in ten made periodic:
    with ``h = crc32(identifier)``, ``g = h // 10`` and ``n`` words, where ``h
    % 10 = 0`` word ``i >= a = g % n`` becomes word ``a + (i - a) % p``, ``p =
    1 + (n - a) // (3 + g % 8)``. A NULL identifier and a text without words
    are left as they are."""
    text = quoted(text_col).cast("string")
    h = F.crc32(quoted(id_col).cast("string").cast("binary"))
    rows = docs.select(quoted(id_col).alias("doc_id"), text.alias("text"), h.alias("h"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    rows = rows.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("g", F.expr("h div 10")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "flatten(array_repeat(slice(words, int(a + 1), int(p)), int(3 + g % 8 + 1)))"  # as long as the rest, or longer
    planted = F.expr(f"array_join(slice(concat(slice(words, 1, int(a)), {tail}), 1, int(n)), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def digest(out: DataFrame) -> DataFrame:
    """The operator's output with its run of greatest length by period, and
    the runs and the words that stay as SHA-256."""

    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(right > left, b).otherwise(a)  # runs come by start, then period: of equals the first stays

    best = F.when(F.size("runs") > 0, F.reduce("runs", F.get("runs", F.lit(0)), better))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.when(F.size("runs") > 0, F.concat(F.array_join(line, "\n"), F.lit("\n"))).otherwise(F.lit(""))
    return out.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
