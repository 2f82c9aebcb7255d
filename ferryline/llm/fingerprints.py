"""Document fingerprints by winnowing, in column expressions only.

The words of a text are hashed in grams of ``gram`` consecutive words (XXH64
rolled over the words' UTF-8 bytes: each word's hash seeds the next). Of each
``window`` consecutive grams the least hash is chosen, the rightmost on ties,
and kept with its place. Two texts that share a passage of
``gram + window - 1`` words share a fingerprint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferryline.llm.common import LAST_ID, quoted, shuffle_partitions

GRAM = 3
WINDOW = 4
#: A chosen gram is one long: 32 bits of hash, then 31 bits that fall as the
#: place grows, so that the least long is the least hash at its last place.
#: A text has fewer words than 2**31 places (Spark's texts end at 2 GB).
_PLACES = (1 << 31) - 1


def words_of(text: Column) -> Column:
    """Runs of characters other than U+0020 and U+0009 to U+000D."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != F.lit(""))


def _gram_hashes(words: Column, gram: int) -> Column:
    """A gram for each place it fits at; a shorter text is one gram."""
    last = F.greatest(F.size(words) - F.lit(gram), F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(words, i + F.lit(j)) for j in range(gram)])
        .bitwiseAND(F.lit(0xFFFFFFFF))
        * F.lit(1 << 31)
        + (F.lit(_PLACES) - i),
    )


def _least_ahead(values: Column, step: int) -> Column:
    """Each value or, if less, the one ``step`` places on."""
    return F.transform(values, lambda x, i: F.least(x, F.get(values, i + F.lit(step))))


def with_fingerprint(
    df: DataFrame, text: Column, name: str, gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """``df`` with a column of the fingerprint's packed longs, in order of
    their places. A text of fewer grams than a window is one window."""
    words, grams = f"{name}__w", f"{name}__g"
    df = df.withColumn(words, words_of(text)).withColumn(grams, _gram_hashes(F.col(words), gram)).drop(words)
    # the least of 1, 2, 4, ... grams from each place on; places near the end
    # see fewer, which chooses nothing that their whole windows wouldn't
    span = 1
    while span < window:
        step = min(span, window - span)
        df = df.withColumn(grams, _least_ahead(F.col(grams), step))
        span += step
    whole = F.greatest(F.size(grams) - F.lit(window - 1), F.lit(1))
    return df.withColumn(name, F.array_distinct(F.slice(F.col(grams), F.lit(1), whole))).drop(grams)


def shown(fingerprint: Column) -> Column:
    """``hash:place`` of each gram chosen, the hash in hexadecimal."""
    return F.array_join(
        F.transform(
            fingerprint,
            lambda x: F.concat(
                F.lower(F.hex(F.shiftright(x, 31))),
                F.lit(":"),
                (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES))).cast("string"),
            ),
        ),
        " ",
    )


def entries(fingerprint: Column) -> Column:
    """``array<struct<hash, place>>`` (place: the gram's first word)."""
    return F.transform(
        fingerprint,
        lambda x: F.struct(
            F.shiftright(x, 31).alias("hash"), (F.lit(_PLACES) - x.bitwiseAND(F.lit(_PLACES))).alias("place")
        ),
    )


def hashes(fingerprint: Column) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 31)))


def likeness(a: Column, b: Column) -> Column:
    """Hashes in both over hashes in either (0 to 1) of two ``hashes``."""
    both = F.size(F.array_intersect(a, b)).cast("double")
    return both / (F.size(a) + F.size(b) - both)


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """``doc_id, fingerprint`` (``array<struct<hash, place>>``) of every row.

    NULL text is empty; a text without words has one gram, the hash of
    nothing. Equal texts have equal fingerprints. NULL identifiers and
    repeated rows stay as they are; an empty table gives no rows; columns
    other than the two named ones are not read.
    """
    rows = docs.select(
        quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text")
    )
    found = with_fingerprint(rows, F.col("text"), "fp", gram, window)
    return found.select("doc_id", entries(F.col("fp")).alias("fingerprint"))


def with_next(docs: DataFrame) -> DataFrame:
    """``id, text`` rows with ``next``, the text of the row that follows in
    ascending order of identifier and text (after the last, the first's),
    and ``guest``: dealt out by sampled splitters, each range sorted.

    The first row of every range is also sent, as a guest, to the range
    before it, and the very first to the last range; no row sees the whole
    order. Guests are marked, for the caller to drop.
    """
    parts = shuffle_partitions(docs.sparkSession)
    cuts = docs.agg(
        F.percentile_approx("id", [k / parts for k in range(1, parts)] or [0.5], 100 * parts).alias("cuts")
    ).first()["cuts"]
    cuts = sorted(set(cuts or []))
    splitters = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    dealt = docs.withColumn("part", F.size(F.filter(splitters, lambda c: c <= F.col("id"))))
    # at most as many firsts as there are ranges
    firsts = sorted(
        (r["part"], r["first"]) for r in dealt.groupBy("part").agg(F.min("id").alias("first")).collect()
    )
    before = {first: firsts[k - 1][0] for k, (_, first) in enumerate(firsts)}
    if not before:
        nowhere = (F.lit(x).alias(c) for c, x in (("part", 0), ("round", 0), ("guest", False), ("next", "")))
        return docs.select("*", *nowhere).limit(0)
    pairs = [x for first, part in before.items() for x in (F.lit(first).cast("long"), F.lit(part))]
    guest_of = F.element_at(F.create_map(*pairs), F.col("id"))
    wrap = firsts[0][1]
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("round"), F.lit(False).alias("guest"))
    sent = F.struct(
        guest_of.alias("part"), F.when(F.col("id") == wrap, 1).otherwise(0).alias("round"), F.lit(True).alias("guest")
    )
    copies = F.when(guest_of.isNull(), F.array(own)).otherwise(F.array(own, sent))
    spread = dealt.withColumn("to", F.explode(copies)).select("id", "text", "to.*")
    order = Window.partitionBy("part").orderBy("round", "id", "text")
    return spread.repartitionByRange(parts, "part").withColumn("next", F.lead("text").over(order))


def edited_pairs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Every text's fingerprint beside that of its edited text and its
    likeness to that one and to the next document's.

    The edited text has its last ``floor(n_chars / 4)`` code points replaced
    by the first as many (or all) of the next document in ascending order of
    identifier; after the last comes the first. Returns ``doc_id, n_chars,
    edited, fp, edited_fp`` (packed longs), ``near_edited, near_next``.
    NULL text is empty; a NULL identifier comes last; rows that share an
    identifier follow one another in order of their texts. A single row is
    followed by itself.
    """
    keyed = docs.select(
        F.coalesce(quoted(id_col).cast("long"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = with_next(keyed).withColumn("next", F.coalesce("next", "text"))
    rows = with_fingerprint(rows, F.col("text"), "fp", gram, window).withColumn("own", hashes(F.col("fp")))
    order = Window.partitionBy("part").orderBy("round", "id", "text")
    rows = rows.withColumn("next_own", F.coalesce(F.lead("own").over(order), "own")).where(~F.col("guest"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn(
        "edited",
        F.concat(
            F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut),
            F.substring(F.col("next"), F.lit(1), cut),
        ),
    ).drop("text", "next")
    rows = with_fingerprint(rows, F.col("edited"), "edited_fp", gram, window)
    return rows.select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"),
        "n_chars",
        "edited",
        "fp",
        "edited_fp",
        likeness(F.col("own"), hashes(F.col("edited_fp"))).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )


def digest(out: DataFrame) -> DataFrame:
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        shown(F.col("fp")).alias("fingerprint"),
        shown(F.col("edited_fp")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )
