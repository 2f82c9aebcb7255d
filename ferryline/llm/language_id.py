"""Language identification of whole, possibly mixed, texts.

A word's script, found by code point ranges, narrows the languages it can
be in to those that use the script. Each word gets a score per language: log
odds of its letter trigrams and of itself under counts learned from labelled
documents. Viterbi decoding with a penalty for switching then labels every
word, and neighbouring words of one language make a span.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ferryline.llm.common import free_name, quoted

#: Documents learned from, per language, on average at most.
SAMPLE_PER_LANGUAGE = 5_000
#: Cells of the hashed trigram and word counts.
TRIGRAMS, WORDS = 1 << 16, 1 << 17
#: What a switch of language costs, in nats.
SWITCH = 8.0
#: A script is a language's if it has this share of the letters learned from.
SCRIPT_SHARE = 0.005
#: Overlapping trigrams say the same thing several times over.
DAMPING = 0.5
#: Code points worked on at once; longer texts are decoded in stretches.
BATCH_CHARS = 1 << 21
UNKNOWN = "und"

# First and last code points of scripts (Unicode blocks).
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "Devanagari": [(0x900, 0x97F), (0xA8E0, 0xA8FF)],
    "Bengali": [(0x980, 0x9FF)],
    "Gurmukhi": [(0xA00, 0xA7F)],
    "Gujarati": [(0xA80, 0xAFF)],
    "Oriya": [(0xB00, 0xB7F)],
    "Tamil": [(0xB80, 0xBFF)],
    "Telugu": [(0xC00, 0xC7F)],
    "Kannada": [(0xC80, 0xCFF)],
    "Malayalam": [(0xD00, 0xD7F)],
    "Sinhala": [(0xD80, 0xDFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Lao": [(0xE80, 0xEFF)],
    "Tibetan": [(0xF00, 0xFFF)],
    "Myanmar": [(0x1000, 0x109F)],
    "Georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Ethiopic": [(0x1200, 0x139F)],
    "Khmer": [(0x1780, 0x17FF)],
    "Kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F)],
    "Han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
OTHER = len(SCRIPTS) + 1
_TABLE = 0x32400


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    trigrams: np.ndarray  # TRIGRAMS x languages, log odds
    words: np.ndarray  # WORDS x languages, log odds
    allowed: np.ndarray  # scripts x languages, bool
    seen: np.ndarray  # scripts with a letter among those learned from, bool
    base: np.ndarray  # TRIGRAMS, what makes log odds log likelihoods over the background
    covered: np.ndarray  # per language, the share of new text's trigrams estimated to be among those learned


def letter_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: its script's number (0: neither letter nor mark), lower
    case, and whether it is a letter and no mark."""
    script, lower = np.zeros(_TABLE, np.uint8), np.arange(_TABLE, dtype=np.uint32)
    letter = np.zeros(_TABLE, bool)
    for cp in range(_TABLE):
        c = chr(cp)
        if c.isalpha() or (cp > 0x2FF and unicodedata.category(c)[0] == "M"):
            script[cp], letter[cp] = OTHER, c.isalpha()
            if len(low := c.lower()) == 1:
                lower[cp] = ord(low)
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            own = script[first : last + 1]
            own[own > 0] = number
    return script, lower, letter


def words_in(points: np.ndarray, tables) -> tuple[np.ndarray, ...]:
    """``(start, length, script, trigram, word)``: each word's first code
    point, letters and script number, every letter's trigram cell (in order
    of the words) and each word's cell. A word is a run of letters of one
    script, and of marks; marks alone are none."""
    script, lower, letter = tables
    known = np.minimum(points, _TABLE - 1)
    kind = np.where(points < _TABLE, script[known], 0)
    runs = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))
    if len(runs):
        told = np.add.reduceat(letter[known].astype(np.int64), runs)
        kind[runs[0] :][np.repeat(told == 0, np.diff(np.r_[runs, len(kind)]))] = 0
    low = np.where(kind > 0, lower[known], 0).astype(np.uint64)
    edge = np.flatnonzero(np.diff(kind, prepend=np.uint8(0), append=np.uint8(0)))
    start, stop = edge[:-1], edge[1:]
    inside = kind[start] > 0 if len(start) else np.empty(0, bool)
    start, length = start[inside], (stop - start)[inside]
    before, after = np.r_[np.uint64(0), low[:-1]], np.r_[low[1:], np.uint64(0)]
    cell = before * np.uint64(0x9E3779B97F4A7C15) + low * np.uint64(0xC2B2AE3D27D4EB4F)
    cell += after * np.uint64(0x165667B19E3779F9)
    cell = (cell ^ (cell >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - 16)
    # a word's key: its letters' numbers summed under multipliers that depend
    # on the place in the word
    letter = np.flatnonzero(kind)
    place = np.arange(len(letter)) - np.repeat(np.cumsum(np.r_[0, length[:-1]]) if len(length) else length, length)
    factor = (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    factor = (factor ^ (factor >> np.uint64(31))) | np.uint64(1)
    terms = low[letter] * factor
    first = np.cumsum(np.r_[0, length[:-1]]) if len(length) else length
    key = np.add.reduceat(terms, first) if len(first) else np.empty(0, np.uint64)
    word = (key ^ (key >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(64 - 17)
    return start, length, kind[start], cell[letter].astype(np.int64), word.astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def learn(
    docs: DataFrame,
    lang_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Model:
    """A model of every language among the rows of ``docs`` (rows without a
    language are passed over), from a sample of the documents picked by
    a hash of the identifier: about ``per_language`` of each language, or
    all where there are fewer."""
    rows = docs.select(
        quoted(lang_col).cast("string").alias("lang"),
        quoted(id_col).cast("string").alias("id"),
        F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("text"),
    ).where(F.col("lang").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = tuple(sorted(counts))
    if not languages:
        return Model((), np.zeros((TRIGRAMS, 0)), np.zeros((WORDS, 0)), np.zeros((OTHER + 1, 0), bool), np.zeros(OTHER + 1, bool), np.zeros(TRIGRAMS), np.zeros(0))
    shares = [x for k in languages for x in (F.lit(k), F.lit(min(1.0, per_language / counts[k])))]
    place = F.pmod(F.xxhash64(F.lit("learn"), F.coalesce("id", F.lit(""))), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(place < F.element_at(F.create_map(*shares), F.col("lang"))).select("lang", "text")
    size = TRIGRAMS + WORDS + OTHER + 1

    def count(batches):
        tables = letter_tables()
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                points = code_points(text.as_py())
                own = held.setdefault(lang, np.zeros(size, np.int64))
                for at in range(0, len(points), BATCH_CHARS):
                    _, length, script, cell, word = words_in(points[at : at + BATCH_CHARS], tables)
                    own[:TRIGRAMS] += np.bincount(cell, minlength=TRIGRAMS)
                    own[TRIGRAMS : TRIGRAMS + WORDS] += np.bincount(word, minlength=WORDS)
                    own[TRIGRAMS + WORDS :] += np.bincount(script, length, OTHER + 1).astype(np.int64)
        for lang, own in held.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]),
                    pa.array([used.astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([own[used].tobytes()], pa.binary()),
                ],
                ["lang", "cells", "counts"],
            )

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(size, np.int64)
        for cells, counted in zip(pdf["cells"], pdf["counts"], strict=True):
            own[np.frombuffer(cells, np.uint32)] += np.frombuffer(counted, np.int64)
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "counts": [own.tobytes()]})

    merged = (
        sample.mapInArrow(count, "lang string, cells binary, counts binary")
        .groupBy("lang")
        .applyInPandas(merge, "lang string, counts binary")
    )
    table = np.zeros((len(languages), size))
    for row in merged.toLocalIterator():  # a fixed number of counts for each language
        table[languages.index(row["lang"])] = np.frombuffer(row["counts"], np.int64)

    def odds(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        share = (own + 0.5) / (own.sum(1, keepdims=True) + 0.5 * own.shape[1])
        log = np.log(share)
        mean = log.mean(0)
        return np.ascontiguousarray((log - mean).T.astype(np.float32)), mean

    letters = table[:, TRIGRAMS + WORDS :]
    allowed = letters >= np.maximum(SCRIPT_SHARE * letters.sum(1, keepdims=True), 1)
    trigrams, mean = odds(table[:, :TRIGRAMS])
    words, _ = odds(table[:, TRIGRAMS : TRIGRAMS + WORDS])
    base = (mean + np.log(TRIGRAMS)).astype(np.float32)
    # Good and Turing: what was met once stands for what was not met
    cells = table[:, :TRIGRAMS]
    met = cells.sum(1)
    covered = np.where(met > 0, 1 - (cells == 1).sum(1) / np.maximum(met, 1), 0)
    return Model(languages, trigrams, words, allowed.T, letters.sum(0) > 0, base, covered)


def word_scores(model: Model, length, script, cell, word) -> np.ndarray:
    """Words x languages. Languages that don't use a word's script are ruled
    out; a word in a script of none says nothing."""
    first = np.cumsum(np.r_[0, length[:-1]])
    scores = DAMPING * (np.add.reduceat(model.trigrams[cell], first, axis=0) + model.words[word])
    scores = np.clip(scores, -12, 12).astype(np.float64)
    allowed = model.allowed[script]
    scores[~allowed] = -40
    scores[~allowed.any(1)] = 0
    return scores


def explained_letters(model: Model, length, script, cell, path) -> np.ndarray:
    """Per word, its letters whose trigram is likelier in the word's language
    than in a background of equally likely cells (in a script that no
    language is taken to use: in any language). No language is judged by
    another, so it matters little how many there are."""
    if not len(length):
        return np.zeros(0)
    best = model.trigrams[cell, np.repeat(path, length)]
    alone = np.repeat(~model.allowed[script].any(1), length)
    best[alone] = model.trigrams[cell[alone]].max(1)
    more = (best + model.base[cell] > 0) & np.repeat(model.seen[script], length)
    return np.add.reduceat(more.astype(np.int64), np.cumsum(np.r_[0, length[:-1]]))


def viterbi(scores: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of each word in turn."""
    best = scores[0]
    came = np.empty(scores.shape, np.int64)
    own = np.arange(scores.shape[1])
    for t in range(1, len(scores)):
        top = int(best.argmax())
        moved = best[top] - switch > best
        came[t] = np.where(moved, top, own)
        best = np.where(moved, best[top] - switch, best) + scores[t]
    path = np.empty(len(scores), np.int64)
    path[-1] = best.argmax()
    for t in range(len(scores) - 1, 0, -1):
        path[t - 1] = came[t, path[t]]
    return path


def decode(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> tuple[np.ndarray, np.ndarray]:
    """``(path, total)``: every word's label, and every text's score in each
    language, for texts of ``counts`` words (1 or more) one after the other.

    Where no stretch of words gains more by leaving the text's best language
    than one switch costs, that language is the whole best path; the others
    are decoded word by word.
    """
    first = np.cumsum(np.r_[0, counts[:-1]])
    total = np.add.reduceat(scores, first, axis=0)
    best = total.argmax(1)
    path = np.repeat(best, counts)
    if scores.shape[1] < 2:
        return path, total
    rows = np.arange(len(scores))
    rival = scores.copy()
    rival[rows, path] = -np.inf
    gain = rival.max(1) - scores[rows, path]
    for k in np.flatnonzero(_mixed(gain, first, counts) > switch):
        part = slice(first[k], first[k] + counts[k])
        path[part] = viterbi(scores[part], switch)
    return path, total


def _mixed(gain: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The largest sum of a stretch of each text's gains."""
    run = np.cumsum(gain)
    base = run[first] - gain[first]
    run = run - np.repeat(base, counts)  # each text's sums start from zero
    before = np.r_[0.0, run[:-1]]
    before[first] = 0.0
    # texts are set far below one another, so the least sum so far is a text's own
    step = float(np.abs(run).max()) * 2 + 1
    shift = step * np.repeat(np.arange(len(counts)), counts)
    least = np.minimum.accumulate(before - shift) + shift
    return np.maximum.reduceat(run - least, first)


def with_language(
    docs: DataFrame, model: Model, text_col: str = "text", switch: float = SWITCH, out: str | None = None
) -> DataFrame:
    """Every row of ``docs``, all its columns untouched, with one struct
    column more (``out``, or ``language`` prefixed until it clashes with
    none): ``lang_pred, score, spans, known, fit, covered``.

    ``lang_pred`` is the language of most letters, ``score`` (0 to 1) their
    share of the letters times the model's belief in that language over the
    words so labelled; ``spans`` (``array<struct<start, end, lang>>``, in code
    points) are the stretches of one language, in order. ``known`` is the
    share of the letters in scripts seen in learning, ``fit`` the share
    that ``explained_letters`` counts: unlike ``score``, neither shares
    belief out among the languages there are. ``covered`` tells how far
    ``fit`` can be trusted: the share of new text in that language whose
    trigrams are estimated to be among those learned.

    NULL and empty texts, and texts without letters, are ``und`` with score,
    known, fit and covered 0 and no spans, as is everything under a model of no languages. A text
    whose letters are all in scripts the model has not seen gets the first
    language with score 1 / languages, and known 0. Long texts are read whole, decoded in
    stretches of BATCH_CHARS code points. Repeated rows each get their row;
    an empty table gives no rows. The text column is a string.
    """
    out = out or free_name(docs, "language")
    names = docs.columns
    text_at = [n.lower() for n in names].index(text_col.lower())
    inner = [f"c{i}" for i in range(len(names))]
    rows = docs.toDF(*inner)
    sent = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def spans_of(path, start, length):
        cut = np.flatnonzero(np.diff(path)) + 1
        a, b = np.r_[0, cut], np.r_[cut, len(path)] - 1
        return list(zip(start[a].tolist(), (start[b] + length[b]).tolist(), path[a].tolist(), strict=True))

    def stretch(own, texts, tables):
        """Adds to each text's letters by language, scores (of the words
        labelled so, in each language) and spans."""
        model = Model(*sent.value)
        points = np.concatenate([np.r_[p, np.uint32(10)] for _, _, p in texts])
        ends = np.cumsum([len(p) + 1 for _, _, p in texts])
        start, length, script, cell, word = words_in(points, tables)
        if not len(start):
            return
        scores = word_scores(model, length, script, cell, word)
        text = np.searchsorted(ends, start, "right")
        which, first, counts = np.unique(text, return_index=True, return_counts=True)
        path, _ = decode(scores, counts, switch)
        told = explained_letters(model, length, script, cell, path)
        explained = np.stack([length * model.seen[script], told], 1)
        for k, a, n in zip(which.tolist(), first.tolist(), counts.tolist(), strict=True):
            i, at, _ = texts[k]
            part = slice(a, a + n)
            several = len(model.languages)
            state = own.setdefault(i, [np.zeros(several), np.zeros((several, several)), [], np.zeros(2)])
            state[0] += np.bincount(path[part], length[part], several)
            np.add.at(state[1], path[part], scores[part])
            base = at - (int(ends[k - 1]) if k else 0)
            state[3] += explained[part].sum(0)
            state[2] += [(s + base, e + base, lang) for s, e, lang in spans_of(path[part], start[part], length[part])]

    def label(batches):
        tables, languages = letter_tables(), sent.value[0]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            own: dict[int, list] = {}
            held, size = [], 0
            for i, text in enumerate(batch.column(text_at) if languages else ()):
                points = code_points(text.as_py() or "")
                for at in range(0, len(points), BATCH_CHARS):
                    part = points[at : at + BATCH_CHARS]
                    if size + len(part) > BATCH_CHARS:
                        stretch(own, held, tables)
                        held, size = [], 0
                    held.append((i, at, part))
                    size += len(part)
            if held:
                stretch(own, held, tables)
            preds, scores, spans, known, fit, covered = [], [], [], [], [], []
            for i in range(batch.num_rows):
                letters, sums, found, explained = own.get(i, (None, None, [], np.zeros(2)))
                shares = explained / letters.sum() if letters is not None else explained
                known.append(float(shares[0]))
                fit.append(float(shares[1]))
                if letters is None:
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    covered.append(0.0)
                else:
                    top = int(letters.argmax())
                    belief = 1.0 / float(np.exp(np.minimum(sums[top] - sums[top, top], 700)).sum())
                    preds.append(languages[top])
                    covered.append(float(sent.value[-1][top]))
                    scores.append(min(1.0, float(letters[top] / letters.sum()) * belief))
                spans.append([{"start": s, "end": e, "lang": languages[x]} for s, e, x in found])
            found = pa.StructArray.from_arrays(
                [
                    pa.array(preds, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(spans, kind),
                    pa.array(known, pa.float64()),
                    pa.array(fit, pa.float64()),
                    pa.array(covered, pa.float64()),
                ],
                ["lang_pred", "score", "spans", "known", "fit", "covered"],
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*inner, "found"])

    span = T.StructType().add("start", T.LongType()).add("end", T.LongType()).add("lang", T.StringType())
    found = T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType()).add("spans", T.ArrayType(span))
    found = found.add("known", T.DoubleType()).add("fit", T.DoubleType()).add("covered", T.DoubleType())
    schema = T.StructType([*rows.schema.fields, T.StructField("found", found)])
    return rows.mapInArrow(label, schema).toDF(*names, out)


def identify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH
) -> DataFrame:
    """``doc_id, lang_pred, score, spans`` of every row, as
    :func:`with_language` finds them."""
    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    return with_language(rows, model, switch=switch, out="found").select("doc_id", "found.lang_pred", "found.score", "found.spans")


def held_out(id_col: str = "doc_id"):
    """Whether the CRC-32 of the identifier as text leaves 2 when divided by 4."""
    return F.crc32(F.coalesce(quoted(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def predictions(docs: DataFrame) -> DataFrame:
    """Every document's language under a model learned from the documents
    that are not held out."""
    model = learn(docs.where(~held_out()))
    found = identify(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
