from __future__ import annotations

import random

import brute
import numpy as np
import pytest
import zstandard
from conftest import edge_rows

from ferryline.llm import anchors
from ferryline.llm import substring_dedup as words
from ferryline.llm import suffix_dedup as suffixes
from ferryline.llm.common import keyed_text


def by_row(rows, found):
    """Found rows in no order against expected rows of possibly equal keys."""
    return sorted(map(str, found)) == sorted(
        str((d, *x)) for (d, _), x in zip(rows, brute_of(rows), strict=True)
    )


def brute_of(rows):
    return brute.removed(rows, 50, lambda t: t.encode(), lambda x: bytes(x))


def test_bytes_on_edge_cases(edges):
    found = [tuple(r) for r in suffixes.digest(suffixes.suffix_dedup(edges)).collect()]
    assert by_row(edge_rows(), found)


def test_words_on_edge_cases(edges):
    expected = brute.removed(edge_rows(), 13, brute.words, " ".join)
    expected = [(d, n, gone, digest) for (d, _), (n, gone, _, digest) in zip(edge_rows(), expected, strict=True)]
    found = [tuple(r) for r in words.digest(words.substring_dedup(edges)).collect()]
    assert sorted(map(str, found)) == sorted(map(str, expected))


def shuffled_rows(seed: int):
    r = random.Random(seed)
    vocabulary = [f"{r.choice('abc')}{i % 7}" for i in range(12)]
    passages = [" ".join(r.choices(vocabulary, k=r.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in r.sample(range(1000), 60):
        parts = [r.choice(passages) if r.random() < 0.6 else " ".join(r.choices(vocabulary, k=9)) for _ in range(r.randint(0, 6))]
        rows.append((i, "  ".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    rows = shuffled_rows(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = [tuple(r) for r in suffixes.digest(suffixes.suffix_dedup(docs)).collect()]
    assert by_row(rows, found)
    expected = brute.removed(rows, 13, brute.words, " ".join)
    expected = {d: (n, gone, digest) for (d, _), (n, gone, _, digest) in zip(rows, expected, strict=True)}
    got = {r[0]: tuple(r)[1:] for r in words.digest(words.substring_dedup(docs)).collect()}
    assert got == expected


def test_same_words_in_another_order_are_kept(spark):
    """Windows of two words that share every sum of places stay apart."""
    tail = "a b c d e f g h i"
    rows = []
    for i in range(40):  # other tails, so that some pairs share their anchor
        own = " ".join(f"{w}{i}" for w in tail.split())
        rows += [(2 * i, f"yes no no yes {own}"), (2 * i + 1, f"no yes yes no {own}")]
    r = random.Random(8)
    rows += [(1000 + i, " ".join(r.choices(["yes", "no"], k=60))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x[0]: tuple(x)[1:] for x in words.digest(words.substring_dedup(docs)).collect()}
    expected = brute.removed(rows, 13, brute.words, " ".join)
    assert got == {d: (n, gone, digest) for (d, _), (n, gone, _, digest) in zip(rows, expected, strict=True)}
    assert all(got[i][1] == 0 for i in range(80))


def test_full_sketch_loses_nothing(spark, monkeypatch):
    """A sketch too small for the input calls everything repeated."""
    from ferryline.llm import anchors

    monkeypatch.setattr(anchors, "SHARD_CELLS", 64)
    rows = shuffled_rows(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[2] for r in words.digest(words.substring_dedup(docs, max_cells=64)).collect()}
    expected = brute.removed(rows, 13, brute.words, " ".join)
    assert got == {d: gone for (d, _), (_, gone, _, _) in zip(rows, expected, strict=True)}


def test_long_text_in_pieces(spark, monkeypatch):
    from ferryline.llm import anchors

    monkeypatch.setattr(words, "BATCH_WORDS", 100)
    monkeypatch.setattr(anchors, "BATCH_TOKENS", 700)
    rows = shuffled_rows(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: r[2] for r in words.digest(words.substring_dedup(docs)).collect()}
    expected = brute.removed(rows, 13, brute.words, " ".join)
    assert got == {d: gone for (d, _), (_, gone, _, _) in zip(rows, expected, strict=True)}


def test_groups_have_all_occurrences(spark):
    r = random.Random(6)
    passage = "".join(r.choices("abcdefghij", k=200))
    rows = [(i, f"{chr(65 + i) * 30}{passage}{chr(75 + i) * 30}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups, covered = {}, {i: set() for i in range(5)}
    for x in suffixes.repeat_groups(docs).collect():
        groups.setdefault((x.repeat_sha256, x.n_bytes), []).append((x.doc_id, x.start))
        covered[x.doc_id] |= set(range(x.start, x.start + x.n_bytes))
    for (digest, size), own in groups.items():
        start = own[0][1]
        assert size >= 50 and sorted(own) == [(i, start) for i in range(5)]
        assert digest == brute.sha(rows[0][1][start : start + size])
    assert all(own == set(range(30, 230)) for own in covered.values())


def test_empty_tables(nothing):
    assert suffixes.suffix_dedup(nothing).count() == 0
    assert words.substring_dedup(nothing).count() == 0


def template_rows(n: int = 400):
    """A template with one changing word, which stands in every document."""
    r = random.Random(5)
    return [
        (i, f"we hereby confirm that your order with number {r.randrange(n // 2)} has been sent today by post")
        for i in r.sample(range(10 * n), n)
    ]


def windows_sent(docs):
    """Windows in each bucket of the last pass."""
    counts: dict[int, int] = {}
    for r in words._bucketed(keyed_text(docs), 13, 1 << 23).collect():
        n, _ = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.blob), "<i8", 2)
        counts[r.bucket] = counts.get(r.bucket, 0) + int(n)
    return counts


def test_windows_of_a_hot_anchor_are_spread(spark, monkeypatch):
    rows = template_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = brute.removed(rows, 13, brute.words, " ".join)
    expected = {d: (n, gone, digest) for (d, _), (n, gone, _, digest) in zip(rows, expected, strict=True)}
    most = []
    for least in (1 << 30, 20):
        monkeypatch.setattr(anchors, "HOT_LEAST", least)
        sent = windows_sent(docs)
        most.append(max(sent.values()) / sum(sent.values()))
        assert {r[0]: tuple(r)[1:] for r in words.digest(words.substring_dedup(docs)).collect()} == expected
    assert most[0] > 0.4 and most[1] < 0.2


def test_only_repeated_windows_travel(spark):
    r = random.Random(6)
    vocabulary = [f"w{k}" for k in range(30)]  # grams of three words recur, windows of thirteen don't
    docs = spark.createDataFrame([(i, " ".join(r.choices(vocabulary, k=300))) for i in range(200)], "doc_id long, text string")
    assert sum(windows_sent(docs).values()) < 0.01 * 200 * 288
