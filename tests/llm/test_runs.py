"""Periodic runs against all periods tried one by one."""

from __future__ import annotations

import random
import zlib

import brute
import numpy as np
import pytest
from conftest import edge_rows

from ferryline.llm import periodic_runs as pr


def planted(doc_id, text):
    own = brute.words(text or "")
    if doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 or not own:
        return own
    g = zlib.crc32(str(doc_id).encode()) // 10
    n = len(own)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]


def expected(doc_id, own):
    runs = brute.runs(own)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(own) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, brute.sha(lines), brute.sha(kept))


def random_words(rng, n):
    """Words of a small vocabulary, with stretches repeated here and there."""
    own = []
    while len(own) < n:
        part = [f"w{rng.randrange(rng.choice([2, 3, 300]))}" for _ in range(rng.randrange(1, 60))]
        own += part * rng.choice([1, 1, 1, 3, 4, 5, 9]) + part[: rng.randrange(len(part) + 1)]
    return own[:n]


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randrange(40))]
        want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
        assert pr.z_function(s) == want


def test_edge_cases_and_planted_tails(spark, edges, nothing):
    found = pr.digest(pr.collapse_runs(pr.with_planted_tails(edges))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(expected(d, planted(d, t))) for d, t in edge_rows())
    assert pr.digest(pr.collapse_runs(pr.with_planted_tails(nothing))).collect() == []
    plain = pr.collapse_runs(edges).collect()
    assert sorted(str((r.doc_id, r.n_words)) for r in plain) == sorted(
        str((d, len(brute.words(t or "")))) for d, t in edge_rows()
    )


@pytest.mark.parametrize("stretch", [32, 64, 4096])
def test_random_documents_in_stretches_of_any_length(spark, monkeypatch, stretch):
    monkeypatch.setattr(pr, "STRETCH_WORDS", stretch)
    monkeypatch.setattr(pr, "BAND", 2 if stretch < 4096 else 16)
    rng = random.Random(stretch)
    rows = [(i, " ".join(random_words(rng, rng.choice([5, 40, 300, 900])))) for i in range(60)]
    rows += [(100, "a " * 700), (101, "a b " * 350), (102, ("a " * 7 + "b ") * 80), (103, "x y " * 3 + "x " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = pr.digest(pr.collapse_runs(pr.with_planted_tails(docs))).collect()
    assert sorted(map(tuple, found), key=str) == sorted((expected(d, planted(d, t)) for d, t in rows), key=str)


def test_a_long_document_is_many_rows_and_the_work_stays_linear():
    parts = list(pr.stretches(1_000_000))
    assert len(parts) > 200 and max(b - a for a, b, _, _ in parts[:-1]) <= 1_000_000
    assert sum(b - a for a, b, _, _ in parts) < 4 * 1_000_000
    # one word over and over: everything but the first octave is skipped
    words = np.zeros(200_000, np.int64)
    assert list(pr.fragments(words, 1, 50_000)) == [(1, 0, 199_999)]


def test_stitching_joins_fragments_that_touch_only(spark):
    rows = [(1, 7, 2, 0, 10), (1, 7, 2, 10, 20), (1, 7, 2, 21, 30), (1, 7, 3, 5, 40), (2, 7, 2, 0, 10), (1, 7, 2, 0, 10)]
    found = pr.stitched(spark.createDataFrame(rows, pr._FRAGMENT)).collect()
    assert sorted(map(tuple, found)) == [(1, 7, 0, 22, 2), (1, 7, 5, 38, 3), (1, 7, 21, 11, 2), (2, 7, 0, 12, 2)]
