"""The multi-index Hamming join against all pairs."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from conftest import edge_rows

from ferryline.llm import minhash_dedup as mh


def checked(docs, rows):
    back = lambda x: None if x == brute.LAST else x
    want = [(back(d), n, back(c), k) for d, n, c, k in brute.linked_sets(rows)]
    found = mh.minhash_dedup(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def family(rng, base, n, most):
    """Copies of a text with up to ``most`` of its words changed."""
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(most + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        yield " ".join(own)


def test_edge_cases(edges, nothing):
    checked(edges, edge_rows())
    assert mh.minhash_dedup(nothing).collect() == []


@pytest.mark.parametrize("tile", [4, 2048])
def test_families_of_near_copies_lose_no_link(spark, monkeypatch, tile):
    monkeypatch.setattr(mh, "TILE", tile)
    monkeypatch.setattr(mh, "SALTS", 4)
    rng = random.Random(5)
    texts = []
    for size, most in ((60, 4), (25, 8), (25, 12), (8, 3)):  # some within the limit, some around it
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 150, 300]))]
        texts += family(rng, base, size, most)
    texts += [" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(40)]
    texts += ["A b C", "a B c", "a b", "a b c d e f g h", "a b c d e f g h i", texts[3].upper(), texts[3] + " "]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    checked(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_chains_link_through_texts_between(spark):
    rng = random.Random(6)
    own, rows = [f"w{i}" for i in range(200)], []
    for i in range(30):
        rows.append((100 - i, " ".join(own)))
        for k in range(4):
            own[(i * 31 + k * 3) % 200] = f"y{rng.randrange(10**6)}"
    checked(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_all_signatures_within_the_distance_share_a_key():
    rng = np.random.default_rng(1)
    one = rng.integers(0, 1 << 16, (500, mh.SYMBOLS), dtype=np.uint16)
    two = one.copy()
    for row in two:
        wrong = rng.permutation(mh.SYMBOLS)[: mh.MOST_APART]
        row[wrong] ^= rng.integers(1, 1 << 16, len(wrong), dtype=np.uint16)
    assert ((one != two).sum(1) == mh.MOST_APART).all()
    assert (mh.chunk_keys(one) == mh.chunk_keys(two)).any(1).all()


def test_signatures_estimate_the_similarity():
    rng = np.random.default_rng(2)
    apart = []
    for _ in range(300):
        both = rng.integers(0, 2**63, 340).astype(np.uint64)
        one, two = np.sort(both[:320]), np.sort(both[20:])
        a, b = mh.signatures([one, two])
        apart.append((a != b).sum())
    assert abs(np.mean(apart) / mh.SYMBOLS - 40 / 340) < 0.02


def test_sketches_pass_pairs_that_may_be_similar():
    rng = np.random.default_rng(3)
    passed = {0.85: 0, 0.6: 0}
    for share in passed:
        for _ in range(300):
            both = np.unique(rng.integers(0, 2**64, 400, dtype=np.uint64))
            apart = rng.permutation(len(both))[: round(len(both) * (1 - share))]
            one, two = np.delete(both, apart[::2]), np.delete(both, apart[1::2])
            size = np.array([len(one) + len(two)])
            passed[share] += bool(mh.likeness(mh.sketch(one)[None], mh.sketch(two)[None], size, 85)[1][0])
    assert passed[0.85] == 300 and passed[0.6] < 10


def test_a_hot_family_is_tied_by_few_pairs(spark, monkeypatch):
    """The candidate pairs grow with the family, not with its square, and
    they tie it together."""
    monkeypatch.setattr(mh, "TILE", 64)
    rng = random.Random(7)
    base = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(family(rng, base, 800, 6))), "doc_id long, text string")
    rows = mh._documents(mh.keyed_text(docs), 3)
    nodes = mh.checkpointed(rows.selectExpr("id AS node", "n", "sign", "bins"))
    pairs = mh._stars(mh._shared_keys(mh._keys(nodes), 800 * 32)).toPandas()
    assert len(pairs) <= 800 * 3
    assert mh.minhash_dedup(docs).where("component_id = 0").count() == 800
