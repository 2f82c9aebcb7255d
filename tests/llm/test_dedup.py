from __future__ import annotations

import random

import brute
import numpy as np
from conftest import edge_rows

from ferryline.llm import exact_dedup as exact
from ferryline.llm import simhash_dedup as near
from ferryline.llm.components import components


def test_exact_on_edge_cases(edges):
    found = exact.exact_dedup(edges, keep="largest", out="found")
    assert found.columns == [*edges.columns, "found"]
    groups = {}
    for d, t in edge_rows():
        groups.setdefault(t or "", []).append(d)
    stay = {}
    for r in found.collect():
        ids = [d for d in groups[r.text or ""] if d is not None]
        assert r.found.keep_id == (max(ids) if ids else None)
        assert r.found.group_size == len(groups[r.text or ""])
        assert r.found.text_sha256 == brute.sha(r.text or "")
        stay[r.text or ""] = stay.get(r.text or "", 0) + r.found.kept
        if r.found.kept:
            assert r.doc_id == r.found.keep_id
    assert set(stay.values()) == {1}
    assert sorted(map(str, ((r.doc_id, r.text) for r in found.collect()))) == sorted(map(str, edge_rows()))


def test_hot_groups_are_dealt_out_whole(spark, monkeypatch):
    monkeypatch.setattr(exact, "SMALL_GROUP", 4)
    rows = [(i, "hot") for i in range(500)] + [(1000 + i, f"t{i % 300}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for keep, best in (("largest", 499), ("smallest", 0)):
        found = exact.digest(exact.exact_dedup(docs, keep=keep)).collect()
        hot = [r for r in found if r.doc_id < 1000]
        assert len(found) == 900 and {(r.keep_id, r.group_size) for r in hot} == {(best, 500)}
        assert [r.doc_id for r in hot if r.kept] == [best]
        assert sum(r.kept for r in found) == 301


def test_exact_runs_no_python(edges):
    plan = exact.exact_dedup(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_normalised_content(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in exact.exact_dedup(docs, normalise=F.lower).collect()}
    assert found[2].dedup.keep_id == 1 and found[2].text == "a B" and found[3].text is None and found[3].dedup.kept


def test_simhash_on_edge_cases(edges):
    found = near.digest(near.simhash_dedup(edges)).collect()
    back = lambda x: None if x == brute.LAST else x
    expected = [(back(d), f, back(c)) for d, f, c in brute.components(edge_rows())]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_one_of_each_group_stays(spark):
    r = random.Random(5)
    base = [f"word{r.randint(0, 400)}" for _ in range(600)]
    rows = []
    for i in range(40):
        own = list(base)
        own[r.randrange(600)] = f"other{i}"
        rows.append((i + 3, " ".join(own)))
    rows += [(100 + i, " ".join(f"{i}w{r.randint(0, 900)}" for _ in range(200))) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {x.doc_id for x in near.one_of_each(docs).collect()}
    assert kept == {d for d, _, c in brute.components(rows) if d == c}
    assert kept >= set(range(100, 110)) and 3 in kept


def test_rows_without_an_identifier_of_their_own(spark):
    """NULL and shared identifiers: unlike texts are apart, near ones meet."""
    r = random.Random(9)

    def text(k):
        return " ".join(f"{k}w{r.randint(0, 900)}" for _ in range(600))

    def edited(t):  # an edit that leaves the fingerprints within the radius
        own = t.split()
        while True:
            own[r.randrange(600)] = f"other{r.random()}"
            if (brute.simhash(t) ^ (now := brute.simhash(" ".join(own)))).bit_count() in (1, 2, 3):
                return " ".join(own)
            if (brute.simhash(t) ^ now).bit_count() > 3:
                own = t.split()

    near_3, alone, pair, shared, twin = (text(k) for k in range(5))
    rows = [(3, near_3), (None, edited(near_3)), (None, alone), (None, pair), (None, edited(pair))]
    rows += [(7, shared), (7, twin), (7, edited(twin))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(x.doc_id, x.text) for x in near.one_of_each(docs).collect()]
    assert (3, near_3) in kept and (None, alone) in kept and (7, shared) in kept and len(kept) == 5
    assert sum(x in kept for x in rows[3:5]) == 1 and sum(x in kept for x in rows[6:]) == 1
    found = [(x.doc_id, x.fingerprint, x.component_id) for x in near.simhash_dedup(docs).collect()]
    ids = {f: c for _, f, c in found}
    assert [ids[f"{brute.simhash(t):016x}"] for _, t in rows] == [3, 3, None, None, None, 7, 7, 7]


def test_tiles_miss_no_pair():
    r = np.random.default_rng(3)
    centre = r.integers(0, 2**63, 40, dtype=np.uint64)
    fp = np.unique(np.concatenate([centre ^ (np.uint64(1) << r.integers(0, 63, 40, dtype=np.uint64)) for _ in range(20)]))
    found = {(min(i, j), max(i, j)) for a, b in near.tile_links(fp, 3) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    wanted = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if int(fp[i] ^ fp[j]).bit_count() <= 3}
    assert found == wanted


def test_split_of_large_groups(spark, monkeypatch):
    """Families too large for one group, and every number of blocks."""
    r = np.random.default_rng(4)
    centre = [int(x) for x in r.integers(0, 2**62, 6)]
    prints = {c ^ (1 << int(r.integers(0, 62))) ^ (1 << int(r.integers(0, 62))) for c in centre for _ in range(60)}
    prints = sorted(prints)
    rows = [(i, p) for i, p in enumerate(prints)]
    docs = spark.createDataFrame(rows, "id long, fp long")
    label = list(range(len(prints)))
    for _ in range(8):
        for i, a in enumerate(prints):
            label[i] = min([label[j] for j, b in enumerate(prints) if (a ^ b).bit_count() <= 3])
    for large, tile in ((8192, 256), (16, 256), (16, 1)):
        monkeypatch.setattr(near, "LARGE_GROUP", large)
        monkeypatch.setattr(near, "TILE", tile)
        found = {x.fp: x.component for x in near.near_components(docs).collect()}
        assert found == {p: label[i] for i, p in enumerate(prints)}


def test_blocks_miss_no_pair():
    for n in (10, 10**6, 10**9, 10**13):
        ways = near._cuts(n, 3)
        r = random.Random(n)
        for _ in range(300):
            a = r.getrandbits(64)
            b = a
            for k in r.sample(range(64), 3):
                b ^= 1 << k
            assert any(all((a >> s) % (1 << w) == (b >> s) % (1 << w) for s, w in way) for way in ways)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(50)]
    star = [(1000, 1001 + i) for i in range(80)]
    links = chain + star + [(2000, 1999), (2000, 2000)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    wanted = {i: 0 for i in range(51)} | {i: 1000 for i in range(1000, 1081)} | {2000: 1999, 1999: 1999}
    assert found == wanted


def test_empty_tables(nothing):
    assert exact.exact_dedup(nothing).count() == 0
    assert near.simhash_dedup(nothing).count() == 0
    assert near.one_of_each(nothing).count() == 0
