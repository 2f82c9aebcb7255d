"""Clusters against plain integer rounds, and the bounds against distances."""

from __future__ import annotations

import random

import brute
import numpy as np

from ferryline.llm import clustering as cl

SCHEMA = "vec_id long, embedding array<double>, id string, ints string, near string, cluster string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "z", "z", "z", "z") for i, v in rows], SCHEMA).repartition(parts)


def checked(spark, rows):
    found = cl.digest(cl.centroid_clusters(table(spark, rows)))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, brute.nearest(rows)))


def test_edge_cases(spark):
    rng = random.Random(3)
    near = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [x + rng.gauss(0, 0.1) for x in near[i % 5]]) for i in range(60)]
    rows += [(60, rows[0][1]), (7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, rows[9][1])]
    rows += [(70, None), (71, []), (72, [0.5] * 63), (73, [0.5] * 65), (74, [0.5] * 63 + [None])]
    rows += [(75, [0.5] * 63 + [float("nan")]), (76, [0.5] * 63 + [float("inf")]), (77, [-1e5] * 64), (78, [-1 / 64] * 64)]
    checked(spark, rows)
    assert cl.centroid_clusters(table(spark, rows[-9:-3])).collect() == []


def test_ties_equal_vectors_and_fewer_than_the_centroids(spark):
    checked(spark, [(i, [float(i % 2)] * 64) for i in range(50)])  # centroids equal to one another
    checked(spark, [(i, [0.25] * 64) for i in range(40)])
    checked(spark, [(i, [i / 64.0] + [0.0] * 63) for i in range(7)])


def test_components_too_large_are_held(spark):
    found = cl.centroid_clusters(table(spark, [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [0.0] * 64)])).collect()
    assert [r.distance for r in found] == [0, 0, 0] and {tuple(r.centroid) for r in found if r.vec_id == 1} == {
        (cl.LARGEST,) * 64
    }


def test_bounds_are_never_above_the_distance_and_skip_many():
    rng = np.random.default_rng(1)
    middle = rng.integers(-300, 300, (16, 64))
    points = (middle[rng.integers(0, 16, 4000)] + rng.integers(-25, 25, (4000, 64))).astype(np.int64)
    pivots = cl.spread_pivots(middle)
    measured, gaps = cl.squared_to(middle, pivots), cl.squared_to(pivots, pivots)
    to_pivots = cl.squared_to(points, pivots)
    exact = cl.squared_to(points, middle)
    assert (cl.ptolemaic_bounds(to_pivots, measured, gaps) <= exact).all()
    number, distance, checks = cl.nearest(points, to_pivots, middle, measured, gaps)
    assert (number == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert checks < 0.35 * exact.size  # of all distances, the share that is computed
    huge = points * 90_000  # near the largest components
    big, far = pivots * 90_000, middle * 90_000
    bound = cl.ptolemaic_bounds(cl.squared_to(huge, big), cl.squared_to(far, big), cl.squared_to(big, big))
    assert (bound <= cl.squared_to(huge, far)).all()
