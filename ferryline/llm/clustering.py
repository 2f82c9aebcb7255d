"""Centroid clustering (Lloyd's rounds in integers) behind Ptolemaic bounds.

For four points of a Euclidean space Ptolemy's inequality gives

    d(x, c) * d(p, s) >= | d(x, p) * d(c, s) - d(x, s) * d(c, p) |

so the distances of a vector ``x`` and of a centroid ``c`` to two fixed
pivots bound their own distance from below. The pivots never move: a vector's
distances to them are taken once and stay beside it, a round only measures
its few centroids anew. A centroid whose bound lies above the best distance
known is skipped; all that survive are checked exactly, in integers.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferryline.llm.common import checkpointed, quoted

#: Pivots; every pair of them gives a bound.
PIVOTS = 6
#: Scaled components are held within this bound either way, so that a squared
#: distance fits a long (up to 64 components).
LARGEST = 1 << 27
#: Relative error allowed for in each floating-point step of a bound; the
#: steps' own errors are below 2**-50.
_SLACK = 2.0**-46


def scaled_vectors(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``id, ints`` of the vectors kept: ``dims`` components, none NULL or
    not finite, each as ``floor(scale * component)``."""
    own = quoted(vector_col).cast("array<double>")
    finite = F.forall(own, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def whole(x: Column) -> Column:
        held = F.greatest(F.least(x * float(scale), F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
        return F.floor(held).cast("int")

    kept = vectors.where((F.size(own) == dims) & finite)
    return kept.select(quoted(id_col).cast("long").alias("id"), F.transform(own, whole).alias("ints"))


def first_centroids(scaled: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors of the least SHA-256 of ``seed:id`` (of equal
    identifiers those of the least components first)."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = scaled.select("ints", F.sha2(name, 256).alias("h")).orderBy("h", "ints").limit(k).collect()
    return np.array([r["ints"] for r in rows], np.int64)


def spread_pivots(points: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Up to ``most`` of the points, each the farthest from those before."""
    chosen = [0]
    far = ((points - points[0]) ** 2).sum(1)
    while len(chosen) < most and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def squared_to(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances, one row a vector."""
    return np.stack([((vectors - p) ** 2).sum(1) for p in points], axis=1)


def ptolemaic_bounds(to_pivots: np.ndarray, centroid_to_pivots: np.ndarray, pivot_gaps: np.ndarray) -> np.ndarray:
    """Lower bounds of the squared distances of vectors to centroids, from
    squared distances to pivots and between them. Rounded down: never above
    the true value."""
    x, c, gap = np.sqrt(to_pivots), np.sqrt(centroid_to_pivots), np.sqrt(pivot_gaps)
    best = np.zeros((len(x), len(c)))
    for p, s in combinations(range(x.shape[1]), 2):
        one, other = x[:, p, None] * c[None, :, s], x[:, s, None] * c[None, :, p]
        low = (np.abs(one - other) - _SLACK * (one + other)) / gap[p, s]
        np.maximum(best, low, out=best)
    return best * best * (1 - _SLACK)


def nearest(vectors, to_pivots, centroids, centroid_to_pivots, pivot_gaps):
    """``(number, squared distance, exact checks)`` of each vector's nearest
    centroid; of equally near ones the smallest number."""
    bound = ptolemaic_bounds(to_pivots, centroid_to_pivots, pivot_gaps)
    number = bound.argmin(1)
    distance = ((vectors - centroids[number]) ** 2).sum(1)
    first, checks = number.copy(), len(vectors)
    for c in range(len(centroids)):
        left = np.flatnonzero((bound[:, c] <= distance) & (first != c))
        checks += len(left)
        found = ((vectors[left] - centroids[c]) ** 2).sum(1)
        nearer = (found < distance[left]) | ((found == distance[left]) & (c < number[left]))
        number[left[nearer]], distance[left[nearer]] = c, found[nearer]
    return number, distance, checks


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists of whole numbers, one row a list."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), kind))


def centroid_clusters(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    scale: int = 64,
    k: int = 16,
    rounds: int = 3,
    seed: int = 1,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of
    every vector kept: its nearest centroid after ``rounds`` rounds (number,
    squared distance, components) and the distances summed over its cluster
    and over all.

    Vectors of another length, and those that are NULL or hold a NULL or a
    number that is not finite, are left out; a component beyond
    ``LARGEST / scale`` counts as that bound, so that distances fit a long
    (a sum that does not is NULL). Fewer vectors than ``k`` make as many
    centroids; none, or an empty table, give no rows. Equal vectors, repeated
    rows and rows that share an identifier each get their row; a NULL
    identifier is hashed as empty text. Columns other than the two named ones
    are not read.

    The driver holds the ``k`` centroids and, per round, their counts and
    sums: ``k * dims`` numbers, added up by component so that a cluster of
    any size is one row a partition.
    """
    spark = vectors.sparkSession
    scaled = scaled_vectors(vectors, id_col, vector_col, dims, scale)
    centroids = first_centroids(scaled, k, seed)
    if not len(centroids):
        return spark.createDataFrame(
            [],
            "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>",
        )
    pivots = spread_pivots(centroids)
    gaps = squared_to(pivots, pivots)

    def measure(batches):
        for batch in batches:
            if batch.num_rows:
                near = squared_to(_matrix(batch.column("ints")), pivots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("ints"), _lists(near, pa.int64())], ["id", "ints", "near"]
                )

    cached = checkpointed(scaled.mapInArrow(measure, "id long, ints array<int>, near array<long>"))
    for _ in range(rounds):
        centroids = _moved(cached, centroids, pivots, gaps)

    measured = squared_to(centroids, pivots)

    def assign(batches):
        for batch in batches:
            if batch.num_rows:
                own, near = _matrix(batch.column("ints")), _matrix(batch.column("near"))
                number, distance, _ = nearest(own, near, centroids, measured, gaps)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    found = checkpointed(cached.mapInArrow(assign, "vec_id long, cluster int, distance long"))
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(_exact_sum("distance", "s")).collect()}
    total = sum(sums.values())
    held = [
        (c, _as_long(s), _as_long(total), [int(x) for x in centroids[c]])
        for c, s in sums.items()
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    return found.join(F.broadcast(spark.createDataFrame(held, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def _exact_sum(column: str, name: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)")).alias(name)


def _as_long(x: int) -> int | None:
    return x if x < 1 << 63 else None


def _moved(cached: DataFrame, centroids: np.ndarray, pivots: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floor of each cluster's mean; those
    without vectors stay."""
    measured = squared_to(centroids, pivots)
    k, dims = centroids.shape

    def sums(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            if batch.num_rows:
                own, near = _matrix(batch.column("ints")), _matrix(batch.column("near"))
                number, _, _ = nearest(own, near, centroids, measured, gaps)
                count += np.bincount(number, minlength=k)
                for c in np.unique(number):
                    total[c] += own[number == c].sum(0)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(held, dims).astype(np.int32)),
                pa.array(np.tile(np.arange(dims, dtype=np.int32), len(held))),
                pa.array(np.repeat(count[held], dims)),
                pa.array(total[held].ravel()),
            ],
            ["cluster", "place", "n", "total"],
        )

    parts = cached.mapInArrow(sums, "cluster int, place int, n long, total long")
    moved = centroids.copy()
    for r in parts.groupBy("cluster", "place").agg(_exact_sum("n", "n"), _exact_sum("total", "total")).collect():
        moved[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return moved


def digest(out: DataFrame) -> DataFrame:
    """The operator's output with each centroid as a SHA-256."""
    text = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return out.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(text, 256).alias("centroid_sha256")
    )
