"""Exact integer k-means whose distances are bounded first by coordinates from a few pivots.

The distances of a vector to m pivots place it as the apex of a simplex over the pivots: m - 1
coordinates in their span and a height above it. Between two apexes the Euclidean distance is never
larger than that of the vectors, and with one height turned over it is never smaller. A vector is
compared in exact integers only with the centroids whose lower bound does not exceed the least upper one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paytrail.session import materialized

DIM = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
PIVOTS = 6
#: Integer components below this keep every squared distance within a long.
LARGEST = 1 << 27

_PIVOT_CHOICES = 64
_SLACK = 1e-7
_ROWS_PER_ROUND = 20_000


def squared_distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to each point, as int64."""
    return np.stack([((vectors - p) ** 2).sum(axis=1) for p in points], axis=1)


@dataclass
class Simplex:
    """Pivots, and the triangular solution that turns squared distances into apex coordinates."""

    pivots: np.ndarray
    edges: np.ndarray
    solve: np.ndarray

    @classmethod
    def over(cls, choices: np.ndarray, most: int = PIVOTS) -> Simplex:
        """The first pivot, then always the vector that stands highest above the span of those taken."""
        rest = choices.astype(np.float64) - choices[0]
        taken, basis = [0], []
        while len(taken) < min(most, len(choices)):
            height = (rest**2).sum(axis=1)
            best = int(height.argmax())
            if not height[best] > 1e-3 * ((choices[taken[1] if len(taken) > 1 else best].astype(np.float64) - choices[0]) ** 2).sum():
                break
            basis.append(rest[best] / np.sqrt(height[best]))
            rest = rest - np.outer(rest @ basis[-1], basis[-1])
            taken.append(best)
        pivots = choices[taken]
        offsets = (pivots[1:] - pivots[0]).astype(np.float64)
        low = offsets @ np.array(basis).reshape(-1, choices.shape[1]).T
        return cls(pivots, (offsets**2).sum(axis=1), np.linalg.inv(np.tril(low)) if len(basis) else low)

    def apex(self, squared: np.ndarray) -> np.ndarray:
        """Coordinates in the pivots' span and, last, the height, from squared distances to the pivots."""
        squared = squared.astype(np.float64)
        inside = ((squared[:, :1] + self.edges - squared[:, 1:]) / 2) @ self.solve.T
        height = np.sqrt(np.maximum(squared[:, 0] - (inside**2).sum(axis=1), 0))
        return np.column_stack([inside, height])


def _bounds(apex: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances between vectors and centroids."""
    span = ((apex[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(axis=2)
    up, down = apex[:, None, -1], centres[None, :, -1]
    return span + (up - down) ** 2, span + (up + down) ** 2


def assign(vectors: np.ndarray, apex: np.ndarray, simplex: Simplex, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number) and the exact squared distance."""
    to_pivots = squared_distances(centroids, simplex.pivots)
    low, high = _bounds(apex, simplex.apex(to_pivots))
    # Rounding errors of the bounds grow with the squares that went into them.
    slack = 1 + _SLACK * ((apex**2).sum(axis=1) + to_pivots.max())
    row, centre = np.nonzero(low <= high.min(axis=1)[:, None] + slack[:, None])
    exact = ((vectors[row] - centroids[centre]) ** 2).sum(axis=1)
    order = np.lexsort((centre, exact, row))
    first = order[np.diff(row[order], prepend=-1) != 0]
    return centre[first], exact[first]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(-1, width)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS_PER_ROUND):
            yield batch.slice(at, _ROWS_PER_ROUND)


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _placer(simplex: Simplex, dim: int):
    """Adds each vector's apex coordinates, from its exact distances to the pivots."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            apex = simplex.apex(squared_distances(_matrix(batch.column("vector"), dim), simplex.pivots))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector"), _lists(apex)], names=["vec_id", "vector", "apex"]
            )

    return place


def _summer(simplex: Simplex, centroids: np.ndarray, width: int):
    """Per task and centroid, of the vectors nearest to it: their number, distance and component sums, one a row."""
    dim, k = centroids.shape[1], len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of sums: component 0 to dim - 1, then the number of vectors and their distance.
        sums = [[0] * (dim + 2) for _ in range(k)]
        for batch in _pieces(batches):
            vectors = _matrix(batch.column("vector"), dim)
            cluster, distance = assign(vectors, _matrix(batch.column("apex"), width), simplex, centroids)
            for c in np.unique(cluster).tolist():
                mine = cluster == c
                found = [*vectors[mine].sum(axis=0).tolist(), int(mine.sum()), sum(distance[mine].tolist())]
                sums[c] = [x + y for x, y in zip(sums[c], found)]
        rows = [(c, i, str(x)) for c in range(k) if sums[c][dim] for i, x in enumerate(sums[c])]
        cluster, place, value = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(place, pa.int32()), pa.array(value, pa.string())],
            names=["cluster", "place", "value"],
        )

    return add


def _finder(simplex: Simplex, centroids: np.ndarray, width: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            vectors = _matrix(batch.column("vector"), centroids.shape[1])
            cluster, distance = assign(vectors, _matrix(batch.column("apex"), width), simplex, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "cluster", "distance"],
            )

    return find


def _totals(placed: DataFrame, simplex: Simplex, centroids: np.ndarray, width: int) -> dict[int, list[int]]:
    """Component sums, number of vectors and inertia per centroid that has vectors: a few rows per centroid."""
    parts = placed.mapInArrow(_summer(simplex, centroids, width), "cluster int, place int, value string")
    total = parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found: dict[int, dict[int, int]] = {}
    for cluster, place, value in total.collect():
        found.setdefault(cluster, {})[place] = int(value)
    return {c: [by[i] for i in range(len(by))] for c, by in found.items()}


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """``vec_id`` and ``vector``: the components times ``scale``, rounded down, of the vectors that can be clustered."""
    rows = vectors.select(vectors[id_col].cast("bigint").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    limit = F.lit(float("inf"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
    kept = rows.where((F.size("v") == dim) & finite)
    fits = F.forall("v", lambda x: F.abs(x) * scale < LARGEST)
    return kept.select("vec_id", F.when(fits, F.transform("v", lambda x: F.floor(x * scale).cast("bigint"))).alias("vector"))


def cluster_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dim: int = DIM,
    scale: int = SCALE,
    seed: int = SEED,
    pivots: int = PIVOTS,
) -> DataFrame:
    """One row per kept vector: ``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Kept are vectors of exactly ``dim`` components, none NULL or not finite; each becomes integers,
    floor(scale * x). The ``k`` vectors with the smallest sha256 of ``<seed>:<vec_id>`` are the first
    centroids. A round assigns every vector to the nearest centroid (ties: the smaller number) and moves
    each centroid that has vectors to floor(sum / count), component by component; then vectors are
    assigned once more. All decisions and results are exact integers.

    The vectors are written once with their apex coordinates; a round reads them in place and shuffles
    one row per task, centroid and component. Only centroids and their sums reach the driver. A lost task is
    one task's vectors to read again.

    Fewer kept vectors than ``k`` make as many centroids. Equal hashes (repeated rows) go by the vector.
    Rows without an id are clustered but begin no centroid. Components of 2^27 / scale (131,072) or more
    are beyond the range in which a distance fits a long: such rows are returned with NULL in all columns but ``vec_id``
    and ``inertia`` and move no centroid. A sum of distances beyond a long is NULL. An empty table, or one
    without kept vectors, gives no rows. Other columns are ignored, whatever their names.
    """
    kept = materialized(whole_vectors(vectors, id_col, vector_col, dim, scale), "vectors")
    whole = kept.where("vector IS NOT NULL")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    # Never more rows than centroids and choices of pivots.
    first = whole.where("vec_id IS NOT NULL").orderBy(digest, "vector").limit(k + _PIVOT_CHOICES).select("vector").collect()
    if not first:
        return kept.select("vec_id", *_results(None))
    chosen = np.array([r[0] for r in first], dtype=np.int64)
    centroids, simplex = chosen[:k], Simplex.over(chosen, pivots)
    width = len(simplex.pivots)
    placed = materialized(
        whole.mapInArrow(_placer(simplex, dim), "vec_id bigint, vector array<bigint>, apex array<double>"), "apexes"
    )
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (*sums, n, _) in _totals(placed, simplex, centroids, width).items():
            moved[c] = [s // n for s in sums]
        centroids = moved
    inertia = {c: t[-1] for c, t in _totals(placed, simplex, centroids, width).items()}
    found = placed.mapInArrow(_finder(simplex, centroids, width), "vec_id bigint, cluster int, distance bigint")
    beyond = kept.where("vector IS NULL").select("vec_id", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance"))
    sha = {c: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for c, v in enumerate(centroids.tolist())}
    return found.union(beyond).select("vec_id", *_results((inertia, sha)))


def _results(found: tuple[dict[int, int], dict[int, str]] | None) -> list:
    """The columns beside the id; values per centroid stand in the plan as literals."""
    if found is None:
        kinds = {"cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint", "centroid_sha256": "string"}
        return [F.lit(None).cast(kind).alias(name) for name, kind in kinds.items()]
    inertia, sha = found

    def long(value: int):
        return F.lit(value if value < 1 << 63 else None).cast("bigint")

    own = F.create_map(*[x for c, v in inertia.items() for x in (F.lit(c), long(v))])
    digests = F.create_map(*[x for c, v in sha.items() for x in (F.lit(c), F.lit(v))])
    return [
        F.col("cluster"),
        F.col("distance"),
        F.try_element_at(own, F.col("cluster")).alias("cluster_inertia"),
        long(sum(inertia.values())).alias("inertia"),
        F.try_element_at(digests, F.col("cluster")).alias("centroid_sha256"),
    ]


def oracle_sql(k: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> str:
    """DuckDB SQL for the same rows: every distance in full, one pair of CTEs a round."""
    parts = [
        f"""ints AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {scale}) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {dim}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS INTEGER) AS cluster, v AS c
  FROM ints WHERE vec_id IS NOT NULL QUALIFY cluster < {k})""",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS (SELECT vec_id, v, cluster, distance, c FROM (
  SELECT vec_id, v, cluster, c,
         CAST(list_sum(list_transform(list_zip(v, c), lambda z: CAST((z[1] - z[2]) * (z[1] - z[2]) AS HUGEINT))) AS BIGINT) AS distance
  FROM ints CROSS JOIN c{r}) QUALIFY row_number() OVER (PARTITION BY vec_id, v ORDER BY distance, cluster) = 1)"""
        )
        if r < rounds:
            floor_div = "(s - (((s % n) + n) % n)) // n"
            parts.append(
                f"""e{r} AS (SELECT cluster, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a{r}),
s{r} AS (SELECT cluster, i, CAST(sum(x) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n FROM e{r} GROUP BY cluster, i),
m{r} AS (SELECT cluster, list(CAST({floor_div} AS BIGINT) ORDER BY i) AS c FROM s{r} GROUP BY cluster),
c{r + 1} AS (SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} m USING (cluster))"""
            )
    return (
        "WITH "
        + ",\n".join(parts)
        + f"""
SELECT vec_id, cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds}"""
    )
