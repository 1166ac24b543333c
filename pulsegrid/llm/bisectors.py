"""Centroid clustering by a bisector tournament.

Components become floor(256 * x). For every pair of centroids i < j the integer
normal 2 (c_j - c_i) and threshold |c_j|^2 - |c_i|^2 of their bisector are
computed once a round: normal . x above the threshold means that j is nearer,
below it that i is, equal that the smaller number i wins. A row takes k - 1 such
sign tests, each between the winner so far and the next centroid, as the loser
of a test can't be nearest; its distance to the last winner is then exact.

Every round is one pass over the scan: tasks assign their rows batch by batch
and return sums and counts per centroid, which Spark adds up; what reaches the
driver is centroids x components numbers, whatever the number of rows. No row
is shuffled or held, and copies or a hot cluster weigh no more than other rows.
Tests, distances and sums are on whole numbers held in doubles where none of
them can reach 2**53, and on Python's integers in batches where one could.

Rows whose vector is null, has another number of components than ``dim`` or
holds null or non-finite ones are left out; all other rows are in the result,
repeated ones each. A null vec_id can't be hashed: such rows are clustered but
start no centroid. Equal hashes (repeated ids) go by vector. Fewer rows than
``k`` give fewer centroids, an empty table an empty result. Equal centroids: the
smaller number takes the rows and the other stays as it is. Distances and sums
beyond a long are held at the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .vectors import as_long, floors, matrix, vector_rows

SCALE = 256
K = 40
ROUNDS = 5
DIM = 64
SALT = "2:"
BLOCK = 2048
EXACT = 2**53


class Bisectors:
    """Normals and thresholds of all pairs of ``centroids`` (lists of integers)."""

    def __init__(self, centroids: list[list[int]]):
        whole = np.array(centroids, dtype=object)
        squares = (whole * whole).sum(axis=1)
        self.top = int(np.abs(whole).max(initial=0))
        self.centroids = whole
        self.normals = 2 * (whole[None, :, :] - whole[:, None, :])
        self.thresholds = squares[None, :] - squares[:, None]

    def kind(self, top: int) -> type:
        """Doubles if no number of a test, distance or block sum reaches 2**53."""
        wide = max(top, self.top)
        return np.float64 if 8 * self.centroids.shape[1] * max(1, wide) ** 2 < EXACT and BLOCK * wide < EXACT else object

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid and squared distance of every row of ``x`` (of the
        ``kind`` that ``top`` asks for)."""
        normals, thresholds = self.normals.astype(x.dtype), self.thresholds.astype(x.dtype)
        winner = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = (x * normals[winner, j]).sum(axis=1) - thresholds[winner, j]
            winner[side > 0] = j
        off = x - self.centroids.astype(x.dtype)[winner]
        return winner, (off * off).sum(axis=1)


def _blocks(batch: pa.RecordBatch, scale: int, bisectors: Bisectors):
    """Runs of a batch's rows as (first row, matrix of the right kind)."""
    x = floors(matrix(batch.column("v")), scale)
    for first in range(0, len(x), BLOCK):
        block = x[first : first + BLOCK]
        yield first, block.astype(bisectors.kind(int(np.abs(block).max(initial=0))))


def _sums(bisectors: Bisectors, scale: int):
    """A task's rows to (cluster, position, n, total)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = bisectors.centroids.shape
        totals, counts = np.zeros((k, dim), dtype=object), np.zeros(k, np.int64)
        for batch in batches:
            for _, block in _blocks(batch, scale, bisectors):
                winner, _ = bisectors.assign(block)
                own = np.arange(k)[:, None] == winner
                part = own.astype(block.dtype) @ block
                totals += part if part.dtype == object else part.astype(np.int64).astype(object)
                counts += own.sum(axis=1)
        some = np.flatnonzero(counts)
        columns = [
            pa.array(np.repeat(some, dim), pa.int32()), pa.array(np.tile(np.arange(dim), len(some)), pa.int32()),
            pa.array(np.repeat(counts[some], dim), pa.int64()),
            pa.array([Decimal(int(t)) for t in totals[some].ravel()], pa.decimal128(38, 0)),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["cluster", "position", "n", "total"])

    return run


def _labels(bisectors: Bisectors, scale: int):
    """A task's rows to (vec_id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in _blocks(batch, scale, bisectors):
                winner, square = bisectors.assign(block)
                columns = [batch.column("vec_id").slice(first, len(block)), pa.array(winner, pa.int32()), pa.array([as_long(d) for d in square], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return run


def cluster_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = SALT
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) per vector, and the centroids."""
    spark = df.sparkSession
    rows = vector_rows(df, id_col, vector_col).where(F.size("v") == dim)
    schema = "vec_id long, cluster int, distance long"
    named = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).alias("h")
    starts = rows.where("vec_id IS NOT NULL").select("v", named).orderBy("h", "v").limit(k).collect()
    if not starts:
        return spark.createDataFrame([], schema), []
    centroids = floors(np.array([r.v for r in starts]), scale).tolist()
    for _ in range(rounds):
        sums = rows.mapInArrow(_sums(Bisectors(centroids), scale), "cluster int, position int, n long, total decimal(38,0)")
        for r in sums.groupBy("cluster", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            centroids[r.cluster][r.position] = int(r.total) // r.n
    return rows.mapInArrow(_labels(Bisectors(centroids), scale), schema), centroids


def clusters(df: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = df.sparkSession
    found, centroids = cluster_vectors(df, **options)
    found = stage(found, "clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = as_long(sum(r.d for r in sums))
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    facts = [(r.cluster, as_long(r.d), inertia, name(centroids[r.cluster])) for r in sums]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, salt: str = SALT) -> str:
    """DuckDB SQL: every round as a pair of table expressions."""
    parts = [
        f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"x AS MATERIALIZED (SELECT vec_id, unnest(range(1, {dim + 1})) i, unnest(v) c FROM kept)",
        f"first AS (SELECT v, row_number() OVER (ORDER BY sha256('{salt}' || vec_id)) - 1 j FROM kept QUALIFY j < {k})",
        f"c0 AS MATERIALIZED (SELECT j, unnest(range(1, {dim + 1})) i, unnest(v) c FROM first)",
    ]
    for r in range(rounds + 1):
        parts.append(f"d{r} AS (SELECT vec_id, j, CAST(sum((x.c - c{r}.c) * (x.c - c{r}.c)) AS BIGINT) d FROM x JOIN c{r} USING (i) GROUP BY vec_id, j)")
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, j, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, j) = 1)")
        if r < rounds:
            parts.append(f"m{r} AS (SELECT a.j, x.i, CAST(floor(CAST(sum(x.c) AS DOUBLE) / count(*)) AS BIGINT) c FROM a{r} a JOIN x USING (vec_id) GROUP BY a.j, x.i)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT o.j, o.i, coalesce(m.c, o.c) c FROM c{r} o LEFT JOIN m{r} m ON m.j = o.j AND m.i = o.i)")
    parts.append(f"h AS (SELECT j, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) s FROM c{rounds} GROUP BY j)")
    return (
        "WITH " + ",\n".join(parts) + f"""
SELECT a.vec_id, CAST(a.j AS INTEGER) AS "cluster", a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.j) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h.s AS centroid_sha256 FROM a{rounds} a JOIN h USING (j)"""
    )


ORACLE = _oracle()
