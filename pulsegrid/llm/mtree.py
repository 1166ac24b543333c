"""Exact top-k by inner product: best-first search in M-trees.

Components become floor(1024 * x). The largest inner product is the nearest
neighbour after one more component: with M the largest squared norm, a vector v
gets sqrt(M - v.v) and a query 0, and then distance^2 = q.q + M - 2 q.v. That
distance is a metric, so the M-tree's bounds hold.

Rows are dealt by hash of vec_id into shards of about ``shard_rows`` rows (a
vector that repeats a million times is spread like any other); each shard is a
tree of pages. An entry of an inner page has a routing vector, a covering
radius, the distance to the routing vector of its page (its parent) and a
child page; an entry of a leaf has a vector and its parent distance. Search
takes the page with the least lower bound first. |d(q, parent) - d(parent, o)|
- radius, from stored distances alone, rules entries out before their own
distance is computed. Bounds are widened by a relative 1e-9, ties are never
ruled out, and scores are computed on integers, so the result is exact.
Queries meet every shard in blocks of ``block`` rows, both read from where they
are staged; the best k of each shard are merged.

Vectors that are null or hold null or non-finite components take no part;
shorter vectors are padded with zeros. A query's own rows are those with its
vec_id; a vec_id that repeats among the queries is one query (its least
vector). Rows with a null vec_id take no part. Repeated candidate rows each
have a rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import every_pair, stage
from .vectors import narrow, widened

SCALE = 1024
SHARD_ROWS = 8192
BLOCK = 256
PAGE = 64
FANOUT = 16
EXACT = 1 << 52
SLACK = 1e-9
ROWS = "shard int, n int, dim int, ids binary, data binary"


class MTree:
    """Bulk-loaded M-tree over the rows of ``vectors`` (integers)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, max_square: int):
        self.ids, self.vectors, self.max_square = ids, vectors, max_square
        squares = (vectors * vectors).sum(axis=1).astype(np.float64)
        self.points = np.column_stack([vectors.astype(np.float64), np.sqrt(np.maximum(max_square - squares, 0))])
        self.pages: list[dict] = []
        self.computed = self.avoided = 0
        if len(ids):
            centre = int(np.argmin(self._distances(self.points.mean(axis=0), np.arange(len(ids)))))
            self.root_vector = centre
            self._build(np.arange(len(ids)), centre, 0)

    def _distances(self, point: np.ndarray, rows: np.ndarray) -> np.ndarray:
        off = self.points[rows] - point
        return np.sqrt(np.einsum("ij,ij->i", off, off))

    def _build(self, rows: np.ndarray, parent: int, depth: int) -> int:
        """Store the page for ``rows`` below the routing vector ``parent``."""
        number = len(self.pages)
        self.pages.append({})
        if len(rows) <= PAGE:
            self.pages[number] = {"rows": rows, "to_parent": self._distances(self.points[parent], rows), "parent": parent}
            return number
        n = min(FANOUT, -(-len(rows) // PAGE))
        near = self._distances(self.points[rows[0]], rows)
        routes, owner = [rows[0]], np.zeros(len(rows), np.int64)
        while len(routes) < n and near.max() > 0:  # farthest-first routing vectors
            new = rows[int(np.argmax(near))]
            d = self._distances(self.points[new], rows)
            owner[d < near] = len(routes)
            near = np.minimum(near, d)
            routes.append(new)
        if len(routes) == 1 or np.bincount(owner).max() > 0.9 * len(rows) and depth > 20:
            owner = np.arange(len(rows)) * n // len(rows)  # equal vectors: any even split
            routes = [rows[int(np.argmax(owner == k))] for k in range(n)]
        entries = []
        for k, route in enumerate(routes):
            own = rows[owner == k]
            if len(own):
                radius = float(self._distances(self.points[route], own).max())
                entries.append((route, radius, self._build(own, route, depth + 1)))
        self.pages[number] = {
            "routes": np.array([e[0] for e in entries]),
            "radius": np.array([e[1] for e in entries]),
            "child": [e[2] for e in entries],
            "to_parent": self._distances(self.points[parent], np.array([e[0] for e in entries])),
            "parent": parent,
        }
        return number

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, vec_id) of the k best other rows, best first."""
        if not len(self.ids):
            return []
        point = np.append(query.astype(np.float64), 0.0)
        base = float((query * query).sum()) + self.max_square
        slack = SLACK * (1 + np.sqrt(base))
        best: list[tuple[int, int]] = []  # (score, -vec_id): the worst first
        limit = np.inf
        at_root = float(self._distances(point, np.array([self.root_vector]))[0])
        queue = [(0.0, 0, at_root)]
        while queue:
            bound, number, to_route = heapq.heappop(queue)
            if bound > limit:
                break
            page = self.pages[number]
            gap = np.abs(to_route - page["to_parent"])
            if "rows" in page:
                keep = gap <= limit
                self.avoided += len(keep) - int(keep.sum())
                rows = page["rows"][keep]
                rows = rows[self.ids[rows] != query_id]
                self.computed += len(rows)
                scores = (self.vectors[rows] @ query).astype(np.int64)
                if len(best) == k:
                    few = scores >= best[0][0]
                    rows, scores = rows[few], scores[few]
                for score, vec_id in zip(scores.tolist(), self.ids[rows].tolist()):
                    if len(best) < k:
                        heapq.heappush(best, (score, -vec_id))
                    elif (score, -vec_id) > best[0]:
                        heapq.heapreplace(best, (score, -vec_id))
                if len(best) == k:
                    limit = np.sqrt(max(base - 2.0 * best[0][0], 0.0)) + slack
            else:
                keep = gap - page["radius"] <= limit
                self.avoided += len(keep) - int(keep.sum())
                some = np.flatnonzero(keep)
                self.computed += len(some)
                d = self._distances(point, page["routes"][some])
                for e, x in zip(some.tolist(), d.tolist()):
                    low = max(x - page["radius"][e], bound, 0.0)
                    if low <= limit:
                        heapq.heappush(queue, (low, page["child"][e], x))
        return [(score, -minus) for score, minus in sorted(best, reverse=True)]


def quantised(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (array of long) of the rows that take part."""
    raw = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    raw = raw.where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()).where(~bad)
    return raw.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))


def _pack(by: str, dim: int):
    """Groups of rows (already side by side) to one row with all of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            ids = np.array([i for part in ids_of for i in part], "<i8")
            data = np.concatenate(rows_of) if rows_of else np.zeros((0, dim), "<i8")
            columns = [[key], [len(ids)], [dim], [ids.tobytes()], [narrow(data)]]
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[by, "n", "dim", "ids", "data"])

        key, ids_of, rows_of = None, [], []
        for batch in batches:
            keys = np.asarray(batch.column(0))
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if key is not None and keys[a] != key:
                    yield flush()
                    ids_of, rows_of = [], []
                key = int(keys[a])
                ids_of.append(batch.column(1).slice(a, b - a).to_pylist())
                block = np.zeros((b - a, dim), "<i8")
                for r, v in enumerate(batch.column(2).slice(a, b - a)):
                    block[r, : len(v)] = v.values.to_numpy()
                rows_of.append(block)
        if key is not None:
            yield flush()

    return run


def _packed(rows: DataFrame, by: str, groups: int, dim: int) -> DataFrame:
    """One row per hash group of about equal size."""
    keyed = rows.select(F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups)).cast("int").alias(by), "vec_id", "v")
    parts = min(groups, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keyed = keyed.repartition(parts, by).sortWithinPartitions(by, "vec_id")
    return keyed.mapInArrow(_pack(by, dim), f"{by} int, n int, dim int, ids binary, data binary")


def _read(row: dict, prefix: str, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[prefix + "ids"], "<i8")
    data = widened(row[prefix + "data"], len(ids), row["dim"])
    return ids, data.astype(np.float64) if exact else data


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best candidates of each query."""
    spark, schema = candidates.sparkSession, "query_id long, vec_id long, score long"
    rows = quantised(candidates, id_col, vector_col)
    asks = quantised(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("v").alias("v"))
    asks = stage(asks, "queries")
    square = F.aggregate("v", F.lit(0).cast("double"), lambda s, c: s + c.cast("double") * c)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(square).alias("top")).first()
    wide = asks.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(square).alias("top")).first()
    dim = max(facts["dim"] or 0, wide["dim"] or 0, 1)
    exact = max(facts["top"] or 0, wide["top"] or 0) < EXACT  # sums of products fit in doubles
    most = int(facts["top"] or 0)
    shards, blocks = max(1, -(-facts["n"] // shard_rows)), max(1, -(-wide["n"] // block))
    trees = stage(_packed(rows, "shard", shards, dim), "shards").select("shard", "dim", "ids", "data")
    asked = stage(_packed(asks, "block", blocks, dim), "blocks").select(F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    pairs = every_pair(trees, asked, blocks)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tree = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1).to_pylist()[0]
                if row["shard"] != held:
                    held, tree = row["shard"], MTree(*_read(row, "", exact), most)
                out = []
                for query_id, query in zip(*_read(row, "q_", exact)):
                    out += [(int(query_id), vec_id, score) for score, vec_id in tree.search(int(query_id), query, k)]
                columns = list(zip(*out)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, schema)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) rn FROM s)
SELECT query_id, CAST(rn AS INTEGER) AS "rank", vec_id, score FROM r WHERE rn <= 10
"""
