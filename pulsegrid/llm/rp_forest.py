"""Approximate nearest neighbours by a forest of random-projection trees.

Nearness is the largest inner product. With one more component, sqrt(M - v.v) for
a row (M: the largest squared norm) and 0 for a query, it is the least Euclidean
distance, so trees of hyperplanes suit it. Each node of a tree projects on the
difference of two random rows and splits at the median.

* Index. The planes are fitted on a sample of at most ``SAMPLE`` rows (smallest
  hashes), split while a leaf stands for more than ``LEAF_ROWS`` rows of the table;
  every row of the table is then put in its leaf of every tree. A leaf of more than
  ``PIECE_ROWS`` rows is dealt to several pieces.
* Search. All trees share one priority queue: the next node is the one whose
  squared distances to the planes crossed on the way sum to least. A query pops
  ``pops`` leaves, and more while they hold too few rows for an answer of k; rows
  and queries meet by leaf, and the rows found are ranked exactly.
* ``pops`` is measured, not guessed: for up to ``CALIBRATE`` queries the true
  neighbours are found by brute force over all rows, and ``pops`` is the least
  number of leaves that holds ``TARGET`` of them.

Scores are sums of products in component order, in doubles, so equal vectors have
equal scores.

Copies: of rows with equal vectors only the k + 1 smallest ids can be in an answer
(ties go to the smaller id, and one may be the query itself), so the others aren't
indexed; queries with equal vectors are searched once, and each drops its own id.
No answer changes by this. Rows whose vector is null, zero or holds null or
non-finite components, and rows with a null id, take no part; an id that repeats is
one row (its least vector); short vectors are padded with zeros. Empty tables give
no rows, fewer candidates than k all of them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .vectors import matrix, vector_rows

K = 20
TREES = 2
SAMPLE = 16384
LEAF_ROWS = 2048
LEAF_SAMPLE = 16
PIECE_ROWS = 4096
CALIBRATE = 200
TARGET = 0.95
BATCH = 256
HELD_ROWS = 1 << 19
SLACK = 1e-9
SEED = 7


class Forest:
    """Trees over sampled points; leaves ("cells") are numbered through."""

    def __init__(self, points: np.ndarray, share: float, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = SEED):
        """``share``: table rows that a sampled point stands for."""
        self.rng, self.cells = np.random.default_rng(seed), 0
        self.normals, self.cuts, self.below, self.above = [], [], [], []
        most = max(LEAF_SAMPLE, leaf_rows / share)
        self.roots = [self._grow(points, most) for _ in range(trees)]
        self.normals = np.array(self.normals).reshape(len(self.cuts), points.shape[1])
        self.cuts = np.array(self.cuts)

    def _grow(self, points: np.ndarray, most: float) -> int:
        """A node's number; leaf c is -1 - c."""
        if len(points) > most:
            a, b = points[self.rng.choice(len(points), 2, replace=False)]
            size = np.linalg.norm(a - b)
            along = points @ ((a - b) / size) if size else np.zeros(len(points))
            cut = float(np.median(along))
            up = along > cut
            if up.any():
                node = len(self.cuts)
                self.normals.append((a - b) / size)
                self.cuts.append(cut)
                self.below.append(0)
                self.above.append(0)
                self.below[node] = self._grow(points[~up], most)
                self.above[node] = self._grow(points[up], most)
                return node
        self.cells += 1
        return -self.cells

    def place(self, points: np.ndarray) -> np.ndarray:
        """The cell of every point in every tree (rows x trees)."""
        out = np.zeros((len(points), len(self.roots)), np.int32)
        for t, root in enumerate(self.roots):
            todo = [(root, np.arange(len(points)))]
            while todo:
                node, rows = todo.pop()
                if node < 0:
                    out[rows, t] = -1 - node
                elif len(rows):
                    up = points[rows] @ self.normals[node] > self.cuts[node]
                    todo += [(self.below[node], rows[~up]), (self.above[node], rows[up])]
        return out

    def search(self, points: np.ndarray, pops: int, counts: np.ndarray | None = None, least: int = 0) -> list[list[int]]:
        """Per point the first ``pops`` cells off the shared queue, and the next
        ones until the cells hold ``least`` rows by ``counts``."""
        out = []
        rows = [least] * self.cells if counts is None else counts.tolist()
        sides = points @ self.normals.T - self.cuts if len(self.cuts) else np.zeros((len(points), 0))
        for side in sides.tolist():
            queue, got = [(0.0, n, root) for n, root in enumerate(self.roots)], []
            count, have = len(queue), 0
            while queue and (len(got) < pops or have < least):
                cost, _, node = heapq.heappop(queue)
                while node >= 0:
                    near, far = (self.above, self.below) if side[node] > 0 else (self.below, self.above)
                    heapq.heappush(queue, (cost + side[node] ** 2, count, far[node]))
                    count, node = count + 1, near[node]
                got.append(-1 - node)
                have += rows[-1 - node]
            out.append(got)
        return out


def lifted(x: np.ndarray, most: float | None) -> np.ndarray:
    """Points of the metric space: rows (``most`` the largest square) or queries."""
    extra = np.zeros(len(x)) if most is None else np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))
    return np.column_stack([x, extra])


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed in component order."""
    return np.cumsum(queries * rows, axis=1)[:, -1] if queries.shape[1] else np.zeros(len(queries))


def top_rows(queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(query, row) places of each query's k best rows, with their exact scores.
    The matrix product only sifts: what comes within rounding of the k-th best
    is scored exactly."""
    table = queries @ rows.T
    floor = np.partition(table, len(ids) - k, axis=1)[:, [len(ids) - k]] if len(ids) > k else -np.inf
    q, r = np.nonzero(table >= floor - SLACK * (1 + np.abs(table).max(initial=0)))
    score = exact_scores(queries[q], rows[r])
    order = np.lexsort((ids[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], r[place < k], score[place < k]


def _batch(names: list[str], columns: list, kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def _truth(asks: np.ndarray, forest: Forest, most: float, k: int):
    """A task's rows to the k best of each calibration query, with their cells."""
    names, kinds = ["ask", "vec_id", "score", "cells"], [pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = matrix(batch.column("v"), asks.shape[1]), np.asarray(batch.column("vec_id"))
            q, r, score = top_rows(asks, ids, x, k)
            yield _batch(names, [q, ids[r], score, list(forest.place(lifted(x[r], most)))], kinds)

    return run


def _cells(forest: Forest, dim: int, most: float):
    """A task's rows to (cell, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(forest.cells, np.int64)
        for batch in batches:
            counts += np.bincount(forest.place(lifted(matrix(batch.column("v"), dim), most)).ravel(), minlength=forest.cells)
        yield _batch(["cell", "n"], [np.flatnonzero(counts), counts[counts > 0]], [pa.int32(), pa.int64()])

    return run


MEETING = "cell int, piece int, kind int, id long, v array<double>"
MEETING_NAMES = ["cell", "piece", "kind", "id", "v"]
MEETING_KINDS = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64())]


def _meeting(cell, piece, kind: int, ids, v) -> pa.RecordBatch:
    flat = pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1], v.ravel())
    return _batch(MEETING_NAMES, [cell, piece, np.full(len(ids), kind), ids, flat], MEETING_KINDS)


def _indexed(forest: Forest, pieces: np.ndarray, dim: int, most: float):
    """Rows to one row per tree, dealt to the pieces of their cell by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ids = matrix(batch.column("v"), dim), np.asarray(batch.column("vec_id"))
            cell = forest.place(lifted(x, most)).T.ravel()
            ids = np.tile(ids, len(forest.roots))
            piece = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % pieces[cell]
            yield _meeting(cell, piece, 0, ids, np.tile(x, (len(forest.roots), 1)))

    return run


def _probes(forest: Forest, pieces: np.ndarray, counts: np.ndarray, dim: int, pops: int, k: int):
    """Queries to one row per popped cell and piece. The trees hold a row each
    once, so cells with trees x (k + 1) rows hold k other rows at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH):
                part = batch.slice(first, BATCH)
                x, ids = matrix(part.column("v"), dim), np.asarray(part.column("vec_id"))
                cells = forest.search(lifted(x, None), pops, counts, len(forest.roots) * (k + 1))
                q = np.repeat(np.arange(len(x)), [len(c) for c in cells])
                cell = np.array([c for some in cells for c in some], np.int64)
                piece = np.concatenate([np.arange(n) for n in pieces[cell]] or [np.zeros(0, np.int64)])
                q, cell = np.repeat(q, pieces[cell]), np.repeat(cell, pieces[cell])
                for a in range(0, len(q), 4096):
                    some = q[a : a + 4096]
                    yield _meeting(cell[a : a + 4096], piece[a : a + 4096], 1, ids[some], x[some])

    return run


def _ranked(dim: int, k: int):
    """Cells in turn, their rows before their queries, to (ask, vec_id, score)."""
    names, kinds = ["ask", "vec_id", "score"], [pa.int64(), pa.int64(), pa.float64()]

    def merged(parts: list) -> tuple:
        """The k best different rows of each query over several cells."""
        ask, vec_id, score = (np.concatenate(c) for c in zip(*parts))
        order = np.lexsort((vec_id, -score, ask))
        ask, vec_id, score = ask[order], vec_id[order], score[order]
        new = np.r_[True, (np.diff(ask) != 0) | (np.diff(vec_id) != 0)]
        ask, vec_id, score = ask[new], vec_id[new], score[new]
        first = np.arange(len(ask)) - np.searchsorted(ask, ask) < k
        return ask[first], vec_id[first], score[first]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, rows, parts, size = None, [], [], [], 0
        for batch in batches:
            cell, piece, kind = (np.asarray(batch.column(c)).astype(np.int64) for c in ("cell", "piece", "kind"))
            own, x = np.asarray(batch.column("id")), matrix(batch.column("v"), dim)
            edges = np.flatnonzero(np.diff(cell) | np.diff(piece) | np.diff(kind)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(cell)]):
                if a == b:
                    continue
                if at != (cell[a], piece[a]):
                    at, ids, rows = (cell[a], piece[a]), [], []
                if kind[a] == 0:
                    ids.append(own[a:b])
                    rows.append(x[a:b])
                elif ids:
                    ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
                    for c in range(a, b, BATCH):
                        d = min(b, c + BATCH)
                        q, r, score = top_rows(x[c:d], ids[0], rows[0], k)
                        parts.append((own[c:d][q], ids[0][r], score))
                        size += len(q)
                        if size > HELD_ROWS:
                            parts = [merged(parts)]
                            size = len(parts[0][0])
                            if size > HELD_ROWS // 2:  # many queries: sent as they are
                                yield _batch(names, parts[0], kinds)
                                parts, size = [], 0
        if parts:
            yield _batch(names, merged(parts), kinds)

    return run


def _least(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vector_rows(df, id_col, vector_col).where("vec_id IS NOT NULL").where(F.exists("v", lambda c: c != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def nearest(
    candidates: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, leaf_rows: int = LEAF_ROWS, target: float = TARGET,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query."""
    spark = candidates.sparkSession
    copies = Window.partitionBy("v").orderBy("vec_id")
    rows = _least(candidates, id_col, vector_col).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    rows = stage(rows.drop("copy"), "rows")
    asked = stage(_least(queries, id_col, vector_col), "queries")
    square = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(square).alias("top")).first()
    if not facts["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, most = max(facts["dim"], asked.agg(F.max(F.size("v"))).first()[0] or 0), facts["top"]
    mixed = F.xxhash64("vec_id", "v")
    sample = matrix(rows.orderBy(mixed, "vec_id").limit(SAMPLE).select("v").toArrow()["v"], dim)
    forest = Forest(lifted(sample, most), max(1.0, facts["n"] / len(sample)), trees, leaf_rows)

    reps = stage(asked.groupBy("v").agg(F.min("vec_id").alias("vec_id")), "asks")
    pops = _pops(rows, reps.orderBy(mixed, "vec_id").limit(CALIBRATE).toArrow(), forest, dim, most, k, target)
    filled = rows.mapInArrow(_cells(forest, dim, most), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(forest.cells, np.int64)
    counts[np.asarray(filled["cell"])] = np.asarray(filled["n"])
    pieces = np.maximum(1, -(-counts // PIECE_ROWS))

    both = rows.mapInArrow(_indexed(forest, pieces, dim, most), MEETING)
    both = both.union(reps.mapInArrow(_probes(forest, pieces, counts, dim, pops, k), MEETING))
    both = both.repartition("cell", "piece").sortWithinPartitions("cell", "piece", "kind", "id")
    found = both.mapInArrow(_ranked(dim, k + 1), "ask long, vec_id long, score double")
    by_score = Window.partitionBy("ask").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("place", F.dense_rank().over(by_score)).where(F.col("place") <= k + 1).dropDuplicates(["ask", "place"])
    owners = asked.select(F.col("vec_id").alias("query_id"), "v").join(reps.select(F.col("vec_id").alias("ask"), "v"), "v")
    found = owners.select("query_id", "ask").join(found.drop("place"), "ask").where("vec_id <> query_id")
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _pops(rows: DataFrame, asks: pa.Table, forest: Forest, dim: int, most: float, k: int, target: float) -> int:
    """The least number of popped cells that holds ``target`` of the true
    neighbours of the calibration queries."""
    if not asks.num_rows:
        return 1
    own, points = np.asarray(asks["vec_id"]), matrix(asks["v"], dim)
    best = Window.partitionBy("ask").orderBy(F.col("score").desc(), "vec_id")
    truth = rows.mapInArrow(_truth(points, forest, most, k + 1), "ask int, vec_id long, score double, cells array<int>")
    truth = truth.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).orderBy("ask", "place").collect()
    order = np.zeros((len(own), forest.cells), np.int64)
    for line, cells in zip(order, forest.search(lifted(points, None), forest.cells)):
        line[cells] = np.arange(1, len(cells) + 1)
    needed = sorted(min(order[r.ask, c] for c in r.cells) for r in truth if r.vec_id != own[r.ask])
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) if needed else 1
