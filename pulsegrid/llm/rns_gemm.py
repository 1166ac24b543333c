"""Hard-negative mining with scores from a residue-number-system product.

Components become floor(256 * x). Anchors and candidates are reduced modulo a few
primes below 1024 (centred residues, float32). A product of residue matrices has
entries below 2**24, so float32 holds it exactly (longer vectors are multiplied in
runs of components and reduced between them). As many primes are taken as the
largest possible score asks for; Garner's mixed-radix digits then give the exact
signed scores by Chinese remaindering.

Rows are dealt out evenly, without a key, to shards of ``shard_rows`` rows, so
copies and repeats spread like any other rows; anchors (a stated query set) meet
every shard in blocks of ``block``, both read from where they are staged. Two
passes over the shards: the first keeps an anchor's ``positives`` best rows of its
label, the second, per positive, the best ``negatives`` rows of other labels inside
its window of scores, found in the score matrix of anchor block and shard. Windows
of both passes merge over shards by a partial top-k, so a shard sends at most so
many rows per anchor.

Rows with a null id, label or vector, or a null or non-finite component take no
part; shorter vectors are padded with zeros. An anchor's own rows are those with
its vec_id; a vec_id that repeats among the anchors is one anchor (its least label
and vector). Repeated rows each take a place among positives and negatives. A
window that is empty (positive scores below zero) gives no negatives. Scores
beyond a long are held at the ends of its range. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import every_pair, stage
from .vectors import as_long, floors, matrix, narrow, vector_rows, widened

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score, in hundredths of its positive's.
WINDOW = (50, 95)
SHARD_ROWS = 8192
BLOCK = 256
FLOAT32_EXACT = 1 << 24
LONG_SAFE = 1 << 62


def _primes() -> list[int]:
    """Primes below 1024, largest first."""
    return [n for n in range(1023, 2, -1) if all(n % d for d in range(2, 33) if d < n)]


def primes_for(bound: int) -> list[int]:
    """Primes whose product tells whole numbers from -bound to bound apart."""
    chosen, product = [], 1
    for p in _primes():
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    return chosen or [1021]


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Centred residues of a matrix of integers, per prime, as float32."""
    out = []
    for p in primes:
        r = np.mod(x, p)
        out.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return out


def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a @ b.T modulo p; every float32 sum stays below 2**24."""
    run = max(1, (FLOAT32_EXACT - 1) // (p // 2) ** 2)
    total = None
    for d in range(0, max(1, a.shape[1]), run):
        part = np.mod((a[:, d : d + run] @ b[:, d : d + run].T).astype(np.int32), p)
        total = part if total is None else np.mod(total + part, p)
    return total


def scores(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact signed inner products from the residues of two matrices."""
    digits: list[np.ndarray] = []
    for i, p in enumerate(primes):
        known = np.zeros((a[i].shape[0], b[i].shape[0]), np.int32)
        for digit, q in zip(digits[::-1], primes[:i][::-1]):  # the number so far, modulo p
            known = np.mod(known * (q % p) + digit, p)
        inverse = pow(int(np.prod(np.array(primes[:i], dtype=object))) if i else 1, -1, p)
        digits.append(np.mod((_product(a[i], b[i], p) - known) * inverse, p))
    whole = 1
    for p in primes:
        whole *= p
    kind = np.int64 if whole < LONG_SAFE else object
    value = digits[-1].astype(kind)
    for digit, q in zip(digits[-2::-1], primes[-2::-1]):
        value = value * q + digit
    return np.where(value > whole // 2, value - whole, value)


def best(row: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest values, largest first, ties to the lower place."""
    some = np.arange(len(row))
    if len(row) > k:
        some = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
    return some[np.argsort(-row[some], kind="stable")][:k]


#: Packed rows: the runs of ids, labels and goals as 64-bit integers, of components as the narrowest that hold them.
KIND = pa.schema([("shard", pa.int64()), ("dim", pa.int32()), ("top", pa.int64())] + [(c, pa.binary()) for c in ("ids", "labels", "data", "goals", "goal_ids", "goal_scores")])
PACKED = "shard long, dim int, top long, ids binary, labels binary, data binary, goals binary, goal_ids binary, goal_scores binary"


def _pack(size: int, stride: int, scale: int):
    """Rows of a task to packed rows of up to ``size`` rows, sorted by id, numbered
    by task and, ``stride`` apart, within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(table: pa.Table) -> pa.RecordBatch:
            nonlocal number
            table = table.sort_by("vec_id")
            x = floors(matrix(table["v"]), scale)
            row = {"shard": number, "dim": x.shape[1], "top": int(np.abs(x).max(initial=0)), "data": narrow(x)}
            row |= {"ids": table["vec_id"], "labels": table["label"], "goals": [], "goal_ids": [], "goal_scores": []}
            if "goals" in table.column_names:
                goals = table["goals"].combine_chunks()
                flat = goals.flatten()
                row |= {"goals": pa.compute.list_value_length(goals), "goal_ids": flat.field("positive_id"), "goal_scores": flat.field("positive_score")}
            number += stride
            row = {c: np.asarray(v).astype("<i8").tobytes() if KIND.field(c).type == pa.binary() and c != "data" else v for c, v in row.items()}
            return pa.RecordBatch.from_pylist([row], schema=KIND)

        number, held, count = TaskContext.get().partitionId(), [], 0
        for batch in batches:
            held.append(pa.table(batch))
            count += batch.num_rows
            while count >= size:
                table = pa.concat_tables(held)
                yield packed(table.slice(0, size))
                held, count = [table.slice(size)], count - size
        if count:
            yield packed(pa.concat_tables(held))

    return run


def _longs(cell: bytes) -> np.ndarray:
    return np.frombuffer(cell, "<i8")


def _padded(row: dict, prefix: str, dim: int) -> np.ndarray:
    x = widened(row[prefix + "data"], len(_longs(row[prefix + "ids"])), row[prefix + "dim"])
    return np.pad(x, ((0, 0), (0, dim - x.shape[1])))


def _tiles(primes: list[int], dim: int, pick, names: list[str]):
    """Runs ``pick(row, scores, same label, other rows, ids)`` on every pair of
    anchor block and shard; it returns the columns to send."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["shard"] != held:
                    held, shard = row["shard"], residues(_padded(row, "", dim), primes)
                ids, labels = _longs(row["ids"]), _longs(row["labels"])
                a_ids, a_labels = _longs(row["a_ids"]), _longs(row["a_labels"])
                table = scores(residues(_padded(row, "a_", dim), primes), shard, primes)
                columns = pick(row, table, a_labels[:, None] == labels, a_ids[:, None] != ids, ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def _near(k: int):
    """The ``k`` best rows of an anchor's label."""

    def pick(row, table, same, other, ids):
        out = [], [], []
        for anchor, line, some in zip(_longs(row["a_ids"]).tolist(), table, same & other):
            some = np.flatnonzero(some)
            for place in some[best(line[some], k)].tolist():
                for column, value in zip(out, (anchor, int(ids[place]), as_long(line[place]))):
                    column.append(value)
        return out

    return pick


def _hard(k: int, window: tuple[int, int]):
    """Per goal of an anchor, the ``k`` best rows of other labels in its window."""
    low, high = window

    def pick(row, table, same, other, ids):
        out = [], [], [], [], []
        counts = _longs(row["a_goals"])
        ends = np.cumsum(counts)
        goal_ids, goal_scores = _longs(row["a_goal_ids"]).tolist(), _longs(row["a_goal_scores"]).tolist()
        for anchor, line, some, end, count in zip(_longs(row["a_ids"]).tolist(), table, ~same & other, ends.tolist(), counts.tolist()):
            some = np.flatnonzero(some)
            line = line[some]
            for goal in range(end - count, end):
                score = goal_scores[goal]
                least, most = -(-low * score // 100), high * score // 100
                within = np.flatnonzero((line >= as_long(least)) & (line <= as_long(most)))
                for place in within[best(line[within], k)].tolist():
                    for column, value in zip(out, (anchor, goal - end + count + 1, goal_ids[goal], int(ids[some[place]]), as_long(line[place]))):
                        column.append(value)
        return out

    return pick


def hard_negatives(
    df: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW, shard_rows: int = SHARD_ROWS, block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors`` picks the anchors among the rows (in terms of vec_id), ``label``
    is each row's label (in terms of the columns of ``df``)."""
    spark = df.sparkSession
    rows = vector_rows(df, id_col, vector_col, label.cast("long").alias("label")).where("vec_id IS NOT NULL AND label IS NOT NULL")
    parts = max(1, min(-(-df.count() // shard_rows), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shards = stage(rows.repartition(parts).mapInArrow(_pack(shard_rows, parts, scale), PACKED), "shards")
    asked = rows.where(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    asked = stage(asked, "anchors")
    facts = shards.agg(F.max("dim").alias("dim"), F.max("top").alias("top")).first()
    dim, top = facts["dim"] or 1, facts["top"] or 0
    primes = primes_for(dim * top * top)

    def meet(blocks: DataFrame, pick, names: list[str]) -> DataFrame:
        blocks = stage(blocks.mapInArrow(_pack(block, 1, scale), PACKED).drop("shard", "top"), "blocks")
        blocks = blocks.select(*[F.col(c).alias(f"a_{c}") for c in blocks.columns])
        pairs = every_pair(shards, blocks, blocks.count())
        return pairs.mapInArrow(_tiles(primes, dim, pick, names), ", ".join(f"{n} long" for n in names))

    by_score = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    found = meet(asked, _near(positives), ["anchor_id", "positive_id", "positive_score"])
    found = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives)
    goals = found.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("goals"))
    goals = stage(asked.join(goals.hint("merge"), "vec_id"), "positives")  # anchors grow with the rows: never to the driver

    found = meet(goals, _hard(negatives, window), ["anchor_id", "place", "positive_id", "negative_id", "negative_score"])
    by_score = Window.partitionBy("anchor_id", "place").orderBy(F.col("negative_score").desc(), "negative_id")
    found = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= negatives)
    scored = goals.select(F.col("vec_id").alias("anchor_id"), F.inline("goals")).select("anchor_id", F.col("place").cast("long").alias("place"), "positive_score")
    found = found.join(scored.hint("merge"), ["anchor_id", "place"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) v FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id anchor_id, c.vec_id, a.label = c.label same,
        CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])) AS BIGINT) score
      FROM e a JOIN e c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id positive_id, score positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id negative_id, p.positive_score, s.score negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) rn
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rn AS INTEGER) AS "rank", negative_id, positive_score, negative_score FROM n WHERE rn <= 3
"""
