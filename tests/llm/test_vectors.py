import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import bisectors, rns_gemm, rp_forest
from pulsegrid.llm.vectors import narrow, widened

ODD = [(None, [1.0] * 6), (9001, None), (9002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (9003, [float("nan")] * 6), (9004, [float("inf")] * 6)]
SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, score int, v string, rank int"


def frame(spark, rows, labels=None):
    return spark.createDataFrame([(i, v, None if labels is None else labels[k], "c", 3, "x", 1) for k, (i, v) in enumerate(rows)], SCHEMA).repartition(5)


def read(df):
    """(vec_id, vector, label) of the rows that take part, as stored."""
    out = []
    for r in df.collect():
        if r.vec_id is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            out.append((r.vec_id, r.embedding, r.label))
    return out


# --- bisector tournament ---------------------------------------------------


def brute_clusters(rows, k, rounds, dim):
    """rows: (vec_id, vector). One entry (vec_id, cluster, distance) a row."""
    kept = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if len(v) == dim]
    start = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centres = [list(v) for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        owner = [nearest(v)[1] for _, v in kept]
        for j in range(len(centres)):
            own = [v for (_, v), o in zip(kept, owner) if o == j]
            if own:
                centres[j] = [sum(c) // len(own) for c in zip(*own)]
    return [(i, *nearest(v)[::-1]) for i, v in kept], centres


def rounded(rows):
    return [(i, [float(np.float32(x)) for x in v]) for i, v in rows]


def test_clusters_equal_brute_force(spark):
    rng = random.Random(5)
    rows = rounded([(k, [rng.gauss(0, 1) for _ in range(6)]) for k in range(400)])
    rows += [(1000 + k, [0.25] * 6) for k in range(150)] + [(7, rows[7][1]), (8, [0.5] * 6)]  # one common vector; repeated ids
    odd = [*ODD[1:], (9005, []), (9006, [1.0] * 5), (9007, [1.0] * 7)]
    want, centres = brute_clusters(rows + [(None, [1.0] * 6)], 12, 5, 6)
    df = frame(spark, rows + [(None, [1.0] * 6)] + odd)
    got = bisectors.clusters(df, k=12, rounds=5, dim=6).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in got) == sorted((i is None, i or 0, c, d) for i, c, d in want)
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) and r.inertia == sum(d for *_, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()


def test_clusters_of_few_equal_and_no_rows(spark):
    rows = [(k, [1.0, -2.0]) for k in range(5)]
    got = bisectors.clusters(frame(spark, rows), k=40, dim=2).collect()
    assert {(r.vec_id, r.cluster, r.distance, r.inertia) for r in got} == {(k, 0, 0, 0) for k in range(5)}
    assert bisectors.clusters(frame(spark, rows).limit(0), dim=2).collect() == []
    assert bisectors.clusters(frame(spark, rows), dim=3).collect() == []  # no vector of that length


def test_tournament_ties_and_wide_numbers():
    two = bisectors.Bisectors([[0, 0], [4, 0], [0, 4]])
    winner, square = two.assign(np.array([[2, 0], [2, 2], [3, 1], [0, 2]], dtype=np.float64))
    assert winner.tolist() == [0, 0, 1, 0] and square.tolist() == [4, 8, 2, 4]
    far = [[2**60, -(2**61)], [2**60 + 1, -(2**61)], [0, 3]]
    wide = bisectors.Bisectors(far)
    assert wide.kind(5) is object and two.kind(2**40) is object and two.kind(10) is np.float64
    winner, square = wide.assign(np.array([far[1], far[2]], dtype=object))
    assert winner.tolist() == [1, 2] and square.tolist() == [0, 0]


def test_wide_components_cluster_exactly(spark):
    rows = rounded([(k, [2.0**40 * (k % 3), float(k)]) for k in range(30)])
    want, _ = brute_clusters(rows, 4, 3, 2)
    got = bisectors.clusters(frame(spark, rows), k=4, rounds=3, dim=2).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted((i, c, min(d, 2**63 - 1)) for i, c, d in want)


# --- residue scores and hard negatives -------------------------------------


@pytest.mark.parametrize("most, dim", [(3, 5), (200, 64), (10**6, 300), (2**40, 7), (1, 1)])
def test_residue_scores_are_exact(most, dim):
    rng = np.random.default_rng(1)
    a, b = rng.integers(-most, most + 1, (9, dim)), rng.integers(-most, most + 1, (31, dim))
    a[0], b[0], b[1] = most, most, -most  # the ends of the range
    primes = rns_gemm.primes_for(dim * most * most)
    got = rns_gemm.scores(rns_gemm.residues(a, primes), rns_gemm.residues(b, primes), primes)
    assert (got == a.astype(object) @ b.T.astype(object)).all()


@pytest.mark.parametrize("low, high, width", [(-128, 127, 1), (-129, 0, 2), (0, 128, 2), (-(2**15), 2**15, 4), (-(2**31) - 1, 0, 8), (-(2**63), 2**63 - 1, 8)])
def test_packed_integers_come_back(low, high, width):
    x = np.array([[low, high, 0], [high, 1, low]], np.int64)
    assert len(narrow(x)) == 6 * width and np.array_equal(widened(narrow(x), 2, 3), x)
    assert widened(narrow(x[:, :0]), 2, 0).shape == (2, 0) and widened(narrow(x[:0]), 0, 3).shape == (0, 3)


def brute_negatives(rows, anchors):
    rows = [(i, [int(np.floor(256 * x)) for x in v], (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows if lab is not None]
    out = []
    for a in {i for i, *_ in rows if i % anchors == 0}:
        lab, v = min((lab, v) for i, v, lab in rows if i == a)
        score = lambda w: sum(x * y for x, y in zip(v, w))
        others = sorted((-score(w), i, l == lab) for i, w, l in rows if i != a)
        for s, p, _ in [o for o in others if o[2]][:5]:
            hard = [o for o in others if not o[2] and 50 * -s <= 100 * -o[0] <= 95 * -s][:3]
            out += [(a, p, r, n, -s, -t) for r, (t, n, _) in enumerate(hard, 1)]
    return sorted(out)


def mined(df, anchors, **options):
    own = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (own + 1) % 10).otherwise(own)
    return rns_gemm.hard_negatives(df, F.col("vec_id") % anchors == 0, label, **options)


def test_hard_negatives_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(0.2, 1) for _ in range(6)]) for k in range(500)]
    rows += [(1000 + k, [0.25] * 6) for k in range(300)]  # one common vector under all labels
    rows += [rows[3], rows[3], rows[30], (60, [0.5] * 6), (2010, [0.0] * 6), (2020, []), (2030, [9.0]), *ODD]
    labels = [rng.choice([0, 1, 2, None]) for _ in rows]
    df = frame(spark, rows, labels)
    want = brute_negatives(read(df), 30)
    got = mined(df, 30, shard_rows=70, block=4).collect()
    assert sorted(tuple(r) for r in got) == want and len(want) > 100
    assert sorted(tuple(r) for r in mined(df, 30).collect()) == want
    assert mined(df.limit(0), 30).count() == 0
    assert mined(df.where("vec_id IN (0, 1)"), 30).count() == 0


def test_anchor_blocks_are_never_broadcast(spark, monkeypatch):
    """Every shard's copy of the anchors, whose size Spark underrates, went to the driver."""
    plans = {}
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()

    def staged(df, label):
        plans[label] = plan_of(df)
        return kept(df, label)

    kept = rns_gemm.stage
    monkeypatch.setattr(rns_gemm, "stage", staged)
    rng = random.Random(5)
    rows = [(k, [rng.gauss(0.2, 1) for _ in range(6)]) for k in range(400)]
    df = frame(spark, rows, [k % 3 for k in range(400)])
    got = mined(df, 10, shard_rows=70, block=4)
    plans["result"] = plan_of(got)
    assert "CartesianProduct" in plans["positives"] and "CartesianProduct" in plans["result"]
    assert not [label for label, plan in plans.items() if "Broadcast" in plan]
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(read(df), 10)


def test_wide_hard_negatives_stay_exact(spark):
    rows = [(k, [2.0**20 + k, -(2.0**19), 3.0 * k]) for k in range(60)]
    df = frame(spark, rows, [k % 3 for k in range(60)])
    assert sorted(tuple(r) for r in mined(df, 10).collect()) == brute_negatives(read(df), 10)


# --- forest of random-projection trees -------------------------------------


def brute_nearest(rows, every, k):
    least = {}
    for i, v, _ in rows:
        if any(v) and (i not in least or v < least[i]):
            least[i] = v
    score = lambda a, b: float(np.cumsum(np.array(a)[: len(b)] * np.array(b)[: len(a)])[-1])
    out = {}
    for q in least:
        if q % every == 0:
            out[q] = sorted((-score(least[q], v), i) for i, v in least.items() if i != q)[:k]
    return out


def found(df, **options):
    out = {}
    for r in rp_forest.nearest(df, df.where("vec_id % 20 = 0"), **options).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len(set(got.get(q, [])) & set(w)) for q, w in want.items()) / sum(map(len, want.values()))


def test_forest_recall_and_exact_scores(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (4000, 24)) * rng.uniform(0.5, 1.5, (4000, 1))
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(5000 + k, [2.0] * 24) for k in range(900)]  # copies: ties to the smaller id
    rows += [rows[20], (40, [9.0] * 24), (6000, [0.0] * 24), (6020, []), (6040, [2.0]), *ODD]
    df = frame(spark, rows)
    want = brute_nearest(read(df), 20, 20)
    got = found(df, leaf_rows=128)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    truth = {i: v for i, v, _ in read(df)}
    for q in (0, 5000, 5880):
        for s, i in got[q]:
            assert i != q and -s == pytest.approx(float(np.dot(truth[q], truth[i])), abs=1e-12)
    assert got[5000] == want[5000] and got[5880] == want[5880]  # all copies tie


def test_forest_of_few_and_no_rows(spark):
    df = frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0, 1.0]), (20, [3.0, 3.0])])
    assert found(df) == brute_nearest(read(df), 20, 20)
    assert found(df.limit(0)) == {} and found(df.where("vec_id = 1")) == {} and found(df.where("vec_id = 0")) == {}


def test_forest_search_visits_nearest_cells_first_and_then_all():
    rng = np.random.default_rng(0)
    points = rng.normal(0, 1, (3000, 8))
    forest = rp_forest.Forest(points, 1.0, trees=3, leaf_rows=100)
    cells = forest.place(points)
    assert (np.bincount(cells.ravel(), minlength=forest.cells) > 0).all() and np.bincount(cells[:, 0]).max() <= 100
    order = forest.search(points[:50], forest.cells)
    assert all(sorted(o) == list(range(forest.cells)) for o in order)
    assert all(set(o[:3]) == set(c.tolist()) for o, c in zip(order, cells[:50]))  # its own cells cost nothing


def test_hot_cell_is_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(rp_forest, "PIECE_ROWS", 50)
    rng = np.random.default_rng(3)
    rows = [(k, (1 + 1e-4 * rng.normal(0, 1, 5)).tolist()) for k in range(600)]  # near copies in one leaf
    df = frame(spark, rows)
    assert recall(found(df, leaf_rows=1000), brute_nearest(read(df), 20, 20)) == 1.0
