import random

import numpy as np

from pulsegrid.llm import compact_windows as W
from pulsegrid.llm import mtree
from pulsegrid.llm.common import RIGHT_ROWS, every_pair, stage


def brute_top(rows, k):
    good = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in good:
        if q % 100 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


def test_top_k_equals_brute_force(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 1) for _ in range(6)]) for k in range(900)]
    rows += [(1000 + k, [0.25] * 6) for k in range(700)]  # one very common vector: ties
    rows += [(2000, None), (2100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2200, [float("nan")] * 6), (2300, [float("inf")] * 6), (None, [1.0] * 6), (2400, []), (2500, [9.0])]
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, score int, v string")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = mtree.top_k(df, df.where("vec_id % 100 = 0"), 10, shard_rows=300, block=7)
    assert {tuple(r) for r in got.collect()} == brute_top(rows, 10)
    assert mtree.top_k(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id IN (0, 1, 2)")
    assert mtree.top_k(few, few.where("vec_id = 0")).count() == 2


def test_tree_avoids_distances():
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 3000, (20, 8))
    v = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(0, 40, (4000, 8)))
    tree = mtree.MTree(np.arange(4000), v, int((v * v).sum(axis=1).max()))
    for q in range(0, 4000, 400):
        got = tree.search(q, v[q], 10)
        want = sorted((-int(v[q] @ v[i]), i) for i in range(4000) if i != q)[:10]
        assert got == [(-s, i) for s, i in want]
    assert tree.avoided > 0 and tree.computed < 0.5 * 10 * 4000


def test_every_pair_keeps_the_pairs_of_a_left_row_together(spark):
    n = 2 * RIGHT_ROWS + 3
    left, right = (stage(spark.range(m).toDF(c).repartition(5), "sides") for m, c in ((7, "a"), (n, "b")))
    parts = every_pair(left, right, n).rdd.glom().collect()
    assert sorted((r.a, r.b) for p in parts for r in p) == [(a, b) for a in range(7) for b in range(n)]
    for p in parts:
        kept = [r.a for i, r in enumerate(p) if not i or p[i - 1].a != r.a]
        assert len(kept) == len(set(kept))
    none = spark.range(0).toDF("b")
    assert every_pair(left, none, 0).count() == every_pair(none, right.toDF("c"), n).count() == 0


def test_query_blocks_are_never_broadcast(spark):
    """Every shard's copy of the queries, whose size Spark underrates, went to the driver."""
    rng = random.Random(2)
    df = spark.createDataFrame([(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(1200)], "vec_id long, embedding array<float>")
    got = mtree.top_k(df, df.where("vec_id % 4 = 0"), 2, shard_rows=100, block=10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
    assert got.count() == 600


def test_wide_values_stay_exact(spark):
    rows = [(k, [2.0**17 + k, -(2.0**16)]) for k in range(0, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in mtree.top_k(df, df.where("vec_id = 0"), 3).collect()} == brute_top(rows, 3)


def test_compact_windows_are_the_cartesian_tree():
    rng = np.random.default_rng(5)
    counts = np.array([0, 60, 46, 45, 200])
    s = rng.integers(0, 2**63, int(counts.sum())).astype(np.uint64)
    s[70:80] = s[20:30]
    l, c, r, owner, *_ = W.compact_windows(s, counts, 1)
    v = W._mix(s * np.uint64((int(W._ODD) * 5) % 2**64 | 1))
    got, want, at = {tuple(map(int, x)) for x in zip(owner, l, c, r)}, set(), 0
    for d, n in enumerate(counts):
        own = v[at : at + n].tolist()
        todo = [(0, n - 1)]
        while todo:
            a, b = todo.pop()
            if b - a + 1 >= W.SPAN:
                m = min(range(a, b + 1), key=lambda i: own[i])
                want.add((d, a, m, b))
                todo += [(a, m - 1), (m + 1, b)]
        at += n
    assert got == want


def shared_words(x, y):
    """Documents share at least 50 words in a row."""
    rows = {tuple(x[i : i + 50]) for i in range(len(x) - 49)}
    return any(tuple(y[i : i + 50]) in rows for i in range(len(y) - 49))


def test_passages_equal_brute_force(spark, sentence_of):
    rng = random.Random(8)
    common = [sentence_of(rng, n) for n in (50, 55, 80, 49, 30)]
    docs = []
    for k in range(90):
        parts = [sentence_of(rng, rng.randint(0, 90))]
        for p in rng.sample(common, rng.randint(0, 2)):
            parts += [p.upper() if k % 5 == 0 else p, sentence_of(rng, rng.randint(0, 40))]
        docs.append((k, "\n".join(parts)))
    docs += [(200, docs[3][1]), (201, None), (202, ""), (None, docs[4][1]), (203, "short copy"), (204, "short copy")]
    text = {k: (t or "").lower().split() for k, t in docs if k is not None}
    root = {k: k for k in text}
    linked = set()
    for x in text:
        for y in text:
            if x < y and (shared_words(text[x], text[y]) or len(text[x]) >= 50 and text[x] == text[y]):
                linked |= {x, y}
                a, b = sorted((root[x], root[y]))
                root = {k: a if v == b else v for k, v in root.items()}
    linked |= {4, None}
    df = spark.createDataFrame([(*d, 1, "z") for d in docs], "doc_id long, text string, key int, passages string").repartition(7)
    got = {r.doc_id: r for r in W.repeated_passages(df).collect()}
    assert set(got) == linked
    assert all(got[k].class_id == root[k] for k in linked if k is not None) and got[None].class_id == got[4].class_id
    for k in linked - {None, 4, 3, 200}:
        assert got[k].n_words == sum(p["last"] - p["first"] + 1 for p in got[k].passages) >= 50
    assert W.repeated_passages(df.limit(0)).count() == 0


def test_near_passages_are_found(spark, sentence_of):
    rng = random.Random(4)
    docs, pairs = [], []
    for k in range(40):
        p = sentence_of(rng, 120).split()
        q = p[:60] + ["changed"] + p[61:]
        docs += [(2 * k, " ".join([sentence_of(rng, 50), *p, sentence_of(rng, 20)])), (2 * k + 1, " ".join([sentence_of(rng, 9), *q]))]
        pairs.append((2 * k, 2 * k + 1))
    docs += [(1000 + k, sentence_of(rng, 100)) for k in range(20)]
    got = {r.doc_id: r.class_id for r in W.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {x: a for a, b in pairs for x in (a, b)}


def test_pairs_around_boilerplate_are_found(spark, sentence_of):
    rng = random.Random(6)
    line = sentence_of(rng, 45)
    docs, pairs = [], {}
    for k in range(300):
        docs.append((k, " ".join([sentence_of(rng, 30), line, sentence_of(rng, 30)])))
    for k in range(300, 340, 2):  # ten more words of the line's surroundings, before or after it
        more = sentence_of(rng, 10)
        for j in (k, k + 1):
            about = [more, line] if k % 4 else [line, more]
            if k % 3 == 0:  # the line once more, elsewhere
                about = [line, sentence_of(rng, 30), *about]
            docs.append((j, " ".join([sentence_of(rng, 30), *about, sentence_of(rng, 30)])))
            pairs[j] = k
    got = W.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.class_id for r in got} == pairs
    assert all(55 <= r.n_words <= 57 for r in got)


def test_near_copies_around_a_common_line_are_found(spark, sentence_of):
    rng = random.Random(8)
    line = sentence_of(rng, 42)
    docs, pairs = [], {}
    for k in range(240):
        docs.append((k, " ".join([sentence_of(rng, 30), line, sentence_of(rng, 30)])))
    for k in range(300, 380, 2):  # 58 words with a changed one inside the line: no 50 equal words
        before, after = sentence_of(rng, 8), sentence_of(rng, 8)
        for j in (k, k + 1):
            about = line.split()
            if j > k:
                about[20] = "changed"
            docs.append((j, " ".join([sentence_of(rng, 30), before, *about, after, sentence_of(rng, 30)])))
            pairs[j] = k
    got = W.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.class_id for r in got} == pairs
    assert all(58 <= r.n_words <= 60 for r in got)


def test_texts_of_one_class_are_not_all_compared(spark, sentence_of, monkeypatch):
    rng = random.Random(9)
    common, docs = sentence_of(rng, 400).split(), []
    for k in range(150):  # near copies, every word changed with probability 1 / 40
        docs.append((k, " ".join(sentence_of(rng, 1) + "x" if rng.random() < 1 / 40 else w for w in common)))
    compared, similar_pairs = [], W.similar_pairs
    monkeypatch.setattr(W, "similar_pairs", lambda own: compared.append(similar_pairs(own)) or compared[0])
    got = W.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: r.class_id for r in got} == {k: 0 for k in range(150)}
    assert compared[0].count() < 20 * 150


def test_alive_ranges_equal_brute_force():
    rng = np.random.default_rng(2)
    for share in (0.8, 0.88, 0.92, 0.97):
        match = rng.random(150) < share
        sums, want = np.concatenate(([0], np.cumsum(match))), np.zeros(150, bool)
        for i in range(150):
            for j in range(i + W.SPAN, 151):
                if 9 * (sums[j] - sums[i]) >= 8 * (j - i):
                    want[i:j] = True
        assert (W._alive(match) == want).all()


def test_runs_leave_a_shared_shingle_out():
    p = np.r_[0, np.arange(10, 55), np.arange(80, 84)]
    n = np.r_[2, np.full(45, 400), np.full(4, 2)]
    assert p[W.outside_runs(p, n)].tolist() == [0]
    assert W.outside_runs(np.arange(46), np.ones(46, int)).sum() == 1


def test_a_text_of_one_word_meets_others(spark):
    docs = [(1, "w " * 5000), (2, "w " * 300), (3, "v " * 49)]
    got = {r.doc_id: (r.class_id, r.n_words) for r in W.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: (1, 5000), 2: (1, 300)}


def test_verify_measures_similarity():
    a = np.arange(200, dtype=np.uint32)
    b = np.r_[np.arange(900, 950), a[20:140], np.arange(950, 990)].astype(np.uint32)
    assert W.verify(a, b) and W.verify(a, b)[0][0] <= 20 and W.verify(a[:60], b[:60]) == []
