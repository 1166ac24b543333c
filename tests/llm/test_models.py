import math
import random
import zlib
from collections import Counter

import numpy as np

from pulsegrid.llm import gru_lm, langid, toxicity
from pulsegrid.llm.common import table

SF = "/root/testdata/sf0.01"


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    marks = [(r.toxic, got[r.doc_id].predicted, got[r.doc_id].held_out) for r in labels.collect() if r.doc_id in got]
    train = [(t, p) for t, p, h in marks if not h]
    assert sum(t == p for t, p in train) / len(train) > 0.95  # some 45 toxic documents teach
    assert not any(p for t, p, h in marks if t == 0 and h)


def test_toxicity_odd_rows(spark, odd_docs, no_docs):
    none = labelled(spark, [])
    assert {r.score for r in toxicity.score_documents(odd_docs, none).collect()} == {0.0}
    one = labelled(spark, [(k, 1, 0) for k in range(20)] + [(None, 1, 1), (3, None, None), (3, 0, 0)])
    rows = toxicity.score_documents(odd_docs, one).collect()
    assert len(rows) == odd_docs.count() and all(r.score < 0.5 for r in rows)
    mixed = labelled(spark, [(k, 1, k % 2) for k in range(40)])
    rows = toxicity.score_documents(odd_docs, mixed).collect()
    assert len(rows) == odd_docs.count() and len({r.score for r in rows if r.doc_id in (100, 101, 102)}) == 1
    assert toxicity.score_documents(no_docs, mixed).count() == 0


def test_toxicity_blocks_do_not_change_scores():
    rng = random.Random(1)
    texts = ["".join(rng.choices("ab cd.", k=rng.randint(0, 80))) for _ in range(60)]
    model = toxicity.fit(texts, [int("abc" in t) for t in texts])
    whole = toxicity.score_texts(texts + [None], model)
    assert np.allclose(whole, [toxicity.score_texts([t], model)[0] for t in texts + [None]])


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    held = [(r.lang, got[r.doc_id].lang_pred) for r in docs.collect() if got[r.doc_id].held_out]
    assert len(got) == docs.count() and sum(a == b for a, b in held) / len(held) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(spark, odd_docs, no_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (100, 101, 102, 103)} == {"und"}
    assert {r.lang_pred for r in rows} <= {"aa", "bb", "und"}
    assert langid.identify(no_docs).count() == 0
    assert {r.lang_pred for r in langid.identify(odd_docs.withColumn("lang", odd_docs["lang"].substr(9, 1)).where("lang IS NULL")).collect()} == {"und"}


def test_language_tables_equal_convolution():
    rng = np.random.default_rng(1)
    net = langid.ByteNet(["a", "b", "c"])
    x = rng.integers(0, 256, (5, langid.WINDOW)).astype(np.uint8)
    h = []
    for w in langid.WIDTHS:
        e, span = net.p["embed"][x], langid.WINDOW - w + 1
        act = sum(e[:, j : j + span] @ net.p[f"conv{w}"][j] for j in range(w))
        h.append(act.max(axis=1) + net.p[f"bias{w}"])
    want = np.maximum(np.concatenate(h, axis=1), 0) @ net.p["out"] + net.p["out_bias"]
    assert np.allclose(net.logits(x, net.tables()), want, atol=1e-4)


def small_scorer(texts):
    count = Counter(w for t in texts for w in gru_lm.words(t))
    sums, types = np.zeros(gru_lm.TAILS), np.zeros(gru_lm.TAILS)
    for w, n in count.items():
        sums[gru_lm.tail_of(w)] += n
        types[gru_lm.tail_of(w)] += 1
    head = sorted(count.items(), key=lambda x: (-x[1], x[0]))
    return gru_lm.Scorer(head, sum(count.values()) + len(texts), len(count) + 1, len(texts), sums, types)


def test_gru_gradients_and_windows():
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["a", "b", "cc", "dd", "eee"], k=rng.randint(1, 90))) for _ in range(30)]
    s = small_scorer(texts)
    docs = [s.tokens_of(gru_lm.words(t))[0] for t in texts]
    s.net.fit(docs, epochs=1)
    s.net.p = {k: v.astype(np.float64) for k, v in s.net.p.items()}
    tokens, h0 = np.stack([d[:1].repeat(7) for d in docs[:3]]), np.random.default_rng(0).normal(0, 0.5, (3, gru_lm.HIDDEN))
    tokens[0, 2] = 0

    def loss():
        h, total = h0, 0.0
        for t in range(tokens.shape[1]):
            total -= s.net.log_likelihood(h, tokens[:, t]).sum()
            h = s.net.step(h, tokens[:, t])[0] * (tokens[:, t] != 0)[:, None]
        return total / 3

    _, g = s.net._window(tokens, h0)
    for name, x in g.items():
        at = np.unravel_index(np.argmax(np.abs(x)), x.shape)
        keep = s.net.p[name][at]
        s.net.p[name][at] = keep + 1e-5
        up = loss()
        s.net.p[name][at] = keep - 1e-5
        down = loss()
        s.net.p[name][at] = keep
        assert math.isclose((up - down) / 2e-5, x[at], rel_tol=1e-3, abs_tol=1e-6), name
    one_by_one = []
    for d in docs:  # a document alone, its state carried token by token
        h, total = np.zeros((1, gru_lm.HIDDEN)), 0.0
        for token in d:
            total += s.net.log_likelihood(h, np.array([token]))[0]
            h, _ = s.net.step(h, np.array([token]))
        one_by_one.append(total)
    assert np.allclose(s.net.score(docs), one_by_one, rtol=1e-4)


def test_gru_step_is_a_distribution():
    s = small_scorer(["a b c a b", "a d e f"])
    n = 1 + gru_lm.TAILS + s.net.words
    h = np.repeat(np.random.default_rng(0).normal(0, 1, (1, gru_lm.HIDDEN)), n, axis=0)
    token = np.arange(n)
    unused = token >= 1 + gru_lm.TAILS + s.net.words
    assert math.isclose(np.exp(s.net.log_likelihood(h, token))[~unused].sum(), 1, rel_tol=0.05)


def check_lm(docs, rows):
    train = [t for d, t in docs if d is not None and zlib.crc32(str(d).encode()) % 5 != 1]
    count = Counter(w for t in train for w in gru_lm.words(t))
    n, v, ends = sum(count.values()) + len(train), len(count) + (len(train) > 0), len(train)

    def want(d, t):
        ws = gru_lm.words(t)
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [count.get(w, 0) for w in ws] + [ends])
        return (d, len(ws) + 1, sum(w in count for w in ws) + (ends > 0), n, round(base, 3))

    got = sorted(str((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 3))) for r in rows)
    assert got == sorted(str(want(d, t)) for d, t in docs)
    assert all(r.score < 0 for r in rows) or not train


def test_lm_counts_equal_brute_force(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(gru_lm, "HEAD", 40)  # most words take the joined way
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    check_lm(docs, gru_lm.score_documents(odd_docs).collect())
    untaught = odd_docs.where("doc_id IS NULL")
    check_lm([(r.doc_id, r.text) for r in untaught.collect()], gru_lm.score_documents(untaught).collect())
    assert gru_lm.score_documents(no_docs).count() == 0


def test_lm_beats_the_base_on_held_out(spark):
    rows = [r for r in gru_lm.score_documents(table(spark, SF, "documents")).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.95


def test_lm_learns_from_every_long_document(spark):
    text = "aa bb cc dd ee " * 3000  # longer than any of the sample
    docs = spark.createDataFrame([(k, text) for k in range(30)], "doc_id long, text string").repartition(3)
    rows = [r for r in gru_lm.score_documents(docs).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > 0.3 * sum(r.base_score for r in rows)

def test_languages_beyond_any_fixed_number_and_long_texts_teach(spark, monkeypatch):
    monkeypatch.setattr(langid, "EPOCHS", 1)
    rows = [(3 * k, "word " * 20, f"l{k:03d}") for k in range(230)]
    rows += [(3 * 230, "long text " * 30_000, "long")] + [(9000, "many times " * 9, "l000")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang for r in langid.sample(docs, None).collect()} == {f"l{k:03d}" for k in range(230)} | {"long"}
    monkeypatch.setattr(langid, "SAMPLE_ALL", 100)  # an equal share is one at least
    got = langid.sample(docs, None).collect()
    assert len(got) == 231 and len({r.lang for r in got}) == 231


def test_language_sample_is_the_first_by_key_in_a_hot_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 7)
    docs = spark.createDataFrame([(k, f"text {k % 500}", "a" if k % 4 else "b") for k in range(2000)], "doc_id long, text string, lang string")
    keyed = docs.selectExpr("lang", "doc_id", "xxhash64(doc_id, text) AS key").collect()
    got = sorted((r.lang, r.key) for r in langid.sample(docs).collect())
    want = [(x, k) for x in "ab" for k in sorted(r.key for r in keyed if r.lang == x and zlib.crc32(str(r.doc_id).encode()) % 3 != 1)[:7]]
    assert got == want


def test_letters():
    assert not any(map(langid.has_letter, ("", "½ ² ①", "12 _ 3", "٣", "…!", "Ⅷ")))
    assert all(map(langid.has_letter, ("a", "½x", "1漢", "ªº", "ǅ", "ʰ")))
