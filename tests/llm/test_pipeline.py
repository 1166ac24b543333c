import random

import corpus_pipeline
from pulsegrid.llm import decontam, pigeonring
from pulsegrid.llm.common import table
from pulsegrid.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    bench = [(r.item_id, decontam.normal(r.text)) for r in table(spark, SF, "benchmark").collect()]
    now, names = docs, docs.columns
    for k, (name, step) in enumerate(corpus_pipeline.STAGES[:4]):
        out = corpus_pipeline.stage(step(spark, now, SF), "t")
        assert out.columns == names, name
        before, after = {r.doc_id: r for r in now.collect()}, [r for r in out.collect()]
        assert all(r == before[r.doc_id] for r in after), name
        kept = {r.doc_id for r in after}
        if k == 0:
            marks = {r.doc_id: r.toxic for r in table(spark, SF, "labels").collect()}
            gone = set(before) - kept
            assert not any(marks.get(d) == 0 for d in gone) and sum(marks.get(d) == 1 for d in gone) >= 0.5 * sum(marks.values())
        if k == 1:
            prints = {d: pigeonring.fingerprint(r.text) for d, r in before.items()}
            assert not any((prints[a] ^ prints[b]).bit_count() <= 2 for a in kept for b in kept if a < b)
            assert all(any((prints[a] ^ prints[b]).bit_count() <= 2 for b in before if b != a) for a in set(before) - kept)
        if k == 2:
            exact = {d for d, r in before.items() if any(s in decontam.normal(r.text) for _, s in bench)}
            assert not kept & exact and len(set(before) - kept) <= len(exact) + 3
        if k == 3:
            assert {r.source for r in after} <= {r.source for r in before.values()} and len(after) > 0.5 * len(before)
        now = out
    tokens = corpus_pipeline.STAGES[4][1](spark, now, SF)
    assert tokens.count() == now.count()


def test_run_and_odd_rows(spark, odd_docs, no_docs):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    for docs in (odd_docs, no_docs):
        for _, step in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stage(step(spark, docs, SF), "t")
        docs.count()


def test_shuffled_input_gives_the_same_mix(spark):
    rows = table(spark, SF, "documents")
    one = sorted(map(tuple, QUERIES["op1_mixing"](spark, SF).collect()))
    from pulsegrid.llm import mixing

    two = sorted(map(tuple, mixing.mix_documents(rows.repartition(random.randint(2, 9))).collect()))
    assert one == two
