import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import pigeonring as P
from pulsegrid.llm.components import connected_components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abC \n\té ", max_size=60))
def test_fingerprint(text):
    assert P.fingerprint(text) == plain_fingerprint(text)


def test_spark_hash_is_the_contract_hash(spark):
    assert spark.sql("SELECT xxhash64('a b c')").first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_close_pairs_equal_brute_force(spark):
    rng = random.Random(7)
    prints = set()
    for _ in range(150):
        x = rng.getrandbits(64)
        prints.add(x)
        for _ in range(4):
            y = x
            for b in rng.sample(range(64), rng.randint(1, 4)):
                y ^= 1 << b
            prints.add(y)
    prints |= {0, 1, 3, 7, 2**63, 2**64 - 1, 2**64 - 2}
    df = spark.createDataFrame([(signed(x),) for x in prints], "fp long")
    got = {frozenset((r.a, r.b)) for r in P.close_pairs(df).collect()}
    some = sorted(prints)
    want = {frozenset((signed(x), signed(y))) for i, x in enumerate(some) for y in some[i + 1 :] if (x ^ y).bit_count() <= 2}
    assert got == want and len(want) > 100


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (7, 6), (6, 5), (3, 1), (-4, 20)] + [(k, k + 1) for k in range(100, 140)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4, -4: -4, 20: -4} | {k: 100 for k in range(100, 141)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_documents_equal_brute_force(spark, odd_docs, no_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    prints = [P.fingerprint(t) for _, t in docs]
    root = list(range(len(docs)))
    for _ in docs:
        for i, x in enumerate(prints):
            for j, y in enumerate(prints):
                if (x ^ y).bit_count() <= 2:
                    root[i] = root[j] = min(root[i], root[j])
    least = {k: min((docs[i][0] for i in range(len(docs)) if root[i] == k and docs[i][0] is not None), default=None) for k in set(root)}
    want = sorted(str((d, f"{x:016x}", least[root[i]])) for i, ((d, _), x) in enumerate(zip(docs, prints)))
    assert sorted(str(tuple(r)) for r in P.near_duplicates(odd_docs).collect()) == want
    kept = P.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(set(root))
    assert {r.doc_id for r in kept.collect()} == set(least.values())
    assert P.near_duplicates(no_docs).count() == 0 and P.keep_one(no_docs).count() == 0
