import random

from pulsegrid.llm import decontam as D


def edit_distance_within(item, text):
    """Least distance of item to any part of text (plain dynamic programme)."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row), row.index(min(row))


def edited(rng, s, n):
    for _ in range(n):
        k = rng.randrange(len(s))
        s = rng.choice((s[:k] + "z" + s[k + 1 :], s[:k] + s[k + 1 :], s[:k] + "q" + s[k:]))
    return s


def test_myers_equals_dynamic_programme():
    rng = random.Random(1)
    for _ in range(60):
        item = "".join(rng.choices("abc ", k=rng.randint(1, 40)))
        text = "".join(rng.choices("abc ", k=rng.randint(1, 80)))
        assert D.myers(D._masks(item), len(item), text)[0] == edit_distance_within(item, text)[0]


def test_finds_what_brute_force_finds(spark, sentence_of):
    rng = random.Random(2)
    items = [(k, sentence_of(rng, 25)) for k in range(8)]
    docs = []
    for n in range(60):
        body = sentence_of(rng, 30)
        if n % 2:
            s = D.normal(items[n % 8][1])
            body += " " + edited(rng, s, rng.randint(0, int(len(s) * 0.12))).upper() + "!! " + sentence_of(rng, 10)
        docs.append((n, body))
    got = {(r.doc_id, r.item_id): r.distance for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {}
    for d, t in docs:
        for i, s in items:
            s = D.normal(s)
            distance, _ = edit_distance_within(s, D.normal(t))
            if distance <= int(len(s) * D.ERROR_RATE):
                want[d, i] = distance
    assert got == want and len(want) > 15


def test_odd_rows_blocks_and_stage(spark, odd_docs, no_docs):
    texts = [r["text"] for r in odd_docs.where("doc_id between 0 and 3").orderBy("doc_id").collect()]
    items = [(1, texts[0]), (2, None), (3, ""), (4, "an"), (None, texts[1]), (5, texts[2]), (5, texts[2])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.leaks(odd_docs, bench, block_chars=100).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in got} >= {(0, 1, 0), (None, 1, 0), (2, 5, 0)}
    whole = [(i, f" {D.normal(t)} ") for i, t in items if t and D.normal(t)]  # these texts hold no near copies
    held = [(r["doc_id"], {i for i, t in whole if t in f" {D.normal(r['text'])} "}) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(((d, i) for d, of in held for i in of), key=str)
    kept = D.drop_leaks(odd_docs, bench)
    assert kept.columns == odd_docs.columns and kept.count() == sum(not of for _, of in held)
    assert D.leaks(no_docs, bench).count() == 0 and D.leaks(odd_docs, bench.limit(0)).count() == 0
    assert D.drop_leaks(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_normal_forms_agree():
    for s in ("A  b-c_d!!", "É ü x", "漢字, Ab ²³ \x85", "", None, " İx"):
        assert D.normal(s) == D._OTHER.sub(" ", (s or "").lower()).strip()


def test_short_items_as_whole_words_and_items_without_an_id(spark):
    long_item = "which of these rivers runs through four capitals on its way east"
    bench = spark.createDataFrame([(1, "Capital of Peru?"), (2, "an"), (None, long_item), (None, "red ox")], "item_id long, text string")
    docs = [
        (0, "quiz: the capital of PERU, please"),
        (1, "the capital of perugia and ancient banter"),
        (2, "so: " + long_item.replace("runs", "ran").upper()),
        (3, "a red ox; Red, ox! and a fox"),
        (4, "red oxen"),
        (5, "An"),
        (6, "capital of peru"),
        (7, ""),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.distance, r.end_char) for r in D.leaks(df, bench).collect()), key=str)
    assert got == [(0, 1, 0, len("quiz the capital of peru")), (2, None, 2, len("so " + long_item) - 1), (3, None, 0, 8), (5, 2, 0, 2), (6, 1, 0, 15)]
    assert sorted(r.doc_id for r in D.drop_leaks(df, bench).collect()) == [1, 4, 7]
