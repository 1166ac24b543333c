import random

import duckdb
from pyspark.sql import functions as F

from pulsegrid.llm import mixing
from pulsegrid.llm.common import row_key


def by_sql(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas())
    return sorted(map(str, con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({mixing.ORACLE})").fetchall()))


def test_oracle_on_odd_rows(spark, odd_docs):
    got = mixing.mix_documents(odd_docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))).drop("source").collect()
    docs = odd_docs.withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    assert sorted(str(tuple(r)) for r in got) == by_sql(docs)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)


def test_targets_stop_at_cap_and_reach_the_share(spark):
    rows = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 500), (None, 90)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got["b"] == 20 and abs(sum(got.values()) - 1.5 * 1600) < 1e-6
    assert got["a"] / 5 == max(t / w for t, w in zip((got["a"], got["b"], got["c"], got[None]), (5, 2, 1, 5))) or got[None] == 180


def brute_sainte_lague(votes, n):
    seats = dict.fromkeys(votes, 0)
    for _ in range(n):
        best = min((k for k in votes if votes[k] > 0), key=lambda k: (-votes[k] / (2 * seats[k] + 1), k))
        seats[best] += 1
    return seats


def test_apportionment_is_highest_quotients(spark):
    votes = {k: float((k * 7919) % 101) for k in range(1, 30)}
    df = spark.createDataFrame(list(votes.items()), "k int, v double")
    for n in (0, 1, 13, 400):
        got = {r["k"]: r["s"] for r in mixing.apportion(df, "v", F.lit(n), [], "k", "s").collect()}
        assert got == brute_sainte_lague(votes, n)


def test_mixed_rows_keep_columns_and_targets(spark, odd_docs, no_docs):
    out = mixing.mixed_rows(odd_docs)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert rows and all(r["text"] and r["text"].strip() for r in rows)
    assert mixing.mixed_rows(no_docs).count() == 0 and mixing.mix_documents(no_docs).count() == 0


def test_native_plan(spark, odd_docs):
    plan = mixing.mix(odd_docs.select("doc_id", "source", "size"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_mixed_rows_meet_each_target_in_whole_documents(spark):
    rng = random.Random(5)
    sizes = {"a": [2000] * 150, "b": [rng.randint(1, 6000) for _ in range(150)], "c": [rng.randint(1, 200) for _ in range(900)] + [9000] * 30}
    rows = [(k, s, f"d{k} " + "w " * (n - 1)) for k, (s, n) in enumerate((s, n) for s, own in sizes.items() for n in own)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for share in (0.25, 0.45, 1.3):
        narrow = docs.select("doc_id", "source", mixing.words_of(F.col("text")).alias("size"))
        want = {r["source"]: r["target"] for r in mixing.targets(narrow, share=share).collect()}
        out = mixing.mixed_rows(docs, share=share).select("source", mixing.words_of(F.col("text")).alias("n"))
        got = {r["source"]: r["words"] for r in out.groupBy("source").agg(F.sum("n").alias("words")).collect()}
        for source, own in sizes.items():
            shards = -(-sum(own) // mixing.SHARD_WORDS)
            miss = abs(got[source] - want[source])
            assert miss <= shards * max(own) and miss <= max(0.12 * want[source], 2 * max(own)), (share, source)
            if source == "c":
                long = out.where("source = 'c' AND n = 9000").count() / 30
                assert abs(long - want["c"] / sum(own)) < 0.25


def test_rows_that_differ_in_which_column_is_null_have_keys_of_their_own(spark):
    rows = spark.createDataFrame([(1, "a b", None, "en"), (1, "a b", "en", None), (1, "a b", "en", None)], "doc_id long, text string, lang string, source string")
    assert rows.select(*row_key(rows)).distinct().count() == 2


def test_smallest_sources_come_near_their_targets(spark):
    sizes = {"a": [500] * 200, "b": [10, 20], "c": [20], "d": [1, 1, 3], "e": [700] * 9, None: [90, 7]}
    rows = [(n, source, size) for n, (source, size) in enumerate((source, size) for source, own in sizes.items() for size in own)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()
    assert len(out) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    for source in sizes:
        own = [r for r in out if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(0.01 * own[0]["target"], 1), source


def test_a_row_in_a_third_of_the_table_lies_in_many_shards(spark):
    hot = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a").alias("source"), F.lit(300).cast("long").alias("size"))
    rest = spark.range(8000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"), F.lit(300).cast("long").alias("size"))
    out = mixing.mix(hot.union(rest))
    shards = {r["shard"]: r["n"] for r in out.where("doc_id IS NULL").groupBy("shard").agg(F.count("*").alias("n")).collect()}
    assert sum(shards.values()) == 4000 and len(shards) > 30 and max(shards.values()) < 250
    got = {r["source"]: (r["t"], r["target"]) for r in out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()}
    assert all(abs(t - want) < 0.01 * want for t, want in got.values())
