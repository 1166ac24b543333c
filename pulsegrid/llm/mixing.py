"""Mixing sources to target weights by Sainte-Lague apportionment.

Sizes are words. Sources in code point order (null last) weigh 5, 2, 1, and so
on again; together they get ``share`` of all words. A source's target stops at
``cap`` times its size, the excess going to the others by weight (a water
level: target = least(cap * size, level * weight)). The mix is made of blocks
of ``block`` words; a source whose target is under ``fine`` such blocks gets
blocks halved until it is not (down to one word), and shares its seats with the
sources of the same block size, so the smallest source comes as near its target
as the largest. Blocks are allocated by highest quotients votes / (2a + 1):
to the sources by target, then within a source to groups of shards, and within
a group to its shards, by words. A shard is a hash class of a source's
documents of about ``shard_words`` words, laid end to end in hash order and cut
into equal blocks of about its block's words; of its integer quota every block is
taken the whole number of times that fits, and the rest are the blocks with the
smallest seeded hashes. A quota stops at ``cap`` times the shard's blocks; what
that leaves is under two blocks a shard.
A document's ``taken`` is the words of it in the taken blocks, repeats counted.

All steps are DataFrame operations. A hot source has as many shards as its
words ask for, and no window holds more than a shard's documents or a group's
shards (about the square root of a source's shards).

Null and empty texts have size 0 and nothing is taken of them; a null source is
a source of its own; a null doc_id hashes as the empty text. Repeated rows are
documents of their own: they are counted first and numbered, and the number is
hashed too, so a row that fills a third of the table lies in many shards. Reruns
agree (md5 of seed, doc_id, size and number; ties by doc_id, size and number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, keyed_rows, row_key, stage

BLOCK = 128
FINE = 256
SHARD_WORDS = 65536
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEED = 7
FRACTION_BITS = 30


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(rows: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """source, src (its number), source_size, weight, target for each source."""
    out = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    out = out.withColumn("src", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    out = out.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("src") - 1) % len(weights) + 1))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "src")
    capped = F.coalesce(F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * cap
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    out = out.withColumn("level", (total * share - capped) / rest)
    out = out.withColumn("level", F.when(F.col("source_size") * cap > F.col("level") * F.col("weight"), F.col("level")))
    level = F.first("level", True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("source_size") * cap, F.coalesce(level * F.col("weight"), F.col("source_size") * cap))
    return out.select("source", "src", "source_size", "weight", target.alias("target"))


def apportion(parties: DataFrame, votes: str, seats: Column, within: list[str], key: str, into: str) -> DataFrame:
    """Add ``into``: each party's seats of the ``seats`` of its ``within``
    group by highest quotients votes / (2a + 1), ties to the smaller key.

    With n seats and S parties, every party surely has the seats it gets for
    n - S/2 and at most those for n + S/2, so only about 2S quotients compete.
    """
    every = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    all_votes, n_parties = F.sum(votes).over(every), F.count("*").over(every)
    out = parties.withColumn("_n", seats).withColumn("_sum", all_votes).withColumn("_s", n_parties / 2 + 1)

    def fair(n: Column) -> Column:
        return F.when(F.col("_sum") > 0, F.floor(F.col(votes) * n / F.col("_sum") + 0.5)).otherwise(F.lit(0))

    out = out.withColumn("_low", F.greatest(fair(F.col("_n") - F.col("_s")) - 1, F.lit(0)))
    out = out.withColumn("_high", F.greatest(fair(F.col("_n") + F.col("_s")) + 1, F.col("_low")))
    out = out.withColumn("_left", F.col("_n") - F.sum("_low").over(every))
    out = out.withColumn("_a", F.explode(F.sequence("_low", "_high")))
    best = Window.partitionBy(*(within or [F.lit(0)])).orderBy((F.col(votes) / (2 * F.col("_a") + 1)).desc(), key)
    won = (F.row_number().over(best) <= F.col("_left")) & (F.col(votes) > 0)
    out = out.withColumn("_won", won.cast("long"))
    keys = parties.columns
    return out.groupBy(*keys).agg((F.first("_low") + F.sum("_won")).alias(into))


def _hash(*parts: Column | str) -> Column:
    """60 bits of an md5 as a long."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def block_words(target: Column, block: int, fine: int) -> Column:
    """Words of a block of a source: ``block``, halved until ``fine`` make the target, at least 1."""
    size = F.lit(1)
    for words in sorted(block >> n for n in range(1, block.bit_length()) if block >> n > 1) + [block]:
        size = F.when(target >= words * fine, F.lit(words)).otherwise(size)
    return size


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_copy``: equal rows are numbered from 1, counted map-side."""
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.select(*rows.columns, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))


def mix(rows: DataFrame, block=BLOCK, shard_words=SHARD_WORDS, weights=WEIGHTS, share=SHARE, cap=CAP, seed=SEED, fine=FINE) -> DataFrame:
    """``rows`` (doc_id, source, size, and any others) with source_size,
    target, taken, and the src and shard they were laid in."""
    own = rows.columns
    rows = numbered(rows)
    sources = targets(rows, weights, share, cap).withColumn("block", block_words(F.col("target"), block, fine))
    alike = Window.partitionBy("block")
    sources = apportion(sources, "target", F.round(F.sum("target").over(alike) / F.col("block")).cast("long"), ["block"], "src", "blocks")
    sources = sources.withColumn("shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)))
    sources = sources.withColumn("fan", F.ceil(F.sqrt("shards"))).withColumnRenamed("source", "_source")
    laid = rows.join(sources, rows["source"].eqNullSafe(sources["_source"])).drop("_source")
    laid = laid.withColumn("_h", _hash(str(seed), F.col("doc_id"), F.col("size"), F.col("_copy"))).withColumn("_shard", F.pmod("_h", "shards"))
    laid = laid.withColumn("_group", F.expr("_shard div fan"))

    shards = laid.groupBy("src", "_group", "_shard", "block", "blocks").agg(F.sum("size").alias("words"))
    groups = shards.groupBy("src", "_group", "blocks").agg(F.sum("words").alias("group_words"))
    groups = apportion(groups, "group_words", F.col("blocks"), ["src"], "_group", "group_blocks")
    shards = shards.drop("blocks").join(groups.drop("blocks", "group_words"), ["src", "_group"])
    shards = apportion(shards, "words", F.col("group_blocks"), ["src", "_group"], "_shard", "quota")
    shards = shards.withColumn("n", F.greatest(F.round(F.col("words") / F.col("block")).cast("long"), F.lit(1))).where("words > 0")
    shards = shards.withColumn("quota", F.least("quota", F.col("n") * int(cap)))

    cut = shards.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    cut = cut.withColumn("_bh", _hash(str(seed), F.col("src"), F.col("_shard"), F.col("b")))
    rank = F.row_number().over(Window.partitionBy("src", "_shard").orderBy("_bh", "b"))
    cut = cut.withColumn("times", F.expr("quota div n") + (rank <= F.expr("quota % n")).cast("long"))
    before = Window.partitionBy("src", "_shard").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("start", F.expr("words * b div n")).withColumn("long", F.expr("words * (b + 1) div n - start"))
    cut = cut.withColumn("before", F.coalesce(F.sum(F.col("times") * F.col("long")).over(before), F.lit(0)))
    cut = cut.groupBy("src", "_shard", "words", "n").agg(F.sort_array(F.collect_list(F.struct("b", "times", "before", "start"))).alias("cut"))

    order = Window.partitionBy("src", "_shard").orderBy("_h", F.col("doc_id").asc_nulls_first(), "size", "_copy")
    laid = laid.withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    laid = laid.join(cut, ["src", "_shard"], "left")

    def upto(x: str) -> str:  # words taken of the first x words of the shard
        at = f"element_at(cut, cast(({x} * n - 1) div words + 1 AS INT))"
        return f"CASE WHEN {x} <= 0 THEN 0L ELSE {at}.before + {at}.times * ({x} - {at}.start) END"

    taken = F.expr(f"CASE WHEN size = 0 THEN 0L ELSE ({upto('_end')}) - ({upto('(_end - size)')}) END")
    return laid.select(*own, "source_size", "target", taken.alias("taken"), "src", F.col("_shard").alias("shard"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (and source): one row per row."""
    rows = docs.select("doc_id", "source", words_of(F.col("text")).alias("size"))
    out = mix(stage(rows, "sizes"), **options)
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


def whole_documents(mixed: DataFrame, seed=SEED) -> DataFrame:
    """``times``: taken / size, rounded to whole documents without loss to a
    shard. Its documents, by size, get the ups of their running sum of
    fractions from a seeded start: each is rounded up with the probability of
    its fraction, and as sizes ascend, a shard's words differ from those taken
    of it by less than its largest document."""
    order = Window.partitionBy("src", "shard").orderBy("size", _hash(str(seed), "whole", F.col("doc_id")), "taken", "k1", "k2")
    one = 1 << FRACTION_BITS
    rows = mixed.where("size > 0").withColumn("_part", F.expr(f"taken % size * {one}L div size"))
    rows = rows.withColumn("_start", F.pmod(_hash(str(seed), "start", F.col("src"), F.col("shard")), F.lit(one)))
    rows = rows.withColumn("_upto", F.col("_start") + F.sum("_part").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    times = F.expr(f"taken div size + _upto div {one}L - (_upto - _part) div {one}L")
    return rows.withColumn("times", times.cast("int")).drop("_part", "_start", "_upto")


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix: each row as many times as the mix takes it,
    in whole documents (``whole_documents``)."""
    narrow = docs.select(*row_key(docs), docs["doc_id"].alias("doc_id"), docs["source"].alias("source"), words_of(docs["text"]).alias("size"))
    narrow = stage(narrow, "sizes")
    times = whole_documents(mix(narrow, **options), options.get("seed", SEED))
    times = stage(times.groupBy("k1", "k2").agg(F.sum("times").cast("int").alias("times")).where("times > 0"), "times")
    rows = keyed_rows(docs, narrow).join(times, ["k1", "k2"])
    return rows.select("doc", F.explode(F.sequence(F.lit(1), "times"))).select("doc.*")


ORACLE = r"""
WITH s AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) size FROM documents),
g AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) src FROM (SELECT source, sum(size)::BIGINT ssize FROM s GROUP BY source)),
gw AS (SELECT *, [5, 2, 1][1 + (src - 1) % 3] w, 2.0::DOUBLE * ssize cap, 1.5::DOUBLE * sum(ssize) OVER () total FROM g),
lv AS (SELECT a.*, (total - coalesce((SELECT sum(b.cap) FROM gw b WHERE (b.ssize / b.w::DOUBLE, b.src) < (a.ssize / a.w::DOUBLE, a.src)), 0))
              / (SELECT sum(b.w) FROM gw b WHERE (b.ssize / b.w::DOUBLE, b.src) >= (a.ssize / a.w::DOUBLE, a.src)) lev FROM gw a),
tg AS (SELECT source, src, ssize, CASE WHEN l IS NULL OR cap <= l * w THEN cap ELSE l * w END target
       FROM (SELECT *, (SELECT x.lev FROM lv x WHERE x.cap > x.lev * x.w ORDER BY x.ssize / x.w::DOUBLE, x.src LIMIT 1) l FROM lv)),
tb AS (SELECT *, CASE WHEN target >= 128 * 256 THEN 128 WHEN target >= 64 * 256 THEN 64 WHEN target >= 32 * 256 THEN 32 WHEN target >= 16 * 256 THEN 16
                     WHEN target >= 8 * 256 THEN 8 WHEN target >= 4 * 256 THEN 4 WHEN target >= 2 * 256 THEN 2 ELSE 1 END blk FROM tg),
n0 AS (SELECT *, CAST(round(sum(target) OVER (PARTITION BY blk) / blk) AS BIGINT) n FROM tb),
q0 AS (SELECT src, n, row_number() OVER (PARTITION BY blk ORDER BY target / (2 * a + 1) DESC, src) r FROM (SELECT *, unnest(range(n + 1)) a FROM n0) WHERE target > 0),
b0 AS (SELECT src, count(*) blocks FROM q0 WHERE r <= n GROUP BY src),
so AS (SELECT tb.*, coalesce(blocks, 0) blocks, greatest(CAST(ceil(ssize / 65536.0) AS BIGINT), 1) shards FROM tb LEFT JOIN b0 USING (src)),
sc AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) cp FROM s),
d AS (SELECT s.doc_id, s.size, cp, so.*, CAST(ceil(sqrt(shards)) AS BIGINT) fan, CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || s.size || ':' || cp), 1, 15) AS BIGINT) h
      FROM sc s JOIN so ON s.source IS NOT DISTINCT FROM so.source),
ds AS (SELECT *, h % shards sh, (h % shards) // fan grp FROM d),
gr AS (SELECT src, grp, any_value(blocks) n, sum(size)::DOUBLE v FROM ds GROUP BY src, grp),
q1 AS (SELECT src, grp, n, row_number() OVER (PARTITION BY src ORDER BY v / (2 * a + 1) DESC, grp) r FROM (SELECT *, unnest(range(n + 1)) a FROM gr WHERE v > 0)),
b1 AS (SELECT src, grp, count(*) gn FROM q1 WHERE r <= n GROUP BY src, grp),
sd AS (SELECT src, grp, sh, any_value(blk) blk, sum(size)::BIGINT words FROM ds GROUP BY src, grp, sh),
q2 AS (SELECT src, sh, gn, row_number() OVER (PARTITION BY src, grp ORDER BY words / (2.0::DOUBLE * a + 1) DESC, sh) r
       FROM (SELECT *, unnest(range(gn + 1)) a FROM sd JOIN b1 USING (src, grp) WHERE words > 0)),
b2 AS (SELECT src, sh, count(*) quota FROM q2 WHERE r <= gn GROUP BY src, sh),
sq AS (SELECT src, sh, words, greatest(CAST(round(words / blk::DOUBLE) AS BIGINT), 1) nb, least(coalesce(quota, 0), 2 * greatest(CAST(round(words / blk::DOUBLE) AS BIGINT), 1)) quota FROM sd LEFT JOIN b2 USING (src, sh) WHERE words > 0),
bl AS (SELECT src, sh, words, nb, quota, unnest(range(nb)) b FROM sq),
bm AS (SELECT src, sh, words * b // nb lo, words * (b + 1) // nb hi, quota // nb + CASE WHEN row_number() OVER (PARTITION BY src, sh ORDER BY
         CAST('0x' || substr(md5('7:' || src || ':' || sh || ':' || b), 1, 15) AS BIGINT), b) <= quota % nb THEN 1 ELSE 0 END times FROM bl),
dl AS (SELECT *, sum(size) OVER (PARTITION BY src, sh ORDER BY h, doc_id NULLS FIRST, size, cp ROWS UNBOUNDED PRECEDING) e, row_number() OVER () rid FROM ds),
tk AS (SELECT rid, sum(times * (least(e, hi) - greatest(e - size, lo))) taken
       FROM dl JOIN bm ON dl.src = bm.src AND dl.sh = bm.sh AND lo < e AND hi > e - size WHERE size > 0 GROUP BY rid)
SELECT doc_id, size, ssize AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, source FROM dl LEFT JOIN tk USING (rid)
"""
