"""SimHash near-duplicates found by pigeonring filtering.

A 64-bit fingerprint is four segments of 16 bits on a ring. If two
fingerprints differ in at most tau bits, then from some segment on, every
chain of consecutive segments keeps within its proportional budget: the
differences of the first l segments add up to at most l * tau / 4. With
tau = 2 that is 0, 1, 1, 2 bits for chains of one to four segments. The first
two links are the join key (a segment equal, the next within one bit, whose
one-bit variants are listed), the third link and the whole ring are checked on
the joined pairs. A key has 32 bits plus the segment number, and works on
distinct fingerprints, so exact copies never meet as pairs.

Null and empty texts have fingerprint zero and link like any other. Rows with
a null doc_id are linked too; component_id is the smallest non-null doc_id of
the component (null if there is none). Repeated rows return a row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker, keyed_rows, row_key, stage
from .components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
SEGMENTS, WIDTH = 4, 16
BLOCK = 65536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(len(words) - shingle + 1, 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + BLOCK], stops[k : k + BLOCK])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int((np.uint64(1) << np.flatnonzero(2 * counts > n).astype(np.uint64)).sum(dtype=np.uint64))


def simhash(text: str | Column, shingle: int = SHINGLE) -> Column:
    """A column: the fingerprint as a signed long."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held_by_worker("simhash", object)  # lets go of what an earlier stage kept
        for texts in batches:
            prints = [fingerprint(t if isinstance(t, str) else None, shingle) for t in texts]
            yield pd.Series(np.array(prints, np.uint64).view(np.int64))

    return of(F.col(text) if isinstance(text, str) else text)


def _segment(col: str, i) -> str:
    return f"(shiftrightunsigned({col}, {WIDTH} * ({i})) & {(1 << WIDTH) - 1})"


def _differ(i) -> str:
    """Bits that differ in segment i (mod 4) of the pair a, b."""
    return f"bit_count({_segment('(a ^ b)', f'({i}) % {SEGMENTS}')})"


def close_pairs(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b) of the distinct longs ``fp`` at 1 to ``max_bits`` bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the chain budgets of the join key are made for at most 2 bits")
    each = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("i"))
    each = each.select(
        "fp", "i", F.expr(_segment("fp", "i")).alias("here"), F.expr(_segment("fp", f"(i + 1) % {SEGMENTS}")).alias("next")
    )
    key = "shiftleft(cast(i AS BIGINT), 32) | shiftleft(here, 16) | {}"
    index = each.select(F.expr(key.format("next")).alias("key"), F.col("fp").alias("b"))
    # one-bit variants: the side that has the bit set asks for the side that hasn't
    probe = each.withColumn("bit", F.explode(F.sequence(F.lit(-1), F.lit(WIDTH - 1))))
    probe = probe.where("bit < 0 OR next & shiftleft(1L, bit) <> 0")
    asked = "(CASE WHEN bit < 0 THEN next ELSE next ^ shiftleft(1L, bit) END)"
    probe = probe.select(F.expr(key.format(asked)).alias("key"), F.col("fp").alias("a"), "i", F.expr("bit < 0").alias("same"))
    met = probe.join(index, "key").where("a <> b AND (NOT same OR a < b)")
    chain = f"{_differ('i')} + {_differ('i + 1')}"
    met = met.where(f"{chain} <= {max_bits} * 2 / {SEGMENTS}").where(f"{chain} + {_differ('i + 2')} <= {max_bits} * 3 / {SEGMENTS}")
    return met.where(f"bit_count(a ^ b) <= {max_bits}").select("a", "b")


def link(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root) for each distinct fingerprint that has a link."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return connected_components(close_pairs(rows.select("fp").distinct().repartition(parts, "fp"), max_bits))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row."""
    rows = stage(docs.select("doc_id", simhash("text", shingle).alias("fp")), "simhash")
    roots = link(rows, max_bits)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    least = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    least = least.withColumn("root", F.coalesce("root", "fp"))
    groups = least.groupBy("root").agg(F.min("least").alias("component_id"))
    names = stage(least.join(groups, "root").select("fp", "component_id"), "components")
    return rows.join(names, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one row of each component: that with the
    smallest doc_id (nulls last; of rows with one doc_id that with the least key)."""
    narrow = docs.select(docs["doc_id"].alias("doc_id"), *row_key(docs), simhash(docs["text"], shingle).alias("fp"))
    narrow = stage(narrow, "marked")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2")).alias("best")
    least = narrow.groupBy("fp").agg(best).join(link(narrow, max_bits).withColumnRenamed("node", "fp"), "fp", "left")
    kept = least.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("best").alias("best")).select("best.k1", "best.k2")
    gone = stage(narrow.select("k1", "k2").distinct().join(kept, ["k1", "k2"], "left_anti"), "gone")
    # a merge join at every size, not a broadcast where few rows go
    return keyed_rows(docs, narrow).join(gone.hint("merge"), ["k1", "k2"], "left_anti").select("doc.*")
