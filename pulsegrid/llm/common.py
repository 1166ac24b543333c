"""Shared helpers of the corpus operators."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and a lost executor costs a reread instead of a recomputation."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of the right side that a task of ``every_pair`` takes.
RIGHT_ROWS = 16


def every_pair(left: DataFrame, right: DataFrame, n_right: int) -> DataFrame:
    """Each row of ``left`` beside each of the ``n_right`` rows of ``right``, the
    pairs of a left row one after the other. Tasks read a part of either side
    from where it is staged: nothing is copied, shuffled or sent to the driver,
    whatever size Spark takes packed rows for."""
    right = right.coalesce(max(1, -(-n_right // RIGHT_ROWS)))
    return left.crossJoin(right.hint("shuffle_replicate_nl"))


_HELD: dict = {}


def held_by_worker(key, make):
    """What ``make`` returns, kept by this Python worker while it runs tasks
    that ask for ``key``. A worker holds one such thing: the next operator's
    tasks let go of it, as workers outlive the stages they serve."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def row_key(df: DataFrame) -> list[Column]:
    """k1, k2: 128 bits that name a row by its content, so that a narrow table
    can point at rows without a copy of them. Rows that repeat share a key."""
    own = [df[f.name] for f in df.schema.fields if f.dataType.typeName() != "map"]
    nulls = [c.isNull() for c in own]  # xxhash64 skips nulls
    return [F.xxhash64(F.lit(k), *own, *nulls).alias(f"k{k}") for k in (1, 2)]


def keyed_rows(docs: DataFrame, narrow: DataFrame) -> DataFrame:
    """The rows of ``docs`` as (doc, k1, k2), rows that repeat once; ``narrow``
    has the keys of all rows. Texts are only shuffled if some rows repeat."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *row_key(docs))
    repeats = narrow.groupBy("k1", "k2").count().where("count > 1").limit(1).count()
    return rows.dropDuplicates(["k1", "k2"]) if repeats else rows


def open_folder(folder: str):
    """File system and path of a URL or a plain path (for files that tasks
    write and read themselves in the shared folder)."""
    if folder.startswith("file:") and "://" not in folder:
        folder = "file://" + folder[5:]
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder else (pa.fs.LocalFileSystem(), folder)


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; null for a null doc_id."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(col.cast("string").cast("binary")) % n


def text_slices(column: pa.Array, budget: int):
    """Split a string column into runs of rows of about ``budget`` text bytes
    (a longer single text is a run of its own); yields (first row, [texts])."""
    sizes = np.asarray(pa.compute.binary_length(column).fill_null(0)).astype(np.int64)
    first, n = 0, len(column)
    ends = np.cumsum(sizes)
    while first < n:
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + budget, side="right")))
        yield first, column.slice(first, last - first).to_pylist()
        first = last
