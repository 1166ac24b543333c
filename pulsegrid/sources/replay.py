"""Replay of stored history as a stream: event-time order, at a chosen speed.

``store_history`` lays a table out for replay: Spark writes it as Parquet, a
folder per slice of event time, files sorted by time, large slices split into
several files. ``ReplaySource`` (format ``history``) streams such a folder. Its
clock starts at ``started`` and shows ``speed`` seconds of event time for each
second since; a slice is told when the clock reaches its start, so events come at
most a slice early. The offset is the start of the last slice told. As it follows
from the clock alone, the source keeps no state: any number of queries may read
one history, and a restarted query goes on from its checkpoint's offset and
catches up on what fell due meanwhile, as on a live source. (The machine's clock
must not be set back by more than a restart takes.)

A batch is a run of whole slices. The driver lists the folder's slices once and
the files of the batch's own slices; tasks read a file each. Rows without a time
come before all others. Slices without rows don't exist; an empty history is a
stream without rows. A history is stored whole before it is replayed.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

FORMAT = "history"
SLICE = "slice"
NO_TIME = -(1 << 62)  # the slice of rows without a time


def store_history(df: DataFrame, path: str, time_column: str, slice_seconds: int, rows_per_file: int = 1_000_000) -> None:
    """Write ``df`` to the new folder ``path`` in slices of ``slice_seconds`` of
    event time. One shuffle; a slice too large for a task is split by the
    rebalance, and by ``rows_per_file`` (a file is a task's work on replay)."""
    at = F.unix_micros(F.col(time_column).cast("timestamp"))
    cut = df.withColumn(SLICE, F.coalesce(at - F.pmod(at, F.lit(slice_seconds * 1_000_000)), F.lit(NO_TIME)))
    cut = cut.hint("rebalance", F.col(SLICE)).sortWithinPartitions(SLICE, time_column)
    cut.write.option("maxRecordsPerFile", rows_per_file).partitionBy(SLICE).parquet(path)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def _listing(path: str) -> list[pafs.FileInfo]:
    files, root = _open(path)
    return files.get_file_info(pafs.FileSelector(root, allow_not_found=True))


def slices(path: str) -> list[int]:
    """Starts of the stored slices in microseconds, ascending."""
    names = [i.base_name for i in _listing(path) if i.type == pafs.FileType.Directory and i.base_name.startswith(SLICE + "=")]
    return sorted(int(n.partition("=")[2]) for n in names)


class HistoryFile(InputPartition):
    """A file of a slice: one task's work."""

    def __init__(self, path: str, name: str):
        self.path, self.name = path, name


class ReplayReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, path: str, speed: float, started: float):
        if not speed > 0:
            raise ValueError("speed must be positive")
        self.schema, self.path, self.speed, self.started = schema, path.rstrip("/"), speed, started
        self.stored: list[int] | None = None
        self.told = NO_TIME - 1

    def _slices(self) -> list[int]:
        if self.stored is None:
            self.stored = slices(self.path)
        return self.stored

    def initialOffset(self) -> dict:
        return {"upto": NO_TIME - 1}

    def latestOffset(self) -> dict:
        stored = self._slices()
        begin = next((s for s in stored if s != NO_TIME), 0)
        now = begin + (time.time() - self.started) * self.speed * 1e6
        self.told = max([self.told, *(s for s in stored if s <= now)])
        return {"upto": self.told}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        for at in self._slices():
            if start["upto"] < at <= end["upto"]:
                folder = f"{self.path}/{SLICE}={at}"
                names = sorted(i.base_name for i in _listing(folder) if i.base_name.endswith(".parquet"))
                out += [HistoryFile(folder, n) for n in names]
        return out

    def read(self, partition: HistoryFile) -> Iterator[pa.RecordBatch]:
        want = to_arrow_schema(self.schema)
        files, folder = _open(partition.path)
        with files.open_input_file(f"{folder}/{partition.name}") as stored:
            # Spark's own timestamps are INT96 instants
            for batch in pq.ParquetFile(stored, coerce_int96_timestamp_unit="us").iter_batches(columns=want.names):
                yield batch.select(want.names).cast(want)


class ReplaySource(DataSource):
    """Options: ``path``, ``speed`` (seconds of event time a second; default 1) and
    ``started`` (epoch seconds at which the replay's clock began)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: T.StructType) -> ReplayReader:
        if "path" not in self.options or "started" not in self.options:
            raise ValueError("options path and started are needed")
        return ReplayReader(schema, self.options["path"], float(self.options.get("speed", 1)), float(self.options["started"]))


def history_stream(spark: SparkSession, path: str, schema: T.StructType, started: float, speed: float = 1.0) -> DataFrame:
    """The history under ``path`` as a streaming table. Keep ``started`` with the
    job's settings: a restart that names the same goes on by the same clock."""
    spark.dataSource.register(ReplaySource)
    options = {"path": path, "speed": repr(float(speed)), "started": repr(float(started))}
    return spark.readStream.format(FORMAT).schema(schema).options(**options).load()
