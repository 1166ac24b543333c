"""Token-ID files in patched frame-of-reference blocks.

A file holds the ids of a run of documents, document after document, cut into
blocks of ``BLOCK`` ids. A block stores its minimum, the differences to it
packed at the width that holds ``PERCENTILE`` percent of them, and the others
(the exceptions) as positions and full values. After the blocks come the
document table (doc_id, whether it is null, number of ids) and the index of the
block starts, so that any range of ids can be read without the rest.

    "PFOR1\\0\\0\\0" | blocks | doc table | block index | trailer (5 x u64) | "PFOR1\\0\\0\\0"
    block:   u32 n, u32 minimum, u32 exceptions, u32 width | packed bits, little end first
             | u16 positions | u32 values
    trailer: documents, blocks, ids, start of doc table, start of block index

``write_tokens`` deals the documents out by range of (doc_id, hash of text),
encodes every partition in order and writes a file each; files have names of
their own, and only those in the manifest, which Spark commits, count. So a
task that is run again leaves at most an unread file. Ascending order puts
null doc_ids first; equal doc_ids are ordered by hash of text. A null text is
encoded as the empty text: the end id alone.

Texts are cut before single blanks, where the tokenizer's own pattern always
cuts, and distinct pieces are encoded once per worker (a bounded cache); texts
with other arrangements of white space are encoded whole.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_by_worker, open_folder, shared_path, stage, text_slices

MAGIC = b"PFOR1\0\0\0"
BLOCK = 4096
PERCENTILE = 90
END_ID = 0
CACHE_PIECES = 900_000
CACHE_CHARS = 10_000
SLICE_BYTES = 4 << 20
READ_BLOCKS = 128
JOINED = 2000
BLANK = "\u0120"  # the vocabulary's letter for the byte 32

# ---------------------------------------------------------------- blocks


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    over = (ids - np.uint32(low)).astype("<u4")
    rank = min(len(over) - 1, int(np.ceil(len(over) * percentile / 100)) - 1)
    width = int(np.partition(over, rank)[rank]).bit_length()
    odd = np.flatnonzero(over >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    values = ids[odd].astype("<u4")
    over[odd] = 0
    bits = np.unpackbits(over.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    return struct.pack("<4I", len(ids), low, len(odd), width) + packed + odd.astype("<u2").tobytes() + values.tobytes()


def unpack_block(data, at: int = 0) -> tuple[np.ndarray, int]:
    """Ids of the block at ``at``, and where it ends."""
    n, low, odd, width = struct.unpack_from("<4I", data, at)
    at += 16
    size = (n * width + 7) // 8
    bits = np.zeros((n, 32), np.uint8)
    if width:
        bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    ids = np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel() + np.uint32(low)
    at += size
    if odd:
        ids[np.frombuffer(data, "<u2", odd, at)] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return ids, at + 6 * odd


class TokenFileWriter:
    """Appends documents to one file; ``close`` writes tables and index."""

    def __init__(self, out, block: int = BLOCK):
        if block > 65536:
            raise ValueError("positions of exceptions have 16 bits")
        self.out, self.block, self.at = out, block, len(MAGIC)
        self.rest, self.kept = [], 0
        self.doc_ids, self.lengths, self.starts, self.ids = [], [], [], 0
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.lengths.append(np.asarray(lengths, "<u8"))
        self.rest.append(ids.astype(np.uint32))
        self.kept += len(ids)
        self.ids += len(ids)
        if self.kept >= self.block:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.rest) if self.rest else np.empty(0, np.uint32)
        end = len(ids) if last else len(ids) // self.block * self.block
        for k in range(0, end, self.block):
            data = pack_block(ids[k : min(k + self.block, end)])
            self.starts.append(self.at)
            self.out.write(data)
            self.at += len(data)
        self.rest, self.kept = [ids[end:]], len(ids) - end

    def close(self) -> None:
        self._flush(True)
        docs_at = self.at
        null = np.array([d is None for d in self.doc_ids], np.uint8)
        table = np.array([d or 0 for d in self.doc_ids], "<i8").tobytes() + null.tobytes()
        table += np.concatenate([np.empty(0, "<u8"), *self.lengths]).astype("<u8").tobytes()
        self.out.write(table)
        index_at = docs_at + len(table)
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(struct.pack("<5Q", len(self.doc_ids), len(self.starts), self.ids, docs_at, index_at) + MAGIC)


class TokenFile:
    """Reads a file by ranges: the trailer and tables first, then blocks."""

    def __init__(self, source):
        self.source = source
        size, tail = source.size(), 40 + len(MAGIC)
        end = source.read_at(tail, size - tail)
        if end[40:] != MAGIC or source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a token file")
        self.docs, self.blocks, self.ids, self.docs_at, index_at = struct.unpack_from("<5Q", end)
        table = source.read_at(index_at - self.docs_at, self.docs_at)
        ids = np.frombuffer(table, "<i8", self.docs).tolist()
        null = np.frombuffer(table, np.uint8, self.docs, 8 * self.docs)
        self.doc_ids = [None if x else d for d, x in zip(ids, null)]
        self.lengths = np.frombuffer(table, "<u8", self.docs, 9 * self.docs)
        self.starts = np.frombuffer(source.read_at(8 * self.blocks, index_at), "<u8") if self.blocks else np.empty(0, "<u8")

    def read_blocks(self, first: int, last: int) -> np.ndarray:
        """Ids of the blocks first to last (exclusive)."""
        begin = int(self.starts[first])
        end = int(self.starts[last]) if last < self.blocks else self.docs_at
        data, at, out = self.source.read_at(end - begin, begin), 0, []
        for _ in range(first, last):
            ids, at = unpack_block(data, at)
            out.append(ids)
        return np.concatenate(out)

    def checksums(self) -> list[int]:
        """crc32 of each document's ids as little-endian u32, in order."""
        out, doc, left, crc = [], 0, int(self.lengths[0]) if self.docs else 0, 0
        for k in range(0, self.blocks, READ_BLOCKS):
            data = memoryview(np.ascontiguousarray(self.read_blocks(k, min(k + READ_BLOCKS, self.blocks)), "<u4")).cast("B")
            at = 0
            while doc < self.docs and (at < len(data) or not left):
                take = min(4 * left, len(data) - at)
                crc = zlib.crc32(data[at : at + take], crc)
                at, left = at + take, left - take // 4
                if left:
                    break
                out.append(crc)
                doc, crc = doc + 1, 0
                left = int(self.lengths[doc]) if doc < self.docs else 0
        return out


# ---------------------------------------------------------------- encoding


class PieceEncoder:
    """Encodes whole texts; the ids of distinct pieces are kept, up to a bound."""

    def __init__(self, tokenizer, limit: int = CACHE_PIECES):
        self.tokenizer, self.limit = tokenizer, limit
        vocabulary = tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self.number: dict = {0: 0}  # the end id is entry 0
        self.flat = np.array([END_ID], np.uint32)
        self.start, self.size = np.array([0]), np.array([1])

    def _ids(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all keys, and the number for each. Pieces that follow a
        blank are encoded side by side: the blank opens each one's first id."""
        whole = [k[1:] for k in keys if k[0] == " "]  # these sort first
        flat, sizes = [], []
        for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False):
            flat.append(np.array(e.ids, np.uint32))
            sizes.append(np.array([len(e.ids)]))
        rest = keys[len(whole) :]
        groups = [rest[k : k + JOINED] for k in range(0, len(rest), JOINED)]
        lines = [" " + " ".join(g) for g in groups]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)):
            ids = np.array(e.ids, np.uint32)
            begin = np.flatnonzero(self.opens[ids])
            if len(begin) != len(group):
                raise ValueError("a piece does not open with a blank of its own")
            flat.append(ids)
            sizes.append(np.diff(np.append(begin, len(ids))))
        return np.concatenate(flat), np.concatenate(sizes)

    def _look_up(self, parts: list[list]) -> tuple[list, np.ndarray, set[str]]:
        """All pieces, their entries (-1: none yet), and the new ones."""
        flat = list(chain.from_iterable(parts))
        at = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        return flat, at, {flat[i] for i in np.flatnonzero(at < 0).tolist()}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with their end ids, and the number for each."""
        parts = []
        for t in texts:  # a first piece is marked by a blank, which no other piece holds
            own = (t or "").split(" ")
            own[0] = " " + own[0]
            own.append(0)
            parts.append(own)
        flat, at, new = self._look_up(parts)
        bad = {p for p in new if not p or p[-1].isspace() and p != " " or p[0].isspace() and p[0] != " "}
        if bad:  # white space beside a cut: the whole text is one piece
            parts = [own if bad.isdisjoint(own) else [" " + (t or ""), 0] for t, own in zip(texts, parts)]
            flat, at, new = self._look_up(parts)
        keys, before = sorted(new), (len(self.flat), len(self.start))
        if keys:
            ids, sizes = self._ids(keys)
            begin = len(self.flat) + np.concatenate(([0], np.cumsum(sizes)[:-1]))
            self.number |= zip(keys, range(len(self.start), len(self.start) + len(keys)))
            self.flat = np.concatenate([self.flat, ids])
            self.start, self.size = np.concatenate([self.start, begin]), np.concatenate([self.size, sizes])
            missing = np.flatnonzero(at < 0)
            at[missing] = [self.number[flat[i]] for i in missing.tolist()]
        counts = np.array([len(own) for own in parts])
        sizes = self.size[at]
        shift = self.start[at] - np.concatenate(([0], np.cumsum(sizes)[:-1]))
        ids = self.flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
        lengths = np.add.reduceat(sizes, np.concatenate(([0], np.cumsum(counts)[:-1])))
        # what comes first stays, as frequent pieces do; beyond the bound new ones go again
        if len(self.number) > self.limit or any(len(k) > CACHE_CHARS for k in keys):
            for k in keys:
                del self.number[k]
            self.flat, self.start, self.size = self.flat[: before[0]], self.start[: before[1]], self.size[: before[1]]
        return ids, lengths


def _encoder(path: str) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return held_by_worker(("tokens", path), lambda: PieceEncoder(Tokenizer.from_file(path)))


# ---------------------------------------------------------------- Spark

MANIFEST = "shard int, path string, docs long, ids long"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_tokens(docs: DataFrame, tokenizer_path: str, out: str | None = None) -> DataFrame:
    """Write the files under the URL ``out`` (a new shared folder if not
    given); returns the manifest: shard, path, docs, ids."""
    spark = docs.sparkSession
    folder = out or shared_path(spark, "tokens")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    texts = texts.repartitionByRange(F.col("doc_id"), F.col("tie")).sortWithinPartitions("doc_id", "tie").drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        shard, writer, encoder = TaskContext.get().partitionId(), None, _encoder(tokenizer_path)
        path = f"{root.rstrip('/')}/shard-{shard:06d}-{uuid.uuid4().hex}.pfor"
        with files.open_output_stream(path) as stream:
            writer = TokenFileWriter(stream)
            for batch in batches:
                for first, part in text_slices(batch.column(1), SLICE_BYTES):
                    ids, lengths = encoder.encode(part)
                    writer.add(batch.column(0).slice(first, len(part)).to_pylist(), lengths, ids)
            writer.close()
        row = [[shard], [path], [len(writer.doc_ids)], [writer.ids]]
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["shard", "path", "docs", "ids"])

    manifest = texts.mapInArrow(write, MANIFEST).withColumn("folder", F.lit(folder))
    return stage(manifest, "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = manifest.where("docs > 0").withColumn("before", F.coalesce(F.sum("ids").over(before), F.lit(0)))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards.select("folder", "path", "before").repartition(parts, "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, _ = open_folder(row["folder"])
                with files.open_input_file(row["path"]) as source:
                    tokens = TokenFile(source)
                    lengths = tokens.lengths.astype(np.int64)
                    start = row["before"] + np.concatenate(([0], np.cumsum(lengths)[:-1]))
                    columns = [pa.array(tokens.doc_ids, pa.int64()), pa.array(start), pa.array(lengths), pa.array(tokens.checksums(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.mapInArrow(read, READ)


def token_table(docs: DataFrame, tokenizer_path: str, out: str | None = None) -> DataFrame:
    """Write the token files of ``docs`` and describe them from a reread."""
    return read_tokens(write_tokens(docs, tokenizer_path, out))
