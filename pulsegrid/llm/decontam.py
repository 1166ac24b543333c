"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in a normal form: lower-cased, every run of characters that
are neither letters nor digits is one blank. An item of m characters may be
found with up to k = floor(m * ERROR_RATE) edits. It is split into k + 1
pieces; a passage within k edits holds at least one piece unchanged. An
Aho-Corasick automaton finds all piece hits of a text in one pass, every hit
names the window of the text in which the item could lie, and Myers'
bit-parallel distance verifies the (merged) windows.

Items are processed in blocks of bounded size: one pass over the documents per
block, the block's pieces being broadcast. An item whose normal form is shorter
than ``MIN_CHARS`` has no error budget and must stand as whole words: its one
piece is the item between blanks. Null and empty texts and items match nothing.
Repeated rows are matched each; items that repeat an item_id are matched each, the
best match being returned, and items without an id count as one item, whose
item_id is null. Ties are broken by the earlier end position.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker, stage, text_slices

ERROR_RATE = 0.08
MIN_CHARS = 24
BLOCK_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")


#: Latin-1 byte -> itself if a letter or digit, else a blank (a faster way for such texts)
_LATIN = bytes(b if _OTHER.sub("", chr(b)) else 32 for b in range(256))


def normal(text: str | None) -> str:
    low = (text or "").lower()
    try:
        return b" ".join(low.encode("latin-1").translate(_LATIN).split()).decode("latin-1")
    except UnicodeEncodeError:
        return _OTHER.sub(" ", low).strip()


def pieces(m: int, k: int) -> list[tuple[int, int]]:
    """(offset, length) of k + 1 pieces of near-equal length."""
    cuts = [m * j // (k + 1) for j in range(k + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def myers(pattern_masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any part of ``text``, and the
    first end position (exclusive) that has it."""
    ones, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, at = ones, 0, m, m, 0
    get = pattern_masks.get
    for j, ch in enumerate(text, 1):
        eq = get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & ones)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score < best:
                best, at = score, j
        ph = ph << 1 & ones
        mh = mh << 1 & ones
        pv = mh | (~(xv | ph) & ones)
        mv = ph & xv
    return best, at


def _masks(item: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for j, ch in enumerate(item):
        masks[ch] |= 1 << j
    return dict(masks)


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = [(i, s, int(len(s) * error_rate) if len(s) >= MIN_CHARS else 0) for i, s in items]
        self.masks: dict[int, dict[str, int]] = {}
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, s, k) in enumerate(self.items):
            if len(s) < MIN_CHARS:
                where[f" {s} "].append((n, 0))  # between blanks: the text has one before and after
                continue
            for offset, size in pieces(len(s), k):
                where[s[offset : offset + size]].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def _windows(self, text: str) -> dict[int, list[list[int]]]:
        """Per item the merged windows of the text in which it could lie."""
        found: dict[int, set[int]] = defaultdict(set)
        for end, (size, places) in self.automaton.iter(f" {text} "):
            for n, offset in places:
                if len(self.items[n][1]) < MIN_CHARS:
                    found[n] = found[n] or {end + 1 - size}  # exact: the first is the best
                else:
                    found[n].add(end - size - offset)
        out = {}
        for n, starts in found.items():
            _, s, k = self.items[n]
            runs: list[list[int]] = []
            for start in sorted(starts):
                a, b = max(0, start - k), min(len(text), start + len(s) + k)
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], b)
                else:
                    runs.append([a, b])
            out[n] = runs
        return out

    def matches(self, raw: str | None) -> list[tuple[int, int, int]]:
        """(item number, distance, end) of the best match of each item."""
        text = normal(raw)
        if self.empty or not text:
            return []
        out = []
        for n, runs in self._windows(text).items():
            _, s, k = self.items[n]
            best = None
            for a, b in runs:
                at = text.find(s, a, b)
                if at >= 0:
                    got = (0, at + len(s))
                else:
                    if n not in self.masks:
                        self.masks[n] = _masks(s)
                    distance, end = myers(self.masks[n], len(s), text[a:b])
                    got = (distance, a + end)
                if got[0] <= k and (best is None or got < best):
                    best = got
            if best:
                out.append((n, *best))
        return out


def _matcher(shared, error_rate: float) -> Matcher:
    """The matcher of a broadcast (name, items), made once per worker."""
    name, items = shared.value
    return held_by_worker((name, error_rate), lambda: Matcher(items, error_rate))


def _share(items: list[tuple[int, str]], spark):
    return spark.sparkContext.broadcast((uuid.uuid4().hex, items))


def _order(item: tuple[int | None, str]) -> tuple:
    return item[0] is None, item[0] or 0, item[1]


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS):
    """Lists of (item_id, normal form) of at most about ``block_chars``."""
    block, chars = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    for row in rows.distinct().toLocalIterator():
        s = normal(row["text"])
        if s:
            block.append((row["item_id"], s))
            chars += len(s)
        if chars >= block_chars:
            yield sorted(block, key=_order)
            block, chars = [], 0
    if block:
        yield sorted(block, key=_order)


def leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, distance, end_char (in the normal form): the best
    match of each item found in a document; clean documents have no row. (An
    item_id whose texts fall into several blocks has a row for each.)"""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance int, end_char long"
    texts, found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _matcher(shared, error_rate)
            for batch in batches:
                ids, rows = batch.column(0).to_pylist(), []
                for first, part in text_slices(batch.column(1), 8 << 20):
                    for r, text in enumerate(part, first):
                        best: dict[int, tuple[int, int]] = {}
                        for n, distance, end in finder.matches(text):
                            item = finder.items[n][0]
                            best[item] = min(best.get(item, (distance, end)), (distance, end))
                        rows += [(ids[r], item, *got) for item, got in sorted(best.items(), key=_order)]
                columns = list(zip(*rows)) or [[], [], [], []]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "item_id", "distance", "end_char"])

        return run

    for items in item_blocks(benchmark, block_chars):
        hits = stage(texts.mapInArrow(search(_share(items, spark)), schema), "leaks")
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else spark.createDataFrame([], schema)


def is_leak(text: str | Column, items: list[tuple[int, str]], spark, error_rate: float = ERROR_RATE) -> Column:
    """A boolean column: the text holds one of the items of a block."""
    shared = _share(items, spark)

    @F.pandas_udf("boolean")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = _matcher(shared, error_rate)
        for texts in batches:
            yield pd.Series([bool(finder.matches(t if isinstance(t, str) else None)) for t in texts], dtype=bool)

    return found(F.col(text) if isinstance(text, str) else text)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    for items in item_blocks(benchmark, block_chars):
        docs = docs.where(~is_leak(docs["text"], items, docs.sparkSession, error_rate))
    return docs
