"""Near-duplicate passages by compact windows.

A text is its sequence of 5-word shingles. For each of ``HASHES`` hash
functions the Cartesian tree over the shingles' hashes gives compact windows
(l, c, r): every passage of at least ``MIN_WORDS`` words within [l, r] that
contains c has its min-hash at c. Only nodes whose span holds such a passage
matter; they are the minima of the sliding windows of that length, so the tree
is built over these alone. Windows meet across documents if they agree in two
min-hashes: their own, and that of the ``CONTEXT`` shingles before or after the
centre (of a passage of 50 words one of the two always lies within it, whatever
surrounds it). Meetings under enough hash functions (``ENOUGH``) in overlapping
intervals on both sides make a candidate, and candidates are verified: passages
of at least ``MIN_WORDS`` words whose shingle sets have a Jaccard similarity of
``SIMILARITY`` or more. Verified documents are linked and connected components
are the classes.

Groups of equal min-hash never become all pairs: sorted by text, each window
meets its predecessor and the first of its group, within a task before the
shuffle and across tasks after it. Pairs that never meet so can only be in
groups of ``MANY`` or more texts. In such a group every passage of ``SPAN``
shingles within a window is hashed whole, and equal hashes are one class by
themselves, so that each text is linked to one other of the class: texts that
share 50 words exactly are linked whatever else their group holds, and all of
these words are covered. Again a task sends each hash on once, so a passage of
a third of all documents crosses the shuffle once per task.

Texts of such groups that are similar without 50 equal words are compared too
(``similar_pairs``): in groups of up to ``FEW`` all pairs whose centres verified
passages of one class do not cover already, in larger ones those of different
classes that share more than what is common. A similar passage begins and ends
with a shared shingle and is longer than ``RUN`` shingles, so of runs that long
with ``APART`` or more between them no choice holds all that is shared: the runs
that hold a text's most frequent shingles are left out, and every text of the
group that has one of the others is compared with it, whatever their number. Only
ranges count of which other classes hold 8 of 9 shingles, as a similar passage
asks for. Texts of one class are linked already; words of theirs that nothing
covers yet are compared with a few texts of the class, so that the comparisons
grow with the texts and not with the square of the class.

Equal texts have equal keys (a 64-bit hash
of the text), are read once per task, and need no windows to be linked.

The result has a row per document that holds a passage found in another
document: null and short texts, and texts without such a passage, have none.
Rows that repeat a text (whatever their doc_id) are copies of each other; a
null doc_id is linked, but class_id is the smallest doc_id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stage, text_slices
from .components import connected_components

SHINGLE = 5
MIN_WORDS = 50
HASHES = 3
ENOUGH = 1
CONTEXT = 20
SIMILARITY = 0.8
SLICE_BYTES = 4 << 20
FLUSH_WINDOWS = 1_000_000
BROADCAST_ROWS = 500_000
MANY = 4  # of 3 texts all pairs meet
FLUSH_PASSAGES = 2_000_000
SPAN = MIN_WORDS - SHINGLE + 1  # shingles of the shortest passage
RUN = SPAN - 1
APART = 12  # a passage over two runs shares 8 of 9 shingles, so one of those between them
FEW = 64
FLUSH_SHINGLES = 500_000
WINDOW = "hk long, salt long, n int, k int, a long, al int, ac int, ar int, b long, bl int, bc int, br int"

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0x5851F42D4C957F2D)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _ODD
    return h ^ (h >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _POWER, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of ``data``, and where each begins."""
    b = _LOWER[np.frombuffer(data, np.uint8)]
    gap = _BLANK[b]
    start = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    if not len(start):
        return np.zeros(0, np.uint64), start
    begin = np.zeros(len(b), np.int64)
    begin[start] = start
    at = np.arange(len(b)) - np.maximum.accumulate(begin)
    at[gap] = 0
    value = (b.astype(np.uint64) + np.uint64(1)) * _powers(int(at.max()) + 1)[at]
    value[gap] = 0
    return _mix(np.add.reduceat(value, start)), start


def shingles(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, one after another, and their numbers."""
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    h, start = word_hashes(b"\n".join(data))
    ends = np.cumsum([len(d) + 1 for d in data])
    words = np.diff(np.concatenate(([0], np.searchsorted(start, ends))))
    counts = np.maximum(words - SHINGLE + 1, 0)
    if len(h) < SHINGLE:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    n = len(h) - SHINGLE + 1
    out = h[:n].copy()
    for j in range(1, SHINGLE):
        out = out * _STEP + h[j : n + j]
    last = np.repeat(np.cumsum(words), words)[:n]  # a shingle lies within one text
    return _mix(out[np.arange(n) + SHINGLE <= last]), counts


def _sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every ``span`` neighbours, by doubling."""
    have = 1
    while 2 * have <= span:
        x, have = np.minimum(x[:-have], x[have:]), 2 * have
    return x if have == span else np.minimum(x[: len(x) - (span - have)], x[span - have :])


def compact_windows(s: np.ndarray, counts: np.ndarray, k: int, span: int = SPAN):
    """l, c, r, text of the windows under hash function k, positions counting
    from each text's first shingle; and the keys under which they meet."""
    ends = np.cumsum(counts)
    begins = ends - counts
    if len(s) < span:
        none = np.zeros(0, np.int64)
        return none, none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    v = _mix(s * np.uint64((int(_ODD) * (2 * k + 3)) % 2**64 | 1))
    low = np.uint64((1 << int(len(s)).bit_length()) - 1)
    rank = (v & ~low) | np.arange(len(s)).astype(np.uint64)  # ties to the left
    m, near = _sliding_min(rank, span), _sliding_min(v, CONTEXT)
    text_of = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(m)) + span <= ends[text_of[: len(m)]]
    c = np.unique((m[inside] & low).astype(np.int64))
    owner = text_of[c]
    left, right = begins[owner].copy(), ends[owner] - 1
    stack: list[int] = []
    ranks, at, own = rank[c].tolist(), c.tolist(), owner.tolist()
    for i, x in enumerate(ranks):  # Cartesian tree over the centres: nearest smaller to each side
        if stack and own[stack[-1]] != own[i]:
            stack.clear()
        while stack and ranks[stack[-1]] > x:
            right[stack.pop()] = at[i] - 1
        if stack:
            left[i] = at[stack[-1]] + 1
        stack.append(i)
    shift = begins[owner]
    after = near[np.minimum(c + 1, len(near) - 1)]
    before = near[np.maximum(c - CONTEXT, 0)]
    # a text's edge: its own first or last shingle stands for the missing context
    after = np.where(c + CONTEXT < ends[owner], after, v[ends[owner] - 1])
    before = np.where(c - CONTEXT >= begins[owner], before, v[begins[owner]])
    own = v[c] + np.uint64(k)
    return left - shift, c - shift, right - shift, owner, _mix(own * _STEP + after), _mix(own * _POWER + before)


def _grouped(parts: list[tuple]) -> pa.RecordBatch:
    """Windows of a task: those of small groups go on, as does the first of a
    larger one, whose others are paired with their predecessor and with it.
    n: texts a row that goes on stands for. A text's further windows under a
    key are paired with none and make the group one of many."""
    hk, k, a, l, c, r = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((c, a, hk))
    hk, k, a, l, c, r = (x[order] for x in (hk, k, a, l, c, r))
    new = np.concatenate(([True], (hk[1:] != hk[:-1]) | (a[1:] != a[:-1])))
    again = [x[~new & (k == 0)] for x in (hk, k, a, l, c, r)]
    repeats = np.diff(np.append(np.flatnonzero(new), len(new)))
    hk, k, a, l, c, r = (x[new] for x in (hk, k, a, l, c, r))
    opens = np.concatenate(([True], hk[1:] != hk[:-1]))
    first = np.maximum.accumulate(np.where(opens, np.arange(len(hk)), 0))
    size = np.bincount(first, minlength=len(hk))[first]
    several = np.bincount(first, repeats > 1, minlength=len(hk))[first] > 0
    size = np.where(several, np.maximum(size, MANY), size)
    on = opens | (size < MANY)
    later = np.flatnonzero(~on)
    far = later[first[later] != later - 1]
    x = np.concatenate([np.flatnonzero(on), later, far])
    y = np.concatenate([np.full(int(on.sum()), -1), later - 1, first[far]])
    lone = y < 0
    salt = np.where(lone, 0, a[x] | 1)
    n = np.where(size < MANY, 1, size)[x].astype(np.int32)
    e = len(again[0])
    rows = [np.concatenate((z[x], more)) for z, more in zip((hk, k, a, l, c, r), again)]
    salt, n = np.concatenate((salt, again[2] | 1)), np.concatenate((n, np.ones(e, np.int32)))
    lone = np.concatenate((lone, np.ones(e, bool)))
    columns = [pa.array(rows[0]), pa.array(salt), pa.array(n), pa.array(rows[1].astype(np.int32)), pa.array(rows[2])]
    columns += [pa.array(z.astype(np.int32)) for z in rows[3:]]
    columns += [pa.array(np.append(a[y], np.zeros(e, np.int64)), mask=lone)]
    columns += [pa.array(np.append(z[y], np.zeros(e, np.int64)).astype(np.int32), mask=lone) for z in (l, c, r)]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in WINDOW.split(", ")])


def windows(texts: DataFrame) -> DataFrame:
    """``texts`` (key, text) to windows and the pairs met within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts, held = [], 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for first, own in text_slices(batch.column(1), SLICE_BYTES):
                fresh = []
                for i, t in enumerate(own, first):
                    if t and keys[i] not in seen:
                        seen.add(keys[i])
                        fresh.append((keys[i], t))
                if not fresh:
                    continue
                key = np.array([x[0] for x in fresh], np.int64)
                s, counts = shingles([x[1] for x in fresh])
                for k in range(HASHES):
                    l, c, r, owner, *both = compact_windows(s, counts, k)
                    l, c, r = (x.astype(np.int32) for x in (l, c, r))
                    for hk in both:
                        parts.append((hk.view(np.int64), np.full(len(c), k, np.int8), key[owner], l, c, r))
                        held += len(c)
                if held > FLUSH_WINDOWS:
                    yield _grouped(parts)
                    parts, held = [], 0
        if held:
            yield _grouped(parts)

    return texts.mapInArrow(run, WINDOW)


def meetings(found: DataFrame) -> DataFrame:
    """a, b (a < b) and their hits, an entry per pair of windows that met; and
    a, a with a's windows in groups of many texts."""
    side = Window.partitionBy("hk", "salt").orderBy("a", "ac", "ar")
    me = F.struct("k", "a", "al", "ac", "ar", "b", "bl", "bc", "br")
    # most rows are alone in their group and meet none: they go before anything else is made of them
    rows = found.withColumn("alone", F.lag("hk").over(side).isNull() & F.lead("hk").over(side).isNull())
    rows = rows.where(f"NOT alone OR salt <> 0 OR n >= {MANY}").withColumn("own", F.struct("a", "al", "ac", "ar"))
    rows = rows.withColumn("before", F.when(F.col("salt") == 0, F.lag("own").over(side)))
    rows = rows.withColumn("first", F.when(F.col("salt") == 0, F.first("own").over(side)))

    many = (F.col("salt") != 0) | (F.sum("n").over(Window.partitionBy("hk", "salt")) >= MANY)
    rows = rows.withColumn("alone", F.when(many, F.col("own")))

    def with_other(name: str):
        o = F.col(name)
        return F.struct("k", "a", "al", "ac", "ar", o["a"].alias("b"), o["al"].alias("bl"), o["ac"].alias("bc"), o["ar"].alias("br"))

    rows = rows.where("b IS NOT NULL OR before IS NOT NULL OR alone IS NOT NULL")
    met = rows.select("hk", F.posexplode(F.array(me, with_other("before"), with_other("first"), with_other("alone"))).alias("way", "m")).select("way", "hk", "m.*")
    met = met.where("b IS NOT NULL AND (a <> b OR way = 3)")
    turned = [F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (
        ("a", "b", "a"), ("al", "bl", "al"), ("ac", "bc", "ac"), ("ar", "br", "ar"),
        ("b", "a", "b"), ("bl", "al", "bl"), ("bc", "ac", "bc"), ("br", "ar", "br"))]
    hit = F.struct("k", "al", "ac", "ar", "bl", "bc", "br", F.when(F.col("way") == 3, F.col("hk")).alias("hk"))
    return met.select("k", "way", "hk", *turned).groupBy("a", "b").agg(F.collect_set(hit).alias("hits")).where(
        F.size(F.array_distinct(F.transform("hits", lambda h: h["k"]))) >= ENOUGH
    )


def join_intervals(hits: list[tuple], span: int = SPAN) -> list[tuple[int, int, int, int]]:
    """Ranges (a0, a1, b0, b1) where hits (k, al, ac, ar, bl, bc, br, _) under
    enough hash functions overlap by a passage on both sides."""
    out, now = [], None
    for k, al, _, ar, bl, _, br, _ in sorted(hits, key=itemgetter(2, 5)):
        if now and min(now[1], ar) - max(now[0], al) + 1 >= span and min(now[3], br) - max(now[2], bl) + 1 >= span:
            now[0], now[1], now[2], now[3] = min(now[0], al), max(now[1], ar), min(now[2], bl), max(now[3], br)
            now[4].add(k)
            continue
        if now and len(now[4]) >= ENOUGH:
            out.append(tuple(now[:4]))
        now = [al, ar, bl, br, {k}]
    if now and len(now[4]) >= ENOUGH:
        out.append(tuple(now[:4]))
    return out


def starts_of(hits: list[tuple], span: int = SPAN) -> list[tuple[int, int, int, int]]:
    """Ranges of first positions of the passages that hold their window's
    centre, the centre, and the group it is in."""
    every = {(max(al, ac - span + 1), min(ac, ar - span + 1), ac, hk) for _, al, ac, ar, *_, hk in hits}
    return sorted(x for x in every if x[0] <= x[1])


def passage_hashes(s: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Hash of every ``span`` neighbours in their order, by doubling."""
    n, out, have, width = len(s) - span + 1, None, 0, 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    part = _mix(s.astype(np.uint64) * _STEP + _POWER)
    while True:
        if span & 1:
            out = part[:n] if out is None else _mix(out * _POWER + part[have : have + n])
            have += width
        span >>= 1
        if not span:
            return out
        part, width = _mix(part[:-width] * _STEP + part[width:]), 2 * width


def _runs(a: np.ndarray, p: np.ndarray, b: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """a, a0, a1, b, b0, b1 in words: equal passages end to end are one."""
    order = np.lexsort((p, p - q, b, a))
    a, p, b, q = a[order], p[order], b[order], q[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1]) | (p[1:] - q[1:] != p[:-1] - q[:-1]) | (p[1:] > p[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(a))[: len(first)] - 1
    return [a[first], p[first], p[last] + MIN_WORDS - 1, b[first], q[first], q[last] + MIN_WORDS - 1]


def _marked(n: int, lo: int, first: list[int], last: list[int]) -> np.ndarray:
    """Which of the positions lo to lo + n - 1 lie in a range (first, last)."""
    begin = np.clip(np.array(first, np.int64) - lo, 0, n)
    end = np.clip(np.array(last, np.int64) - lo + 1, begin, n)
    return np.cumsum((np.bincount(begin, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n]) > 0


def equal_passages(own: DataFrame) -> DataFrame:
    """a, a0, a1, b, b0, b1 (words) from key, lo, data and ranges (lows, highs)
    of passage starts: every passage that occurs in another text, linked to one of them."""

    def grouped(parts: list[tuple]) -> pa.RecordBatch:
        pk, a, p = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((p, a, pk))
        pk, a, p = pk[order], a[order], p[order]
        opens = np.concatenate(([True], pk[1:] != pk[:-1]))
        at = np.flatnonzero(opens)
        first = np.repeat(at, np.diff(np.append(at, len(pk))))
        last = np.repeat(np.append(at[1:], len(pk)) - 1, np.diff(np.append(at, len(pk))))
        other = np.where(a != a[first], first, last)
        linked = np.flatnonzero(a != a[other])
        sides = _runs(a[linked], p[linked], a[other[linked]], p[other[linked]])
        # the first text's positions go on, as one row
        on = np.flatnonzero(a == a[first])
        more = np.diff(np.append(np.searchsorted(on, at), len(on)))
        places = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(more))).astype(np.int32)), pa.array(p[on].astype(np.int32)))
        lone, n = len(at), len(sides[0])
        columns = [pa.concat_arrays([pa.array(pk[at]), pa.nulls(n, pa.int64())]), pa.concat_arrays([places, pa.nulls(n, places.type)])]
        for k, x in enumerate(sides):
            kind = pa.int64() if k % 3 == 0 else pa.int32()
            head = pa.array(a[at]) if k == 0 else pa.nulls(lone, kind)
            columns.append(pa.concat_arrays([head, pa.array(x.astype(np.int64)).cast(kind)]))
        return pa.RecordBatch.from_arrays(columns, names=["pk", "places", "a", "a0", "a1", "b", "b0", "b1"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for key, lo, data, lows, highs in zip(*(c.to_pylist() for c in batch.columns)):
                h = passage_hashes(np.frombuffer(data, "<u4"))
                at = np.flatnonzero(_marked(len(h), lo, lows, highs))
                parts.append((h[at].view(np.int64), np.full(len(at), key, np.int64), at + lo))
                held += len(at)
                if held > FLUSH_PASSAGES:
                    yield grouped(parts)
                    parts, held = [], 0
        if held:
            yield grouped(parts)

    found = stage(own.mapInArrow(run, "pk long, places array<int>, a long, a0 int, a1 int, b long, b0 int, b1 int"), "equal")
    every = Window.partitionBy("pk")
    me = F.struct("a", F.element_at("places", 1).alias("p"))
    heads = found.where("pk IS NOT NULL").select("pk", "a", "places", F.min(me).over(every).alias("low"), F.max(me).over(every).alias("high"))
    heads = heads.withColumn("o", F.when(F.col("a") != F.col("low.a"), F.col("low")).otherwise(F.col("high"))).where("a <> o.a")
    heads = heads.select("a", F.explode("places").alias("p"), F.col("o.a").alias("b"), F.col("o.p").alias("q"))
    # runs: consecutive positions with one partner and one offset
    side = Window.partitionBy("a", "b", F.col("p") - F.col("q")).orderBy("p")
    heads = heads.distinct().withColumn("run", F.col("p") - F.row_number().over(side))
    words = MIN_WORDS - 1
    heads = heads.groupBy("a", "b", (F.col("p") - F.col("q")).alias("off"), "run").agg(F.min("p").alias("a0"), F.max("p").alias("a1"), F.min("q").alias("b0"), F.max("q").alias("b1"))
    heads = heads.selectExpr("a", "a0", f"a1 + {words} AS a1", "b", "b0", f"b1 + {words} AS b1")
    return heads.union(found.where("pk IS NULL").select(*heads.columns))


def outside_runs(p: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Which of the ascending positions ``p`` lie outside runs of ``RUN``
    positions, ``APART`` or more between them, that together hold the largest
    sum of ``n``. Every passage of more than ``RUN`` shingles that begins and
    ends with a shared one, as do 8 of 9 in it, shares one outside."""
    sums = np.concatenate(([0], np.cumsum(n))).tolist()
    ends, nexts = (np.searchsorted(p, p + x).tolist() for x in (RUN, RUN + APART))
    best = [0] * (len(p) + 1)
    for i in range(len(p) - 1, -1, -1):
        best[i] = max(best[i + 1], sums[ends[i]] - sums[i] + best[nexts[i]])
    out, i = np.ones(len(p), bool), 0
    while i < len(p):
        if best[i] > best[i + 1]:
            out[i : ends[i]] = False
            i = nexts[i]
        else:
            i += 1
    return out


def _states(key: int, lo: int, n: int, root: int | None, first: list | None, last: list | None) -> np.ndarray:
    """A position's state: its text's class if verified passages (words first
    to last) cover it, else its text."""
    out = np.full(n, ~key, np.int64)
    if first:
        out[_marked(n, lo, first, np.array(last) - SHINGLE + 1)] = root
    return out


def _joined(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=names)


def unsettled(spots: DataFrame) -> DataFrame:
    """g, key, class, state and n (the group's rows): centres of groups of many
    texts, but for groups of one state. From key, lo, size, centres, groups,
    root and first, last (words that verified passages cover, if any)."""

    def middles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, lo, size, centres, groups, root, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                state = _states(key, lo, size, root, first, last)
                pair = np.unique(np.stack([groups, state[np.array(centres) - lo]]), axis=1)
                n = pair.shape[1]
                parts.append((pair[0], np.full(n, key, np.int64), np.full(n, ~key if root is None else root, np.int64), pair[1]))
            if parts:
                yield _joined(parts, ["g", "key", "class", "state"])

    rows = spots.select("key", "lo", "size", "centres", "groups", "root", "first", "last")
    rows = rows.mapInArrow(middles, "g long, key long, class long, state long")
    found = rows.groupBy("g").agg(F.min("state").alias("low"), F.max("state").alias("high"), F.count("*").alias("n"))
    return rows.join(found.where("low < high").select("g", "n"), "g")


def _alive(match: np.ndarray) -> np.ndarray:
    """Positions in ranges of ``SPAN`` or more of which 8 of 9 match, as they
    do in every passage that ``verify`` can find."""
    out = np.zeros(len(match) + 1, np.int64)
    p = np.concatenate(([0], np.cumsum(np.where(match, 1, -8))))
    highs = np.maximum.accumulate(p[::-1])[::-1]
    ends = np.searchsorted(-highs, -p, side="right") - 1  # the farthest end of such a range
    begin = np.flatnonzero(ends - np.arange(len(p)) >= SPAN)
    np.add.at(out, begin, 1)
    np.add.at(out, ends[begin], -1)
    return np.cumsum(out)[:-1] > 0


def similar_pairs(own: DataFrame) -> DataFrame:
    """a, b (a < b): texts still to compare, from ``unsettled``'s columns and
    data, lows, highs. Texts of two classes are compared if they share one of
    the shingles ``outside_runs``, where other classes hold enough around it
    (``_alive``); the texts of the class that most of a group are in need not
    look for the others, which look for them. Words that no verified passage
    covers are looked up in the text's own class in the same way, but with a few
    texts of the class: the texts are linked already."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held, names = [], 0, ["g", "s", "key", "class", "p", "bare", "starts"]
        for batch in batches:
            for key, lo, data, lows, highs, groups, root, first, last, large in zip(*(c.to_pylist() for c in batch.columns)):
                s = np.frombuffer(data, "<i4")
                bare = _states(key, lo, len(s), root, first, last) == ~key
                lows, highs, groups = np.array(lows), np.array(highs) + SPAN - 1, np.array(groups)
                own = ~key if root is None else root
                for g, most in {(x["g"], x["most"]) for x in large}:
                    at = np.flatnonzero(_marked(len(s), lo, lows[groups == g], highs[groups == g]))
                    starts = own != most or bool(bare[at].any())
                    parts.append((np.full(len(at), g, np.int64), s[at], np.full(len(at), key, np.int64), np.full(len(at), own, np.int64),
                                  (at + lo).astype(np.int32), bare[at], np.full(len(at), starts)))
                    held += len(at)
                if held > FLUSH_SHINGLES:
                    yield _joined(parts, names)
                    parts, held = [], 0
        if held:
            yield _joined(parts, names)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for key, g, own, most, rows in zip(*(c.to_pylist() for c in batch.columns[:4]), batch.column(4)):
                p, s, n, *flags = (rows.values.field(k).to_numpy(zero_copy_only=False) for k in range(6))
                order = np.argsort(p, kind="stable")
                p, s, n, bare, other, same = (x[order] for x in (p, s, n, *flags))
                at = p - p[0]
                for inside, match in ((False, other), (True, same)):
                    if not inside and own == most:
                        continue
                    marks = np.zeros(at[-1] + 1, bool)
                    marks[at] = match
                    alive = _alive(marks)
                    if inside:  # stretches with words that nothing covers
                        stretch = np.cumsum(np.diff(alive, prepend=False))
                        alive &= np.isin(stretch, stretch[at[bare & alive[at]]])
                    own_p = match & alive[at]
                    q, t = p[own_p], s[own_p]
                    t = np.unique(t[outside_runs(q, n[own_p])])
                    parts.append((np.full(len(t), g, np.int64), t, np.full(len(t), key, np.int64), np.full(len(t), own, np.int64), np.full(len(t), inside)))
            if parts:
                yield _joined(parts, ["g", "s", "a", "own", "inside"])

    some = stage(unsettled(own), "unsettled")
    few, many = some.where(F.col("n") <= FEW), some.where(F.col("n") > FEW)
    most = many.groupBy("g", "class").agg(F.count("*").alias("n")).groupBy("g").agg(F.max_by("class", F.struct("n", "class")).alias("most"))
    large = many.select("g", "key").distinct().join(most, "g").groupBy("key").agg(F.collect_list(F.struct("g", "most")).alias("large"))
    found = own.join(large, "key").select("key", "lo", "data", "lows", "highs", "groups", "root", "first", "last", "large")
    found = stage(found.mapInArrow(places, "g long, s int, key long, class long, p int, bare boolean, starts boolean"), "places")
    some_way = F.xxhash64("key", F.expr("pmod(s, 4)"))  # other texts for other shingles, but not for each
    held = found.groupBy("g", "s", "class").agg(F.count("*").alias("n"), F.min_by("key", some_way).alias("low"), F.max_by("key", some_way).alias("high"))
    held = held.withColumn("same", F.expr("low <> high"))
    every = held.groupBy("g", "s").agg(F.sum("n").alias("n"), (F.min("class") < F.max("class")).alias("other"))
    rows = found.where("starts").join(held.select("g", "s", "class", "same"), ["g", "s", "class"]).join(every, ["g", "s"]).where("same OR other")
    rows = rows.groupBy("key", "g", "class").agg(F.collect_list(F.struct("p", "s", "n", "bare", "other", "same")).alias("rows")).join(most, "g")
    rows = rows.select("key", "g", "class", "most", "rows")
    outs = stage(rows.mapInArrow(keys, "g long, s int, a long, own long, inside boolean"), "outs")
    apart = outs.where("NOT inside")
    at = stage(apart.join(held.select("g", "s", "class"), ["g", "s"]).where("class <> own").select("g", "s", "class").distinct(), "at")
    if at.count() <= BROADCAST_ROWS:
        at = F.broadcast(at)
    rest = found.join(at, ["g", "s", "class"], "left_semi").select("g", "s", "key", "class").distinct()
    met = apart.join(rest, ["g", "s"]).where("class <> own").select("a", "key")
    near = outs.where("inside").join(held.withColumnRenamed("class", "own"), ["g", "s", "own"])
    near = near.select("a", F.explode(F.array("low", "high")).alias("key")).where("a <> key")
    two = few.selectExpr("g", "key AS a", "state AS own").join(few, "g").where("key <> a AND state <> own")
    met = met.union(near).union(two.select("a", "key"))
    return met.select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).distinct()


def _in(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted ``own``."""
    at = np.searchsorted(own, x)
    at[at == len(own)] = 0
    return own[at] == x


def _longest(match: np.ndarray, span: int) -> tuple[int, int] | None:
    """The longest range in which at least 8 of 9 positions match: passages
    of equal length with that share have a similarity of 0.8."""
    n = int(np.count_nonzero(match))
    if 9 * n < 8 * span:
        return None
    if n == len(match):
        return (0, n) if n >= span else None
    p = np.concatenate(([0], np.cumsum(np.where(match, 1, -8))))
    lows = np.minimum.accumulate(p)
    highs = np.maximum.accumulate(p[::-1])[::-1]
    ends = np.searchsorted(-highs, -lows, side="right") - 1  # the last to reach each running minimum
    i = int(np.argmax(ends - np.arange(len(p))))
    at = np.flatnonzero(match[i : ends[i]])
    if not len(at):
        return None
    i, j = i + int(at[0]), i + int(at[-1]) + 1
    return (i, j) if j - i >= span else None


def verify(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY, span: int = SPAN) -> list[tuple[int, int, int, int]]:
    """Passages (first, last in a; first, last in b, in shingles) of at least
    ``span`` shingles with similar shingle sets."""
    if len(a) < span or len(b) < span:
        return []
    if len(a) == len(b) and (a == b).all():
        return [(0, len(a) - 1, 0, len(b) - 1)]
    out, todo, match = [], [(0, len(a))], _in(a, np.sort(b))
    while todo:
        x, y = todo.pop()
        got = _longest(match[x:y], span) if y - x >= span else None
        if not got:
            continue
        i, j = x + got[0], x + got[1]
        other = _longest(_in(b, np.sort(a[i:j])), span)
        while other:  # what only other parts of b match goes, until both ranges stand
            p, q = other
            again = _longest(_in(a[i:j], np.sort(b[p:q])), span)
            if not again or again == (0, j - i):
                break
            i, j = i + again[0], i + again[1]
            other = _longest(_in(b, np.sort(a[i:j])), span)
        if other:
            one, two = set(a[i:j].tolist()), set(b[p:q].tolist())
            same = len(one & two)
            if same >= similarity * (len(one) + len(two) - same):
                out.append((i, j - 1, p, q - 1))
        todo += [(x, i), (j, y)]
    return out


def _slices(texts: DataFrame, need: DataFrame) -> DataFrame:
    """key, lo, data (32-bit shingle hashes lo to hi) of the needed ranges."""
    if need.count() <= BROADCAST_ROWS:
        need = F.broadcast(need)
    rows = texts.join(need, "key").select("key", "lo", "hi", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keys, lo, hi = (batch.column(k).to_pylist() for k in range(3))
            for first, own in text_slices(batch.column(3), SLICE_BYTES):
                fresh = [i for i in range(first, first + len(own)) if not (keys[i] in seen or seen.add(keys[i]))]
                s, counts = shingles([own[i - first] for i in fresh])
                at = np.cumsum(counts) - counts
                data = [s[x + lo[i] : x + hi[i] + 1].astype("<u4").tobytes() for i, x in zip(fresh, at.tolist())]
                columns = [pa.array([keys[i] for i in fresh], pa.int64()), pa.array([lo[i] for i in fresh], pa.int32()), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "lo", "data"])

    out = rows.mapInArrow(run, "key long, lo int, data binary")
    return out.groupBy("key").agg(F.first("lo").alias("lo"), F.first("data").alias("data"))


def compared(found: DataFrame, cut: DataFrame) -> DataFrame:
    """a, a0, a1, b, b0, b1 (words): the verified passages of pairs a, b, in
    their ranges a0 to a1 and b0 to b1 if they have any, else in whole slices."""
    both, whole = found, "a0" not in found.columns
    for x in "ab":  # the range's hashes, 4 bytes each
        own = cut.select(F.col("key").alias(x), F.col("lo").alias(f"{x}0" if whole else "_lo"), F.col("data").alias(f"{x}_data" if whole else "_data"))
        both = both.join(own, x)
        if not whole:
            part = F.expr(f"substring(_data, 4 * ({x}0 - _lo) + 1, 4 * ({x}1 - {x}0 + 1))")
            both = both.withColumn(f"{x}_data", part).drop("_lo", "_data")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "a0", "a1", "b", "b0", "b1"]
        for batch in batches:
            rows = []
            for a, a0, b, b0, one, two in zip(*(c.to_pylist() for c in batch.columns[:4]), *batch.columns[4:]):
                for i, j, p, q in verify(np.frombuffer(one.as_buffer(), "<u4"), np.frombuffer(two.as_buffer(), "<u4")):
                    more = SHINGLE - 1
                    rows.append((a, a0 + i, a0 + j + more, b, b0 + p, b0 + q + more))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    both = both.select("a", "a0", "b", "b0", "a_data", "b_data")
    return both.mapInArrow(check, "a long, a0 int, a1 int, b long, b0 int, b1 int")


def _sides(shared: DataFrame) -> DataFrame:
    sides = shared.selectExpr("a AS key", "b AS other", "a0 AS first", "a1 AS last")
    return sides.union(shared.selectExpr("b", "a", "b0", "b1"))


def passages(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """a, a0, a1, b, b0, b1 (words, inclusive): verified passages that the
    different texts a and b share; and the components (node, root) they make."""
    pairs = meetings(windows(texts))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "a0", "a1", "b0", "b1", "lows", "highs", "centres", "groups"]
        for batch in batches:
            rows, hits = [], batch.column(2)
            every = list(zip(*(x.fill_null(0).to_numpy().tolist() for x in hits.flatten().flatten())))
            cuts = (hits.offsets.to_numpy() - hits.offsets[0].as_py()).tolist()
            for a, b, i, j in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), cuts, cuts[1:]):
                if a == b:
                    lows, highs, *middles = zip(*starts_of(every[i:j]))  # a window holds a passage
                    rows.append((a, b, min(lows), max(highs) + SPAN - 1, None, None, lows, highs, *middles))
                else:
                    rows += [(a, b, *x, None, None, None, None) for x in join_intervals(every[i:j])]
            columns = list(zip(*rows)) or [[]] * 10
            kinds = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.list_(pa.int32())] * 3 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    kinds = "a long, b long, a0 int, a1 int, b0 int, b1 int, lows array<int>, highs array<int>, centres array<int>, groups array<long>"
    found = stage(pairs.mapInArrow(candidates, kinds), "candidates")
    alone, found = found.where("a = b"), found.where("a <> b").drop("lows", "highs", "centres", "groups")
    need = found.selectExpr("a AS key", "a0 AS lo", "a1 AS hi").union(found.selectExpr("b", "b0", "b1"))
    need = need.union(alone.select("a", "a0", "a1"))
    need = stage(need.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "need")
    cut = stage(_slices(texts, need), "slices")
    alone = alone.select(F.col("a").alias("key"), "lows", "highs", "centres", "groups")
    own = cut.join(alone, "key").withColumn("size", F.expr("cast(length(data) / 4 AS int)"))
    shared = stage(compared(found, cut).union(equal_passages(own.select("key", "lo", "data", "lows", "highs"))), "passages")
    roots = stage(connected_components(shared.select("a", "b")), "roots")
    more = stage(compared(similar_pairs(_covered(own, shared, roots)), cut), "similar")
    return shared.union(more), _merged(roots, more)


def _covered(own: DataFrame, shared: DataFrame, roots: DataFrame) -> DataFrame:
    """``own`` with its texts' root and the words first to last that passages cover."""
    done = _sides(shared).join(own.select("key"), "key", "left_semi").select("key", "first", "last").distinct()
    done = done.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("done"))
    done = done.select("key", F.col("done.first").alias("first"), F.col("done.last").alias("last"))
    return own.join(done, "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left")


def _merged(roots: DataFrame, more: DataFrame) -> DataFrame:
    """Components (node, root) after the passages ``more``, whose links join
    components of ``roots``, or single texts."""
    links = more.select("a", "b").distinct()
    for x in "ab":
        links = links.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")), x, "left")
    links = links.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    late = stage(connected_components(links), "late")
    moved = late.select(F.col("node").alias("root"), F.col("root").alias("_to"))
    first = roots.join(moved, "root", "left").select("node", F.coalesce("_to", "root").alias("root"))
    return first.union(late.join(roots, "node", "left_anti").select("node", "root"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links (other texts compared and found to share a
    passage, not all of its class, and copies), n_words (covered) and passages (first and last word)."""
    texts = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("key"), "text")
    shared, roots = passages(texts)
    sides = _sides(shared)
    links = sides.select("key", "other").distinct().groupBy("key").agg(F.count("*").alias("n_texts"))
    ranges = sides.select("key", "first", "last").distinct().groupBy("key").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("ranges"))
    merged = """aggregate(ranges, cast(array() AS array<struct<first:int,last:int>>), (done, x) ->
        CASE WHEN size(done) > 0 AND x.first <= element_at(done, -1).last + 1
        THEN concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first, 'last', greatest(element_at(done, -1).last, x.last))))
        ELSE concat(done, array(x)) END)"""
    marked = ranges.select("key", F.expr(merged).alias("passages")).join(links, "key").join(roots.withColumnRenamed("node", "key"), "key")

    rows = stage(docs.where("text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.regexp_count("text", F.lit(WORD)).alias("words")), "keys")
    copies = rows.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"), F.max("words").alias("words"))
    copies = copies.join(marked, "key", "left").where(f"root IS NOT NULL OR copies > 1 AND words >= {MIN_WORDS}")
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("words") - 1).cast("int").alias("last")))
    copies = copies.withColumn("passages", F.when((F.col("copies") > 1) & (F.col("words") >= MIN_WORDS), whole).otherwise(F.col("passages")))
    copies = copies.withColumn("root", F.coalesce("root", "key")).withColumn("n_links", F.coalesce("n_texts", F.lit(0)) + F.col("copies") - 1)
    classes = copies.groupBy("root").agg(F.min("least").alias("class_id"))
    named = stage(copies.join(classes, "root").select("key", "class_id", "n_links", "passages"), "classes")
    n_words = F.expr("aggregate(passages, 0L, (s, p) -> s + p.last - p.first + 1)")
    return rows.join(named, "key").select("doc_id", "class_id", "n_links", n_words.alias("n_words"), "passages")
