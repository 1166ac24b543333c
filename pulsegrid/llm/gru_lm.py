"""Language-model scoring with a gated recurrent network.

Counts come from all training documents: a distributed word count gives c, N
and V of the base score. The ``HEAD`` most frequent words (a fixed bound) go to
the tasks; all other words are joined with the count table.

The network reads a document token by token and predicts the next one with a
class-factored softmax. The ``GROUPS * GROUP`` most frequent words are in
groups of equal rank: P(word) = P(group | state) * P(word | group, state). All
other words fall into ``TAILS`` classes by their last two bytes, and within
such a class P(word) = (c + 0.5) / (counts of the class + 0.5 * (its words +
1)) from the corpus counts, so that the whole is a distribution over known
words and one unknown word per class. The end is a class of its own. Biases
start at the log shares of the whole corpus. Weights are fitted in numpy by
truncated backpropagation: they start from a bounded sample of training
documents (``SAMPLE_DOCS`` of at most ``SAMPLE_CHARS`` characters, the first by
hash of doc_id), from which every task reads all of its training documents,
long ones too, and the tasks' weights are averaged by their tokens. Scoring reads whole documents, many side by side, in windows
of ``WINDOW`` tokens, the state being carried from window to window.

A null text is the empty text: the end alone. Rows with a null doc_id are
scored but teach nothing; repeated rows count and are scored each. Without
training documents all counts are 0 and the network keeps its first weights.
"""

from __future__ import annotations

import copy
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, stage, text_slices

HEAD = 131_072
HEAD_BYTES = 64
GROUPS, GROUP = 32, 64
TAILS = 64
HIDDEN = 32
WINDOW = 32
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 20_000
EPOCHS = 2
BATCH = 64
SIDE_BY_SIDE = 512
FIT_BATCH = 512
FIT_TOKENS = 200_000
FIT_RATE = 0.01
FLUSH_WORDS = 300_000
SLICE_BYTES = 16 << 20
ROWS_AT_ONCE = 2048
SEED = 5
OUT = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, words array<binary>, times array<long>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").lower().split()


def tail_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


class GRU:
    """Gated recurrent language model over class tokens.

    Tokens: 0 the end, 1..TAILS the tail classes, then the grouped words.
    Output classes: the end, the tail classes, then the groups."""

    def __init__(self, group_counts: np.ndarray, class_counts: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        n, classes = 1 + TAILS + len(group_counts), len(class_counts)
        self.words = len(group_counts)
        self.first = 1 + TAILS

        def normal(*shape):
            return rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)

        shares = np.log((class_counts + 0.5) / (class_counts + 0.5).sum())
        word_bias = np.log(group_counts + 0.5).astype(np.float32) if self.words else np.zeros(0, np.float32)
        self.p = {
            "gx": (0.3 * rng.normal(0, 1, (n, 3 * HIDDEN))).astype(np.float32),  # embedding and input weights in one
            "u": normal(HIDDEN, 3 * HIDDEN),
            "c": 0.1 * normal(HIDDEN, classes),
            "c_bias": np.where(np.arange(classes) < self.first + -(-self.words // GROUP), shares, -30).astype(np.float32),  # no empty groups
            "w": 0.1 * normal(HIDDEN, self.words) if self.words else np.zeros((HIDDEN, 0), np.float32),
            "w_bias": word_bias,
        }

    def split(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class, and grouped word (or -1), of tokens."""
        word = token - self.first
        return np.where(word < 0, token, self.first + word // GROUP), np.where(word < 0, -1, word)

    def step(self, h: np.ndarray, token: np.ndarray):
        gx, gh = self.p["gx"].take(token, axis=0), h @ self.p["u"]
        gates = gx[:, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        inner = gh[:, 2 * HIDDEN :]
        n = r * inner
        n += gx[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        out = h - n
        out *= z
        out += n
        return out, (r, z, n, inner)

    @staticmethod
    def _log_chosen(x: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """Log softmax of one column per row; ``x`` is overwritten."""
        x -= x.max(axis=1, keepdims=True)
        got = x[np.arange(len(x)), chosen]
        np.exp(x, out=x)
        return got - np.log(x @ np.ones(x.shape[1], x.dtype))

    @staticmethod
    def _error(x: np.ndarray, chosen: np.ndarray, scale: np.float32) -> np.ndarray:
        """Gradient of ``scale`` times the cross entropy; ``x`` is overwritten."""
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        x *= (scale / (x @ np.ones(x.shape[1], x.dtype)))[:, None]
        x[np.arange(len(x)), chosen] -= scale
        return x

    def _grouped(self, word: np.ndarray):
        """Rows of each group that occurs, with its span of words."""
        group = (word // GROUP).astype(np.int16)  # short integers sort by radix
        order = np.argsort(group, kind="stable")
        cuts = np.searchsorted(group[order], np.arange(GROUPS + 1, dtype=np.int16))
        for g in range(GROUPS):
            if cuts[g + 1] > cuts[g]:
                yield order[cuts[g] : cuts[g + 1]], g * GROUP, min((g + 1) * GROUP, self.words)

    def log_likelihood(self, h: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Natural log P(token | state) for each row."""
        classes, word = self.split(token)
        out = np.empty(len(token))
        for k in range(0, len(token), ROWS_AT_ONCE):
            out[k : k + ROWS_AT_ONCE] = self._log_chosen(h[k : k + ROWS_AT_ONCE] @ self.p["c"] + self.p["c_bias"], classes[k : k + ROWS_AT_ONCE])
        for rows, a, b in self._grouped(word):
            out[rows] += self._log_chosen(h.take(rows, axis=0) @ self.p["w"][:, a:b] + self.p["w_bias"][a:b], word[rows] - a)
        return out

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Natural log-likelihood of whole token sequences."""
        order = np.argsort([-len(d) for d in docs], kind="stable")
        out = np.empty(len(docs))
        for k in range(0, len(docs), SIDE_BY_SIDE):  # of like length
            part = order[k : k + SIDE_BY_SIDE]
            out[part] = self._score([docs[n] for n in part])
        return out

    def _score(self, docs: list[np.ndarray]) -> np.ndarray:
        lengths = np.array([len(d) for d in docs], np.int64)
        order = np.argsort(-lengths, kind="stable")
        flat = np.concatenate([docs[k] for k in order]) if docs else np.zeros(0, np.int64)
        lengths, total = lengths[order], np.zeros(len(docs))
        start = np.concatenate(([0], np.cumsum(lengths)[:-1])) if docs else lengths
        h = np.zeros((len(docs), HIDDEN), np.float32)
        t = 0
        while len(docs) and t < lengths[0]:
            states, tokens, owners = [], [], []
            for t in range(t, min(t + WINDOW, int(lengths[0]))):
                active = int(np.searchsorted(-lengths, -t, side="left"))  # documents longer than t
                h = h[:active]  # others have ended: documents are sorted by length
                token = flat[start[:active] + t]
                states.append(h)
                tokens.append(token)
                owners.append(np.arange(active))
                h, _ = self.step(h, token)
            logs = self.log_likelihood(np.concatenate(states), np.concatenate(tokens))
            total += np.bincount(np.concatenate(owners), logs, len(docs))
            t += 1
        out = np.empty(len(docs))
        out[order] = total
        return out

    # ------------------------------------------------------------ training

    def fit(self, docs: list[np.ndarray], epochs: int = EPOCHS, seed: int = SEED, moments: list | None = None, pace: float = 0.01, batch: int = BATCH) -> "GRU":
        """Truncated backpropagation: documents end to end in ``batch`` rows,
        windows of ``WINDOW`` tokens, the state carried but not its gradient;
        it restarts where a document ends. With ``moments`` (empty at first)
        the optimizer goes on from call to call."""
        if not docs:
            return self
        rng = np.random.default_rng(seed)
        if moments:
            first, second, steps = moments
        else:
            first = {k: np.zeros_like(v) for k, v in self.p.items()}
            second = {k: np.zeros_like(v) for k, v in self.p.items()}
            steps = 0
        for epoch in range(epochs):
            flat = np.concatenate([docs[k] for k in rng.permutation(len(docs))])
            rows = min(batch, max(1, len(flat) // WINDOW))
            width = len(flat) // rows
            grid, h = flat[: rows * width].reshape(rows, width), np.zeros((rows, HIDDEN), np.float32)
            for k in range(0, width, WINDOW):
                h, g = self._window(grid[:, k : k + WINDOW], h)
                steps += 1
                norm = float(np.sqrt(sum(float((x * x).sum()) for x in g.values())))
                rate = pace * (0.3 if moments is None and epoch == epochs - 1 and k > width // 2 else 1)
                rate *= (1 - 0.999**steps) ** 0.5 / (1 - 0.9**steps)
                for name, x in g.items():
                    x = x * min(1.0, 5.0 / (norm + 1e-9))
                    first[name] += 0.1 * (x - first[name])
                    second[name] += 0.001 * (x * x - second[name])
                    self.p[name] -= (rate * first[name] / (np.sqrt(second[name]) + 1e-6)).astype(np.float32)
        if moments is not None:
            moments[:] = first, second, steps
        return self

    def _window(self, tokens: np.ndarray, h: np.ndarray):
        p, (rows, span) = self.p, tokens.shape
        states, memory = np.empty((span, rows, HIDDEN), np.float32), []
        goes_on = (tokens.T != 0)[:, :, None]
        for t in range(span):
            states[t] = h
            h, kept = self.step(h, tokens[:, t])
            memory.append(kept)
            h *= goes_on[t]  # a new document begins with no state
        g = {k: np.zeros_like(v) for k, v in p.items()}
        every, target = states.reshape(-1, HIDDEN), tokens.T.ravel()
        classes, word = self.split(target)
        scale, back = np.float32(1 / rows), np.empty_like(every)
        for k in range(0, len(every), ROWS_AT_ONCE):
            part = every[k : k + ROWS_AT_ONCE]
            d = self._error(part @ p["c"] + p["c_bias"], classes[k : k + ROWS_AT_ONCE], scale)
            g["c"] += part.T @ d
            g["c_bias"] += d.sum(axis=0)
            back[k : k + ROWS_AT_ONCE] = d @ p["c"].T
        for own, a, b in self._grouped(word):
            part = every.take(own, axis=0)
            d = self._error(part @ p["w"][:, a:b] + p["w_bias"][a:b], word[own] - a, scale)
            g["w"][:, a:b], g["w_bias"][a:b] = part.T @ d, d.sum(axis=0)
            back[own] += d @ p["w"][:, a:b].T
        back = back.reshape(span, rows, HIDDEN)
        dx, du = (np.empty((span, rows, 3 * HIDDEN), np.float32) for _ in range(2))
        dh, u_back = np.zeros((rows, HIDDEN), np.float32), np.ascontiguousarray(p["u"].T)
        for t in range(span - 1, -1, -1):
            r, z, n, inner = memory[t]
            dh *= goes_on[t]
            dn = dh * (1 - z)
            dn *= 1 - n * n
            dx[t, :, :HIDDEN] = dn * inner * r * (1 - r)
            dx[t, :, HIDDEN : 2 * HIDDEN] = dh * (states[t] - n) * z * (1 - z)
            dx[t, :, 2 * HIDDEN :] = dn
            du[t, :, : 2 * HIDDEN] = dx[t, :, : 2 * HIDDEN]
            du[t, :, 2 * HIDDEN :] = dn * r
            dh *= z
            dh += du[t] @ u_back
            dh += back[t]
        g["u"] = every.T @ du.reshape(-1, 3 * HIDDEN)
        order = np.argsort(target.astype(np.int16), kind="stable")  # fewer tokens than 2^15
        seen, first = np.unique(target[order], return_index=True)
        g["gx"][seen] = np.add.reduceat(dx.reshape(-1, 3 * HIDDEN).take(order, axis=0), first, axis=0)
        return h, g


class Scorer:
    """What the tasks need: head words with counts, class totals, the network."""

    def __init__(self, head: list[tuple[bytes, int]], tokens: int, types: int, ends: int, tail_sums: np.ndarray, tail_types: np.ndarray):
        grouped = min(GROUPS * GROUP, len(head))
        self.index = {w: k for k, (w, _) in enumerate(head)}
        counts = np.array([c for _, c in head], np.float64)
        tails = np.array([tail_of(w) for w, _ in head], np.int64)
        for k in range(grouped):  # grouped words are not in the tail classes
            tail_sums[tails[k]] -= counts[k]
            tail_types[tails[k]] -= 1
        self.total, self.ends = tokens + 0.5 * (types + 1), ends
        self.tail_total = tail_sums + 0.5 * (tail_types + 1)
        self.token = np.where(np.arange(len(head)) < grouped, 1 + TAILS + np.arange(len(head)), 1 + tails)
        self.base = np.log10((counts + 0.5) / self.total)
        self.own = np.where(np.arange(len(head)) < grouped, 0.0, np.log10((counts + 0.5) / self.tail_total[tails]))
        groups = np.add.reduceat(counts[:grouped], np.arange(0, grouped, GROUP)) if grouped else np.zeros(0)
        groups = np.pad(groups, (0, GROUPS - len(groups)))
        self.net = GRU(counts[:grouped], np.concatenate([[ends], tail_sums, groups]))

    def tokens_of(self, own: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Network tokens with the end, head numbers of the known words, and
        the words that are not in the head."""
        at = np.fromiter(map(self.index.get, own, repeat(-1)), np.int64, len(own))
        missing = np.flatnonzero(at < 0)
        token = np.zeros(len(own) + 1, np.int64)  # the last one is the end
        if not len(missing):
            token[:-1] = self.token[at]
            return token, at, []
        rest = [own[k] for k in missing.tolist()]
        known = at >= 0
        token[:-1][known] = self.token[at[known]]
        token[missing] = [1 + tail_of(w) for w in rest]
        return token, at[known], rest

    def score(self, texts: list[str | None]) -> list[tuple]:
        """(n_tokens, n_known, base, score, rest words, their counts) of each
        text, the words outside the head still missing from the sums."""
        parts = [self.tokens_of(words(t)) for t in texts]
        logs = self.net.score([p[0] for p in parts]) / np.log(10)
        end = np.log10((self.ends + 0.5) / self.total)
        out = []
        for (token, at, rest), log in zip(parts, logs):
            times = Counter(rest)
            base = float(self.base[at].sum()) + end
            score = float(log) + float(self.own[at].sum())
            out.append((len(token), len(at) + (self.ends > 0), base, score, list(times), list(times.values())))
        return out


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), c: counts over all documents, summed within tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush():
            columns = [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "c"])

        for batch in batches:
            for _, texts in text_slices(batch.column(0), 4 << 20):
                for t in texts:
                    seen.update(words(t))
                if len(seen) > FLUSH_WORDS:
                    yield flush()
                    seen.clear()
        yield flush()

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame) -> list[tuple[bytes, int]]:
    """At most ``HEAD`` words and their counts, the most frequent first: all
    from the lowest count class on that lets them fit (16 classes per octave;
    if even the first class is too large, its words by hash)."""
    own = counts.where(F.length("word") <= HEAD_BYTES).withColumn("class", F.floor(F.log2("c") * 16))
    sizes = own.groupBy("class").agg(F.count("*").alias("n")).orderBy(F.col("class").desc()).collect()  # about 1000 at most
    total, least = 0, None
    for r in sizes:
        if total + r["n"] > HEAD:
            break
        total, least = total + r["n"], r["class"]
    if least is None:
        own = own.orderBy(F.xxhash64("word")).limit(HEAD if sizes else 0)
    else:
        own = own.where(F.col("class") >= least)
    rows = [(bytes(r["word"]), r["c"]) for r in own.select("word", "c").collect()]
    return sorted(rows, key=lambda x: (-x[1], x[0]))


def train(docs: DataFrame, counts: DataFrame) -> Scorer:
    """The scorer for training documents ``docs`` with their ``counts``."""
    ends = docs.count()
    tail = F.crc32(F.expr(f"substring(word, greatest(length(word) - 1, 1), 2)")) % TAILS
    sums = counts.groupBy(tail.alias("tail")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect()
    tail_sums, tail_types = np.zeros(TAILS), np.zeros(TAILS)
    for r in sums:
        tail_sums[r["tail"]], tail_types[r["tail"]] = r["c"], r["n"]
    tokens, types = int(tail_sums.sum()) + ends, int(tail_types.sum()) + (ends > 0)
    scorer = Scorer(frequent_words(counts), tokens, types, ends, tail_sums, tail_types)
    scorer.tokens, scorer.types = tokens, types
    few = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS).select("doc_id", F.xxhash64("doc_id").alias("key"))
    few = few.orderBy("key", "doc_id").limit(SAMPLE_DOCS).select("doc_id").distinct()
    sample = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS).join(F.broadcast(few), "doc_id", "left_semi")
    sample = sample.orderBy("doc_id", F.xxhash64("text")).limit(2 * SAMPLE_DOCS)
    texts = sorted((r["doc_id"], r["text"] or "") for r in sample.select("doc_id", "text").collect())
    scorer.net.fit([scorer.tokens_of(words(t))[0] for _, t in texts])
    fit_everywhere(scorer, docs)
    return scorer


def fit_everywhere(scorer: Scorer, docs: DataFrame) -> None:
    """One pass over all of ``docs``: each task goes on from the scorer's
    weights over its own documents; the mean of the tasks' weights, by tokens,
    is summed in a tree."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    names = list(scorer.net.p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, net = shared.value, copy.copy(shared.value.net)
        net.p = {k: v.copy() for k, v in net.p.items()}
        moments, chunk, held, total = [], [], 0, 0

        def learn():  # rows side by side double with every chunk, so that small parts get steps enough
            net.fit(chunk, 1, moments=moments, pace=FIT_RATE, batch=min(FIT_BATCH, BATCH << min(total // FIT_TOKENS, 9)))

        for batch in batches:
            for _, texts in text_slices(batch.column(0), SLICE_BYTES):
                for t in texts:
                    chunk.append(own.tokens_of(words(t))[0])
                    held += len(chunk[-1])
                    if held >= FIT_TOKENS:
                        learn()
                        chunk, held, total = [], 0, total + held
        learn()
        total += held
        if total:
            data = [net.p[k].astype(np.float32).tobytes() for k in names]
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.int64()), pa.array([data], pa.list_(pa.binary()))], names=["tokens", "weights"])

    def add(a, b):
        return b if a is None else a if b is None else (a[0] + b[0], [x + y for x, y in zip(a[1], b[1])])

    def weighted(r):
        return r["tokens"], [np.frombuffer(x, np.float32).astype(np.float64) * r["tokens"] for x in r["weights"]]

    fitted = docs.select("text").mapInArrow(run, "tokens long, weights array<binary>").rdd.map(weighted)
    got = fitted.treeAggregate(None, add, add) if fitted.getNumPartitions() else None
    if got:
        for k, x in zip(names, got[1]):
            scorer.net.p[k] = (x / got[0]).astype(np.float32).reshape(scorer.net.p[k].shape)


def score_documents(docs: DataFrame, fold_mod: int = 5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    learned = rows.where(crc_mod("doc_id", fold_mod) != 1)
    counts = stage(count_words(learned), "counts")
    scorer = train(learned, counts)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, row = shared.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in text_slices(batch.column(1), SLICE_BYTES):
                got = scorer.score(texts)
                own = ids[first : first + len(texts)]
                held = [i is not None and zlib.crc32(str(i).encode()) % fold_mod == 1 for i in own]
                columns = [range(row, row + len(own)), own, held, *zip(*got)]
                kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                names = [field.split()[0] for field in OUT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
                row += len(own)

    scored = stage(rows.mapInArrow(run, OUT), "scored")
    rest = scored.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select("row", "w.words", "w.times")
    rest = rest.join(counts.select(F.col("word").alias("words"), "c"), "words", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    tail = F.crc32(F.expr("substring(words, greatest(length(words) - 1, 1), 2)")) % TAILS
    totals = F.array(*[F.lit(float(x)) for x in scorer.tail_total])
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.col("c") + 0.5) / F.lit(float(scorer.total)))).alias("more_base"),
        F.sum(F.col("times") * F.log10((F.col("c") + 0.5) / F.element_at(totals, (tail + 1).cast("int")))).alias("more_score"),
    )
    out = scored.drop("words", "times").join(rest, "row", "left")
    return out.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(scorer.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
