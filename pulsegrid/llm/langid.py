"""Language identification by a byte convolutional network.

The network reads windows of ``WINDOW`` bytes (UTF-8, A-Z lower-cased; the last
window of a text is padded with zeros): byte embeddings, filters of several
widths, the maximum of each filter over the window, and a softmax layer. It is
trained in numpy on a bounded, documented sample: ``SAMPLE_DOCS`` documents of
every language (an equal share of ``SAMPLE_ALL``, one at least, where there are
many languages), the first by hash of doc_id and text, whatever their length,
and at most ``DOC_WINDOWS`` windows spread over each, at random lengths. Every
language that has a text with a letter is learned. Prediction reads
all windows of a text; the document's logits are the mean of its windows'
logits, weighted by their bytes.

As embeddings and filters are both linear, prediction adds up rows of tables
made from them: two bytes of a filter's width at a time.

Texts that are null or have no letter (a character of a Unicode letter category:
digits, fractions and circled numbers are none) are ``und`` with score 0, and so
is every text when there is nothing to learn from. Rows with a null doc_id, a
null lang or a text without a letter teach nothing; repeated rows teach once and
are predicted each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, stage, text_slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
SAMPLE_DOCS = 600
DOC_WINDOWS = 4
SAMPLE_ALL = 120_000
SALTS = 64
EPOCHS = 12
BATCH = 128
BLOCK_WINDOWS = 4096
SEED = 11
NUMERIC_OR_LETTER = re.compile(r"[^\W\d_]+")


def _windows(data: bytes, window: int = WINDOW) -> np.ndarray:
    """All windows of a text's bytes (one at least), zero-padded."""
    n = max(1, -(-len(data) // window))
    return np.frombuffer(data.ljust(n * window, b"\0"), np.uint8).reshape(n, window)


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "replace").lower()


class ByteNet:
    """Multi-width convolutions over bytes, max pooling, softmax."""

    def __init__(self, classes: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.p = {"embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)}
        for w in WIDTHS:
            self.p[f"conv{w}"] = rng.normal(0, (2 / (w * EMBED)) ** 0.5, (w, EMBED, FILTERS)).astype(np.float32)
            self.p[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        n = FILTERS * len(WIDTHS)
        self.p["out"] = rng.normal(0, n**-0.5, (n, len(classes))).astype(np.float32)
        self.p["out_bias"] = np.zeros(len(classes), np.float32)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> "ByteNet":
        """Adam on the cross entropy; x: windows, y: class numbers."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for k in range(0, len(x), BATCH):
                rows = order[k : k + BATCH]
                step += 1
                for name, g in self._gradients(x[rows], y[rows]).items():
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.01 * (g * g - second[name])
                    rate = 0.01 * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
                    self.p[name] -= (rate * first[name] / (np.sqrt(second[name]) + 1e-7)).astype(np.float32)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, len(x)
        e = p["embed"][x]
        pooled, at = [], []
        for w in WIDTHS:
            span = x.shape[1] - w + 1
            act = sum(e[:, j : j + span] @ p[f"conv{w}"][j] for j in range(w))
            best = act.argmax(axis=1)
            at.append(best)
            pooled.append(np.take_along_axis(act, best[:, None], 1)[:, 0] + p[f"bias{w}"])
        h = np.concatenate(pooled, axis=1)
        z = np.maximum(h, 0) @ p["out"] + p["out_bias"]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        z /= z.sum(axis=1, keepdims=True)
        z[np.arange(n), y] -= 1
        z /= n
        g = {"out": np.maximum(h, 0).T @ z, "out_bias": z.sum(axis=0), "embed": np.zeros_like(p["embed"])}
        back = (z @ p["out"].T) * (h > 0)
        for k, w in enumerate(WIDTHS):
            d = back[:, k * FILTERS : (k + 1) * FILTERS]
            g[f"bias{w}"] = d.sum(axis=0)
            g[f"conv{w}"] = np.empty_like(p[f"conv{w}"])
            for j in range(w):  # only the pooled position of each filter has a gradient
                byte = np.take_along_axis(x, at[k] + j, 1)
                g[f"conv{w}"][j] = np.einsum("nfe,nf->ef", p["embed"][byte], d)
                np.add.at(g["embed"], byte.ravel(), (d[:, :, None] * p[f"conv{w}"][j].T[None]).reshape(-1, EMBED))
        return g

    def tables(self) -> list[list[np.ndarray]]:
        """Per width: what each pair of bytes (or last single byte) adds."""
        out = []
        for w in WIDTHS:
            one = [self.p["embed"] @ self.p[f"conv{w}"][j] for j in range(w)]
            steps = [(one[j][:, None] + one[j + 1][None]).reshape(65536, FILTERS) for j in range(0, w - 1, 2)]
            out.append(steps + ([one[-1]] if w % 2 else []))
        return out

    def logits(self, x: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w, steps in zip(WIDTHS, tables):
            span = x.shape[1] - w + 1
            act = steps[0].take(pair[:, :span], axis=0)
            for j, t in enumerate(steps[1:], 1):
                act += t.take(pair[:, 2 * j : 2 * j + span] if len(t) > 256 else x[:, 2 * j : 2 * j + span], axis=0)
            pooled.append(act.max(axis=1) + self.p[f"bias{w}"])
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.p["out"] + self.p["out_bias"]


def has_letter(text: str) -> bool:
    return any(c.isalpha() for run in NUMERIC_OR_LETTER.finditer(text) for c in run.group())


def sample_windows(text: str, key: int) -> np.ndarray:
    """Windows spread over a text, cut to random lengths seeded by ``key``."""
    every, rng = _windows(_bytes(text)), np.random.default_rng([SEED, key & (1 << 63) - 1])
    rows = every[sorted(set(np.linspace(0, len(every) - 1, DOC_WINDOWS).astype(int).tolist()))]
    for row in rows:
        if rng.random() < 0.5:
            row[rng.integers(16, WINDOW) :] = 0
    return rows


def fit(windows: list[np.ndarray], langs: list[str]) -> ByteNet | None:
    """The network for the sampled windows of texts and their languages."""
    classes = sorted(set(langs))
    if not classes:
        return None
    number = {lang: k for k, lang in enumerate(classes)}
    y = np.repeat([number[lang] for lang in langs], [len(w) for w in windows])
    return ByteNet(classes).fit(np.concatenate(windows), y)


def sample(docs: DataFrame, fold_mod: int | None = 3) -> DataFrame:
    """lang, key, windows (bytes): the bounded sample. Distinct texts are ranked
    by key within salted parts of a language, then among the parts' first, so a
    language of a third of all rows has no single task; only the last key of
    each language is broadcast, as the network has an output for each."""
    ids = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    if fold_mod:
        ids = ids.where(crc_mod("doc_id", fold_mod) != 1)
    ids = ids.select("lang", F.xxhash64("doc_id", "text").alias("key"), "text")
    keys = stage(ids.select("lang", "key").distinct(), "keys")
    per = max(1, min(SAMPLE_DOCS, SAMPLE_ALL // max(1, keys.select("lang").distinct().count())))
    part = Window.partitionBy("lang", "salt").orderBy("key")
    first = keys.withColumn("salt", F.pmod("key", F.lit(SALTS))).withColumn("r", F.row_number().over(part)).where(F.col("r") <= per)
    first = first.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("key"))).where(F.col("r") <= per)
    last = first.groupBy("lang").agg(F.max("key").alias("last"))
    few = ids.join(F.broadcast(last), "lang").where("key <= last").select("lang", "key", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, got = batch.column(1).to_pylist(), []
            for first, texts in text_slices(batch.column(2), 4 << 20):
                got += [sample_windows(t, keys[first + k]).tobytes() for k, t in enumerate(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.binary())], names=["lang", "key", "windows"])

    return few.mapInArrow(cut, "lang string, key long, windows binary").distinct()


def train(docs: DataFrame, fold_mod: int | None = 3) -> ByteNet | None:
    """Fit on the bounded sample; rows whose crc32(doc_id as text) mod
    ``fold_mod`` is 1 are never read."""
    rows = sorted((r["lang"], r["key"], bytes(r["windows"])) for r in sample(docs, fold_mod).collect())
    return fit([np.frombuffer(w, np.uint8).reshape(-1, WINDOW) for _, _, w in rows], [lang for lang, _, _ in rows])


def predict(texts: list[str | None], net: ByteNet | None, tables) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, from all its windows."""
    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
    known = [k for k, t in enumerate(texts) if net is not None and t and has_letter(t)]
    if not known:
        return langs, scores
    data = [_bytes(texts[k]) for k in known]
    counts = np.array([max(1, -(-len(b) // WINDOW)) for b in data])
    x = np.concatenate([_windows(b) for b in data])
    z = np.concatenate([net.logits(x[k : k + BLOCK_WINDOWS], tables) for k in range(0, len(x), BLOCK_WINDOWS)])
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    weight = np.full(len(x), float(WINDOW))
    weight[first + counts - 1] = [len(b) - (n - 1) * WINDOW for b, n in zip(data, counts)]
    z = np.add.reduceat(z * weight[:, None], first) / np.add.reduceat(weight, first)[:, None]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    z /= z.sum(axis=1, keepdims=True)
    for k, best, share in zip(known, z.argmax(axis=1), z.max(axis=1)):
        langs[k], scores[k] = net.classes[best], min(float(share), 1.0)
    return langs, scores


def identify(docs: DataFrame, fold_mod: int = 3) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, fold_mod))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables() if net is not None else None
        for batch in batches:
            langs, scores = [], []
            for _, texts in text_slices(batch.column(1), 4 << 20):
                a, b = predict(texts, net, tables)
                langs += a
                scores.append(b)
            ids = batch.column(0).to_pylist()
            held = [i is not None and zlib.crc32(str(i).encode()) % fold_mod == 1 for i in ids]
            columns = [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(langs, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
