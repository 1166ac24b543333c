"""Toxicity: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios, trained on labelled text.

Letters are lower-cased and every other character counts as one blank, so
n-grams see word boundaries but not case, digits or punctuation. A document
is the set of its n-grams (all of them: whole texts are read, in blocks).
The model is a logistic regression over the n-grams that separate the classes
best; the value of a present n-gram is its log-count ratio.

Training reads a bounded, documented sample of labelled rows: at most
``SAMPLE_TOXIC`` toxic and ``SAMPLE_CLEAN`` other documents of at most
``SAMPLE_CHARS`` characters, the first by hash of doc_id. Scoring covers every
document. Null and empty texts get the model's score for no n-grams. Without
both labels in the sample every score is the smoothed share of label 1.
Documents labelled more than once count as toxic if any label says so; null
labels and null doc_ids teach nothing. Repeated rows are scored each.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, held_by_worker

SAMPLE_TOXIC = 1200
SAMPLE_CLEAN = 2400
SAMPLE_CHARS = 20_000
ORDERS = (3, 4, 5, 6)
MAX_FEATURES = 1024
TABLE_BITS = 20
BLOCK_CHARS = 1_000_000

_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(1_000_003)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> lower-case letter, or blank (basic plane)."""
    if not _LETTERS:
        out = np.full(65536, 32, np.uint64)
        for cp in range(65536):
            ch = chr(cp)
            if ch.isalpha():
                low = ch.lower()
                out[cp] = ord(low) if len(low) == 1 else cp
        _LETTERS.append(out)
    return _LETTERS[0]


def _codes(text: str | None) -> np.ndarray:
    """Normalised code points between blanks."""
    cps = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    low = np.where(cps < 65536, _letters()[np.minimum(cps, 65535)], cps.astype(np.uint64))
    return np.concatenate(([32], low, [32])).astype(np.uint64)


def _grams(codes: np.ndarray):
    """For each order: the hash of the n-gram that starts at each position."""
    with np.errstate(over="ignore"):
        h, done = codes, 1
        for n in ORDERS:
            while done < n:
                h = h[:-1] * _STEP + codes[done:] if len(h) > 1 else h[:0]
                done += 1
            yield n, (h + np.uint64(n)) * _MUL


def _gram_set(text: str | None) -> np.ndarray:
    return np.unique(np.concatenate([h for _, h in _grams(_codes(text))]))


def fit(texts: list[str | None], toxic: list[int]) -> dict:
    """The model: n-gram hashes (sorted), their weights, and the bias."""
    pos = [t for t, y in zip(texts, toxic) if y == 1]
    neg = [t for t, y in zip(texts, toxic) if y != 1]
    prior = (len(pos) + 1) / (len(pos) + len(neg) + 2) if pos or neg else 0.0
    model = {"grams": np.empty(0, np.uint64), "weights": np.empty(0, np.float64), "bias": None, "prior": prior}
    if not pos or not neg:
        return model
    seen, df_pos = np.unique(np.concatenate([_gram_set(t) for t in pos]), return_counts=True)
    frequent = df_pos >= (3 if len(pos) >= 20 else 1)
    seen, df_pos = seen[frequent], df_pos[frequent]
    df_neg = np.zeros(len(seen), np.int64)
    for t in neg:
        grams = _gram_set(t)
        at = np.minimum(np.searchsorted(seen, grams), max(len(seen) - 1, 0))
        df_neg[at[seen[at] == grams] if len(seen) else at[:0]] += 1
    p, q = (df_pos + 0.5) / (len(pos) + 1), (df_neg + 0.5) / (len(neg) + 1)
    both = (df_pos + df_neg + 0.5) / (len(pos) + len(neg) + 1)

    def gain(k, n, share):
        return k * np.log(np.maximum(share, 1e-12) / both) + (n - k) * np.log(np.maximum(1 - share, 1e-12) / (1 - both + 1e-12))

    g2 = 2 * (gain(df_pos, len(pos), p) + gain(df_neg, len(neg), q))
    best = np.sort(np.argsort(-g2, kind="stable")[:MAX_FEATURES])
    best = best[g2[best] > 12] if (g2[best] > 12).any() else best[:64]
    grams = seen[best]
    ratio = np.log(p[best] / p[best].sum()) - np.log(q[best] / q[best].sum())
    ratio = np.where(p[best] > q[best], np.abs(ratio) + 1e-3, -np.abs(ratio) - 1e-3)
    x = np.zeros((len(pos) + len(neg), len(grams)), np.float32)
    for row, t in enumerate(pos + neg):
        own = _gram_set(t)
        at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
        x[row, at[grams[at] == own]] = 1
    x *= ratio.astype(np.float32)
    y = np.r_[np.ones(len(pos)), np.zeros(len(neg))].astype(np.float32)
    scale = max(float((x * x).sum(axis=1).max()), 1.0)
    w, b = np.zeros(len(grams), np.float32), float(np.log(len(pos) / len(neg)))
    v, vb, step, l2 = w.copy(), b, 4.0 / scale, 1e-5
    step, l2 = np.float32(step * min(len(y), 64)), np.float32(l2 / min(len(y), 64))
    for k in range(200):  # Nesterov's accelerated gradient on the logistic loss
        err = 1 / (1 + np.exp(-np.clip(x @ v + np.float32(vb), -35, 35))) - y
        w_new = v - step * (x.T @ err / np.float32(len(y)) + l2 * v)
        b_new = vb - 0.5 * err.mean()
        momentum = np.float32(k / (k + 3))
        v, vb = w_new + momentum * (w_new - w), b_new + momentum * (b_new - b)
        w, b = w_new, b_new
    model |= {"grams": grams, "weights": w.astype(np.float64) * ratio, "bias": float(b)}
    return model


def _filter_table(model: dict) -> np.ndarray:
    hit = np.zeros(1 << TABLE_BITS, bool)
    hit[(model["grams"] >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    return hit


def score_texts(texts: list[str | None], model: dict, hit: np.ndarray | None = None) -> np.ndarray:
    """Score of each text from the set of its known n-grams."""
    if model["bias"] is None:
        return np.full(len(texts), model["prior"], np.float64)
    hit = _filter_table(model) if hit is None else hit
    out, first = np.empty(len(texts)), 0
    while first < len(texts):
        last, chars = first, 0
        while last < len(texts) and (last == first or chars + len(texts[last] or "") <= BLOCK_CHARS):
            chars += len(texts[last] or "")
            last += 1
        parts = [_codes(t) for t in texts[first:last]]
        ends = np.cumsum([len(p) + 1 for p in parts])
        codes = np.concatenate([np.append(p, np.uint64(0)) for p in parts])
        docs, feats = [], []
        for n, h in _grams(codes):
            at = np.flatnonzero(hit[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
            found = np.minimum(np.searchsorted(model["grams"], h[at]), len(model["grams"]) - 1)
            same = model["grams"][found] == h[at]
            at, found = at[same], found[same]
            doc = np.searchsorted(ends, at, side="right")
            inside = at + n <= ends[doc] - 1  # an n-gram lies within one text
            docs.append(doc[inside])
            feats.append(found[inside])
        pairs = np.unique(np.concatenate(docs).astype(np.int64) * len(model["grams"]) + np.concatenate(feats))
        z = np.bincount(pairs // len(model["grams"]), model["weights"][pairs % len(model["grams"])], last - first)
        out[first:last] = 1 / (1 + np.exp(-np.clip(z + model["bias"], -35, 35)))
        first = last
    return out


def train(docs: DataFrame, labels: DataFrame, held_out_mod: int | None = 5) -> dict:
    """Fit on the bounded sample of labelled documents; rows whose
    crc32(doc_id as text) mod ``held_out_mod`` is 0 are never read."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    if held_out_mod:
        marks = marks.where(crc_mod("doc_id", held_out_mod) != 0)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.length("text").alias("chars"))
    known = known.where(F.coalesce("chars", F.lit(0)) <= SAMPLE_CHARS).select("doc_id").join(marks, "doc_id")
    key = F.xxhash64("doc_id")
    few = [
        known.where(cond).select("doc_id", "toxic", key.alias("key")).distinct().orderBy("key", "doc_id").limit(n)
        for cond, n in (("toxic = 1", SAMPLE_TOXIC), ("toxic <> 1", SAMPLE_CLEAN))
    ]
    sample = F.broadcast(few[0].unionByName(few[1]))  # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    text = text.where(F.coalesce(F.length("text"), F.lit(0)) <= SAMPLE_CHARS).join(sample, "doc_id")
    rows = text.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([r["text"] for r in rows], [int(r["toxic"] == 1) for r in rows])


def toxicity(text: str | Column, model: dict, spark) -> Column:
    """A column: the model's score of a whole text, 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held_by_worker("toxicity", object)  # lets go of what an earlier stage kept
        model = shared.value
        hit = None if model["bias"] is None else _filter_table(model)
        for texts in batches:
            yield pd.Series(score_texts([t if isinstance(t, str) else None for t in texts], model, hit))

    return score(F.col(text) if isinstance(text, str) else text)


def score_documents(docs: DataFrame, labels: DataFrame, held_out_mod: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    model = train(docs, labels, held_out_mod)
    out = docs.select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", held_out_mod) == 0, F.lit(False)).alias("held_out"),
        toxicity("text", model, docs.sparkSession).alias("score"),
    )
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
