"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct 64-bit hashes of its words, word stems (first bytes), word pairs and
pairs with one or two words skipped; a word is a run of ASCII letters and digits and non-ASCII
characters, A-Z lower-cased. Per-coordinate learning rates and L1 make most weights exactly zero, so the
model is a short sorted list of (hash, weight) that is broadcast. In a text, a bitmap over the upper hash
bits drops nearly all features before the exact lookup.

The fit runs in one task on a bounded sample of labelled documents: at most ``positives`` and
``negatives`` of them, the ones whose ids hash lowest (documented bound). Features that fewer than
``MIN_DOCS`` texts of the sample share are left out. The intercept is shifted from the sample's share of
toxic documents to that of all training labels, whatever the size of the sample.

Defined results: null and empty texts get the model's intercept as score; rows with a null id are
scored; label rows with a null id or a label other than 0 and 1 are left out, and of several labels of
one id the largest holds; without a toxic training document every score is 0; whole texts are scored;
repeated rows give repeated results; an empty table gives an empty table; an output column replaces an
input column of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WordHasher, collect_bounded, id_text, map_columns, mix64, quoted, separators, small_batches, text_buffer

#: Bounds of the labelled documents used to fit.
POSITIVES, NEGATIVES = 3_000, 5_000
#: Bound of the weights kept (nonzero ones; 16 bytes each in the broadcast).
MAX_WEIGHTS = 500_000
STEMS = (4, 6)
MIN_DOCS = 3
_BREAKS = separators(r"[^0-9A-Za-z]")
_PAIRS = ((1, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03), (2, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7),
          (3, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def hasher() -> WordHasher:
    return WordHasher(_BREAKS, STEMS)


def features(col: pa.Array, words: WordHasher) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature hash) arrays of a batch, one pair of arrays for each kind of feature."""
    data, offsets = text_buffer(col)
    w, first = words(data, offsets)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    yield row, w
    for stem in words.stem_hashes:
        yield row, stem
    for gap, a, b in _PAIRS:
        if len(w) > gap:
            same = row[:-gap] == row[gap:]
            yield row[:-gap][same], mix64(w[:-gap][same] * np.uint64(a) + w[gap:][same] * np.uint64(b))


@dataclass
class ToxicityModel:
    keys: np.ndarray       # sorted feature hashes
    weights: np.ndarray
    intercept: float
    bits: int = 20

    def __post_init__(self) -> None:
        self.bitmap = np.zeros(1 << self.bits, bool)
        self.bitmap[self.keys >> np.uint64(64 - self.bits)] = True

    def margins(self, col: pa.Array, words: WordHasher) -> np.ndarray:
        """Log odds of each text: the intercept and the weights of its distinct features."""
        out = np.full(len(col), self.intercept)
        rows, keys = [], []
        for row, key in features(col, words):
            near = self.bitmap[key >> np.uint64(64 - self.bits)]
            rows.append(row[near])
            keys.append(key[near])
        row, key = np.concatenate(rows), np.concatenate(keys)
        if len(self.keys) and len(key):
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            seen = np.unique(row[hit] * len(self.keys) + at[hit])
            out += np.bincount(seen // len(self.keys), self.weights[seen % len(self.keys)], len(out))
        return out


class Ftrl:
    """FTRL-proximal with per-coordinate rates, L1 and L2 (one example at a time)."""

    def __init__(self, size: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 3.0, l2: float = 0.1) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)   # the last coordinate is the intercept

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        w[np.abs(z) <= self.l1] = 0.0
        return w

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def fit(texts: list[str], labels: list[int], epochs: int = 4, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted hashes, weights, intercept): the nonzero weights learned from a bounded sample in memory."""
    words, step, bits = hasher(), 200, 24
    docs = _document_features(texts, words, step)
    seen = np.zeros(1 << bits, np.uint16)
    for own in docs():
        at = own >> np.uint64(64 - bits)
        at = np.unique(at)
        seen[at] = np.minimum(seen[at], 60_000) + 1
    kept = [own[seen[own >> np.uint64(64 - bits)] >= MIN_DOCS] for own in docs()]
    keys, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *kept]), return_counts=True)
    keys = keys[counts >= MIN_DOCS]
    rows = []
    for own in kept:
        at = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
        rows.append(np.append(at[keys[at] == own] if len(keys) else at[:0], len(keys)))
    model, order = Ftrl(len(keys)), np.arange(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            model.learn(rows[i], labels[i])
    w = model.weights(np.arange(len(keys) + 1))
    own = np.flatnonzero(w[:-1])
    return keys[own], w[own], float(w[-1])


def _document_features(texts: list[str], words: WordHasher, step: int):
    """A function that goes through the distinct features of each text, in order."""
    def go() -> Iterator[np.ndarray]:
        for i in range(0, len(texts), step):
            parts = list(features(pa.array(texts[i:i + step], pa.large_string()), words))
            row, key = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(row, kind="stable")
            row, key = row[order], key[order]
            at = np.searchsorted(row, np.arange(min(step, len(texts) - i) + 1))
            for a, b in zip(at, at[1:]):
                yield np.unique(key[a:b])
    return go


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether the crc32 of the id's text leaves the fold as remainder."""
    return F.crc32(id_text(doc_id).cast("binary")) % folds == fold


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          positives: int = POSITIVES, negatives: int = NEGATIVES) -> ToxicityModel:
    """Fit on ``labels`` (id and 0/1 label; the caller leaves out what must stay unseen)."""
    small_batches(docs.sparkSession)
    rows = (labels.select(quoted(doc_id).alias("doc_id"), quoted(label).cast("int").alias("label"))
            .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label")))
    share = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    if not share["toxic"]:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    order = [F.xxhash64("doc_id"), "doc_id"]
    sample = rows.where("label = 1").orderBy(*order).limit(positives).unionByName(
        rows.where("label = 0").orderBy(*order).limit(negatives))
    # ids of a bounded sample: at most positives + negatives rows
    texts = (docs.select(quoted(doc_id).alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
             .join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: (r[0], r[1]))
        keys, weights, intercept = fit([r[1] for r in got], [r[2] for r in got])
        toxic = sum(r[2] for r in got)
        keys, weights = np.append(keys.view(np.int64), [0, 0]), np.append(weights, [intercept, toxic / max(1, len(got))])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(weights), pa.array(
            ["weight"] * (len(keys) - 2) + ["intercept", "share"])], names=["key", "weight", "what"])

    got = collect_bounded(texts.repartition(1).mapInArrow(learn, "key long, weight double, what string"),
                          MAX_WEIGHTS, "weights").to_pydict()
    what = np.array(got["what"])
    keys, weights = np.array(got["key"], np.int64).view(np.uint64), np.array(got["weight"])
    intercept = float(weights[what == "intercept"].sum())
    in_sample = float(np.clip(weights[what == "share"].sum(), 1e-6, 1 - 1e-6))
    overall = float(np.clip(share["toxic"] / share["n"], 1e-6, 1 - 1e-6))
    intercept += np.log(overall / (1 - overall)) - np.log(in_sample / (1 - in_sample))
    own = what == "weight"
    return ToxicityModel(keys[own], weights[own], intercept)


def score(df: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Adds ``score``: the probability that the text is toxic."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        words = hasher()
        return lambda col: [pa.array(1 / (1 + np.exp(-np.clip(shared.value.margins(col, words), -700, 700))), pa.float64())]

    return map_columns(df, [text], [T.StructField(out, T.DoubleType())], make)
