"""Text quality by positive-unlabelled learning.

Trusted positives (labelled good) and unlabelled web text are enough: with the class prior p, the risk of
the unseen negatives is the unlabelled risk less p times the positives' risk as negatives. The
non-negative estimator doesn't let that difference fall below zero, so a flexible model can't gain by driving it
negative. The loss is logistic, the model linear in style features of a text and their squares: shares of character
classes, word and line repetition, word shapes and lengths.

The fit reads every positive and every unlabelled document, at any size: feature vectors are computed once and stored,
and Newton's method needs of them only sums (risks, gradient, curvature), which Spark adds up in one pass a step. A
step that would raise the risk, or take the negatives' part of it below zero, is halved.

The class prior comes from positives and unlabelled text alone: a logistic regression tells the two apart, and where
it is surest of a positive, unlabelled documents are there for the positives among them only. So the share of unlabelled
documents over a margin, divided by that of positives, is the prior where it is least; the margin is the one whose upper
confidence bound of this ratio is least (best-bin estimation, Garg et al. 2021). The regression learned on either half of
the rows (by hash of id) counts the other half's margins, so that what it learned by heart doesn't count. Labels other than good enter nothing
but that their documents are not unlabelled.

Defined results: null and empty texts have all features zero and get a score like any other; rows with a
null id are unlabelled and scored; label rows with a null id or a label other than 0 and 1 are left out, and of several
labels of one id the smallest holds; rows of one id all count; without trusted positives every score is 0; without
unlabelled text the positives are taken as all there is and every score is 1; whole texts are read;
repeated rows give repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import collect_bounded, map_columns, quoted, small_batches, stored, texts

#: Weight of the squared norm, most Newton steps, most halvings of one, and the gain below which the fit ends.
L2, STEPS, HALVINGS, LEAST_GAIN = 0.1, 30, 8, 1e-3
#: Margins are counted in so many bins between -MARGIN and MARGIN; confidence terms of the prior's bound.
BINS, MARGIN, DELTA, GAMMA = 2_000, 25.0, 0.1, 0.01
#: Least class prior.
LEAST_PRIOR = 1e-3


def _bytes(pattern: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(pattern)] = 1
    return out


_UPPER = _bytes(bytes(range(65, 91)))
_LETTER = _UPPER + _bytes(bytes(range(97, 123))) + _bytes(bytes(range(128, 256)))
_CLASSES = np.stack([
    _UPPER, _LETTER, _bytes(b"0123456789"), _bytes(b".,;:?"), _bytes(b"!"), _bytes(b"#$%&*+=<>@^_~"), _bytes(b"|/\\[]{}()"),
    _bytes(b"\"'`-"), _bytes(b" "), _bytes(b"\n\r\t"), _bytes(bytes(range(128, 256)))], axis=1)
#: Symbols that end words of noisy text.
_NOISE = tuple(bytes([c]) for c in b"!#$%&*|")
N_FEATURES = _CLASSES.shape[1] + 15


def features(text: str) -> np.ndarray:
    """Style features of a whole text; all zero for the empty text."""
    out = np.zeros(N_FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    if not raw:
        return out
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    k = _CLASSES.shape[1]
    out[:k] = counts @ _CLASSES / len(raw)
    out[0] /= max(out[1], 1e-9)   # capitals among letters
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x]
    if not n:
        return out
    lengths = np.fromiter(map(len, words), np.int64, n)
    distinct = len(set(words))
    out[k:] = [
        np.log1p(n), lengths.mean(), lengths.std(), (lengths <= 3).mean(), (lengths >= 15).mean(),
        distinct / n, distinct / n ** 0.75, sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        sum(map(bytes.isupper, words)) / n, sum(map(bytes.istitle, words)) / n,
        sum([w.endswith(_NOISE) for w in words]) / n, sum([w.endswith((b".", b",")) for w in words]) / n,
        len(set(lines)) / max(1, len(lines)), np.log1p(len(raw) / max(1, len(lines))),
    ]
    return out


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z], axis=1)

    def design(self, x: np.ndarray) -> np.ndarray:
        """Expanded features and a one for the bias."""
        return np.c_[self.expand(x), np.ones(len(x))]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.expand(x) @ self.weights + self.bias, -50, 50)))


def constant(score: float) -> QualityModel:
    margin = 50.0 if score >= 1 else -50.0
    return QualityModel(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES), margin)


# --- sums over rows, and what is minimised of them --------------------------------------------------------

def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def moments(positive: np.ndarray, unlabelled: np.ndarray) -> np.ndarray:
    """Numbers of rows of both kinds, then sums and sums of squares of the features of all."""
    both = np.concatenate([positive, unlabelled])
    return np.concatenate([[len(positive), len(unlabelled)], both.sum(axis=0), (both * both).sum(axis=0)])


def scaled(sums: np.ndarray) -> QualityModel:
    """A model without weights, whose mean and scale are those of all rows."""
    n, (total, squares) = max(1.0, sums[0] + sums[1]), sums[2:].reshape(2, -1)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean * mean, 0))
    return QualityModel(mean, spread + 1e-6, np.zeros(2 * len(mean)), 0.0)


def risk_sums(positive: np.ndarray, unlabelled: np.ndarray, model: QualityModel, w: np.ndarray) -> np.ndarray:
    """For each kind: rows, losses as negatives, features, gradient and curvature of these losses, in one vector."""
    out = []
    for x in (model.design(positive), model.design(unlabelled)):
        z = x @ w
        s = _sigmoid(z)
        out += [[len(x), _softplus(z).sum()], x.sum(axis=0), x.T @ s, ((x.T * (s * (1 - s))) @ x).ravel()]
    return np.concatenate(out)


@dataclass
class Risk:
    """Means over the rows of one kind, from their sums."""

    as_negative: float
    features: np.ndarray
    gradient: np.ndarray
    curvature: np.ndarray


def _risks(sums: np.ndarray, size: int) -> tuple[Risk, Risk]:
    def of(own: np.ndarray) -> Risk:
        n = max(1.0, own[0])
        x, g, h = own[2:2 + size], own[2 + size:2 + 2 * size], own[2 + 2 * size:]
        return Risk(own[1] / n, x / n, g / n, h.reshape(size, size) / n)

    p, u = np.split(sums, 2)
    return of(p), of(u)


Objective = Callable[[np.ndarray, np.ndarray], tuple[float, np.ndarray, np.ndarray]]


def _ridge(w: np.ndarray) -> np.ndarray:
    return np.append(np.full(len(w) - 1, L2), 1e-9)   # the bias is all but free


def apart(w: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic risk of telling positives from unlabelled rows, both kinds weighing the same; its gradient and curvature."""
    p, u = _risks(sums, len(w))
    ridge = _ridge(w)
    value = p.as_negative - w @ p.features + u.as_negative + 0.5 * ridge @ (w * w)
    return value, p.gradient - p.features + u.gradient + ridge * w, p.curvature + u.curvature + np.diag(ridge)


def non_negative(prior: float) -> Objective:
    """The unbiased risk, infinite where the negatives' part of it is below zero; its gradient and curvature."""
    def objective(w: np.ndarray, sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        p, u = _risks(sums, len(w))
        ridge = _ridge(w)
        as_positive = p.as_negative - w @ p.features   # softplus(-z) = softplus(z) - z
        negatives = u.as_negative - prior * p.as_negative
        value = prior * as_positive + negatives + 0.5 * ridge @ (w * w) if negatives >= 0 else np.inf
        # the positives' curved parts cancel out
        return value, u.gradient - prior * p.features + ridge * w, u.curvature + np.diag(ridge)
    return objective


def minimise(sums_at: Callable[[np.ndarray], np.ndarray], size: int, objective: Objective) -> np.ndarray:
    """Newton's method with halved steps; each value asked for is one pass over the rows."""
    w = np.zeros(size)
    value, gradient, curvature = objective(w, sums_at(w))
    for _ in range(STEPS):
        step = -np.linalg.solve(curvature, gradient)
        if -gradient @ step < LEAST_GAIN:
            break
        for _ in range(HALVINGS):
            tried = objective(w + step, sums_at(w + step))
            if tried[0] < value:
                break
            step = step / 2
        else:   # at the edge where the negatives' risk is zero
            break
        w = w + step
        gain, (value, gradient, curvature) = value - tried[0], tried
        if gain < LEAST_GAIN:
            break
    return w


def margin_counts(positive: np.ndarray, unlabelled: np.ndarray, model: QualityModel, w: np.ndarray) -> np.ndarray:
    """Rows a bin of margin, of the positives and of the unlabelled rows."""
    edges = np.linspace(-MARGIN, MARGIN, BINS + 1)
    return np.concatenate([np.histogram(np.clip(model.design(x) @ w, -MARGIN, MARGIN), edges)[0].astype(float)
                           for x in (positive, unlabelled)])


def class_prior(counts: np.ndarray) -> float:
    """Share of positives among unlabelled rows from the counts of margins of both kinds (best-bin estimation)."""
    p, u = np.split(counts, 2)
    n_p, n_u = max(1.0, p.sum()), max(1.0, u.sum())
    over_p, over_u = np.cumsum(p[::-1]) / n_p, np.cumsum(u[::-1]) / n_u
    slack = (1 + GAMMA) * sum(np.sqrt(np.log(4 / DELTA) / (2 * n)) for n in (n_p, n_u))
    some = over_p > 0
    if not some.any():
        return LEAST_PRIOR
    at = np.argmin((over_u[some] + slack) / over_p[some])
    return float(np.clip(over_u[some][at] / over_p[some][at], LEAST_PRIOR, 1.0))


def estimated_prior(sum_of: Callable[..., np.ndarray], model: QualityModel) -> float:
    """Class prior by margins of each half of the rows under the regression learned on the other."""
    counts = np.zeros(2 * BINS)
    for half in (0, 1):
        w = minimise(lambda v: sum_of(1 - half, risk_sums, model, v), len(model.weights) + 1, apart)
        counts += sum_of(half, margin_counts, model, w)
    return class_prior(counts)


def fit_sums(sum_of: Callable[..., np.ndarray], prior: float | None = None) -> QualityModel:
    """The model from ``sum_of(half, part, *values)``: the sum of the vectors that ``part(positive, unlabelled, *values)``
    makes of the rows of a half (None: all rows). Without a prior it is estimated."""
    sums = sum_of(None, moments)
    if not sums[0]:
        return constant(0.0)
    if not sums[1]:
        return constant(1.0)
    model = scaled(sums)
    objective = non_negative(estimated_prior(sum_of, model) if prior is None else prior)
    w = minimise(lambda v: sum_of(None, risk_sums, model, v), len(model.weights) + 1, objective)
    return QualityModel(model.mean, model.scale, w[:-1], float(w[-1]))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> QualityModel:
    """Fit on feature vectors in memory; every other row is of one half."""
    def sum_of(half: int | None, part: Callable[..., np.ndarray], *values) -> np.ndarray:
        own = slice(None) if half is None else slice(half, None, 2)
        return part(positive[own], unlabelled[own], *values)

    return fit_sums(sum_of, prior)


def add_features(df: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """Adds the feature vector of the text."""
    def make():
        return lambda col: [pa.FixedSizeListArray.from_arrays(
            pa.array(np.concatenate([features(x) for x in texts(col)]) if len(col) else np.zeros(0)), N_FEATURES).cast(
            pa.list_(pa.float64()))]

    return map_columns(df, [text], [T.StructField(out, T.ArrayType(T.DoubleType()))], make)


def summed(rows: DataFrame, part: Callable[..., np.ndarray], *values) -> np.ndarray:
    """Sum over (good, features) rows of the vectors that ``part`` makes of each batch: tasks add up their own, Spark the tasks'."""
    length = len(part(np.zeros((0, N_FEATURES)), np.zeros((0, N_FEATURES)), *values))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            good = b.column(0).to_numpy(zero_copy_only=False).astype(bool)
            x = b.column(1).flatten().to_numpy().reshape(-1, N_FEATURES)
            total += part(x[good], x[~good], *values)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length)), pa.array(total)], names=["at", "value"])

    small_batches(rows.sparkSession)
    sums = rows.mapInArrow(add, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    got = collect_bounded(sums, length, "sums")
    out = np.zeros(length)
    out[got.column("at").to_numpy()] = got.column("value").to_numpy()
    return out


def labelled_features(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      label: str = "quality") -> DataFrame:
    """(good, half, features) of all trusted positives and all documents without a label."""
    known = (labels.select(quoted(doc_id).alias("doc_id"), quoted(label).cast("int").alias("label"))
             .where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label")))
    own = add_features(docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text")), "text").drop("text")
    return (own.join(known, "doc_id", "left").where("label IS NULL OR label = 1")
            .select(F.col("label").isNotNull().alias("good"), F.xxhash64("doc_id").bitwiseAND(F.lit(1)).alias("half"), "features"))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          prior: float | None = None) -> QualityModel:
    """Fit on the trusted positives of ``labels`` and all documents without a label there."""
    rows = stored(labelled_features(docs, labels, doc_id, text, label), "quality-features")

    def sum_of(half: int | None, part: Callable[..., np.ndarray], *values) -> np.ndarray:
        own = rows if half is None else rows.where(F.col("half") == half)
        return summed(own.select("good", "features"), part, *values)

    return fit_sums(sum_of, prior)


def score(df: DataFrame, model: QualityModel, text: str = "text", out: str = "score") -> DataFrame:
    """Adds ``score``: how likely the text is a good one (0 to 1)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        return lambda col: [pa.array(shared.value.score(np.array([features(x) for x in texts(col)]).reshape(-1, N_FEATURES)), pa.float64())]

    return map_columns(df, [text], [T.StructField(out, T.DoubleType())], make)
