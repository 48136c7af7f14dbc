"""URL filtering: rules on host and path, and logistic regression for URLs that no rule fits.

The classifier hashes the character n-grams of host and path (with marks for start and end, and a tag for
which of the two they come from) into a fixed number of buckets and is trained by weighted logistic
regression with L2 on a small labelled URL table: at most ``per_class`` distinct URLs of each label, the
ones with the smallest hashes (documented bound; the table may be larger). The weights (8 bytes a bucket)
are broadcast.

A rule ``host/path`` fits its host and all subdomains if the URL's path starts with the rule's path; the
longest fitting rule wins, ties by text. Defined results: null URLs and URLs without ``://`` have empty
host and path and get the classifier's verdict; without labelled URLs of both labels the classifier
allows everything but what the single label says; repeated rows give repeated results; an empty table
gives an empty table; output columns replace input columns of their names.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import collect_bounded, map_columns, quoted

GRAMS = (2, 3, 4)
BUCKETS = 1 << 16
#: Bound of the labelled URLs used to fit, for each label.
PER_CLASS = 3_000
#: Rules of the production query: (verdict, host/path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):   # longer rules override
        own_host, _, own_path = text.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def grams(host: str, path: str) -> np.ndarray:
    """Distinct buckets of the character n-grams of host and path."""
    found = set()
    for tag, part in (("h", host), ("p", path)):
        s = f"^{part}$"
        found.update([zlib.crc32((tag + s[i:i + n]).encode("utf-8", "surrogatepass")) for n in GRAMS for i in range(len(s) - n + 1)])
    return np.unique(np.fromiter(found, np.int64, len(found)) % BUCKETS)


@dataclass
class UrlModel:
    """Logistic regression weights; ``score`` is the probability of label 1 (block)."""

    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        g = grams(host, path)
        return float(1 / (1 + np.exp(-(self.weights[g].sum() / np.sqrt(max(1, len(g))) + self.bias))))


def fit(rows: list[tuple[str, str, int]], steps: int = 200, rate: float = 0.5, l2: float = 1e-4) -> UrlModel:
    """Weighted logistic regression (both labels weigh the same) by Adagrad on the whole labelled table."""
    labels = np.array([x[2] for x in rows], float)
    if len(set(labels)) < 2:
        return UrlModel(np.zeros(BUCKETS), 20.0 if len(labels) and labels[0] == 1 else -20.0)
    parts = [grams(h, p) for h, p, _ in rows]
    row = np.repeat(np.arange(len(parts)), [len(g) for g in parts])
    col = np.concatenate(parts)
    value = np.concatenate([np.full(len(g), 1 / np.sqrt(max(1, len(g)))) for g in parts])
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (len(labels) - labels.sum()))
    w, b, gw, gb = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(steps):
        z = np.bincount(row, w[col] * value, len(parts)) + b
        d = weight * (1 / (1 + np.exp(-z)) - labels)
        g = np.bincount(col, d[row] * value, BUCKETS) + l2 * w
        gw += g * g
        gb += d.sum() ** 2
        w -= rate * g / np.sqrt(gw)
        b -= rate * d.sum() / np.sqrt(gb)
    return UrlModel(w, float(b))


def train(labelled: DataFrame, url: str = "url", label: str = "label", per_class: int = PER_CLASS) -> UrlModel:
    """Fit on a labelled URL table: label 1 blocks, 0 allows; other labels and null URLs are left out."""
    rows = labelled.select(quoted(url).alias("url"), quoted(label).alias("label")).where("url IS NOT NULL AND label IN (0, 1)")
    host, path = host_and_path(F.col("url"))
    rows = rows.select(host.alias("host"), path.alias("path"), F.col("label").cast("int").alias("label"))
    order = [F.xxhash64("host", "path"), "host", "path"]
    own = [rows.where(F.col("label") == k).dropDuplicates(["host", "path"]).orderBy(*order).limit(per_class) for k in (0, 1)]
    got = collect_bounded(own[0].unionByName(own[1]), 2 * per_class, "labelled URLs").to_pylist()
    return fit([(x["host"], x["path"], x["label"]) for x in got])


def judge(df: DataFrame, model: UrlModel, rules: tuple[tuple[str, str], ...] = RULES, url: str = "url") -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (the classifier's probability of block)."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [quoted(c) for c in df.columns if c.lower() not in ("host", "path", "rule", "verdict", "score")]
    host, path = host_and_path(quoted(url))
    df = df.select(*keep, host.alias("host"), path.alias("path"))

    def make():
        own = shared.value
        return lambda hosts, paths: [hosts, paths, pa.array(
            [own.score(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist())], pa.float64())]

    scored = map_columns(df, ["host", "path"], [T.StructField("host", T.StringType()), T.StructField("path", T.StringType()),
                                                T.StructField("score", T.DoubleType())], make)
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return (scored.withColumn("rule", rule)
            .withColumn("verdict", F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow"))))


def rule_labels(df: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, url: str = "url") -> DataFrame:
    """A labelled URL table from the rules themselves: every distinct URL that a rule fits, with its verdict."""
    host, path = host_and_path(quoted(url))
    _, verdict = best_rule(host, path, rules)
    return (df.select(quoted(url).alias("url"), F.when(verdict == "block", 1).when(verdict == "allow", 0).alias("label"))
            .where("label IS NOT NULL"))
