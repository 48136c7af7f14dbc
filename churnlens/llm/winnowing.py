"""Document fingerprints by winnowing, and the likeness of neighbouring documents.

Every k-gram of code points gets a rolling polynomial hash; of each window of w consecutive hashes the
minimum is selected, the rightmost one on ties, and its position is kept. Two texts that share a
passage of at least w + k - 1 code points share a selected hash. A text with fewer than w hashes is one
window; a text shorter than k is one gram.

Neighbours: documents are dealt by ranges of their id; the first rows of a range also go, flagged, to
the range before (the first range's to the last), so each range sees the row behind its last one and
rows stream through in order. Range bounds are the smallest ids of an ids-only range partitioning, as
many as partitions.

Defined results: null and empty text have the empty fingerprint; two empty fingerprints are alike (1.0),
an empty and another one aren't (0.0); rows with a null id come first; rows of one id are ordered by
text, and each row's next one is the row behind it, repeated rows included; a single row is its own
next; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_ROWS, map_columns, mix64, quoted, small_batches

#: Gram length and window length, powers of two; the match guarantee is GRAM + WINDOW - 1 code points.
GRAM, WINDOW = 16, 32
_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64(0xFFFFFFFF)
_NO_ID = -(1 << 63)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def winnow(codes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit hashes, positions) selected from a text's code points, in order of position."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    h = mix64(codes.astype(np.uint64) + np.uint64(1))
    if n < gram:   # one gram: the whole text
        weights = np.array([pow(_BASE, n - 1 - i, 1 << 64) for i in range(n)], np.uint64)
        h = (h * weights).sum(keepdims=True)
    else:
        step = 1   # hash of 2j symbols = hash of the first j * base^j + hash of the next j
        while step < gram:
            h = h[:-step] * np.uint64(pow(_BASE, step, 1 << 64)) + h[step:]
            step *= 2
    m = len(h)
    # hash above, reversed position below: the minimum is the smallest hash, the rightmost on ties
    key = (mix64(h) & ~_LOW) | (_LOW - np.arange(m, dtype=np.uint64))
    if m <= window:
        key = key.min(keepdims=True)
    else:
        step = 1
        while step < window:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    return (key >> np.uint64(32)).astype(np.uint32), (_LOW - (key & _LOW)).astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct hashes (sorted arrays)."""
    if len(a) == 0 or len(b) == 0:
        return float(len(a) == len(b))
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def as_text(hashes: np.ndarray, positions: np.ndarray) -> str:
    """``hash@position`` of each selected gram, comma-joined."""
    return ",".join([f"{h:08x}@{p}" for h, p in zip(hashes.tolist(), positions.tolist())])


def fingerprints(df: DataFrame, text: str = "text", fingerprint: str = "fingerprint") -> DataFrame:
    """Adds ``fingerprint``: array of (hash, position) selected from the text."""
    kind = T.ArrayType(T.StructType([T.StructField("hash", T.LongType()), T.StructField("position", T.LongType())]))

    def make():
        def fn(col):
            got = [winnow(_codes(x or "")) for x in col.to_pylist()]
            sizes = np.cumsum([0] + [len(h) for h, _ in got]).astype(np.int32)
            h = np.concatenate([x[0] for x in got] or [np.zeros(0, np.uint32)]).astype(np.int64)
            p = np.concatenate([x[1] for x in got] or [np.zeros(0, np.int64)])
            return [pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays(
                [pa.array(h), pa.array(p)], names=["hash", "position"]))]
        return fn

    return map_columns(df, [text], [T.StructField(fingerprint, kind)], make)


def edit(own: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the following text."""
    q = len(own) // 4
    return own[:len(own) - q] + following[:q]


def range_starts(df: DataFrame, key: str, ranges: int) -> np.ndarray:
    """Smallest key of each of up to ``ranges`` ranges of about equal row counts (8 bytes a range)."""
    parts = df.select(key).repartitionByRange(ranges, key).groupBy(F.spark_partition_id().alias("part"))
    got = parts.agg(F.min(key).alias("start")).select("start").toArrow()
    return np.sort(np.asarray(got.column("start").to_pylist(), dtype=np.int64))


def neighbour_fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and their likeness to each other and to the
    next document's, in ascending order of the id."""
    spark = df.sparkSession
    small_batches(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    docs = docs.withColumn("key", F.coalesce("doc_id", F.lit(_NO_ID)))
    starts = range_starts(docs, "key", ranges)
    n_ranges = len(starts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text", "key", "part", "behind"]
        for b in batches:
            key = b.column(2).to_numpy()
            part = np.searchsorted(starts, key, side="right") - 1
            first = np.flatnonzero(starts[part] == key)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part.astype(np.int32)),
                                              pa.array(np.zeros(len(key), bool))], names=names)
            if len(first):
                own = b.take(pa.array(first))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(((part[first] - 1) % n_ranges).astype(np.int32)),
                                                  pa.array(np.ones(len(first), bool))], names=names)

    dealt = docs.mapInArrow(deal, "doc_id long, text string, key long, part int, behind boolean")
    ordered = dealt.repartition(ranges, "part").sortWithinPartitions("part", "behind", "key", F.col("text").asc_nulls_first())
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType())])
    names = schema.fieldNames()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        last = None   # (id, text, selected, distinct hashes) of the row that still waits for its next one
        at, closed = None, False

        def done(row, following: str, following_set: np.ndarray) -> None:
            doc, own, selected, own_set = row
            edited = edit(own, following)
            edited_selected = winnow(_codes(edited))
            rows.append((doc, len(own), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                         as_text(*selected), as_text(*edited_selected),
                         likeness(own_set, np.unique(edited_selected[0])), likeness(own_set, following_set)))

        for b in batches:
            for doc, own, part, behind in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if part != at:
                    at, closed, last = part, False, None
                if closed:   # only the first row behind the range counts
                    continue
                own = own or ""
                selected = winnow(_codes(own))
                distinct = np.unique(selected[0])
                if last is not None:
                    done(last, own, distinct)
                closed = behind
                last = None if behind else (doc, own, selected, distinct)
                if len(rows) >= BATCH_ROWS:
                    yield _batch(rows, names)
                    rows.clear()
        if rows:
            yield _batch(rows, names)

    return ordered.mapInArrow(walk, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
