"""Helpers shared by the text operators: Arrow column mapping, word hashing, bounded collects."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path, scratch_path

#: Rows and bytes per Arrow batch sent to Python: texts are long, so batches stay small.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of the Python workers: few, long rows per Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quoted(name: str) -> Column:
    """Column by exact name (dots and spaces in names are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_columns(df: DataFrame, inputs: list[str], outputs: list[T.StructField],
                make: Callable[[], Callable[..., list[pa.Array]]]) -> DataFrame:
    """``df`` with ``outputs`` computed batch-wise from the columns ``inputs``.

    Other columns pass through; a column of ``df`` named as an output is replaced by it.
    ``make`` is called once per task and returns the function of the input Arrow columns.
    """
    spark = df.sparkSession
    small_batches(spark)
    names = {f.name.lower() for f in outputs}
    keep = [f for f in df.schema.fields if f.name.lower() not in names]
    src = df.select([quoted(c).alias(f"in{j}") for j, c in enumerate(inputs)]
                    + [quoted(f.name).alias(f"keep{j}") for j, f in enumerate(keep)])
    schema = T.StructType(keep + outputs)
    out_names, n_in = [f.name for f in schema.fields], len(inputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for b in batches:
            got = fn(*b.columns[:n_in])
            yield pa.RecordBatch.from_arrays(list(b.columns[n_in:]) + got, names=out_names)
            del b, got
        pa.default_memory_pool().release_unused()   # workers stay for later tasks

    return src.mapInArrow(run, schema)


def texts(col: pa.Array) -> list[str]:
    """Python strings of a text column; null is the empty text."""
    return [x or "" for x in col.to_pylist()]


def text_hash(col: Column) -> Column:
    """64-bit hash that tells rows of one id apart by their text (null apart from empty)."""
    return F.xxhash64(col.isNull(), F.coalesce(col, F.lit("")))


def id_text(name: str) -> Column:
    """The id as text; a null id is the empty text."""
    return F.coalesce(quoted(name).cast("string"), F.lit(""))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared checkpoint folder and read back: cuts lineage, survives lost executors.

    The shuffles behind it aren't read again. Spark removes the files of a shuffle when the JVM has collected what refers to it, so
    it is asked to here; else the disk would hold the shuffles of all steps, not of one."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    spark.sparkContext._jvm.java.lang.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove ``stored`` tables that no later step reads."""
    for table in tables:
        spark = table.sparkSession
        own = scratch_path(spark, "llm").split(":", 1)[-1] + "/"   # a URI here is a file's with or without its slashes
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if own.lstrip("/") in folder:
                remove_path(spark, folder)


def numbered(df: DataFrame, order: list[Column], group: list[str], name: str) -> DataFrame:
    """``df``, a stored frame, with ``idx`` (position in its group, from 0, by ``order``) and ``n`` (rows of the group).

    ``order`` begins with the group columns, which hold no nulls, and should be a total order: rows are dealt by
    ranges of it, sorted and stored once with their place in their range, so a group may span any number of ranges.
    Counts per (range, group) are summed up over the ranges of a group and joined.
    """
    low = F.lit((1 << 33) - 1)
    rows = stored(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("at", F.monotonically_increasing_id()), name)   # range number above bit 33, place below
    rows = rows.withColumn("range", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(low))
    counts = rows.groupBy("range", *group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("count"))
    own = Window.partitionBy(*group) if group else Window.partitionBy()   # without groups: one row a range
    before = F.coalesce(F.sum("count").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("range", *group, (before - F.col("first")).alias("shift"), F.sum("count").over(own).alias("n"))
    return rows.join(starts, ["range", *group]).withColumn("idx", F.col("at") + F.col("shift")).drop("range", "at", "shift")


def collect_bounded(df: DataFrame, limit: int, what: str):
    """Arrow table of a frame whose size bound is proven by the caller; checked again here."""
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return table


# --- vectorised hashing of words -------------------------------------------------------------------
# Polynomial hash modulo 2^64 over random 64-bit values of the bytes. All words of a batch are hashed at
# once: prefix sums of value * r^position, and a difference of prefix sums divided by r^start per word.

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_VALUES = np.random.Generator(np.random.PCG64(20240131)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: ASCII white space: \x20 and \x09-\x0D.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_VALUES = _VALUES[_LOWER]   # A-Z hash as a-z


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all bits (multiply and shift)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def separators(pattern: str) -> np.ndarray:
    """Bytes that separate words: the ASCII characters that match a one-character pattern."""
    out = np.zeros(256, bool)
    out[[c for c in range(128) if re.fullmatch(pattern, chr(c))]] = True
    return out


class WordHasher:
    """Hashes of the words of many texts, A-Z lower-cased; ``space`` marks the bytes between words.

    With ``stems``, also the hashes of each word's first bytes, as many as each stem length says.
    """

    #: Bytes hashed at once (a few arrays of 8 bytes each); a longer single word gets a digest instead.
    BLOCK = 1 << 20

    def __init__(self, space: np.ndarray = _SPACE, stems: tuple[int, ...] = ()) -> None:
        self.space, self.stems = space, stems
        self.stem_hashes: list[np.ndarray] = []
        p, q = np.full(self.BLOCK + 1, _R, np.uint64), np.full(self.BLOCK + 1, _R_INV, np.uint64)
        p[0] = q[0] = 1
        self._pow, self._inv = np.cumprod(p), np.cumprod(q)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word hashes, first word of each text and the end) of the texts data[offsets[i]:offsets[i+1]]."""
        n = len(data)
        word = ~self.space[data]
        before, follows = np.zeros(n, bool), np.zeros(n, bool)   # a word byte next to this one, in the same text
        before[1:], follows[:-1] = word[:-1], word[1:]
        before[offsets[offsets < n]] = False
        follows[offsets[(offsets > 0) & (offsets <= n)] - 1] = False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~follows) + 1
        h = np.empty(len(starts), np.uint64)
        self.stem_hashes = [np.zeros(len(starts), np.uint64) for _ in self.stems]
        i = 0
        while i < len(starts):
            a = starts[i]
            j = int(np.searchsorted(ends, a + self.BLOCK, side="right"))
            if j <= i:   # one word longer than a block
                h[i] = int.from_bytes(hashlib.blake2b(_LOWER[data[a:ends[i]]].tobytes(), digest_size=8).digest(), "little")
                i += 1
                continue
            own = data[a:ends[j - 1]]
            total = np.zeros(len(own) + 1, np.uint64)
            np.cumsum(_VALUES[own] * self._pow[:len(own)], out=total[1:])
            s, e = starts[i:j] - a, ends[i:j] - a
            h[i:j] = mix64((total[e] - total[s]) * self._inv[s] + (e - s).astype(np.uint64))
            for k, out in zip(self.stems, self.stem_hashes):
                out[i:j] = mix64((total[np.minimum(e, s + k)] - total[s]) * self._inv[s] + np.uint64(k << 40))
            i = j
        return h, np.searchsorted(starts, offsets)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and text offsets of a string column without copying texts; null is the empty text."""
    col = pa.array(col.to_pylist(), pa.large_string()) if pa.types.is_string_view(col.type) else col.cast(pa.large_string())
    n = len(col)
    buf = col.buffers()
    offsets = np.frombuffer(buf[1], np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buf[2], np.uint8) if n and buf[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]
