"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers.

Rows get a global number by an order (``common.numbered``: sorted ranges and summed counts). A balanced Feistel network
permutes the numbers below the next power of four; a number that lands at or above the row count is permuted again until
it falls below (cycle walking), which makes it a permutation of the row numbers. The permuted number q gives the shard,
q mod shards, and the slot in it, q div shards: counts of shards differ by at most one and slots have no gaps. All
of it follows from (row number, row count, shards, seed), so ``place`` says where a row went and ``row_at`` which row a slot
holds, without the data.

The network's domain is less than four times the row count, so a walk takes fewer than four steps on average; it ends, as
a permutation's cycle comes back to its start, which is below the row count.

Defined results: null ids come first; rows of one id are ordered by the other order columns; rows equal in all of them are
interchangeable; an empty table gives an empty table, fewer rows than shards leave shards empty; null and empty
texts are rows like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_columns, mix64, numbered, quoted, stored

SHARDS, ROUNDS, SEED = 16, 6, 20240131
#: Odd multipliers of the round function.
MULTIPLY = (0x9E3779B1, 0x85EBCA77)
_LOW = np.uint64((1 << 32) - 1)


def half_bits(n: int) -> int:
    """Bits of each half of the smallest balanced domain that holds n numbers."""
    return max(1, -(-max(n - 1, 1).bit_length() // 2))


def _round(half: np.ndarray, key: int, mask: np.uint64) -> np.ndarray:
    """Low bits of a 32-bit hash of half and key (two multiplications, shifted sums)."""
    x = (half ^ np.uint64(key)) * np.uint64(MULTIPLY[0]) & _LOW
    x = (x ^ x >> np.uint64(13)) * np.uint64(MULTIPLY[1]) & _LOW
    return (x ^ x >> np.uint64(16)) & mask


def round_keys(seed: int = SEED, rounds: int = ROUNDS) -> list[int]:
    """A 32-bit key a round."""
    return [int(k) for k in mix64(np.uint64(seed) + np.arange(1, rounds + 1, dtype=np.uint64)) & _LOW]


def _network(x: np.ndarray, bits: int, keys: list[int], inverse: bool) -> np.ndarray:
    width, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    left, right = x >> width, x & mask
    if inverse:
        for k in reversed(keys):
            left, right = right ^ _round(left, k, mask), left
    else:
        for k in keys:
            left, right = right, left ^ _round(right, k, mask)
    return (left << width) | right


def permute(rows: np.ndarray, n: int, seed: int = SEED, rounds: int = ROUNDS, inverse: bool = False) -> np.ndarray:
    """The permutation of 0 .. n - 1 (or its inverse) at each of ``rows``."""
    bits, keys = half_bits(n), round_keys(seed, rounds)
    out = np.asarray(rows).astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        out[walking] = _network(out[walking], bits, keys, inverse)
        walking = walking[out[walking] >= np.uint64(n)]
    return out.astype(np.int64)


def place(rows: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(shard, slot) of row numbers."""
    q = permute(rows, n, seed)
    return q % shards, q // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Row numbers that stand at slots of shards."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, inverse=True)


def assign(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``row`` (global number by ``order``, nulls first), ``shard`` and ``slot``; its columns of these names go.

    All of ``df`` is sorted and stored, so hand over the columns that are needed and join the rest, or use ``write``.
    """
    names = [c for c in df.columns if c.lower() not in ("row", "shard", "slot")]
    inner = df.select([quoted(c).alias(f"c{i}") for i, c in enumerate(names)])
    keys = [F.col(f"c{names.index(c)}") for c in order]
    rows = stored(inner.withColumn("row", F.monotonically_increasing_id()), "sharding-rows")   # parts equal rows
    rows = numbered(rows, [*keys, F.col("row")], [], "sharding-numbered").drop("row")

    def make():
        def run(idx: pa.Array, n: pa.Array) -> list[pa.Array]:
            if not len(idx):
                return [pa.array([], pa.int32()), pa.array([], pa.int64())]
            shard, slot = place(idx.to_numpy(), n[0].as_py(), shards, seed)
            return [pa.array(shard, pa.int32()), pa.array(slot, pa.int64())]
        return run

    placed = map_columns(rows, ["idx", "n"], [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())], make)
    return placed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("idx").alias("row"), "shard", "slot")


def write(df: DataFrame, order: list[str], path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the rows as Parquet, a folder a shard, in order of slot; a shard of any size is dealt over many files."""
    placed = assign(df, order, shards, seed)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus one; null has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
