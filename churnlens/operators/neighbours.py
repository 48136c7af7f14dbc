"""The k nearest rows of many query rows, by a weighted sum of absolute differences.

score = sum over the dimensions of |difference| / max(q - lo, hi - q, 1), with lo and hi the smallest and largest value of the
query's group, so the weights differ from query to query.

An index that follows the data: rows are sorted along a Hilbert curve through their quantile ranks and cut into cells of
equally many rows, whatever the distribution; outliers stretch one cell, not the others. Every cell has its bounding box; boxes of ``FAN`` consecutive cells
make a node, and so on up to one root a group. Quantiles come from a mergeable sketch: they steer only where cells are cut, the
boxes are exact.

A search descends the tree by joins on (group, node). First each query follows the child that holds its place on the curve down to one
cell, whose k-th score bounds its result; then it meets every node that a box says may hold something as near, down to the cells, and only
those cells' rows are scored. Nothing is dropped: a box further away than k known rows holds no result.
A node is one row with an array of its children's boxes, a cell one with an array of its rows, and queries go in arrays too:
they are sorted along the same order and up to ``POINTS`` consecutive ones are one row, so those of a row reach the same few
cells. An array of queries meets an array of boxes or rows as two matrices, and only the boxes that its queries go on with and
the k best rows of each query in a cell are dealt or sorted: what a search writes to disk grows with the cells it meets, not
with the rows in them.

Before that, rows that agree in all dimensions are reduced to the k smallest ids (no others can be in a result), and equal
queries are searched once, so neither a hot profile nor a hot query makes a large group. A query set of at most ``few`` rows,
counted first, is broadcast and scored against all rows in one scan instead: same result, no index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from ..sources.io import materialize
from .order_stats import group_positions

#: Rows a cell (up to twice as many in a group's last), children a node, queries that are scored against all rows.
CELL, FAN, FEW = 512, 256, 64
#: Distinct queries in an array, queries times rows that are scored at once.
POINTS, BLOCK = 2000, 500_000
#: Rows and bytes of an Arrow batch: rows hold arrays.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20
#: Bits of a rank, one of so many quantiles a dimension.
RANK_BITS = 8
#: Nodes of a level, and groups, that are broadcast (some 10 KB each); more meet the queries in a shuffle join.
FEW_NODES = 500
_SLACK = 1 + 1e-9   # rounding of a bound must not exclude a tie


def _best(scored: DataFrame, query: str, id_col: str, k: int) -> DataFrame:
    """The k best rows of each query; Spark limits the groups before the shuffle as well (rank filter on a window)."""
    w = Window.partitionBy(query).orderBy("score", id_col)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _score(dims: list[str]) -> Column:
    return sum(F.abs(F.col(d) - F.col(f"q_{d}")) / F.col(f"max_{d}") for d in dims)


# --- arrays of rows -----------------------------------------------------------------------------------------

class _Lists:
    """A batch's column of arrays of structs: each one's place in the fields' flat values."""

    def __init__(self, col: pa.Array) -> None:
        self.flat = col.flatten()
        self.ends = np.concatenate([[0], np.cumsum(col.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)

    def numbers(self, names: list[str]) -> list[np.ndarray]:
        return [self.flat.field(name).cast(pa.float64()).to_numpy(zero_copy_only=False) for name in names]

    def of(self, i: int) -> slice:
        return slice(int(self.ends[i]), int(self.ends[i + 1]))


def _arrays(flat: pa.Array, sizes: list[int]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)


def _structs(df: DataFrame, columns: list[str]) -> T.ArrayType:
    return T.ArrayType(df.select(columns).schema)


def _packed(df: DataFrame, group: str, columns: list[str], name: str) -> DataFrame:
    """(group, ``name``): arrays of up to ``POINTS`` rows of a group, in the order of each partition."""
    schema = T.StructType([df.schema[group], T.StructField(name, _structs(df, columns))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = b.column(0).dictionary_encode()
            code = key.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(code, kind="stable")
            cuts = [c for at in (np.flatnonzero(code[order] == g) for g in range(len(key.dictionary))) for c in range(at[0], at[-1] + 1, POINTS)]
            rows = pa.StructArray.from_arrays([x.take(pa.array(order)) for x in b.columns[1:]], names=columns)
            sizes = np.diff([*cuts, b.num_rows]).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(order[cuts])), _arrays(rows, sizes)], names=[group, name])

    # a group column that is packed too goes twice
    return df.select(F.col(group).alias("_group"), *columns).mapInArrow(pack, schema)


def _few_first(df: DataFrame) -> DataFrame:
    """``df``, broadcast if it has at most ``FEW_NODES`` rows."""
    return F.broadcast(df) if df.limit(FEW_NODES + 1).count() <= FEW_NODES else df


# --- index --------------------------------------------------------------------------------------------------

def _ranks(rows: DataFrame, group: str, dims: list[str]) -> DataFrame:
    """Quantile bounds of each dimension and group, one row a group."""
    shares = [i / (1 << RANK_BITS) for i in range(1, 1 << RANK_BITS)]
    return rows.groupBy(group).agg(*[F.percentile_approx(d, shares, 2000).alias(f"bounds_{d}") for d in dims])


def _hilbert(ranks: list[np.ndarray]) -> np.ndarray:
    """Places of the ranks along a Hilbert curve (Skilling 2004): consecutive places are neighbours, so any stretch of them has
    a compact box."""
    x = [rank.astype(np.int64) for rank in ranks]
    for bit in reversed(range(1, RANK_BITS)):
        high, low = 1 << bit, (1 << bit) - 1
        for i in range(len(x)):
            flip = (x[i] & high) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ np.where(flip, low, swap)
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in reversed(range(1, RANK_BITS)):
        turn ^= np.where(x[-1] & (1 << bit), (1 << bit) - 1, 0)
    code = np.zeros_like(x[0])
    for bit in reversed(range(RANK_BITS)):
        for own in x:
            code = code * 2 + ((own ^ turn) >> bit & 1)
    return code


def _coded(df: DataFrame, bounds: DataFrame, group: str, values: list[str], dims: list[str]) -> DataFrame:
    """``df`` with ``_code``, the place of its ``values`` on the curve: their ranks are how many distinct quantile bounds they have
    reached, spread over the ranks there are."""
    columns = df.columns
    packed = _packed(df, group, columns, "_rows").join(bounds, group).select("_rows", *[f"bounds_{d}" for d in dims])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = _Lists(b.column(0))
            own = rows.numbers(values)
            codes = []
            for i in range(b.num_rows):
                steps = [np.unique(np.array(b.column(j + 1)[i].as_py(), float)) for j in range(len(own))]
                codes.append(_hilbert([np.searchsorted(x, v[rows.of(i)], side="right") * ((1 << RANK_BITS) - 1) // len(x) for x, v in zip(steps, own)]))
            yield pa.RecordBatch.from_arrays([*[rows.flat.field(c) for c in columns], pa.array(np.concatenate(codes or [[]]), pa.int64())],
                                             names=[*columns, "_code"])

    return packed.mapInArrow(code, T.StructType([*df.schema.fields, T.StructField("_code", T.LongType())]))


def _index(rows: DataFrame, bounds: DataFrame, group: str, dims: list[str], id_col: str, cell: int) -> tuple[DataFrame, list[DataFrame]]:
    """(cells with their ``_rows``, by id, the node tables from the cells' parents up) -- a parent has the boxes of its ``_children``."""
    coded = _coded(rows, bounds, group, dims, dims)
    placed = group_positions(coded, [group], [F.col(c) for c in ("_code", *dims, id_col)])
    last = F.greatest(F.floor(F.col("group_size") / cell) - 1, F.lit(0))
    placed = placed.withColumn("cell", F.least(F.floor(F.col("position") / cell), last))
    # a cell's rows are one array: at most twice ``cell`` of them
    by_id = F.struct(F.col(id_col).alias("_id"), F.col("position"), F.struct(*rows.columns).alias("_row"))
    sides = [*dims, "_code"]
    cells = materialize(placed.groupBy(group, "cell").agg(
        F.transform(F.sort_array(F.collect_list(by_id)), lambda x: x["_row"]).alias("_rows"),
        *[f(d).alias(f"{n}_{d}") for d in sides for n, f in (("lo", F.min), ("hi", F.max))]))
    edges = [f(f"{n}_{d}").alias(f"{n}_{d}") for d in sides for n, f in (("lo", F.min), ("hi", F.max))]
    boxes = [f"{n}_{d}" for d in sides for n in ("lo", "hi")]
    level = materialize(cells.select(group, F.col("cell").alias("node"), *boxes, F.floor(F.col("cell") / FAN).alias("parent")))
    levels, width = [level], level.agg(F.max("node")).first()[0] or 0
    while width >= FAN:
        level = level.groupBy(group, F.col("parent").alias("node")).agg(*edges).withColumn("parent", F.floor(F.col("node") / FAN))
        levels.append(level)
        width //= FAN
    children = F.collect_list(F.struct("node", *boxes)).alias("_children")   # at most ``FAN``
    return cells.select(group, F.col("cell").alias("parent"), "_rows"), [_few_first(materialize(x.groupBy(group, "parent").agg(children))) for x in levels]


# --- search -------------------------------------------------------------------------------------------------

def _box_bounds(q: list[np.ndarray], most: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray]) -> np.ndarray:
    """The least score that a row inside a box can have."""
    return sum(np.maximum(np.maximum(lo - v, v - hi), 0.0) / m for v, m, lo, hi in zip(q, most, low, high))


def _scores(q: list[np.ndarray], most: list[np.ndarray], rows: list[np.ndarray]) -> np.ndarray:
    return sum(np.abs(r - v) / m for v, m, r in zip(q, most, rows))


def _own_child(code: np.ndarray, low_code: np.ndarray, high_code: np.ndarray, q: list[np.ndarray], most: list[np.ndarray],
               low: list[np.ndarray], high: list[np.ndarray]) -> np.ndarray:
    """The child that holds each query's place on the curve; of several the nearest, of overlapping ones that with the nearest centre."""
    away = np.maximum(np.maximum(low_code - code[:, None], code[:, None] - high_code), 0)
    at, child = np.nonzero(away <= away.min(axis=1, keepdims=True))
    q, most, low, high = [x[at] for x in q], [x[at] for x in most], [x[child] for x in low], [x[child] for x in high]
    order = np.lexsort((_scores(q, most, [(a + z) / 2 for a, z in zip(low, high)]), _box_bounds(q, most, low, high), at))
    return child[order[np.flatnonzero(np.diff(at[order], prepend=-1))]]


def _descended(pieces: DataFrame, level: DataFrame, group: str, dims: list[str], first_only: bool) -> DataFrame:
    """Arrays of queries at the nodes ``parent`` a level down: at the one child where each belongs, or all children within its ``reach``."""
    met = pieces.join(level, [group, "parent"]).select(group, "_points", "_children")
    schema = pieces.select(group, "parent", "_points").schema

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points, boxes = _Lists(b.column(1)), _Lists(b.column(2))
            q, most = (points.numbers([f"{n}_{d}" for d in dims]) for n in ("q", "max"))
            low, high = (boxes.numbers([f"{n}_{d}" for d in dims]) for n in ("lo", "hi"))
            nodes = boxes.flat.field("node").to_numpy(zero_copy_only=False)
            reach = None if first_only else points.numbers(["reach"])[0]
            code, low_code, high_code = (x.flat.field(n).to_numpy(zero_copy_only=False) for x, n in ((points, "_code"), (boxes, "lo__code"), (boxes, "hi__code")))
            for i in range(b.num_rows):
                p, c = points.of(i), boxes.of(i)
                own, own_most, own_low, own_high = ([x[s] for x in xs] for xs, s in ((q, p), (most, p), (low, c), (high, c)))
                if first_only:
                    child = _own_child(code[p], low_code[c], high_code[c], own, own_most, own_low, own_high)
                    at = np.argsort(child, kind="stable")
                    child = child[at]
                else:
                    bound = _box_bounds([x[:, None] for x in own], [x[:, None] for x in own_most], own_low, own_high)
                    child, at = np.nonzero((bound <= reach[p, None] * _SLACK).T)
                if len(child):
                    begin = np.flatnonzero(np.diff(child, prepend=-1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([b.column(0)[i].as_py()] * len(begin), b.schema.field(0).type), pa.array(nodes[c][child[begin]], pa.int64()),
                         _arrays(points.flat.take(pa.array(p.start + at)), np.diff([*begin, len(child)]).tolist())], names=[group, "parent", "_points"])

    return met.mapInArrow(descend, schema)


def _reached(pieces: DataFrame, cells: DataFrame, group: str, dims: list[str], k: int) -> DataFrame:
    """Arrays of queries, at the root again, with their ``reach``: the k-th score in the cell they are at."""
    met = pieces.join(cells, [group, "parent"]).select(group, "_points", "_rows")
    point = pieces.schema["_points"].dataType.elementType
    names = point.names
    schema = T.StructType([pieces.schema[group], T.StructField("parent", T.LongType()),
                           T.StructField("_points", T.ArrayType(T.StructType([*point.fields, T.StructField("reach", T.DoubleType())])))])

    def limit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points, rows = _Lists(b.column(1)), _Lists(b.column(2))
            q, most, own = (x.numbers([f"{n}{d}" for d in dims]) for x, n in ((points, "q_"), (points, "max_"), (rows, "")))
            reach = np.full(len(points.flat), np.inf)
            for i in range(b.num_rows):
                p, r = points.of(i), rows.of(i)
                if r.stop - r.start >= k:
                    for part in _parts(p, r):
                        scores = _scores([x[part, None] for x in q], [x[part, None] for x in most], [x[r] for x in own])
                        reach[part] = np.partition(scores, k - 1, axis=1)[:, k - 1]
            out = pa.StructArray.from_arrays([*[points.flat.field(n) for n in names], pa.array(reach)], names=[*names, "reach"])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.zeros(b.num_rows, np.int64)), _arrays(out, np.diff(points.ends).tolist())],
                                             names=[group, "parent", "_points"])

    return met.mapInArrow(limit, schema)


def _parts(points: slice, rows: slice) -> list[slice]:
    """The points in parts that meet all the rows in a matrix of bounded size."""
    width = max(1, BLOCK // max(1, rows.stop - rows.start))
    return [slice(c, min(c + width, points.stop)) for c in range(points.start, points.stop, width)]


def _rows_within(pieces: DataFrame, cells: DataFrame, rows: DataFrame, group: str, dims: list[str], k: int) -> DataFrame:
    """(_point, score, the row's columns) of the rows within each query's ``reach`` in the cells it is at, k of a cell at most."""
    met = pieces.join(cells, [group, "parent"]).select("_points", "_rows")
    columns = rows.columns

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points, lists = _Lists(b.column(0)), _Lists(b.column(1))
            q, most, own = (x.numbers([f"{n}{d}" for d in dims]) for x, n in ((points, "q_"), (points, "max_"), (lists, "")))
            reach = points.numbers(["reach"])[0]
            found = []
            for i in range(b.num_rows):
                r = lists.of(i)
                for part in _parts(points.of(i), r):
                    scores = _scores([x[part, None] for x in q], [x[part, None] for x in most], [x[r] for x in own])
                    limit = reach[part]
                    if r.stop - r.start > k:
                        limit = np.minimum(limit, np.partition(scores, k - 1, axis=1)[:, k - 1])
                    at, row = np.nonzero(scores <= limit[:, None])
                    score = scores[at, row]
                    best = np.lexsort((row, score, at))   # a cell's rows are in the order of their ids
                    at, row, score = at[best], row[best], score[best]
                    kept = np.arange(len(at)) - np.searchsorted(at, at) < k
                    found.append((part.start + at[kept], r.start + row[kept], score[kept]))
            at, row, score = (np.concatenate([f[j] for f in found]) for j in range(3)) if found else (np.zeros(0, np.int64),) * 3
            taken = lists.flat.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([points.flat.field("_point").take(pa.array(at)), pa.array(score, pa.float64()), *[taken.field(c) for c in columns]],
                                             names=["_point", "score", *columns])

    return met.mapInArrow(meet, T.StructType([T.StructField("_point", T.LongType()), T.StructField("score", T.DoubleType()), *rows.schema.fields]))


def nearest(rows: DataFrame, queries: DataFrame, k: int, id_col: str, query_col: str, group: str, dims: list[str],
            cell: int = CELL, few: int = FEW) -> DataFrame:
    """(query, rank, score, the row's columns): the k nearest ``rows`` of each query's group, ties by ``id_col``.

    Groups and dimensions that are NULL match nothing; a group of fewer than k rows gives what it has; repeated queries of
    one id are one query.
    """
    whole = lambda df: df.where(F.expr(" and ".join(f"`{c}` is not null" for c in (group, *dims))))
    rows = whole(rows)
    spans = rows.groupBy(group).agg(*[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))])
    asked = whole(queries.dropDuplicates([query_col]))
    widest = [F.greatest(F.col(d) - F.col(f"lo_{d}"), F.col(f"hi_{d}") - F.col(d), F.lit(1.0)).alias(f"max_{d}") for d in dims]
    out = [query_col, "rank", "score", *rows.columns]
    sized = materialize(asked.join(spans, group).select(query_col, group, *[F.col(d).alias(f"q_{d}") for d in dims], *widest))
    if sized.limit(few + 1).count() <= few:
        return _best(rows.join(F.broadcast(sized), group).withColumn("score", _score(dims)), query_col, id_col, k).select(out)

    spark = rows.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    same = Window.partitionBy(group, *dims).orderBy(id_col)
    distinct = rows.withColumn("_same", F.row_number().over(same)).where(F.col("_same") <= k).drop("_same")
    bounds = _few_first(materialize(_ranks(distinct, group, dims)))
    cells, levels = _index(distinct, bounds, group, dims, id_col, max(cell, k))
    profile, widths = [f"q_{d}" for d in dims], [f"max_{d}" for d in dims]
    asked = _coded(sized.drop(query_col).dropDuplicates([group, *profile]), bounds, group, profile, dims)
    order = [F.col(c) for c in (group, "_code", *profile)]
    parts = max(1, -(-asked.count() // POINTS))   # much work a row: not dealt by bytes
    points = materialize(asked.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_point", F.monotonically_increasing_id()))
    pieces = _packed(points, group, ["_point", "_code", *profile, *widths], "_points").withColumn("parent", F.lit(0).cast("long"))
    for level in reversed(levels):
        pieces = _descended(pieces, level, group, dims, True)
    pieces = _reached(pieces, cells, group, dims, k)
    for level in reversed(levels):
        pieces = _descended(pieces, level, group, dims, False)
    found = _best(_rows_within(pieces, cells, rows, group, dims, k), "_point", id_col, k)
    own = sized.select(query_col, group, *profile).join(points.select("_point", group, *profile), [group, *profile]).select(query_col, "_point")
    return own.join(found.select("_point", *out[1:]), "_point").select(out)
