"""Merkle manifest of a dataset: a digest a row, a tree a source, a tree over the sources, and a proof a row.

H is the lowercase hex sha256 of its inputs one after another. A leaf is H of a row's fields, each ``-`` if null,
else its UTF-8 byte count, ``:`` and its value. Leaves of a source ascend by id; every ``arity`` consecutive nodes of a
level become the H of their hex digests, until one is left, the source's subroot. The subroots, by source, become the
root in the same way.

Sibling-shift self-joins: at every level a node computes the indices of its siblings (its own slot shifted by
1 .. arity - 1 within its run) and an equijoin on (source, run, slot) fetches their digests; the rows of slot zero then emit
the parents. Both sides of the join lie dealt by (source, run), so a level shuffles each node once, and a hot source
spreads over as many runs as it has. Paths come down again: a node's path is its own slot and siblings and its parent's path,
an equijoin on the parent's index.

Positions within a source come from sorted ranges and summed counts (``common.numbered``), so no source is sorted in one
task. The levels are stored; there are log(n) of them, the driver learns the size of the largest source and no more.

Defined results: a null id comes first; rows of one id are ordered by leaf, and equal rows share a leaf, so their
order changes nothing; a null source is a source of its own, before all others, apart from the empty name; null fields are
``-``, an empty text ``0:``; a source of one row has its leaf as subroot; with one source the subroot is the root; a row without
siblings at any level has the proof H of nothing; an empty table gives an empty table; columns not named as
fields change nothing and are left behind unless asked for.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, quoted, stored

ARITY = 16


def digest(*inputs: Column) -> Column:
    """H as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*inputs), 256))


def hex_text(col: Column) -> Column:
    return F.lower(F.hex(col))


def leaf(fields: list[Column]) -> Column:
    """Digest of a row's fields."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def source_key(col: Column) -> Column:
    """A text that keeps null apart from every name, and before it."""
    return F.when(col.isNull(), "").otherwise(F.concat(F.lit(":"), col.cast("string")))


@contextmanager
def _partial_keys(spark: SparkSession) -> Iterator[None]:
    """Joins on (tree, run, slot) may use rows that lie dealt by (tree, run); else each would shuffle arity - 1 rows a node."""
    conf = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def _level(nodes: DataFrame, arity: int, name: str) -> DataFrame:
    """Nodes (tree, idx, n, digest, ...) of runs with their ``slot`` and ``siblings``: the digests of the run's others, in order."""
    run = ["tree", "run"]
    nodes = nodes.where("n > 1").withColumn("run", F.floor(F.col("idx") / arity)).withColumn("slot", F.col("idx") % arity) \
        .repartition(*run)
    shifted = F.transform(F.sequence(F.lit(1), F.lit(arity - 1)), lambda k: (F.col("slot") + k) % arity)
    there = F.filter(shifted, lambda s: F.col("run") * arity + s < F.col("n"))
    asked = nodes.select(*run, "slot", F.explode(there).alias("sibling"))
    given = nodes.select(*run, F.col("slot").alias("sibling"), F.col("digest").alias("held"))
    found = asked.join(given.hint("merge"), [*run, "sibling"]).groupBy(*run, "slot").agg(
        F.array_sort(F.collect_list(F.struct("sibling", "held"))).alias("found"))   # at most arity - 1
    siblings = F.aggregate("found", F.lit(b""), lambda a, s: F.concat(a, s["held"]))
    out = nodes.join(found.select(*run, "slot", siblings.alias("siblings")).hint("merge"), [*run, "slot"], "left")
    with _partial_keys(nodes.sparkSession):
        return stored(out.withColumn("siblings", F.coalesce("siblings", F.lit(b""))), name)


def _parents(level: DataFrame, arity: int) -> DataFrame:
    """The rows of slot zero as their runs' parents."""
    return level.where("slot = 0").select(
        "tree", F.col("run").alias("idx"), F.ceil(F.col("n") / arity).alias("n"),
        digest(hex_text(F.col("digest")), hex_text(F.col("siblings"))).alias("digest"))


def _grow(nodes: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels from the leaves up, the one node left of each tree) of numbered nodes."""
    size = nodes.agg(F.max("n")).first()[0] or 0
    levels, tops = [], nodes.where("n = 1").select("tree", "digest")
    while size > 1:
        levels.append(_level(nodes, arity, f"{name}-{len(levels)}"))
        nodes, size = _parents(levels[-1], arity), -(-size // arity)
        tops = tops.unionByName(nodes.where("n = 1").select("tree", "digest"))
    return levels, tops


def _paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """``nodes`` with their ``path``, the (slot, siblings) of every level upwards, and what ``tops`` holds a tree.

    The path of a tree's last node is its ``tops`` row's; a node whose run is its tree's only one continues there.
    """
    held = [c for c in tops.columns if c not in ("tree", "path")]
    step = F.array(F.struct("slot", "siblings"))
    above = None
    for level in reversed(levels):
        part = level.where(F.col("n") <= arity).join(tops, "tree")
        if above is not None:
            part = part.unionByName(level.where(F.col("n") > arity).join(above, ["tree", "run"]))
        part = part.withColumn("path", F.concat(step, F.col("path")))
        above = part.select("tree", F.col("idx").alias("run"), "path", *held)
    alone = nodes.where("n = 1").join(tops, "tree").drop("n", "idx")
    return alone if above is None else alone.unionByName(part.drop("n", "idx", "run", "slot", "siblings"))


def leaves(df: DataFrame, fields: list[str], source: str, order: str, keep: dict[str, Column] | None = None) -> DataFrame:
    """Stored leaves (tree, id, digest, row) of a frame; ``keep`` are columns to carry along, by name."""
    rows = df.select(source_key(quoted(source)).alias("tree"), quoted(order).alias("id"), leaf([quoted(c) for c in fields]).alias("digest"),
                     *[c.alias(k) for k, c in (keep or {}).items()])
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")


def manifest(rows: DataFrame, arity: int = ARITY) -> DataFrame:
    """The leaves with their ``subroot``, the ``root`` (32 bytes each) and their ``path``: an array of (slot, siblings)."""
    order = [F.col(c) for c in ("tree", "id", "digest", "row")]
    nodes = numbered(rows, order, ["tree"], "merkle-numbered").drop("row")
    levels, tops = _grow(nodes, arity, "merkle-level")
    sources = stored(tops.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "merkle-subroots")
    places = numbered(sources, [F.col("tree"), F.col("source")], ["tree"], "merkle-sources")
    upper, last = _grow(places, arity, "merkle-upper")
    roots = last.select("tree", F.array().cast("array<struct<slot:bigint,siblings:binary>>").alias("path"), F.col("digest").alias("root"))
    tops = _paths(places, upper, roots, arity).select(F.col("source").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    return _paths(nodes, levels, stored(tops, "merkle-tops"), arity).drop("tree")


def proof_digest(path: Column) -> Column:
    """H of a path's siblings, from the leaf's upwards."""
    return digest(F.array_join(F.transform(path, lambda p: hex_text(p["siblings"])), ""))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    def up(at: Column, p: Column) -> Column:
        own = (p["slot"] * 32).cast("int")
        return digest(hex_text(F.concat(F.substring(p["siblings"], F.lit(1), own), at, F.substring(p["siblings"], own + 1, F.octet_length(p["siblings"])))))
    return F.aggregate(path, start, up)
