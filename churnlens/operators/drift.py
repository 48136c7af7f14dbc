"""Drift from stored quantile sketches (A15, A24, Q10, Q11): one small row per (period, split, feature), merged on read.

Every period's rows are read once, when they arrive, into one KLL sketch per (split, feature) and published as a part of a
versioned table; a period that is run again replaces its part. Drift reads sketches only: merged over the periods
asked for, the baseline's sketch gives the bin edges, and ranks of the edges in both sketches give the bin counts, so there is no
second pass over rows, no join of counts and nothing that grows with the rows.

Up to ``SKETCH_K`` values a (split, feature) a sketch holds every value and all results are exact; beyond, a rank is off by
about 1 / ``SKETCH_K`` of the rows, as documented for KLL sketches. NULL values are left out; a feature without
baseline values has no edges and no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import materialize
from ..sources.versions import Conflict, Manifest, VersionedTable

SKETCH_K = 4096
SCHEMA = T.StructType([T.StructField("split", T.StringType()), T.StructField("feature", T.StringType()),
                       T.StructField("sketch", T.BinaryType())])


def sketches(long: DataFrame, *by: str, k: int = SKETCH_K) -> DataFrame:
    """A KLL sketch of ``value`` per (``by``, split, feature)."""
    return long.where(F.col("value").isNotNull()).groupBy(*by, "split", "feature").agg(F.kll_sketch_agg_double("value", k).alias("sketch"))


def publish(table: VersionedTable, long: DataFrame, period: Column, only: list[str] | None = None) -> Manifest:
    """Publish the sketches of every period in ``long`` (one scan); other periods of the table stay as they are.

    ``only`` names the periods that ``long`` holds, where the caller knows; else they are read off the written folder.
    """
    folder = table.new_folder()
    made = sketches(long.withColumn("period", period.cast("string")), "period")
    made.coalesce(8).write.partitionBy("period").parquet(f"{table.root}/{folder}")   # a few hundred small rows a period
    periods = only or table.partition_values(folder, "period")
    parts = {f"period={p}": [f"{folder}/period={p}"] for p in periods}
    while True:
        try:
            return table.commit(table.latest(), parts)
        except Conflict:   # other periods were published meanwhile: these come on top
            continue


def stored(spark: SparkSession, root: str, long, period: Column) -> DataFrame:
    """The table's sketches; where none are published yet, those of ``long()`` are made and published first."""
    table = VersionedTable(spark, root)
    found = table.latest() or publish(table, long(), period)
    return table.read(found, SCHEMA)


def bins(sketch_rows: DataFrame, baseline: str = "train", current: str = "test", n_bins: int = 10) -> DataFrame:
    """(feature, bin, n_expected, n_actual): counts between the baseline's quantile edges, a value on an edge below it."""
    of = lambda split: F.kll_merge_agg_double(F.when(F.col("split") == split, F.col("sketch")), SKETCH_K)
    merged = sketch_rows.groupBy("feature").agg(of(baseline).alias("e"), of(current).alias("a"))
    shares = F.array(*[F.lit(i / n_bins) for i in range(1, n_bins)])
    held = merged.withColumns({"n_e": F.kll_sketch_get_n_double("e"), "n_a": F.kll_sketch_get_n_double("a")}).where("n_e > 0")
    held = materialize(held.withColumn("edges", F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("e", shares)))))
    # Spark takes ranks of literals only: the edges, n_bins - 1 numbers a feature, become part of the plan
    edges = {r["feature"]: r["edges"] for r in held.select("feature", "edges").collect()}
    if not edges:
        return held.select("feature", F.lit(0).alias("bin"), F.col("n_e").alias("n_expected"), F.col("n_a").alias("n_actual"))

    def counts(sketch: str, n: str) -> Column:
        upto = F.coalesce(*[F.when(F.col("feature") == f, F.kll_sketch_get_rank_double(sketch, F.array(*[F.lit(x) for x in own])))
                            for f, own in edges.items()])
        upto = F.when(F.col(n) > 0, F.transform(upto, lambda r: F.round(r * F.col(n)).cast("long"))) \
            .otherwise(F.transform("edges", lambda x: F.lit(0).cast("long")))
        return F.zip_with(F.concat(upto, F.array(F.col(n))), F.concat(F.array(F.lit(0).cast("long")), upto), lambda hi, lo: hi - lo)

    both = held.select("feature", counts("e", "n_e").alias("n_expected"), counts("a", "n_a").alias("n_actual"))
    each = both.select("feature", F.posexplode(F.arrays_zip("n_expected", "n_actual")))
    return each.select("feature", F.col("pos").alias("bin"), "col.n_expected", "col.n_actual").where("n_expected + n_actual > 0")
