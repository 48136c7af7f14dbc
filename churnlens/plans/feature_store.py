"""Materialized feature views (S17/S19/S20): the reference's daily-refreshed view tables.

Each view, and the wide training table built from them, is written once under the
shared folder (``spark.checkpoint.dir``) as a Parquet table **bucketed and sorted by
subscriber_id** into the same number of buckets.  Joins between them on the entity
key then need no exchange and no sort (bucket-aligned sort-merge joins), and every
downstream query reads a few narrow tables instead of re-aggregating the raw events.

The store key covers the data root, the evaluation clock, the source files' sizes and
modification times, the bucket count and a hash of the view definitions, so a changed
input or a changed definition builds a new version instead of reading a stale one.
"""

from __future__ import annotations

import hashlib
import inspect
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar
from ..operators import features as FE
from ..session import file_fingerprints, scratch_path
from ..sources import adapters
from ..sources.versions import VersionedTable

KEY = FE.KEY
FOLDED = "folded_id"
#: Ids that a point lookup takes as literals.
MAX_POINTS = 100
_LOCK = threading.Lock()


def _code_hash() -> str:
    src = "".join(inspect.getsource(m) for m in (FE, adapters, scalar))
    return hashlib.sha1(src.encode()).hexdigest()[:10]


def store_key(spark: SparkSession, cat, as_of, buckets: int) -> str:
    """Data-version key: the catalog's source files (paths, sizes, modification times), the clock,
    the bucket count and the definitions.  A catalog without source files (in-memory frames) gets
    a unique key, so its store is never reused."""
    h = hashlib.sha1()
    h.update(f"{cat.root}|{as_of.isoformat()}|{buckets}|{_code_hash()}".encode())
    if not cat.source_paths:
        h.update(uuid.uuid4().hex.encode())
    for path in cat.source_paths:
        for fp, size, mtime in file_fingerprints(spark, path):
            h.update(f"{fp}|{size}|{mtime}".encode())
    return h.hexdigest()[:16]


BUCKET_TARGET_ROWS = 25_000   # subscribers per bucket: a task sorts and joins one bucket of every view
MIN_BUCKETS, MAX_BUCKETS = 8, 65536   # Spark takes up to 100,000
#: Shuffled bytes that a task of a build reads: small partitions are put together up to it.
TASK_READ = "16m"


def default_buckets(spark: SparkSession, cat) -> int:
    """Bucket count from the data, not the session: views hold one row per subscriber, so size
    the buckets from the counted subscribers (compressed bytes say little of them); a power of two in [8, 65536]."""
    want = max(1, -(-cat.subscriber_count // BUCKET_TARGET_ROWS))
    b = MIN_BUCKETS
    while b < want and b < MAX_BUCKETS:
        b *= 2
    return b


def _register(spark: SparkSession, name: str, path: str, buckets: int, key: str, ddl: str) -> DataFrame:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet CLUSTERED BY ({key}) "
              f"SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _table(spark: SparkSession, name: str, path: str, buckets: int, build, key: str = KEY) -> DataFrame:
    """Get-or-create one bucketed table, published by a manifest (``sources.versions``).

    A build writes into a data folder of its own and then publishes it, so a reader (or a concurrent builder in another
    process sharing the folder) never sees a partial table, and the first of two builders counts; a later session
    re-registers the published files with the same bucket spec.
    """
    if spark.catalog.tableExists(name):
        return spark.table(name)
    table = VersionedTable(spark, path)

    def write() -> str:
        folder, tmp_name = table.new_folder(), f"{name}_tmp_{uuid.uuid4().hex[:8]}"
        # one writer per bucket: repartition on the key first, so each bucket is one file
        (build().repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
         .option("path", f"{path}/{folder}").saveAsTable(tmp_name))
        spark.sql(f"DROP TABLE IF EXISTS {tmp_name}")  # external table: drops the entry, keeps the files
        return folder

    ddl = build()._jdf.schema().toDDL()   # an empty table has no file to read it from
    return _register(spark, name, table.folders(table.get_or_create(write))[0], buckets, key, ddl)


def materialized(ws, buckets: int | None = None, version: str = "") -> tuple[dict[str, DataFrame], DataFrame]:
    """(views, wide) for a Workspace, building what is missing (see ``store``)."""
    st = store(ws, buckets, version)
    return st["views"], st["wide"]


def store(ws, buckets: int | None = None, version: str = "") -> dict:
    """The bucketed tables of one data version: the five views, the wide table and the subscriber
    dimension (so joins of predictions or views with subscriber attributes are bucket-aligned too).

    The views and the dimension are independent jobs and are submitted concurrently (Spark
    schedules jobs from several threads); the wide table is built after them, from the stored views.
    Shuffles meanwhile have at least as many partitions as there are buckets, and no more of them are read by one task
    than ``TASK_READ`` holds, so a task's share of the raw rows stays as it is when the tables grow.
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = ws.spark
    buckets = buckets or default_buckets(spark, ws.cat)
    key = store_key(spark, ws.cat, ws.as_of, buckets) + version
    base = scratch_path(spark, "feature_store", key)

    def one(k: str) -> DataFrame:
        if k == "subscribers":
            return _table(spark, f"fs_{key}_subscribers", f"{base}/subscribers", buckets, lambda: ws.cat.subscribers)
        if k == "folded_ids":
            return _table(spark, f"fs_{key}_folded_ids", f"{base}/folded_ids", buckets,
                          lambda: ws.cat.subscribers.select(fold(F.col(KEY)).alias(FOLDED), KEY), FOLDED)
        fv = FE.FEATURE_VIEWS[k]
        return _table(spark, f"fs_{key}_{fv.table_name}", f"{base}/{fv.table_name}", buckets,
                      lambda: fv.build(ws.cat))

    names = [*FE.VIEW_ORDER, "subscribers", "folded_ids"]
    with _LOCK, shuffle_partitions(spark, buckets):
        with ThreadPoolExecutor(max_workers=len(names)) as pool:
            built = dict(zip(names, pool.map(one, names)))
        views = {k: built[k] for k in FE.VIEW_ORDER}
        wide = _table(spark, f"fs_{key}_churn_features", f"{base}/churn_features", buckets,
                      lambda: FE.training_frame(ws.cat, ws.as_of, views))
    return {"views": views, "wide": wide, "subscribers": built["subscribers"], "folded_ids": built["folded_ids"]}


@contextmanager
def shuffle_partitions(spark: SparkSession, least: int):
    """At least so many shuffle partitions, put together up to ``TASK_READ`` bytes a task."""
    name, together = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    own, own_together = spark.conf.get(name), spark.conf.get(together)
    try:
        if int(own) < least:
            spark.conf.set(name, str(least))
        spark.conf.set(together, TASK_READ)
        yield
    finally:
        spark.conf.set(name, own)
        spark.conf.set(together, own_together)


def fold(col: Column) -> Column:
    """Ids are looked up whatever their case."""
    return F.upper(col)


def lookup(st: dict, ids: DataFrame | list[str]) -> DataFrame:
    """The wide rows of ids typed in any case, by the stored index of folded ids.

    A list (a page's typed ids, at most ``MAX_POINTS``) becomes literals: the index is read from the buckets that its folded ids
    hash to, the wide table from the buckets of the ids found, and sorted files skip the row groups between. A frame of any size
    (column ``id``) joins the index on the folded id and the wide table on the id, both dealt by their join key already.
    """
    index, wide = st["folded_ids"], st["wide"]
    if isinstance(ids, list):
        if len(ids) > MAX_POINTS:
            raise ValueError(f"{len(ids)} ids: look up more than {MAX_POINTS} as a frame")
        own = index.where(F.col(FOLDED).isin([fold(F.lit(i)) for i in ids])) if ids else index.limit(0)
        found = [r[0] for r in own.select(KEY).collect()]   # ids that differ only in case
        return wide.where(F.col(KEY).isin(found)) if found else wide.limit(0)
    wanted = index.join(ids.select(fold(F.col("id")).alias(FOLDED)).distinct(), FOLDED).select(KEY)
    return wide.join(wanted, KEY, "left_semi")


def refresh(ws, buckets: int | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Recompute every view now into a new version (readers of the old one are unaffected)."""
    import uuid
    return materialized(ws, buckets, version="_" + uuid.uuid4().hex[:8])
