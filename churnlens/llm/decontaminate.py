"""Benchmark decontamination: which document words lie inside an occurrence of a benchmark window.

A prefix-filtered set join, all in DataFrame functions. A window is ``window`` consecutive words of an item
(all its words if they are fewer); containment is exact, so the necessary prefix of a window is its one
rarest shingle.

1. Shingles of ``SHINGLE`` words (of the whole window where it is shorter) of the items meet the documents'
   shingles at every position; a hash joins, the words decide. One scan of the documents gives every match
   and, by a mark on each document, its word count.
2. The matches give each shingle's frequency in the documents. Each window is represented by its rarest
   shingle; windows with a shingle that never occurs are out.
3. A match of that shingle proposes one start. Positional and length bounds drop starts before the first or
   windows beyond the last word.
4. A candidate is verified over the whole window: each of its shingles must have matched at its position,
   so the words are equal one by one.

The benchmark's shingles are broadcast up to ``max_broadcast`` rows and joined by a shuffle beyond it.
Hits are counted from distinct word positions, items from distinct windows.

Defined results: null and empty text have no words and no hits; items without words have no window; equal
windows of several items count for each of them; rows of one id and text are judged alike, one row out for
each row in; null ids are kept; a null item id counts as an item but isn't listed; an empty table on
either side gives no hits. Only the columns named are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, stored, text_hash

#: Words per shingle of a window, and the broadcast bound for the benchmark's shingles.
SHINGLE, MAX_BROADCAST = 3, 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words, after lower-casing A-Z: ASCII but digits and a-z.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BETWEEN), lambda w: w != "")


def _shingles(w: Column, size: int) -> Column:
    """Array of the joined ``size``-word shingles at each position; empty for fewer words."""
    if size == 1:
        return w
    return F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(1), F.size(w) - (size - 1)), lambda i: F.array_join(F.slice(w, i, size), " "))).otherwise(
        F.array().cast("array<string>"))


def _hashes(w: Column, size: int) -> Column:
    """Array of the shingles' hashes at each position, without building their text."""
    return F.when(F.size(w) >= size, F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(size)]))).otherwise(
        F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct windows: window_id, its words ``w`` and the items that hold it."""
    items = benchmark.select(quoted(item_id).alias("item_id"), words(quoted(text)).alias("w")).where(F.size("w") > 0)
    start = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1)))
    return (items.select("item_id", F.explode(F.transform(start, lambda i: F.slice(F.col("w"), i, window))).alias("w"))
            .groupBy("w").agg(F.collect_set("item_id").alias("items"))
            .withColumn("window_id", F.array_join("w", " ")))


def find_hits(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text", window: int = 10,
              max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per document: doc_id, text_hash, n_words, n_hit, n_items, item_ids, contaminated."""
    wins = stored(windows(benchmark, item_id, item_text, window), "windows")
    sized = wins.select("window_id", F.size("w").alias("n"), "w").withColumn("size", F.least(F.col("n"), F.lit(SHINGLE)))
    sizes = [r["size"] for r in sized.select("size").distinct().orderBy("size").collect()]   # at most SHINGLE values
    # each window's shingles with their offset
    parts = None
    for size in sizes:
        own = sized.where(F.col("size") == size)
        own = own.select("window_id", "n", F.posexplode(_shingles(F.col("w"), size)).alias("offset", "shingle"))
        own = own.withColumn("size", F.lit(size))
        parts = own if parts is None else parts.unionByName(own)

    source = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    read = source.select("doc_id", text_hash(F.col("text")).alias("text_hash"), words(F.col("text")).alias("w"))
    if parts is None:   # no window at all
        return (read.select("doc_id", "text_hash", F.size("w").cast("long").alias("n_words"))
                .withColumns({"n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"),
                              "item_ids": F.array().cast("array<string>"), "contaminated": F.lit(False)}))
    parts = stored(parts, "window-shingles")
    wanted = parts.groupBy("shingle", "size").agg(F.lit(1).alias("one")).drop("one")
    key = F.lit(None).cast("long")
    for size in sizes:
        key = F.when(F.col("size") == size, F.xxhash64(*[F.get(F.split("shingle", " "), F.lit(j)) for j in range(size)])).otherwise(key)
    wanted = wanted.select("shingle", F.col("size").alias("wanted_size"), key.alias("hash"))
    mark = docs.sparkSession.range(1).select(F.lit(None).cast("string").alias("shingle"), F.lit(0).alias("wanted_size"),
                                             F.lit(0).cast("long").alias("hash"))
    wanted = wanted.unionByName(mark)
    small = F.broadcast if parts.limit(max_broadcast + 1).count() <= max_broadcast else (lambda df: df)
    wanted = small(wanted)

    # the hashes of each shingle size one after another, and one last entry that marks the document itself
    n_words = F.size("w")
    exploded = read.select("doc_id", "text_hash", "w", n_words.alias("n_words"),
                           F.posexplode(F.concat(*[_hashes(F.col("w"), k) for k in sizes], F.array(F.lit(0).cast("long")))).alias("entry", "hash"))
    size, position, first = F.lit(0), F.lit(-1), F.lit(0)
    for k in sizes:
        count = F.greatest(F.lit(0), F.col("n_words") - (k - 1))
        here = (F.col("entry") >= first) & (F.col("entry") < first + count)
        size, position, first = F.when(here, k).otherwise(size), F.when(here, F.col("entry") - first).otherwise(position), first + count
    same = F.col("wanted_size") == 0
    for k in sizes:
        same = F.when(size == k, F.array_join(F.slice("w", position + 1, F.lit(k)), " ") == F.col("shingle")).otherwise(same)
    matched = (exploded.join(wanted, "hash").where((size == F.col("wanted_size")) & same)
               .select("doc_id", "text_hash", "n_words", size.alias("size"), position.alias("position"), "shingle"))
    return _judge(stored(matched, "matches"), parts, wins, small)


def _judge(matched: DataFrame, parts: DataFrame, wins: DataFrame, small) -> DataFrame:
    every = matched.where("size = 0").select("doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"))
    hits = matched.where("size > 0").distinct()   # rows of one id and text match alike
    frequency = hits.groupBy("shingle", "size").agg(F.count(F.lit(1)).alias("frequency"))
    rarity = (parts.join(frequency, ["shingle", "size"], "left").groupBy("window_id", "n", "size")
              .agg(F.min(F.struct(F.coalesce("frequency", F.lit(0)).alias("frequency"), "offset", "shingle")).alias("rarest"),
                   F.count(F.lit(1)).alias("needed")))
    prefix = rarity.where("rarest.frequency > 0").select("window_id", "n", "size", "needed", "rarest.offset", "rarest.shingle")
    at = (hits.join(small(prefix), ["shingle", "size"])
          .withColumn("start", F.col("position") - F.col("offset"))
          .where("start >= 0 AND start + n <= n_words")
          .select("doc_id", "text_hash", "start", "window_id", "n", "size", "needed"))
    key = F.struct("doc_id", "text_hash", "position", "size", "shingle")
    steps = at.join(small(parts.select("window_id", "offset", "shingle")), "window_id").withColumn("position", F.col("start") + F.col("offset"))
    there = hits.select(key.alias("key"))
    verified = (steps.withColumn("key", key).join(there, "key").groupBy("doc_id", "text_hash", "start", "window_id", "n", "needed")
                .agg(F.count(F.lit(1)).alias("found")).where("found = needed"))
    verified = stored(verified.select("doc_id", "text_hash", "start", "window_id", "n"), "occurrences")
    covered = (verified.select("doc_id", "text_hash", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("p"))
               .distinct().groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n_hit")))
    items = (verified.select("doc_id", "text_hash", "window_id").distinct()
             .join(wins.select("window_id", F.explode_outer("items").alias("item")), "window_id")
             .select("doc_id", "text_hash", "item").distinct()
             .groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n_items"),
                                                 F.sort_array(F.collect_list(F.col("item").cast("string"))).alias("item_ids")))
    found = covered.join(items, [covered["doc_id"].eqNullSafe(items["doc_id"]), covered["text_hash"] == items["text_hash"]]).select(
        covered["doc_id"].alias("hit_id"), covered["text_hash"].alias("hit_hash"), "n_hit", "n_items", "item_ids")
    out = every.join(found, [every["doc_id"].eqNullSafe(found["hit_id"]), every["text_hash"] == found["hit_hash"]], "left")
    return out.select("doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))
