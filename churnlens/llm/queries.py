"""The registered opN queries: thin wrappers that read the tables, apply an operator and derive digest columns."""

from __future__ import annotations

import importlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontaminate, html_extract, jaccard_join, merkle, pii, quality_pu, runs, sharding, suffix_tree, toxicity, url_filter, winnowing


OP1_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
        FROM items WHERE len(w) > 0)),
spots AS (
  SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM docs, (SELECT DISTINCT n FROM wins))),
found AS (SELECT rid, p, n, item_id FROM spots JOIN wins USING (n, win)),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM found) GROUP BY rid),
who AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN who USING (rid)
"""


def _crc32_sql(array: str) -> str:
    """crc32 of a list of byte values: eight shifts a byte of the reflected polynomial."""
    shift = "list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {array}), lambda c, b: {shift}), 4294967295)"


def _levels_sql(name: str, start: str, levels: int) -> str:
    """CTEs {name}0 .. {name}{levels}: nodes (tree, idx, d) of each level; {name}_up{l}: what stands before and behind a node's digest."""
    parts = [f"{name}0 AS ({start})"]
    for k in range(levels):
        parts.append(f"{name}_many{k} AS (SELECT *, idx // 16 AS run FROM {name}{k} WHERE tree IN (SELECT tree FROM {name}{k} GROUP BY tree HAVING count(*) > 1))")
        parts.append(f"""{name}_up{k} AS (SELECT a.tree, a.idx, coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS pre,
            coalesce(string_agg(b.d, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS post
            FROM {name}_many{k} a JOIN {name}_many{k} b ON a.tree = b.tree AND a.run = b.run GROUP BY a.tree, a.idx)""")
        parts.append(f"""{name}{k + 1} AS (SELECT tree, run AS idx, sha256(string_agg(d, '' ORDER BY idx)) AS d FROM {name}_many{k} GROUP BY tree, run)""")
    tops = " UNION ALL ".join(f"SELECT tree, d FROM {name}{k} WHERE tree IN (SELECT tree FROM {name}{k} GROUP BY tree HAVING count(*) = 1)" for k in range(levels + 1))
    parts.append(f"{name}_top AS ({tops})")
    return ",\n".join(parts)


def _fold_sql(name: str, steps: list[tuple[str, str, str]]) -> str:
    """CTEs that fold leaf digests d and f and the proof upwards over (siblings table, tree column, index expression) steps."""
    parts = []
    for k, (up, tree, idx) in enumerate(steps):
        parts.append(f"""{name}{k + 1} AS (SELECT w.* EXCLUDE (f, proof), CASE WHEN u.idx IS NULL THEN f ELSE sha256(u.pre || f || u.post) END AS f,
            proof || coalesce(u.pre || u.post, '') AS proof
            FROM {name}{k} w LEFT JOIN {up} u ON u.tree = w.{tree} AND u.idx = {idx})""")
    return ",\n".join(parts)


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


#: Levels that the SQL spells out: up to 16^6 rows a source, 16^4 sources.
_LEVELS, _UPPER = 6, 4
_TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
OP11_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(':' || source, '') AS tree, {_LEAF.format(text="text")} AS leaf, {_LEAF.format(text=_TAMPERED)} AS tampered,
         {_crc32_sql("[ord(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]")} % 5 = 0 AS chosen
  FROM documents),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM docs),
{_levels_sql("s", "SELECT tree, idx, leaf AS d FROM placed", _LEVELS)},
named AS (SELECT tree AS name, d, row_number() OVER (ORDER BY tree) - 1 AS place FROM s_top),
{_levels_sql("t", "SELECT '' AS tree, place AS idx, d FROM named", _UPPER)},
walk0 AS (SELECT doc_id, leaf, p.tree, p.idx, n.d AS subroot, '' AS top, n.place, CASE WHEN chosen THEN tampered ELSE leaf END AS f, '' AS proof
          FROM placed p JOIN named n ON n.name = p.tree),
{_fold_sql("walk", [(f"s_up{k}", "tree", f"w.idx // {16 ** k}") for k in range(_LEVELS)] + [(f"t_up{k}", "top", f"w.place // {16 ** k}") for k in range(_UPPER)])}
SELECT doc_id, leaf, subroot, t_top.d AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t_top.d AS verified
FROM walk{_LEVELS + _UPPER}, t_top
"""


_BYTES = "[('0x' || h)::BIGINT FOR h IN regexp_extract_all(hex(encode(coalesce(text, ''))), '..')]"
_M = 4294967295
#: One step of the recursion is one round; a number is home after its last round if it is below the row count.
OP13_SQL = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 1)::BIGINT AS size, {_crc32_sql(_BYTES)} AS text_crc32,
         row_number() OVER (ORDER BY doc_id NULLS FIRST, text IS NOT NULL, sha256(coalesce(text, ''))) - 1 AS row
  FROM documents),
size AS (SELECT count(*) AS n, greatest(1, (length(ltrim(bin(greatest(count(*) - 1, 1)), '0')) + 1) // 2)::INT AS bits FROM documents),
keys AS (SELECT unnest({sharding.round_keys()})::UBIGINT AS key, unnest(range({sharding.ROUNDS})) AS k),
walk AS (
  SELECT row, 0 AS k, row::UBIGINT >> bits AS l, row::UBIGINT & ((1::UBIGINT << bits) - 1) AS r, FALSE AS home FROM docs, size
  UNION ALL
  SELECT row, (k + 1) % {sharding.ROUNDS}, r, xor(l, xor(y, y >> 16) & ((1::UBIGINT << bits) - 1)),
         k = {sharding.ROUNDS - 1} AND (r << bits) + xor(l, xor(y, y >> 16) & ((1::UBIGINT << bits) - 1)) < n
  FROM (SELECT *, (xor(x, x >> 13) * {sharding.MULTIPLY[1]}::UBIGINT) & {_M}::UBIGINT AS y
        FROM (SELECT *, (xor(r, key) * {sharding.MULTIPLY[0]}::UBIGINT) & {_M}::UBIGINT AS x
              FROM walk JOIN keys USING (k), size WHERE NOT home))),
placed AS (SELECT row, ((l << bits) + r)::BIGINT AS q FROM walk, size WHERE home)
SELECT doc_id, size, text_crc32, 'rows' AS law, (q % {sharding.SHARDS})::INT AS shard, q // {sharding.SHARDS} AS slot,
       NULL::INT AS grown_shard, row
FROM docs JOIN placed USING (row)
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text and the bytes they decode to, as digests."""
    ranks, pattern = byte_bpe.public_vocabulary()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern).drop("text"), ranks)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside an occurrence of a ten-word benchmark window."""
    hits = decontaminate.find_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of three-word shingles have a Jaccard similarity of 0.9 or more."""
    found = jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = html_extract.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL; the classifier learns from URLs that the rules already judge."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.train(url_filter.rule_labels(pages)))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op4_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts, a digest of the base spans and all spans."""
    found = pii.find_spans(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    counts = [F.size(F.filter("spans", pii.of_kind(k))).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select(
        "doc_id", *counts,
        F.sha2(pii.span_text("spans", pii.BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        pii.span_text("spans").alias("spans"),
    )


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, with their likeness to the next document's."""
    return winnowing.neighbour_fingerprints(_table(spark, sf_dir, "documents"))


def op6_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every text under a suffix tree and under smoothed word counts, learned from four folds of five."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.held_out("doc_id", 5, 1)
    scored = suffix_tree.score(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text; labels of the held-out fold are never read by the fit."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = _table(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id", 3, 1))
    scored = quality_pu.score(docs, quality_pu.train(docs, seen)).drop("text")
    return scored.select("doc_id", toxicity.held_out("doc_id", 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text; labels of the held-out fold are never read by the fit."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = _table(spark, sf_dir, "labels").where(~toxicity.held_out("doc_id", 5, 0))
    scored = toxicity.score(docs, toxicity.train(docs, seen)).drop("text")
    return scored.select("doc_id", toxicity.held_out("doc_id", 5, 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


#: A-Z and their small letters, for ``translate``.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAF_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaf, subroot, root and proof of every document, and the root that a tampered leaf folds to."""
    docs = _table(spark, sf_dir, "documents").select(LEAF_FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = merkle.leaf([*[F.col(c) for c in LEAF_FIELDS[:-1]], F.translate("text", UPPER, LOWER)])
    rows = merkle.leaves(docs, LEAF_FIELDS, "source", "doc_id", {"tampered": F.when(chosen, tampered)})
    found = merkle.manifest(rows).withColumn("folded", merkle.folded(F.coalesce("tampered", "digest"), F.col("path")))
    return found.select(
        F.col("id").alias("doc_id"), merkle.hex_text(F.col("digest")).alias("leaf"), merkle.hex_text(F.col("subroot")).alias("subroot"),
        merkle.hex_text(F.col("root")).alias("root"), merkle.hex_text(merkle.proof_digest(F.col("path"))).alias("proof_sha256"),
        merkle.hex_text(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def _repeat_tail(doc_id: Column, text: Column) -> Column:
    """The texts of one id in ten repeat the words from one word on with a period, both given by the id's crc32."""
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    n, g = F.greatest(F.size(words), F.lit(1)), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    changed = F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(block), F.lit(1), n - a))
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), F.array_join(changed, " ")).otherwise(text)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every text, one in ten of which repeats its tail, and the texts without the repeats."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", _repeat_tail(F.col("doc_id"), F.col("text")).alias("text"))
    found = runs.find_runs(docs).drop("text").withColumn("best", runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reproducible shuffle of all documents into 16 shards whose counts differ by at most one (law ``rows``)."""
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", sharding.byte_size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("text").isNotNull().alias("has_text"), F.unhex(F.sha2(text, 256)).alias("sha"))
    placed = sharding.assign(docs, ["doc_id", "has_text", "sha"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row")


def llm_queries() -> dict:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_html_text": op3_html_text,
        "op5_url_filter": op5_url_filter,
        "op4_pii_spans": op4_pii_spans,
        "op6_suffix_tree": op6_suffix_tree,
        "op7_quality": op7_quality,
        "op8_winnowing": op8_winnowing,
        "op9_toxicity": op9_toxicity,
        "op10_byte_bpe": op10_byte_bpe,
        "op11_merkle": op11_merkle,
        "op12_runs": op12_runs,
        "op13_sharding": op13_sharding,
    }


def llm_oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": OP1_SQL, "op11_merkle": OP11_SQL, "op13_sharding": OP13_SQL}
