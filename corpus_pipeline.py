"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's docs. All but the last return the columns they got, in order, extra columns included:

1. ``toxicity``: documents whose toxicity score is 0.5 or more go; the classifier learns from the labels
   outside the held-out fold.
2. ``jaccard``: of each class of documents linked by five-word shingles at a similarity of 0.8, one stays
   (the smallest id).
3. ``decontaminate``: documents with an occurrence of a ten-word benchmark window go.
4. ``pii``: personal data and secrets in the texts are masked; ``n_chars`` follows the new text.
5. ``byte_bpe``: the texts become token ids (little-endian unsigned 32-bit integers), with a check that they
   decode to the text.

Defined results: null and empty texts pass every stage (no words, no personal data, no tokens) unless the
classifier rejects the empty text; null ids are kept; repeated rows are near-duplicates of each other;
an empty table gives an empty table; columns named like a stage's own are kept apart from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm import byte_bpe, decontaminate, jaccard_join, pii, toxicity
from churnlens.llm.common import quoted, stored, text_hash
from churnlens.session import ensure_checkpoint_dir, ship_package


def _prepare(spark: SparkSession) -> None:
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out("doc_id", 5, 0))
    scored = toxicity.score(docs, toxicity.train(docs, labels), out="toxicity score")
    return scored.where(F.col("`toxicity score`") < 0.5).select([quoted(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    return jaccard_join.keep_one(docs).select([quoted(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hits = decontaminate.find_hits(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias("hit id"), F.col("text_hash").alias("hit hash")).distinct()
    hits = stored(hits.toDF("hit_id", "hit_hash"), "contaminated").toDF("hit id", "hit hash")
    same = F.col("`hit id`").eqNullSafe(quoted("doc_id")) & (F.col("`hit hash`") == text_hash(quoted("text")))
    return docs.join(hits, same, "left_anti").select([quoted(c) for c in docs.columns])


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                                   .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return masked.select([quoted(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepare(spark)
    ranks, pattern = byte_bpe.public_vocabulary()
    coded = byte_bpe.decode(byte_bpe.encode(docs.select("doc_id", "text", "lang", "source"), ranks, pattern), ranks)
    return coded.select("doc_id", "lang", "source", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("pii", mask_personal_data),
    ("byte_bpe", encode),
]

#: SQL can't express the classifier, so the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
