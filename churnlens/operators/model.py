"""The churn model surface (U1-U8, U13-U15) on Spark ML.

One ``Pipeline``: a ``StringIndexer`` per categorical (alphabetical order, unseen ->
extra index), a ``VectorAssembler`` over the 33 inputs, and a ``GBTClassifier``.
Training, scoring and evaluation all stay in executors; the driver only holds the
fitted trees.  Predictions are produced beside the id and label in one plan (U3), so
nothing is ever paired by row position (D14).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import ts_lit
from ..session import path_exists, scratch_path
from ..sources.io import write_and_read
from .evaluate import classification_metrics
from .features import CATEGORICAL_FEATURES, KEY, NUMERIC_FEATURES

LABEL = "churned"
MODEL_NAME = "CHURN_MODEL"


@dataclass(frozen=True)
class GBTParams:
    """Reference defaults: 100 trees, depth 6, learning rate 0.1."""
    n_estimators: int = 100
    max_depth: int = 6
    learning_rate: float = 0.1
    seed: int = 42
    max_bins: int = 32

    @property
    def run_name(self) -> str:
        return f"gbt_n{self.n_estimators}_d{self.max_depth}_lr{self.learning_rate:g}"


def indexed_name(c: str) -> str:
    return f"{c}_idx"


def feature_columns() -> list[str]:
    """Assembler inputs: 30 numeric columns then the 3 indexed categoricals."""
    return list(NUMERIC_FEATURES) + [indexed_name(c) for c in CATEGORICAL_FEATURES]


def label_encoders() -> list[StringIndexer]:
    """One ordinal encoder per categorical, alphabetical, unseen values -> the extra index."""
    return [StringIndexer(inputCol=c, outputCol=indexed_name(c), stringOrderType="alphabetAsc",
                          handleInvalid="keep") for c in CATEGORICAL_FEATURES]


def boosted_trees(params: GBTParams = GBTParams()) -> GBTClassifier:
    return GBTClassifier(labelCol=LABEL, featuresCol="features", maxIter=params.n_estimators, maxDepth=params.max_depth,
                         stepSize=params.learning_rate, seed=params.seed, maxBins=params.max_bins)


def input_stages() -> list:
    """Encoders and assembler: what comes before the trees."""
    return [*label_encoders(), VectorAssembler(inputCols=feature_columns(), outputCol="features", handleInvalid="keep")]


def build_pipeline(params: GBTParams = GBTParams()) -> Pipeline:
    """U4: encoders + assembler + boosted trees as one estimator."""
    return Pipeline(stages=[*input_stages(), boosted_trees(params)])


def model_inputs(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns the pipeline reads, numeric ones as double (decimals included), and the columns to ``keep`` along."""
    return df.select(*keep, KEY, *CATEGORICAL_FEATURES,
                     *[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES],
                     *([F.col(LABEL).cast("double").alias(LABEL)] if LABEL in df.columns else []))


#: Training rows a partition: a boosting step reads all of a partition's rows for every tree and level. Fewer bring nothing;
#: more than a core can take at a time, up to the most that a task should hold in memory, bring less to merge.
TRAIN_ROWS_PER_PARTITION, MOST_ROWS_PER_PARTITION = 20_000, 250_000


def training_input(train: DataFrame) -> DataFrame:
    """Model inputs without NULL rows (D5), spread over ``training_partitions``.

    Boosting runs several small jobs per tree; on a small training set every extra partition
    is pure task overhead, on a large one the partitions keep each task's share bounded and all
    cores busy.  The rows are counted, as sizes of stored or compressed tables say little of the work.
    """
    df = model_inputs(train).dropna()
    return df.repartition(training_partitions(df.count(), train_cores(df.sparkSession)))


def training_partitions(rows: int, cores: int) -> int:
    """Partitions of ``TRAIN_ROWS_PER_PARTITION``, but no more than one a core, or as many a core as
    ``MOST_ROWS_PER_PARTITION`` asks for.

    Each partition gives its own table of all nodes, features and bins to every level's merge, at the cost of reading
    about 30,000 rows, so partitions that wait for a core only add to the work.
    """
    return max(1, min(-(-rows // TRAIN_ROWS_PER_PARTITION), cores * -(-rows // (cores * MOST_ROWS_PER_PARTITION))))


def train_cores(spark: SparkSession) -> int:
    return max(8, spark.sparkContext.defaultParallelism)   # executors may still be joining


@dataclass(frozen=True)
class Prepared:
    """The fitted encoders and assembler, and the training rows as stored (features, label) vectors."""
    stages: PipelineModel
    rows: DataFrame


def prepare(train: DataFrame) -> Prepared:
    """Encode and assemble the training rows once, and store them: any number of fits read them."""
    inputs = training_input(train)
    stages = Pipeline(stages=input_stages()).fit(inputs)
    rows = write_and_read(train.sparkSession, stages.transform(inputs).select("features", LABEL), "training_vectors")
    parts = training_partitions(rows.count(), train_cores(train.sparkSession))   # a scan packs the stored files into fewer
    return Prepared(stages, rows.repartition(parts) if parts > 1 else rows)


def fit(train: DataFrame | Prepared, params: GBTParams = GBTParams()) -> PipelineModel:
    """Training drops rows with any NULL (D5) and fits the pipeline; prepared rows are read as they are stored."""
    prepared = train if isinstance(train, Prepared) else prepare(train)
    return PipelineModel([*prepared.stages.stages, boosted_trees(params).fit(prepared.rows)])


def gbt_stage(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def predict(model: PipelineModel, df: DataFrame, as_of: _dt.datetime | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """U3 + U15: id, label (when present), prediction, probability of class 1, timestamp -- one plan; ``keep`` goes first."""
    scored = model.transform(model_inputs(df, keep))
    cols = [*keep, KEY]
    if LABEL in df.columns:
        cols.append(F.col(LABEL).cast("int").alias("actual_churn"))
    ts = ts_lit(as_of) if as_of else F.current_timestamp()
    return scored.select(*cols, F.col("prediction").cast("int").alias("predicted_churn"),
                         F.round(vector_to_array("probability")[1], 6).alias("churn_probability"),
                         ts.alias("prediction_timestamp"))


def evaluate(model: PipelineModel, df: DataFrame) -> DataFrame:
    """A11 on model predictions."""
    return classification_metrics(predict(model, df))


def gain_importance(model: PipelineModel) -> DataFrame:
    """Split-gain importance per assembler input (normalised by Spark to sum 1)."""
    spark = SparkSession.getActiveSession()
    imp = gbt_stage(model).featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(feature_columns(), imp)]
    return spark.createDataFrame(rows, "feature string, importance double")


# ---------------------------------------------------------------------------
# Model registry as a Parquet table next to the saved pipelines
# ---------------------------------------------------------------------------

def save_version(spark: SparkSession, model: PipelineModel, metrics: dict, params: GBTParams,
                 comment: str = "", default: bool = True, version: str | None = None) -> str:
    """Save the pipeline under the shared folder and register it; returns the version name."""
    version = version or f"V_{_dt.datetime.now(_dt.timezone.utc).strftime('%Y%m%d_%H%M%S')}_{uuid.uuid4().hex[:6]}"
    path = scratch_path(spark, "models", MODEL_NAME.lower(), version)
    model.write().overwrite().save(path)
    register_version(spark, path, version, metrics, params, comment)
    if default:
        set_default(spark, version)
    return version


def register_version(spark: SparkSession, path: str, version: str, metrics: dict, params: GBTParams, comment: str = "") -> None:
    """Append a registry row for a pipeline saved at ``path``. Rows are only ever appended, so readers and other
    writers are never in the way."""
    row = [(MODEL_NAME, version, comment, json.dumps({"metric": metrics, "params": params.__dict__}), "PREDICT", path)]
    new = spark.createDataFrame(row, "model_name string, model_version_name string, comment string, metadata string, "
                                     "functions string, path string")
    new.withColumn("created_on", F.current_timestamp()).write.mode("append").parquet(_registry(spark, "model_versions"))


def set_default(spark: SparkSession, version: str) -> None:
    """The default is the version named last in an append-only table of choices."""
    new = spark.createDataFrame([(MODEL_NAME, version)], "model_name string, model_version_name string")
    new.withColumn("set_on", F.current_timestamp()).write.mode("append").parquet(_registry(spark, "model_defaults"))


def _registry(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "registry", name)


def has_default(spark: SparkSession) -> bool:
    return path_exists(spark, _registry(spark, "model_defaults"))


def versions(spark: SparkSession, model_name: str = MODEL_NAME) -> DataFrame:
    """Versions with their metrics (P18: out of the JSON metadata), newest first, the default flagged."""
    reg = spark.read.parquet(_registry(spark, "model_versions")).where(F.col("model_name") == model_name)
    if has_default(spark):
        chosen = (spark.read.parquet(_registry(spark, "model_defaults")).where(F.col("model_name") == model_name)
                  .agg(F.max_by("model_version_name", "set_on").alias("default_version")))
    else:
        chosen = spark.range(1).select(F.lit(None).cast("string").alias("default_version"))
    return reg.crossJoin(chosen).select(   # one-row side
        "model_name", "model_version_name", "comment", "created_on", "path",
        F.coalesce(F.col("model_version_name") == F.col("default_version"), F.lit(False)).alias("is_default"),
        *[F.get_json_object("metadata", f"$.metric.{m}").cast("double").alias(m)
          for m in ("accuracy", "precision", "recall", "f1_score")]).orderBy(F.desc("created_on"), F.desc("model_version_name"))


def load_version(spark: SparkSession, version: str | None = None) -> PipelineModel:
    """Load a version by name, or the default one."""
    pick = F.col("model_version_name") == version if version else F.col("is_default")
    row = versions(spark).where(pick).select("path").first()
    if row is None:
        raise LookupError(f"no model version {version or '(default)'}")
    return PipelineModel.load(row["path"])
