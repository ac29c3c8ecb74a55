"""Fitted models and their records, kept side by side in one folder."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.schema import SEED, TRAIN_SHARE, VAL_SHARE

# Names and format of the record.
VERSION_PREFIX = "engine_rul_prediction_"
MODEL_NAMES = {"Ridge": "RidgeRegression", "RandomForest": "RandomForestRegressor"}
# The forest wins a tie.
PREFERENCE = ("RandomForest", "Ridge")
_SCORES = "struct<MAE: double, RMSE: double, R2: double>"
_MODEL = f"struct<Val: {_SCORES}, Test: {_SCORES}>"
RECORD_SCHEMA = (
    "model_name string, model_version string, train_date string, "
    f"metrics struct<Ridge: {_MODEL}, RandomForest: {_MODEL}, "
    "Selected: struct<Model: string, Val_R2: double, Test_R2: double>>, "
    "features_used array<string>, train_size bigint, val_size bigint, test_size bigint, random_seed int, "
    "split_shares array<double>"
)


def version_name(when: datetime) -> str:
    return f"{VERSION_PREFIX}{when:%Y-%m-%d}"


def build_record(
    metrics: DataFrame,
    sizes: DataFrame,
    features: Sequence[str],
    when: datetime,
    *,
    seed: int = SEED,
    shares: Sequence[float] = (TRAIN_SHARE, VAL_SHARE),
    names: Mapping[str, str] = MODEL_NAMES,
) -> DataFrame:
    """One nested row. ``metrics``: model, split, mae, rmse, r2; ``sizes``: split, n_rows.

    ``seed`` and ``shares`` are those of the split, so that whoever scores later can tell its test units.
    A model without metrics is not chosen.
    """
    scores = F.struct(F.col("mae").alias("MAE"), F.col("rmse").alias("RMSE"), F.col("r2").alias("R2"))

    def held_out(model: str, split: str) -> Column:
        here = (F.col("model") == model) & (F.col("split") == split)
        return F.max(F.when(here, scores)).alias(split.capitalize())

    def size(split: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col("n_rows"))).alias(f"{split}_size")

    table = metrics.agg(*[F.struct(held_out(m, "val"), held_out(m, "test")).alias(m) for m in ("Ridge", "RandomForest")])
    counts = sizes.agg(F.struct(size("train"), size("val"), size("test")))
    first, second = PREFERENCE
    chosen = F.col(f"{first}.Val.R2") >= F.col(f"{second}.Val.R2")
    name = F.when(chosen, names[first]).otherwise(names[second]).alias("Model")

    def r2(split: str) -> Column:
        value = F.when(chosen, F.col(f"{first}.{split}.R2")).otherwise(F.col(f"{second}.{split}.R2"))
        return value.alias(f"{split}_R2")

    return table.withColumn("sizes", counts.scalar()).select(
        name.alias("model_name"),
        F.lit(version_name(when)).alias("model_version"),
        F.lit(f"{when:%Y-%m-%d %H:%M:%S}").alias("train_date"),
        F.struct("Ridge", "RandomForest", F.struct(name, r2("Val"), r2("Test")).alias("Selected")).alias("metrics"),
        F.array(*[F.lit(c) for c in features]).alias("features_used"),
        "sizes.train_size",
        "sizes.val_size",
        "sizes.test_size",
        F.lit(seed).alias("random_seed"),
        F.array(*[F.lit(float(x)) for x in shares]).alias("split_shares"),
    )


def save(model: PipelineModel, record: DataFrame, bank: str) -> str:
    """Write the model and its record under the record's version; returns the version."""
    row = record.select("model_version").first()
    model.write().overwrite().save(posixpath.join(bank, row["model_version"]))
    record.coalesce(1).write.mode("overwrite").json(posixpath.join(bank, f"{row['model_version']}_meta.json"))
    return row["model_version"]


def records(spark: SparkSession, bank: str) -> DataFrame:
    try:
        return spark.read.schema(RECORD_SCHEMA).json(posixpath.join(bank, "*_meta.json"), multiLine=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no model record in {bank}") from error


def latest(spark: SparkSession, bank: str) -> DataFrame:
    """The record with the highest version, the later training date first."""
    return records(spark, bank).orderBy(F.desc("model_version"), F.desc("train_date")).limit(1)


def load(bank: str, version: str) -> PipelineModel:
    return PipelineModel.load(posixpath.join(bank, version))
