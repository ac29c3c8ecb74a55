"""Split, tune, compare, choose and store."""

from __future__ import annotations

import posixpath
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.models import forest, registry, ridge
from wearcurve.operators.metrics import evaluate, select_model, stack_predictions
from wearcurve.operators.split import assign_folds, assign_split, split_sizes
from wearcurve.schema import KEYS, LABEL, SEED, TRAIN_SHARE, VAL_SHARE, feature_columns, require_columns
from wearcurve.sources.sinks import shared_dir, write_parquet


@dataclass(frozen=True)
class Prepared:
    """Rows with ``split``, and the training rows with ``fold``, both read from one written table; how they were split."""

    rows: DataFrame
    train: DataFrame
    features: list[str]
    seed: int = SEED
    shares: tuple[float, float] = (TRAIN_SHARE, VAL_SHARE)


def prepare(
    spark: SparkSession,
    gold: DataFrame,
    *,
    seed: int = SEED,
    shares: tuple[float, float] = (TRAIN_SHARE, VAL_SHARE),
    folds: int = ridge.FOLDS,
    path: str | None = None,
) -> Prepared:
    """Training reads its rows many times, so split and folds are settled once and written.

    The table is written once and partitioned by split: reading one split prunes the others. Cut points of the folds come
    from the keys alone.
    """
    require_columns(gold, (*KEYS, LABEL), "gold")
    path = path or shared_dir(spark, "training")
    features = feature_columns(gold)
    rows_path = posixpath.join(path, "rows")
    is_train = F.col("split") == "train"
    folded = assign_folds(assign_split(gold, seed=seed, shares=shares), folds, among=is_train)
    folded.write.mode("overwrite").partitionBy("split").parquet(rows_path)
    rows = spark.read.parquet(rows_path)
    own = [c for c in rows.columns if c not in ("split", "fold")]
    return Prepared(rows.drop("fold"), rows.filter(is_train).select(*own, "split", "fold"), features, seed, shares)


def predict(model: PipelineModel, df: DataFrame, name: str = "RUL_pred") -> DataFrame:
    """Add one prediction column; the assembled vector does not stay."""
    return model.transform(df).withColumnRenamed("prediction", name).drop(ridge.VECTOR)


def compare(rows: DataFrame, models: Mapping[str, PipelineModel], *, label: str = LABEL) -> DataFrame:
    """``model, split, mae, rmse, r2`` on the held-out splits, all models in one pass."""
    scored = rows.filter(F.col("split").isin("val", "test"))
    for name, model in models.items():
        scored = predict(model, scored, f"_{name}")
    stacked = stack_predictions(scored, {name: f"_{name}" for name in models}, target=label, keep=("split",))
    return evaluate(stacked, target=label)


@dataclass(frozen=True)
class Trained:
    ridge: ridge.RidgeSearch
    forest: forest.ForestSearch
    metrics: DataFrame
    selected: DataFrame
    record: DataFrame
    version: str | None
    model: PipelineModel


def train(
    spark: SparkSession,
    gold: DataFrame,
    *,
    bank: str | None = None,
    alphas: Sequence[float] = ridge.ALPHAS,
    forest_grid: Mapping[str, Sequence] = forest.FOREST_GRID,
    seed: int = SEED,
    when: datetime | None = None,
    prepared: Prepared | None = None,
    by_forest: forest.ForestSearch | None = None,
) -> Trained:
    """Both grids, held-out metrics, the choice and its record; stored when ``bank`` is given.

    Rows that are already ``prepared`` bring their own seed. A search of the forest's grid on these rows may be given.
    """
    prepared = prepared or prepare(spark, gold, seed=seed)
    by_ridge = ridge.search(prepared.train, prepared.features, alphas)
    by_forest = by_forest or forest.search(prepared.train, prepared.features, forest_grid, seed=prepared.seed)
    models = {"Ridge": by_ridge.model, "RandomForest": by_forest.model}
    # Two models on two splits: four rows, held so that choosing and recording do not score again.
    metrics = write_parquet(compare(prepared.rows, models), shared_dir(spark, "metrics"))
    record = registry.build_record(
        metrics, split_sizes(prepared.rows), prepared.features, when or datetime.now(),
        seed=prepared.seed, shares=prepared.shares,
    )
    selected = select_model(metrics, registry.PREFERENCE)
    model = models[selected.first()["model"]]
    version = registry.save(model, record, bank) if bank is not None else None
    return Trained(by_ridge, by_forest, metrics, selected, record, version, model)
