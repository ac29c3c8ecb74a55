"""Regression quality and model choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.schema import LABEL


def stack_predictions(df: DataFrame, models: Mapping[str, str], *, target: str = LABEL, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row and model: ``model, prediction`` beside the target. ``models``: name -> column."""
    pairs = [
        F.struct(F.lit(name).alias("model"), F.col(c).cast("double").alias("prediction"))
        for name, c in models.items()
    ]
    return df.select(*keep, F.col(target).cast("double").alias(target), F.inline(F.array(*pairs)))


def evaluate(df: DataFrame, by: Sequence[str] = ("model", "split"), *, target: str = LABEL) -> DataFrame:
    """MAE, RMSE and R² per group, in one aggregate.

    Rows without target or prediction do not count in the scores; ``n_skipped`` says how many. R² of a target that does not vary is 1 for a
    perfect prediction and 0 otherwise; of fewer than two rows it is null.
    """
    error = F.col(target) - F.col("prediction")
    known = F.col(target).isNotNull() & F.col("prediction").isNotNull()
    scored = df.withColumn(target, F.when(known, F.col(target)))
    residual, total = F.col("_residual"), F.col("_total")
    r2 = (
        F.when(F.col("n_rows") < 2, None)
        .when(total > 0, 1 - residual / F.nullif(total, F.lit(0.0)))
        .when(residual == 0, 1.0)
        .otherwise(0.0)
    )
    return (
        scored.groupBy(*by)
        .agg(
            F.count(target).alias("n_rows"),
            F.count_if(F.col(target).isNull()).alias("n_skipped"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.sum(error * error).alias("_residual"),
            (F.var_pop(target) * F.count(target)).alias("_total"),
        )
        .withColumn("r2", r2)
        .drop("_residual", "_total")
    )


def select_model(metrics: DataFrame, preference: Sequence[str], *, split: str = "val") -> DataFrame:
    """The model with the best R² on ``split``; on a tie the one named first in ``preference``."""
    rank = F.array_position(F.array(*[F.lit(m) for m in preference]), F.col("model"))
    return (
        metrics.filter(F.col("split") == split)
        .orderBy(F.desc_nulls_last("r2"), rank, "model")
        .limit(1)
    )
