"""Score a fleet drawn with replacement from the test units, with the latest stored model."""

from __future__ import annotations

import posixpath
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.models import registry
from wearcurve.operators.metrics import evaluate
from wearcurve.operators.split import bootstrap
from wearcurve.plans.training import predict
from wearcurve.schema import LABEL, OOT_UNITS
from wearcurve.sources.sinks import write_parquet


@dataclass(frozen=True)
class Scored:
    predictions: DataFrame
    metrics: DataFrame
    model_name: str


def score_fleet(
    spark: SparkSession, rows: DataFrame, bank: str, *, n: int = OOT_UNITS, out: str | None = None
) -> Scored:
    """Predictions per drawn unit and cycle, and their quality. With ``out`` they are written.

    The record's seed and shares say which units the model was tested on; no other unit is drawn.
    """
    record = registry.latest(spark, bank).first()
    model = registry.load(bank, record["model_version"])
    fleet = bootstrap(rows, n, seed=record["random_seed"], test_from=record["split_shares"][1])
    predictions = predict(model, fleet).select("cycle", *record["features_used"], LABEL, "unit", "RUL_pred")
    name = record["model_name"]
    if out is not None:
        ordered = predictions.sortWithinPartitions("unit", "cycle")
        predictions = write_parquet(ordered, posixpath.join(out, f"oot_predictions_{name.lower()}.parquet"))
    scored = predictions.select(
        F.lit(name).alias("model"), F.lit("oot").alias("split"), LABEL, F.col("RUL_pred").alias("prediction")
    )
    return Scored(predictions, evaluate(scored), name)
