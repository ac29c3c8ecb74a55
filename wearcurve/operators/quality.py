"""Counts that follow the data through the layers. Each report is one aggregate per input.

An input is a panel, or a summary of one; then ``rows`` names its column of the rows behind each row.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.schema import EXPECTED_UNITS, KEYS


def _n_rows(rows: str | None) -> Column:
    return (F.coalesce(F.sum(rows), F.lit(0).cast("bigint")) if rows else F.count(F.lit(1))).alias("n_rows")


def integrity(
    df: DataFrame, expected_units: int | None = EXPECTED_UNITS, *, unit: str = "unit", rows: str | None = None
) -> DataFrame:
    """Rows, units and whether the fleet size differs from the expected one."""
    expected = F.lit(expected_units).cast("bigint")
    return (
        df.agg(_n_rows(rows), F.count_distinct(unit).alias("n_units"))
        .withColumn("warning", F.coalesce(F.col("n_units") != expected, F.lit(False)))
    )


def integrity_by_layer(layers: Mapping[str, DataFrame], expected_units: int | None = EXPECTED_UNITS) -> DataFrame:
    reports = [integrity(df, expected_units).select(F.lit(name).alias("layer"), "*") for name, df in layers.items()]
    return reduce(DataFrame.unionByName, reports)


def raw_stats(df: DataFrame, *, unit: str = "unit", rows: str | None = None) -> DataFrame:
    return df.agg(
        _n_rows(rows),
        F.count_distinct(unit).alias("n_units"),
        F.min(unit).alias("min_unit"),
        F.max(unit).alias("max_unit"),
    )


def source_stats(df: DataFrame, *, unit: str = "unit", rows: str | None = None) -> DataFrame:
    return df.groupBy("source").agg(_n_rows(rows), F.count_distinct(unit).alias("n_units"))


def duplicate_keys(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Keys that occur more than once. Ordered features need none."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
