"""Z-score standardisation with reusable mean/std metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearcurve.schema import feature_columns


_FLOAT_LIMIT = 1e38


def fit_metadata(
    df: DataFrame, features: Sequence[str] | None = None, fit_on: Column | None = None
) -> DataFrame:
    """``feature, mean, std``, one row per feature, from one pass.

    Population deviation. A column that does not vary gets its value and 1, so it scales to exactly 0;
    merged partial deviations of such a column are only nearly 0, hence the look at its range.
    ``fit_on`` restricts the rows, for example to training units; by default all rows count.

    Features are stacked before they are aggregated: all accumulators of all features in one row would
    be too wide for generated code, while the stacked form leaves each task with one row per feature.

    Values are summed in two parts, rounded to float and the rest. Sums of the first are exact in double
    and the second are tiny, so the mean does not depend on the order of the rows. That matters where
    the deviation is small beside the mean.
    """
    features = list(features or feature_columns(df))
    rows = df if fit_on is None else df.filter(fit_on)
    stacked = rows.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in features])).alias("at", "x"))
    coarse = F.when(F.abs("x") < _FLOAT_LIMIT, F.col("x").cast("float").cast("double")).otherwise(F.col("x"))
    fixed = F.col("lowest") == F.col("highest")
    return (
        stacked.withColumn("coarse", coarse)
        .groupBy("at")
        .agg(
            ((F.sum("coarse") + F.sum(F.col("x") - F.col("coarse"))) / F.nullif(F.count("x"), F.lit(0))).alias("mean"),
            F.stddev_pop("x").alias("std"),
            F.min("x").alias("lowest"),
            F.max("x").alias("highest"),
        )
        .select(
            F.element_at(F.array(*[F.lit(c) for c in features]), F.col("at") + 1).alias("feature"),
            F.when(fixed, F.col("lowest")).otherwise(F.col("mean")).alias("mean"),
            F.when(fixed, 1.0).otherwise(F.col("std")).alias("std"),
        )
    )


def _stats_struct(metadata: DataFrame, features: Sequence[str]) -> DataFrame:
    """Metadata -> one struct with the fields ``m0, s0, m1, s1, ...`` in the order of ``features``.

    A feature without metadata is an error that names it, raised when the statistics are read.
    """
    entry = {c: F.try_element_at("by_name", F.lit(c)) for c in features}
    fields = [
        field
        for i, c in enumerate(features)
        for field in (entry[c]["mean"].alias(f"m{i}"), entry[c]["std"].alias(f"s{i}"))
    ]
    by_name = F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "std"))))
    absent = F.array_except(F.array(*[F.lit(c) for c in features]), F.map_keys("found"))
    message = F.concat(F.lit("metadata lacks the features "), F.array_join(absent, ", "))
    checked = F.when(F.size(absent) > 0, F.raise_error(message)).otherwise(F.col("found")).alias("by_name")
    return metadata.agg(by_name.alias("found")).select(checked).select(F.struct(*fields))


def apply_metadata(df: DataFrame, metadata: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """``(x - mean) / std`` with fitted or saved metadata.

    The statistics are a scalar subquery: computed once, then a constant in every task. They are plain
    struct fields, since array access would make the generated method too long for the JIT compiler.
    """
    features = list(features or feature_columns(df))
    place = {c: i for i, c in enumerate(features)}
    row = df.withColumn("_stats", _stats_struct(metadata, features).scalar())
    stats = F.col("_stats")
    return row.select(
        *[
            ((F.col(c) - stats[f"m{place[c]}"]) / stats[f"s{place[c]}"]).alias(c) if c in place else F.col(c)
            for c in df.columns
        ]
    )


def standardize(df: DataFrame, fit_on: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Scaled rows and their metadata."""
    features = feature_columns(df)
    metadata = fit_metadata(df, features, fit_on)
    return apply_metadata(df, metadata, features), metadata


def fill_missing(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Missing scaled readings become 0, the fleet mean. Keeps every row usable by a regressor."""
    place = set(features)
    return df.select(*[F.coalesce(c, F.lit(0.0)).alias(c) if c in place else F.col(c) for c in df.columns])
