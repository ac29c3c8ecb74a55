"""Raw logs -> bronze -> silver -> gold."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.operators import stores
from wearcurve.operators.conform import cast_columns, drop_constant, drop_correlated, shared_units, shift_units, source_offsets
from wearcurve.operators.features import ROW_FEATURES, engineer, row_columns
from wearcurve.operators.normalize import apply_metadata, fit_metadata
from wearcurve.operators.positions import bounded
from wearcurve.operators.quality import duplicate_keys, integrity
from wearcurve.operators.split import assign_split
from wearcurve.operators.summary import ROWS, Keys, layer_integrity, unit_summary, write_counted
from wearcurve.schema import EXPECTED_UNITS, RAW_FIELDS, SEED, feature_columns
from wearcurve.sources.sinks import base_name, shared_dir, write_csv, write_parquet
from wearcurve.sources.tables import load
from wearcurve.sources.text_log import datasets, read_raws

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
    ]
)


def clean(silver: DataFrame) -> DataFrame:
    return drop_correlated(drop_constant(silver)).drop("source")


@dataclass(frozen=True)
class Gold:
    full: DataFrame
    features: DataFrame
    labels: DataFrame
    metadata: DataFrame
    keys: Keys
    #: Rows before scaling, without what follows from the row itself; ``scaled`` adds that and scales.
    narrow: DataFrame
    scaled: Callable[[DataFrame], DataFrame]


def build_gold(
    spark: SparkSession,
    source: str | DataFrame,
    out: str | None = None,
    *,
    fit_on: Column | str | None = None,
    seed: int = SEED,
    include_lifecycle: bool = True,
    **blocks,
) -> Gold:
    """Gold table, feature store, label store and normalisation metadata.

    The unscaled features are written first: statistics and scaling both need them, and this way the
    panel is shuffled and sorted once, and the four outputs are plain scans of that table. That job runs
    here in any case: the table goes to ``out`` or, without one, to the shared folder, where ``release``
    finds it, and only the outputs are then left lazy. In the shared folder it holds no ratios and lifecycle features, which
    are computed where it is read.

    ``fit_on`` restricts the rows behind the statistics: a condition, or the name of a split such as
    ``"train"``, drawn with ``seed`` as training draws it. By default they come from all rows, held-out units included.
    """
    staging = out or shared_dir(spark, "gold")
    engineered = engineer(load(spark, source), include_lifecycle=include_lifecycle, **blocks)
    columns = engineered.columns

    def widened(narrow: DataFrame) -> DataFrame:
        return narrow.select("*", *row_columns(narrow)).select(*columns)

    kept = engineered if out else engineered.drop(*ROW_FEATURES)
    panel, keys = write_counted(kept, posixpath.join(staging, "engineered.parquet"))
    narrow = panel.drop(*ROW_FEATURES)
    panel = panel if out else widened(panel)
    features = feature_columns(panel)
    fitted = assign_split(panel, seed=seed) if isinstance(fit_on, str) else panel
    metadata = fit_metadata(fitted, features, F.col("split") == fit_on if isinstance(fit_on, str) else fit_on)

    def scaled(narrow: DataFrame) -> DataFrame:
        return apply_metadata(widened(narrow), metadata, features)

    if out is None:
        full = scaled(narrow)
        return Gold(full, stores.feature_store(full), stores.label_store(full), metadata, keys, narrow, scaled)

    metadata_path = posixpath.join(out, "feature_metadata.csv")
    in_order = F.array_position(F.array(*[F.lit(c) for c in features]), F.col("feature"))
    # One row per feature, so one sorted file.
    write_csv(metadata.orderBy(in_order), metadata_path, single_file=True)
    metadata = spark.read.schema(METADATA_SCHEMA).option("header", True).csv(metadata_path)
    full, keys = write_counted(apply_metadata(panel, metadata, features), posixpath.join(out, "gold_full.parquet"))
    return Gold(
        full,
        write_parquet(stores.feature_store(full), posixpath.join(out, "feature_store.parquet")),
        write_parquet(stores.label_store(full), posixpath.join(out, "label_store.parquet")),
        metadata,
        keys,
        narrow,
        scaled,
    )


def _bronze_names(paths: Sequence[str]) -> list[str]:
    names = [f"bronze_{base_name(p)}" for p in paths]
    if len(set(names)) < len(names):
        raise ValueError(f"raw files share a base name: {sorted(names)}")
    return names


def run(
    spark: SparkSession,
    raw_paths: Sequence[str],
    out: str | None = None,
    *,
    offset_by: str = "count",
    expected_units: int | None = EXPECTED_UNITS,
    fit_on: Column | str | None = None,
    seed: int = SEED,
    include_lifecycle: bool = True,
    single_file: bool = False,
    compression: str | None = None,
) -> dict[str, DataFrame]:
    """Every layer as a DataFrame, by name. With ``out`` each layer is written and the next reads it.

    A path is a file or a folder, one dataset each; a pattern stands for all it matches. All raw files are one scan, one
    parser and one write, whatever their number; ``source`` numbers the datasets in the order given. Bronze has a folder
    ``dataset=bronze_<file name>`` for each, its files under ``compression``. Without ``out`` the parsed rows and silver are
    still written, to the shared folder, so that text is parsed once.

    Bronze is read once for a row per unit (``summary/bronze.parquet``); id offsets, silver's own summary and the reports
    come from it and from what the write jobs counted. Silver short of bronze's rows is an error.
    """
    if not raw_paths:
        raise ValueError("no raw file given")
    _bronze_names(raw_paths)
    raw_paths = datasets(spark, raw_paths)
    names = _bronze_names(raw_paths)
    parsed = read_raws(spark, raw_paths)
    bronze = parsed.rows
    listed = spark.createDataFrame(list(zip(names, range(1, len(names) + 1), raw_paths)), "dataset string, source int, path string")
    listed = bounded(listed, len(names))
    if out is not None:
        path = posixpath.join(out, "bronze")
        named = bronze.join(listed.drop("path"), "source").drop("source")
        write_csv(named, path, single_file=single_file, by=("dataset",), compression=compression)
        text = ", ".join(f"{c} string" for c in RAW_FIELDS)
        bronze = spark.read.schema(f"{text}, dataset string").option("header", True).csv(path)
        bronze = bronze.join(listed.drop("path"), "dataset").drop("dataset")
    root = out or shared_dir(spark, "layers")
    if out is None:
        bronze = write_parquet(bronze, posixpath.join(root, "bronze.parquet"))
    typed = cast_columns(bronze)
    per_unit = write_parquet(unit_summary(typed, by=("source",)), posixpath.join(root, "summary", "bronze.parquet"))
    offsets = source_offsets(per_unit, offset_by=offset_by)
    silver = shift_units(typed, offsets=offsets, n_sources=len(names))
    silver_path = posixpath.join(root, "silver")
    silver, keys = write_counted(
        silver.select(*RAW_FIELDS, "source"), posixpath.join(silver_path, "silver_feature.parquet")
    )
    of_silver = write_parquet(
        shift_units(per_unit, offsets=offsets, n_sources=len(names)), posixpath.join(root, "summary", "silver.parquet")
    )
    n_bronze = per_unit.agg(F.coalesce(F.sum(ROWS), F.lit(0))).first()[0]
    if keys.n_rows != n_bronze:
        raise ValueError(f"silver holds {keys.n_rows} of the {n_bronze} rows of bronze")
    cleaned, cleaned_keys = clean(silver), keys
    if out is not None:
        cleaned, cleaned_keys = write_counted(cleaned, posixpath.join(silver_path, "silver_feature_cleaned.parquet"))
    gold = build_gold(
        spark, cleaned, posixpath.join(out, "gold") if out else None,
        fit_on=fit_on, seed=seed, include_lifecycle=include_lifecycle,
    )
    bronze_rows = bronze.select(*RAW_FIELDS)
    rejects = parsed.rejects.join(listed.drop("dataset"), "source").select("path", "value", "reason")
    layers = {"silver": (silver, keys), "cleaned": (cleaned, cleaned_keys), "gold": (gold.full, gold.keys)}
    first = integrity(per_unit, expected_units, rows=ROWS).select(F.lit("bronze").alias("layer"), "*")
    return {
        "bronze": bronze_rows,
        "rejects": rejects,
        "silver": silver,
        "cleaned": cleaned,
        "gold": gold.full,
        "feature_store": gold.features,
        "label_store": gold.labels,
        "feature_metadata": gold.metadata,
        "integrity": first.unionByName(layer_integrity(layers, of_silver, keys, expected_units)),
        "unit_summary": of_silver,
        "duplicate_keys": duplicate_keys(silver),
        "shared_units": shared_units(of_silver),
    }
