"""Tables and fitted models that several registered queries start from, made once per application."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from wearcurve.catalog.panels import flagged_panel, panel_lines, silver_panel, source_lines, split_sources
from wearcurve.models import forest
from wearcurve.models.forest import FOREST_GRID, ForestSearch
from wearcurve.models.ridge import RidgeSearch, search
from wearcurve.operators.normalize import fill_missing
from wearcurve.operators.summary import unit_summary
from wearcurve.plans.medallion import Gold, build_gold, clean
from wearcurve.plans.training import Prepared, Trained, prepare, train
from wearcurve.schema import feature_columns
from wearcurve.sources.sinks import shared_dir, write_parquet

# The first point of the library's grid, for a single fit.
FOREST_POINT = {name: values[:1] for name, values in FOREST_GRID.items()}
TRIAL_DATE = datetime(2025, 1, 1)

_made: dict[tuple, Any] = {}


def once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], Any]) -> Any:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def staged(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table written to the shared folder on first use, like the layer files gold reads."""

    def write() -> str:
        path = shared_dir(spark, name) + ".parquet"
        write_parquet(build(), path)
        return path

    return spark.read.parquet(once(spark, sf_dir, name, write))


def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "cleaned", lambda: clean(silver_panel(spark, sf_dir)))


def cleaned_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir, "cleaned_summary", lambda: unit_summary(cleaned_table(spark, sf_dir)))


def gold(spark: SparkSession, sf_dir: str) -> Gold:
    """Gold as it is scaled from its one written table, and not written again."""
    return once(spark, sf_dir, "gold", lambda: build_gold(spark, cleaned_table(spark, sf_dir)))


def gold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(spark, sf_dir).full


def source_panels(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The three datasets of a panel that is numbered and written once."""
    return split_sources(staged(spark, sf_dir, "flagged", lambda: flagged_panel(spark, sf_dir)))


def raw_path(spark: SparkSession, sf_dir: str) -> str:
    def write() -> str:
        path = shared_dir(spark, "raw") + ".txt"
        # A part of a log is one task's output and one task's input again, so it need not be split.
        panel_lines(spark, sf_dir).write.mode("overwrite").text(path, compression="gzip")
        return path

    return once(spark, sf_dir, "raw", write)


def raw_paths(spark: SparkSession, sf_dir: str) -> list[str]:
    """Three raw logs whose unit ids collide."""

    def write() -> list[str]:
        root = shared_dir(spark, "raws")
        paths = [f"{root}/train_{i}.txt" for i in (1, 2, 3)]
        for lines, path in zip(source_lines(source_panels(spark, sf_dir)), paths):
            lines.write.mode("overwrite").text(path, compression="gzip")
        return paths

    return once(spark, sf_dir, "raws", write)


def prepared(spark: SparkSession, sf_dir: str) -> Prepared:
    """Scaled rows with missing readings at the fleet mean, so that no row is lost to a regressor."""

    def make() -> Prepared:
        full = gold_table(spark, sf_dir)
        return prepare(spark, fill_missing(full, feature_columns(full)))

    return once(spark, sf_dir, "prepared", make)


def tuned(spark: SparkSession, sf_dir: str) -> RidgeSearch:
    """The ridge under the best penalty of its grid."""

    def make() -> RidgeSearch:
        ready = prepared(spark, sf_dir)
        return search(ready.train, ready.features)

    return once(spark, sf_dir, "tuned", make)


def forest_search(spark: SparkSession, sf_dir: str) -> ForestSearch:
    """All points of the forest's grid, each on all rows, and the forest of the best one."""

    def make() -> ForestSearch:
        ready = prepared(spark, sf_dir)
        return forest.search(ready.train, ready.features, seed=ready.seed)

    return once(spark, sf_dir, "forest-grid", make)


def trained(spark: SparkSession, sf_dir: str) -> tuple[Trained, str]:
    """One training run over both whole grids, and the folder its model is stored in."""

    def make() -> tuple[Trained, str]:
        bank = shared_dir(spark, "models")
        ready = prepared(spark, sf_dir)
        run = train(spark, ready.rows, bank=bank, when=TRIAL_DATE, prepared=ready, by_forest=forest_search(spark, sf_dir))
        return run, bank

    return once(spark, sf_dir, "trained", make)
