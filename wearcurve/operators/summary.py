"""One small row per unit, kept beside a layer and read in place of its panel.

A row covers one block of a unit's cycles, so a unit that holds a third of all rows is a few rows more and never one
task's work. Rows merge by sum, least and greatest: summaries of parts add up to that of the whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from wearcurve.operators.positions import DIGIT_BITS
from wearcurve.operators.quality import integrity
from wearcurve.schema import EXPECTED_UNITS
from wearcurve.sources.sinks import write_parquet

# Column of the rows behind a row of a summary.
ROWS = "n_rows"


def unit_summary(df: DataFrame, *, by: Sequence[str] = (), unit: str = "unit", cycle: str = "cycle") -> DataFrame:
    """``*by, unit, block, n_rows, first_cycle, last_cycle``: one row per unit and block of 2**16 cycles, one pass.

    Rows without a unit or a cycle are counted in a row of their own.
    """
    block = F.shiftright(cycle, DIGIT_BITS).alias("block")
    return df.groupBy(*by, unit, block).agg(
        F.count(F.lit(1)).alias(ROWS), F.min(cycle).alias("first_cycle"), F.max(cycle).alias("last_cycle")
    )


def merge_summaries(parts: Sequence[DataFrame], *, by: Sequence[str] = (), unit: str = "unit") -> DataFrame:
    """The summary of all rows behind ``parts``, without reading those rows."""
    if not parts:
        raise ValueError("no summary to merge")
    return reduce(DataFrame.unionByName, parts).groupBy(*by, unit, "block").agg(
        F.sum(ROWS).alias(ROWS), F.min("first_cycle").alias("first_cycle"), F.max("last_cycle").alias("last_cycle")
    )


@dataclass(frozen=True)
class Keys:
    """Rows of a table, and the sum of their keys' hashes: equal for tables that hold the same keys."""

    n_rows: int
    digest: Decimal


def write_counted(df: DataFrame, path: str, *, unit: str = "unit", cycle: str = "cycle") -> tuple[DataFrame, Keys]:
    """``write_parquet``, and the keys of what was written, gathered by the writing tasks: no second scan."""
    seen = Observation()
    digest = F.sum(F.xxhash64(unit, cycle).cast("decimal(20,0)"))
    written = write_parquet(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), digest.alias("digest")), path)
    found = seen.get
    return written, Keys(found.get("n_rows") or 0, found.get("digest") or Decimal(0))


def layer_integrity(
    layers: Mapping[str, tuple[DataFrame, Keys]], summary: DataFrame, keys: Keys, expected_units: int | None = EXPECTED_UNITS
) -> DataFrame:
    """``integrity`` of each layer. Where a write job saw the ``keys`` that ``summary`` covers, its units come from there;
    only a layer with other keys is read again."""
    fleet = integrity(summary, expected_units, rows=ROWS)
    reports = [
        (fleet if seen == keys else integrity(df, expected_units)).select(F.lit(name).alias("layer"), "*")
        for name, (df, seen) in layers.items()
    ]
    return reduce(DataFrame.unionByName, reports)
