"""Label and engineered features of a panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from wearcurve.functions.expressions import first_difference, ratio, trailing_mean
from wearcurve.operators.ordered import over_units
from wearcurve.schema import LABEL, RATIOS, ROLL_ROWS, TREND_SENSORS, require_columns


def last_cycles(df: DataFrame, *, unit: str = "unit", cycle: str = "cycle") -> DataFrame:
    return df.groupBy(unit).agg(F.max(cycle).alias("max_cycle"))


def rul_via_join(
    df: DataFrame, *, unit: str = "unit", cycle: str = "cycle", summary: DataFrame | None = None
) -> DataFrame:
    """Label by joining each unit's last cycle back; the size of the unit table picks the join.

    With the ``summary`` of ``df`` last cycles come from there and ``df`` is read once.
    """
    last = last_cycles(df, unit=unit, cycle=cycle) if summary is None else last_cycles(summary, unit=unit, cycle="last_cycle")
    joined = df.join(last, unit, "left")
    return joined.withColumn(LABEL, F.col("max_cycle") - F.col(cycle)).drop("max_cycle")


def add_rul(df: DataFrame, *, unit: str = "unit", cycle: str = "cycle", **blocks) -> DataFrame:
    """Remaining cycles until the unit's last one."""
    rows = over_units(df, last="_last", unit=unit, cycle=cycle, **blocks)
    return rows.withColumn(LABEL, F.col("_last") - F.col(cycle)).drop("_last")


def _lifecycle(cycle: str, last: Column | None = None) -> list[Column]:
    share = F.col(cycle).cast("double") / (F.col("_last") if last is None else last).cast("double")
    return [share.alias("cycle_norm"), (F.lit(1.0) - share).alias("health_index")]


def add_lifecycle(df: DataFrame, *, unit: str = "unit", cycle: str = "cycle", **blocks) -> DataFrame:
    """Position in the unit's life, and its complement. Both encode the label."""
    rows = over_units(df, last="_last", unit=unit, cycle=cycle, **blocks)
    return rows.select("*", *_lifecycle(cycle)).drop("_last")


def row_columns(df: DataFrame, ratios: Mapping[str, tuple[str, str]] = RATIOS, *, cycle: str = "cycle") -> list[Column]:
    """The features of ``engineer`` that follow from a row's own readings, cycle and label: they need not be moved or kept."""
    return [*ratio_columns(df, ratios), *_lifecycle(cycle, F.col(LABEL) + F.col(cycle))]


#: Names of ``row_columns``.
ROW_FEATURES = (*RATIOS, "cycle_norm", "health_index")


def _trend_windows(df: DataFrame, sensors: Sequence[str], rows: int, means: bool = True, deltas: bool = True):
    types = {f.name: f.dataType for f in df.schema}

    def build(ordered: WindowSpec) -> dict[str, Column]:
        out = {}
        for s in sensors:
            if means:
                out[f"{s}_roll{rows}_mean"] = trailing_mean(F.col(s), ordered, rows)
            if deltas:
                out[f"{s}_delta1"] = first_difference(F.col(s), ordered, types[s])
        return out

    return build


def add_rolling_mean(
    df: DataFrame, sensors: Sequence[str] = TREND_SENSORS, rows: int = ROLL_ROWS,
    *, unit: str = "unit", cycle: str = "cycle", **blocks,
) -> DataFrame:
    build = _trend_windows(df, sensors, rows, deltas=False)
    return over_units(df, build, columns=sensors, depth=rows - 1, unit=unit, cycle=cycle, **blocks)


def add_delta(
    df: DataFrame, sensors: Sequence[str] = TREND_SENSORS, *, unit: str = "unit", cycle: str = "cycle", **blocks
) -> DataFrame:
    build = _trend_windows(df, sensors, ROLL_ROWS, means=False)
    return over_units(df, build, columns=sensors, depth=1, unit=unit, cycle=cycle, **blocks)


def ratio_columns(df: DataFrame, ratios: Mapping[str, tuple[str, str]] = RATIOS) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema}
    return [ratio(F.col(a), F.col(b), types[b]).alias(name) for name, (a, b) in ratios.items()]


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]] = RATIOS) -> DataFrame:
    return df.select("*", *ratio_columns(df, ratios))


def engineer(
    df: DataFrame,
    sensors: Sequence[str] = TREND_SENSORS,
    ratios: Mapping[str, tuple[str, str]] = RATIOS,
    *,
    rows: int = ROLL_ROWS,
    include_lifecycle: bool = True,
    unit: str = "unit",
    cycle: str = "cycle",
    **blocks,
) -> DataFrame:
    """Label and all features: one shuffle, one sort, one window operator.

    ``include_lifecycle=False`` leaves out the two features computed from the unit's last cycle, which
    are unknown for a unit still in service.
    """
    require_columns(df, (unit, cycle, *sensors), "panel")
    windowed = over_units(
        df, _trend_windows(df, sensors, rows), columns=sensors, depth=rows - 1, last="_last",
        unit=unit, cycle=cycle, **blocks,
    )
    added = [c for c in windowed.columns if c not in df.columns and c != "_last"]
    return windowed.select(
        *df.columns,
        (F.col("_last") - F.col(cycle)).alias(LABEL),
        *added,
        *ratio_columns(df, ratios),
        *(_lifecycle(cycle) if include_lifecycle else []),
    )
