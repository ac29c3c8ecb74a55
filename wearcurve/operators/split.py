"""Leak-free split by unit, contiguous row folds, and the bootstrapped fleet.

Units are ordered by a seeded digest. A split is a pair of cut points in that order and a fold a pair
of cut points in (unit, cycle) order: one row of constants, compared on each row. No row is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from wearcurve.functions.expressions import digest_number, seeded_digest
from wearcurve.operators.positions import DIGIT_BITS, bounded, rows_at
from wearcurve.schema import OOT_UNITS, SEED, TRAIN_SHARE, VAL_SHARE
from wearcurve.sources.sinks import shared_dir, write_parquet


def distinct_units(df: DataFrame, unit: str = "unit") -> DataFrame:
    return df.select(unit).distinct()


def _unit_order(unit: str, seed: int) -> Column:
    return F.struct(seeded_digest(seed, F.col(unit)).alias("digest"), F.col(unit).alias("unit"))


def _ordered_units(df: DataFrame, unit: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Units with their place in the order, and their count per leading digits of the digest."""
    units = distinct_units(df, unit).select(_unit_order(unit, seed).alias("_order"))
    units = units.withColumn("_lead", digest_number(F.col("_order.digest"), DIGIT_BITS // 4))
    return units, _counted(units.groupBy("_lead"))


def _counted(groups: GroupedData) -> DataFrame:
    """Rows per group, written: several levels of a search read them, and the panel is counted once."""
    counts = groups.agg(F.count(F.lit(1)).alias("_n"))
    return write_parquet(counts, shared_dir(counts.sparkSession, "counts"))


def _cut(n: Column, share: float) -> Column:
    return F.floor(n * F.lit(share))


def assign_split(
    df: DataFrame,
    *,
    unit: str = "unit",
    seed: int = SEED,
    shares: tuple[float, float] = (TRAIN_SHARE, VAL_SHARE),
    summary: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``: train, val or test. All rows of a unit fall on the same side.

    With the ``summary`` of ``df`` the cut points are found there, and ``df`` is read only by what uses the result.
    """
    units, counts = _ordered_units(df if summary is None else summary, unit, seed)
    n = F.col("n")
    targets = counts.agg(F.sum("_n").alias("n")).select(
        F.inline(
            F.array(
                F.struct(F.lit("train").alias("target"), _cut(n, shares[0]).alias("position")),
                F.struct(F.lit("val").alias("target"), _cut(n, shares[1]).alias("position")),
            )
        )
    )
    cuts = rows_at(counts, units, targets, ["_lead", "_order"], n_targets=2).agg(
        F.struct(
            F.max(F.when(F.col("target") == "train", F.col("_order"))).alias("train"),
            F.max(F.when(F.col("target") == "val", F.col("_order"))).alias("val"),
        )
    )
    place = F.col("_place")
    return (
        df.withColumn("_cuts", cuts.scalar())
        .withColumn("_place", _unit_order(unit, seed))
        .withColumn(
            "split",
            F.when(place <= F.col("_cuts.train"), "train").when(place <= F.col("_cuts.val"), "val").otherwise("test"),
        )
        .drop("_cuts", "_place")
    )


def unit_split(df: DataFrame, *, unit: str = "unit", **options) -> DataFrame:
    """One row per unit with its split."""
    return assign_split(distinct_units(df, unit), unit=unit, **options)


def split_rows(df: DataFrame, split: str, **options) -> DataFrame:
    """The rows of one split."""
    assigned = df if "split" in df.columns else assign_split(df, **options)
    return assigned.filter(F.col("split") == split)


def split_sizes(df: DataFrame, *, unit: str = "unit", rows: str | None = None) -> DataFrame:
    """Rows and units of each split of a panel, or of its summary, where ``rows`` counts the rows behind each row."""
    n_rows = F.sum(rows) if rows else F.count(F.lit(1))
    return df.groupBy("split").agg(n_rows.alias("n_rows"), F.count_distinct(unit).alias("n_units"))


def assign_folds(
    df: DataFrame, k: int = 3, *, unit: str = "unit", cycle: str = "cycle", summary: DataFrame | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Add ``fold`` 0..k-1: contiguous in (unit, cycle) order, the first ``n mod k`` one row longer.

    Rows are counted in the ``summary`` of ``df`` where it is given; then only the blocks that hold a cut are sought
    in ``df`` itself. With ``among`` the rows that meet it are dealt into folds; ``fold`` is null for the others.
    """
    dealt = df if among is None else df.filter(among)
    keyed = dealt.select(
        unit,
        cycle,
        F.shiftright(unit, DIGIT_BITS).alias("_unit_lead"),
        F.shiftright(cycle, DIGIT_BITS).alias("_cycle_lead"),
    )
    if summary is None:
        counts = _counted(keyed.groupBy("_unit_lead", unit, "_cycle_lead"))
    else:
        lead = F.shiftright(unit, DIGIT_BITS).alias("_unit_lead")
        counts = summary.select(lead, unit, F.col("block").alias("_cycle_lead"), F.col("n_rows").alias("_n"))
    i, n = F.col("target"), F.col("n")
    targets = counts.agg(F.sum("_n").alias("n")).select(
        n, F.explode(F.sequence(F.lit(1), F.lit(k - 1))).alias("target")
    ).select(
        "target",
        (i * F.floor(n / k) + F.least(i.cast("bigint"), n % k)).alias("position"),
    )
    ends = rows_at(counts, keyed, targets, ["_unit_lead", unit, "_cycle_lead", cycle], n_targets=k - 1).agg(
        F.sort_array(F.collect_list(F.struct("target", F.struct(unit, cycle).alias("end"))))
    )
    place = F.struct(unit, cycle)
    fold = F.lit(k - 1)
    for j in reversed(range(k - 1)):
        fold = F.when(place <= F.col("_ends")[j]["end"], j).otherwise(fold)
    fold = fold if among is None else F.when(among, fold)
    return df.withColumn("_ends", ends.scalar()).withColumn("fold", fold.cast("int")).drop("_ends")


def bootstrap_draws(
    df: DataFrame, n: int = OOT_UNITS, *, unit: str = "unit", seed: int = SEED, test_from: float = VAL_SHARE
) -> DataFrame:
    """``n`` draws with replacement from the test units: ``(draw, unit)``, one row per draw."""
    units, counts = _ordered_units(df, unit, seed)
    total = counts.agg(F.sum("_n"))
    start = _cut(F.col("_units"), test_from)
    targets = (
        df.sparkSession.range(1, n + 1)
        .withColumn("_units", total.scalar())
        .select(
            F.col("id").cast("int").alias("target"),
            (start + digest_number(seeded_digest(seed, F.col("id"))) % (F.col("_units") - start) + 1).alias("position"),
        )
    )
    found = rows_at(counts, units, targets, ["_lead", "_order"], n_targets=n)
    return found.select(F.col("target").alias("draw"), F.col("_order.unit").alias(unit))


def bootstrap(
    df: DataFrame,
    n: int = OOT_UNITS,
    *,
    unit: str = "unit",
    seed: int = SEED,
    test_from: float = VAL_SHARE,
    prefix: str = "OOT_",
) -> DataFrame:
    """A fleet of ``n`` drawn units: every draw copies all rows of its unit under a new id.

    The draws are the small side by construction, so a large unit is copied where it lies.
    """
    draws = bootstrap_draws(df, n, unit=unit, seed=seed, test_from=test_from)
    return df.join(bounded(draws, n), unit).withColumn(unit, F.concat(F.lit(prefix), F.col("draw").cast("string")))
