"""Ordered per-unit windows that hold when a single unit owns a large share of all rows.

A plain ``Window.partitionBy(unit)`` puts a unit into one task. Here a unit with more than
``HOT_ROWS`` rows is cut into blocks of its order column, and each block receives copies of the
last few rows before it, so any frame that looks back a bounded number of rows gives the same
answer as over the whole unit. Other units keep one block, and without hot units the plan is one
plain window behind one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wearcurve.sources.sinks import shared_dir, write_parquet

# A parameter of the caller. It changes the plan and never the answer.
HOT_ROWS = 1 << 20
# An int order column has at most 2**32 >> BLOCK_BITS blocks per unit, each of at most 2**BLOCK_BITS rows.
BLOCK_BITS = 18


def hot_units(df: DataFrame, unit: str, measures: Sequence[Column], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """All units above ``hot_rows`` rows with whole-unit ``measures``, or None without any.

    A written table, so the planner knows its size and picks the join by it.
    """
    found = df.groupBy(unit).agg(F.count(F.lit(1)).alias("_rows"), *measures).filter(F.col("_rows") > hot_rows)
    hot = write_parquet(found.drop("_rows"), shared_dir(df.sparkSession, "hot"))
    return None if hot.isEmpty() else hot


def _blocks(df: DataFrame, hot: DataFrame, unit: str, cycle: str, block_bits: int, how: str) -> DataFrame:
    """Add ``_hot_last``, the last cycle of a hot unit, and ``_block``, which is 0 for other units."""
    block = F.when(F.col("_hot_last").isNotNull(), F.shiftright(cycle, block_bits)).otherwise(0)
    return df.join(hot, unit, how).withColumn("_block", block.cast("int"))


def _lead_in(hot_rows: DataFrame, unit: str, order: Sequence[str], columns: Sequence[str], depth: int) -> DataFrame:
    """For each block of a hot unit, the ``depth`` rows that precede it, wherever they are."""
    group = (unit, "_block", "_hot_last")
    within = Window.partitionBy(unit, "_block").orderBy(*order)
    # Each block contributes at most `depth` rows, and at least one, so the last `depth` rows before a
    # block are found in the `depth` blocks that precede it.
    endings = (
        hot_rows.select(*group, *order, *columns)
        .withColumn("_later", F.lead(order[0], depth).over(within))
        .filter(F.col("_later").isNull())
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct(*order, *columns))).alias("_ending"))
    )
    before = Window.partitionBy(unit).orderBy("_block").rowsBetween(-depth, -1)
    start = F.greatest(F.size("_earlier") - depth + 1, F.lit(1))
    return (
        endings.select(*group, F.collect_list("_ending").over(before).alias("_endings"))
        .select(*group, F.flatten("_endings").alias("_earlier"))
        .select(*group, F.inline(F.slice("_earlier", start, depth)))
    )


def over_units(
    df: DataFrame,
    windows: Callable[[WindowSpec], dict[str, Column]] | None = None,
    *,
    columns: Sequence[str] = (),
    depth: int = 0,
    last: str | None = None,
    unit: str = "unit",
    cycle: str = "cycle",
    hot_rows: int = HOT_ROWS,
    block_bits: int = BLOCK_BITS,
    ties: bool = False,
) -> DataFrame:
    """Add window columns to every row, all behind one shuffle and one sort.

    ``windows(ordered)`` names the new columns over the window ordered by ``cycle``; their frames may
    reach back ``depth`` rows over ``columns``. ``last`` names a column for the unit's last cycle.
    (``unit``, ``cycle``) must be unique, or ``ties`` set: rows of one cycle are then ordered by a digest of all
    their columns, the same in every plan and on every run. Rows that agree in all columns are interchangeable.
    """
    if windows is None:
        return _with_last(df, last, unit, cycle) if last else df
    order = (cycle, "_tie") if ties else (cycle,)
    if ties:
        df = df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in sorted(df.columns)]))
    hot = hot_units(df, unit, [F.max(cycle).alias("_hot_last")], hot_rows)
    if hot is None:
        rows, group = df, (unit,)
    else:
        group = (unit, "_block")
        rows = _blocks(df, hot, unit, cycle, block_bits, "left")
        if depth:
            hot_only = _blocks(df, hot, unit, cycle, block_bits, "inner")
            lead_in = _lead_in(hot_only, unit, order, columns, depth).withColumn("_copy", F.lit(True))
            rows = rows.withColumn("_copy", F.lit(False)).unionByName(lead_in, allowMissingColumns=True)
        # A join on the unit alone must not leave a hot unit's blocks together.
        rows = rows.repartition(*group)
    ordered = Window.partitionBy(*group).orderBy(*order)
    added = dict(windows(ordered))
    if last:
        # Same order spec as the other columns, so that no second sort is planned for the maximum.
        whole = F.max(cycle).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        added[last] = whole if hot is None else F.coalesce("_hot_last", whole)
    rows = rows.select("*", *[c.alias(name) for name, c in added.items()]).drop("_tie")
    if hot is None:
        return rows
    if depth:
        rows = rows.filter(~F.col("_copy")).drop("_copy")
    return rows.drop("_block", "_hot_last")


def _with_last(df: DataFrame, last: str, unit: str, cycle: str) -> DataFrame:
    """A maximum needs no order: it is aggregated and joined, and Spark splits a skewed side."""
    most = df.groupBy(F.col(unit).alias("_of")).agg(F.max(cycle).alias(last))
    return df.join(most, F.col(unit).eqNullSafe(F.col("_of")), "left").drop("_of")


def number_rows(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    *buckets: Column,
    name: str = "cycle",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``row_number`` per ``key``, also when one key, or one bucket of a key, holds a large share of the rows.

    ``buckets`` are integers, coarse to fine, that never decrease along ``order_by`` inside the bucket before, such as
    the day of a timestamp and its second. Rows of a hot key are numbered per finest bucket and shifted by the counts
    of the buckets before it, level by level.
    """
    hot = hot_units(df, key, [F.lit(True).alias("_hot")], hot_rows)
    if hot is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order_by)).cast("int"))
    levels = [f"_bucket{i}" for i in range(len(buckets))]
    rows = df.join(hot, key, "left").withColumns(
        {
            level: F.when(F.col("_hot"), F.coalesce(bucket.cast("long"), F.lit(-(2**63)))).otherwise(0)
            for level, bucket in zip(levels, buckets)
        }
    )
    counts = rows.filter(F.col("_hot")).groupBy(key, *levels).agg(F.count(F.lit(1)).alias("_n"))
    offsets, own = counts, []
    for depth, level in enumerate(levels):
        parents = [key, *levels[:depth]]
        before = Window.partitionBy(*parents).orderBy(level).rowsBetween(Window.unboundedPreceding, -1)
        sums = counts.groupBy(*parents, level).agg(F.sum("_n").alias("_sum"))
        shifted = sums.select(*parents, level, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(f"_before{depth}"))
        offsets = offsets.join(shifted, [*parents, level])
        own.append(f"_before{depth}")
    offsets = offsets.select(key, *levels, sum((F.col(c) for c in own), F.lit(0)).alias("_before"))
    within = Window.partitionBy(key, *levels).orderBy(*order_by)
    return (
        rows.repartition(key, *levels)
        .withColumn("_number", F.row_number().over(within))
        .join(offsets, [key, *levels], "left")
        .withColumn(name, (F.col("_number") + F.coalesce("_before", F.lit(0))).cast("int"))
        .drop("_hot", "_number", "_before", *levels)
    )
