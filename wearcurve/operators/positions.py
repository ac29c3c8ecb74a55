"""Rows at given positions of a total order, without sorting or moving the rows.

Counting goes level by level, coarse to fine. Each level splits a group into a bounded number of
children (leading digits of an int or of a digest), so running totals stay small whatever the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 16


# Most targets that may be asked for at once. Targets are broadcast, and ordered in one place beside
# the running totals of at most 2**DIGIT_BITS groups.
MAX_TARGETS = 1 << 20


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast of a table that holds ``rows`` rows by construction; refused beyond ``MAX_TARGETS``."""
    if rows > MAX_TARGETS:
        raise ValueError(f"{rows} targets; at most {MAX_TARGETS} can be broadcast")
    return F.broadcast(df)


def rows_at(
    counts: DataFrame, rows: DataFrame, targets: DataFrame, levels: Sequence[str], *, n_targets: int
) -> DataFrame:
    """``targets(target, position)`` -> ``(target, *levels)`` of the row at each 1-based position.

    ``counts`` holds ``_n`` rows per value of all levels but the last. ``rows`` holds all levels and is
    read only in the groups that contain a target. Levels sort as the total order does and together
    identify a row. ``n_targets`` is a parameter of the caller, not a property of the data. A position outside the data yields no row.
    """
    first, *deeper = levels
    # The first level has no parent to join on. Totals and targets become one short ordered sequence
    # in which a target takes the nearest running total that reaches it.
    running = Window.orderBy(first).rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        counts.groupBy(first)
        .agg(F.sum("_n").alias("_size"))
        .withColumn("_at", F.sum("_size").over(running))
        .select("_at", F.struct(first, "_size", F.col("_at").alias("_end")).alias("_group"))
    )
    asked = targets.select("target", F.col("position").cast("bigint").alias("_at"))
    reaching = Window.orderBy(F.desc("_at"), F.col("target").isNotNull()).rowsBetween(
        Window.unboundedPreceding, 0
    )
    found = (
        totals.unionByName(asked, allowMissingColumns=True)
        .withColumn("_group", F.last("_group", ignorenulls=True).over(reaching))
        .filter(F.col("target").isNotNull())
        .select(
            "target",
            (F.col("_at") - F.col("_group._end") + F.col("_group._size")).alias("_position"),
            F.col(f"_group.{first}").alias(first),
        )
    )
    for depth, level in enumerate(deeper, start=1):
        parents = list(levels[:depth])
        source = rows.withColumn("_n", F.lit(1)) if level == levels[-1] else counts
        upto = Window.partitionBy("target").orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
        found = (
            source.join(bounded(found, n_targets), parents)
            .groupBy("target", "_position", *parents, level)
            .agg(F.sum("_n").alias("_size"))
            .withColumn("_end", F.sum("_size").over(upto))
            .withColumn("_before", F.col("_end") - F.col("_size"))
            .filter((F.col("_before") < F.col("_position")) & (F.col("_position") <= F.col("_end")))
            .select("target", (F.col("_position") - F.col("_before")).alias("_position"), *parents, level)
        )
    return found.select("target", *levels)
