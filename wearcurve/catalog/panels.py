"""Sensor panels derived from the star tables, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.operators.conform import cast_columns
from wearcurve.operators.ordered import number_rows
from wearcurve.schema import RAW_FIELDS

# Sensor name -> SQL over lineitem. The oracle SQL is built from the same table.
LINEITEM_SENSORS = {
    "op_setting_1": "CAST(l_discount - 0.05 AS DOUBLE)",
    "op_setting_2": "CAST(l_tax - 0.04 AS DOUBLE)",
    "op_setting_3": "CAST(100.0 AS DOUBLE)",
    "T2": "CAST(518.67 AS DOUBLE)",
    "T24": "CAST(640 + l_quantity / 25 AS DOUBLE)",
    "T30": "CAST(1580 + l_extendedprice / 10000 AS DOUBLE)",
    "T50": "CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(1400 + l_extendedprice / 5000 AS DOUBLE) END",
    "P2": "CAST(14.62 AS DOUBLE)",
    "P15": "CAST(21.5 + l_tax / 8 AS DOUBLE)",
    "P30": "CAST(553 + l_discount * 10 AS DOUBLE)",
    "Nf": "CAST(2388 + l_tax AS DOUBLE)",
    "Nc": "CAST(9050 + l_quantity AS DOUBLE)",
    "epr": "CAST(1.3 AS DOUBLE)",
    "Ps30": "CAST(47.25 + l_discount AS DOUBLE)",
    "phi": "CAST(521 + l_quantity / 64 AS DOUBLE)",
    "NRf": "CAST(2388 + l_tax AS DOUBLE)",
    "NRc": "CAST(8130 + l_quantity AS DOUBLE)",
    "BPR": "CAST(8.5 + l_discount / 8 AS DOUBLE)",
    "farB": "CAST(0.03 AS DOUBLE)",
    "htBleed": "CAST(390 + l_linenumber AS DOUBLE)",
    "Nf_dmd": "CAST(2388.0 AS DOUBLE)",
    "PCNfR_dmd": "CAST(100.0 AS DOUBLE)",
    "W31": "CAST(39 - l_tax AS DOUBLE)",
    "W32": "CAST(23.5 - l_tax / 2 AS DOUBLE)",
}
LINEITEM_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem_panel(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """One supplier is one unit; its lines in shipping order are its cycles. ``keep``: extra columns."""
    lines = table(spark, sf_dir, "lineitem")
    day = F.datediff("l_shipdate", F.lit("1970-01-01").cast("date"))
    numbered = number_rows(lines, "l_suppkey", LINEITEM_ORDER, day, F.shiftright("l_orderkey", 12))
    return numbered.select(
        F.col("l_suppkey").cast("int").alias("unit"),
        "cycle",
        *[F.expr(sql).alias(name) for name, sql in LINEITEM_SENSORS.items()],
        *keep,
    ).select(*RAW_FIELDS, *keep)


def silver_panel(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return cast_columns(lineitem_panel(spark, sf_dir, *keep))


def panel_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as raw text in ``value``; every third line carries outer blanks."""
    return _lines(lineitem_panel(spark, sf_dir))


def source_lines(sources: list[DataFrame]) -> list[DataFrame]:
    """The three datasets as raw text."""
    empty = F.lit(None).cast("double")
    return [_lines(df if "W32" in df.columns else df.withColumn("W32", empty)) for df in sources]


def _lines(panel: DataFrame) -> DataFrame:
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("NaN")) for c in RAW_FIELDS]
    line = F.concat_ws(" ", *fields)
    padded = F.when(F.col("cycle") % 3 == 0, F.concat(F.lit("  "), line, F.lit(" \t"))).otherwise(line)
    return panel.select(padded.alias("value"))


def panel_sources(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The panel in three datasets whose unit ids collide; the second one lacks a sensor."""
    return split_sources(flagged_panel(spark, sf_dir))


def flagged_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_panel(spark, sf_dir, "l_returnflag")


def split_sources(panel: DataFrame) -> list[DataFrame]:
    parts = [panel.filter(F.col("l_returnflag") == flag).drop("l_returnflag") for flag in ("A", "N", "R")]
    return [parts[0], parts[1].drop("W32"), parts[2]]


def events_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user is one unit; its events in time order are its cycles."""
    events = table(spark, sf_dir, "events")
    # From calendar fields, so that no session time zone can put hours out of order.
    hour = F.datediff("ts", F.lit("1970-01-01").cast("date")) * 24 + F.hour("ts")
    second = F.minute("ts") * 60 + F.second("ts")
    return number_rows(events, "user_id", ("ts",), hour, second).select(
        F.col("user_id").cast("int").alias("unit"),
        "cycle",
        "value",
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
    )
