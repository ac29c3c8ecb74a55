"""Raw run-to-failure logs: text without header, fields parted by runs of whitespace."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearcurve.functions.expressions import nan_to_null
from wearcurve.operators.positions import MAX_TARGETS, bounded
from wearcurve.schema import KEYS, RAW_FIELDS

# Ids are read as numbers first, since they may be written as 1.0.
_LINE_SCHEMA = ", ".join(f"{c} double" for c in RAW_FIELDS) + ", _malformed string"
_LINE_OPTIONS = {"sep": " ", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}


@dataclass(frozen=True)
class ParsedLog:
    """``rows`` in the bronze schema; ``rejects`` as ``value, reason``."""

    rows: DataFrame
    rejects: DataFrame


def parse_lines(lines: DataFrame, *, pad_short: bool = True) -> ParsedLog:
    """Column ``value`` -> named, typed columns; other columns stay, after them.

    Blank lines are skipped and outer blanks ignored; an unreadable field is null. A short line is padded
    with nulls unless ``pad_short`` is off. A line with too many fields, or without a readable unit and
    cycle, is rejected.
    """
    width = len(RAW_FIELDS)
    kept = [c for c in lines.columns if c != "value"]
    inked = lines.filter(F.col("value").rlike(r"\S"))
    text = inked.select(*kept, "value", F.trim(F.regexp_replace("value", r"\s+", " ")).alias("_text"))
    # Inlined rather than selected: the parsed struct is computed once per line, and filters on its
    # fields stay above it instead of parsing the line again.
    parsed = text.select(
        *kept, "value", "_text", F.inline(F.array(F.from_csv("_text", F.lit(_LINE_SCHEMA), _LINE_OPTIONS)))
    )
    # Only a line the parser objected to is split again, to tell a field too many from a bad one.
    fields = F.when(F.col("_malformed").isNotNull(), F.size(F.split("_text", " "))).otherwise(width)
    typed = parsed.select(
        *kept,
        "value",
        fields.alias("_fields"),
        *[
            nan_to_null(F.col(c)).try_cast("int").alias(c) if c in KEYS else nan_to_null(F.col(c)).alias(c)
            for c in RAW_FIELDS
        ],
    )
    reason = (
        F.when(F.col("_fields") > width, "too many fields")
        .when(F.lit(not pad_short) & (F.col("_fields") < width), "too few fields")
        .when(F.col("unit").isNull() | F.col("cycle").isNull(), "no unit or cycle")
    )
    judged = typed.withColumn("reason", reason)
    return ParsedLog(
        judged.filter(F.col("reason").isNull()).select(*RAW_FIELDS, *kept),
        judged.filter(F.col("reason").isNotNull()).select("value", "reason", *kept),
    )


def read_raw(spark: SparkSession, path: str | list[str], *, pad_short: bool = True) -> ParsedLog:
    return parse_lines(spark.read.text(path), pad_short=pad_short)


def read_raws(spark: SparkSession, paths: Sequence[str], *, pad_short: bool = True) -> ParsedLog:
    """Many files or folders of parts in one scan, with ``source``, the number of a line's dataset from 1.

    Each path is a dataset, and so is each match of a pattern (see ``datasets``). A folder holds its files at any depth.
    The plan does not grow with the number of paths. A line whose file is none of those listed is an error, so no line
    is lost in silence.
    """
    return _read_files(spark, files_of(spark, datasets(spark, paths)), pad_short)


def _read_files(spark: SparkSession, files: list[tuple[str, int]], pad_short: bool = True) -> ParsedLog:
    # A reader would take signs of a pattern in a file's own name for a pattern.
    lines = spark.read.text([re.sub(r"([*?\[\]{}\\])", r"\\\1", path) for path, _ in files])
    listed = spark.createDataFrame([(_place(path), source) for path, source in files], "_file string, source int")
    if len(files) <= MAX_TARGETS:
        listed = bounded(listed, len(files))
    place = F.regexp_replace(F.col("_metadata.file_path"), "^([a-z0-9]+):/+", "$1:/")
    found = lines.select("value", place.alias("_file")).join(listed, "_file", "left")
    lost = F.raise_error(F.concat(F.lit("no dataset for lines of "), F.col("_file")))
    return parse_lines(found.select("value", F.coalesce("source", lost.cast("int")).alias("source")), pad_short=pad_short)


def datasets(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The caller's paths in order, each pattern replaced by the files and folders it matches, by name.

    A path without a match is an error, and so is one that is given twice. A name that holds signs of a pattern and
    exists as it stands is no pattern.
    """
    found: list[str] = []
    for path in paths:
        given = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = given.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.exists(given):
            matches = [system.makeQualified(given).toString()]
        else:
            # Hidden files, such as marks of a finished job, are no data.
            statuses = [s.getPath() for s in system.globStatus(given) or ()]
            matches = sorted(s.toString() for s in statuses if s.getName()[0] not in "_.")
        if not matches:
            raise FileNotFoundError(f"nothing at {path}")
        found += matches
    if len(set(found)) < len(found):
        raise ValueError(f"raw data given twice: {sorted(p for p in set(found) if found.count(p) > 1)}")
    return found


def files_of(spark: SparkSession, roots: Sequence[str]) -> list[tuple[str, int]]:
    """Files at or below each of ``roots`` with its number from 1; hidden files and folders are left out.

    A file below two of them belongs to the deeper one. A root without files is skipped with a warning; none left is an
    error.
    """
    owner: dict[str, int] = {}
    by_depth = sorted(enumerate(roots, start=1), key=lambda x: len(x[1]))
    for number, root in by_depth:
        top = spark._jvm.org.apache.hadoop.fs.Path(root)
        system = top.getFileSystem(spark._jsc.hadoopConfiguration())
        listing = system.listFiles(top, True)
        while listing.hasNext():
            path = listing.next().getPath().toString()
            if not re.search(r"/[_.]", path[len(root) :]):
                owner[path] = number
    for number, root in by_depth:
        if number not in owner.values():
            warnings.warn(f"no data in {root}, skipped", stacklevel=3)
    if not owner:
        raise ValueError(f"no data in any of {list(roots)}")
    return sorted(owner.items(), key=lambda x: (x[1], x[0]))


def _place(path: str) -> str:
    """A Hadoop path as a scan names it: an encoded address with one slash behind its scheme."""
    uri = SparkContext._active_spark_context._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()
    return re.sub("^([a-z0-9]+):/+", r"\1:/", uri)
