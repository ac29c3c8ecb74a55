"""Tables at the layer edges."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.schema import require_columns


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, *, infer: bool = False) -> DataFrame:
    """CSV with header: all strings by default, a declared schema, or inferred types.

    A directory is read whole. A declared schema is matched by the names in the header: the file may hold
    its columns in any order and others besides, an absent one is an error, an unreadable value is null.
    """
    found = spark.read.option("header", True).option("inferSchema", infer and schema is None).csv(path)
    if schema is None:
        return found
    require_columns(found, tuple(schema.names), path)
    return found.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def read_many(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """One DataFrame of strings per dataset that has data; a directory without parts is skipped."""
    found = []
    for path in paths:
        try:
            found.append(read_csv(spark, path))
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            warnings.warn(f"no data in {path}, skipped", stacklevel=2)
    if not found:
        raise ValueError(f"no data in any of {list(paths)}")
    return found


def load(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Parquet or CSV by extension; a DataFrame passes through."""
    if isinstance(source, DataFrame):
        return source
    if source.endswith(".parquet"):
        return spark.read.parquet(source)
    if source.endswith(".csv"):
        return read_csv(spark, source, infer=True)
    raise ValueError(f"unsupported input {source!r}: expected .parquet, .csv or a DataFrame")
