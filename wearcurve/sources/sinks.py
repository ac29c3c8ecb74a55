"""Writers. Every table is written by the tasks that hold its rows, and read back from storage."""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


# Names the work folder where ``spark.checkpoint.dir`` is not set.
WORK_DIR = "spark.wearcurve.workDir"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share.

    That is the one the cluster names in ``spark.checkpoint.dir``, else the one in
    ``spark.wearcurve.workDir``. Without either nothing is written anywhere.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_DIR, None)
    if not root:
        raise ValueError(f"set spark.checkpoint.dir or {WORK_DIR} to a folder all executors share")
    path = posixpath.join(root, f"{name}-{uuid.uuid4().hex}")
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_handed_out: dict[str, list[str]] = {}


def release(spark: SparkSession) -> int:
    """Delete the tables this application wrote to its work folder; returns how many there were.

    DataFrames that read them can no longer be used.
    """
    paths = _handed_out.pop(spark.sparkContext.applicationId, [])
    gone = 0
    for path in paths:
        # A caller may have added an extension.
        pattern = spark._jvm.org.apache.hadoop.fs.Path(path + "*")
        files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in files.globStatus(pattern) or ():
            gone += files.delete(found.getPath(), True)
    return gone


def base_name(path: str) -> str:
    """Last part of a path without its extension."""
    return re.sub(r"(?<=.)\.[^.]*$", "", posixpath.basename(path.rstrip("/")))


#: Options of Parquet tables. Whether a column gets a dictionary is settled at its first page; in pages of 20,000 rows, the
#: default, readings of some ten thousand values never get one.
PACKED = {"compression": "zstd", "parquet.page.row.count.limit": str(1 << 20), "parquet.dictionary.page.size": str(2 << 20)}


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(
    df: DataFrame, path: str, *, single_file: bool = False, by: Sequence[str] = (), compression: str | None = None
) -> str:
    """CSV with header, with one folder for each value of the columns ``by``. A ``compression`` that cannot be split, such
    as ``gzip``, suits parts of a size that one task reads."""
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").option("header", True).partitionBy(*by).csv(path, compression=compression)
    return path


def write_bronze(
    df: DataFrame, raw_path: str, bronze_dir: str, *, single_file: bool = False, compression: str | None = None
) -> str:
    """Bronze CSV of a raw file, in ``bronze_<file name without extension>``."""
    path = posixpath.join(bronze_dir, f"bronze_{base_name(raw_path)}")
    return write_csv(df, path, single_file=single_file, compression=compression)
