"""A local session for tests and the benchmark. On a cluster the caller brings the session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", *, checkpoint_dir: str = "/tmp/wearcurve", memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("wearcurve")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
