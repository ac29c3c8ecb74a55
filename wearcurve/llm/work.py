"""Tables that cut lineage, in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.sources.sinks import shared_dir

#: White space that separates words, and the words themselves.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh shared folder and return a scan of it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text) -> F.Column:
    """Words of a text as an array; empty for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that would clash with ``names``, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def sample_by_hash(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """At most ``rows`` rows of ``df``: those of the smallest hash of ``keys``, ties by the keys.

    Rows whose hash is far too large are left out before anything is ordered, so one task orders about twice ``rows``
    at any size.
    """
    place = F.shiftrightunsigned(F.xxhash64(*keys), 1)
    share = (2 * rows + 1000) / max(df.count(), 1)
    near = df if share >= 1 else df.filter(place < int(share * 2**63))
    return near.orderBy(place, *keys).limit(rows)
