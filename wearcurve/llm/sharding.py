"""Shards by a two-pass external shuffle.

The first pass scatters records over buckets of a size that fits memory, by a seeded hash of the whole record. The
second shuffles each bucket by Fisher-Yates (``shuffle`` over the bucket's array) and writes it. Buckets follow one
another in one order of all records; its n-th record goes to shard n mod shards, so counts differ by one at most and
each shard is itself a uniform shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.llm.work import stage, without

SHARDS = 8
BUCKET_BYTES = 8 << 20
LAW = "rows"
#: Buckets of one task beyond ``SMALL`` buckets, and buckets whose places are counted together.
TASK_BUCKETS, SMALL, BLOCK = 16, 200, 1 << 12
#: Rows that repeat in every column more often than this are dealt as copies, one by one.
HOT_ROWS = 10_000
COPIES = 1 << 12


def bytes_in(text: str = "text"):
    return (F.coalesce(F.octet_length(F.col(f"`{text}`")), F.lit(0)) + 1).cast("long")


def write_shards(
    docs: DataFrame,
    path: str,
    *,
    shards: int = SHARDS,
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = 23,
    text: str = "text",
    hot_rows: int = HOT_ROWS,
) -> T.StructType:
    """Write ``docs`` under ``path``, one folder ``shard=n`` each, with ``slot``, its rows' gapless places from 0.

    A bucket's file holds its records of one shard in the order of their slots. Nulls are hashed like values. A row that
    repeats in every column more than ``hot_rows`` times is counted, and its copies go to buckets of their own hashes;
    fewer repeats share a bucket. Columns named ``shard`` or ``slot`` are replaced. The number of buckets follows from the
    bytes alone, that of tasks is a sixteenth of it where buckets are many. A bucket is one row of one task while it is
    shuffled. An empty table leaves an empty folder. Returns the schema of what was written, which reads such a folder too.
    """
    docs = without(docs, "shard", "slot")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    records = docs.select(
        F.xxhash64(F.lit(seed), *columns).alias("hash"), F.xxhash64(*columns).alias("second"), F.struct(*columns).alias("record")
    )
    total = docs.agg(F.sum(bytes_in(text))).first()[0] or 0
    buckets = 1 + total // bucket_bytes
    rows = stage(records.groupBy("hash", "second").agg(F.count(F.lit(1)).alias("n")), "rows")
    hot = rows.filter(F.col("n") > hot_rows)
    if not hot.isEmpty():
        records, rows = _deal_copies(records, rows, hot, seed)
    bucket = F.pmod("hash", F.lit(buckets)).cast("int")
    counts = rows.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))
    offsets = _running(stage(counts, "buckets"))

    # Sorted by their hash and packed, a bucket's records are the same array in every attempt, and sorted buckets meet
    # the generator in the same order, so a lost task comes back alike.
    records = records.select(bucket.alias("bucket"), F.struct("hash", "record").alias("r"))
    in_order = lambda a, b: F.when(a["hash"] < b["hash"], -1).when(a["hash"] > b["hash"], 1).otherwise(0)
    dealt = records.repartition(max(min(buckets, SMALL), -(-buckets // TASK_BUCKETS)), "bucket")
    gathered = dealt.groupBy("bucket").agg(F.array_sort(F.collect_list("r"), in_order).alias("r"))
    placed = gathered.join(offsets, "bucket").sortWithinPartitions("bucket")
    shuffled = placed.select("offset", F.shuffle("r", F.lit(seed)).alias("r"))
    numbered = shuffled.select("offset", F.posexplode("r").alias("place", "r"))
    position = F.col("offset") + F.col("place")
    out = numbered.select("r.record.*", F.pmod(position, F.lit(shards)).cast("int").alias("shard"), F.floor(position / shards).alias("slot"))
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return out.schema


def _deal_copies(records: DataFrame, rows: DataFrame, hot: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """``records`` and counts of ``rows`` with a hash of its own for each copy of a ``hot`` row.

    The copies are made anew from one record and their number, so they are the same in every attempt.
    """
    keys = ["hash", "second"]
    one = records.join(hot, keys, "left_semi").groupBy(*keys).agg(F.first("record").alias("record"))
    rare, others = records.join(hot, keys, "left_anti"), rows.join(hot, keys, "left_anti")
    many = _copies(one.join(hot, keys), seed).select("hash", "second", "record")
    each = _copies(hot, seed).select("hash", "second", F.lit(1).cast("long").alias("n"))
    return rare.select("hash", "second", "record").union(many), others.select("hash", "second", "n").union(each)


def _copies(hot: DataFrame, seed: int) -> DataFrame:
    """``n`` rows for each of ``hot``, with hashes of their own; tasks share a row's copies by thousands."""
    last = F.col("n") - 1
    parts = hot.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(last / COPIES))))
    first = F.col("part") * COPIES
    within = F.sequence(first, F.least(first + COPIES - 1, last))
    copies = parts.repartition("hash", "second", "part").withColumn("copy", F.explode(within))
    return copies.withColumn("hash", F.xxhash64(F.lit(seed), "hash", "second", "copy"))


def _running(counts: DataFrame) -> DataFrame:
    """``bucket`` and ``offset``, the rows in earlier buckets; one task orders the sums of blocks of buckets alone."""
    blocks = counts.withColumn("block", F.floor(F.col("bucket") / BLOCK))
    before = lambda window: F.coalesce(F.sum("n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.groupBy("block").agg(F.sum("n").alias("n")).select("block", before(Window.orderBy("block")).alias("start"))
    inside = blocks.select("block", "bucket", before(Window.partitionBy("block").orderBy("bucket")).alias("inside"))
    return inside.join(starts, "block").select("bucket", (F.col("start") + F.col("inside")).alias("offset"))


def read_shards(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The written records; without their ``schema`` it is read from the files, of which there must be some."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def shard_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Where each written document lies, read back from the files; ``grown_shard`` is null under this law."""
    return read_shards(spark, path, schema).select(
        "doc_id",
        bytes_in().alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
