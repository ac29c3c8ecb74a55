"""Token ids in Parquet: list columns, delta-packed, in the order of the documents.

Documents are dealt into ranges of their order once, as text, and each task tokenizes, sorts and writes its range.
Row groups and pages are small and page-indexed, so a reader of some documents or of the metadata columns alone reads
little.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearcurve.llm.units import ASCII_SPACE, by_text, list_array, map_texts, schema_with
from wearcurve.llm.word_bpe import library_ids

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
#: Most text bytes of a range of documents, and so of a file, about.
FILE_BYTES = 64 << 20


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    *,
    end_id: int = 2,
    text: str = "text",
    order: Sequence[str] = ("doc_id",),
    files: int | None = None,
) -> None:
    """Write the token ids of each document, ``end_id`` last, in ascending ``order``, with ``n_tokens``.

    Null and empty texts have the end id alone. Null keys come first. Rows of equal keys are ordered by a digest of
    their texts, so a key that many rows share is spread too. ``files`` is the number of ranges, by default one for
    every shuffle partition, and more if the texts are larger than ``FILE_BYTES`` for each.
    """
    if files is None:
        total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
        files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + total // FILE_BYTES)
    tied = docs.select(*order, text, F.xxhash64(text).alias("tie"))
    keys = [F.col(k).asc_nulls_first() for k in (*order, "tie")]
    ranged = tied.repartitionByRange(files, *keys).sortWithinPartitions(*keys)

    def work(texts: list[bytes]) -> list[pa.Array]:
        ids, sizes = by_text(texts, ASCII_SPACE, library_ids(vocabulary))
        ends = np.cumsum(sizes)
        full = np.insert(ids, ends, end_id)
        return [list_array(full, sizes + 1), pa.array(sizes + 1, pa.int64())]

    coded = ranged.mapInArrow(
        lambda batches: map_texts(batches, text, work, ["ids", "n_tokens"]),
        schema_with(tied, text, "ids array<int>, n_tokens long"),
    )
    (
        coded.write.option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; ``ids`` are read only if they are used."""
    return spark.read.parquet(path)


def token_starts(spark: SparkSession, path: str, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each document with ``start``, the ids of all documents before it, and a checksum of its ids.

    Files hold ranges of the order, and a file's name has its range's number: sums of whole files, one row each, then
    a running sum inside each file.
    """
    rows = read_tokens(spark, path).withColumn("file", F.col("_metadata.file_name"))

    def checksums(batches):
        for batch in batches:
            lists = batch.column(batch.schema.names.index("ids"))
            flat, ends = lists.flatten().to_numpy().astype("<u4"), np.cumsum(lists.value_lengths().to_numpy())
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != "ids"]
            added = [pa.array(np.diff(ends, prepend=0), pa.int64()), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [c for _, c in rest] + added, names=[n for n, _ in rest] + ["n_tokens", "ids_crc32"]
            )

    rows = rows.select("file", *order, "tie", "ids")
    summed = rows.mapInArrow(checksums, schema_with(rows, "ids", "n_tokens long, ids_crc32 long"))
    totals = read_tokens(spark, path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.sum("n_tokens").alias("total")
    )
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    keys = [F.col(k).asc_nulls_first() for k in (*order, "tie")]
    within = Window.partitionBy("file").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return summed.join(totals, "file").select(
        *order,
        (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("start"),
        "n_tokens",
        "ids_crc32",
    )
