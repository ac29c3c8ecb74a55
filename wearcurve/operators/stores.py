"""Feature store and label store: two projections of gold that share the row key."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearcurve.schema import KEYS, LABEL, require_columns
from wearcurve.sources.sinks import PACKED, shared_dir


def feature_store(gold: DataFrame) -> DataFrame:
    return gold.drop(LABEL)


def label_store(gold: DataFrame) -> DataFrame:
    return gold.select(*KEYS, LABEL)


def join_stores(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows present in both stores. A key that repeats on both sides fans out."""
    require_columns(features, KEYS, "feature store")
    require_columns(labels, KEYS, "label store")
    return features.join(labels, list(KEYS), "inner")


#: Rows of a bucket, about, and the fewest buckets.
BUCKET_ROWS, FEWEST_BUCKETS = 1 << 19, 8


def buckets_for(gold: DataFrame, bucket_rows: int = BUCKET_ROWS) -> int:
    """Buckets for ``write_co_located`` that hold about as many rows each whatever the size of the table, a power of two."""
    wanted = -(-gold.select(KEYS[0]).count() // bucket_rows)
    return max(FEWEST_BUCKETS, 1 << max(wanted - 1, 0).bit_length())


def _deal(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows by key to ``buckets`` tasks; floats and doubles travel side by side in arrays, where a float takes four bytes."""
    alike = {kind: [n for n, k in rows.dtypes if k == kind and n not in KEYS] for kind in ("float", "double")}
    alike = {f"_{kind}": names for kind, names in alike.items() if names}
    place = {n: F.get(packed, F.lit(i)).alias(n) for packed, names in alike.items() for i, n in enumerate(names)}
    moved = rows.select(*[n for n in rows.columns if n not in place], *[F.array(*names).alias(p) for p, names in alike.items()])
    return moved.repartition(buckets, *KEYS).select(*[place.get(n, F.col(n)) for n in rows.columns])


def write_co_located(
    gold: DataFrame, buckets: int, path: str | None = None, *, finish: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Feature store and label store as tables with the same buckets of the row key, sorted by it.

    ``join_stores`` of the two moves and sorts nothing: each bucket meets its counterpart where it is read. A bucket is
    one task of that join, so ``buckets`` is chosen for the size of the table. A row's bucket follows from unit and cycle,
    so a long unit spreads over all of them. The rows are dealt once for each store, so a bucket is one file. ``finish``
    makes gold of rows that were dealt, such as by scaling them: ``gold`` then is what it starts from.
    The tables go to ``path`` or the shared folder, under fresh names in the session's catalog.
    """
    spark = gold.sparkSession
    path = path or shared_dir(spark, "stores")
    found = []
    dealt = _deal(gold, buckets)
    features = feature_store(finish(dealt) if finish else dealt)
    for name, store in (("feature_store", features), ("label_store", _deal(label_store(gold), buckets))):
        table = f"{name}_{uuid.uuid4().hex}"
        writer = store.write.options(**PACKED).bucketBy(buckets, *KEYS).sortBy(*KEYS).option("path", f"{path}/{name}")
        writer.format("parquet").saveAsTable(table)
        found.append(spark.table(table))
    return found[0], found[1]
