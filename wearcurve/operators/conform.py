"""Several bronze datasets -> one typed panel with distinct unit ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.functions.expressions import identifier, nan_to_null
from wearcurve.operators.positions import bounded
from wearcurve.schema import CONSTANT_SENSORS, CORRELATED_SENSORS, SILVER_TYPES


def cast_columns(df: DataFrame, types: Mapping[str, T.DataType] = SILVER_TYPES) -> DataFrame:
    """Cast the named columns that exist, in one projection; other columns pass through.

    Unreadable values become null, NaN becomes null, and ids may be written as ``1.0``.
    """

    def cast(field: T.StructField):
        kind = types.get(field.name)
        if kind is None:
            return F.col(field.name)
        if isinstance(kind, T.IntegralType) and not isinstance(field.dataType, T.IntegralType):
            return identifier(F.col(field.name)).alias(field.name)
        value = F.col(field.name).try_cast(kind)
        return (nan_to_null(value, kind) if isinstance(kind, T.FractionalType) else value).alias(field.name)

    return df.select(*[cast(f) for f in df.schema])


def drop_constant(df: DataFrame, columns: Sequence[str] = CONSTANT_SENSORS) -> DataFrame:
    return df.drop(*columns)


def drop_correlated(df: DataFrame, columns: Sequence[str] = CORRELATED_SENSORS) -> DataFrame:
    return df.drop(*columns)


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, n, is_constant``: readings of each column, and whether these are all the same; one pass.

    A column without readings is constant.
    """
    stacked = df.select(F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("at", "x"))
    name = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("at") + 1)
    same = F.coalesce(F.min("x") == F.max("x"), F.lit(True))
    return stacked.groupBy("at").agg(F.count("x").alias("n"), same.alias("is_constant")).select(name.alias("feature"), "n", "is_constant")


def correlated_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a, b, n, r``: correlation of each pair of columns, ``a`` before ``b``, over the ``n`` rows that have both.

    One pass: each task sums the products of a batch around the batch's own means, for all pairs at once, and leaves one
    row a pair. Its moments are centred throughout, so that a small deviation beside a large mean is no trouble. Without
    two different readings on both sides ``r`` is null; a pair with a reading that is no finite number has no ``r`` but NaN.
    """
    k = len(columns)
    first, second = np.triu_indices(k, 1)
    stats = ("n", "mx", "my", "cxx", "cyy", "cxy", "x_low", "x_high", "y_low", "y_high")

    def moments(x: np.ndarray, there: np.ndarray) -> dict[str, np.ndarray]:
        """Of a batch; ``x[i, j]`` of a result is of column i over the rows that hold i and j."""
        m = there.astype(float)
        n = m.T @ m
        sound = np.where(there & np.isfinite(x), x, 0.0)
        mean = sound.sum(axis=0) / np.maximum(m.sum(axis=0), 1)
        d = np.where(there & np.isfinite(x), x - mean, 0.0)
        s, some = d.T @ m, np.maximum(n, 1)
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for j in range(k):
            rows = slice(None) if there[:, j].all() else there[:, j]
            least, most = np.where(there[rows], x[rows], np.inf), np.where(there[rows], x[rows], -np.inf)
            low[:, j], high[:, j] = np.fmin.reduce(least, axis=0, initial=np.inf), np.max(most, axis=0, initial=-np.inf)
        found = dict(
            n=n, mean=mean[:, None] + s / some, square=(d * d).T @ m - s * s / some, product=d.T @ d - s * s.T / some,
            low=low, high=high,
        )
        wild = (there & ~np.isfinite(x)).astype(float)
        if wild.any():
            touched = (wild.T @ m + m.T @ wild) > 0
            found["square"][touched] = found["product"][touched] = np.nan
        return found

    def merged(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        n = a["n"] + b["n"]
        some, apart = np.maximum(n, 1), b["mean"] - a["mean"]
        weight = a["n"] * b["n"] / some
        return dict(
            n=n, mean=a["mean"] + apart * b["n"] / some, square=a["square"] + b["square"] + apart * apart * weight,
            product=a["product"] + b["product"] + apart * apart.T * weight,
            low=np.fmin(a["low"], b["low"]), high=np.maximum(a["high"], b["high"]),
        )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
                found = moments(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]), there)
                total = found if total is None else merged(total, found)
        if total is not None:
            t, u = (lambda name: total[name][first, second]), (lambda name: total[name][second, first])
            values = (t("n"), t("mean"), u("mean"), t("square"), u("square"), t("product"), t("low"), t("high"), u("low"), u("high"))
            ends = [pa.array(first, pa.int32()), pa.array(second, pa.int32())]
            yield pa.RecordBatch.from_arrays([*ends, *map(pa.array, values)], names=["i", "j", *stats])

    schema = "i int, j int, " + ", ".join(f"{name} double" for name in stats)
    partials = df.select(*[F.col(c).cast("double") for c in columns]).mapInArrow(partial, schema).filter("n > 0")
    # A row a task and pair; around the mean of all tasks.
    every = Window.partitionBy("i", "j")
    dx, dy = (F.col(m) - F.sum(F.col("n") * F.col(m)).over(every) / F.sum("n").over(every) for m in ("mx", "my"))
    about = partials.select("*", dx.alias("dx"), dy.alias("dy"))
    names = F.array(*[F.lit(c) for c in columns])
    found = about.groupBy("i", "j").agg(
        F.sum("n").cast("long").alias("n"),
        F.sum(F.col("cxx") + F.col("n") * F.col("dx") ** 2).alias("cxx"),
        F.sum(F.col("cyy") + F.col("n") * F.col("dy") ** 2).alias("cyy"),
        F.sum(F.col("cxy") + F.col("n") * F.col("dx") * F.col("dy")).alias("cxy"),
        (F.min("x_low") < F.max("x_high")).alias("x_varies"), (F.min("y_low") < F.max("y_high")).alias("y_varies"),
    )
    r = F.try_divide("cxy", F.sqrt("cxx") * F.sqrt("cyy"))
    return found.select(
        F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"), "n",
        F.when(F.col("x_varies") & F.col("y_varies"), r).alias("r"),
    )


def redundant_columns(pairs: DataFrame, columns: Sequence[str], threshold: float = 0.95) -> list[str]:
    """Columns that an earlier kept one repeats: ``|r|`` at the threshold or above, decided in the order of ``columns``.

    ``pairs`` are those of ``correlated_pairs``: one row a pair of columns.
    """
    near = {(r["a"], r["b"]) for r in pairs.filter(F.abs("r") >= threshold).collect()}
    kept: list[str] = []
    for c in columns:
        if not any((k, c) in near or (c, k) in near for k in kept):
            kept.append(c)
    return [c for c in columns if c not in kept]


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Union by column name with a ``source`` number from 1; a column absent on one side is null."""
    if not sources:
        raise ValueError("no dataset to combine")
    numbered = [df.withColumn("source", F.lit(i)) for i, df in enumerate(sources, start=1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def source_offsets(df: DataFrame, *, unit: str = "unit", offset_by: str = "count") -> DataFrame:
    """``source, offset``: units (or highest ids) of all earlier sources. One row per source."""
    if offset_by not in ("count", "max"):
        raise ValueError("offset_by must be 'count' or 'max'")
    size = F.count_distinct(unit) if offset_by == "count" else F.max(unit)
    before = Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy("source")
        .agg(size.alias("_size"))
        .select("source", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("offset"))
    )


def shift_units(
    df: DataFrame, *, unit: str = "unit", offset_by: str = "count", n_sources: int | None = None,
    offsets: DataFrame | None = None,
) -> DataFrame:
    """Shift unit ids so that datasets do not share them.

    With ``n_sources``, the length of the caller's list, the offsets are broadcast once that length is
    checked; otherwise Spark picks the join. ``offsets`` found elsewhere, as in a summary, spare a scan of ``df``.
    """
    if offsets is None:
        offsets = source_offsets(df, unit=unit, offset_by=offset_by)
    if n_sources is not None:
        offsets = bounded(offsets, n_sources)
    shifted = (F.col(unit) + F.col("offset")).cast("int")
    return df.join(offsets, "source").withColumn(unit, shifted).drop("offset")


def shared_units(df: DataFrame, *, unit: str = "unit") -> DataFrame:
    """Unit ids claimed by more than one source. Possible after a count offset over ids with gaps."""
    return (
        df.groupBy(unit)
        .agg(F.count_distinct("source").alias("n_sources"))
        .filter(F.col("n_sources") > 1)
    )


def conform(sources: Sequence[DataFrame], *, offset_by: str = "count") -> DataFrame:
    """Cast, number, union and shift: the silver panel, with its ``source`` column."""
    united = union_sources([cast_columns(df) for df in sources])
    return shift_units(united, offset_by=offset_by, n_sources=len(sources))
