"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of all words, at most ``most`` times its own; what that cuts off is shared
again by weight. Target over own words is the number of copies each document is due: the whole part is taken for
certain, the rest by a fixed-size sample. Documents are ranked by the odds of a seeded uniform number over the odds of
their inclusion, and the first ones are taken as long as their words fit.

The cut in a source's ranking is found from words summed per slice of the ranking, so only one slice of a source is
ever ordered, and a source with most of the rows is counted in parts like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearcurve.llm.work import WORD, stage, without

WEIGHTS = (1, 2, 3)
MOST = 3
#: Slices of a source's ranking.
SLICES = 1 << 16


def words_in(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(*columns: str, seed: int) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of a digest."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size``, ``target`` from ``source`` and ``size`` of documents.

    Sources by code point, null last, have ``weights`` in turn. One row a source is ordered in one place: a mix names
    its sources, so these are few.
    """
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = own.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights)) + 1))
    # Sources reach their limit in the order of size over weight. With the first k at their limits, the others share
    # what is left; k is right once the next source stays below its limit.
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rate = (
        F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    rated = weighed.withColumn("rate", rate.cast("double")).withColumn(
        "below", F.col("rate") * F.col("weight") <= most * F.col("source_size")
    )
    first = F.min(F.when(F.col("below"), F.struct(F.col("source_size") / F.col("weight"), "rate")))
    share = rated.agg(first["rate"]).first()[0]
    limit = (most * F.col("source_size")).cast("double")
    return weighed.select("source", "source_size", F.least(F.lit(share) * F.col("weight"), limit).alias("target"))


def plan(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: int = 11) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``rows``, ``copies``, once for each document.

    Rows that agree in id, source and size are ``rows`` rows of one document and are taken together, each ``copies``
    times. A null text has no words. Null sources are one source, null ids draw like an id. Without words nothing is
    taken.
    """
    sized = docs.select("doc_id", "source", words_in().alias("size"))
    sized = stage(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    by_source = stage(targets(sized.withColumn("size", F.col("size") * F.col("rows")), weights, most), "targets")
    ratio = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    due = by_source.select(
        F.col("source").alias("of"), "source_size", "target", F.floor(ratio).cast("int").alias("whole"), ratio.alias("ratio")
    ).withColumn("part", F.col("ratio") - F.col("whole"))
    u, p = uniform("doc_id", seed=seed), F.col("part")
    # Odds of the draw over odds of the inclusion, q, as q / (1 + q), which lies between 0 and 1.
    odds = u * (1 - p) / (u * (1 - p) + (1 - u) * p)
    drawn = stage(
        sized.join(due, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("rank", F.when(p > 0, odds).otherwise(1.0))
        .withColumn("slice", F.floor(F.col("rank") * SLICES).cast("int"))
        .withColumn("words", F.col("size") * F.col("rows"))
        .drop("of", "ratio"),
        "drawn",
    )
    need = F.col("target") - F.col("whole") * F.col("source_size")
    slices = drawn.groupBy("source", "slice").agg(F.sum("words").alias("words"), F.max(need).alias("need"))
    so_far = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = slices.withColumn("before", F.coalesce(F.sum("words").over(so_far), F.lit(0)))
    # The slice in which the words run over; slices before it fit whole.
    cut = cut.filter("before <= need AND before + words > need").groupBy("source").agg(
        F.min(F.struct("slice", "before")).alias("cut")
    )
    cut = cut.select(F.col("source").alias("of"), F.col("cut.slice").alias("last"), F.col("cut.before").alias("before"))
    placed = drawn.join(cut, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    # The document at the cut is taken if most of it fits.
    within = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    run = F.col("before") + F.sum("words").over(within)
    inside = placed.filter("slice = last").withColumn("fits", 2 * run - F.col("words") <= 2 * need)
    outside = placed.filter("last IS NULL OR slice <> last").withColumn(
        "fits", (F.col("part") > 0) & (F.col("last").isNull() | (F.col("slice") < F.col("last")))
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "rows"]
    both = inside.select(*columns, "whole", "fits").union(outside.select(*columns, "whole", "fits"))
    return both.select(*columns, (F.col("whole") + F.col("fits").cast("int")).alias("copies"))


def taken(docs: DataFrame, **options) -> DataFrame:
    """One row for each row of ``docs``, with the words that the mix takes of it."""
    each = plan(docs, **options).withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    chosen = plan(docs, **options).filter("copies > 0")
    chosen = chosen.select(*[F.col(c).alias(f"of_{c}") for c in ("doc_id", "source", "size")], "copies")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    sized = docs.select("doc_id", "source", words_in().alias("size"), whole)
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ("doc_id", "source", "size")]
    picked = sized.join(chosen, same).select("document", "copies")
    return picked.select("document", F.explode(F.sequence(F.lit(1), "copies"))).select("document.*")
