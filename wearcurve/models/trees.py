"""Fitted tree ensembles as tables of nodes, so that they can be cut, judged and applied by Spark.

``tree, node, left, right, feature, threshold, prediction, n_rows``: one row for each node, the root of a tree is node 0.
An inner node sends rows with ``feature <= threshold`` to ``left``. ``prediction`` is the mean of a node's own training
rows, at inner nodes too, which is what makes any node a possible leaf; ``n_rows`` is the size of its sample. Leaves have
no children, feature and threshold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearcurve.operators.positions import MAX_TARGETS
from wearcurve.sources.sinks import shared_dir, write_parquet


def node_table(model, path: str | None = None) -> DataFrame:
    """Nodes of a fitted MLlib forest or boosted ensemble, read from its saved form at ``path`` or the shared folder."""
    spark = SparkSession.getActiveSession()
    path = path or shared_dir(spark, "forest")
    model.write().overwrite().save(path)
    return read_nodes(spark, path)


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of an ensemble that MLlib saved at ``path``; the ensemble itself is not loaded."""
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(inner, node["leftChild"]).alias("left"),
        F.when(inner, node["rightChild"]).alias("right"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        node["prediction"].alias("prediction"),
        node["rawCount"].alias("n_rows"),
    )


#: Deepest level MLlib grows.
MAX_DEPTH = 30


def walk(
    rows: DataFrame,
    nodes: DataFrame,
    features: Sequence[str],
    *,
    trees: int,
    depths: Sequence[int] = (MAX_DEPTH,),
    splits: Sequence[int] = (2,),
    levels: int = MAX_DEPTH,
    n_nodes: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Each row once for each tree, with what the tree says when it is cut: columns ``tree`` and ``p_<depth>_<split>``.

    Cut at ``depth`` and ``split``, a tree ends at the first node on the row's way that is a leaf, lies at that depth, or
    has fewer than ``split`` rows. All cuts are read off one way down. Where the caller knows the number of nodes and it
    may be broadcast, every task goes down all levels at once on the rows it holds; without it all rows go down one level
    a join, and Spark picks the joins. ``levels`` is the depth of the deepest tree. Of the rows' columns those in ``keep``
    stay, by default all. Features must not be null.
    """
    keep = list(rows.columns if keep is None else keep)
    if small_enough(n_nodes):
        told = [f"p_{d}_{s}" for d in depths for s in splits]

        def each(kept: pa.RecordBatch, said: dict[tuple[int, int], np.ndarray]) -> list[pa.Array]:
            at = np.repeat(np.arange(kept.num_rows), trees)
            values = [said[d, s].ravel() for d in depths for s in splits]
            return [*kept.take(pa.array(at)).columns, pa.array(np.tile(np.arange(trees, dtype=np.int32), kept.num_rows)), *map(pa.array, values)]

        added = [T.StructField("tree", T.IntegerType()), *[T.StructField(c, T.DoubleType()) for c in told]]
        return _by_tasks(rows, nodes, features, keep, each, added, trees=trees, depths=depths, splits=splits, levels=levels)
    lookup = nodes.select("tree", F.col("node").alias("_node"), "left", "right", "feature", "threshold", "prediction", "n_rows")
    kept = [F.col(f"`{c}`") for c in keep]
    state = rows.select(
        F.struct(*kept).alias("_row"), F.array(*[F.col(c).cast("double") for c in features]).alias("_x"),
        F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("_node"),
        *[F.lit(None).cast("double").alias(f"_now{s}") for s in splits], *[F.lit(True).alias(f"_on{s}") for s in splits],
    )
    told: list[str] = []
    for level in range(levels + 1):
        inner = F.col("left").isNotNull()
        goes = F.when(~inner, F.col("_node")).when(F.get("_x", F.col("feature")) <= F.col("threshold"), F.col("left"))
        state = state.join(lookup, ["tree", "_node"]).select(
            "_row", "_x", "tree", goes.otherwise(F.col("right")).alias("_node"), *told,
            *[F.when(F.col(f"_on{s}"), F.col("prediction")).otherwise(F.col(f"_now{s}")).alias(f"_now{s}") for s in splits],
            *[(F.col(f"_on{s}") & inner & (F.col("n_rows") >= s)).alias(f"_on{s}") for s in splits],
        )
        reached = [d for d in depths if d == level or level == levels and d > level]
        state = state.select("*", *[F.col(f"_now{s}").alias(f"p_{d}_{s}") for d in reached for s in splits])
        told += [f"p_{d}_{s}" for d in reached for s in splits]
    return state.select("_row.*", "tree", *told)


def small_enough(n_nodes: int | None) -> bool:
    """Whether a table of this many nodes may be sent to every task."""
    return n_nodes is not None and n_nodes <= MAX_TARGETS


def mean_predictions(
    rows: DataFrame,
    nodes: DataFrame,
    features: Sequence[str],
    *,
    sizes: Sequence[int],
    depths: Sequence[int],
    splits: Sequence[int],
    levels: int,
    n_nodes: int,
    keep: Sequence[str],
) -> DataFrame:
    """Each row once: the columns ``keep``, and ``m_<depth>_<split>_<n>``, what the forest of the first ``n`` trees says
    when they are cut as in ``walk``. Rows stay where they are; ``sizes`` are the numbers of trees.

    Nodes too many for a broadcast are walked down by joins.
    """
    cuts = [(d, s, n) for d in depths for s in splits for n in sizes]
    options = dict(trees=max(sizes), depths=depths, splits=splits, levels=levels)
    if not small_enough(n_nodes):
        numbered = rows.withColumn("_id", F.monotonically_increasing_id())
        said = walk(numbered, nodes, features, n_nodes=n_nodes, keep=["_id", *keep], **options)
        means = [F.avg(F.when(F.col("tree") < n, F.col(f"p_{d}_{s}"))).alias(f"m_{d}_{s}_{n}") for d, s, n in cuts]
        firsts = [F.first(f"`{c}`").alias(c) for c in keep]
        return said.groupBy("_id").agg(*firsts, *means).drop("_id")

    def means_of(kept: pa.RecordBatch, said: dict[tuple[int, int], np.ndarray]) -> list[pa.Array]:
        return [*kept.columns, *[pa.array(said[d, s][:, :n].mean(axis=1)) for d, s, n in cuts]]

    added = [T.StructField(f"m_{d}_{s}_{n}", T.DoubleType()) for d, s, n in cuts]
    return _by_tasks(rows, nodes, features, list(keep), means_of, added, **options)


#: Predictions that a task holds at once, and rows that go down a tree at once: their features stay in a core's own cache.
_STEPS, _RUN_ROWS = 1 << 18, 1 << 11


def _by_tasks(rows, nodes, features, keep, out, added, *, trees, depths, splits, levels) -> DataFrame:
    """``out(kept columns, {(depth, split): predictions by row and tree})`` of runs of rows, as columns ``keep`` and ``added``."""
    lookup = rows.sparkSession.sparkContext.broadcast(_packed(nodes, trees, splits))
    depths, splits, n_kept = list(depths), list(splits), len(keep)
    run = max(1, min(_STEPS // trees, _RUN_ROWS))

    # Tasks get these functions by value: nothing in them names this module.
    def descend(x: np.ndarray, forest: dict[str, np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
        """What each tree says of each row at every cut; all rows go down one tree after the other, a level at a time."""
        feature, threshold, children = forest["feature"], forest["threshold"], forest["children"]
        values, first = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        said = {(d, s): np.empty((len(x), len(forest["roots"]))) for d in depths for s in splits}
        for tree, root in enumerate(forest["roots"]):
            node = np.full(len(x), root, np.int64)
            for level in range(levels + 1):
                reached = [d for d in depths if d == level or level == levels and d > level]
                for s in splits if reached else ():
                    here = forest[f"says{s}"].take(node)
                    for d in reached:
                        said[d, s][:, tree] = here
                if level < levels:
                    low = values.take(first + feature.take(node)) <= threshold.take(node)
                    node += node
                    node += low
                    node = children.take(node)
        return said

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[n_kept:]])
            kept = batch.select(list(range(n_kept)))
            for start in range(0, batch.num_rows, run):
                said = descend(x[start : start + run], lookup.value)
                yield pa.RecordBatch.from_arrays(out(kept.slice(start, run), said), names=names)

    schema = T.StructType([*[rows.schema[c] for c in keep], *added])
    names = schema.names
    narrow = rows.select(*[F.col(f"`{c}`") for c in keep], *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)])
    return narrow.mapInArrow(work, schema)


def _packed(nodes: DataFrame, trees: int, splits: Sequence[int]) -> dict[str, np.ndarray]:
    """The first ``trees`` trees as arrays over all nodes: a leaf is its own child, and ``says`` holds for each split what a
    walk says that has come down to a node, which is what it said where it ended."""
    table = nodes.filter(F.col("tree") < trees).select(
        F.shiftleft(F.col("tree").cast("long"), 32).alias("tree"), "node",
        F.coalesce("left", F.lit(-1)).alias("left"), F.coalesce("right", F.lit(-1)).alias("right"),
        F.coalesce("feature", F.lit(0)).alias("feature"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"),
        "prediction", F.col("n_rows").cast("double").alias("n_rows"),
    ).toArrow()
    t = {c: table[c].to_numpy() for c in table.column_names}
    key = t["tree"] + t["node"]
    order = np.argsort(key)
    t, key = {c: v[order] for c, v in t.items()}, key[order]
    at = np.arange(len(key))
    inner = t["left"] >= 0
    left, right = (np.where(inner, np.searchsorted(key, t["tree"] + np.maximum(t[side], 0)), at) for side in ("left", "right"))
    roots = np.searchsorted(key, np.arange(trees, dtype=np.int64) << 32)
    says = {s: t["prediction"].copy() for s in splits}
    ended = {s: np.zeros(len(key), bool) for s in splits}
    level = roots
    while len(level):
        level = level[inner[level]]
        for s in splits:
            stops = ended[s][level] | (t["n_rows"][level] < s)
            for side in (left, right):
                ended[s][side[level]] = stops
                below = side[level[stops]]
                says[s][below] = says[s][level[stops]]
        level = np.concatenate([left[level], right[level]])
    children = np.empty(2 * len(key), np.int64)
    children[0::2], children[1::2] = right, left
    return {
        "roots": roots, "children": children, "feature": t["feature"].astype(np.int64),
        "threshold": t["threshold"], **{f"says{s}": says[s] for s in splits},
    }


def _dead(nodes: DataFrame, split: int) -> DataFrame:
    """``tree, node`` of all nodes below one that has fewer than ``split`` rows.

    One written table a level, from the children of such nodes down. Rows fall by one at least from a node to its
    children, so these parts of a tree have fewer than ``split`` levels, and no more than the tree.
    """
    spark = nodes.sparkSession
    children = nodes.filter("left IS NOT NULL").select("tree", "node", "n_rows", F.explode(F.array("left", "right")).alias("child"))
    children = write_parquet(children, shared_dir(spark, "children"))
    level = children.filter(F.col("n_rows") < split).select("tree", F.col("child").alias("node"))
    parts = [write_parquet(level.distinct(), shared_dir(spark, "cut"))]
    while not parts[-1].isEmpty():
        level = children.join(parts[-1], ["tree", "node"]).select("tree", F.col("child").alias("node"))
        # What an upper level has named already is not followed twice.
        new = level.join(reduce(DataFrame.union, parts), ["tree", "node"], "left_anti")
        parts.append(write_parquet(new, shared_dir(spark, "cut")))
    return reduce(DataFrame.union, parts)


def cut(nodes: DataFrame, split: int) -> DataFrame:
    """The trees that a smallest number of rows to split gives: nodes with fewer become leaves."""
    kept = nodes.join(_dead(nodes, split), ["tree", "node"], "left_anti")
    leaf = F.col("n_rows") < split
    inner = ("left", "right", "feature", "threshold")
    return kept.withColumns({c: F.when(~leaf, F.col(c)) for c in inner}).select(nodes.columns)


def cut_model(model, split: int):
    """A fitted MLlib forest whose nodes with fewer than ``split`` rows are leaves.

    The saved table of nodes is cut and numbered anew, and loaded as a model again.
    """
    spark = SparkSession.getActiveSession()
    whole, path = shared_dir(spark, "forest"), shared_dir(spark, "forest-cut")
    model.write().overwrite().save(whole)
    model.write().overwrite().save(path)
    dead = _dead(read_nodes(spark, whole), split).select(F.col("tree").alias("treeID"), "node")
    data = spark.read.parquet(f"{whole}/data").withColumn("node", F.col("nodeData.id"))
    kept = data.join(dead, ["treeID", "node"], "left_anti")
    # A tree's nodes are numbered from its root down, left before right, and stay in that order.
    number = (F.row_number().over(Window.partitionBy("treeID").orderBy("node")) - 1).cast("int")
    numbered = kept.select("treeID", "node", number.alias("id"))
    old = kept.join(numbered, ["treeID", "node"])
    for side in ("left", "right"):
        other = numbered.select("treeID", F.col("node").alias(side), F.col("id").alias(f"{side}_id"))
        old = old.withColumn(side, F.col(f"nodeData.{side}Child")).join(other, ["treeID", side], "left")
    n = F.col("nodeData")
    inner = (n["leftChild"] >= 0) & (n["rawCount"] >= split)
    none = F.struct(
        F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")
    )
    node = F.struct(
        F.col("id").alias("id"), n["prediction"].alias("prediction"), n["impurity"].alias("impurity"),
        n["impurityStats"].alias("impurityStats"), n["rawCount"].alias("rawCount"),
        F.when(inner, n["gain"]).otherwise(-1.0).alias("gain"),
        F.when(inner, F.col("left_id")).otherwise(-1).alias("leftChild"),
        F.when(inner, F.col("right_id")).otherwise(-1).alias("rightChild"),
        F.when(inner, n["split"]).otherwise(none).alias("split"),
    )
    old.select("treeID", node.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    return type(model).load(path)
