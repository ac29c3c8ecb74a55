"""Tables of nodes against the models they come from."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from wearcurve.models import forest, trees
from wearcurve.models.ridge import VECTOR, assembler

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.random((240, 3))
    y = 10 * x[:, 0] + np.sin(9 * x[:, 1]) + rng.random(240)
    values = [(i, *map(float, r), float(t), int(i % 3)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(values, "id long, a double, b double, c double, RUL double, fold int").cache()


@pytest.fixture(scope="module")
def model(rows):
    return RandomForestRegressor(featuresCol=VECTOR, labelCol="RUL", numTrees=4, maxDepth=30, seed=3).fit(
        assembler(NAMES).transform(rows)
    )


@pytest.fixture(scope="module")
def nodes(model):
    return trees.node_table(model).cache()


def by_hand(nodes, limit, split):
    """A function from a row to the predictions of its trees, cut at a depth and a number of rows."""
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}

    def say(row):
        out = []
        for tree in range(4):
            node, depth = table[tree, 0], 0
            while node["left"] is not None and depth < limit and node["n_rows"] >= split:
                side = "left" if row[NAMES[node["feature"]]] <= node["threshold"] else "right"
                node, depth = table[tree, node[side]], depth + 1
            out.append(node["prediction"])
        return out

    return say


def test_walk_equals_the_model_on_all_rows(rows, model, nodes):
    levels = max(t.depth for t in model.trees)
    for n_nodes in (model.totalNumNodes, None):
        said = trees.walk(rows, nodes, NAMES, trees=4, levels=levels, n_nodes=n_nodes)
        got = {r["id"]: r["p"] for r in said.groupBy("id").agg(F.avg("p_30_2").alias("p")).collect()}
        want = {r["id"]: r["prediction"] for r in model.transform(assembler(NAMES).transform(rows)).collect()}
        assert got == pytest.approx(want)


def test_all_cuts_are_read_off_one_way_down(rows, model, nodes):
    depths, splits = (0, 3, 6, 30), (2, 5, 20)
    said = trees.walk(rows, nodes, NAMES, trees=4, depths=depths, splits=splits, levels=max(t.depth for t in model.trees))
    assert said.columns[:7] == [*rows.columns, "tree"]
    got = {(r["id"], r["tree"]): r for r in said.collect()}
    assert len(got) == 4 * 240
    for d in depths:
        for s in splits:
            say = by_hand(nodes, d, s)
            for r in rows.limit(60).collect():
                assert [got[r["id"], t][f"p_{d}_{s}"] for t in range(4)] == say(r)


def test_cut_trees_obey_the_limit(nodes):
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}
    for split in (3, 5, 40, 10_000):
        kept = {(r["tree"], r["node"]): r for r in trees.cut(nodes, split).collect()}
        assert all(r["n_rows"] >= split for r in kept.values() if r["left"] is not None)
        for r in kept.values():
            if r["left"] is not None:
                assert (r["tree"], r["left"]) in kept and (r["tree"], r["right"]) in kept
            else:
                before = table[r["tree"], r["node"]]
                assert before["left"] is None or before["n_rows"] < split
        assert set(kept) <= set(table)
    assert len(kept) == 4


def test_cut_models_say_what_cut_tables_say(rows, model, nodes):
    short = trees.cut_model(model, 12)
    assert short.totalNumNodes == trees.cut(nodes, 12).count() < model.totalNumNodes
    say = by_hand(nodes, 30, 12)
    for r in short.transform(assembler(NAMES).transform(rows)).collect():
        assert r["prediction"] == pytest.approx(np.mean(say(r)))


POINTS = {
    "maxDepth": (1, 3, 30), "featureSubsetStrategy": ("sqrt", "all"), "minInstancesPerNode": (1, 9),
    "minRowsToSplit": (2, 25), "numTrees": (2, 5),
}


def test_grid_fits_once_for_all_nested_points(rows, monkeypatch):
    fits = []
    grown = forest._grown
    monkeypatch.setattr(forest, "_grown", lambda *a: fits.append(a[-1]) or grown(*a))
    found = forest.search(rows, NAMES, POINTS)
    assert len(fits) == 2 * 2 * 3 + 1
    scores = {tuple(r)[:-1]: r["mean_rmse"] for r in found.results.collect()}
    assert len(scores) == 48 and min(scores.values()) == scores[tuple(found.params.values())]
    deep, flat = (np.mean([v for k, v in scores.items() if k[0] == d]) for d in (30, 1))
    assert deep < flat
    fitted = found.model.stages[-1]
    assert fitted.getNumTrees == found.params["numTrees"]
    assert max(t.depth for t in fitted.trees) <= found.params["maxDepth"]
    inner = trees.node_table(fitted).filter("left IS NOT NULL")
    assert inner.agg(F.min("n_rows")).first()[0] >= found.params["minRowsToSplit"]


def test_scores_of_a_point_are_those_of_its_own_model(rows):
    """The largest point is the fit itself; a smaller one is that fit, cut."""
    points = {"maxDepth": (2, 8), "featureSubsetStrategy": ("all",), "minInstancesPerNode": (1,), "minRowsToSplit": (2, 9), "numTrees": (3,)}
    got = {(r["maxDepth"], r["minRowsToSplit"], r["fold"]): r["rmse"] for r in forest.fold_scores(rows, NAMES, points).collect()}
    assert len(got) == 12
    for k in range(3):
        train, held = rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k)
        for split in (2, 9):
            model = forest.fit(train, NAMES, maxDepth=8, featureSubsetStrategy="all", numTrees=3, minRowsToSplit=split)
            error = model.transform(held).agg(F.sqrt(F.avg((F.col("prediction") - F.col("RUL")) ** 2))).first()[0]
            assert got[8, split, k] == pytest.approx(error)


def test_subsets_of_one_size_share_a_fit(rows, monkeypatch):
    fits = []
    grown = forest._grown
    monkeypatch.setattr(forest, "_grown", lambda *a: fits.append(a[-1]) or grown(*a))
    points = {"maxDepth": (2,), "featureSubsetStrategy": ("sqrt", "log2"), "minInstancesPerNode": (1,), "minRowsToSplit": (2,), "numTrees": (2,)}
    got = {(r["featureSubsetStrategy"], r["fold"]): r["rmse"] for r in forest.fold_scores(rows, NAMES, points).collect()}
    assert len(fits) == 3 and len(got) == 6 and all(got["sqrt", k] == got["log2", k] for k in range(3))
    own = [forest.fit(rows, NAMES, numTrees=2, maxDepth=2, featureSubsetStrategy=s).stages[-1].toDebugString for s in ("sqrt", "log2")]
    assert own[0].split("\n")[1:] == own[1].split("\n")[1:]


def test_rows_of_a_tree_are_bounded(rows):
    model = forest.fit(rows, NAMES, numTrees=6, maxDepth=30, tree_rows=20).stages[-1]
    sizes = [r["n_rows"] for r in trees.node_table(model).filter("node = 0").collect()]
    assert len(sizes) == 6 and 5 < np.mean(sizes) < 40


def test_rows_go_down_small_tables_without_joins(rows, model, nodes):
    """Nodes that may be broadcast: the rows are neither joined nor multiplied on the way to a forest's mean."""
    depths, splits, levels = (0, 3, 30), (2, 20), max(t.depth for t in model.trees)
    options = dict(depths=depths, splits=splits, levels=levels)
    by_joins = trees.walk(rows, nodes, NAMES, trees=4, **options)
    by_tasks = trees.walk(rows, nodes, NAMES, trees=4, n_nodes=model.totalNumNodes, **options)
    assert by_tasks.schema.names == by_joins.schema.names
    assert sorted(by_tasks.collect()) == sorted(by_joins.collect())
    for n_nodes, joined in ((model.totalNumNodes, False), (trees.MAX_TARGETS + 1, True)):
        means = trees.mean_predictions(rows, nodes, NAMES, sizes=(1, 4), n_nodes=n_nodes, keep=["id"], **options)
        assert ("Join" in means._jdf.queryExecution().optimizedPlan().toString()) is joined
        got = {r["id"]: r for r in means.collect()}
        assert len(got) == 240
        for d in depths:
            for s in splits:
                say = by_hand(nodes, d, s)
                for r in rows.limit(30).collect():
                    assert got[r["id"]][f"m_{d}_{s}_1"] == pytest.approx(say(r)[0])
                    assert got[r["id"]][f"m_{d}_{s}_4"] == pytest.approx(np.mean(say(r)))


def test_cut_tables_and_odd_rows_go_down_in_tasks(spark, rows, model, nodes):
    """Node numbers with gaps, NaN, and no rows at all."""
    short = trees.cut(nodes, 12)
    odd = rows.select("id", *[F.when(F.col("id") % 7 == i, float("nan")).otherwise(F.col(c)).alias(c) for i, c in enumerate(NAMES)])
    levels = max(t.depth for t in model.trees)
    a, b = (trees.walk(odd.select("id", *NAMES), short, NAMES, trees=4, levels=levels, n_nodes=n, keep=["id"]) for n in (short.count(), None))
    assert sorted(a.collect()) == sorted(b.collect())
    assert trees.walk(odd.limit(0), short, NAMES, trees=4, levels=levels, n_nodes=short.count()).count() == 0
