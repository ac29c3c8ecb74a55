import pytest

from tests.panels import fleet, rows_of, small, to_spark
from wearcurve.operators.conform import source_offsets
from wearcurve.operators.features import rul_via_join
from wearcurve.operators.quality import integrity, raw_stats, source_stats
from wearcurve.operators.split import assign_folds, assign_split, split_sizes
from wearcurve.operators.summary import ROWS, Keys, layer_integrity, merge_summaries, unit_summary, write_counted
from wearcurve.plans.medallion import run

KEYED = "unit int, cycle int, source int"
LONG = [(u, c, 1 + u % 2) for u in (1, 2, 5) for c in (*range(1, 30), 70_000, 70_001, 140_000 + u)]


@pytest.fixture(scope="module")
def panel(spark):
    return spark.createDataFrame(LONG, KEYED).repartition(3)


def test_rows_and_blocks(panel):
    got = [tuple(r) for r in unit_summary(panel).filter("unit = 2").orderBy("block").collect()]
    assert got == [(2, 0, 29, 1, 29), (2, 1, 2, 70_000, 70_001), (2, 2, 1, 140_002, 140_002)]


def test_parts_merge_to_the_whole(panel):
    whole = unit_summary(panel, by=("source",))
    parts = [unit_summary(panel.filter(f"cycle % 3 = {i}"), by=("source",)) for i in range(3)]
    merged = merge_summaries([*parts, unit_summary(panel.limit(0), by=("source",))], by=("source",))
    order = ("source", "unit", "block")
    assert rows_of(merged.select(whole.columns), *order) == rows_of(whole, *order)
    with pytest.raises(ValueError):
        merge_summaries([])


def test_reports_of_a_summary_equal_those_of_the_panel(panel):
    summary = unit_summary(panel, by=("source",)).cache()
    assert rows_of(integrity(summary, 3, rows=ROWS), "n_rows") == rows_of(integrity(panel, 3), "n_rows")
    assert rows_of(raw_stats(summary, rows=ROWS), "n_rows") == rows_of(raw_stats(panel), "n_rows")
    assert rows_of(source_stats(summary, rows=ROWS), "source") == rows_of(source_stats(panel), "source")
    for by in ("count", "max"):
        got, want = (source_offsets(df, offset_by=by) for df in (summary, panel))
        assert rows_of(got, "source") == rows_of(want, "source")


def test_splits_folds_and_labels_from_a_summary(spark):
    panel = to_spark(spark, fleet([40, 3, 90, 1, 25, 60], seed=3)).select("unit", "cycle")
    panel = panel.union(spark.createDataFrame([(7, 10 + 40_000 * i) for i in range(50)], "unit int, cycle int"))
    summary = unit_summary(panel).cache()
    order = ("unit", "cycle")
    assert rows_of(assign_split(panel, summary=summary), *order) == rows_of(assign_split(panel), *order)
    sizes = split_sizes(assign_split(summary), rows=ROWS)
    assert rows_of(sizes, "split") == rows_of(split_sizes(assign_split(panel)), "split")
    for k in (2, 3, 7):
        assert rows_of(assign_folds(panel, k, summary=summary), *order) == rows_of(assign_folds(panel, k), *order)
    assert rows_of(rul_via_join(panel, summary=summary), *order) == rows_of(rul_via_join(panel), *order)


def test_nulls_and_empty(spark):
    odd = small(spark, [(1, 1, 0.0), (None, 2, 0.0), (1, None, 0.0), (None, None, 0.0)])
    assert rows_of(integrity(unit_summary(odd), 1, rows=ROWS), "n_rows") == rows_of(integrity(odd, 1), "n_rows") == [(4, 1, False)]
    none = odd.limit(0)
    assert rows_of(integrity(unit_summary(none), 1, rows=ROWS), "n_rows") == rows_of(integrity(none, 1), "n_rows")


def test_write_jobs_count_their_keys(spark, panel, tmp_path):
    a, keys = write_counted(panel, str(tmp_path / "a"))
    b, again = write_counted(panel.repartition(7).select("cycle", "unit"), str(tmp_path / "b"))
    c, other = write_counted(panel.selectExpr("unit", "cycle + 1 AS cycle"), str(tmp_path / "c"))
    d, fewer = write_counted(panel.filter("unit <> 5"), str(tmp_path / "d"))
    assert keys == again and keys.n_rows == len(LONG) == other.n_rows and other != keys
    assert write_counted(panel.limit(0), str(tmp_path / "e"))[1] == Keys(0, 0)
    layers = {"a": (a, keys), "b": (b, again), "c": (c, other), "d": (d, fewer)}
    report = layer_integrity(layers, unit_summary(panel), keys, 3)
    n = len(LONG)
    assert rows_of(report, "layer") == [("a", n, 3, False), ("b", n, 3, False), ("c", n, 3, False), ("d", n * 2 // 3, 2, True)]


def test_reports_of_a_run_read_no_layer(spark, tmp_path):
    """Integrity and shared ids of written layers come from the summaries beside them."""
    rows = fleet([9, 4], gaps=False, missing=0.0)
    path = tmp_path / "train_1.txt"
    path.write_text("\n".join(" ".join(map(str, r)) for r in rows.astype(object).to_numpy()) + "\n")
    layers = run(spark, [str(path)], str(tmp_path / "out"), expected_units=2)
    assert rows_of(layers["integrity"], "n_rows", "layer") == [(x, 13, 2, False) for x in ("bronze", "cleaned", "gold", "silver")]
    for name in ("integrity", "shared_units"):
        read = {f.split("/out/")[1].split("/")[0] for f in layers[name].inputFiles()}
        assert read == {"summary"}
