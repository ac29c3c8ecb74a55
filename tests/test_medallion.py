import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.panels import fleet, rows_of
from wearcurve.operators.stores import join_stores
from wearcurve.plans.medallion import build_gold, run
from wearcurve.schema import RAW_FIELDS, feature_columns


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    paths = []
    for name, lengths in (("train_1", [12, 30]), ("train_2", [8])):
        pdf = fleet(lengths, seed=len(lengths), gaps=False, missing=0.05)[list(RAW_FIELDS)]
        path = folder / f"{name}.txt"
        path.write_text("\n".join("  ".join(map(str, r)) for r in pdf.astype(object).to_numpy()) + "\nbad line\n")
        paths.append(str(path))
    return paths


@pytest.fixture(scope="module")
def layers(spark, raw, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return run(spark, raw, str(out), expected_units=3), run(spark, raw, expected_units=3), out


def test_written_and_lazy_layers_agree(layers):
    written, lazy, _ = layers
    assert written.keys() == lazy.keys()
    for name in ("silver", "cleaned", "label_store"):
        order = ["unit", "cycle"]
        assert rows_of(written[name].select(sorted(written[name].columns)), *order) == rows_of(
            lazy[name].select(sorted(lazy[name].columns)), *order)
    a = written["gold"].toPandas().sort_values(["unit", "cycle"])
    b = lazy["gold"].toPandas().sort_values(["unit", "cycle"])[a.columns]
    np.testing.assert_allclose(a.to_numpy(float), b.to_numpy(float), atol=1e-9)


def test_reports(layers):
    written, _, _ = layers
    assert [tuple(r)[1:] for r in written["integrity"].collect()[1:]] == [(50, 3, False)] * 3
    assert written["rejects"].count() == 2
    assert written["duplicate_keys"].count() == 0 and written["shared_units"].count() == 0


def test_gold_contract(layers, spark):
    written, _, out = layers
    features = feature_columns(written["gold"])
    assert len(features) == 35 and features[:4] == ["op_setting_1", "op_setting_2", "op_setting_3", "T24"]
    assert features[15:17] == ["T24_roll5_mean", "T24_delta1"] and features[-2:] == ["cycle_norm", "health_index"]
    assert [r["feature"] for r in written["feature_metadata"].collect()] == features
    assert written["silver"].select("unit").distinct().count() == 3
    joined = join_stores(written["feature_store"], written["label_store"])
    assert joined.count() == 50 and set(joined.columns) == set(written["gold"].columns)
    names = {"gold_full.parquet", "feature_store.parquet", "label_store.parquet", "feature_metadata.csv"}
    assert names <= {p.name for p in (out / "gold").iterdir()}
    folders = {p.name for p in (out / "bronze").iterdir() if p.is_dir()}
    assert folders == {"dataset=bronze_train_1", "dataset=bronze_train_2"}


def test_plan_does_not_grow_with_the_files(spark, raw, tmp_path):
    from wearcurve.sources.text_log import read_raws

    more = []
    for i in range(9):
        (tmp_path / f"more {i}.txt").write_text((tmp_path / raw[i % 2]).read_text())
        more.append(str(tmp_path / f"more {i}.txt"))
    few, many = (read_raws(spark, p).rows for p in (raw, more))
    nodes = [df._jdf.queryExecution().optimizedPlan().toString().count("\n") for df in (few, many)]
    assert nodes[0] == nodes[1]
    sizes = {r["source"]: r["count"] for r in many.groupBy("source").count().collect()}
    assert sizes == {i: 42 if i % 2 else 8 for i in range(1, 10)}


def test_bad_calls(spark, raw):
    with pytest.raises(ValueError):
        run(spark, [])
    with pytest.raises(ValueError):
        run(spark, [raw[0], raw[0].replace("/train_1", "/../x/train_1")], "/tmp/unused")
    with pytest.raises(ValueError):
        build_gold(spark, "silver.txt")


def test_gold_outputs_are_scans(spark, layers):
    gold = build_gold(spark, layers[0]["cleaned"])

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    for df in (gold.full, gold.features, gold.labels, gold.metadata):
        assert "Window" not in plan(df) and "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)
    assert "Exchange" not in plan(gold.labels) and "ReadSchema: struct<unit:int,cycle:int,RUL:int>" in plan(gold.labels)


def test_features_take_one_sort_and_no_cross_join(spark, layers):
    from wearcurve.operators.features import engineer

    text = engineer(layers[0]["cleaned"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [") == 1 and text.count("Sort [") == 1 and text.count("Exchange") == 1
    blocked = engineer(layers[0]["cleaned"], hot_rows=5, block_bits=2)._jdf.queryExecution().executedPlan().toString()
    main = blocked[: blocked.index("Union")]
    assert main.count("Window [") == 1 and main.count("Sort [") == 1
    assert "NestedLoop" not in text + blocked and "Cartesian" not in text + blocked


def test_split_and_folds_move_no_rows(spark, layers):
    from wearcurve.operators.split import assign_folds, assign_split

    for df in (assign_split(layers[0]["cleaned"]), assign_folds(layers[0]["cleaned"])):
        text = df._jdf.queryExecution().executedPlan().toString()
        main = "\n".join(x for x in text.split("\n") if not x.lstrip().startswith(":"))
        assert "Exchange" not in main.split("Subquery")[0] and "Sort [" not in main.split("Subquery")[0]


def test_statistics_of_the_training_units_only(spark, layers):
    from wearcurve.operators.normalize import fit_metadata
    from wearcurve.operators.split import split_rows

    cleaned = layers[0]["cleaned"]
    gold = build_gold(spark, cleaned, fit_on="train")
    got = {r["feature"]: r["mean"] for r in gold.metadata.collect()}
    want = {r["feature"]: r["mean"] for r in fit_metadata(split_rows(cleaned, "train")).collect()}
    assert len(got) == 35 and all(got[c] == want[c] for c in want)
    assert gold.full.count() == cleaned.count()


def _log(folder, name, unit, rows=5):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(f"{unit} {c} " + " ".join(["1.5"] * 24) + "\n" for c in range(1, rows + 1)))


@pytest.mark.parametrize("written", [False, True])
@pytest.mark.parametrize(
    "given, sizes",
    [
        (["train_*.txt"], [5, 3]),
        (["train_2.txt", "train_1.txt"], [3, 5]),
        (["odd name %41 [x].txt", "t*_1.txt"], [4, 5]),
        (["deep"], [13]),
        (["deep/*"], [6, 7]),
        (["train_?.txt", "deep/a=1"], [5, 3, 6]),
        (["nothing here/", "train_1.txt"], [0, 5]),
    ],
)
def test_no_row_is_lost_whatever_names_the_files(spark, tmp_path, given, sizes, written):
    raw = tmp_path / "raw logs"
    _log(raw, "train_1.txt", 1)
    _log(raw, "train_2.txt", 1, 3)
    _log(raw, "odd name %41 [x].txt", 2, 4)
    _log(raw / "deep" / "a=1", "part-0.txt", 1, 4)
    _log(raw / "deep" / "a=1" / "more", "part-1.txt", 3, 2)
    _log(raw / "deep" / "b", "part-0.txt", 1, 7)
    _log(raw / "deep" / "b", "_SUCCESS", 9, 7)
    (raw / "nothing here").mkdir()
    layers = run(spark, [f"{raw}/{g}" for g in given], str(tmp_path / "out") if written else None)
    rows = {r["source"]: r["count"] for r in layers["silver"].groupBy("source").count().collect()}
    assert rows == {i: n for i, n in enumerate(sizes, start=1) if n}
    assert layers["bronze"].count() == layers["gold"].count() == sum(sizes)


def test_paths_without_data_or_given_twice(spark, tmp_path):
    _log(tmp_path, "a.txt", 1)
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError, match="nothing at"):
        run(spark, [f"{tmp_path}/b*.txt"])
    with pytest.raises(ValueError, match="given twice"):
        run(spark, [f"{tmp_path}/a.txt", f"{tmp_path}/*.txt"])
    with pytest.raises(ValueError, match="no data"):
        run(spark, [f"{tmp_path}/empty"])


def test_co_located_stores_join_without_an_exchange(spark, layers):
    from wearcurve.operators.stores import feature_store, label_store, write_co_located

    gold = layers[0]["gold"]
    features, labels = write_co_located(gold, 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_stores(features, labels)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        apart = join_stores(feature_store(gold), label_store(gold))
        assert "Exchange" in apart._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    columns = sorted(joined.columns)
    assert rows_of(joined.select(columns), "unit", "cycle") == rows_of(apart.select(columns), "unit", "cycle")


def test_stores_are_dealt_before_they_are_scaled(spark, layers):
    """What is moved holds no scaled reading and nothing that follows from the row itself; the stores are those of gold."""
    from wearcurve.operators.features import ROW_FEATURES
    from wearcurve.operators.stores import write_co_located
    from wearcurve.plans.medallion import build_gold

    cleaned = layers[0]["cleaned"].withColumn("T30", F.when(F.col("cycle") % 7 != 0, F.col("T30")))
    found = build_gold(spark, cleaned)
    assert set(found.full.columns) - set(found.narrow.columns) == set(ROW_FEATURES)
    stored = spark.read.parquet(found.narrow.inputFiles()[0].rsplit("/", 1)[0])
    assert not set(ROW_FEATURES) & set(stored.columns)
    features, labels = write_co_located(found.narrow, 4, finish=found.scaled)
    assert features.columns == found.features.columns and features.dtypes == found.features.dtypes
    got, want = (df.toPandas().sort_values(["unit", "cycle"]).to_numpy(float) for df in (features, found.features))
    assert np.isnan(want).any()
    np.testing.assert_allclose(got, want, atol=1e-9)
    assert rows_of(labels, "unit", "cycle") == rows_of(found.labels, "unit", "cycle")
