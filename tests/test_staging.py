"""What the registered queries start from: written once, and small."""

import __spark_entry__ as entry_points
from wearcurve.catalog import staging

DATA = "/root/testdata/sf0.001"


def test_gold_is_read_off_its_one_written_table(spark):
    gold = staging.gold_table(spark, DATA)
    assert all("engineered.parquet" in path for path in gold.inputFiles())


def test_raw_logs_are_packed(spark):
    for path in (staging.raw_path(spark, DATA), *staging.raw_paths(spark, DATA)):
        assert all(f.endswith(".gz") for f in spark.read.text(path).inputFiles())


def test_sources_share_one_numbered_panel(spark):
    plan = entry_points.queries()["silver_union"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
