import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.panels import fleet, to_spark
from wearcurve.operators import normalize
from wearcurve.schema import feature_columns


def test_population_deviation_and_constants(spark):
    rows = [(1, 1, 1.0, 518.67, None, 5.0), (1, 2, 3.0, 518.67, None, None), (1, 3, 8.0, 518.67, None, 7.0)]
    df = spark.createDataFrame(rows * 50, "unit int, cycle int, a float, fixed float, none float, part double")
    scaled, metadata = normalize.standardize(df.repartition(5))
    stats = {r["feature"]: (r["mean"], r["std"]) for r in metadata.collect()}
    assert stats["a"] == pytest.approx((4.0, np.std([1, 3, 8])))
    assert stats["fixed"] == (float(np.float32(518.67)), 1.0) and stats["none"] == (None, None)
    assert stats["part"] == pytest.approx((6.0, 1.0))
    got = scaled.filter("cycle = 2").first()
    assert got["fixed"] == 0.0 and got["none"] is None and got["part"] is None
    assert got["a"] == pytest.approx((3 - 4) / np.std([1, 3, 8]))


def test_scaled_columns_are_standard(spark):
    df = to_spark(spark, fleet([50, 70, 20], missing=0.2))
    scaled, _ = normalize.standardize(df)
    pdf = scaled.toPandas()
    for c in feature_columns(df):
        assert pdf[c].mean() == pytest.approx(0, abs=1e-9) and pdf[c].std(ddof=0) == pytest.approx(1)


def test_fit_on_a_part_and_apply_saved(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (1, 2, 2.0), (2, 1, 11.0)], "unit int, cycle int, a double")
    metadata = normalize.fit_metadata(df, fit_on=F.col("unit") == 1)
    got = [r["a"] for r in normalize.apply_metadata(df, metadata).orderBy("unit", "cycle").collect()]
    assert got == [-1.0, 1.0, 10.0]


def test_mean_beside_a_small_deviation(spark):
    values = 1e6 + np.arange(3000) * 1e-7
    df = spark.createDataFrame([(1, i, float(v)) for i, v in enumerate(values)], "unit int, cycle int, a double")
    means = {normalize.fit_metadata(df.repartition(n)).first()["mean"] for n in (1, 3, 8)}
    assert len(means) == 1 and abs(means.pop() - values.mean()) < 1e-9


def test_fill(spark):
    df = spark.createDataFrame([(1, None, None)], "unit int, a double, b double")
    assert tuple(normalize.fill_missing(df, ["a"]).first()) == (1, 0.0, None)


def test_missing_metadata_is_an_error_with_names(spark):
    df = spark.createDataFrame([(1, 1, 0.0, 1.0, 2.0)], "unit int, cycle int, a double, b double, c double")
    metadata = normalize.fit_metadata(df, ["a"])
    with pytest.raises(Exception, match="lacks the features b, c"):
        normalize.apply_metadata(df, metadata).collect()
