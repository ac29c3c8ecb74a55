import warnings

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.panels import rows_of, small
from wearcurve.operators import stores
from wearcurve.schema import feature_columns, require_columns
from wearcurve.sources import sinks
from wearcurve.sources.sinks import base_name, shared_dir, write_bronze, write_csv, write_parquet
from wearcurve.sources.tables import load, read_csv, read_many


def test_load_dispatch(spark, tmp_path):
    df = small(spark, [(1, 1, 0.5), (1, 2, 1.5)])
    write_parquet(df, str(tmp_path / "a.parquet"))
    write_csv(df, str(tmp_path / "a.csv"))
    want = rows_of(df, "cycle")
    assert rows_of(load(spark, str(tmp_path / "a.parquet")), "cycle") == want
    assert rows_of(load(spark, str(tmp_path / "a.csv")), "cycle") == want
    assert load(spark, df) is df
    with pytest.raises(ValueError):
        load(spark, "a.txt")


def test_all_parts_are_read_and_empty_directories_skipped(spark, tmp_path):
    df = small(spark, [(i, 1, 0.5) for i in range(8)]).repartition(4)
    write_csv(df, str(tmp_path / "a"))
    assert len(list((tmp_path / "a").glob("part-*.csv"))) > 1
    (tmp_path / "empty").mkdir()
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        found = read_many(spark, [str(tmp_path / "a"), str(tmp_path / "empty")])
    assert [d.count() for d in found] == [8] and any("skipped" in str(w.message) for w in seen)
    with pytest.raises(ValueError), warnings.catch_warnings():
        warnings.simplefilter("ignore")
        read_many(spark, [str(tmp_path / "empty")])


def test_csv_types(spark, tmp_path):
    write_csv(small(spark, [(1, 1, 0.5)]), str(tmp_path / "a"))
    assert read_csv(spark, str(tmp_path / "a")).dtypes == [("unit", "string"), ("cycle", "string"), ("s", "string")]
    assert read_csv(spark, str(tmp_path / "a"), infer=True).dtypes[0] == ("unit", "int")


def test_names(spark, tmp_path):
    assert [base_name(p) for p in ("x/train_1.txt", "train.a.txt", "d/.hidden", "d/plain/")] == [
        "train_1", "train.a", ".hidden", "plain"]
    path = write_bronze(small(spark, [(1, 1, 0.5)]), "raw/train.txt", str(tmp_path), single_file=True)
    assert path.endswith("/bronze_train") and len(list((tmp_path / "bronze_train").glob("part-*"))) == 1
    assert shared_dir(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_required_and_feature_columns(spark):
    df = spark.createDataFrame([(1, 2, 3.0, "x", 4)], "unit int, cycle int, s double, tag string, RUL int")
    assert feature_columns(df) == ["s"]
    assert require_columns(df) is df
    with pytest.raises(KeyError, match="cycle"):
        require_columns(df.drop("cycle"))


def test_declared_schema_is_matched_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cycle,other,unit\n7,x,1\nbad,y,2\n")
    schema = T.StructType([T.StructField("unit", T.IntegerType()), T.StructField("cycle", T.IntegerType())])
    assert rows_of(read_csv(spark, str(tmp_path / "a.csv"), schema), "unit") == [(1, 7), (2, None)]
    with pytest.raises(KeyError, match="absent"):
        read_csv(spark, str(tmp_path / "a.csv"), T.StructType([T.StructField("absent", T.IntegerType())]))


def test_work_folder_is_asked_for_and_released(spark, tmp_path):
    class Bare:
        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError, match="workDir"):
        shared_dir(Bare, "a")
    path = shared_dir(spark, "gone") + ".parquet"
    write_parquet(small(spark, [(1, 1, 0.5)]), path)
    before = dict(sinks._handed_out)
    sinks._handed_out[spark.sparkContext.applicationId] = [path.removesuffix(".parquet")]
    assert sinks.release(spark) == 1
    sinks._handed_out.update(before)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_buckets_grow_with_the_table(spark):
    gold = small(spark, [(i, 1, 0.5) for i in range(40)])
    assert [stores.buckets_for(gold, n) for n in (100, 5, 3, 1)] == [8, 8, 16, 64]
    assert stores.buckets_for(gold.limit(0)) == 8


def test_packed_bronze_is_read_like_plain(spark, tmp_path):
    df = small(spark, [(i, 1, 0.5) for i in range(8)])
    path = write_bronze(df, "raw/train.txt", str(tmp_path), compression="gzip")
    assert list((tmp_path / "bronze_train").glob("part-*.csv.gz"))
    assert read_csv(spark, path).count() == 8


def test_readings_of_many_values_get_a_dictionary(spark, tmp_path):
    """30,000 values in 200,000 rows: 15 bits and a share of the dictionary a row, not eight bytes."""
    value = F.sqrt(F.xxhash64(F.col("id") % 30_000).cast("double") ** 2 + 1)
    df = spark.range(0, 200_000, 1, 1).select(F.lit(1).alias("unit"), F.col("id").cast("int").alias("cycle"), value.alias("x"))
    back = write_parquet(df.drop("cycle"), str(tmp_path / "packed"))
    size = sum(f.stat().st_size for f in (tmp_path / "packed").glob("*.parquet"))
    assert size < 200_000 * 8 / 2
    assert back.agg(F.count_distinct("x"), F.count("x")).first() == (30_000, 200_000)
