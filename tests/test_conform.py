import math

import numpy as np
import pandas as pd
import pytest

from tests.panels import rows_of, small
from wearcurve.operators import conform, quality


def test_cast(spark):
    df = spark.createDataFrame(
        [("1.0", "2", "0.5", "a"), ("2", "3", "NaN", "b"), ("3", "4", "bad", "c"), ("x", "5", None, "d")],
        "unit string, cycle string, T24 string, other string",
    )
    got = conform.cast_columns(df)
    assert got.dtypes == [("unit", "int"), ("cycle", "int"), ("T24", "float"), ("other", "string")]
    assert rows_of(got, "other") == [(1, 2, 0.5, "a"), (2, 3, None, "b"), (3, 4, None, "c"), (None, 5, None, "d")]


def test_cast_of_nan_and_doubles(spark):
    df = spark.createDataFrame([(1, 1.0, math.nan), (2, 2.0, 0.1)], "unit bigint, cycle double, T24 double")
    got = rows_of(conform.cast_columns(df), "unit")
    assert got[0] == (1, 1, None) and got[1][:2] == (2, 2) and abs(got[1][2] - 0.1) < 1e-7


def test_drops_ignore_absent_columns(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "unit int, epr float, NRc float")
    assert conform.drop_constant(df).columns == ["unit", "NRc"]
    assert conform.drop_correlated(df).columns == ["unit", "epr"]


def sources(spark):
    return [
        small(spark, [(1, 1, 1.0), (2, 1, 2.0)]),
        small(spark, [(1, 1), (7, 1)], "unit int, cycle int"),
        small(spark, [(1, 1, 3.0)]),
    ]


def test_union_by_name(spark):
    got = conform.union_sources(sources(spark))
    assert got.filter("source = 2 AND s IS NULL").count() == 2 and got.count() == 5
    with pytest.raises(ValueError):
        conform.union_sources([])


def test_offsets(spark):
    union = conform.union_sources(sources(spark))
    shifted = {m: conform.shift_units(union, offset_by=m) for m in ("count", "max")}
    units = {m: [tuple(r) for r in d.select("source", "unit").orderBy("source", "unit").collect()] for m, d in shifted.items()}
    assert units["count"] == [(1, 1), (1, 2), (2, 3), (2, 9), (3, 5)]
    assert units["max"] == [(1, 1), (1, 2), (2, 3), (2, 9), (3, 10)]
    assert shifted["count"].schema["unit"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        conform.source_offsets(union, offset_by="other")


def test_collision_after_count_offset(spark):
    union = conform.union_sources([small(spark, [(1, 1, 0.0), (2, 1, 0.0), (5, 1, 0.0)]), small(spark, [(2, 1, 0.0)])])
    assert rows_of(conform.shared_units(conform.shift_units(union)), "unit") == [(5, 2)]
    assert conform.shared_units(conform.shift_units(union, offset_by="max")).count() == 0


def test_quality_reports(spark):
    df = small(spark, [(1, 1, 0.0), (1, 1, 0.0), (4, 2, 0.0)])
    assert tuple(quality.integrity(df, 2).first()) == (3, 2, False)
    assert tuple(quality.integrity(df).first()) == (3, 2, True)
    assert tuple(quality.integrity(df, None).first()) == (3, 2, False)
    assert tuple(quality.raw_stats(df).first()) == (3, 2, 1, 4)
    assert rows_of(quality.duplicate_keys(df), "unit") == [(1, 1, 2)]
    layers = quality.integrity_by_layer({"a": df, "b": df.filter("unit = 4")}, 2)
    assert rows_of(layers, "layer") == [("a", 3, 2, False), ("b", 1, 1, True)]


def test_correlations_of_pairs_with_gaps(spark):
    from wearcurve.operators.conform import constant_columns, correlated_pairs, redundant_columns

    rng = np.random.default_rng(1)
    a = rng.normal(size=400)
    table = pd.DataFrame({
        "a": 2388 + a / 1000, "b": rng.normal(size=400), "c": 5 - 3 * a, "fixed": 7.0, "none": np.nan, "once": np.nan,
    })
    table.loc[::7, "b"] = np.nan
    table.loc[::5, "c"] = np.nan
    table.loc[3, "once"] = 1.0
    clean = table.astype(object).where(table.notna(), None)
    df = spark.createDataFrame([tuple(r) for r in clean.itertuples(index=False)], ", ".join(f"{c} double" for c in table))
    found = {(r["a"], r["b"]): r for r in correlated_pairs(df, list(table)).collect()}
    for (x, y), r in found.items():
        both = table[[x, y]].dropna()
        assert r["n"] == len(both)
        want = both[x].corr(both[y]) if both[x].nunique() > 1 and both[y].nunique() > 1 else None
        assert r["r"] == (None if want is None else pytest.approx(want, abs=1e-9))
    read = [c for c in table if c != "none"]
    assert set(found) == {(x, y) for i, x in enumerate(read) for y in read[i + 1 :]}
    pairs = correlated_pairs(df, list(table))
    assert redundant_columns(pairs, ["a", "b", "c"]) == ["c"] and redundant_columns(pairs, ["c", "b", "a"]) == ["a"]
    told = {r["feature"]: (r["n"], r["is_constant"]) for r in constant_columns(df, list(table)).collect()}
    assert told == {"a": (400, False), "b": (342, False), "c": (320, False), "fixed": (400, True), "none": (0, True), "once": (1, True)}


def test_correlations_with_gaps_and_odd_values_in_one_row_a_task(spark):
    """Against numpy over the rows that hold both; no row is multiplied by the number of pairs."""
    rng = np.random.default_rng(4)
    x = 2388 + 0.01 * rng.standard_normal((500, 4))
    x[:, 1] += x[:, 0] - 2388
    x[:, 3] = 7.0
    values = [[None if (r + c) % 5 == 0 and c else float(x[r, c]) for c in range(4)] + [float("inf") if r == 3 else float(r), None] for r in range(500)]
    names = list("abcdef")
    df = spark.createDataFrame(values, ", ".join(f"{n} double" for n in names)).repartition(7)
    pairs = conform.correlated_pairs(df, names)
    assert "Generate" not in pairs._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["a"], r["b"]): (r["n"], r["r"]) for r in pairs.collect()}
    full = np.array([[np.nan if v is None else v for v in row] for row in values], float)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        both = ~np.isnan(full[:, i]) & ~np.isnan(full[:, j])
        n, r = got[names[i], names[j]]
        assert n == both.sum() and r == pytest.approx(np.corrcoef(full[both, i], full[both, j])[0, 1])
    assert got["a", "d"][1] is None and np.isnan(got["a", "e"][1]) and len(got) == 10
    assert conform.correlated_pairs(df.limit(0), names).count() == 0
