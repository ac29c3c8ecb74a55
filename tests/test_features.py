import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.panels import fleet, rows_of, small, to_spark
from wearcurve.operators import features
from wearcurve.operators.conform import cast_columns
from wearcurve.operators.ordered import hot_units, number_rows
from wearcurve.schema import RATIOS, TREND_SENSORS


def mean(values):
    """Mean of the readings that are there."""
    there = [v for v in values if not math.isnan(v)]
    return sum(there) / len(there) if there else math.nan


def expected(pdf):
    """Label and features of a panel, unit by unit and row by row, from their definitions."""
    lives = {}
    for row in pdf.to_dict("records"):
        lives.setdefault(row["unit"], []).append(row)
    out = []
    for life in lives.values():
        life.sort(key=lambda row: row["cycle"])
        last = life[-1]["cycle"]
        for at, row in enumerate(life):
            made = dict(row, RUL=last - row["cycle"])
            for s in TREND_SENSORS:
                made[f"{s}_roll5_mean"] = mean([float(r[s]) for r in life[max(0, at - 4) : at + 1]])
                step = float(row[s]) - float(life[at - 1][s]) if at else 0.0
                made[f"{s}_delta1"] = 0.0 if math.isnan(step) else step
            for name, (a, b) in RATIOS.items():
                made[name] = np.float32(row[a]) / (np.float32(row[b]) + np.float32(1e-6))
            made["cycle_norm"] = row["cycle"] / last
            made["health_index"] = 1 - row["cycle"] / last
            out.append(made)
    out.sort(key=lambda row: (row["unit"], row["cycle"]))
    return pd.DataFrame(out)


def check(got, want):
    got = got.toPandas().sort_values(["unit", "cycle"]).reset_index(drop=True)
    assert set(got.columns) == set(want.columns) and len(got) == len(want)
    for c in want.columns:
        np.testing.assert_allclose(
            got[c].astype("float64"), want[c].astype("float64"), rtol=1e-6, atol=1e-6, err_msg=c)


@pytest.mark.parametrize("blocks", [{}, {"hot_rows": 20, "block_bits": 3}, {"hot_rows": 0, "block_bits": 6}])
def test_engineer_matches_pandas_whatever_the_blocks(spark, blocks):
    pdf = fleet([1, 2, 4, 5, 30, 200, 77])
    df = to_spark(spark, pdf).repartition(7, "T24")
    check(features.engineer(df, **blocks), expected(pdf))


def test_blocks_without_gaps_and_with_long_gaps(spark):
    for gaps in (False, True):
        pdf = fleet([60, 3], seed=3, gaps=gaps, missing=0.3)
        check(features.engineer(to_spark(spark, pdf), hot_rows=10, block_bits=1), expected(pdf))


def test_row_frame_ignores_gaps_and_order(spark):
    df = small(spark, [(1, 30, 6.0), (1, 1, 2.0), (1, 9, 4.0), (2, 5, 1.0)])
    got = features.add_delta(features.add_rolling_mean(df, ("s",), 2), ("s",))
    assert rows_of(got.select("unit", "cycle", "s_roll2_mean", "s_delta1"), "unit", "cycle") == [
        (1, 1, 2.0, 0.0), (1, 9, 3.0, 2.0), (1, 30, 5.0, 2.0), (2, 5, 1.0, 0.0)]


def test_missing_readings(spark):
    df = small(spark, [(1, 1, math.nan), (1, 2, 2.0), (1, 3, None), (1, 4, 8.0)])
    df = cast_columns(df, {"s": df.schema["s"].dataType})
    got = features.add_delta(features.add_rolling_mean(df, ("s",), 5), ("s",))
    assert rows_of(got.select("s_roll5_mean", "s_delta1", "cycle"), "cycle") == [
        (None, 0.0, 1), (2.0, 0.0, 2), (2.0, 0.0, 3), (5.0, 0.0, 4)]


def test_ratio_at_float_precision(spark):
    rows = [(1, 1, 1.0, 3.0), (1, 2, 1.0, 0.0), (1, 3, 1.0, -1e-6), (1, 4, None, 1.0), (1, 5, 518.67, 642.1)]
    df = spark.createDataFrame(rows, "unit int, cycle int, a float, b float")
    got = [r["r"] for r in features.add_ratios(df, {"r": ("a", "b")}).orderBy("cycle").collect()]
    third = np.float32(1.0) / (np.float32(3.0) + np.float32(1e-6))
    last = np.float32(518.67) / (np.float32(642.1) + np.float32(1e-6))
    assert got[0] == third and got[4] == last
    assert got[1] == pytest.approx(1e6) and got[2] is None and got[3] is None


def test_label_forms_agree_and_invariants(spark):
    pdf = fleet([10, 1, 25], gaps=False, missing=0.0)
    df = to_spark(spark, pdf)
    window = rows_of(features.add_rul(df).select("unit", "cycle", "RUL"), "unit", "cycle")
    blocked = features.add_rul(df, hot_rows=5, block_bits=2).select("unit", "cycle", "RUL")
    joined = features.rul_via_join(df).select("unit", "cycle", "RUL")
    assert window == rows_of(joined, "unit", "cycle") == rows_of(blocked, "unit", "cycle")
    got = features.engineer(df).toPandas()
    assert (got.groupby("unit")["RUL"].min() == 0).all()
    mean = got["cycle_norm"].mean()
    assert mean == pytest.approx(0.5 + 3 / (2 * 36)) and got["health_index"].mean() == pytest.approx(1 - mean)
    by = got.sort_values(["unit", "cycle"]).groupby("unit")
    span = by["T24"].last() - by["T24"].first()
    np.testing.assert_allclose(by["T24_delta1"].sum(), span, atol=1e-3)


def test_lifecycle_can_be_left_out(spark):
    df = to_spark(spark, fleet([5]))
    names = features.engineer(df, include_lifecycle=False).columns
    assert "cycle_norm" not in names and "health_index" not in names and "T24_delta1" in names
    assert rows_of(features.add_lifecycle(small(spark, [(1, 1, 0.0), (1, 4, 0.0)])).drop("s"), "cycle") == [
        (1, 1, 0.25, 0.75), (1, 4, 1.0, 0.0)]


def test_missing_sensor_is_an_error(spark):
    with pytest.raises(KeyError):
        features.engineer(small(spark, [(1, 1, 0.0)]))


def test_many_hot_units(spark):
    """As many hot units as there are: none is left whole."""
    pdf = fleet([6] * 400, seed=9)
    df = to_spark(spark, pdf)
    hot = hot_units(df, "unit", [F.max("cycle").alias("m")], 5)
    assert hot.count() == 400
    assert hot_units(df, "unit", [], 6) is None
    check(features.engineer(df, hot_rows=5, block_bits=2), expected(pdf))


def test_plain_plan_has_one_shuffle(spark):
    plan = features.engineer(to_spark(spark, fleet([9]))).select("T24_delta1", "RUL")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_number_rows_of_hot_buckets(spark):
    """Most rows of a key in one bucket: the finer level splits it."""
    rows = [(1, 5, i // 10, i) for i in range(300)] + [(1, 4, 0, 1), (2, 5, 1, 3), (1, None, None, 9)]
    df = spark.createDataFrame(rows, "k int, day int, hour int, id int")
    order = ("day", "hour", "id")
    whole = rows_of(number_rows(df, "k", order, F.col("day"), F.col("hour"), hot_rows=10_000), "k", "cycle")
    assert rows_of(number_rows(df, "k", order, F.col("day"), F.col("hour"), hot_rows=5), "k", "cycle") == whole


def test_number_rows_of_hot_keys(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": rng.integers(0, 4, 500), "day": rng.integers(0, 12, 500), "id": np.arange(500)})
    df = spark.createDataFrame(pdf)
    want = pdf.sort_values(["day", "id"]).groupby("k").cumcount() + 1
    for hot in (0, 120, 10_000):
        got = number_rows(df, "k", ("day", "id"), F.col("day"), hot_rows=hot).toPandas().set_index("id")["cycle"]
        assert got.sort_index().tolist() == want.sort_index().tolist()


def test_tied_cycles_agree_in_plain_and_hot_plans(spark):
    """Rows that share a cycle: both plans order them alike, however the rows lie."""
    from pyspark.sql import functions as F

    from wearcurve.operators.ordered import over_units

    rng = np.random.default_rng(2)
    rows = [(int(u), int(c), float(np.float32(s))) for u, c, s in zip(rng.integers(1, 4, 600), rng.integers(1, 60, 600), rng.normal(size=600))]
    rows += rows[:20]
    build = lambda w: {"mean": F.avg("s").over(w.rowsBetween(-4, 0)), "step": F.col("s") - F.lag("s").over(w)}

    def made(rows, parts, **blocks):
        df = small(spark, rows).repartition(parts)
        out = over_units(df, build, columns=("s",), depth=4, last="last", ties=True, **blocks)
        assert out.columns == ["unit", "cycle", "s", "mean", "step", "last"]
        return sorted(map(str, out.collect()))

    plain = made(rows, 3)
    assert len(plain) == 620
    assert plain == made(rows[::-1], 5) == made(rows, 2, hot_rows=10, block_bits=2) == made(rows[::-1], 4, hot_rows=150, block_bits=0)
