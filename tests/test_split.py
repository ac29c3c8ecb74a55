import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.panels import small
from wearcurve.operators import split
from wearcurve.operators.positions import rows_at


def order_of(units, seed=42):
    return sorted(units, key=lambda u: (hashlib.md5(f"{seed}:{u}".encode()).hexdigest(), u))


@pytest.mark.parametrize("n", [1, 2, 3, 7, 20, 100, 600])
def test_split_cuts(spark, n):
    units = [u * 3 - 7 for u in range(n)]
    got = {r["unit"]: r["split"] for r in split.unit_split(small(spark, [(u, 1, 0.0) for u in units])).collect()}
    order = order_of(units)
    a, b = int(n * 0.7), int(n * 0.85)
    want = {u: "train" if i < a else "val" if i < b else "test" for i, u in enumerate(order)}
    assert got == want


def test_reference_sizes_and_seed(spark):
    df = small(spark, [(u, c, 0.0) for u in range(600) for c in (1, 2)])
    sizes = {r["split"]: (r["n_rows"], r["n_units"]) for r in split.split_sizes(split.assign_split(df)).collect()}
    assert sizes == {"train": (840, 420), "val": (180, 90), "test": (180, 90)}
    other = split.split_rows(df, "train", seed=7).select("unit").distinct()
    assert other.count() == 420 and other.exceptAll(split.split_rows(df, "train").select("unit").distinct()).count() > 0


@pytest.mark.parametrize("n,k", [(1, 3), (2, 3), (3, 3), (10, 3), (101, 4), (300, 3)])
def test_folds(spark, n, k):
    rng = np.random.default_rng(n)
    units = np.sort(rng.choice([-70000, 3, 9, 80000, 200000], size=n))
    pdf = pd.DataFrame({"unit": units})
    pdf["cycle"] = pdf.groupby("unit").cumcount() * 30011 + 1
    df = spark.createDataFrame([tuple(map(int, r)) for r in pdf.sample(frac=1, random_state=0).to_numpy()], "unit int, cycle int")
    got = [r["fold"] for r in split.assign_folds(df, k).orderBy("unit", "cycle").collect()]
    sizes = [n // k + (i < n % k) for i in range(k)]
    assert got == [i for i, s in enumerate(sizes) for _ in range(s)]


def test_rows_at_positions(spark):
    values = list(range(-50, 400_000, 3001))
    rows = spark.createDataFrame([(v,) for v in values], "v int").withColumn("hi", F.shiftright("v", 16))
    counts = rows.groupBy("hi").agg(F.count(F.lit(1)).alias("_n"))
    asked = [1, 2, 22, 23, 100, len(values), len(values) + 1, 0]
    targets = spark.createDataFrame([(i, p) for i, p in enumerate(asked)], "target int, position int")
    got = {r["target"]: r["v"] for r in rows_at(counts, rows, targets, ["hi", "v"], n_targets=8).collect()}
    assert got == {i: values[p - 1] for i, p in enumerate(asked) if 1 <= p <= len(values)}


def test_bootstrap(spark):
    lengths = {u: u % 5 + 1 for u in range(40)}
    df = small(spark, [(u, c, float(u)) for u, n in lengths.items() for c in range(1, n + 1)])
    draws = {r["draw"]: r["unit"] for r in split.bootstrap_draws(df, 25).collect()}
    tests = order_of(lengths)[int(40 * 0.85):]
    pick = lambda i: int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) % len(tests)
    assert draws == {i: tests[pick(i)] for i in range(1, 26)}
    got = Counter(r["unit"] for r in split.bootstrap(df, 25).collect())
    assert got == {f"OOT_{i}": lengths[u] for i, u in draws.items()}


def test_more_targets_than_can_be_broadcast_are_refused(spark, monkeypatch):
    from wearcurve.operators import positions

    df = small(spark, [(u, 1, 0.0) for u in range(9)])
    monkeypatch.setattr(positions, "MAX_TARGETS", 3)
    with pytest.raises(ValueError, match="targets"):
        split.bootstrap(df, 5)
