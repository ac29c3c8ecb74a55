import duckdb
import pandas as pd
import pytest

from tests.llm.conftest import DATA
from wearcurve.llm import mixing
from wearcurve.llm.queries import ORACLES


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, stop at the limit, share the excess again, until no target is above its limit."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return {s: share.get(s, most * sizes[s]) for s in order}
        capped |= over


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 10, "c": 10, "d": 500, None: 3},
    {"a": 5, "b": 5}, {"z": 7}, {"a": 0, "b": 9}, {f"s{i}": 10**i for i in range(8)},
])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(targets_by_hand(sizes))


def test_table(spark, docs):
    got = mixing.taken(docs).toPandas().sort_values("doc_id", ignore_index=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.sql(ORACLES["op3_mixing"]).df().sort_values("doc_id", ignore_index=True)
    pd.testing.assert_frame_equal(got, want)
    assert (got["taken"] <= 3 * got["size"]).all()
    source = got.merge(docs.select("doc_id", "source").toPandas(), on="doc_id")
    sums = source.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert (abs(sums["taken"] - sums["target"]) <= sums["most"] / 2 + 1e-6).all()
    again = mixing.taken(docs.repartition(7)).toPandas().sort_values("doc_id", ignore_index=True)
    assert got.equals(again)


def test_slices_give_the_plain_ranking(spark, monkeypatch):
    """One source with many rows: the cut by slices is the cut of the whole ranking."""
    rows = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat('w ', int(1 + id % 40)) AS text", "if(id % 5 = 0, 'b', 'a') AS source"
    )
    want = sorted(map(tuple, mixing.taken(rows).collect()))
    monkeypatch.setattr(mixing, "SLICES", 1)
    assert sorted(map(tuple, mixing.taken(rows).collect())) == want


def test_odd_rows(odd_docs, no_docs):
    got = mixing.taken(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    out = mixing.mixed(odd_docs)
    assert out.columns == odd_docs.columns
    assert mixing.words_in().alias("n") is not None
    words = out.select(mixing.words_in().alias("n")).groupBy().sum("n").first()[0]
    assert words == sum(r["taken"] for r in got)
    assert mixing.taken(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
