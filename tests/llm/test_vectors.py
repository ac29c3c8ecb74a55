import math

import numpy as np
import pyarrow as pa
import pytest

from wearcurve.llm import vectors


def by_hand(rows, threshold=0.9):
    ok = {
        i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64))
        for i, v in rows.items()
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    links = {i: set() for i in rows}
    for i, x in ok.items():
        for j, y in ok.items():
            if i != j and len(x) == len(y) and x @ y >= threshold:
                links[i].add(j)
    least = {}
    for i in sorted(rows):
        if i not in least:
            seen, todo = {i}, [i]
            while todo:
                for j in links[todo.pop()] - seen:
                    seen.add(j)
                    todo.append(j)
            least |= dict.fromkeys(seen, i)
    return {i: (len(links[i]), least[i], least[i] == i) for i in rows}


def got_of(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_groups_chains_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = {i: rng.standard_normal(16).astype(np.float32).tolist() for i in range(200)}
    for i in range(200, 420):  # copies of one, close copies of others
        base = np.array(rows[i % 7 if i % 2 else 3])
        rows[i] = (base + rng.standard_normal(16) * (0.05 if i % 2 else 0)).astype(np.float32).tolist()
    angle = 0.0
    for i in range(420, 450):  # a chain whose ends are far apart
        rows[i] = [math.cos(angle), math.sin(angle)] + [0.0] * 14
        angle += 0.3
    rows |= {500: None, 501: [], 502: [0.0] * 16, 503: [math.nan] + rows[3][1:], 504: [math.inf] + rows[3][1:]}
    rows |= {505: [None] + rows[3][1:], 506: [1.0, 2.0], 507: [2.0, 4.0], 508: [x * 3 for x in rows[3]]}
    frame = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>")
    frame = frame.selectExpr("*", "1 AS id", "2 AS component", "'x' AS kept")
    assert got_of(vectors.near_copies(frame.repartition(5))) == by_hand(rows)
    again = frame.union(frame.limit(20)).union(spark.createDataFrame([(None, [1.0], 1, 2, "x")], frame.schema))
    got = vectors.near_copies(again).collect()
    assert len(got) == len(rows) + 1
    assert {r["vec_id"]: r["n_links"] for r in got if r["vec_id"] is not None} == {
        i: n for i, (n, _, _) in by_hand(rows).items()
    }


def test_empty(spark):
    assert vectors.near_copies(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r["vec_id"]: r["embedding"] for r in table.collect()}
    assert got_of(vectors.near_copies(table)) == by_hand(rows)


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def planted(n, pairs, cosine, hot, seed):
    """Random directions with isolated pairs; a third of all and the pairs in one loose topic where ``hot``."""
    rng = np.random.default_rng(seed)
    x, topic = unit(rng.standard_normal((n, 64))), unit(rng.standard_normal((1, 64)))
    if hot:
        x[: n // 3] = unit(topic * 0.6**0.5 + x[: n // 3] * 0.4**0.5)
    away = rng.standard_normal((pairs, 64))
    away = unit(away - (away * x[:pairs]).sum(1, keepdims=True) * x[:pairs])
    if hot:  # stay in the topic
        away = unit(topic * 0.5 + away * 0.5)
        away = unit(away - (away * x[:pairs]).sum(1, keepdims=True) * x[:pairs])
    mate = x[:pairs] * cosine + away * (1 - cosine**2) ** 0.5
    return np.concatenate([x, mate]).astype(np.float32)


def frame_of(spark, x):
    lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))
    return spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": lists})).repartition(8)


@pytest.mark.parametrize(("n", "hot"), [(10_000, False), (60_000, False), (30_000, True)])
def test_isolated_pairs(spark, n, hot):
    pairs = 400
    got = got_of(vectors.near_copies(frame_of(spark, planted(n, pairs, 0.905, hot, 1))))
    assert sum(got[n + i][1] == i for i in range(pairs)) >= vectors.RECALL * pairs


def test_passes_of_a_hot_topic(spark):
    """Passes alone, as many as the crowd asks for."""
    n, pairs = 30_000, 400
    x = planted(n, pairs, 0.905, True, 2)
    few = vectors.passes_for(unit(planted(n, 0, 0.9, False, 2)[:1024].astype(float)), n, 0.9, vectors.WINDOW)
    sample = x[np.random.default_rng(0).choice(n, 1024, replace=False)].astype(float)
    number = vectors.passes_for(unit(sample), len(x), 0.9, vectors.WINDOW)
    assert 5 < few < number < 100
    got = got_of(vectors.near_copies(frame_of(spark, x), passes=int(number)))
    assert sum(got[n + i][1] == i for i in range(pairs)) >= vectors.RECALL * pairs


def test_passes_grow_with_rows():
    none = np.empty((0, 64))
    assert [vectors.passes_for(none, n, 0.9, 64, 0.95) for n in (50, 10**4, 10**6, 10**8)] == [1, 8, 25, 72]


def clustered(n, topics, spread, seed):
    """Vectors about ``topics`` directions: pairs of a topic lie on both sides of the threshold."""
    rng = np.random.default_rng(seed)
    centres = unit(rng.standard_normal((topics, 32)))
    return unit(centres[rng.integers(topics, size=n)] + rng.standard_normal((n, 32)) * spread / 32**0.5).astype(np.float32)


def test_passes_equal_all_pairs(spark):
    """Link counts and components of whole clusters by passes, at a size that all pairs could serve too."""
    x = clustered(3000, 60, 0.33, 4)
    number, whole = vectors.planned(frame_of(spark, x).selectExpr("vec_id AS id", "embedding AS vec"), 0.9, vectors.WINDOW, vectors.RECALL)
    assert not whole and 1 < number[32] < 20
    want = by_hand({i: v.tolist() for i, v in enumerate(x)})
    assert sum(n for n, _, _ in want.values()) > 10_000
    assert got_of(vectors.near_copies(frame_of(spark, x))) == want


def test_crowds_that_no_passes_part(spark, monkeypatch):
    monkeypatch.setattr(vectors, "passes_for", lambda *_: np.inf)
    x = clustered(600, 6, 0.4, 5)
    assert got_of(vectors.near_copies(frame_of(spark, x))) == by_hand({i: v.tolist() for i, v in enumerate(x)})
