"""Quality classifier: held-out accuracy, and its rules and scores by hand."""

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wearcurve.llm import classifier
from wearcurve.llm.queries import QUERIES

MID = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def mid(spark):
    return spark.read.parquet(f"{MID}/documents.parquet"), spark.read.parquet(f"{MID}/labels.parquet")


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op13_quality_classifier"](spark, MID).toPandas()


def test_held_out_rows_are_told_apart(mid, scored):
    truth = {r["doc_id"]: r["quality"] for r in mid[1].collect()}
    assert len(scored) == mid[0].count() and scored["score"].between(0, 1).all()
    assert ((scored["score"] >= 0.3) == (scored["predicted"] == 1)).all()
    assert (scored["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in scored["doc_id"]]).all()
    judged = [(truth[i], p) for i, h, p in zip(scored["doc_id"], scored["held_out"], scored["predicted"]) if h and i in truth]
    assert len(judged) > 50
    assert sum(t == p for t, p in judged) / len(judged) >= 0.9
    bad = [p for t, p in judged if t == 0]
    assert sum(p == 0 for p in bad) / len(bad) >= 0.7


def test_labels_of_held_out_rows_teach_nothing(mid, scored):
    docs, labels = mid
    turned = labels.withColumn("quality", F.when(classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = classifier.classify(docs, turned).toPandas()
    assert dict(zip(scored["doc_id"], scored["score"])) == dict(zip(again["doc_id"], again["score"]))


def by_hand(text):
    """Some of the statistics."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, share = len(words), lambda a, b: a / b if b else 0.0
    return {
        "n_words": float(n),
        "word_length": share(sum(map(len, words)), n),
        "short_share": share(sum(len(w) <= 3 for w in words), n),
        "line_words": share(n, len(lines)),
        "distinct_line_share": share(len(set(lines)), len(lines)),
        "bars_share": share(text.count("|"), len(text)),
        "digits_share": share(len(re.findall("[0-9]", text)), len(text)),
        "other_share": share(sum(ord(c) > 127 for c in text), len(text)),
    }


def test_statistics_of_odd_texts(odd_docs):
    rows = classifier.statistics(odd_docs.withColumn("again", F.col("text")).withColumn("stats", F.lit(1))).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        got, want = r["stats"].asDict(), by_hand(r["again"])
        assert {k: got[k] for k in want} == pytest.approx(want)


def test_scores_are_those_of_the_rules(spark, mid):
    docs, labels = mid
    stats = classifier.statistics(docs.select("doc_id", "text")).join(labels, "doc_id").withColumn("label", F.col("quality"))
    found = classifier.fit(stats)
    assert 0 < len(found.rules) < 200
    for r in stats.withColumn("score", found.score()).limit(200).collect():
        odds = found.intercept
        for rule, weight in found.rules:
            if all((r["stats"][x.feature] > x.threshold) == x.above for x in rule):
                odds += weight
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-odds)))


def test_paths_are_conjunctions_of_the_narrowest_thresholds(spark):
    tree = [
        (0, 0, 1, 4, 0, 5.0), (0, 1, 2, 3, 0, 3.0), (0, 2, None, None, None, None), (0, 3, None, None, None, None),
        (0, 4, 5, 6, 1, 0.5), (0, 5, None, None, None, None), (0, 6, None, None, None, None),
    ]
    nodes = spark.createDataFrame(tree, "tree int, node int, left int, right int, feature int, threshold double")
    told = {tuple((x.feature, x.above, x.threshold) for x in rule) for rule in classifier.paths(nodes, ["a", "b"])}
    assert told == {
        (("a", False, 5.0),), (("a", False, 3.0),), (("a", False, 5.0), ("a", True, 3.0)),
        (("a", True, 5.0), ("b", False, 0.5)), (("a", True, 5.0), ("b", True, 0.5)),
    }


def test_one_class_no_labels_odd_rows_and_empty_tables(spark, odd_docs, no_docs, mid):
    none = mid[1].limit(0)
    plain = classifier.classify(odd_docs, none)
    assert plain.count() == odd_docs.count() and {r["score"] for r in plain.collect()} == {0.5}
    same = spark.createDataFrame([(i, 1) for i in range(20)] + [(None, 0), (3, None)], "doc_id long, quality int")
    assert {r["predicted"] for r in classifier.classify(odd_docs, same).collect()} == {1}
    assert classifier.classify(no_docs, mid[1]).collect() == []
    rows = classifier.classify(odd_docs.unionByName(odd_docs), same).groupBy("doc_id").agg(F.count_distinct("score").alias("n"))
    assert {r["n"] for r in rows.collect()} == {1}


def test_fits_in_a_session_that_has_counted_rows(spark):
    """Once rows were counted while they were written, a session cannot be sent to tasks, nor can what holds it."""
    from pyspark.sql import Observation

    seen = Observation("seen")
    assert spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).count() == 3 and seen.get["n"] == 3
    good, bad = "plain words make a line of text", "|||| 0 0 ## 1 2 | 77 ||"
    docs = spark.createDataFrame([(i, f"{good if i % 2 else bad} {i % 7}") for i in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    found = classifier.classify(docs, labels).collect()
    assert len(found) == 400 and all(r["predicted"] == r["doc_id"] % 2 for r in found)
