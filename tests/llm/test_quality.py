import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.conftest import DATA
from wearcurve.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_statistics(spark, docs, odd_docs):
    for table in (docs, odd_docs):
        got = quality.statistics(table.select("*", F.col("text").alias("original"))).collect()
        assert len(got) == table.count()
        for row in got:
            assert tuple(row[c] for c in COLUMNS) == by_hand(row["original"])


def test_empty(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.assess(no_docs, labels).count() == 0
    assert quality.keep_good(no_docs, labels).columns == no_docs.columns


def test_no_labels_keep_what_passes_the_base(spark, odd_docs):
    labels = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    rows = quality.assess(odd_docs, labels).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in rows)
    assert quality.keep_good(odd_docs, labels).columns == odd_docs.columns


def test_learned_list_holds_on_other_rows(spark):
    """Fitted on two thirds of the labels of a larger table, judged on the rest."""
    docs = spark.read.parquet(DATA.replace("0.001", "0.1") + "/documents.parquet")
    labels = spark.read.parquet(DATA.replace("0.001", "0.1") + "/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    found = quality.assess(docs, labels.filter(~held)).join(labels.filter(held), "doc_id").filter("NOT base_failed")
    counts = found.groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in counts}
    good, bad = n.get((1, True), 0) + n.get((1, False), 0), n.get((0, True), 0) + n.get((0, False), 0)
    print(n)
    assert n.get((1, True), 0) >= 0.98 * good
    assert n.get((0, False), 0) >= 0.5 * bad


def test_expression_is_ordered_and_conditional(spark):
    rules = [(quality.Literal("mark_share", True, 0.1), quality.Literal("n_words", False, 100.0))]
    assert "CASE WHEN" in str(quality.verdict(rules))
