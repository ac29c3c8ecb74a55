import re

import duckdb
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from tests.llm.conftest import DATA
from tests.llm.test_sharding import Counter
from tests.llm.test_simhash import classes_by_hand, print_by_hand
from wearcurve.llm.queries import ORACLES, PIECE_MODEL


def test_stages_against_brute_force(spark, docs, tmp_path):
    """Each stage on what its predecessor kept, redone by hand."""
    names, state = [n for n, _ in corpus_pipeline.STAGES], docs
    kept = {}
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, state, DATA).write.parquet(path := str(tmp_path / str(i)))
        before, state = state, spark.read.parquet(path)
        kept[name] = state
        if i < len(names) - 1:
            assert state.columns == docs.columns
        if name == "near copies":
            prints = {r["doc_id"]: print_by_hand(r["text"]) for r in before.collect()}
            assert {r["doc_id"] for r in state.collect()} == set(classes_by_hand(prints).values())
    rows = {r["doc_id"]: r for r in docs.collect()}
    good = {r["doc_id"] for r in kept["quality rules"].collect()}
    assert all(len((rows[i]["text"] or "").split()) >= 50 for i in good) and len(good) > 0.5 * len(rows)
    for r in kept["secrets"].collect():
        assert r["text"] == re.sub(r"(?i)(token = \")[0-9a-f]{40}(\")", r"\1<SECRET>\2", rows[r["doc_id"]]["text"])
    con = duckdb.connect()
    documents = kept["secrets"].toPandas()
    con.register("documents", documents)
    want = {r[0]: r[4] // r[1] for r in con.sql(ORACLES["op3_mixing"]).fetchall() if r[4]}
    assert Counter(r["doc_id"] for r in kept["mix"].collect()) == Counter(want)
    library = SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {r["doc_id"]: r["text"] for r in kept["mix"].collect()}
    for r in kept["encode"].collect():
        assert r["n_tokens"] == len(library.encode(texts[r["doc_id"]]))
    assert sorted(corpus_pipeline.run(spark, DATA).collect()) == sorted(kept["encode"].collect())


def folder(docs, labels, path):
    for name, df in (("documents", docs), ("labels", labels)):
        df.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_odd_rows(spark, docs, odd_docs, tmp_path):
    """Nulls, repeats and clashing columns among sound documents: each class once, and only sound ones remain."""
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    extra = [c for c in odd_docs.columns if c not in docs.columns]
    sound = docs.withColumn("doc_id", docs["doc_id"] + 1000)
    sound = sound.unionByName(sound.limit(20)).unionByName(sound.limit(20).selectExpr("null AS doc_id", *sound.columns[1:]))
    mixed = odd_docs.unionByName(sound, allowMissingColumns=True)
    sf_dir = folder(mixed, labels.withColumn("doc_id", labels["doc_id"] + 1000), tmp_path)
    state, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, state, sf_dir).write.parquet(path := str(tmp_path / f"stage-{i}"))
        state = spark.read.parquet(path)
        seen[name] = state.collect()
        if name != "encode":
            assert state.columns == mixed.columns and set(extra) < set(state.columns)
    texts = [r["text"] for r in seen["near copies"]]
    assert len(texts) == len(set(texts)) and None not in texts and "" not in texts
    assert None not in {r["doc_id"] for r in seen["near copies"]}  # rows without an id are copies of named ones here
    want = {r["text"] for r in seen["quality rules"]}
    prints = {t: print_by_hand(t) for t in want}
    assert len(texts) == len(set(classes_by_hand({i: p for i, p in enumerate(prints.values())}).values()))
    assert len(seen["encode"]) == len(seen["mix"]) > 0
    assert sorted(corpus_pipeline.run(spark, sf_dir).collect()) == sorted(seen["encode"])


def test_empty_tables(spark, no_docs, tmp_path):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    assert corpus_pipeline.run(spark, folder(no_docs, labels, tmp_path / "a")).collect() == []
    assert corpus_pipeline.run(spark, folder(no_docs, labels.limit(0), tmp_path / "b")).collect() == []
