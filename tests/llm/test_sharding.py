import zlib
from collections import Counter

from wearcurve.llm import sharding


def written(df, path, **options):
    schema = sharding.write_shards(df, str(path), **options)
    return sharding.shard_table(df.sparkSession, str(path), schema).collect()


def check(rows, docs, shards=8):
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_table(docs, tmp_path):
    rows = written(docs, tmp_path / "a", bucket_bytes=50_000)
    check(rows, docs.collect())
    again = written(docs.repartition(5), tmp_path / "b", bucket_bytes=50_000)
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in rows) == sorted((r["doc_id"], r["shard"], r["slot"]) for r in again)
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["slot"], r["shard"]))]
    rises = sum(a < b for a, b in zip(order, order[1:]))
    assert 0.35 * len(order) < rises < 0.65 * len(order)  # no trace of the order of ids
    files = sharding.read_shards(docs.sparkSession, str(tmp_path / "a"))
    assert set(files.columns) == {*docs.columns, "shard", "slot"}


def test_odd_rows(odd_docs, no_docs, tmp_path):
    check(written(odd_docs, tmp_path / "a", bucket_bytes=1000), odd_docs.collect())
    assert written(no_docs, tmp_path / "b") == []


def test_equal_rows(spark, docs, tmp_path):
    """A row that fills a third of the table is dealt over all buckets, alike in every run."""
    hot = spark.range(100_000).selectExpr("7L AS doc_id", "'same text' AS text", "CAST(null AS string) AS lang")
    rest = docs.select("doc_id", "text", "lang")
    both = hot.union(rest)
    rows = written(both, tmp_path / "a", bucket_bytes=50_000, hot_rows=1000)
    check(rows, both.collect())
    again = written(both.repartition(7), tmp_path / "b", bucket_bytes=50_000, hot_rows=1000)
    place = lambda r: (str(r["doc_id"]), r["shard"], r["slot"])
    assert sorted(map(place, rows)) == sorted(map(place, again))
    others = sorted(r["slot"] for r in rows if r["text_crc32"] != zlib.crc32(b"same text"))
    assert others[len(others) // 2] in range(len(rows) // 8 // 4, len(rows) // 8 * 3 // 4)  # spread among the copies
    files = spark.read.parquet(str(tmp_path / "a")).selectExpr("input_file_name() AS f", "doc_id").groupBy("f").count()
    assert files.agg({"count": "max"}).first()[0] < 0.05 * len(rows)


def test_offsets_over_blocks(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 3)
    monkeypatch.setattr(sharding, "SMALL", 4)
    check(written(docs, tmp_path / "a", bucket_bytes=10_000), docs.collect())
