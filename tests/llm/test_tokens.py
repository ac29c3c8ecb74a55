import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from wearcurve.llm import piece_bpe, sentence_pieces, token_counts, token_files, units, word_bpe
from wearcurve.llm.merging import PairTable, merge_all, merge_in_order
from wearcurve.llm.queries import PIECE_MODEL, WORD_VOCABULARY


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORD_VOCABULARY)


@pytest.fixture(scope="module")
def pieces():
    return SentencePieceProcessor(model_file=PIECE_MODEL)


def odd_strings(n=1500):
    rnd = random.Random(1)
    letters = "ab cd  \n\t'sé́ñİΣσß中文한글😀<|endoftext|>0123½²٣  ​\x1c\x85▁.,!?-_\\\"ABCthe intion"
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 120))) for _ in range(n)]
    out += ["".join(rnd.choice("aehinorst") for _ in range(rnd.randint(1, 60))) for _ in range(n)]
    return out + ["a" * 5000, " " * 777, "ab" * 3000, "<|startoftext|>x<|endoftext|><|endoftext|>", "", "\n\n", " \n "]


def test_kernels_equal_the_libraries(words, pieces):
    texts = odd_strings()
    raw = [t.encode() for t in texts]
    want = [e.ids for e in words.encode_batch(texts, add_special_tokens=False)]
    flat, sizes = units.by_text(raw, units.ASCII_SPACE, word_bpe.library_ids(WORD_VOCABULARY))
    assert sizes.tolist() == list(map(len, want)) and flat.tolist() == [i for ids in want for i in ids]
    counts, sizes = units.by_text(raw, units.ASCII_SPACE, word_bpe.merged_counts(WORD_VOCABULARY))
    ends = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(sizes)))]
    assert np.diff(ends).tolist() == list(map(len, want))
    want = pieces.encode(texts)
    flat, sizes = piece_bpe.pieces(PIECE_MODEL)(raw)
    assert sizes.tolist() == list(map(len, want)) and flat.tolist() == [i for ids in want for i in ids]


def test_rounds_equal_single_merges():
    """Random tables, among them ones in which a merge makes a better pair than the one at hand."""
    rnd = random.Random(2)
    for _ in range(150):
        pairs = [(a, b) for a in range(7) for b in range(7) if rnd.random() < 0.5]
        table = PairTable([a for a, _ in pairs], [b for _, b in pairs],
                          [rnd.randrange(len(pairs)) for _ in pairs], [rnd.randrange(7) for _ in pairs])
        runs = [[rnd.randrange(7) for _ in range(rnd.randrange(14))] for _ in range(20)]
        flat, sizes = merge_all(np.array([s for r in runs for s in r], np.int32), np.array(list(map(len, runs))), table)
        got = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
        assert got == [merge_in_order(r, table) for r in runs]


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(units, "_LETTER", np.ones(256, np.uint64))  # words of one length share a hash
    blob, starts, ends, sizes = units.cut([b"ab cd ab", b"", b" x cd "], units.ASCII_SPACE)
    first, inverse = units.distinct(blob, starts, ends)
    heads = [blob[starts[i] : ends[i]] for i in first]
    assert [heads[i] for i in inverse] == [b"ab", b"cd", b"ab", b"x", b"cd"] and sizes.tolist() == [3, 0, 2]


def test_long_texts_are_cut_at_spaces():
    text = b"ab " * 100 + b"c" * 50 + b" d"
    for limit in (7, 20, 1000):
        runs = list(units.chunks([text, b"", b"x"], units.ASCII_SPACE, limit))
        assert [w for run, places in runs for t, p in zip(run, places) if p == 0 for w in t.split()] == text.split()
        assert {p for _, places in runs for p in places} == {0, 1, 2}


def test_counts(spark, docs, odd_docs, no_docs, words):
    for table in (docs, odd_docs):
        texts = {r["doc_id"]: r["text"] or "" for r in table.collect() if r["doc_id"] is not None}
        rows = token_counts.over_budget(table, WORD_VOCABULARY).collect()
        assert len(rows) == table.count()
        for r in rows:
            if r["doc_id"] is not None:
                text = texts[r["doc_id"]]
                n = len(words.encode(text, add_special_tokens=False).ids)
                assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)
    assert token_counts.count_tokens(no_docs, WORD_VOCABULARY).count() == 0
    wide = token_counts.count_tokens(odd_docs.selectExpr("*", "1 AS n_tokens"), WORD_VOCABULARY)
    assert wide.columns == [c for c in odd_docs.columns if c != "text"] + ["n_tokens"]


def test_pieces(spark, docs, odd_docs, no_docs, pieces):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for table in (docs, odd_docs):
        texts = {r["doc_id"]: r["text"] or "" for r in table.collect() if r["doc_id"] is not None}
        for r in sentence_pieces.round_trip(table, PIECE_MODEL).collect():
            if r["doc_id"] is not None:
                ids = pieces.encode(texts[r["doc_id"]])
                want = (len(ids), digest(",".join(map(str, ids))), digest(pieces.decode(ids) if ids else ""))
                assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == want
    coded = sentence_pieces.encode(odd_docs, PIECE_MODEL)
    assert coded.columns.count("ids") == 1
    back = sentence_pieces.decode(coded, PIECE_MODEL).select("doc_id", "text").collect()
    assert len(back) == odd_docs.count()
    assert sentence_pieces.round_trip(no_docs, PIECE_MODEL).count() == 0


def test_files(spark, docs, odd_docs, no_docs, words, tmp_path):
    for name, table in (("a", docs), ("b", odd_docs)):
        path = str(tmp_path / name)
        token_files.write_tokens(table, path, WORD_VOCABULARY)
        got = token_files.token_starts(spark, path).collect()
        assert len(got) == table.count()
        texts = {r["doc_id"]: r["text"] or "" for r in table.collect() if r["doc_id"] is not None}
        at = 0
        for r in sorted(got, key=lambda r: (r["start"])):
            assert r["start"] == at
            at += r["n_tokens"]
            if r["doc_id"] is not None:
                ids = words.encode(texts[r["doc_id"]], add_special_tokens=False).ids + [2]
                assert r["n_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
        assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    file = next((tmp_path / "a").glob("part-*.parquet"))
    column = next(c for c in range(pq.ParquetFile(file).metadata.num_columns)
                  if pq.ParquetFile(file).metadata.row_group(0).column(c).path_in_schema.startswith("ids"))
    meta = pq.ParquetFile(file).metadata.row_group(0).column(column)
    assert "DELTA_BINARY_PACKED" in meta.encodings and meta.has_offset_index
    token_files.write_tokens(no_docs, str(tmp_path / "c"), WORD_VOCABULARY)
    assert token_files.token_starts(spark, str(tmp_path / "c")).count() == 0
