"""Alignment of two tokenizers against their whole-text tokens and a count of all pairs."""

import hashlib
import json
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from wearcurve.llm import alignment
from wearcurve.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, QUERIES

from .conftest import DATA, ODD_TEXTS


class Plain:
    """Groups of whole texts by the definition: decoded bytes of each token, one after the other."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE_VOCABULARY)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=PIECE_MODEL)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in shown}
        letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        with open(BYTE_VOCABULARY, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        self.a_bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        sides = [[(i, self.a_bytes[i]) for i in a], [(i, self.b_bytes(i)) for i in b]]
        if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
            return []
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
        out, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            p, q = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            out.append((a[i:p], b[j:q]))
            i, j = p, q
        return out


def as_text(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


@lru_cache(1)
def the_aligner():
    return alignment.Aligner(alignment.Pair(BYTE_VOCABULARY, PIECE_MODEL))


@lru_cache(1)
def the_plain():
    return Plain()


@pytest.fixture(scope="module")
def plain():
    return the_plain()


def expected(plain, rows):
    all_groups = [plain.groups(text) for _, text in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in all_groups]
    held = Counter(pair for each in links for pair in each)
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for (key, _), groups, each in zip(rows, all_groups, links):
        digest = hashlib.sha256(as_text(groups).encode()).hexdigest() if groups else ""
        out.append((
            key, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(each.values()),
            sum(n for p, n in each.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in each.items()), digest,
        ))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


PARTS = ["word", " ", "  ", "\n", "\n\n", " a", "ß", "über", "日本", "😀", "\t", " ", "　", "᠎", "'s", "12", "é", "<s>", "<0x0A>", "▁", "\x00", "\x1c", "\r\n", "—", "é", "İ", "<|endoftext|>", ".", "👩‍👩‍👧", ",", "Ab.,", '."', "x't"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=6))
def test_units_give_what_whole_texts_give(texts):
    plain = the_plain()
    counts, groups, links, sizes = the_aligner()([t.encode() for t in texts])
    want = [plain.groups(t) for t in texts]
    assert groups == [as_text(g) for g in want]
    n_b = plain.b.get_piece_size()
    flat = [x * n_b + y for g in want for a, b in g for x in a for y in b]
    assert links.tolist() == flat
    assert counts.tolist() == [[sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g)] for g in want]
    assert sizes.tolist() == [sum(len(a) * len(b) for a, b in g) for g in want]


def test_report_on_documents(spark, docs, plain):
    got = [tuple(r) for r in QUERIES["op12_token_alignment"](spark, DATA).collect()]
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert ordered(got) == ordered(expected(plain, rows))


def test_report_over_many_slices_and_partitions(spark, docs, plain, monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_ROWS", 7)
    part = docs.filter("length(text) < 4000").repartition(5)
    got = [tuple(r) for r in alignment.report(part, BYTE_VOCABULARY, PIECE_MODEL).collect()]
    rows = [tuple(r) for r in part.select("doc_id", "text").collect()]
    assert ordered(got) == ordered(expected(plain, rows))


def test_report_on_odd_rows(spark, odd_docs, plain):
    got = [tuple(r) for r in alignment.report(odd_docs, BYTE_VOCABULARY, PIECE_MODEL).collect()]
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert ordered(got) == ordered(expected(plain, rows))
    nothing = {None, "", next(t for t in ODD_TEXTS if t and "▁" in t)}
    assert all(r[1:] == (0, 0, 0, 0, 0, 0, "") for r in got if r[0] is not None and ODD_TEXTS[r[0]] in nothing)


def test_extra_columns_and_empty_table(spark, odd_docs, no_docs):
    extra = odd_docs.withColumns({"groups": odd_docs.doc_id, "slice": odd_docs.doc_id, "at": odd_docs.doc_id, "pairs": odd_docs.doc_id})
    found = alignment.align(extra, BYTE_VOCABULARY, PIECE_MODEL)
    assert {"slice", "at", "pairs", "row", "groups", "count_sum"} <= set(found.columns)
    whole = found.filter("doc_id = 9").first()
    assert whole["groups"] == as_text(the_plain().groups(ODD_TEXTS[9]))
    assert found.count() == extra.count() and found.filter("slice IS NOT NULL AND slice <> doc_id").count() == 0
    assert alignment.report(no_docs, BYTE_VOCABULARY, PIECE_MODEL).collect() == []
