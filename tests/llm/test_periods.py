"""Periodic runs against comparison of all places at all distances."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wearcurve.llm import periods
from wearcurve.llm.queries import QUERIES

from .conftest import DATA, ODD_TEXTS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """Runs as start, length, period."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([number[w] for w in words], np.int64)
    found = {}
    for q in range(1, len(ids) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.concatenate(([0], ids[:-q] == ids[q:], [0]))))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b - a + q >= max(12, 2 * q):
                found.setdefault((a, b - a + q), q)
    return sorted((a, length, q) for (a, length), q in found.items())


def as_tuples(found):
    return [tuple(r) for r in found.tolist()]


def in_order(found):
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120), st.integers(1, 40), st.integers(0, 200), st.lists(st.integers(0, 2), max_size=30))
def test_runs_of_short_sequences(head, period, length, tail):
    repeated = [head[i % period % len(head)] if head else 0 for i in range(length)]
    ids = np.array(head + repeated + tail, np.int64)
    assert as_tuples(periods.runs(ids)) == in_order(brute(ids.tolist()))


@pytest.mark.parametrize("words", [2, 30, 100_000])
def test_runs_of_long_sequences(words):
    rng = np.random.default_rng(words)
    part = rng.integers(0, words, 700)
    ids = np.concatenate([np.tile(part, 4), rng.integers(0, words, 900), np.tile(part[:9], 30), part[:5]])
    _, ids = np.unique(ids, return_inverse=True)
    assert as_tuples(periods.runs(ids)) == in_order(brute(ids.tolist()))


def test_transform_finds_every_occurrence():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 3, 500)
    for size, low, high in periods._scales(400):
        at = np.arange(0, 500 - size, size)
        s, d = periods.occurrences(ids, at, size, low, high)
        want = {
            (a, k) for a in at.tolist() for k in range(low, high + 1)
            if a + k + size <= 500 and (ids[a : a + size] == ids[a + k : a + k + size]).all()
        }
        assert want == set(zip(s.tolist(), d.tolist()))


def test_one_word_many_times():
    assert as_tuples(periods.runs(np.zeros(300_000, np.int64))) == [(0, 300_000, 1)]


def expected(doc_id, text):
    """One row of the report, by hand."""
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = in_order(brute(words))
    gone = {i for a, length, q in found for i in range(a + q, a + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{a},{length},{q}\n" for a, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (
        doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_report_on_documents(spark, docs):
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, DATA).collect()]
    rows = docs.select("doc_id", "text").collect()
    assert ordered(got) == ordered([expected(*r) for r in rows])
    assert any(r[1] for r in got) and any(not r[1] for r in got)


def test_report_on_odd_rows(spark, odd_docs):
    short = odd_docs.filter("text IS NULL OR length(text) < 50000")
    got = [tuple(r) for r in periods.report(periods.with_repeats(short)).collect()]
    assert ordered(got) == ordered([expected(*r) for r in short.select("doc_id", "text").collect()])


def test_long_text_extra_columns_and_empty_table(spark, odd_docs, no_docs):
    found = periods.find_runs(odd_docs.withColumns({"runs": odd_docs.doc_id, "n_words": odd_docs.doc_id}))
    assert {"row", "words", "runs", "collapsed", "n_words"} <= set(found.columns) and "text" not in found.columns
    assert found.count() == len(ODD_TEXTS) + 4
    long = found.filter("n_words = 60000").first()
    assert [tuple(r) for r in long["runs"]] == [(0, 60000, 1)] and long["collapsed"] == "word"
    assert periods.report(periods.with_repeats(no_docs)).collect() == []
