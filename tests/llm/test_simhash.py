import random

import numpy as np
import pytest
import xxhash

from wearcurve.llm import simhash


def print_by_hand(text, width=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lower + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes_by_hand(prints, radius=3):
    """Smallest id reachable, for (id, print) rows."""
    distinct = sorted(set(prints.values()))
    near = {p: [q for q in distinct if (p ^ q).bit_count() <= radius] for p in distinct}
    out = {}
    for start in distinct:
        if start not in out:
            seen, todo = {start}, [start]
            while todo:
                for q in near[todo.pop()]:
                    if q not in seen:
                        seen.add(q)
                        todo.append(q)
            least = min(i for i, p in prints.items() if p in seen)
            out |= dict.fromkeys(seen, least)
    return {i: out[p] for i, p in prints.items()}


def test_documents(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: print_by_hand(t) for i, t in texts.items()}
    want = classes_by_hand(prints)
    got = simhash.classes(docs).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in got} == prints
    assert all(len(r["fingerprint"]) == 16 for r in got)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(want.values())


def test_odd_rows(odd_docs, no_docs):
    got = simhash.classes(odd_docs).collect()
    assert len(got) == odd_docs.count()
    rows = odd_docs.collect()
    prints = {r["doc_id"]: print_by_hand(r["text"]) for r in rows if r["doc_id"] is not None}
    want = classes_by_hand(prints)
    for r in got:
        if r["doc_id"] is not None:
            assert (int(r["fingerprint"], 16), r["component_id"]) == (prints[r["doc_id"]], want[r["doc_id"]])
    assert simhash.classes(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(set(want.values()))
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["no id here"]  # the other lies in the wordless class


def test_repeated_ids(spark):
    """Each class keeps one row, also where an id stands for several texts and where none has an id."""
    rows = [(1, "a b c d e", "x"), (1, "p q r s t", "x"), (1, "p q r s t", "y"), (2, "a b c d e", "x"), (2, "a b c d e", "x")]
    rows += [(None, "u v w x y", "x")] * 3 + [(None, "p q r s t", "x"), (None, None, None), (3, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = sorted((r["text"], r["doc_id"]) for r in simhash.keep_one(docs).collect())
    assert kept == [("", 3), ("a b c d e", 1), ("p q r s t", 1), ("u v w x y", None)]
    assert simhash.keep_one(docs.repartition(5)).collect() != []
    order = lambda d: sorted(map(str, simhash.keep_one(d).collect()))
    assert order(docs) == order(docs.repartition(5))


def test_chains_and_cells(spark):
    """Chains link through members; every pair within the radius is met once, also when cells are split."""
    rnd = random.Random(3)
    prints = [rnd.getrandbits(64) for _ in range(300)]
    chain = prints[0]
    for _ in range(12):
        chain ^= sum(1 << b for b in rnd.sample(range(64), 3))
        prints.append(chain)
    for p in prints[:100]:
        prints += [p ^ sum(1 << b for b in rnd.sample(range(64), k)) for k in (1, 2, 3, 4)]
    prints = sorted({*prints, 0, 1, 7, 15, 2**64 - 1})
    want = {(p, q) for p in prints for q in prints if p < q and (p ^ q).bit_count() <= 3}
    signed = [(p - (p >> 63 << 64),) for p in prints]
    for cell_rows in (10**6, 100, 7):
        pairs = simhash.near_prints(spark.createDataFrame(signed, "fp long"), 3, cell_rows).collect()
        got = [tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in pairs]
        assert len(got) == len(set(got)) and set(got) == want


def test_visits_stay_few():
    """Visits a fingerprint hardly grow from a million to a hundred million, and no task holds more than it should."""
    sample, rows = np.random.default_rng(4).integers(0, 2**64, 100_000, np.uint64), simhash.CELL_ROWS
    at_home, guests = simhash.cell_sizes(sample, simhash.RADIUS)
    visits = {}
    for size in (10**6, 10**7, 10**8):
        scale = size / len(sample)
        parts, blocks = simhash.split_cells((at_home * scale).astype(int), (guests * scale).astype(int), rows)
        dealt = list(simhash.visits(sample, simhash.RADIUS, parts, blocks))
        visits[size] = sum(len(d[0]) for d in dealt) / len(sample)
        for cell, _, block, home, _ in dealt:
            task = cell * (blocks.max() + 1) + block
            for side in (home, ~home):
                assert np.unique(task[side], return_counts=True)[1].max(initial=0) * scale < 1.2 * rows
    assert visits[10**6] < 21 and visits[10**8] < 25


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
def test_other_radius(spark, radius):
    rnd = random.Random(radius)
    prints = [rnd.getrandbits(64) for _ in range(150)]
    for p in prints[:100]:
        prints += [p ^ sum(1 << b for b in rnd.sample(range(64), k)) for k in (1, 2, 3, 4, 5)]
    prints = sorted(set(prints))
    want = {(p, q) for p in prints for q in prints if p < q and (p ^ q).bit_count() <= radius}
    frame = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "fp long")
    got = [tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in simhash.near_prints(frame, radius, 100).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    with pytest.raises(ValueError):
        simhash.near_prints(frame, 5)


def test_classes_follow_radius_and_width(spark):
    """Long texts with one word changed: their fingerprints lie from none to many bits apart."""
    rnd = random.Random(8)
    rows = []
    for group in range(40):
        words = [rnd.choice("abcdefghij") * rnd.randint(1, 4) for _ in range(120)]
        rows.append((len(rows), " ".join(words)))
        for at in rnd.sample(range(120), 3):
            rows.append((len(rows), " ".join([*words[:at], "changed", *words[at + 1 :]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = set()
    for radius, width in ((0, 3), (1, 3), (4, 3), (4, 5)):
        want = classes_by_hand({i: print_by_hand(t, width) for i, t in rows}, radius)
        got = {r["doc_id"]: r["component_id"] for r in simhash.classes(docs, radius=radius, words=width).collect()}
        assert got == want
        assert {r["doc_id"] for r in simhash.keep_one(docs, radius=radius, words=width).collect()} == set(want.values())
        seen.add(len(set(want.values())))
    assert len(seen) > 2
