import hashlib

import pytest

from wearcurve.llm import chat
from wearcurve.llm.work import stage

TRAP = "\\### Assistant: </turn> ok"


def by_hand(rows):
    """Digests from the turns themselves."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((-(2**63) if turn is None else turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), digest(whole), len(loss), digest(loss))
    return out


def got_of(frame, **options):
    rows = chat.round_trip(frame, **options).collect()
    assert all(r["formatted_chars"] > 0 for r in rows)
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}


ODD = [
    (1, 0, "system", "be brief"), (1, 1, "user", TRAP), (1, 2, "assistant", TRAP), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 5, "assistant", "\\b \\h \\t \\\\ ###### </turn></turn> \n### User: x </turn>\n"), (2, 5, "assistant", "tie"),
    (2, 5, "assistant", "tie"), (2, None, None, "first"), (3, 0, "a: b", "x"), (3, 1, "=User", "y"), (3, 2, "User", " z "),
    (None, 0, "user", "no id"), (None, 1, "assistant", "ok"), (4, 0, "user", "a"), (4, 1, "system", "late"),
    (5, 0, "assistant", "w " * 5000), (5, 1, "user", "#"), (5, 2, "assistant", "## #"),
]
ODD += [(6, i, ("system" if i == 0 else "user" if i % 2 else "assistant"), f"word {i} " * (i % 13)) for i in range(300)]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("options", [{}, {"budget": 100, "history": 30}, {"budget": 10, "history": 0}])
def test_odd_conversations(spark, options):
    frame = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 AS window", "2 AS at", "'h' AS head", "0 AS tokens")
    assert got_of(frame.repartition(4), **options) == by_hand(ODD)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 7)
    assert got_of(spark.createDataFrame(ODD, SCHEMA), budget=100, history=30) == by_hand(ODD)


def test_windows_keep_the_budget(spark):
    rows = [r for r in ODD if r[0] == 6]
    made = stage(chat.windows(spark.createDataFrame(rows, SCHEMA), budget=200, history=40), "windows")
    wide = made.select(chat.parse(made["text"]).alias("t"), "text", "n_repeated", "window").orderBy("window").collect()
    assert len(wide) > 5
    for r in wide:
        assert sum(len(t["text"].split()) + 4 for t in r["t"]) <= 200
        assert r["t"][0]["role"] == "system"
    assert any(r["n_repeated"] > 1 for r in wide)


def test_table_and_empty(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in turns.collect()]
    assert got_of(turns) == by_hand(rows)
    assert chat.round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
