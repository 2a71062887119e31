"""Windows of conversations, read back and compared with the rows."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from crawltable.llm import chat, queries
from crawltable.llm.tokens import tokenizer, vocabulary_path

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def digest(turns):
    """What the contract's columns say, from ordered (role, text)."""
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(whole), len(loss), sha(loss)


def check(df, turns, **options):
    windows = chat.format_windows(df, **options)
    rows = chat.digest(windows).collect()
    assert {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows
    } == {c: digest(t) for c, t in turns.items()}
    return windows.orderBy("conv_id", "cell", "span").collect(), rows


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns[r.conv_id].append((r.role or "", r.text or ""))
    turns[-1] = [("user", queries.TRICKY), ("assistant", queries.TRICKY)]
    rows = queries.op9_chat(spark, sf).collect()
    assert {
        r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows
    } == {c: digest(t) for c, t in turns.items()}


def conversation(n, system=True, words=40):
    roles = ["system"] if system else []
    roles += ["user" if k % 2 == 0 else "assistant" for k in range(n)]
    return [(r, f"{r} {k} " + " ".join(f"word{k}" for _ in range(words))) for k, r in enumerate(roles)]


@pytest.mark.parametrize("budget, history", [(400, 150), (300, 0), (2000, 500)])
@pytest.mark.parametrize("partitions", ["1", "6"])
def test_windows_keep_to_their_budget(spark, budget, history, partitions):
    """A long conversation over several tasks, and short ones beside it."""
    turns = {1: conversation(60), 2: conversation(3, system=False), 3: conversation(1)}
    rows = [(c, k, *t) for c, ts in turns.items() for k, t in enumerate(ts)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        windows, _ = check(spark.createDataFrame(rows, SCHEMA), turns, budget=budget, history=history)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    count = tokenizer(vocabulary_path())
    for w in windows:
        shown = chat.parse(w.formatted)
        size = sum(len(x) + chat.FRAME_TOKENS for x in count.encode([t for _, t in shown]))
        assert size == w.n_tokens <= budget and not w.over_budget
        assert len(shown) == w.n_turns
        if w.conv_id == 1:
            assert shown[0] == turns[1][0]
        repeated = [t for t in shown[: w.n_repeated] if t[0] != "system"]
        if repeated:  # history ends where the new turns begin
            place = turns[w.conv_id].index(repeated[0])
            assert shown[w.n_repeated - len(repeated) :] == turns[w.conv_id][place : place + len(shown) - w.n_repeated + len(repeated)]
        texts = [w.formatted[s.start : s.end] for s in w.loss]
        assert texts == [chat.escape(t) for r, t in shown[w.n_repeated :] if r == "assistant"]
    if history:
        assert any(w.n_repeated > 1 for w in windows if w.conv_id == 1 and w.cell) or budget > 1500


def test_turns_over_the_budget_stand_alone(spark):
    turns = {1: [("system", "s"), ("user", "a"), ("assistant", "long " * 500), ("user", "b"), ("assistant", "c")]}
    rows = [(1, k, *t) for k, t in enumerate(turns[1])]
    windows, _ = check(spark.createDataFrame(rows, SCHEMA), turns, budget=100, history=30)
    assert [w.over_budget for w in windows].count(True) == 1
    assert "".join(w.formatted for w in windows).count("long " * 500) == 1


def test_odd_rows(spark):
    rows = [
        (1, 0, None, "no role"), (1, 1, "assistant", None), (1, None, "user", "first"), (None, 0, "user", "x"),
        (None, 0, "user", "x"), (2, 0, "a\nb\\n<|", "<|im_end|>\n<|im_start|>"), (2, 1, "assistant", "<\\|<\\\\|"),
        (3, 0, "assistant", ""), (4, 5, "user", "only"), (4, 5, "assistant", "tie"), (4, 5, "assistant", "tie"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "role AS hash", "turn AS position", "text AS cell")
    found = {r.conv_id: r for r in chat.digest(chat.format_windows(df)).collect()}
    assert (found[1].n_turns, found[1].loss_chars) == (3, 0)
    assert found[1].turns_sha256 == digest([("user", "first"), ("", "no role"), ("assistant", "")])[1]
    assert found[None].n_turns == 2 and found[4].n_turns == 3 and found[4].loss_chars == 6
    assert found[2].turns_sha256 == digest([tuple(r[2:]) for r in rows[5:7]])[1]
    assert chat.digest(chat.format_windows(df.where("false"))).count() == 0


@given(st.text(alphabet="<|\\>im_start\n", max_size=30), st.text(alphabet="<|\\\nn", max_size=10))
def test_escapes_are_reversible(text, role):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    window = (chat.turn_head(role) + chat.escape(text) + chat.TAIL) * 2
    assert chat.parse(window) == [(role, text)] * 2
