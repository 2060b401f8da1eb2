from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gaugeworks.llm.chat import TARGET_ROLE, budgeted_windows, escaped, parsed, read_back, rendered, unescaped
from gaugeworks.llm.queries import WORD_VOCABULARY, op1_chat_formatting
from gaugeworks.llm.tokens import ChunkEncoder
from tests.llm.brute import sha

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = st.lists(st.sampled_from(list("#</turn> \\\n:a") + ["### ", " </turn>\n", "é"]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(NASTY, NASTY), max_size=5))
def test_turns_come_back(turns):
    text = "".join(rendered(role, said)[0] for role, said in turns)
    found = parsed(text)
    assert [(role, said) for role, said, _, _ in found] == turns
    assert all(unescaped(text[begin:end]) == said for (_, said, begin, end) in found)
    for _, said in turns:
        assert "###" not in escaped(said).replace("\\#", "") or "###" not in said
        assert unescaped(escaped(said)) == said


def brute(rows):
    """conv to (n_turns, sha of turns, characters and sha of assistant texts)."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0)
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=key)
        said = "".join(r[3] or "" for r in turns if r[2] == TARGET_ROLE)
        all_turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
        out[conv] = (len(turns), sha(all_turns), len(said), sha(said))
    return out


def summary(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    found = op1_chat_formatting(spark, SF)
    assert found.columns[:6] == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    assert summary(found) == brute(rows)


ENCODER = ChunkEncoder(WORD_VOCABULARY, counts_only=True)


def cost(role, text):
    return max(1, ENCODER.count(rendered(role, text)[0]))


@pytest.mark.parametrize("span, history", [(40, 15), (60, 0), (25, 25), (10_000, 10)])
def test_windows(spark, span, history):
    """Every window: the system turn, whole history within its budget, then new turns within theirs."""
    random.seed(span)
    rows, convs = [], {}
    for conv in range(12):
        roles = (["system"] if conv % 3 else []) + [("user", "assistant")[i % 2] for i in range(random.randint(0, 40))]
        turns = [(role, " ".join(random.choices(["alpha", "beta", "gamma"], k=random.randint(0, 30)))) for role in roles]
        convs[conv] = turns
        rows += [(conv, turn, *pair) for turn, pair in enumerate(turns)]
    random.shuffle(rows)
    windows = budgeted_windows(spark.createDataFrame(rows, SCHEMA).repartition(4), WORD_VOCABULARY, span_tokens=span, history_tokens=history)
    by_conv = {}
    for w in sorted(windows.collect(), key=lambda w: (w.conv, w.window)):
        by_conv.setdefault(w.conv, []).append(w)
    assert set(by_conv) == {c for c, turns in convs.items() if turns}
    for conv, found in by_conv.items():
        turns, seen = convs[conv], 0
        system = turns[0][0] == "system"
        for number, w in enumerate(found):
            inside = [(role, text) for role, text, _, _ in parsed(w.formatted)]
            again, new = inside[: w.repeated], inside[w.repeated :]
            assert new and new == turns[seen : seen + len(new)]
            if system and number:
                assert again[0] == turns[0]
                again = again[1:]
            assert again == turns[seen - len(again) : seen]
            assert sum(cost(*t) for t in again) <= history
            before = seen - len(again) - 1
            if number and before >= (1 if system else 0):
                assert sum(cost(*t) for t in turns[before:seen]) > history
            counted = [t for k, t in enumerate(new) if not (system and number == 0 and k == 0)]
            assert len(counted) <= 1 or sum(cost(*t) for t in counted) <= span
            targets = [text for role, text in new if role == TARGET_ROLE]
            assert [unescaped(w.formatted[s.begin : s.begin + s.length]) for s in w.loss] == targets
            assert w.tokens == sum(cost(*t) for t in inside)
            seen += len(new)
        assert seen == len(turns)
    assert summary(read_back(windows)) == brute(rows)


def test_edge_cases(spark):
    rows = [
        (1, 0, "user", None),
        (1, 1, None, "no role"),
        (2, None, "assistant", "turn unknown"),
        (2, 3, "assistant", "### user: x </turn>\n"),
        (None, 0, "assistant", "no conversation"),
        (3, 0, "system", "only a system turn"),
        (4, 0, "system", "long " * 5_000),
        (4, 1, "assistant", "long " * 50_000),
        (4, 2, "user", ""),
        (5, 0, "assistant", "twice"),
        (5, 0, "assistant", "twice"),
        (6, 0, "a: b\n### c", "role of control strings"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("window", F.lit("clash")).withColumn("conv", F.lit(1)).withColumn("tokens", F.lit(1))
    assert summary(read_back(budgeted_windows(frame, WORD_VOCABULARY))) == brute(rows)
    assert read_back(budgeted_windows(frame.limit(0), WORD_VOCABULARY)).count() == 0


def test_one_conversation_of_all_rows(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn number {i}") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = budgeted_windows(spark.createDataFrame(rows, SCHEMA).repartition(6), WORD_VOCABULARY)
        assert summary(read_back(frame)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
