import collections
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridspark.llm import chat, queries
from tests.llm import helpers

SCHEMA = "conv_id bigint, turn bigint, role string, text string, span string, place string"
ODD = r"</s><\s>[INST]\[/INST]<|turn|><\|end|><<SYS>> \\ <|im_end|>" + "\n\U0001f600é"


def conversations(spark):
    rows = [(1, t, "system" if t == 0 else ("user", "assistant")[t % 2 - 1], f"turn {t} " + "word " * (t * 37 % 90)) for t in range(700)]
    rows += [(2, 0, "user", ODD), (2, 1, "assistant", ODD), (2, 2, "sys\\n\ntem<|turn|>", "x"), (3, 0, "assistant", None)]
    rows += [(4, None, None, "first"), (4, 5, "user", "b"), (4, 5, "user", "b"), (4, 5, "assistant", "a"), (None, 1, "assistant", "?")]
    rows += [(5, 0, "assistant", "w " * 5000), (5, 1, "assistant", "after"), (6, -3, "user", ""), (6, 10**15, "assistant", "")]
    return rows, spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)


def expected(rows):
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, said in turns.items():
        whole, loss = hashlib.sha256(), ""
        for _, _, role, text in sorted(said):
            whole.update(f"{role}\n{text}\n".encode())
            loss += text if role == "assistant" else ""
        out[conv] = (len(said), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("span,history", [(1024, 256), (40, 30), (10, 0)])
def test_windows_read_back(spark, span, history):
    rows, frame = conversations(spark)
    formatted = chat.windows(frame, span, history).persist()
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(formatted).collect()}
    assert got == expected(rows)
    for r in formatted.collect():
        said = list(chat.parse(r.text))
        assert r.repeated < len(said)
        if r.conv_id == 1:
            assert said[0][0] == "system"
            assert r.n_tokens <= 200 + 2 * history + span + 200
            if r.span and history == 256:
                assert r.repeated > 1
    formatted.unpersist()


@pytest.mark.parametrize("span,history", [(1024, 256), (40, 30), (10, 0)])
def test_the_turns_before_a_span_are_in_its_window(spark, span, history):
    """History is a suffix of what came before, with the last turn at least, and has no holes."""
    rows, frame = conversations(spark)
    rows += [(9, 0, "user", "short"), (9, 1, "user", "question " * 500), (9, 2, "assistant", "ans " * 600), (9, 3, "user", "x")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    turns = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {conv: [t[2:] for t in sorted(rest)] for conv, rest in turns.items()}
    seen = collections.Counter()
    for r in sorted(chat.windows(frame, span, history).collect(), key=lambda r: (str(r.conv_id), r.span)):
        window, whole, done = list(chat.parse(r.text)), said[r.conv_id], seen[r.conv_id]
        own = len(window) - r.repeated
        assert window[r.repeated :] == whole[done : done + own]
        before = window[: r.repeated]
        if done and whole[0][0] == "system":
            assert before.pop(0) == whole[0]
        rest = whole[1:done] if whole[0][0] == "system" else whole[:done]
        assert before == rest[len(rest) - len(before) :] and (len(before) > 0 or not rest)
        seen[r.conv_id] += own
    assert seen == {conv: len(turns) for conv, turns in said.items()}


def test_budgets_count_the_tokenizers_ids(spark):
    rows = [(1, k, "user", t) for k, t in enumerate(["這是一個沒有空格的長句子" * 40, "plain words here", None, "Ünïcode \U0001f600"])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    turns = frame.selectExpr("conv_id AS conv", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    counted = {r.turn: r.tokens for r in chat.with_tokens(turns, helpers.tokenizer()).collect()}
    assert counted == {k: len(ids) - 1 + 4 for k, ids in enumerate(helpers.encode([r[3] for r in rows], 1))}
    guessed = {r.turn: r.tokens for r in chat.with_tokens(turns, None).collect()}
    assert guessed == {0: 484, 1: 7, 2: 4, 3: 6}


def test_planted_conversation_and_all_rows(spark, sf_dir):
    got = {r.conv_id: tuple(r)[1:5] for r in queries.op2_chat_windows(spark, sf_dir).collect()}
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "conversations").collect()]
    said = "</s>[INST] ok [/INST]"
    assert got == expected(rows + [(-7, 0, "user", said), (-7, 1, "assistant", said)])


def test_empty_table(spark):
    assert chat.read_back(chat.windows(spark.createDataFrame([], SCHEMA))).count() == 0


@settings(max_examples=200)
@given(st.text(r"<\[]/s>INT|turnedYS", max_size=30))
def test_control_strings_are_escaped_reversibly(text):
    import re

    escaped = re.sub(chat.ESCAPE, r"\1\\\2\3", text)
    assert chat.unescaped(escaped) == text
    assert not re.search(r"</?s>|\[/?INST\]|<\|turn\|>|<\|end\|>", escaped)
