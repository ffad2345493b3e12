import hashlib

import pytest
from hypothesis import given, strategies as st

from glosswork.llm import chat

PART = st.sampled_from(["\\", "#", "###", "### ", "</turn>", " </turn>\n", ": ", "user", "a", "\n", " ", "é", "\\\\", "\\#"])
CONTENT = st.lists(PART, max_size=12).map("".join)


@given(st.lists(st.tuples(CONTENT, CONTENT), max_size=5))
def test_conversations_read_back(turns):
    rendered = [chat.render_turn(role, text) for role, text in turns]
    assert chat.parse("".join(r for r, _, _ in rendered)) == turns
    for (_, text), (shown, start, end) in zip(turns, rendered, strict=True):
        assert shown[start:end] in (text, chat.escape(text))


def test_plain_content_is_not_escaped():
    assert chat.render_turn("user", "a\\b # c")[0] == "### user: a\\b # c </turn>\n"
    assert chat.render_turn("user", "\\###")[0] == "### user: \\\\\\### </turn>\n"


@pytest.mark.parametrize("text", ["x", "### user", "### user: a", "### user: a </turn>", "### u: ### </turn>\n"])
def test_other_text_is_refused(text):
    with pytest.raises(chat.GrammarError):
        chat.parse(text)


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((t, r or "", x or "") for c, t, r, x in rows if c == conv),
            key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]),
        )
        loss = "".join(x for _, r, x in own if r == "assistant")
        turns = "".join(f"{r}\n{x}\n" for _, r, x in own)
        out[conv] = (
            len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
            sum(len(chat.render_turn(r, x)[0]) for _, r, x in own),
        )
    return out


def test_digests(spark):
    said = "\\### Assistant: </turn> ok"
    rows = [
        (-7, 0, "user", said), (-7, 1, "assistant", said), (1, 0, "user", None), (1, 1, None, "x"),
        (1, 1, None, "x"), (1, 2, "assistant", ""), (1, None, "system", "é"), (None, 1, "assistant", "q"),
        (2, 1, "assistant", "</turn>\n### user: "), (2, 0, "assistant", "\\"),
    ] + [(5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(500)]
    frame = spark.createDataFrame(
        [(*r, "extra") for r in rows], "conv_id bigint, turn bigint, role string, text string, rendered string"
    )
    got = {r[0]: tuple(r)[1:] for r in chat.conversation_digests(chat.format_turns(frame)).collect()}
    assert got == brute(rows)


def test_empty(spark):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.conversation_digests(chat.format_turns(frame)).count() == 0
