r"""Conversations as marked-up text whose turns read back unchanged.

Grammar of the output:

    conversation = { turn }
    turn         = "### " role ": " text " </turn>" LF

Inside role and text a backslash stands before a backslash, ``###`` or
``</turn>`` (in roles also before ``:`` and a line break) that belongs to the
content; any other backslash stands for itself. Rendering tries the content as
it is, reparses the result with the deterministic parser, and escapes the
content that came back different until the turn is identical. Escaping every
backslash and control string always reads back, so two tries suffice.

Turns render independently, so a conversation that holds a third of all rows is
rendered by all tasks. Only the digests of ``conversation_digests`` need whole
conversations in order: their rows stream through one task that holds one turn
at a time and running hashes.

Defined results: null text and null role are empty; turns sort by turn (nulls
first), then role, then text, so ties and repeated rows have one order and all
count; a null conv_id is a conversation of its own; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

OPEN, SEP, CLOSE = "### ", ": ", " </turn>\n"
ESCAPED = re.compile(r"\\|###|</turn>")
ROLE_ESCAPED = re.compile(r"\\|###|</turn>|:|\n")
RENDERED = "conv_id bigint, turn bigint, role string, text string, rendered string, loss_start int, loss_end int"
DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint"
)
DIGESTS_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


class GrammarError(ValueError):
    """Text that is not a sequence of turns."""


def escape(content: str, control: re.Pattern = ESCAPED) -> str:
    return control.sub(lambda m: "\\" + m[0], content)


def _read_until(text: str, at: int, end: str, control: re.Pattern) -> tuple[str, int]:
    """Unescaped content from ``at`` to the first bare ``end``; position after it."""
    parts, stop = [], -1
    while True:
        slash = text.find("\\", at)
        stop = stop if stop >= at else text.find(end, at)
        if stop < 0:
            raise GrammarError(f"no {end!r} after position {at}")
        if slash < 0 or stop < slash:
            bare = text[at:stop]
            if "###" in bare or "</turn>" in bare:
                raise GrammarError(f"a bare control string after position {at}")
            return "".join([*parts, bare]), stop + len(end)
        bare = text[at:slash]
        if "###" in bare or "</turn>" in bare:
            raise GrammarError(f"a bare control string after position {at}")
        literal = control.match(text, slash + 1)
        parts += [bare, literal[0] if literal else "\\"]
        at = literal.end() if literal else slash + 1


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int]:
    """Role, text and the position after the turn that starts at ``at``."""
    if not text.startswith(OPEN, at):
        raise GrammarError(f"no turn at position {at}")
    role, at = _read_until(text, at + len(OPEN), SEP, ROLE_ESCAPED)
    content, at = _read_until(text, at, CLOSE, ESCAPED)
    return role, content, at


def parse(text: str) -> list[tuple[str, str]]:
    """All turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(text):
        role, content, at = parse_turn(text, at)
        turns.append((role, content))
    return turns


def _reads_back(rendered: str, role: str, content: str) -> bool:
    try:
        return parse_turn(rendered) == (role, content, len(rendered))
    except GrammarError:
        return False


def render_turn(role: str, content: str) -> tuple[str, int, int]:
    """The turn as text and the span of its content, escaped as far as needed."""
    tries = (
        (role, content),
        (role, escape(content)),
        (escape(role, ROLE_ESCAPED), content),
        (escape(role, ROLE_ESCAPED), escape(content)),
    )
    for shown_role, shown in tries:
        start = len(OPEN) + len(shown_role) + len(SEP)
        rendered = f"{OPEN}{shown_role}{SEP}{shown}{CLOSE}"
        if _reads_back(rendered, role, content):
            return rendered, start, start + len(shown)
    raise GrammarError(f"a turn of {len(content)} characters does not read back")


def format_turns(conversations: DataFrame) -> DataFrame:
    """One row per turn with ``rendered`` and the span of assistant text in it.

    Concatenated in the order of ``conversation_digests``, the rendered turns
    are the formatted conversation. Spans are empty for other roles.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rendered, starts, ends = [], [], []
            for role, content in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text, start, end = render_turn(role, content)
                rendered.append(text)
                starts.append(start)
                ends.append(end if role == "assistant" else start)
            columns = [*batch.columns, pa.array(rendered), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
            names = ["conv_id", "turn", "role", "text", "rendered", "loss_start", "loss_end"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def empty_if_null(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    rows = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), empty_if_null("role"), empty_if_null("text")
    )
    return rows.mapInArrow(render, RENDERED)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, all read back from the rendered turns with the parser."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, current, state = False, None, None

        def row() -> dict:
            turns, loss, n_turns, loss_chars, size = state
            return {
                "conv_id": current,
                "n_turns": n_turns,
                "turns_sha256": turns.hexdigest(),
                "loss_chars": loss_chars,
                "loss_sha256": loss.hexdigest(),
                "formatted_chars": size,
            }

        for batch in batches:
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "rendered", "loss_start", "loss_end"))
            for conv, rendered, start, end in zip(*columns, strict=True):
                if not started or conv != current:
                    if started:
                        done.append(row())
                    started, current, state = True, conv, [hashlib.sha256(), hashlib.sha256(), 0, 0, 0]
                for role, content in parse(rendered):
                    state[0].update(f"{role}\n{content}\n".encode())
                    state[2] += 1
                if end > start:
                    masked, _ = _read_until(rendered[start:end] + CLOSE, 0, CLOSE, ESCAPED)
                    state[1].update(masked.encode())
                    state[3] += len(masked)
                state[4] += len(rendered)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=DIGESTS_ARROW)
        if started:
            yield pa.RecordBatch.from_pylist([row()], schema=DIGESTS_ARROW)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(digest, DIGESTS)
