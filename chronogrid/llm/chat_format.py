"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and
only its reply is trainable. The template marks turns with control strings; such strings
inside texts are escaped so that the formatted text reads back to the same turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded

CONTROL = ("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<<ROLE>>", "<<SAYS>>", "<</ROLE>>")
_TO_ESCAPE = re.compile(r"\\|" + "|".join(re.escape(c) for c in CONTROL))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_MARKS = {"system": ("<<SYS>> ", " <</SYS>>\n"), "user": ("[INST] ", " [/INST]\n"), "assistant": ("<s> ", " </s>\n")}
_TURN = re.compile(r"<<SYS>> (?P<system>.*?) <</SYS>>\n|\[INST\] (?P<user>.*?) \[/INST\]\n|<s> (?P<assistant>.*?) </s>\n|<<ROLE>> (?P<role>.*?) <<SAYS>> (?P<said>.*?) <</ROLE>>\n", re.DOTALL)

EXAMPLES = "conv_id long, target long, n_turns long, formatted string, loss_start long, loss_end long"


def escape(text: str) -> str:
    """``text`` without control strings: a backslash after the first character of each, backslashes doubled."""
    return _TO_ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, str, str]:
    """(mark before, escaped text, mark after) of one turn."""
    before, after = _MARKS.get(role) or (f"<<ROLE>> {escape(role)} <<SAYS>> ", " <</ROLE>>\n")
    return before, escape(text), after


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        role = m.lastgroup if m.lastgroup != "said" else unescape(m["role"])
        turns.append((role, unescape(m[m.lastgroup])))
        at = m.end()
    return turns


def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation and turn -> examples. Holds one conversation's prefix."""
    out: list[tuple] = []
    held = 0
    conv, parts, length, turns, open_ = object(), [], 0, 0, False

    def flush():
        nonlocal out, held
        done, out, held = out, [], 0
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()))], ["conv_id", "target", "n_turns", "formatted", "loss_start", "loss_end"])

    def rest():
        """Turns after the last reply, or all if there is none: an example that trains nothing."""
        return (conv, None, turns, "".join(parts), length, length)

    for batch in batches:
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
            if c != conv:
                if open_:
                    out.append(rest())
                    held += length
                conv, parts, length, turns, open_ = c, [], 0, 0, False
            before, body, after = render(role or "", text or "")
            parts += (before, body, after)
            start = length + len(before)
            length, turns, open_ = start + len(body) + len(after), turns + 1, True
            if role == "assistant":
                out.append((c, turns - 1, turns, "".join(parts), start, start + len(body)))
                held, open_ = held + length, False
            if held > 4 << 20:
                yield flush()
    if open_:
        out.append(rest())
    yield flush()


def prefix_targets(conversations: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, target (its place among the turns), n_turns (up to it), formatted, loss_start, loss_end.

    ``formatted`` holds all turns up to the target; the half-open range of code points
    [loss_start, loss_end) is the reply, the only trainable part. Turns that no reply
    follows would be lost, so a conversation that does not end in a reply has one more
    row with a null target and an empty range, over all its turns.

    Turns are ordered by turn, role and text, nulls first; repeated rows are turns of
    their own. Null roles and texts count as empty; a null conv_id is a conversation.
    Long texts are whole. Other columns are not read; an empty table gives no rows.
    Turns are dealt by conversation and streamed in order; a task holds one prefix at a
    time, while its output is as long as the expansion asks for.
    """
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    turns = bounded(turns, 2048).repartition(int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions")), "conv_id")
    return turns.sortWithinPartitions("conv_id", "turn", F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first()).mapInArrow(_expanded, EXAMPLES)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    conv, last = object(), None
    loss, chars, n, total = hashlib.sha256(), 0, 0, 0

    def closed():
        seen = parse(last)
        digest = hashlib.sha256()
        for role, text in seen:
            digest.update(f"{role}\n{text}\n".encode())
        return (conv, len(seen), digest.hexdigest(), chars, loss.hexdigest(), len(last), n, total)

    for batch in batches:
        for c, formatted, start, end in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5)), strict=True):
            if c != conv:
                if last is not None:
                    rows.append(closed())
                conv, loss, chars, n, total = c, hashlib.sha256(), 0, 0, 0
            reply = unescape(formatted[start:end])
            loss.update(reply.encode())
            chars, n, total, last = chars + len(reply), n + 1, total + len(formatted), formatted
        yield _digest_batch(rows)
        rows = []
    if last is not None:
        rows.append(closed())
    yield _digest_batch(rows)


_DIGESTS = (("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_examples", pa.int64()), ("example_chars", pa.int64()))


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(_DIGESTS)], [name for name, _ in _DIGESTS])


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples as ``prefix_targets`` yields them (in order, without a new shuffle).

    turns_sha256 is over role, newline, text, newline of the longest example's turns,
    loss_sha256 over the replies under the loss ranges; formatted_chars is the length of
    the longest example, example_chars that of all.
    """
    return examples.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, example_chars long")
