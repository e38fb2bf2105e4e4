import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from chronogrid.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
ROWS = [
    (1, 0, "system", "be </s> brief", "x"), (1, 1, "user", "[INST] hi \\ [/INST]", "x"), (1, 2, "assistant", "a\nb", "x"), (1, 3, "user", "more", "x"), (1, 4, "assistant", "", "x"), (1, 5, "user", "bye", "x"),
    (2, 0, "user", None, "x"), (3, 0, "assistant", "first", "x"), (3, 0, "assistant", "first", "x"), (3, None, "tool<s>", "t", "x"), (None, 0, "user", "n", "x"), (None, 1, "assistant", "m", "x"), (4, 0, None, "x", "x"),
]


def expected(rows):
    convs = {}
    for conv, turn, role, text, _ in rows:
        convs.setdefault(conv, []).append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        said = [(r[1], t[1]) for _, r, t in turns]
        loss = "".join(t for r, t in said if r == "assistant")
        out[conv] = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len("".join("".join(C.render(r, t)) for r, t in said)))
    return out


def test_digests_read_back(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    got = {r.conv_id: tuple(r)[1:6] for r in C.digests(C.prefix_targets(df)).collect()}
    assert got == expected(ROWS)


def test_one_example_a_reply_and_only_it_is_trainable(spark):
    got = sorted((tuple(r) for r in C.prefix_targets(spark.createDataFrame(ROWS[:6], SCHEMA)).collect()), key=lambda r: r[2])
    assert [(r[1], r[2]) for r in got] == [(2, 3), (4, 5), (None, 6)]
    assert [C.unescape(r[3][r[4] : r[5]]) for r in got] == ["a\nb", "", ""]
    assert C.parse(got[1][3]) == [(r, t) for _, _, r, t, _ in ROWS[:5]]


def test_empty_table(spark):
    assert C.digests(C.prefix_targets(spark.createDataFrame([], SCHEMA))).collect() == []


def test_long_text_is_whole(spark):
    text = "<s>[INST]\\" * 30_000
    got = C.digests(C.prefix_targets(spark.createDataFrame([(1, 0, "assistant", text, "")], SCHEMA))).collect()[0]
    assert got.loss_chars == len(text) and got.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


pieces = st.lists(st.sampled_from([*C.CONTROL, "\\", "<", ">", "[", "]", "s>", "/INST]", " ", "\n", "x", "é"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "<s>", "a <<SAYS>> b"]), pieces), min_size=1, max_size=5))
def test_template_is_reversible(turns):
    assert C.parse("".join("".join(C.render(r, t)) for r, t in turns)) == turns


@pytest.mark.parametrize("mark", C.CONTROL)
def test_no_control_string_is_left_in_a_text(mark):
    assert mark not in C.escape(f"<{mark}{mark[0]}{mark}>") and C.unescape(C.escape(mark * 3)) == mark * 3
