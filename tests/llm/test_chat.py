import pytest
from pyspark.sql import functions as F

from gleaner.llm import chat

HARD = [
    "", "\n", "\\", "a\\", "</turn>", "\\</turn>", "\\\\</turn>", "</turn>\n", "\n</turn>\n### User:\nx\n</turn>\n", "### User:",
    "\\### User:", "#### User:", "### user:", "### Heading", "###", "</turn", "### Role-:", "### Role-0A:", "</turn></turn>",
    "### ### A:", "a\n### Assistant:\nb", "caf\u00e9 \U0001f600 </turn> \u4e2d", "$1 \\1 \\Q \\E", "\\### Assistant: </turn> ok", "x" * 200000,
    "</turn>" * 20000,
]
ROLES = ["user", "assistant", "system", "", "User", "tool use", "</turn>", "### User:", "a\n", "\u00e9", "role", "role-"]


def conversations(spark, rows):
    # extra columns whose names the operator uses itself
    return spark.createDataFrame(
        [(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, at int, pieces string"
    )


def read(df):
    turns = chat.parsed(F.col("formatted")).alias("turns")
    return {r.conv_id: r for r in df.select("*", turns, chat.masked(F.col("formatted"), F.col("loss")).alias("learnt")).collect()}


def test_every_text_is_read_back(spark):
    rows = [(i, k, ROLES[(i + k) % len(ROLES)], HARD[(i * 7 + k) % len(HARD)]) for i in range(len(HARD)) for k in range(i % 9)]
    got = read(chat.formatted(conversations(spark, rows[::-1])))
    for i in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == i]
        assert [tuple(t) for t in got[i].turns] == [(r[2], r[3]) for r in own]
        assert got[i].learnt == "".join(r[3] for r in own if r[2] == "assistant")
        raw = got[i].formatted.encode()
        assert all(raw[: s.start].endswith(b":\n") and raw[s.start + s.length :].startswith(b"\n</turn>\n") for s in got[i].loss)
    assert len(got) == len({r[0] for r in rows})


def test_only_what_conflicts_is_escaped(spark):
    rows = [(1, 0, "user", "### Heading\n\\alpha <b> </b>"), (2, 0, "user", "say </turn>"), (2, 1, "assistant", "\\</turn>")]
    got = read(chat.formatted(conversations(spark, rows)))
    assert got[1].formatted == "### User:\n### Heading\n\\alpha <b> </b>\n</turn>\n"
    assert got[2].formatted == "### User:\nsay \\</turn>\n</turn>\n### Assistant:\n\\\\</turn>\n</turn>\n"


def test_nulls_ties_and_empty_tables(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "b"), (None, 3, "user", "a"), (None, 3, "assistant", "c"),
        (5, 1, "user", "same"), (5, 1, "user", "same"), (5, None, "assistant", "first"),
    ]
    df = conversations(spark, rows)
    got = read(chat.formatted(df))
    assert [tuple(t) for t in got[None].turns] == [("", ""), ("assistant", "c"), ("user", "a"), ("user", "b")]
    assert [tuple(t) for t in got[5].turns] == [("assistant", "first"), ("user", "same"), ("user", "same")]
    assert chat.formatted(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text",
    ["x", "### User:\nx\n", "### User:\nx\n</turn>", "### user:\nx\n</turn>\n", "### User:\n### A:\n</turn>\n",
     "### User:\nx\n</turn>\n\n", "### User:x\n</turn>\n", "### User:\na </turn> b\n</turn>\n"],
)
def test_the_grammar_is_strict(one, text):
    assert one(chat.parsed(F.lit(text))) is None


def test_the_empty_conversation(one):
    assert one(chat.parsed(F.lit(""))) == []


def test_built_in_functions_only(spark):
    text = chat.formatted(conversations(spark, [(1, 1, "user", "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("Exchange") <= 2
