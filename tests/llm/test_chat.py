"""Formatted conversations hold every turn, exactly, and only assistant texts under the mask."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.plans import physical
from tidemark.llm.chat_format import IM, INSTRUCT, Template, format_chat, read_loss, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, formatted int, blocks string, t int, turns int"
NASTY = ["[", "INST]", "/INST]", "[INST]", "[/INST]", "<", "s>", "/s>", "<s>", "</s>", "\\", "\\\\", "é😀", "\n", "$1", "<|im_end|>", "|im_sep|>", " ", "a b"]
ROLES = ["user", "assistant", "system", "", None, "[/INST]", "assistant ", "</s>"]
piece = st.lists(st.sampled_from(NASTY), max_size=6).map("".join)
turn = st.tuples(st.integers(1, 3), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(ROLES), st.one_of(st.none(), piece))


def check(spark, rows, template):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    out = format_chat(df, template=template)
    assert out.columns == ["conv_id", "blocks", "formatted", "loss_mask"]
    found = out.withColumn("back", read_turns(F.col("formatted"), template)).withColumn("loss", read_loss(F.col("formatted"), F.col("loss_mask"), template)).collect()
    want = {}
    for conv, number, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(conv, []).append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.back] for r in found} == want
    for r in found:
        turns = want[r.conv_id]
        assert [t for b in r.blocks for t in b.texts] == [t for _, t in turns]
        assert all(a.role != b.role for a, b in zip(r.blocks, r.blocks[1:]))
        assert sum(m.skip + m.take + m.rest for m in r.loss_mask) == len(r.formatted)
        assert list(r.loss) == [t if role == "assistant" else "" for role, t in turns]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(turn, min_size=1, max_size=12), st.sampled_from([INSTRUCT, IM]))
def test_round_trip(spark, rows, template):
    check(spark, rows, template)


def test_edges(spark):
    long = "</s>" * 50_000 + "\\" * 50_000
    rows = [(None, 1, "user", "no id"), (1, None, None, None), (1, 2, "user", "same"), (1, 2, "user", "same"), (2, 0, "assistant", long), (3, 5, "assistant", ""), (3, 4, "assistant", "[INST]")]
    rows += [(4, i, "assistant" if i % 3 else "user", f"turn {i}") for i in range(3000)]
    check(spark, rows, INSTRUCT)
    empty = spark.createDataFrame([], SCHEMA)
    assert format_chat(empty).collect() == []


def test_only_expressions(spark):
    plan = physical(format_chat(spark.createDataFrame([], SCHEMA)))
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("controls", [("", "b", "c", "d"), ("[a", "[a", "c", "d"), ("[a", "<[b", "c", "d"), ("[\\", "<b", "c", "d"), ("[a", "[ab", "<", "d")])
def test_templates_that_cannot_be_read_back_are_refused(controls):
    with pytest.raises(ValueError):
        Template(*controls)
