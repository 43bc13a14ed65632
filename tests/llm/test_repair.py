"""Conversation repair against plain Python, segments and ties included."""

import random

import pytest

from tessera.llm.repair import repaired_conversations, SuffixAutomaton, FINAL
from tessera.llm.workspace import Workspace, documents
from tests.llm.brute import repair

SCHEMA = "conv_id long, turn long, role string, text string"


def result(spark, df, **kw):
    rows = repaired_conversations(df, Workspace(spark, "t11"), **kw).collect()
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("segment", [3, 512])
def test_random_conversations_in_segments_of_any_size(spark, segment):
    rng = random.Random(segment)
    rows = []
    for c in [None, *range(60)]:
        for t in range(rng.choice([1, 2, 5, 9, 14])):
            turn = rng.choice([t, t, t, t + 3, None])
            rows.append((c, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u2"]),
                         rng.choice(["Yes.", "No", "", " \t", None, "Well? ", f"a{t}.", "é!"])))
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(spark, df, segment=segment) == repair(rows)


def test_given_table_and_an_extra_column(spark):
    table = documents(spark, "/root/testdata/sf0.001", "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert result(spark, table.selectExpr("*", "turn as seg", "role as symbol")) == repair(rows)


def test_no_rows_and_a_conversation_that_the_damage_drops(spark):
    assert result(spark, spark.createDataFrame([], SCHEMA)) == {}
    rows = [(c, 0, "user", "Hi.") for c in range(60)]
    got = result(spark, spark.createDataFrame(rows, SCHEMA))
    assert got == repair(rows) and any(v[-2] == "" for v in got.values())


def test_a_state_is_built_once_for_all_words_that_share_its_suffix():
    a = SuffixAutomaton()
    words = sorted(["suaua", "uaua", "ua", "xua".replace("x", "o"), "-ua"], key=lambda w: w[::-1])
    for w in words:
        a.solve(w, FINAL)
    assert a.built == 1 + len({w[k:] for w in words for k in range(len(w))})
