"""The conversation trie against plain Python, with shards and levels down to a few turns."""

import random

import numpy as np
import pytest

from tessera.llm.turntrie import conversation_trie, pack
from tessera.llm.workspace import Workspace, documents
from tests.llm.brute import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def result(spark, df, **kw):
    rows = conversation_trie(df, Workspace(spark, "t12"), **kw).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


@pytest.mark.parametrize(("block", "shard"), [(2, 5), (3, 9), (256, 7), (256, 200_000)])
def test_random_conversations_in_any_cut(spark, block, shard):
    rng = random.Random(block * shard)
    rows = []
    for c in [*range(100, 140), *range(200, 215), *range(302, 306), 7, None]:
        copy = rng.random() < 0.4
        for t in range(rng.choice([1, 3, 6, 9])):
            role, text = (["u", "a"][t % 2], "same") if copy else (rng.choice(["u", "a", None]), rng.choice(["x", "yé", "", None]))
            rows.append((c, rng.choice([t, t, None]), role, text))
    assert result(spark, spark.createDataFrame(rows, SCHEMA), block=block, shard=shard) == trie(rows)


def test_given_table_and_clashing_columns(spark):
    table = documents(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert result(spark, table.selectExpr("*", "turn as pos", "role as level", "text as key")) == trie(rows)


def test_empty_table_and_conversations_without_a_turn(spark):
    assert result(spark, spark.createDataFrame([], SCHEMA)) == []
    rows = [(c, 0, "user", "a") for c in range(1, 40)]
    assert result(spark, spark.createDataFrame(rows, SCHEMA)) == trie(rows)


def test_double_array_holds_exactly_the_packed_strings():
    rng = random.Random(1)
    strings = sorted({tuple(rng.randrange(1, 9) for _ in range(rng.randrange(1, 6))) for _ in range(300)})
    flat = np.array([x for s in strings for x in s], np.int64)
    sizes = np.array([len(s) for s in strings])
    t = pack(flat, np.cumsum(sizes) - sizes, sizes)
    prefixes = {s[:d] for s in strings for d in range(1, len(s) + 1)}
    assert int((t.check > 0).sum()) == len(prefixes)
    for p in [*prefixes, (8, 8, 8, 8, 8, 8), (9,)]:
        state = np.array([1])
        for x in p:
            state = t.step(state, np.array([x])) if state[0] else state
        assert (state[0] > 0) == (p in prefixes)
