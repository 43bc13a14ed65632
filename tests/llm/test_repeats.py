"""Repeated byte strings against a table of all windows."""

import random

import pytest

from tessera.llm.repeats import cut_repeats, removal_report
from tessera.llm.workspace import Workspace, documents
from tests.llm.brute import cut


def result(spark, df, **kw):
    return sorted((tuple(r) for r in removal_report(cut_repeats(df, Workspace(spark, "t13"), **kw)).collect()), key=str)


def want(rows, window):
    return sorted(((i, *c) for (i, _), c in zip(rows, cut([t for _, t in rows], window), strict=True)), key=str)


@pytest.mark.parametrize(("window", "letters"), [(200, "abc déf ghi"), (40, "ab"), (7, "abé"), (2, "abcd")])
def test_random_texts_with_edits_and_periods(spark, window, letters):
    rng = random.Random(window)
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    base = [word(rng.randrange(window, 6 * window)) for _ in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(t))
            t[k:k + rng.randrange(2)] = word(rng.randrange(1, 4))
        a = rng.randrange(len(t))
        rows.append((100 + i, "".join(t[a:a + rng.randrange(4 * window)])))
    rows += [(1, "a" * (5 * window)), (None, "a" * window + "b"), (2, "ab" * window), (3, "a" * (window - 1)), (4, ""), (None, None),
             (5, base[0]), (5, base[0]), (6, "x" + base[1] + base[1][:window])]
    assert result(spark, spark.createDataFrame(rows, "doc_id long, text string"), window=window) == want(rows, window)


def test_given_table_with_clashing_columns(spark):
    table = documents(spark, "/root/testdata/sf0.001").filter("length(text) < 6000")
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    assert result(spark, table.selectExpr("*", "doc_id as id", "lang as key", "source as place")) == want(rows, 200)


def test_empty_tables(spark):
    assert result(spark, spark.createDataFrame([], "doc_id long, text string")) == []
