"""The registered queries: present, over whole tables, and equal to their SQL where there is one."""

import collections

import duckdb

import __spark_entry__ as entry
from tessera.llm import queries as llm

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query_and_the_pipeline_is_registered():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_queries_return_a_row_per_row_of_their_table(spark):
    tables = {"op4_embedding_near_dedup": "embeddings", "op5_warc_revisits": "pages"}
    for name, fn in llm.QUERIES.items():
        if not name.startswith(("op7", "op8", "op11", "op12")):
            assert fn(spark, SF).count() == spark.read.parquet(f"{SF}/{tables.get(name, 'documents')}.parquet").count(), name


def test_oracles(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    for name, sql in llm.ORACLE_SQL.items():
        df = llm.QUERIES[name](spark, SF)
        rel = con.execute(sql)
        assert [d[0] for d in rel.description] == df.columns
        assert collections.Counter(map(tuple, df.collect())) == collections.Counter(rel.fetchall())
