"""Property-graph and memory operators.

A graph is two tables: ``nodes(id, type, properties map<string,string>)`` and
``edges(src, type, dst, properties map<string,string>)``. Every hop is an equi
join; AQE picks broadcast or sort-merge at run time from the actual sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.dedup import last_per_key
from tessera.operators.paths import path_search  # noqa: F401  X1 is a graph operator too
from tessera.operators.recall import relations_of, semantic_recall  # noqa: F401  M3 likewise


def node_id(kind: str, key) -> Column:
    return F.concat(F.lit(kind + ":"), key.cast("string"))


def extract_triples(rows: DataFrame, triples: list[tuple[Column, str, Column]],
                    props: Column | None = None) -> DataFrame:
    """M2: several (src, relation, dst) triples from each structured row with one
    ``inline(array(struct…))`` - a projection, no shuffle."""
    p = props if props is not None else F.create_map().cast("map<string,string>")
    arr = F.array(*[F.struct(s.alias("src"), F.lit(r).alias("type"), d.alias("dst"), p.alias("properties"))
                    for s, r, d in triples])
    return rows.select(F.inline(arr))


def dedup_graph(edges: DataFrame, version: list[str]) -> DataFrame:
    """D3: writing the same edge again merges it; the newest properties (by ``version``) win."""
    e = edges.select("src", "type", "dst", "properties", *version)
    return last_per_key(e, ["src", "type", "dst"], version, ["properties"])


def graph_schema(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Node labels and relation types with their property keys and counts.

    One aggregation per table: the distinct key sets per type are few, so
    ``collect_set`` of the key arrays stays small in the partial aggregates.
    """
    def one(df, kind):
        g = df.groupBy("type").agg(F.count(F.lit(1)).alias("n"),
                                   F.collect_set(F.map_keys("properties")).alias("_ks"))
        return g.select(F.lit(kind).alias("kind"), "type",
                        F.array_join(F.array_sort(F.array_distinct(F.flatten("_ks"))), ",").alias("property_keys"), "n")
    return one(nodes, "node").unionByName(one(edges, "edge"))


def graph_neighbors(seeds: DataFrame, edges: DataFrame, seed_col: str = "id") -> DataFrame:
    """Distinct relations in either direction from each seed entity to its neighbour; ``edges`` may hold an edge
    many times (only what touches a seed is merged)."""
    return relations_of(seeds.select(F.col(seed_col).alias("entity")), edges)


def graph_typed_match(nodes: DataFrame, edges: DataFrame, src_type: str, rel_types: list[str]) -> DataFrame:
    """``(n:src_type)-[r:A|B]->(m)`` - directed and typed; two equi joins."""
    n = nodes.where(F.col("type") == src_type).select(F.col("id").alias("src"))
    e = edges.where(F.col("type").isin(rel_types)).select("src", F.col("type").alias("relation"), "dst")
    m = nodes.select(F.col("id").alias("dst"), F.col("type").alias("dst_type"))
    return n.join(e, "src").join(m, "dst").select("src", "relation", "dst", "dst_type")


def rename_classes(df: DataFrame, col: str, mapping: DataFrame, new: str) -> DataFrame:
    """Equi lookup of a class name; rows whose class has no mapping are dropped (inner).

    No broadcast hint: the mapping is caller data of unknown size, so AQE broadcasts
    it only when its run-time size is under the threshold, else it sort-merges."""
    return df.join(mapping, df[col] == mapping["from_name"], "inner").drop("from_name") \
        .withColumnRenamed("to_name", new)


def limit_global(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """One ``LIMIT n`` over the whole result under a fixed total order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def within_budget(items: DataFrame, key: str, order: list, text: str, budget: int) -> DataFrame:
    """(key, texts): the items of each key in ``order``, joined by newlines, as long as they fit into ``budget``
    characters (newlines included); the first that doesn't fit ends the list. Keys none of whose items fits are left out.

    ``items`` holds the few recalled rows of each key (the k best, the limit), so a key's rows are bounded."""
    w = Window.partitionBy(key).orderBy(*order)
    fits = items.withColumns({"_n": F.row_number().over(w), "_used": F.sum(F.length(text) + 1).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1})
    return (fits.where(F.col("_used") <= budget).groupBy(key)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_n", F.col(text).alias("t")))), lambda x: x["t"]), "\n").alias("texts")))


def context_assembly(queries: DataFrame, episodic: DataFrame, semantic: DataFrame, key: str) -> DataFrame:
    """C11: both memory results of every query (columns ``texts`` of either side) in one prompt text under fixed headings."""
    e, s = episodic.select(key, F.col("texts").alias("_e")), semantic.select(key, F.col("texts").alias("_s"))
    text = F.concat(F.lit("Episodic memory:\n"), F.coalesce(F.col("_e"), F.lit("(none)")),
                    F.lit("\n\nSemantic memory:\n"), F.coalesce(F.col("_s"), F.lit("(none)")))
    return queries.select(key).distinct().join(e, key, "left").join(s, key, "left").select(key, text.alias("context"))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
