"""Full-text recall over a graph's nodes (M3): an inverted index with BM25 scores.

Entities with the same tokens, equally often, have the same score for any query, so the index holds one of them (the smallest
id) and a table of members: of each such class the ``k`` smallest ids, more can't be among the k best. The index is three
written tables: postings ``(token, entity, tf, length, weight)`` of the classes, terms ``(token, df, idf, top, kth)`` and
members ``(class, entity)``; ``df`` and ``kth`` count entities. ``weight`` is a posting's BM25 part without the term's idf, ``top`` the
largest weight of the term and ``kth`` its k-th largest (0 if it has fewer postings). So a term's postings alone promise at
least k entities a score of ``idf * kth``: the best such promise of a query's terms is a floor under its k-th best score.
Terms whose ``idf * top`` together stay under the floor ("spare" terms, the frequent ones) can't lift an entity into the
top k: candidates come from the other terms' postings only, and spare terms are looked up for candidates.

Queries and frequent words multiply, so the rows (query, entity) are never written: postings of the queries' tokens lie in
blocks of whole entities, every block of queries visits every block of postings, sums scores in arrays and hands on
the k best of a query in that block.

Scores are sums of integers (every term's part rounded to six places), so ties do not depend on the order of a sum.
Hot tokens: the index is aggregated map-side, the k largest weights of a token are cut map-side by the rank limit, and
a token's postings are spread over the blocks by entity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import WS_CLASS
from tessera.operators.ordering import settled
from tessera.operators.tokens import attach_small

# The usual BM25 parameters.
K1, B = 1.2, 0.75
PLACES = 6
# Postings and queries of a block (about), and tasks that share the queries' visits to one block of postings.
BLOCK_POSTINGS, BLOCK_QUERIES, SHARES = 100_000, 1024, 8


def keyword_tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens of a text (T12 on the query side)."""
    return F.filter(F.split(F.lower(text), f"{WS_CLASS}+"), lambda x: x != "")


@dataclass(frozen=True)
class TextIndex:
    postings: DataFrame  # token, entity (the smallest of its class), tf, length, weight
    terms: DataFrame  # token, df, idf, top, kth
    members: DataFrame  # class, entity: at most k a class
    k: int  # ``kth`` is the weight of this rank


def text_index(entities: DataFrame, id_col: str, text: Column, k: int = 5) -> TextIndex:
    """Inverted index of ``text`` (null: no token). Rows with a null id are left out; rows with one id are one
    entity whose tokens add up. An empty table gives an empty index. Classes are told by 128 bits."""
    words = entities.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("entity"), F.explode(keyword_tokens(text)).alias("token"))
    counted = words.groupBy("token", "entity").agg(F.count(F.lit(1)).alias("tf"))
    counted = settled(counted)
    bits = [F.bit_xor(F.xxhash64(F.lit(seed), "token", "tf")).alias(name) for seed, name in ((1, "_a"), (2, "_b"))]
    bags = settled(counted.groupBy("entity").agg(F.sum("tf").alias("length"), *bits))
    alike = Window.partitionBy("_a", "_b", "length")
    first = bags.withColumn("_r", F.row_number().over(alike.orderBy("entity"))).where(F.col("_r") <= k)
    members = settled(first.select("entity", "length", F.min("entity").over(alike).alias("class")))
    whole = bags.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"))
    postings = attach_small(counted.join(members, "entity"), whole)
    tf = F.col("tf").cast("double")
    weight = tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    postings = settled(postings.select("token", "entity", "class", "tf", "length", "n", weight.alias("weight")))
    top = postings.groupBy("token").agg(F.max("weight").alias("top"), F.max("n").alias("n"))
    df = counted.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    by_weight = Window.partitionBy("token").orderBy(F.col("weight").desc(), "entity")
    best = postings.select("token", "entity", "weight").withColumn("_r", F.row_number().over(by_weight)).where(F.col("_r") <= k)
    kth = best.where(F.col("_r") == k).select("token", F.col("weight").alias("kth"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    terms = settled(df.join(top, "token").join(kth, "token", "left").select("token", "df", idf.alias("idf"), "top", F.coalesce("kth", F.lit(0.0)).alias("kth")))
    return TextIndex(postings.where(F.col("entity") == F.col("class")).drop("n", "class"), terms, members.select("class", "entity"), k)


def query_terms(queries: DataFrame, index: TextIndex) -> DataFrame:
    """(query_id, token, idf, spare): the distinct tokens of each query that the index holds."""
    q = queries.where(F.col("query_id").isNotNull()).select("query_id", F.explode(F.array_distinct(keyword_tokens(F.col("text")))).alias("token")).distinct()
    q = q.join(index.terms, "token")
    each = Window.partitionBy("query_id")  # the terms of one query text
    rising = each.orderBy(F.col("idf") * F.col("top"), "token").rowsBetween(Window.unboundedPreceding, 0)
    slack = F.lit(10.0 ** -PLACES) * (F.count(F.lit(1)).over(each) + 1)  # the parts are rounded
    floor = F.max(F.col("idf") * F.col("kth")).over(each) - slack
    return q.select("query_id", "token", "idf", (F.sum(F.col("idf") * F.col("top")).over(rising) < floor).alias("spare"))


def posting_blocks(terms: DataFrame, index: TextIndex) -> tuple[DataFrame, int]:
    """The postings of the queries' tokens in blocks (block, tokens, starts, rows, parts, entities) and the number of blocks.

    A block holds whole entities, ascending; the postings of its i-th token are ``starts[i]`` to ``starts[i + 1]`` of ``rows`` (places
    in ``entities``) and ``parts`` (score parts in millionths)."""
    part = (F.round(F.col("idf") * F.col("weight"), PLACES).cast(f"decimal(18,{PLACES})") * 10 ** PLACES).cast("long")
    used = settled(index.postings.join(settled(terms.select("token", "idf").distinct()), "token").select("token", "entity", part.alias("part")))
    blocks = 1 + used.count() // BLOCK_POSTINGS
    names = ["block", "tokens", "starts", "rows", "parts", "entities"]

    def pack(f: pd.DataFrame) -> pd.DataFrame:
        entities, rows = np.unique(f["entity"].to_numpy(), return_inverse=True)
        tokens, of = np.unique(f["token"].to_numpy(), return_inverse=True)
        order = np.lexsort((rows, of))
        starts = np.searchsorted(of[order], np.arange(len(tokens) + 1))
        one = (int(f["block"].iloc[0]), tokens, starts, rows[order], f["part"].to_numpy()[order], entities)
        return pd.DataFrame([one], columns=names)

    kind = index.postings.schema["entity"].dataType.simpleString()
    return settled(used.withColumn("block", F.pmod(F.xxhash64("entity"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(
        pack, f"block int, tokens array<string>, starts array<bigint>, rows array<bigint>, parts array<bigint>, entities array<{kind}>")), blocks


def best_of_blocks(queries: DataFrame, index: TextIndex) -> DataFrame:
    """(query_id, entity, part): of every block of postings the ``index.k`` best entities of a query, parts in millionths."""
    terms = settled(query_terms(queries, index))
    packed, blocks = posting_blocks(terms, index)
    shares = F.array(*[F.lit(i) for i in range(SHARES)])
    buckets = 1 + terms.agg(F.count_distinct("query_id").alias("n")).first()["n"] // BLOCK_QUERIES
    asked = (terms.withColumn("_q", F.pmod(F.xxhash64("query_id"), F.lit(buckets)).cast("int")).groupBy("_q")
             .agg(F.sort_array(F.collect_list(F.struct("query_id", "spare", "token"))).alias("t"))  # the terms of a block of queries
             .select(F.pmod("_q", F.lit(SHARES)).alias("share"), F.col("t")["query_id"].alias("qids"), F.col("t")["spare"].alias("spare"), F.col("t")["token"].alias("asked")))
    visits = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = visits.join(packed.withColumn("share", F.explode(shares)), ["block", "share"])
    k, names = index.k, ["query_id", "entity", "part"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples(index=False):
                held = {t: i for i, t in enumerate(r.tokens)}
                starts, rows, parts, entities = (np.asarray(x) for x in (r.starts, r.rows, r.parts, r.entities))
                size = len(entities)
                total = np.zeros(size, np.int64)
                out, at, n = [], 0, len(r.qids)
                while at < n:
                    end = at + 1
                    while end < n and r.qids[end] == r.qids[at]:
                        end += 1
                    mine = [(held[t], s) for t, s in zip(r.asked[at:end], r.spare[at:end]) if t in held]
                    near = [slice(starts[i], starts[i + 1]) for i, s in mine if not s]
                    if near:
                        for s in near:
                            total[rows[s]] += parts[s]
                        on = np.concatenate([rows[s] for s in near])
                        score = total[on]
                        total[on] = 0
                        for i in (i for i, s in mine if s):
                            own, own_parts = rows[starts[i]:starts[i + 1]], parts[starts[i]:starts[i + 1]]
                            place = np.minimum(np.searchsorted(own, on), len(own) - 1)
                            score += np.where(own[place] == on, own_parts[place], 0)
                        first = score * size + (size - 1 - on)  # by score, ties by the smaller entity
                        most = k * len(near)  # an entity is in ``on`` once a list
                        if len(first) > most:
                            first = np.partition(first, len(first) - most)[-most:]
                        first = np.unique(first)[-k:]
                        out.append((at, entities[size - 1 - first % size], first // size))
                    at = end
                if out:
                    where = np.repeat([o[0] for o in out], [len(o[1]) for o in out])
                    yield pd.DataFrame(dict(zip(names, (np.asarray(r.qids)[where], np.concatenate([o[1] for o in out]), np.concatenate([o[2] for o in out])))))

    kinds = queries.schema["query_id"].dataType.simpleString(), index.postings.schema["entity"].dataType.simpleString()
    return pairs.select("qids", "spare", "asked", "tokens", "starts", "rows", "parts", "entities").mapInPandas(
        run, f"query_id {kinds[0]}, entity {kinds[1]}, part bigint")


def scored_entities(queries: DataFrame, index: TextIndex) -> DataFrame:
    """(query_id, entity, score decimal) of all candidates: every entity of the true top ``index.k`` is among them."""
    w = Window.partitionBy("query_id").orderBy(F.col("part").desc(), "entity")
    best = best_of_blocks(queries, index).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= index.k)
    score = (F.col("part").cast("decimal(28,0)") / F.lit(10 ** PLACES)).cast(f"decimal(28,{PLACES})")
    return best.withColumnRenamed("entity", "class").join(index.members, "class").select("query_id", "entity", score.alias("score"))


def top_entities(queries: DataFrame, index: TextIndex) -> DataFrame:
    """(query_id, rank, entity, score): the ``index.k`` best entities of each query, ties by id.

    ``queries`` has (query_id, text); rows with one id are one query, null ids and texts find nothing. A query none of
    whose tokens is indexed has no row.
    """
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "entity")
    return (scored_entities(queries, index).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= index.k)
            .select("query_id", "rank", "entity", "score"))


def both_ends(edges: DataFrame) -> DataFrame:
    """A row per end of each edge: (entity, relation, neighbor, direction), one pass over the edges."""
    ends = F.array(F.struct(F.col("src").alias("entity"), F.col("type").alias("relation"), F.col("dst").alias("neighbor"), F.lit("out").alias("direction")),
                   F.struct(F.col("dst").alias("entity"), F.col("type").alias("relation"), F.col("src").alias("neighbor"), F.lit("in").alias("direction")))
    return edges.select(F.inline(ends))


def relations_of(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct (entity, relation, neighbor, direction) of the seeds (column ``entity``) in edges as they were written:
    seeds are known before edges are merged, so only what touches a seed is."""
    return both_ends(edges).join(settled(seeds.select("entity").distinct()), "entity").distinct()


def property_text(properties: str = "properties") -> Column:
    """What the index reads of a node: its property values."""
    return F.array_join(F.map_values(properties), " ")


def semantic_recall(queries: DataFrame, nodes: DataFrame, edges: DataFrame, limit: int = 5, index: TextIndex | None = None) -> DataFrame:
    """M3: the ``limit`` best entities of a query by score, one hop either way, ``limit`` rows per query.

    (query_id, entity, score, relation, neighbor, direction), best score first, then by the other columns. ``edges``
    may hold an edge many times. Without an ``index`` one is made of the nodes' property values.
    """
    index = index or text_index(nodes, "id", property_text(), limit)
    top = settled(top_entities(queries, index))
    each = Window.partitionBy("entity").orderBy("relation", "neighbor", "direction")
    relations = settled(relations_of(top, edges).withColumn("_rn", F.row_number().over(each)).where(F.col("_rn") <= limit).drop("_rn"))  # no query takes more of an entity
    rows = top.join(relations, "entity")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "entity", "relation", "neighbor", "direction")
    return (rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)
            .select("query_id", "entity", "score", "relation", "neighbor", "direction"))
