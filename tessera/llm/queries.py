"""The registered queries of this package: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import quality, toxicity
from tessera.llm.bpe import bpe_round_trip
from tessera.llm.embeddings import embedding_links
from tessera.llm.packing import pack_documents
from tessera.llm.repair import repaired_conversations
from tessera.llm.repeats import cut_repeats, removal_report
from tessera.llm.sharding import stratified_shards
from tessera.llm.simhash import simhash_components
from tessera.llm.substring import substring_index
from tessera.llm.tokenfile import token_file_index, write_token_files
from tessera.llm.turntrie import conversation_trie
from tessera.llm.warc import resolved_index, write_archives
from tessera.llm.workspace import Workspace, documents

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(documents(spark, sf_dir), Workspace(spark, "op1"), shingle=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"),
                        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))


@query
def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe_round_trip(documents(spark, sf_dir), vocabulary(WORD_BPE))
    return rows.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(documents(spark, sf_dir))
    base_failed = ~quality.passes("base-1")
    return rows.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base_failed.alias("base_failed"), (~base_failed & quality.passes("full-1")).alias("kept"))


ORACLE_SQL["op3_quality_rules"] = quality.ORACLE


@query
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(documents(spark, sf_dir, "embeddings"), Workspace(spark, "op4"), threshold=0.98)


@query
def op5_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "op5")
    write_archives(documents(spark, sf_dir, "pages"), ws.path("archives"), ws)
    return resolved_index(spark, ws.path("archives"), ws)


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, documents(spark, sf_dir, "labels"), Workspace(spark, "op6"))
    rows = toxicity.add_scores(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_index(documents(spark, sf_dir), Workspace(spark, "op7"))


@query
def op8_order_preserving_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), Workspace(spark, "op8"), vocabulary(WORD_BPE))


@query
def op9_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stratified_shards(documents(spark, sf_dir), Workspace(spark, "op9"), "doc_id", "source", "text", shards=8)
    return rows.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "op10")
    write_token_files(documents(spark, sf_dir), ws.path("tokens"), vocabulary(BYTE_BPE))
    return token_file_index(spark, ws.path("tokens"), ws)


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired_conversations(documents(spark, sf_dir, "conversations"), Workspace(spark, "op11"))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(documents(spark, sf_dir, "conversations"), Workspace(spark, "op12"))


@query
def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(cut_repeats(documents(spark, sf_dir), Workspace(spark, "op13"), window=200)).withColumnRenamed("id", "doc_id")
