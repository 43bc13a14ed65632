"""Token, label, mask and batch arrays.

Everything per sequence is a higher-order array expression (``transform``,
``slice``, ``filter``) evaluated inside whole-stage codegen. Shuffles happen only
where rows of different sequences meet: the vocabulary count, the dictionary
join, batch numbering and packing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import char_tokens
from tessera.operators.ordering import join_same, md5_order, running_sums, with_global_index

# Special tokens and their ids; ordinary ids start after them.
PAD_TOKEN, PAD_ID = "<PAD>", 0
UNK_TOKEN, UNK_ID = "<UNK>", 1
IGNORE_INDEX = -100


def build_vocab(texts: DataFrame, text: str, first_id: int = 2) -> DataFrame:
    """Every distinct character token, ids by rank (count, then token) from ``first_id``.

    Counting is a partial aggregate; the ranking has one row per distinct character, of
    which Unicode bounds the number.
    """
    toks = texts.select(F.explode(char_tokens(F.col(text))).alias("token"))
    counts = toks.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("token", (F.row_number().over(Window.orderBy(F.desc("n"), F.asc("token")))
                                   + F.lit(first_id - 1)).cast("int").alias("id"))


def with_specials(vocab: DataFrame) -> DataFrame:
    """Vocabulary table including ``<PAD>`` and ``<UNK>``."""
    spark = vocab.sparkSession
    sp = spark.createDataFrame([(PAD_TOKEN, PAD_ID), (UNK_TOKEN, UNK_ID)], "token string, id int")
    return sp.unionByName(vocab)


def vocab_encode(df: DataFrame, key: list[str], tokens: str, vocab: DataFrame, out: str = "input_ids",
                 unk_id: int = UNK_ID) -> DataFrame:
    """Token -> id, unknown -> ``<UNK>``, order kept.

    Only the distinct tokens of each sequence travel: they are joined to the vocabulary (AQE
    broadcasts it when its run-time size is under the threshold, else sort-merge) and come back
    as one map per sequence, which a ``transform`` applies. No vocabulary size is assumed.
    """
    ex = df.select(*key, F.explode(F.array_distinct(F.col(tokens))).alias("token"))
    j = ex.join(vocab.select("token", F.col("id").alias("_id")), "token")
    maps = j.groupBy(*key).agg(F.map_from_entries(F.collect_set(F.struct("token", "_id"))).alias("_map"))
    known = F.coalesce(F.col("_map"), F.create_map().cast("map<string,int>"))
    return (join_same(df, maps, key, "left").withColumn("_map", known)
            .withColumn(out, encode_with_map(F.coalesce(F.col(tokens), F.array().cast("array<string>")), F.col("_map"), unk_id))
            .drop("_map"))


def truncate_tokens(ids, max_len: int) -> Column:
    """A1: first ``max_len`` tokens."""
    return F.slice(ids, 1, max_len)


def marker_position(ids, marker: Column, m: int) -> Column:
    """1-based start of the first occurrence of the ``m``-token marker, else null.

    The first-element test runs before the slice compare, so the O(T*m) compare
    only happens at candidate positions.
    """
    n = F.size(ids) - F.lit(m) + 1
    cand = F.when(n >= 1, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    hits = F.filter(cand, lambda i: (F.element_at(ids, i) == F.element_at(marker, 1))
                    & (F.slice(ids, i, m) == marker))
    return F.try_element_at(hits, F.lit(1))


def loss_mask_marker(ids, marker: Column, m: int) -> Column:
    """A2: ones from the token after marker+newline to the end (pad and later turns too);
    zeros everywhere when the marker is absent."""
    return mask_from_position(ids, marker_position(ids, marker, m), m)


def mask_from_position(ids, pos, m: int) -> Column:
    """Zeros up to the marker, its length and the newline, ones after; no lambda, so the
    marker search is evaluated once per row (not once per element)."""
    n = F.size(ids)
    zeros = F.least(pos - 1 + F.lit(m) + 1, n)  # positions before the answer start
    return F.when(pos.isNull(), F.array_repeat(F.lit(0), n)).otherwise(
        F.concat(F.array_repeat(F.lit(0), zeros), F.array_repeat(F.lit(1), n - zeros)))


def labels_prompt_cut(full_ids, prompt_len) -> Column:
    """A3: -100 on the first min(prompt, full) positions, then the ids."""
    cut = F.least(prompt_len, F.size(full_ids))
    rest = F.slice(full_ids, cut + 1, F.greatest(F.size(full_ids) - cut, F.lit(0)))
    return F.concat(F.array_repeat(F.lit(IGNORE_INDEX), cut), rest)


def labels_copy(ids) -> Column:
    """A4: full-sequence loss, labels are the ids."""
    return ids


def attention_mask(ids, pad_id: int = PAD_ID, length=None) -> Column:
    """A5: 1 for real tokens, 0 for pad.

    With ``length`` (the true length before padding) the mask goes by position, which is the
    form to use when the pad token is also the end mark."""
    if length is not None:
        n = F.least(length, F.size(ids))
        return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.size(ids) - n))
    return F.transform(ids, lambda x: F.when(x != F.lit(pad_id), 1).otherwise(0))


def shift_align(ids, labels, mask):
    """Position i predicts i+1: inputs lose the last, labels and mask lose the first."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.slice(ids, 1, n), F.slice(labels, 2, n), F.slice(mask, 2, n)


def assign_batches(df: DataFrame, id_col: str, bs: int, seed: str = "42", name: str = "batch") -> DataFrame:
    """Shuffled order (md5 of id||seed, then id) cut in batches of ``bs``; last one short.

    The global position comes from range partitioning (see ``ordering``), so no single task
    numbers the whole table. The rows themselves are numbered, so rows with a null id (first in the
    order) or a repeated one have their own places.
    """
    idx = with_global_index(df.withColumn("_shuf", md5_order(id_col, seed)), [F.col("_shuf"), F.col(id_col)], "_g")
    return idx.select(*df.columns, F.floor(F.col("_g") / bs).cast("long").alias(name))


def pad_batch(df: DataFrame, batch: str, ids: str, labels: str, max_len: int | None = None,
              pad_id: int = PAD_ID, ignore: int = IGNORE_INDEX) -> DataFrame:
    """T = longest in the batch, at most ``max_len`` if given; ids padded with ``pad_id``, labels with -100.

    A batch holds at most ``bs`` rows, so the window per batch is bounded.
    """
    T = F.max(F.size(ids)).over(Window.partitionBy(batch))
    if max_len is not None:
        T = F.least(T, F.lit(max_len))

    def fit(c, fill):
        cut = F.slice(F.col(c), 1, T)
        return F.concat(cut, F.array_repeat(F.lit(fill), T - F.size(cut)))

    return df.withColumn(ids, fit(ids, pad_id)).withColumn(labels, fit(labels, ignore))


def pack_sequences(df: DataFrame, key: str, ids: str, max_len: int, buckets: int) -> DataFrame:
    """Concatenate sequences of a bucket (md5 of the key, ``buckets`` of them) in key order and cut
    into ``max_len`` chunks.

    Where a sequence starts in its bucket is a running sum over chunks of range partitions, so a bucket
    spans many tasks; sequences are cut at chunk borders and travel as arrays, one group per chunk. Sequences
    without a key are a bucket of their own; those that share a key follow each other by a hash of their ids.
    """
    bucket = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(buckets))
    b = df.select(F.col(key).alias("_k"), F.col(ids).alias("_ids"), bucket.alias("bucket"), F.size(ids).cast("long").alias("_n")).where("_n > 0")
    ends = running_sums(b, ["bucket"], [F.col("_k"), F.xxhash64("_ids"), F.col("_ids")], {"_end": F.col("_n")})
    placed = ends.withColumn("_start", F.col("_end") - F.col("_n"))
    first, last = F.floor(F.col("_start") / max_len), F.floor((F.col("_end") - 1) / max_len)
    cut = placed.withColumn("chunk", F.explode(F.sequence(first, last)))
    at = F.greatest(F.col("chunk") * max_len - F.col("_start"), F.lit(0))
    stop = F.least((F.col("chunk") + 1) * max_len - F.col("_start"), F.col("_n"))
    piece = F.slice("_ids", (at + 1).cast("int"), (stop - at).cast("int"))
    return (cut.select("bucket", "chunk", F.struct(F.col("_start"), piece.alias("p")).alias("s"))
            .groupBy("bucket", "chunk")
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list("s")), lambda x: x["p"])).alias("packed")))


def masked_sums(loss: Column, mask: Column) -> tuple[Column, Column]:
    """sum(loss * mask) and sum(mask) of one sequence, from its per-token arrays."""
    add = lambda acc, x: acc + F.coalesce(x, F.lit(0.0))
    zero = F.lit(0.0)
    return (F.aggregate(F.zip_with(loss, mask, lambda a, b: (a * b).cast("double")), zero, add),
            F.aggregate(F.transform(mask, lambda x: x.cast("double")), zero, add))


def masked_mean_loss(df: DataFrame, group: list[str], loss_sum: str, mask_sum: str) -> DataFrame:
    """sum(loss * mask) / (sum(mask) + 1e-8) per group, from the sums of each sequence (``masked_sums``)."""
    return df.groupBy(*group).agg((F.sum(loss_sum) / (F.sum(mask_sum) + F.lit(1e-8))).alias("masked_loss"))


def attach_small(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row table of bounded size (marker ids, gate
    vectors, channel statistics) to every row.

    The row is a scalar subquery: computed once, then handed to every task as a
    value - no join, so no nested-loop or cartesian operator in the plan.
    """
    cols = one_row.columns
    packed = one_row.select(F.struct(*cols).alias("_s")).scalar()
    out = df.withColumn("_small", packed)
    return out.select(*[F.col(c) for c in df.columns], *[F.col("_small")[c].alias(c) for c in cols])


def encode_with_map(tokens, vmap, unk_id: int = UNK_ID) -> Column:
    """Ids of the tokens by the row's own map of its distinct tokens."""
    return F.transform(tokens, lambda t: F.coalesce(F.element_at(vmap, t), F.lit(unk_id)))
