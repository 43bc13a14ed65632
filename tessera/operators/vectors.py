"""Vector operators.

Per-vector maths is ``transform``/``zip_with``/``aggregate`` in the JVM. Small
parameter tables (gates, channel statistics) are one bounded row attached as a
scalar subquery. Exact k-nearest-neighbour search (J8) is in ``nearest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.ordering import settled
from tessera.operators.tokens import attach_small


def to_double(vec) -> Column:
    return F.transform(vec, lambda x: x.cast("double"))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def uniform_hash(key: Column) -> Column:
    """Reproducible U[0,1) from the first 8 hex digits of an md5 (same in DuckDB)."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(float(2 ** 32))


def neft_noise(df: DataFrame, id_col: str, vec: str, alpha: float = 10.0, seq_len: int = 1,
               seed: str = "42", out: str = "noisy") -> DataFrame:
    """E + U(-m, m) with m = alpha / sqrt(L * D); u from md5(id:i:seed) so reruns agree."""
    d = F.size(vec)
    m = F.lit(alpha) / F.sqrt(F.lit(seq_len) * d)
    noisy = F.transform(F.col(vec), lambda x, i: x.cast("double") + m * (2 * uniform_hash(
        F.concat_ws(":", F.col(id_col).cast("string"), i.cast("string"), F.lit(seed))) - 1))
    return df.withColumn(out, noisy).withColumn("noise_bound", m)


def _with_scalar(vec, scalar, fn) -> Column:
    """Element-wise ``fn(x, scalar)``. The scalar is passed in as a repeated array so it is
    evaluated once per row, not once per element inside the lambda."""
    return F.zip_with(vec, F.array_repeat(scalar, F.size(vec)), fn)


def _sum(vec) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda a, x: a + x)


def layernorm(vec) -> Column:
    """(x - mean) / sqrt(var_pop + 1e-6), no learned scale."""
    n = F.size(vec)
    centered = _with_scalar(vec, _sum(vec) / n, lambda x, m: x - m)
    var = F.aggregate(centered, F.lit(0.0), lambda a, x: a + x * x) / n
    return _with_scalar(centered, F.sqrt(var + F.lit(1e-6)), lambda x, s: x / s)


def rmsnorm(vec) -> Column:
    """X / sqrt(mean(x^2) + 1e-6)."""
    ms = F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x) / F.size(vec)
    return _with_scalar(vec, F.sqrt(ms + F.lit(1e-6)), lambda x, s: x / s)


def channel_stats(df: DataFrame, vec: str) -> DataFrame:
    """Per-component mean and population std as one row (D values, bounded by the width)."""
    ex = df.select(F.posexplode(to_double(F.col(vec))).alias("c", "x"))
    st = ex.groupBy("c").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"))
    return st.agg(F.array_sort(F.collect_list(F.struct("c", "mu", "sd"))).alias("_s")).select(
        F.transform("_s", lambda s: s["mu"]).alias("ch_mean"), F.transform("_s", lambda s: s["sd"]).alias("ch_std"))


def standardize_channels(vec, mean, std) -> Column:
    """(x - mean_c) / std_c per component."""
    return F.zip_with(F.zip_with(vec, mean, lambda x, m: x - m), std, lambda x, s: x / s)


def unstandardize_clamped(z, mean, std) -> Column:
    """A15 inverse: z * std_c + mean_c clamped to [0, 1]."""
    return F.zip_with(F.zip_with(z, std, lambda x, s: x * s), mean,
                      lambda x, m: F.least(F.greatest(x + m, F.lit(0.0)), F.lit(1.0)))


def gate_row(gates: DataFrame, id_col: str, vec: str) -> DataFrame:
    """The E gate vectors as one row ``gates: array<array<double>>`` ordered by id (E is bounded)."""
    return gates.agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(id_col).alias("k"),
                                                                      to_double(F.col(vec)).alias("v")))),
                                 lambda s: s["v"]).alias("gates"))


def topk_route(df: DataFrame, vec: str, gates: DataFrame, k: int = 2) -> DataFrame:
    """Scores against E gates, top k (first index on ties), softmax over those k only."""
    x = attach_small(df, gates)
    scores = F.transform(F.col("gates"), lambda g, i: F.struct(dot(to_double(F.col(vec)), g).alias("s"),
                                                              (-i).alias("neg_e")))
    x = x.withColumn("_top", F.slice(F.sort_array(scores, asc=False), 1, k)).drop("gates")
    mx = F.element_at("_top", 1)["s"]
    x = x.withColumn("_ex", _with_scalar(F.col("_top"), mx, lambda t, m: F.exp(t["s"] - m)))
    w = _with_scalar(F.col("_ex"), _sum(F.col("_ex")), lambda e, t: e / t)
    routes = F.zip_with("_top", w, lambda t, e: F.struct((-t["neg_e"]).alias("expert"), e.alias("weight")))
    return x.withColumn("routes", routes).drop("_top", "_ex")


def expert_load(routed: DataFrame, experts: DataFrame) -> DataFrame:
    """Rows and total weight sent to each expert; experts with no rows kept as 0."""
    ex = routed.select(F.inline("routes"))
    agg = ex.groupBy("expert").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("weight").alias("total_weight"))
    return (experts.join(agg, "expert", "left")
            .select("expert", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
                    F.coalesce("total_weight", F.lit(0.0)).alias("total_weight")))


def expert_combine(routed: DataFrame, id_col: str, vec: str, experts: DataFrame) -> DataFrame:
    """Every row's vector goes through the linear maps of the experts it is routed to; the weighted outputs add up.

    ``routed`` has ``routes`` (A13) and integer ids (null and repeated ids keep their rows); ``experts`` has (expert, matrix
    array<array<double>>), one row an expert, rows of a matrix giving one output component each. One row per row of
    ``routed``: (id, output array<double>); routes to an expert that is not listed add nothing, and rows left
    without any have a null output. Outputs add in the order of the routes, so repeated runs give the same bits. A hot
    expert is a hot join key between two written or scanned tables, which adaptive execution splits; what meets again per
    row are its few routes.
    """
    rows = settled(routed.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"), to_double(F.col(vec)).alias("_x"), "routes"))
    sent = rows.select("_row", "_x", F.posexplode("routes").alias("_slot", "_r")).select("_row", "_x", "_slot", "_r.expert", "_r.weight")
    mapped = sent.join(experts.select("expert", "matrix"), "expert").select(
        "_row", "_slot", F.zip_with(F.transform("matrix", lambda m: dot(m, F.col("_x"))), F.transform("matrix", lambda _: F.col("weight")),
                                    lambda y, w: y * w).alias("y"))
    per_row = mapped.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_slot", "y"))).alias("ys"))
    total = F.aggregate(F.slice("ys", 2, F.greatest(F.size("ys") - 1, F.lit(0))), F.col("ys")[0]["y"],
                        lambda acc, s: F.zip_with(acc, s["y"], lambda a, b: a + b))
    return rows.select("_row", "_id").join(settled(per_row), "_row", "left").select(F.col("_id").alias("id"), total.alias("output"))


def hashed_terms(rows: DataFrame, id_col: str, tokens: Column, dims: int = 64, scale: int = 1000) -> DataFrame:
    """(id, vector array<double>): signed counts of hashed tokens, scaled to length ``scale`` and rounded to integers.

    A token's component is the first 32 bits of its MD5 modulo ``dims``, its sign the next bit. Components are
    integers, so distances between such vectors are exact. A text without a token has the zero vector.
    """
    md = F.md5("t")
    words = rows.select(F.col(id_col).alias("id"), F.explode(tokens).alias("t"))
    signed = words.select("id", (F.conv(F.substring(md, 1, 8), 16, 10).cast("long") % dims).cast("int").alias("b"),
                          F.when(F.substring(md, 9, 1) >= "8", -1).otherwise(1).alias("s"))
    sums = signed.groupBy("id", "b").agg(F.sum("s").cast("double").alias("s"))
    per_row = sums.groupBy("id").agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("n"), F.map_from_entries(F.collect_list(F.struct("b", "s"))).alias("m"))
    at = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.coalesce(F.try_element_at("m", d), F.lit(0.0)))
    filled = per_row.withColumn("v", at)
    scaled = _with_scalar(F.col("v"), F.when(F.col("n") > 0, F.col("n")).otherwise(1.0), lambda x, n: F.floor(x * F.lit(float(scale)) / n + 0.5).cast("double"))
    return (rows.select(F.col(id_col).alias("id")).join(settled(filled.select("id", scaled.alias("vector"))), "id", "left")
            .select("id", F.coalesce("vector", F.array_repeat(F.lit(0.0), dims)).alias("vector")))
