"""Vector queries on ``embeddings`` (fixture F4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import r6

from tessera.operators import vectors as vx
from tessera.operators.nearest import knn_join
from tessera.operators.tokens import attach_small
from tessera.plans.registry import register
from tessera.sources.tables import table

SEED = "42"
N_GATES = 8
K = 2


def emb(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", "label", "embedding")


def _sumsq(c):
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x)


def sql_sum(lst: str) -> str:
    return f"list_reduce({lst}, lambda a, b: a + b)"


DV = "list_transform(embedding, lambda x: CAST(x AS DOUBLE))"


@register("a12_neft_noise", f"""
WITH n AS (
  SELECT vec_id, 10.0 / sqrt(1 * len(embedding)) AS m, {DV} AS v FROM embeddings),
z AS (
  SELECT vec_id, m, v, list_transform(v, lambda x, i: x + m * (2 * (CAST(('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':' || CAST(i - 1 AS VARCHAR) || ':{SEED}'), 1, 8)) AS BIGINT) / 4294967296.0) - 1)) AS noisy
  FROM n)
SELECT vec_id, round(m, 6) AS noise_bound,
       round(list_max(list_transform(range(1, len(v) + 1), lambda j: abs(noisy[j] - v[j]))), 6) AS max_abs_noise,
       round({sql_sum('noisy')}, 6) AS noisy_sum
FROM z
""")
def a12(spark, sf):
    e = vx.neft_noise(emb(spark, sf), "vec_id", "embedding", 10.0, 1, SEED)
    v = vx.to_double(F.col("embedding"))
    diff = F.zip_with(F.col("noisy"), v, lambda a, b: F.abs(a - b))
    return e.select("vec_id", r6("noise_bound", 6).alias("noise_bound"),
                    r6(F.array_max(diff), 6).alias("max_abs_noise"),
                    r6(F.aggregate("noisy", F.lit(0.0), lambda a, x: a + x), 6).alias("noisy_sum"))


def gates(spark, sf) -> DataFrame:
    g = emb(spark, sf).where(F.col("vec_id") < N_GATES)
    return vx.gate_row(g, "vec_id", "embedding")


def routed(spark, sf) -> DataFrame:
    return vx.topk_route(emb(spark, sf).select("vec_id", "embedding"), "embedding", gates(spark, sf), 2)


ROUTE_SQL = f"""
WITH g AS (SELECT list({DV} ORDER BY vec_id) AS gates FROM embeddings WHERE vec_id < {N_GATES}),
s AS (SELECT e.vec_id, list_transform(g.gates, lambda gv, i: {{'s': list_reduce(list_transform(range(1, len(gv) + 1),
          lambda j: CAST(e.embedding[j] AS DOUBLE) * gv[j]), lambda a, b: a + b), 'neg_e': -(i - 1)}}) AS sc
      FROM embeddings e, g),
t AS (SELECT vec_id, list_sort(sc, 'DESC')[1:2] AS top FROM s),
w AS (SELECT vec_id, -top[1].neg_e AS e1, -top[2].neg_e AS e2,
             1.0 / (1.0 + exp(top[2].s - top[1].s)) AS w1, exp(top[2].s - top[1].s) / (1.0 + exp(top[2].s - top[1].s)) AS w2 FROM t)
"""


@register("a13_topk_route", ROUTE_SQL + """
SELECT vec_id, CAST(e1 AS INTEGER) AS expert1, round(w1, 6) AS weight1, CAST(e2 AS INTEGER) AS expert2, round(w2, 6) AS weight2 FROM w
""")
def a13(spark, sf):
    r = routed(spark, sf)
    return r.select("vec_id", F.col("routes")[0]["expert"].alias("expert1"), r6(F.col("routes")[0]["weight"], 6).alias("weight1"),
                    F.col("routes")[1]["expert"].alias("expert2"), r6(F.col("routes")[1]["weight"], 6).alias("weight2"))


@register("g14_expert_load", ROUTE_SQL + f""",
r AS (SELECT e1 AS expert, w1 AS weight FROM w UNION ALL SELECT e2, w2 FROM w),
ex AS (SELECT CAST(vec_id AS INTEGER) AS expert FROM embeddings WHERE vec_id < {N_GATES})
SELECT ex.expert, CAST(count(r.expert) AS BIGINT) AS n_rows, round(coalesce(sum(r.weight), 0.0), 6) AS total_weight
FROM ex LEFT JOIN r USING (expert) GROUP BY ex.expert
""")
def g14(spark, sf):
    experts = emb(spark, sf).where(F.col("vec_id") < N_GATES).select(F.col("vec_id").cast("int").alias("expert"))
    g = vx.expert_load(routed(spark, sf), experts)
    return g.select("expert", "n_rows", r6("total_weight", 6).alias("total_weight"))


def expert_maps(spark, sf) -> DataFrame:
    """One matrix per gate: the sum of the outer products of the two vector pairs that follow the gates in the table
    (vectors 8 + 4e .. 11 + 4e for expert e), a map of rank two."""
    last = N_GATES + 4 * N_GATES
    four = emb(spark, sf).where(F.col("vec_id").between(N_GATES, last - 1)).groupBy(
        F.floor((F.col("vec_id") - N_GATES) / 4).cast("int").alias("expert")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("vec_id", vx.to_double(F.col("embedding")).alias("v")))), lambda s: s["v"]).alias("vs"))
    outer = lambda a, b: F.transform(F.col("vs")[a], lambda x: F.transform(F.col("vs")[b], lambda y: x * y))
    return four.where(F.size("vs") == 4).select("expert", F.zip_with(outer(0, 1), outer(2, 3), lambda p, q: F.zip_with(p, q, lambda x, y: x + y)).alias("matrix"))


@register("g14_expert_combine", ROUTE_SQL + f""",
x AS (SELECT vec_id, {DV} AS v FROM embeddings),
ab AS (SELECT CAST(floor((vec_id - {N_GATES}) / 4) AS INTEGER) AS expert, list(v ORDER BY vec_id) AS vs FROM x
       WHERE vec_id >= {N_GATES} AND vec_id < {5 * N_GATES} GROUP BY 1 HAVING count(*) = 4),
r AS (SELECT vec_id, 1 AS slot, e1 AS expert, w1 AS weight FROM w UNION ALL SELECT vec_id, 2, e2, w2 FROM w),
pr AS (SELECT r.vec_id, r.slot, r.weight, ab.vs, {sql_sum('list_transform(range(1, len(x.v) + 1), lambda j: x.v[j] * ab.vs[2][j])')} AS p1,
              {sql_sum('list_transform(range(1, len(x.v) + 1), lambda j: x.v[j] * ab.vs[4][j])')} AS p2
       FROM r JOIN x USING (vec_id) JOIN ab USING (expert)),
y AS (SELECT vec_id, list_transform(range(1, len(vs[1]) + 1), lambda j: weight * (vs[1][j] * p1 + vs[3][j] * p2)) AS y FROM pr),
u AS (SELECT vec_id, unnest(y) AS y, generate_subscripts(y, 1) AS c FROM y),
o AS (SELECT vec_id, c, sum(y) AS o FROM u GROUP BY vec_id, c)
SELECT x.vec_id, round(max(CASE WHEN c = 1 THEN o END), 6) AS out_first, round(max(CASE WHEN c = 64 THEN o END), 6) AS out_last,
       round(sum(o * o), 6) AS out_sumsq, round(sum(o), 6) AS out_sum
FROM x LEFT JOIN o USING (vec_id) GROUP BY x.vec_id
""")
def g14_combine(spark, sf):
    o = vx.expert_combine(routed(spark, sf), "vec_id", "embedding", expert_maps(spark, sf))
    total = F.aggregate("output", F.lit(0.0), lambda a, x: a + x)
    return o.select(F.col("id").alias("vec_id"), r6(F.element_at("output", 1), 6).alias("out_first"), r6(F.element_at("output", -1), 6).alias("out_last"),
                    r6(_sumsq(F.col("output")), 6).alias("out_sumsq"), r6(total, 6).alias("out_sum"))


@register("a14_layernorm_rmsnorm", f"""
WITH v AS (SELECT vec_id, {DV} AS v FROM embeddings),
st AS (SELECT vec_id, v, {sql_sum('v')} / len(v) AS mu, {sql_sum('list_transform(v, lambda x: x * x)')} / len(v) AS ms FROM v),
st2 AS (SELECT *, {sql_sum('list_transform(v, lambda x: (x - mu) * (x - mu))')} / len(v) AS var FROM st),
o AS (SELECT vec_id, list_transform(v, lambda x: (x - mu) / sqrt(var + 1e-6)) AS ln, list_transform(v, lambda x: x / sqrt(ms + 1e-6)) AS rms FROM st2)
SELECT vec_id, round(ln[1], 6) AS ln_first, round({sql_sum('list_transform(ln, lambda x: x * x)')}, 6) AS ln_sumsq,
       round(rms[1], 6) AS rms_first, round({sql_sum('list_transform(rms, lambda x: x * x)')}, 6) AS rms_sumsq FROM o
""")
def a14(spark, sf):
    e = emb(spark, sf).select("vec_id", vx.to_double(F.col("embedding")).alias("v"))
    o = e.select("vec_id", vx.layernorm(F.col("v")).alias("ln"), vx.rmsnorm(F.col("v")).alias("rms"))
    return o.select("vec_id", r6(F.element_at("ln", 1), 6).alias("ln_first"), r6(_sumsq(F.col("ln")), 6).alias("ln_sumsq"),
                    r6(F.element_at("rms", 1), 6).alias("rms_first"), r6(_sumsq(F.col("rms")), 6).alias("rms_sumsq"))


@register("a15_standardize_channels", f"""
WITH x AS (SELECT vec_id, unnest({DV}) AS x, generate_subscripts(embedding, 1) AS c FROM embeddings),
st AS (SELECT c, avg(x) AS mu, stddev_pop(x) AS sd FROM x GROUP BY c),
z AS (SELECT x.vec_id, x.c, (x.x - st.mu) / st.sd AS z, least(greatest(((x.x - st.mu) / st.sd) * st.sd + st.mu, 0.0), 1.0) AS inv
      FROM x JOIN st USING (c))
SELECT vec_id, round(max(CASE WHEN c = 1 THEN z END), 6) AS z_first, round(sum(z * z), 6) AS z_sumsq,
       round(min(inv), 6) AS inv_min, round(max(inv), 6) AS inv_max FROM z GROUP BY vec_id
""")
def a15(spark, sf):
    e = emb(spark, sf)
    st = vx.channel_stats(e, "embedding")
    x = attach_small(e.select("vec_id", vx.to_double(F.col("embedding")).alias("v")), st)
    z = x.select("vec_id", vx.standardize_channels(F.col("v"), F.col("ch_mean"), F.col("ch_std")).alias("z"),
                 "ch_mean", "ch_std")
    inv = vx.unstandardize_clamped(F.col("z"), F.col("ch_mean"), F.col("ch_std"))
    return z.select("vec_id", r6(F.element_at("z", 1), 6).alias("z_first"), r6(_sumsq(F.col("z")), 6).alias("z_sumsq"),
                    r6(F.array_min(inv), 6).alias("inv_min"), r6(F.array_max(inv), 6).alias("inv_max"))


KNN_SQL = f"""
WITH v AS (SELECT vec_id, {DV} AS v FROM embeddings),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id,
             {sql_sum('list_transform(range(1, len(q.v) + 1), lambda j: (q.v[j] - c.v[j]) * (q.v[j] - c.v[j]))')} AS dist
      FROM v q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY dist, neighbor_id) AS INTEGER) AS rank FROM p)
"""


def knn(spark, sf) -> DataFrame:
    """Every vector is a query against the whole table (its own row excluded)."""
    e = emb(spark, sf)
    return knn_join(e, e, "vec_id", "vec_id", "embedding", K)


@register("j8_knn_join", KNN_SQL + f" SELECT query_id, rank, neighbor_id, round(dist, 6) AS dist FROM r WHERE rank <= {K}")
def j8(spark, sf):
    return knn(spark, sf).withColumn("dist", r6("dist", 6))
