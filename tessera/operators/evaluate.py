"""Splits, sampling and evaluation.

Per-row maths runs on arrays with higher-order functions; metrics are partial
aggregates. Group-relative numbers (ranks, shares) come from aggregates joined
back on the group key instead of windows over unbounded groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import r6
from tessera.operators.ordering import join_same, md5_order, rank_in_groups, settled


# ------------------------------------------------------------------ array maths

def softmax(logits) -> Column:
    """exp(x - max) / sum(exp(x - max))."""
    ex = F.zip_with(logits, F.array_repeat(F.array_max(logits), F.size(logits)), lambda x, m: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    # scalars enter as repeated arrays: evaluated once per row, not per element
    return F.zip_with(ex, F.array_repeat(total, F.size(ex)), lambda x, t: x / t)


def argmax(probs) -> Column:
    """A10: 0-based index of the maximum; first on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def confidence(probs) -> Column:
    """A10: the maximum probability."""
    return F.array_max(probs)


def topk_classes(probs, names, k: int = 3) -> Column:
    """K largest probabilities with class names, ties by smaller class index."""
    idx = F.transform(probs, lambda p, i: F.struct(p.alias("prob"), (-i).alias("neg_idx")))
    top = F.slice(F.sort_array(idx, asc=False), 1, k)
    return F.transform(top, lambda s: F.struct(F.element_at(names, 1 - s["neg_idx"]).alias("cls"),
                                               s["prob"].alias("prob")))


def smoothed_ce(probs, label, eps: float = 0.1) -> Column:
    """(1-eps)(-log p_y) + eps/K * sum_k(-log p_k)."""
    k = F.size(probs)
    nll_y = -F.log(F.element_at(probs, label + 1))
    nll_all = F.aggregate(probs, F.lit(0.0), lambda acc, p: acc - F.log(p))
    return (1 - eps) * nll_y + F.lit(eps) / k * nll_all


# ------------------------------------------------------------------ splits and sampling

def stratified_split(df: DataFrame, id_col: str, label: str, ratio: float = 0.8, seed: str = "42") -> DataFrame:
    """Inside each class, shuffled (md5 of id||seed, then id), first floor(n*ratio) -> train.

    Disjoint and complete; rows without a class are a class of their own. Ranks come from a range-partitioned
    global index, so a class holding most of the rows is still split over tasks.
    """
    ranked = rank_in_groups(df.withColumn("_shuf", md5_order(id_col, seed)), [label],
                            [F.col("_shuf"), F.col(id_col)], "_rn")
    sizes = settled(df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    return (join_same(ranked, sizes, [label])
            .withColumn("split", F.when(F.col("_rn") <= F.floor(F.col("_n") * ratio), "train").otherwise("test"))
            .drop("_shuf", "_rn", "_n"))


def sequence_ids(df: DataFrame, label: str, order: str, fmt: str = "%s_%04d.txt", name: str = "new_name") -> DataFrame:
    """Per-class running number from 0, rendered into a file name."""
    r = rank_in_groups(df, [label], [F.col(order)], "_rn")
    return r.withColumn(name, F.format_string(fmt, F.col(label), F.col("_rn") - 1)).drop("_rn")


# ------------------------------------------------------------------ metrics

def accuracy(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """100 * correct / total."""
    return df.agg((F.avg((F.col(truth) == F.col(pred)).cast("double")) * 100).alias("accuracy"))


def contingency(df: DataFrame, truth: str, pred: str, name: str = "n") -> DataFrame:
    """Rows per (truth, prediction): the one pass over the data from which the reports below follow.

    It has at most classes^2 rows and is written, so that they don't scan the predictions again."""
    return settled(df.groupBy(truth, pred).agg(F.count(F.lit(1)).alias(name)))


def per_class_counts(df: DataFrame, truth: str, pred: str, classes: DataFrame, n: str | None = None) -> DataFrame:
    """tp, support and predicted count for every class of ``classes`` (one column ``cls``);
    ``n`` is the count column if ``df`` is a contingency table."""
    rows = F.lit(1) if n is None else F.col(n)
    t = df.groupBy(F.col(truth).alias("cls")).agg(
        F.sum(rows).alias("support"),
        F.sum((F.col(truth) == F.col(pred)).cast("long") * rows).alias("tp"))
    p = df.groupBy(F.col(pred).alias("cls")).agg(F.sum(rows).alias("predicted"))
    out = join_same(join_same(classes, t, ["cls"], "left"), p, ["cls"], "left")
    return out.select("cls", *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
                               for c in ("support", "tp", "predicted")])


def prf(counts: DataFrame, keep_tp: bool = False) -> DataFrame:
    """Per-class precision, recall, F1; a class never predicted has precision 0."""
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0)
    return counts.select("cls", "support", p.alias("precision"), r.alias("recall"), f1.alias("f1"), *(["tp"] if keep_tp else []))


def weighted_prf(per_class: DataFrame) -> DataFrame:
    """Precision, recall, F1 averaged by class support, x100."""
    tot = F.sum("support")
    return per_class.agg(*[(F.sum(F.col(m) * F.col("support")) / tot * 100).alias(m)
                           for m in ("precision", "recall", "f1")])


def class_counts(counted: DataFrame, truth: str, pred: str, n: str) -> DataFrame:
    """(cls, support, tp, predicted) of every class that is a truth or a prediction, from a contingency table: each
    of its rows counts for its true class and for its predicted one, in one aggregation."""
    hit = F.when(F.col(truth) == F.col(pred), F.col(n)).otherwise(0)
    sides = F.array(F.struct(F.col(truth).alias("cls"), F.col(n).alias("support"), hit.alias("tp"), F.lit(0).cast("long").alias("predicted")),
                    F.struct(F.col(pred).alias("cls"), F.lit(0).cast("long").alias("support"), F.lit(0).cast("long").alias("tp"), F.col(n).alias("predicted")))
    return counted.select(F.inline(sides)).groupBy("cls").agg(*[F.sum(c).cast("long").alias(c) for c in ("support", "tp", "predicted")])


def classification_report(counts: DataFrame) -> DataFrame:
    """Per-class lines plus accuracy, macro avg and weighted avg lines, from (cls, support, tp, predicted).

    The three summary lines are one aggregate over the class lines, unrolled."""
    per_class = prf(counts, keep_tp=True)
    lines = per_class.select(F.col("cls").cast("string").alias("label"), "precision", "recall", "f1", F.col("support").cast("long"))
    names = ("precision", "recall", "f1")
    sums = per_class.agg(*[F.avg(m).alias("a_" + m) for m in names], *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias("w_" + m) for m in names],
                         F.sum("support").cast("long").alias("support"), (F.sum("tp") / F.sum("support")).alias("accuracy"))
    none = F.lit(None).cast("double")

    def line(label, values):
        return F.struct(F.lit(label).alias("label"), *[v.alias(m) for m, v in zip(names, values)], F.col("support").alias("support"))

    summary = sums.select(F.inline(F.array(line("macro avg", [F.col("a_" + m) for m in names]), line("weighted avg", [F.col("w_" + m) for m in names]),
                                           line("accuracy", [none, none, F.col("accuracy")]))))
    return lines.unionByName(summary)


def confusion_matrix(df: DataFrame, truth: str, pred: str, classes: list[int], class_rows: DataFrame,
                     n: str | None = None) -> DataFrame:
    """Dense true x pred counts; the value list of ``pivot`` keeps empty columns and
    ``class_rows`` (column ``cls``) keeps classes that never occur as truth; ``n`` as above."""
    m = df.groupBy(F.col(truth).alias("cls")).pivot(pred, classes).agg(F.sum(F.lit(1) if n is None else F.col(n)))
    out = class_rows.join(m, "cls", "left")
    return out.select(F.col("cls").alias("true"),
                      *[F.coalesce(F.col(str(c)), F.lit(0)).cast("long").alias(f"p{c}") for c in classes])


def confusion_counts(counted: DataFrame, truth: str, pred: str, n: str) -> DataFrame:
    """G5 for classes as the data has them: a row (true, pred, n) for every pair of classes that occur as truth or
    prediction, zeros included. ``counted`` is a contingency table; rows without a truth or a prediction are no pair.

    The classes become one array (as many as there are classes), which every row class is paired with.
    """
    both = counted.select(F.explode(F.array(truth, pred)).alias("c")).where("c is not null")
    classes = both.agg(F.array_sort(F.collect_set("c")).alias("classes"))
    grid = classes.select(F.explode("classes").alias("true"), "classes").select("true", F.explode("classes").alias("pred"))
    have = counted.groupBy(F.col(truth).alias("_t"), F.col(pred).alias("_p")).agg(F.sum(n).alias("_n"))
    return (grid.join(have, (F.col("true") == F.col("_t")) & (F.col("pred") == F.col("_p")), "left")
            .select("true", "pred", F.coalesce("_n", F.lit(0)).cast("long").alias("n")))


def confidence_histogram(df: DataFrame, conf: str, correct: str, bins: int = 20) -> DataFrame:
    """Equal-width bins from min to max of each series (all / correct / wrong); the
    maximum falls in the last bin. Min and max are one-row aggregates joined back."""
    series = (df.select(F.lit("all").alias("series"), F.col(conf).alias("x"))
              .unionByName(df.select(F.when(F.col(correct), "correct").otherwise("wrong").alias("series"),
                                     F.col(conf).alias("x"))))
    edges = series.groupBy("series").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    j = series.join(edges, "series")
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1)))
    return j.groupBy("series", b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def confidence_stats(df: DataFrame, conf: str, correct: str) -> DataFrame:
    """Mean confidence overall, on correct rows, on wrong rows (null if none)."""
    return df.agg(F.avg(conf).alias("mean_conf"),
                  F.avg(F.when(F.col(correct), F.col(conf))).alias("mean_conf_correct"),
                  F.avg(F.when(~F.col(correct), F.col(conf))).alias("mean_conf_wrong"))


def eval_summary(df: DataFrame, conf: str, truth: str, pred: str) -> DataFrame:
    """Mean confidence over all rows; accuracy only over rows that have a label."""
    labelled = F.col(truth).isNotNull()
    ok = labelled & (F.col(truth) == F.col(pred))
    return df.agg(F.avg(conf).alias("mean_conf"),
                  F.sum(ok.cast("long")).alias("n_correct"),
                  F.sum(labelled.cast("long")).alias("n_labelled"),
                  (F.try_divide(F.sum(ok.cast("long")).cast("double"), F.sum(labelled.cast("long"))) * 100)
                  .alias("accuracy"))


def epoch_metrics(batches: DataFrame, run: str, epoch: str, batch_loss: str, n_correct: str, n: str) -> DataFrame:
    """Epoch loss = mean of batch losses (not row weighted); accuracy = rows correct / rows."""
    return batches.groupBy(run, epoch).agg(
        F.avg(batch_loss).alias("loss"),
        (F.sum(n_correct) / F.sum(n)).alias("accuracy"))


def best_epoch(history: DataFrame, run: str, epoch: str, metric: str) -> DataFrame:
    """Epoch of the highest metric per run; the first epoch on ties."""
    return history.groupBy(run).agg(
        F.max_by(F.col(epoch), F.struct(F.col(metric), (-F.col(epoch)).alias("_e"))).alias("best_epoch"),
        F.max(metric).alias("best_value"))


def early_stopping(history: DataFrame, run: str, epoch: str, loss: str, patience: int, delta: float = 0.0) -> DataFrame:
    """The stopping rule as a fold over each run's epochs (runs in Catalyst, no UDF).

    score = -loss; the first epoch sets best; a score below best + delta counts
    up and stops at ``patience``; anything else resets the counter and sets best.
    A run's history has one row per epoch, so the per-run array is small.
    """
    hist = history.groupBy(run).agg(F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"),
                                                                          (-F.col(loss)).alias("s")))).alias("h"))
    init = F.struct(F.lit(None).cast("double").alias("best"), F.lit(0).alias("counter"),
                    F.lit(None).cast(history.schema[epoch].dataType).alias("stop"))

    def step(st, x):
        first = st["best"].isNull()
        worse = x["s"] < st["best"] + F.lit(delta)
        stopped = st["stop"].isNotNull()
        cnt = st["counter"] + 1
        return (F.when(stopped, st)
                .when(first, F.struct(x["s"].alias("best"), F.lit(0).alias("counter"), st["stop"].alias("stop")))
                .when(worse, F.struct(st["best"].alias("best"), cnt.alias("counter"),
                                      F.when(cnt >= patience, x["e"]).alias("stop")))
                .otherwise(F.struct(x["s"].alias("best"), F.lit(0).alias("counter"), st["stop"].alias("stop"))))

    fold = F.aggregate("h", init, step)
    return hist.select(run, fold["stop"].alias("stop_epoch"), fold["best"].alias("best_score"))


def class_distribution(df: DataFrame, label: str, split: str) -> DataFrame:
    """G1: count and percent (1 decimal) of each class inside each split."""
    c = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    tot = df.groupBy(split).agg(F.count(F.lit(1)).alias("_tot"))
    return (c.join(tot, split)
            .withColumn("pct", r6(F.col("n") * 100.0 / F.col("_tot"), 1)).drop("_tot"))


def sorted_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class in class order."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(label)


def dataset_manifest(df: DataFrame, label: str, note: str) -> DataFrame:
    """Total rows, class list and rows per class in one row.

    Counting is a partial aggregate; only the per-class counts (one row per class)
    are gathered into the manifest row.
    """
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(F.sum("n").alias("total_rows"),
                 F.array_join(F.array_sort(F.collect_list(F.col(label))), ",").alias("classes"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(label).alias("k"), "n"))),
                                          lambda x: F.concat(x["k"], F.lit(":"), x["n"].cast("string"))), ",")
                 .alias("per_class"),
                 F.lit(note).alias("source_note"))


def step_plan(df: DataFrame, group: str, bs: int, accum: int, epochs: int, warmup_ratio: float) -> DataFrame:
    """Effective batch, optimizer steps per epoch and in total, warm-up steps."""
    eff = bs * accum
    c = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"))
    per_epoch = F.ceil(F.col("n_rows") / eff).cast("long")
    return c.select(group, "n_rows", F.lit(eff).cast("long").alias("effective_batch"),
                    per_epoch.alias("steps_per_epoch"), (per_epoch * epochs).alias("total_steps"),
                    F.ceil(per_epoch * epochs * F.lit(warmup_ratio)).cast("long").alias("warmup_steps"))
