"""Toxicity classifier with a counterfactual regulariser.

A logistic model over the presence of word beginnings and whole words. Beside the log loss it pays
for every change of the score when an identity term of a labelled text is swapped for another term
of its list, or left out, so a group's name cannot become evidence and neutral mentions stay low.

Every labelled text gives such pairs: where it names no group, a term is put into it first, drawn from all lists by a
hash of the text, and the text with the term teaches with the text's own label. All terms are features, whether the sample
holds them or not.

The model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, drawn by a hash of the id); its other
features are all that a likelihood ratio test over that sample finds to depend on the label (``MIN_Z``). Scoring is
one pass over all texts with the small model in the task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessera.llm.workspace import Workspace

SAMPLE_ROWS = 20_000  # bound on the labelled rows that the model is fitted on
MIN_Z = 4.0  # least root of the likelihood ratio statistic of a feature, its standard score
THRESHOLD = 0.7
SWAPS = 2  # counterfactuals per text
FAIRNESS = 2.0  # weight of the squared logit change under a swap
RIDGE = 1e-4

#: Identity terms by language and kind (singular words, lower case); a term is swapped within its list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "african", "latino", "european"),
    ("gay", "straight", "lesbian", "transgender", "bisexual"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer", "mädchen", "jungen"), ("frau", "mann"),
    ("muslime", "christen", "juden", "hindus", "buddhisten", "katholiken", "atheisten"),
    ("muslim", "christ", "jude", "hindu", "buddhist", "katholik", "atheist"),
    ("schwarze", "weiße", "asiaten", "afrikaner", "europäer"), ("schwule", "lesben", "heterosexuelle"),
    ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"), ("femme", "homme", "fille", "garçon"),
    ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "catholiques", "athées"),
    ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "catholique", "athée"),
    ("noirs", "blancs", "asiatiques", "africains", "européens"), ("gays", "lesbiennes", "hétérosexuels"),
    ("immigrés", "réfugiés", "étrangers", "autochtones"),
    ("mujeres", "hombres", "niñas", "niños"), ("mujer", "hombre", "niña", "niño"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "católicos", "ateos"),
    ("musulmán", "cristiano", "judío", "hindú", "budista", "católico", "ateo"),
    ("negros", "blancos", "asiáticos", "africanos", "europeos"), ("homosexuales", "lesbianas", "heterosexuales"),
    ("inmigrantes", "refugiados", "extranjeros", "nativos"),
)

words_of = re.compile(r"[^\W\d_]+").findall


def features_of(word: str) -> list[str]:
    """The whole word and its first 4, 5 and 6 letters ("-" marks a beginning)."""
    return [word, *[word[:n] + "-" for n in (4, 5, 6) if len(word) >= n]]


@dataclass
class Model:
    """score = 1 / (1 + exp(-(bias + sum of the weights of the features present))). ``n_pairs``: counterfactual pairs of the fit."""

    bias: float
    weights: dict[str, float] = field(default_factory=dict)
    n_pairs: int = 0

    def scorer(self):
        by_start: dict[str, list[tuple[str, float]]] = {}
        for f, w in self.weights.items():
            by_start.setdefault(f.rstrip("-")[:4], []).append((f, w))
        start = by_start.get

        def score(text: str | None) -> float:
            seen: dict[str, float] = {}
            for word in set(words_of((text or "").lower())):
                near = start(word[:4])
                if near is not None:
                    own = features_of(word)
                    seen.update((f, w) for f, w in near if f in own)
            z = self.bias + sum(seen[f] for f in sorted(seen))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def held_out(doc_id: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 when divided by 3. A null id is not one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def swapped(words: set[str], terms=IDENTITY_TERMS, swaps: int = SWAPS) -> list[set[str]]:
    """Word sets with every identity term replaced by the k-th next term of its list, k = 1..swaps."""
    lists = {}
    for ts in terms:
        for t in ts:
            lists.setdefault(t, ts)  # a word of two languages swaps in the first list that has it
    named = words & lists.keys()
    if not named:
        return []
    out = []
    for k in range(1, swaps + 1):
        changed = {lists[t][(lists[t].index(t) + k) % len(lists[t])] for t in named}
        out.append((words - named) | changed)
    return out


def with_group(words: set[str], text: str, terms=IDENTITY_TERMS) -> set[str]:
    """The words of a text that names a group; of another one its words and one term, drawn by a hash of the text."""
    names = sorted({t for ts in terms for t in ts})
    if not names or words & set(names):
        return words
    return words | {names[zlib.crc32(text.encode()) % len(names)]}


def training_rows(docs: DataFrame, labels: DataFrame, ws: Workspace, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(label, text) of at most about ``sample_rows`` labelled rows outside the held-out fold, equal texts once."""
    known = (labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    share = min(1.0, sample_rows / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(F.col("doc_id"), F.col("text").alias("text")).join(F.broadcast(drawn), "doc_id")  # bounded by sample_rows
    rows = rows.filter("text is not null").withColumn("h", F.xxhash64("text"))
    return ws.put(rows.groupBy("h").agg(F.max(F.struct("label", "text")).alias("r")).select("r.label", "r.text"), "training")


def choose_features(training: DataFrame, min_z: float = MIN_Z) -> tuple[list[str], int, int]:
    """(features, rows of label 0, rows of label 1); those that depend on the label most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for b in batches:
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found[label].update({f for w in set(words_of(text.lower())) for f in features_of(w)})
        names = list(found[0].keys() | found[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([found[0][f] for f in names], pa.int64()),
                                          pa.array([found[1][f] for f in names], pa.int64())], names=["f", "n0", "n1"])

    sizes = {r[0]: r[1] for r in training.groupBy("label").count().collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return [], n0, n1
    stats = training.select("label", "text").mapInArrow(count, "f string, n0 long, n1 long")
    stats = stats.groupBy("f").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).filter(F.col("n0") + F.col("n1") >= max(3, n1 // 100))
    total, present = n0 + n1, F.col("n0") + F.col("n1")
    cells = [(F.col("n1"), present * n1 / total), (F.col("n0"), present * n0 / total),
             (n1 - F.col("n1"), (total - present) * n1 / total), (n0 - F.col("n0"), (total - present) * n0 / total)]
    g2 = sum((F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0) for seen, expected in cells), F.lit(0.0))
    z = F.sqrt(F.greatest(g2, F.lit(0.0)))
    best = stats.select("f", z.alias("z")).filter(F.col("z") >= min_z).orderBy(F.col("z").desc(), "f")
    return [r.f for r in best.collect()], n0, n1  # features of a bounded sample


def fit(docs: DataFrame, labels: DataFrame, ws: Workspace, terms=IDENTITY_TERMS, sample_rows: int = SAMPLE_ROWS,
        fairness: float = FAIRNESS) -> Model:
    """The model, fitted as if both labels were equally frequent; without rows of both labels, or without a feature
    that depends on the label, a constant at the share of label 1. Repeated rows and equal texts teach once (label 1 if any
    of them has it); empty tables give the constant 1/2."""
    training = training_rows(docs, labels, ws, sample_rows)
    chosen, n0, n1 = choose_features(training)
    if not chosen:
        share = (n1 + 0.5) / (n0 + n1 + 1)
        return Model(float(np.log(share / (1 - share))))
    every = {t for ts in terms for t in ts}
    named = sorted(every - set(chosen))
    index = {f: k for k, f in enumerate([*chosen, *named])}

    def present(words: set[str]) -> list[int]:
        return sorted({index[f] for w in words for f in features_of(w) if f in index})

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [set(words_of(t.lower())) for t in b.column(1).to_pylist()]
            named = [with_group(s, t, terms) for s, t in zip(sets, b.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([present(s) for s in sets], pa.list_(pa.int32())), pa.array([present(s) for s in named], pa.list_(pa.int32())),
                pa.array([[present(x) for x in (*swapped(s, terms), s - every)] for s in named], pa.list_(pa.list_(pa.int32())))],
                names=["label", "x", "named", "others"])

    rows = training.select("label", "text").mapInArrow(
        sparse, "label int, x array<int>, named array<int>, others array<array<int>>").collect()  # bounded by sample_rows
    rows.sort(key=lambda r: (r.label, r.x, r.named, r.others))  # the fit doesn't depend on the order of the tasks
    taught = [(r.label, x) for r in rows for x in (r.x, r.named)]  # every text as it is and with its group
    y = np.array([label for label, _ in taught], float)
    row = np.repeat(np.arange(len(taught)), [len(x) for _, x in taught])
    col = np.array([k for _, x in taught for k in x], np.int64)
    pairs = [(r.named, o) for r in rows for o in r.others]
    d_row, d_col, d_val = [], [], []
    for p, (x, o) in enumerate(pairs):
        for k in set(x) ^ set(o):
            d_row.append(p)
            d_col.append(k)
            d_val.append(1.0 if k in o else -1.0)
    d_row, d_col, d_val = np.array(d_row, np.int64), np.array(d_col, np.int64), np.array(d_val)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) / len(y)  # both labels weigh the same
    w, bias = np.zeros(len(index)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, 401):
        p = 1 / (1 + np.exp(-np.clip(bias + np.bincount(row, w[col], len(y)), -30, 30)))
        off = (p - y) * weight
        g = np.bincount(col, off[row], len(w)) + RIDGE * w
        if pairs:
            change = np.bincount(d_row, w[d_col] * d_val, len(pairs))
            g += fairness * 2 * np.bincount(d_col, change[d_row] * d_val, len(w)) / len(pairs)
        gb = float(off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.05 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        w -= rate * m / (np.sqrt(v) + 1e-8)
        bias -= rate * mb / (np.sqrt(vb) + 1e-8)
    return Model(float(bias), {f: float(w[k]) for f, k in index.items() if abs(w[k]) > 1e-9}, len(pairs))


def add_scores(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` plus ``out`` (double in 0..1), which replaces a column of that name. Null and empty texts get the score of a text
    without features."""
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for b in batches:
            scores = pa.array([score(t) for t in b.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def toxicity_filter(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, all columns unchanged."""
    out = "__toxicity"
    while out in docs.columns:
        out += "_"
    return add_scores(docs, model, out=out).filter(F.col(out) < threshold).drop(out)
