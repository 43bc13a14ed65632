"""File sources and sinks.

Readers take explicit schemas; JSON rows that do not parse land in
``_corrupt_record`` instead of failing the job. Sinks overwrite their target and
refuse a target that is also an input of the same DataFrame.
"""

from __future__ import annotations

import uuid
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-io/{name}-{uuid.uuid4().hex[:12]}"


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """Every file as one UTF-8 string, with its path."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One object per line (blank lines skipped by the reader); unparsable lines are
    kept in ``_corrupt_record``."""
    full = T.StructType(list(schema.fields) + [T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(full).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record").json(path))


def _norm_path(p: str) -> str:
    u = urlparse(p)
    return ((u.netloc + u.path) if u.scheme not in ("", "file") else u.path).rstrip("/")


def _check_not_input(df: DataFrame, path: str) -> None:
    target = _norm_path(path)
    for f in df.inputFiles():
        if (_norm_path(f) + "/").startswith(target + "/"):
            raise ValueError(f"refusing to overwrite {path}: it is an input of this DataFrame")


def sink_jsonl(df: DataFrame, path: str) -> str:
    """JSON lines, UTF-8 kept as is, target overwritten."""
    _check_not_input(df, path)
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def latest_version_file(spark: SparkSession, path: str) -> DataFrame:
    """S4 (file case): rows of the newest file under ``path`` by modification time;
    an error if there is none."""
    listing = spark.read.format("binaryFile").load(path).select("path", "modificationTime")  # contents are not read
    newest = listing.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path")).first()["path"]
    if newest is None:
        raise FileNotFoundError(f"no dataset file under {path}")
    return spark.read.text(newest).select(F.col("_metadata.file_path").alias("file"), "value")


def latest_version_folder(spark: SparkSession, root: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """S4 (file case, datasets of many files): the rows of the version under ``root/<version>/`` whose newest file is newest,
    ties by the version's name; an error if there is none. The listing alone decides, contents of others are not read."""
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "modificationTime")
               .where(~F.element_at(F.split("path", "/"), -1).rlike("^[_.]")))
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    newest = listing.agg(F.max_by(folder, F.struct("modificationTime", folder)).alias("folder")).first()["folder"]
    if newest is None:
        raise FileNotFoundError(f"no dataset version under {root}")
    return spark.read.schema(schema).format(fmt).load(newest)


def labelled_tree_report(spark: SparkSession, root: str, classes: list[str], exts: list[str]) -> DataFrame:
    """A row per wanted class: (label, n_files, bytes, missing). A class without a folder, or whose folder has no file of the
    known extensions, is reported as missing with zeros; other folders are left out."""
    wanted = spark.createDataFrame([(c,) for c in classes], "label string")
    found = scan_labelled_tree(spark, root, exts, classes).groupBy(F.col("label").alias("_l")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
    return wanted.join(found, F.col("label") == F.col("_l"), "left").select(
        "label", F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"), F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
        F.col("n_files").isNull().alias("missing"))


def scan_labelled_tree(spark: SparkSession, root: str, exts: list[str], classes: list[str] | None = None) -> DataFrame:
    """Listing of ``root/<class>/*`` with the class taken from the parent folder (those of ``classes`` only, if given).
    Only the listing columns are selected, so file contents are not read."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
          .select("path", "length", "modificationTime"))
    low = F.lower(F.col("path"))
    cond = None
    for e in exts:
        c = low.endswith(e.lower())
        cond = c if cond is None else cond | c
    out = df.where(cond).withColumn("label", F.element_at(F.split("path", "/"), -2))
    return out if classes is None else out.where(F.col("label").isin(classes))


def from_records(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A dataset from an in-memory list of dicts, with an explicit schema."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def write_json_array(tokens: DataFrame, token: str, order: str, path: str) -> str:
    """Write one JSON array (a vocabulary file): tokens in ``order``; the table is bounded
    by the vocabulary size, which is the only thing gathered into one row."""
    arr = tokens.agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct(order, token))),
                                           lambda x: x[token])).alias("value"))
    arr.coalesce(1).write.mode("overwrite").text(path)
    return path


def scan_json_array(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of strings per file; position = id."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.posexplode(F.from_json("value", "array<string>")).alias("id", "token"))


def metrics_document(counted: DataFrame, truth: str, pred: str, n: str, per_class: DataFrame, history: DataFrame, now: Column | None = None) -> DataFrame:
    """One row: metrics (accuracy, n_rows), class_names, per_class, confusion_matrix (rows true, columns predicted, in the
    order of class_names), history (epoch, loss, accuracy by epoch) and timestamp.

    ``counted`` is the contingency table, so the predictions are scanned once; ``per_class`` has (cls, precision, recall, f1,
    support). Classes and epochs bound what meets in the row.
    """
    from tessera.operators.evaluate import confusion_counts
    from tessera.operators.tokens import attach_small

    metrics = counted.agg(F.struct((F.sum(F.when(F.col(truth) == F.col(pred), F.col(n)).otherwise(0)) * 100.0 / F.sum(n)).alias("accuracy"),
                                   F.sum(n).alias("n_rows")).alias("metrics"))
    lines = confusion_counts(counted, truth, pred, n).groupBy("true").agg(F.array_sort(F.collect_list(F.struct("pred", "n"))).alias("_line"))
    matrix = lines.agg(F.array_sort(F.collect_list(F.struct("true", "_line"))).alias("_m")).select(
        F.transform("_m", lambda r: r["true"].cast("string")).alias("class_names"),
        F.transform("_m", lambda r: F.transform(r["_line"], lambda c: c["n"])).alias("confusion_matrix"))
    classes = per_class.agg(F.array_sort(F.collect_list(F.struct("cls", "precision", "recall", "f1", "support"))).alias("per_class"))
    epochs = history.agg(F.array_sort(F.collect_list(F.struct("epoch", "loss", "accuracy"))).alias("history"))
    out = metrics
    for part in (matrix, classes, epochs):
        out = attach_small(out, part)
    return out.withColumn("timestamp", F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd HH:mm:ss"))


def sink_metrics(metrics: DataFrame, path: str) -> str:
    """Nested metrics document (one row of structs/arrays) as JSON."""
    _check_not_input(metrics, path)
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


def sink_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace earlier output; never a path the DataFrame reads from."""
    _check_not_input(df, path)
    df.write.mode("overwrite").format(fmt).save(path)
    return path

