"""Sinks: append-only versions behind a gate, an approval pointer, Markdown files and JSON registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.issues import passed


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions under root."""
    fs, where = _fs(spark, f"{root}/versions")
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n) for n in names if n.isdigit())


def snapshot(df: DataFrame, root: str) -> int:
    """df written as the next version; an existing version is never touched."""
    number = (versions(df.sparkSession, root) or [0])[-1] + 1
    df.write.mode("errorifexists").parquet(f"{root}/versions/{number:03d}")
    return number


def gated_snapshot(df: DataFrame, issues: DataFrame, root: str) -> int | None:
    """A new version if no hard issue exists, else None."""
    return snapshot(df, root) if passed(issues) else None


def approve(spark: SparkSession, root: str, version: int, notes: str = "") -> None:
    """Points the approval at an existing version."""
    if version not in versions(spark, root):
        raise ValueError(f"no version {version} under {root}")
    row = spark.range(1).select(F.lit(version).alias("approved_version"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("approved_at"), F.lit(notes).alias("notes"))
    row.write.mode("overwrite").json(f"{root}/approved")


def approved(spark: SparkSession, root: str) -> DataFrame:
    """The approved version's table."""
    number = spark.read.json(f"{root}/approved").first()["approved_version"]
    return spark.read.parquet(f"{root}/versions/{number:03d}")


def write_markdown(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """One folder per document with its text; the documents are written by all executors."""
    docs.select(F.col(key), F.col(text).alias("value")).repartition(F.col(key)).write.partitionBy(key).mode("errorifexists").text(path)


def registry_json(records: DataFrame, key: str = "doc_id") -> DataFrame:
    """One JSON array of records per document, in order of page_start and id: key, json."""
    cols = [c for c in records.columns if c != key]
    rows = F.array_sort(F.collect_list(F.struct("page_start", "id", F.struct(*cols).alias("r"))))
    return records.groupBy(key).agg(F.to_json(F.transform(rows, lambda x: x["r"])).alias("json"))


def run_log(before: DataFrame, after: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Sizes and hashes of every document before and after a run, with the time."""
    side = lambda df, n: df.select(key, F.octet_length(text).alias(f"bytes_{n}"), F.upper(F.sha2(F.col(text), 256)).alias(f"sha256_{n}"))
    return side(before, "before").join(side(after, "after"), key, "full_outer").withColumn("at", F.current_timestamp())
