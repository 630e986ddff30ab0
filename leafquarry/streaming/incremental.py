"""Incremental work: new files and events as streams that also run as batches.

The functions take streaming or static DataFrames, so a query can be checked as a batch and then run as a stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as X


def new_markdown(spark: SparkSession, path: str, files_at_once: int = 1000) -> DataFrame:
    """Stream of whole Markdown files as they arrive: name, text."""
    stream = spark.readStream.option("maxFilesPerTrigger", files_at_once).option("wholetext", True).text(path)
    return stream.select(F.regexp_extract(F.input_file_name(), r"([^/]+)$", 1).alias("name"), F.col("value").alias("text"))


def cleaned(docs: DataFrame) -> DataFrame:
    """Stateless cleanup that holds for a stream: broken words, typos, URLs, with the fixes that changed the text."""
    steps = [("hyphenation", X.fix_broken_words), ("typos", X.fix_typos), ("urls", X.sanitize_urls)]
    made = docs.withColumn("_t0", F.col("text"))
    for i, (_, step) in enumerate(steps):
        made = made.withColumn(f"_t{i + 1}", step(F.col(f"_t{i}")))
    labels = F.array(*[F.when(F.col(f"_t{i}") != F.col(f"_t{i + 1}"), F.lit(n)) for i, (n, _) in enumerate(steps)])
    return made.withColumn("fixes", F.filter(labels, lambda x: x.isNotNull())).withColumn("text", F.col(f"_t{len(steps)}")).drop(*[f"_t{i}" for i in range(len(steps) + 1)])


def ingest(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Everything that has arrived since the last run appended to the target table, once."""
    return stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events per type and tumbling window, with a watermark for late ones: window_start, event_type, n, total."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    marked = timed.withWatermark("ts", late) if events.isStreaming else timed
    return marked.groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(
        F.col("window.start").alias("window_start"), "event_type", "n", "total"
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Sessions of each user, parted by gaps: user_id, session_start, session_end, n."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    marked = timed.withWatermark("ts", late) if events.isStreaming else timed
    return marked.groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n")).select(
        "user_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n"
    )
