"""Queries of page scans, of versions and of overrides, with oracle SQL."""

from uuid import uuid4

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import shared_folder, table
from ..sources import sinks
from .windows import _LINES, doc_lines

QUERIES: dict = {}
SQL: dict = {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query("SELECT line_id, extracted_at, s.font AS font, s.flags AS flags, s.size AS size, s.text AS text FROM (SELECT line_id, extracted_at, unnest(spans) AS s FROM pdf_lines)")
def s01_span_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").select("line_id", "extracted_at", F.explode("spans").alias("s"))
    return rows.select("line_id", "extracted_at", "s.font", "s.flags", "s.size", "s.text")


@query(f"""WITH l AS ({_LINES}), t AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM l WHERE starts_with(trim(line, ' '), '|'))
SELECT doc_id, min(line_no)::INTEGER AS first_line, count(*) AS n_rows, max(length(line) - length(replace(line, '|', '')))::INTEGER AS bars FROM t GROUP BY doc_id, g""")
def s02_tables(spark, sf_dir):
    rows = doc_lines(spark, sf_dir).where(F.trim("line").startswith("|"))
    runs = rows.withColumn("g", F.col("line_no") - F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no")))
    bars = F.length("line") - F.length(F.replace(F.col("line"), F.lit("|"), F.lit("")))
    return runs.groupBy("doc_id", "g").agg(F.min("line_no").alias("first_line"), F.count(F.lit(1)).alias("n_rows"), F.max(bars).alias("bars")).drop("g")


@query("SELECT job_id, snapshot_no, 'versions/' || CASE WHEN length(snapshot_no::VARCHAR) < 3 THEN lpad(snapshot_no::VARCHAR, 3, '0') ELSE snapshot_no::VARCHAR END AS path, count(*) AS records, max(snapshot_no) OVER (PARTITION BY job_id) + 1 AS next_version FROM manifest_entries WHERE job_id IS NOT NULL AND snapshot_no IS NOT NULL GROUP BY job_id, snapshot_no")
def k06_versions(spark, sf_dir):
    rows = table(spark, sf_dir, "manifest_entries").where("job_id is not null and snapshot_no is not null")
    per = rows.groupBy("job_id", "snapshot_no").agg(F.count(F.lit(1)).alias("records"))
    path = F.concat(F.lit("versions/"), X.padded(F.col("snapshot_no"), 3))
    return per.select("job_id", "snapshot_no", path.alias("path"), "records", (F.max("snapshot_no").over(Window.partitionBy("job_id")) + 1).alias("next_version"))


@query("SELECT job_id, count(*) AS entries, count(DISTINCT id) AS ids, 1 AS approved_version, '1,2' AS versions FROM manifest_entries GROUP BY job_id")
def k07_approved_version(spark, sf_dir):
    """The table written as a version, a smaller one after it, the first one approved and read through the approval."""
    root = f"{shared_folder(spark)}/k07-{uuid4().hex}"
    entries = table(spark, sf_dir, "manifest_entries").select("job_id", "snapshot_no", "id", "title")
    first = sinks.snapshot(entries, root)
    sinks.snapshot(entries.where("title is null"), root)
    sinks.approve(spark, root, first)
    made = sinks.approved(spark, root).groupBy("job_id").agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("id").alias("ids"))
    return made.select("job_id", "entries", "ids", F.lit(first).alias("approved_version"), F.lit(",".join(map(str, sinks.versions(spark, root)))).alias("versions"))


@query("SELECT id, received_at, strftime(received_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM jobs")
def c36_timestamps(spark, sf_dir):
    return table(spark, sf_dir, "jobs").select("id", "received_at", F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"))


@query("SELECT l.line_id, coalesce(max(t.term), max(l.text)) AS text FROM (SELECT DISTINCT line_id, text FROM pdf_lines WHERE text IS NOT NULL) l LEFT JOIN glossary t ON lower(l.text) = lower(t.term) GROUP BY l.line_id")
def n03_line_rewrites(spark, sf_dir):
    """Rewrites are rows (text to find, text to put); lines without one stay."""
    rewrites = table(spark, sf_dir, "glossary").where("term is not null").groupBy(F.lower("term").alias("k")).agg(F.max("term").alias("put"))
    lines = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "text").distinct()
    met = lines.join(rewrites, F.lower("text") == F.col("k"), "left")
    return met.groupBy("line_id").agg(F.coalesce(F.max("put"), F.max("text")).alias("text"))


@query("SELECT c.doc_id, c.chunk_id, CASE WHEN count(*) > 1 THEN 'generated' ELSE 'first' END AS origin FROM chunks c GROUP BY ALL")
def n04_generated_overrides(spark, sf_dir):
    """Of the rows of one key a later one overrides the first; which keys were overridden."""
    per = table(spark, sf_dir, "chunks").groupBy("doc_id", "chunk_id").agg(F.count(F.lit(1)).alias("n"))
    return per.select("doc_id", "chunk_id", F.when(F.col("n") > 1, "generated").otherwise("first").alias("origin"))

