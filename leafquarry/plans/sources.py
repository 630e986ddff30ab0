"""Queries of scans and of incremental work, run as batches over whole tables."""

from pyspark.sql import functions as F

from ..sources.files import JOB
from ..sources.sinks import registry_json
from ..streaming.incremental import cleaned, sessions, windowed_counts
from ..session import table
from .windows import _LINES, doc_lines, spans

QUERIES: dict = {}
SQL: dict = {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query(f"SELECT doc_id, line_no, rtrim(line, ' ') AS line, trim(line, ' ') = '' AS is_break FROM ({_LINES})")
def s06_text_lines(spark, sf_dir):
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", F.rtrim("line").alias("line"), (F.trim("line") == "").alias("is_break"))


@query("SELECT doc_id, text, strlen(text) AS bytes FROM documents WHERE text IS NOT NULL")
def s07_whole_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "text", F.octet_length("text").alias("bytes"))


@query("SELECT id, received_at, title, source.sha256 AS sha256, extraction.chunk_size AS chunk_size, len(extraction.levels) AS n_levels FROM jobs")
def s08_json_sidecars(spark, sf_dir):
    jobs = table(spark, sf_dir, "jobs")
    text = F.to_json(F.struct(*[c for c in jobs.columns if c not in ("received_at", "product", "output")]))
    read = jobs.select("received_at", F.from_json(text, JOB).alias("j"))
    return read.select("j.id", "received_at", "j.title", "j.source.sha256", "j.extraction.chunk_size", F.nullif(F.size("j.extraction.levels"), F.lit(-1)).alias("n_levels"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_valid(props) AS valid FROM events")
def s09_json_lines(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.expr("try_parse_json(props)").isNotNull().alias("valid"))


@query()
def k04_registry_json(spark, sf_dir):
    records = spans(spark, sf_dir).select("doc_id", F.col("group_id").alias("id"), "title", F.col("lo").alias("page_start"), F.col("hi").alias("page_end"))
    return registry_json(records)


@query()
def d11_cleanup(spark, sf_dir):
    return cleaned(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", F.array_join("fixes", ",").alias("fixes"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts::TIMESTAMP) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def x01_event_windows(spark, sf_dir):
    made = windowed_counts(table(spark, sf_dir, "events").select("ts", "event_type", "value"))
    return made.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""WITH e AS (SELECT user_id, ts::TIMESTAMP AS ts, lag(ts::TIMESTAMP) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
s AS (SELECT *, sum(CASE WHEN p IS NULL OR ts >= p + INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM e)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM s GROUP BY user_id, s""")
def x02_event_sessions(spark, sf_dir):
    made = sessions(table(spark, sf_dir, "events").where("user_id is not null").select("ts", "user_id"))
    return made.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
