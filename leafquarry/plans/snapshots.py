"""Queries on consecutive deliveries of navigation lists."""

from pyspark.sql import functions as F

from ..functions.look import look, squeezed
from ..operators.snapshots import snapshot_changes
from ..session import table


def changes(spark, sf_dir):
    return snapshot_changes(
        table(spark, sf_dir, "manifest_entries"), "job_id", "snapshot_no", "id",
        {"title": squeezed(look(F.col("title"))), "page": F.col("page")}, "delivered_at",
    )


def p2_found(spark, sf_dir):
    return changes(spark, sf_dir).select("job_id", "snapshot_no", "id", "change_type")


def p2_changed_fields(spark, sf_dir):
    return changes(spark, sf_dir).groupBy("change_type", F.array_join("changed_fields", ",").alias("fields")).agg(
        F.count(F.lit(1)).alias("n")
    )


def p2_exact_changes(spark, sf_dir):
    """Changes where titles are compared character by character, with the fields that changed."""
    raw = {"title": F.col("title"), "page": F.col("page")}
    made = snapshot_changes(table(spark, sf_dir, "manifest_entries"), "job_id", "snapshot_no", "id", raw, "delivered_at")
    return made.select("job_id", "snapshot_no", "id", "change_type", F.array_join("changed_fields", ",").alias("fields"))


QUERIES = {"p2_found": p2_found, "p2_changed_fields": p2_changed_fields, "p2_exact_changes": p2_exact_changes}
SQL = {
    "p2_exact_changes": """
WITH d AS (SELECT job_id, snapshot_no, id, title, page FROM (SELECT *, row_number() OVER (PARTITION BY job_id, snapshot_no, id
  ORDER BY delivered_at DESC NULLS LAST, title DESC NULLS LAST, page DESC NULLS LAST) AS k FROM manifest_entries
  WHERE job_id IS NOT NULL AND snapshot_no IS NOT NULL AND id IS NOT NULL) WHERE k = 1),
s AS (SELECT job_id, snapshot_no, lag(snapshot_no) OVER (PARTITION BY job_id ORDER BY snapshot_no) AS prev FROM (SELECT DISTINCT job_id, snapshot_no FROM d)),
n AS (SELECT d.* FROM d JOIN s USING (job_id, snapshot_no) WHERE prev IS NOT NULL),
o AS (SELECT d.job_id, s.snapshot_no, d.id, d.title, d.page FROM d JOIN s ON d.job_id = s.job_id AND d.snapshot_no = s.prev)
SELECT coalesce(n.job_id, o.job_id) AS job_id, coalesce(n.snapshot_no, o.snapshot_no) AS snapshot_no, coalesce(n.id, o.id) AS id,
  CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' ELSE 'changed' END AS change_type,
  CASE WHEN o.id IS NULL OR n.id IS NULL THEN 'title,page' ELSE concat_ws(',', CASE WHEN n.title IS DISTINCT FROM o.title THEN 'title' END, CASE WHEN n.page IS DISTINCT FROM o.page THEN 'page' END) END AS fields
FROM n FULL JOIN o ON n.job_id = o.job_id AND n.snapshot_no = o.snapshot_no AND n.id = o.id
WHERE o.id IS NULL OR n.id IS NULL OR n.title IS DISTINCT FROM o.title OR n.page IS DISTINCT FROM o.page""",
}
