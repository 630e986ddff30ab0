"""The project's tables in the form the operators take them."""

from pyspark.sql import functions as F

from ..functions.look import look
from ..operators.snapshots import latest
from ..session import table


def jobs(spark, sf_dir):
    """One row per job, the latest delivery: id, publisher, scanned, pages."""
    raw = table(spark, sf_dir, "jobs").select(
        "id", "publisher", "profile", F.col("source.expected_page_count").alias("pages"), "received_at"
    )
    last = latest(raw, ["id"], "received_at", ["publisher", "profile", "pages"])
    return last.select("id", "publisher", "pages", F.coalesce(F.col("profile") == "page_png", F.lit(False)).alias("scanned"))


def lines(spark, sf_dir, *columns):
    return table(spark, sf_dir, "pdf_lines").select(*columns)


def chunks(spark, sf_dir):
    """Chunks as delivered last: doc, item, lo, hi; an open end is the last page of the document."""
    last = latest(table(spark, sf_dir, "chunks"), ["doc_id", "chunk_id"], "delivered_at", ["start_page", "end_page"])
    known = jobs(spark, sf_dir).select(F.col("id").alias("doc_id"), "pages")
    ended = last.join(known, "doc_id", "left").withColumn("end_page", F.coalesce("end_page", "pages"))
    return ended.where("start_page is not null and end_page is not null").select(
        F.col("doc_id").alias("doc"), F.col("chunk_id").alias("item"),
        F.least("start_page", "end_page").alias("lo"), F.greatest("start_page", "end_page").alias("hi"),
    )


def span_groups(spark, sf_dir):
    """Span groups as often as delivered: doc, lo, hi, title, protected; swapped pages put right, a missing page is the other one."""
    raw = table(spark, sf_dir, "span_groups").select("doc_id", "span_type", "start_page", "end_page", "title")
    a, b = F.coalesce("start_page", "end_page"), F.coalesce("end_page", "start_page")
    long_series = (F.col("span_type") == "series") & (F.col("hi") - F.col("lo") + 1 >= 10)
    return (
        raw.where("doc_id is not null")
        .withColumn("lo", F.least(a, b)).withColumn("hi", F.greatest(a, b)).where("lo is not null")
        .select(
            F.col("doc_id").alias("doc"), "lo", "hi", "title",
            F.coalesce(F.col("span_type").isin("continuation", "section_block") | long_series, F.lit(False)).alias("protected"),
        )
    )


def layout_rows(spark, sf_dir, scanned: bool):
    """Line and token rows of the scanned, or of the other, documents in one form."""
    docs = jobs(spark, sf_dir).where(F.col("scanned") == scanned).select(F.col("id").alias("doc"))
    size = F.get("spans", F.lit(0))["size"]
    rows = table(spark, sf_dir, "pdf_lines").select(
        F.lit("line").alias("kind"), F.col("line_id").alias("row_id"), F.col("doc_id").alias("doc"), "page",
        F.col("line_no").alias("no"), "y0", "x0", size.alias("size"), "text",
    )
    toks = table(spark, sf_dir, "page_toks").select(
        F.lit("tok").alias("kind"), F.col("tok_id").alias("row_id"), F.col("doc_id").alias("doc"), "page",
        F.col("tok_no").alias("no"), "y0", "x0", "size", "text",
    )
    return rows.unionByName(toks).where("text is not null and row_id is not null").join(docs, "doc")


def reference_texts(spark, sf_dir):
    """Titles of jobs and glossary terms: texts that no scanner has touched, in consistent form."""
    titles = table(spark, sf_dir, "jobs").select(F.col("title").alias("text"))
    terms = table(spark, sf_dir, "glossary").select(F.col("term").alias("text"))
    copies = terms.select("text", F.explode(F.sequence(F.lit(1), F.lit(2)))).select("text")  # a term is always known
    return titles.unionByName(copies).where("text is not null").select(look(F.col("text")).alias("form"))
