"""Queries of stateful repairs, layout merges and formats; SQL where the oracle can say the same."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import repairs as R
from ..functions import text as X
from ..operators import lines as L
from ..operators.formatting import collapse_blanks, format_documents, page_blocks, page_markdown
from ..session import table
from .windows import _LINES, _SPANS, doc_lines, spans

QUERIES: dict = {}
SQL: dict = {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def boxes(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").where("x0 is not null and y0 is not null and x1 is not null and y1 is not null")
    return rows.select("line_id", "doc_id", "page", "x0", "y0", "x1", "y1", "text").distinct()


@query()
def c09_titles(spark, sf_dir):
    rows = table(spark, sf_dir, "manifest_entries").where("title is not null")
    return rows.select("job_id", "id", R.fix_reversed_title(F.col("title")).alias("title"))


@query("SELECT doc_id, group_id AS result FROM span_groups WHERE title IS NOT NULL")
def c10_clean_ids(spark, sf_dir):
    return table(spark, sf_dir, "span_groups").where("title is not null").select("doc_id", R.clean_id(F.col("group_id"), F.col("title")).alias("result"))


@query("SELECT job_id, id, CASE WHEN page IS NULL THEN trim(title, ' ') ELSE trim(title, ' ') || ' — ' || page END AS line FROM manifest_entries WHERE title IS NOT NULL")
def c37_list_of_figures(spark, sf_dir):
    t = F.trim("title")
    return table(spark, sf_dir, "manifest_entries").where("title is not null").select("job_id", "id", F.when(F.col("page").isNull(), t).otherwise(F.concat(t, F.lit(" — "), F.col("page").cast("string"))).alias("line"))


@query(f"""WITH l AS ({_LINES}), h AS (SELECT *, starts_with(line, '#') AS hd FROM l) SELECT doc_id, count(*) + count_if(hd) AS n_lines FROM h GROUP BY doc_id""")
def c38_figure_injection(spark, sf_dir):
    head = F.col("line").startswith("#")
    image = F.concat(F.lit("![]("), F.col("doc_id").cast("string"), F.lit(".png)"))
    many = doc_lines(spark, sf_dir).select("doc_id", F.explode(F.when(head, F.array(F.col("line"), image)).otherwise(F.array("line"))).alias("line"))
    return many.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query(f"""WITH l AS ({_LINES}), c AS (SELECT DISTINCT doc_id, lower(trim(unnest(string_split(trim(line, '| '), '|')), ' ')) AS cell FROM l WHERE starts_with(trim(line, ' '), '|'))
SELECT l.doc_id, l.line_no, l.line FROM l ANTI JOIN c ON l.doc_id = c.doc_id AND lower(trim(l.line, ' ')) = c.cell AND NOT starts_with(trim(l.line, ' '), '|') AND c.cell <> ''""")
def c40_dual_prose(spark, sf_dir):
    rows = doc_lines(spark, sf_dir).withColumn("t", F.lower(F.trim("line")))
    cells = rows.where(F.col("t").startswith("|")).select("doc_id", F.explode(F.split(F.btrim("t", F.lit("| ")), r"\|")).alias("c")).select("doc_id", F.trim("c").alias("t")).distinct().where("t <> ''")
    return rows.join(cells, ["doc_id", "t"], "left_anti").select("doc_id", "line_no", "line")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 AND title IS NOT NULL THEN '# ' || title ELSE text END AS text FROM documents")
def c41_page_replace(spark, sf_dir):
    new = docs(spark, sf_dir).where("doc_id % 2 = 0 and title is not null").select("doc_id", F.concat(F.lit("# "), "title").alias("new"))
    return docs(spark, sf_dir).select("doc_id", "text").join(new, "doc_id", "left").select("doc_id", F.coalesce("new", "text").alias("text"))


@query(f"""WITH l AS ({_LINES}) SELECT doc_id, count_if(regexp_matches(line, '(?i)chapter [0-9]+')) >= 3 OR max(length(line)) > 400 AS narrative FROM l GROUP BY doc_id""")
def f16_narrative(spark, sf_dir):
    n = F.count_if(F.col("line").rlike("(?i)chapter [0-9]+"))
    return doc_lines(spark, sf_dir).groupBy("doc_id").agg(((n >= 3) | (F.max(F.length("line")) > 400)).alias("narrative"))


_KNOWN = "[" + ",".join(f"'{w}'" for w in X.SCORE_WORDS) + "]"


@query(f"SELECT id, page, CASE WHEN len(w) < 30 THEN 1.0 ELSE round(len(list_filter(w, lambda x: list_contains({_KNOWN}, x)))::DOUBLE / len(w), 6) END AS score FROM (SELECT doc_id AS id, n_chars AS page, regexp_extract_all(lower(text), '[a-z]{{2,}}') AS w FROM documents WHERE text IS NOT NULL)")
def g03_table_score(spark, sf_dir):
    w = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{2,}"), F.lit(0))
    rows = docs(spark, sf_dir).where("text is not null").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("page"), w.alias("w"))
    share = F.round(F.size(F.filter("w", lambda x: x.isin(*X.SCORE_WORDS))) / F.size("w"), 6)
    return rows.select("id", "page", F.when(F.size("w") < 30, F.lit(1.0)).otherwise(share).alias("score"))


@query(f"""WITH l AS ({_LINES}), m AS (SELECT *, CASE WHEN starts_with(line, '#') THEN trim(line, ' ') END AS h FROM l), p AS (SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ph FROM m)
SELECT doc_id, count(*) AS kept FROM p WHERE h IS NULL OR ph IS NULL OR h <> ph GROUP BY doc_id""")
def w02_repeated_markers(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(*L.BEFORE)
    rows = doc_lines(spark, sf_dir).withColumn("h", F.when(F.col("line").startswith("#"), F.trim("line"))).withColumn("ph", F.last("h", True).over(w))
    return rows.where("h is null or ph is null or h <> ph").groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"))


@query()
def w09_box_stacks(spark, sf_dir):
    per = boxes(spark, sf_dir).groupBy("doc_id", "page").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("b"))
    return per.select("doc_id", "page", F.explode(R.merge_stacks(F.col("b"))).alias("s")).select("doc_id", "page", "s.*")


@query()
def w12_reading_order(spark, sf_dir):
    kind = F.when(F.col("x0") > 100, "table").otherwise("prose")
    el = F.struct("line_id", kind.alias("kind"), "x0", "y0", "x1", "y1")
    per = boxes(spark, sf_dir).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(el)).alias("e"))
    order = R.in_reading_order(F.transform("e", lambda e: e.dropFields("line_id")), 595.0)
    ranked = per.withColumn("o", order).select("doc_id", "page", "e", F.posexplode("o").alias("seq", "i"))
    return ranked.select("doc_id", "page", "seq", F.get("e", F.col("i"))["line_id"].alias("line_id"))


@query()
def w19_page_blocks(spark, sf_dir):
    return format_documents(docs(spark, sf_dir), [("page blocks", page_blocks), ("blank runs", collapse_blanks)])


@query()
def w21_bands(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "doc_id", "page", "line_no", "text").distinct()
    bands = rows.groupBy("doc_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line_id", "text"))), lambda x: x["text"]).alias("b"))
    return bands.select("doc_id", "page", F.posexplode(R.stitch_bands(F.col("b"))).alias("band_no", "text"))


@query()
def d03_figure_page(spark, sf_dir):
    """The elements of a page in reading order, captions as their pictures and without the labels under these."""
    texts = boxes(spark, sf_dir).select("line_id", "text")
    ordered = w12_reading_order(spark, sf_dir).join(texts, "line_id").select("doc_id", "page", F.col("seq").alias("line_no"), "text", F.lit(None).cast("double").alias("size"))
    return page_markdown(ordered)


@query()
def d09_page_markdown(spark, sf_dir):
    size = F.get("spans", F.lit(0))["size"]
    rows = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "doc_id", "page", "line_no", "text", size.alias("size")).distinct()
    return page_markdown(rows)


@query()
def d10_format(spark, sf_dir):
    return format_documents(docs(spark, sf_dir))


@query("SELECT * FROM (SELECT doc_id, instr(text, title) > 0 AS literal FROM documents WHERE title IS NOT NULL AND text IS NOT NULL)")
def v05_document_gates(spark, sf_dir):
    rules = docs(spark, sf_dir).where("title is not null").select("doc_id", F.col("title").alias("literal_text"))
    met = docs(spark, sf_dir).where("text is not null").select("doc_id", "text").join(rules, "doc_id")
    return met.select("doc_id", (F.instr("text", F.col("literal_text")) > 0).alias("literal"))


@query()
def v17_aligned_diff(spark, sf_dir):
    """Every delivered snapshot against the job's previous delivered one; snapshot_no is that of the later."""
    rows = table(spark, sf_dir, "manifest_entries").where("job_id is not null and snapshot_no is not null")
    entry = F.when(F.col("title").isNotNull(), F.struct("page", "id", "title"))  # a snapshot without titles is a delivered one
    titles = F.transform(F.array_sort(F.collect_set(entry)), lambda x: x["title"])
    w = Window.partitionBy("job_id").orderBy("snapshot_no")
    snaps = rows.groupBy("job_id", "snapshot_no").agg(titles.alias("t2"))
    both = snaps.withColumn("t1", F.lag("t2").over(w)).where("t1 is not null")
    return both.select("job_id", "snapshot_no", F.explode(R.opcodes(F.col("t1"), F.col("t2"))).alias("o")).select("job_id", "snapshot_no", "o.*")


@query("SELECT doc_id, CASE WHEN text = replace(text, 'working', 'w0rking') THEN -1 ELSE instr(text, 'working') END AS at FROM documents WHERE text IS NOT NULL")
def v18_first_difference(spark, sf_dir):
    rows = docs(spark, sf_dir).where("text is not null")
    return rows.select("doc_id", R.first_diff(F.col("text"), F.replace(F.col("text"), F.lit("working"), F.lit("w0rking"))).alias("at"))


@query("SELECT doc_id, replace(replace(text, 'colour', 'color'), 'programme', 'program') AS text FROM documents")
def n01_literal_patches(spark, sf_dir):
    """Patches are rows (ordered literal pairs), not code; one pass applies them in order."""
    return docs(spark, sf_dir).select("doc_id", X.replace_all(F.col("text"), [("colour", "color"), ("programme", "program")]).alias("text"))


@query("SELECT doc_id, page, coalesce(o.body, string_agg(l.text, chr(10) ORDER BY l.line_no, l.line_id)) AS body FROM (SELECT DISTINCT line_id, doc_id, page, line_no, text FROM pdf_lines WHERE text IS NOT NULL) l LEFT JOIN (SELECT doc_id AS od, start_page AS op, max(chunk_id) AS body FROM chunks GROUP BY ALL) o ON l.doc_id = o.od AND l.page = o.op GROUP BY doc_id, page, o.body")
def n02_page_overrides(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "doc_id", "page", "line_no", "text").distinct()
    auto = rows.groupBy("doc_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line_id", "text"))), lambda x: x["text"]), "\n").alias("auto"))
    over = table(spark, sf_dir, "chunks").groupBy("doc_id", F.col("start_page").alias("page")).agg(F.max("chunk_id").alias("o"))
    return auto.join(over, ["doc_id", "page"], "left").select("doc_id", "page", F.coalesce("o", "auto").alias("body"))
