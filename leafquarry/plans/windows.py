"""Queries of the ordered operators over whole tables, with oracle SQL where windows can say the same."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import lines as L
from ..session import table

QUERIES: dict = {}
SQL: dict = {}

_LINES = (
    "SELECT doc_id, unnest(generate_series(1, len(l))) AS line_no, unnest(l) AS line FROM "
    "(SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)"
)
_ROWS = "SELECT DISTINCT line_id, doc_id, page, line_no, y0, x0, text FROM pdf_lines WHERE text IS NOT NULL AND y0 IS NOT NULL"


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def doc_lines(spark, sf_dir):
    return L.exploded(table(spark, sf_dir, "documents"))


def layout(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").where("text is not null and y0 is not null")
    return rows.select("line_id", "doc_id", "page", "line_no", "y0", "x0", "text").distinct()


def spans(spark, sf_dir):
    """Span groups once each; swapped pages are put right, a missing page is the other one."""
    a, b = F.coalesce("start_page", "end_page"), F.coalesce("end_page", "start_page")
    rows = table(spark, sf_dir, "span_groups").where("doc_id is not null").where(a.isNotNull())
    lo, hi = F.least(a, b), F.greatest(a, b)
    return rows.select("doc_id", "group_id", "span_type", "title", lo.alias("lo"), hi.alias("hi")).distinct()


_SPANS = (
    "SELECT DISTINCT doc_id, group_id, span_type, title, least(coalesce(start_page, end_page), coalesce(end_page, start_page)) AS lo, "
    "greatest(coalesce(start_page, end_page), coalesce(end_page, start_page)) AS hi "
    "FROM span_groups WHERE coalesce(start_page, end_page) IS NOT NULL AND doc_id IS NOT NULL"
)


@query(f"WITH l AS ({_LINES}), p AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS p FROM l) "
       "SELECT doc_id, count(*) AS kept FROM p WHERE trim(line) = '' OR p IS NULL OR p <> line GROUP BY doc_id")
def w01_no_repeats(spark, sf_dir):
    return L.no_repeats(doc_lines(spark, sf_dir), ["doc_id"]).groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"))


@query(f"""WITH r AS ({_ROWS}), p AS (SELECT *, lag(y0) OVER w AS py, lag(text) OVER w AS pt FROM r WINDOW w AS (PARTITION BY doc_id, page ORDER BY line_no, line_id)),
s AS (SELECT *, sum(CASE WHEN coalesce(py IS NULL OR y0 - py >= 15 OR trim(pt, ' ') = '' OR regexp_matches(trim(text, ' '), '^([#*•-]|[0-9]+(\\.[0-9]+)+\\.?\\s|[0-9]{{1,2}}\\.\\s+\\S)'), true) THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id, page ORDER BY line_no, line_id ROWS UNBOUNDED PRECEDING) AS paragraph FROM p)
SELECT doc_id, page, paragraph, string_agg(trim(text, ' '), ' ' ORDER BY line_no, line_id) AS text, count(*) AS n_rows FROM s WHERE trim(text, ' ') <> '' GROUP BY ALL""")
def w03_gap_paragraphs(spark, sf_dir):
    return L.gap_paragraphs(layout(spark, sf_dir), ["doc_id", "page"], "y0", "text", ["line_no", "line_id"])


def _merged_rows(tolerance: float, middle: float) -> str:
    """Rows anchored on their first fragment, by recursion over the fragments of a page in order."""
    return f"""WITH RECURSIVE t AS (SELECT DISTINCT tok_id, doc_id, page, y0, x0, text FROM page_toks WHERE y0 IS NOT NULL AND text IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY y0, x0 NULLS FIRST, text) AS k FROM t),
f AS (SELECT doc_id, page, k, y0, x0, text, y0 AS top FROM r WHERE k = 1 UNION ALL
  SELECT r.doc_id, r.page, r.k, r.y0, r.x0, r.text, CASE WHEN r.y0 - f.top <= {tolerance} THEN f.top ELSE r.y0 END FROM f JOIN r ON r.doc_id IS NOT DISTINCT FROM f.doc_id AND r.page IS NOT DISTINCT FROM f.page AND r.k = f.k + 1)
SELECT doc_id, page, first(y0 ORDER BY x0, y0, text) AS y, min(x0) AS x, coalesce(string_agg(trim(text, ' '), ' ' ORDER BY x0, y0, text) FILTER (WHERE trim(text, ' ') <> ''), '') AS text
FROM f WHERE x0 IS NOT NULL GROUP BY doc_id, page, top, x0 < {middle}"""


@query(_merged_rows(3.0, 595 * 0.48))
def w04_same_row(spark, sf_dir):
    toks = table(spark, sf_dir, "page_toks").where("y0 is not null and text is not null").select("tok_id", "doc_id", "page", "y0", "x0", "text").distinct()
    pages = toks.groupBy("doc_id", "page").agg(F.collect_list(F.struct(F.col("y0").alias("y"), F.col("x0").alias("x"), "text")).alias("e"))
    return pages.select("doc_id", "page", F.explode(L.merge_same_row(F.col("e"), 3.0, 595 * 0.48)).alias("r")).select("doc_id", "page", "r.*")


@query(_merged_rows(7.0, 595 * 0.82))
def w05_toc_bands(spark, sf_dir):
    toks = table(spark, sf_dir, "page_toks").where("y0 is not null and text is not null").select("tok_id", "doc_id", "page", "y0", "x0", "text").distinct()
    pages = toks.groupBy("doc_id", "page").agg(F.collect_list(F.struct(F.col("y0").alias("y"), F.col("x0").alias("x"), "text")).alias("e"))
    return pages.select("doc_id", "page", F.explode(L.merge_same_row(F.col("e"), 7.0, 595 * 0.82)).alias("r")).select("doc_id", "page", "r.*")


@query(f"""WITH r AS ({_ROWS}), c AS (SELECT *, sum(CASE WHEN x0 < 100 THEN 1 ELSE 0 END) OVER w AS nl, sum(CASE WHEN x0 < 100 THEN 0 ELSE 1 END) OVER w AS nr FROM r WHERE x0 IS NOT NULL WINDOW w AS (PARTITION BY doc_id, page))
SELECT doc_id, page, line_id, row_number() OVER (PARTITION BY doc_id, page ORDER BY CASE WHEN nl >= 5 AND nr >= 5 AND x0 >= 100 THEN 1 ELSE 0 END, y0, x0, line_id) AS reading_no FROM c""")
def w06_column_order(spark, sf_dir):
    rows = layout(spark, sf_dir).where("x0 is not null")
    page = Window.partitionBy("doc_id", "page")
    left = F.col("x0") < 100
    two = (F.sum(left.cast("int")).over(page) >= 5) & (F.sum((~left).cast("int")).over(page) >= 5)
    w = Window.partitionBy("doc_id", "page").orderBy("half", "y0", "x0", "line_id")
    return rows.withColumn("half", F.when(two & ~left, 1).otherwise(0)).select("doc_id", "page", "line_id", F.row_number().over(w).alias("reading_no"))


@query(f"""WITH r AS ({_ROWS}), k AS (SELECT *, CASE WHEN y0 >= 842*0.88 THEN 'page_marker' WHEN y0 > 842*0.62 AND regexp_matches(trim(text), '^[0-9]{{1,3}}\\.[ \\t]') THEN 'footnote' ELSE 'body' END AS kind FROM r),
c AS (SELECT *, last_value(CASE WHEN kind <> 'body' OR y0 <= 842*0.65 THEN kind END IGNORE NULLS) OVER (PARTITION BY doc_id, page ORDER BY line_no, line_id ROWS UNBOUNDED PRECEDING) AS zone FROM k)
SELECT doc_id, coalesce(zone, 'body') AS zone, count(*) AS n FROM c GROUP BY ALL""")
def w07_zones(spark, sf_dir):
    rows = layout(spark, sf_dir)
    kind = F.when(F.col("y0") >= 842 * 0.88, "page_marker").when(
        (F.col("y0") > 842 * 0.62) & F.trim("text").rlike(r"^[0-9]{1,3}\.[ \t]"), "footnote").otherwise("body")
    w = Window.partitionBy("doc_id", "page").orderBy("line_no", "line_id").rowsBetween(*L.SO_FAR)
    said = F.when((F.col("kind") != "body") | (F.col("y0") <= 842 * 0.65), F.col("kind"))
    carried = rows.withColumn("kind", kind).withColumn("zone", F.coalesce(F.last(said, True).over(w), F.lit("body")))
    return carried.groupBy("doc_id", "zone").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH s AS (SELECT doc_id, span_type, lo, hi, title, max(hi) OVER (PARTITION BY doc_id, span_type ORDER BY lo, hi, title NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ({_SPANS})),
i AS (SELECT *, sum(CASE WHEN r IS NULL OR lo > r + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, span_type ORDER BY lo, hi, title NULLS FIRST ROWS UNBOUNDED PRECEDING) AS i FROM s)
SELECT doc_id, span_type, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM i GROUP BY doc_id, span_type, i""")
def w08_span_chains(spark, sf_dir):
    return L.merge_chains(spans(spark, sf_dir), ["doc_id", "span_type"]).select("doc_id", "span_type", "lo", "hi", "n")


@query(f"""WITH s AS (SELECT doc_id, span_type, lo, hi, title, max(hi) OVER (PARTITION BY doc_id, span_type ORDER BY lo, hi, title NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ({_SPANS})),
i AS (SELECT *, sum(CASE WHEN r IS NULL OR lo > r + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, span_type ORDER BY lo, hi, title NULLS FIRST ROWS UNBOUNDED PRECEDING) AS i FROM s)
SELECT doc_id, span_type, min(lo)::INTEGER AS lo, max(hi)::INTEGER AS hi, list_reduce(list({{'lo': lo, 'hi': hi, 'title': title}} ORDER BY lo, hi, title NULLS FIRST),
  lambda a, x: {{'lo': least(a.lo, x.lo), 'hi': greatest(a.hi, x.hi), 'title': CASE WHEN a.hi - a.lo >= x.hi - x.lo THEN a.title ELSE x.title END}}).title AS title, count(*) AS n FROM i GROUP BY doc_id, span_type, i""")
def w08_chain_titles(spark, sf_dir):
    return L.merge_chains(spans(spark, sf_dir), ["doc_id", "span_type"])


@query("""WITH p AS (SELECT DISTINCT doc_id, page FROM pdf_lines WHERE page IS NOT NULL), g AS (SELECT *, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM p)
SELECT doc_id, min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages FROM g GROUP BY doc_id, g""")
def w10_page_runs(spark, sf_dir):
    return L.page_runs(table(spark, sf_dir, "pdf_lines"), ["doc_id"])


@query(f"""SELECT doc_id, group_id, page, CASE WHEN page = lo THEN 'start' WHEN page = hi THEN 'end' ELSE 'middle' END AS role
FROM (SELECT doc_id, group_id, lo, hi, unnest(generate_series(lo, hi)) AS page FROM ({_SPANS}))""")
def w11_span_roles(spark, sf_dir):
    pages = spans(spark, sf_dir).withColumn("page", F.explode(F.sequence("lo", "hi")))
    role = F.when(F.col("page") == F.col("lo"), "start").when(F.col("page") == F.col("hi"), "end").otherwise("middle")
    return pages.select("doc_id", "group_id", "page", role.alias("role"))


@query(f"""WITH s AS (SELECT doc_id, lo, max(hi) OVER (PARTITION BY doc_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ({_SPANS}))
SELECT DISTINCT doc_id, r + 1 AS gap_lo, lo - 1 AS gap_hi FROM s WHERE lo > r + 1""")
def w13_gaps(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("lo", "hi").rowsBetween(*L.BEFORE)
    reach = spans(spark, sf_dir).withColumn("r", F.max("hi").over(w))
    return reach.where("lo > r + 1").select("doc_id", (F.col("r") + 1).alias("gap_lo"), (F.col("lo") - 1).alias("gap_hi")).distinct()


_STARTS = r"^(#{1,6} |<!--|!\\[|---|\\||- |\\* |> |[0-9]{1,3}[.)] |• |▪ |[a-z]\\) )"


@query(f"""WITH l AS ({_LINES}), f AS (SELECT *, sum(CASE WHEN starts_with(trim(line), '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS f, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS p FROM l),
i AS (SELECT *, (f % 2 = 1 OR starts_with(trim(line), '```')) AS inn, trim(line) = '' AS blank FROM f),
s AS (SELECT *, coalesce(inn OR blank OR regexp_matches(trim(line), '{_STARTS.replace(chr(92) * 2, chr(92))}') OR p IS NULL OR trim(p) = '' OR lag(inn) OVER (PARTITION BY doc_id ORDER BY line_no), true) AS st FROM i),
b AS (SELECT *, sum(CASE WHEN st THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS block_no FROM s)
SELECT doc_id, block_no, string_agg(CASE WHEN inn THEN line ELSE trim(line) END, ' ' ORDER BY line_no) AS text FROM b WHERE inn OR NOT blank GROUP BY ALL""")
def w14_join_wrapped(spark, sf_dir):
    starter = F.trim("line").rlike(_STARTS.replace("\\\\", "\\"))
    return L.join_wrapped(doc_lines(spark, sf_dir), ["doc_id"], starter)


@query(f"""WITH l AS ({_LINES}), n AS (SELECT *, CASE WHEN trim(line) <> '' THEN regexp_matches(trim(line), '^([-*•▪–] |[0-9]+[.)] )') END AS item FROM l),
a AS (SELECT *, last_value(item IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b4, first_value(item IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS af FROM n)
SELECT doc_id, count(*) AS kept FROM a WHERE NOT (trim(line) = '' AND coalesce(b4, false) AND coalesce(af, false)) GROUP BY doc_id""")
def w15_list_blanks(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no")
    item = F.when(F.trim("line") != "", F.trim("line").rlike(r"^([-*•▪–] |[0-9]+[.)] )"))
    rows = doc_lines(spark, sf_dir).withColumn("item", item).withColumns(
        {"b4": F.last("item", True).over(w.rowsBetween(*L.BEFORE)), "af": F.first("item", True).over(w.rowsBetween(*L.AFTER))}
    )
    between = (F.trim("line") == "") & F.coalesce("b4", F.lit(False)) & F.coalesce("af", F.lit(False))
    return rows.where(~between).groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"))


@query(f"""WITH l AS ({_LINES}), t AS (SELECT *, trim(line) AS r FROM l WHERE starts_with(trim(line), '|')), h AS (SELECT *, first_value(r) OVER (PARTITION BY doc_id ORDER BY line_no) AS h, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k FROM t)
SELECT doc_id, string_agg(r, chr(10) ORDER BY line_no) AS table_text FROM h WHERE (k = 1 OR r <> h) AND NOT regexp_matches(r, '^[| ]*$') GROUP BY doc_id""")
def w16_table_merge(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no")
    rows = doc_lines(spark, sf_dir).withColumn("r", F.trim("line")).where(F.col("r").startswith("|"))
    kept = rows.withColumns({"h": F.first("r").over(w), "k": F.row_number().over(w)}).where("(k = 1 or r <> h)").where(~F.col("r").rlike("^[| ]*$"))
    return L.rebuilt(kept, ["doc_id"], "r", out="table_text")


@query(f"""WITH l AS ({_LINES}), k AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(trim(regexp_replace(line, '[ \\t]+', ' ', 'g'))) ORDER BY line_no) AS k FROM l WHERE trim(line) <> '')
SELECT doc_id, line_no, line FROM k WHERE k = 1""")
def w17_first_rows(spark, sf_dir):
    key = F.lower(F.trim(F.regexp_replace("line", r"[ \t]+", " ")))
    rows = doc_lines(spark, sf_dir).where(F.trim("line") != "").withColumn("key", key)
    w = Window.partitionBy("doc_id", "key").orderBy("line_no")
    return rows.withColumn("k", F.row_number().over(w)).where("k = 1").select("doc_id", "line_no", "line")


@query(f"""WITH r AS ({_ROWS}), n AS (SELECT *, lead(page) OVER (PARTITION BY doc_id ORDER BY page, line_no, line_id) AS np FROM r WHERE trim(text) <> '')
SELECT doc_id, line_id, page, CASE WHEN np > page AND regexp_matches(trim(text), '^[A-Z][A-Z ]+$') THEN np ELSE page END AS moved_to FROM n""")
def w18_section_moves(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("page", "line_no", "line_id")
    rows = layout(spark, sf_dir).where(F.trim("text") != "").withColumn("np", F.lead("page").over(w))
    moved = F.when((F.col("np") > F.col("page")) & F.trim("text").rlike("^[A-Z][A-Z ]+$"), F.col("np")).otherwise(F.col("page"))
    return rows.select("doc_id", "line_id", "page", moved.alias("moved_to"))


@query(f"""WITH l AS ({_LINES}), p AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS p FROM l)
SELECT doc_id, count(*) + sum(CASE WHEN starts_with(line, '#') AND p IS NOT NULL AND trim(p) <> '' THEN 1 ELSE 0 END)::BIGINT AS n_lines FROM p GROUP BY doc_id""")
def w20_heading_spacing(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no")
    rows = doc_lines(spark, sf_dir).withColumn("p", F.lag("line").over(w))
    tight = F.col("line").startswith("#") & F.col("p").isNotNull() & (F.trim("p") != "")
    spaced = rows.select("doc_id", F.explode(F.when(tight, F.array(F.lit(""), F.col("line"))).otherwise(F.array("line"))).alias("line"))
    return spaced.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query(f"""WITH l AS ({_LINES}), m AS (SELECT *, CASE WHEN starts_with(line, '#') THEN line_no END AS h FROM l), s AS (SELECT *, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS seg FROM m),
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, seg, trim(line) ORDER BY line_no) AS k FROM s)
SELECT doc_id, count(*) AS kept FROM f WHERE trim(line) = '' OR k = 1 OR length(trim(line)) > 40 GROUP BY doc_id""")
def w22_soup_runs(spark, sf_dir):
    rows = doc_lines(spark, sf_dir)
    seg = F.last(F.when(F.col("line").startswith("#"), F.col("line_no")), True).over(Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(*L.SO_FAR))
    marked = rows.withColumn("seg", seg).withColumn("t", F.trim("line"))
    k = F.row_number().over(Window.partitionBy("doc_id", "seg", "t").orderBy("line_no"))
    return marked.withColumn("k", k).where("t = '' or k = 1 or length(t) > 40").groupBy("doc_id").agg(F.count(F.lit(1)).alias("kept"))


@query("""WITH p AS (SELECT DISTINCT doc_id, page FROM pdf_lines WHERE page IS NOT NULL AND regexp_matches(text, '[A-C][12]')), g AS (SELECT *, page - row_number() OVER (PARTITION BY doc_id ORDER BY page) AS g FROM p)
SELECT doc_id, min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages FROM g GROUP BY doc_id, g""")
def w23_hit_ranges(spark, sf_dir):
    return L.page_runs(table(spark, sf_dir, "pdf_lines").where(F.col("text").rlike("[A-C][12]")), ["doc_id"])


@query(f"""WITH l AS ({_LINES}) SELECT doc_id, line_no, count(*) OVER w AS rows_in, sum(length(line)) OVER w AS chars_in FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN 30 PRECEDING AND 60 FOLLOWING)""")
def w24_context(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(-30, 60)
    return doc_lines(spark, sf_dir).select("doc_id", "line_no", F.count(F.lit(1)).over(w).alias("rows_in"), F.sum(F.length("line")).over(w).alias("chars_in"))


@query(f"""WITH f AS (SELECT doc_id, group_id, min(lo) AS first_page FROM ({_SPANS}) GROUP BY ALL), o AS (SELECT doc_id, string_agg(group_id, ',' ORDER BY first_page, group_id) AS seen, string_agg(group_id, ',' ORDER BY group_id) AS named FROM f GROUP BY doc_id)
SELECT doc_id, seen, seen = named AS in_order FROM o""")
def w25_emission_order(spark, sf_dir):
    first = spans(spark, sf_dir).groupBy("doc_id", "group_id").agg(F.min("lo").alias("p"))
    seen = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p", "group_id"))), lambda x: x["group_id"]), ",")
    named = F.array_join(F.array_sort(F.collect_list("group_id")), ",")
    return first.groupBy("doc_id").agg(seen.alias("seen"), (seen == named).alias("in_order"))


@query(f"""WITH l AS ({_LINES}), m AS (SELECT *, CASE WHEN starts_with(line, '#') THEN trim(line) END AS h FROM l)
SELECT doc_id, line_no, last_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS heading FROM m""")
def j05_as_of_backward(spark, sf_dir):
    h = F.when(F.col("line").startswith("#"), F.trim("line"))
    return L.page_of_line(doc_lines(spark, sf_dir), ["doc_id"], h, after=True).select("doc_id", "line_no", F.col("page").alias("heading"))


@query(f"""WITH l AS ({_LINES}), m AS (SELECT *, CASE WHEN starts_with(line, '#') THEN trim(line) END AS h FROM l)
SELECT doc_id, line_no, first_value(h IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heading FROM m""")
def j06_as_of_forward(spark, sf_dir):
    h = F.when(F.col("line").startswith("#"), F.trim("line"))
    return L.page_of_line(doc_lines(spark, sf_dir), ["doc_id"], h).select("doc_id", "line_no", F.col("page").alias("heading"))


@query(f"""WITH l AS ({_LINES}), f AS (SELECT *, sum(CASE WHEN starts_with(trim(line), '```') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS f FROM l)
SELECT doc_id, count(*) FILTER (WHERE f % 2 = 1 OR starts_with(trim(line), '```')) AS fenced, count(*) AS n FROM f GROUP BY doc_id""")
def c22_fences(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(*L.SO_FAR)
    mark = F.trim("line").startswith("```")
    rows = doc_lines(spark, sf_dir).withColumn("f", F.sum(mark.cast("int")).over(w))
    return rows.groupBy("doc_id").agg(F.count_if((F.col("f") % 2 == 1) | mark).alias("fenced"), F.count(F.lit(1)).alias("n"))


@query(f"""WITH RECURSIVE j AS (SELECT id AS doc, max(source.expected_page_count) AS pages FROM jobs GROUP BY id),
s AS (SELECT doc_id AS doc, list_sort(list(DISTINCT {{'lo': lo, 'hi': hi}})) AS spans FROM ({_SPANS}) WHERE span_type IN ('continuation', 'section_block') OR (span_type = 'series' AND hi - lo + 1 >= 10) GROUP BY doc_id),
c AS (SELECT j.doc, j.pages, s.spans, 0 AS chunk_no, 0 AS lo, 0 AS hi FROM j LEFT JOIN s ON j.doc = s.doc WHERE j.pages IS NOT NULL UNION ALL
  SELECT doc, pages, spans, chunk_no + 1, hi + 1, least(coalesce(list_filter(spans, lambda x: x.lo <= least(hi + 25, pages) AND least(hi + 25, pages) < x.hi)[1].hi, least(hi + 25, pages)), pages) FROM c WHERE hi < pages)
SELECT doc, chunk_no, lo, hi FROM c WHERE chunk_no > 0""")
def g06_chunk_ranges(spark, sf_dir):
    jobs = table(spark, sf_dir, "jobs").select(F.col("id").alias("doc"), F.col("source.expected_page_count").alias("pages")).groupBy("doc").agg(F.max("pages").alias("pages"))
    safe = spans(spark, sf_dir).where("span_type in ('continuation', 'section_block') or (span_type = 'series' and hi - lo + 1 >= 10)")
    return L.span_safe_ranges(jobs, safe.withColumnRenamed("doc_id", "doc"))


@query("SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM (" + _LINES + ") GROUP BY doc_id")
def k02_rebuild(spark, sf_dir):
    return L.rebuilt(doc_lines(spark, sf_dir), ["doc_id"])
