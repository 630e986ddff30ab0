"""Queries of joins, aggregations, sorts and set operations over whole tables, with oracle SQL."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import repairs as R
from ..functions import text as X
from ..operators import lines as L
from ..operators.intervals import coalesce_intervals, points_in_intervals
from ..session import table
from .windows import _SPANS, spans

QUERIES: dict = {}
SQL: dict = {}


def query(sql=None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def pages(spark, sf_dir):
    return table(spark, sf_dir, "pdf_lines").where("page is not null").select("doc_id", "page").distinct()


_PAGES = "SELECT DISTINCT doc_id, page FROM pdf_lines WHERE page IS NOT NULL"
_JOBS = "SELECT id, max(publisher) AS publisher, max(source.expected_page_count) AS pages, max(title) AS title, max(profile) AS profile FROM jobs GROUP BY id"


def jobs(spark, sf_dir):
    return table(spark, sf_dir, "jobs").groupBy("id").agg(
        F.max("publisher").alias("publisher"), F.max("source.expected_page_count").alias("pages"), F.max("title").alias("title"), F.max("profile").alias("profile")
    )


def boxes(spark, sf_dir):
    rows = table(spark, sf_dir, "page_toks").where("y0 is not null and x0 is not null")
    return rows.groupBy("doc_id", "page").agg(F.min("y0").alias("ty0"), F.max("y0").alias("ty1"))


_BOXES = "SELECT doc_id, page, min(y0) AS ty0, max(y0) AS ty1 FROM page_toks WHERE y0 IS NOT NULL AND x0 IS NOT NULL GROUP BY ALL"


@query(f"""WITH r AS (SELECT doc_id, lo AS page, group_id, title, row_number() OVER (PARTITION BY doc_id, lo ORDER BY group_id DESC, title DESC NULLS LAST) AS k FROM ({_SPANS}))
SELECT p.doc_id, p.page, r.group_id, r.title FROM ({_PAGES}) p LEFT JOIN r ON p.doc_id = r.doc_id AND p.page = r.page AND r.k = 1""")
def j01_registry_lookup(spark, sf_dir):
    w = Window.partitionBy("doc_id", "page").orderBy(F.desc("group_id"), F.desc("title"))
    last = spans(spark, sf_dir).withColumn("page", F.col("lo")).withColumn("k", F.row_number().over(w)).where("k = 1")
    return pages(spark, sf_dir).join(last.select("doc_id", "page", "group_id", "title"), ["doc_id", "page"], "left")


@query(f"""SELECT doc_id, page, group_id FROM (SELECT p.doc_id, p.page, s.group_id, row_number() OVER (PARTITION BY p.doc_id, p.page ORDER BY s.hi - s.lo DESC, s.group_id, s.lo) AS k
FROM ({_PAGES}) p JOIN ({_SPANS}) s ON p.doc_id = s.doc_id AND p.page BETWEEN s.lo AND s.hi) WHERE k = 1""")
def j02_page_span(spark, sf_dir):
    return L.longest_cover(pages(spark, sf_dir), spans(spark, sf_dir), ["doc_id"], "page", "lo", "hi", ["group_id", "lo"]).select("doc_id", "page", "group_id")


@query(f"SELECT DISTINCT l.line_id FROM pdf_lines l JOIN ({_BOXES}) b ON l.doc_id = b.doc_id AND l.page = b.page AND l.y0 BETWEEN b.ty0 AND b.ty1")
def j03_line_in_rect(spark, sf_dir):
    lines = table(spark, sf_dir, "pdf_lines").select("line_id", "doc_id", "page", "y0")
    return lines.join(boxes(spark, sf_dir), ["doc_id", "page"]).where("y0 between ty0 and ty1").select("line_id").distinct()


@query(f"""WITH s AS ({_SPANS}) SELECT a.doc_id, a.group_id, a.lo, a.hi, EXISTS (SELECT 1 FROM s b WHERE a.doc_id = b.doc_id AND a.group_id <> b.group_id AND a.lo <= b.hi AND b.lo <= a.hi) AS overlaps FROM s a""")
def j04_overlaps(spark, sf_dir):
    return L.overlapping_pairs(spans(spark, sf_dir), ["doc_id"], "group_id")


@query(f"""SELECT j.id, count(p.page) AS missing FROM (SELECT id, unnest(generate_series(1, pages)) AS page FROM ({_JOBS}) WHERE pages IS NOT NULL) p
JOIN ({_JOBS}) j USING (id) ANTI JOIN ({_PAGES}) f ON p.id = f.doc_id AND p.page = f.page GROUP BY j.id""")
def j07_missing_pages(spark, sf_dir):
    expected = jobs(spark, sf_dir).where("pages is not null").select("id", F.explode(F.sequence(F.lit(1), "pages")).alias("page"))
    found = pages(spark, sf_dir).withColumnRenamed("doc_id", "id")
    return expected.join(found, ["id", "page"], "left_anti").groupBy("id").agg(F.count("page").alias("missing"))


@query(f"SELECT id, publisher FROM ({_JOBS}) j WHERE EXISTS (SELECT 1 FROM chunks c WHERE c.doc_id = j.id)")
def j08_jobs_with_chunks(spark, sf_dir):
    return jobs(spark, sf_dir).join(table(spark, sf_dir, "chunks").select(F.col("doc_id").alias("id")), "id", "left_semi").select("id", "publisher")


_SKEL = r"trim(lower(regexp_replace(regexp_replace(regexp_replace({c}, '[‘’]', '''', 'g'), '[ˈˎˋˏˊˇ·ˌ''`´,.\x22|$]+', '', 'g'), '[^A-Za-z0-9]+', ' ', 'g')))"


@query(f"""WITH g AS (SELECT {_SKEL.format(c='term')} AS key, min(term) AS gold FROM glossary WHERE term IS NOT NULL GROUP BY 1)
SELECT t.line_id, coalesce(CASE WHEN t.text NOT IN (SELECT term FROM glossary WHERE term IS NOT NULL) THEN g.gold END, t.text) AS text FROM (SELECT DISTINCT line_id, text FROM pdf_lines WHERE text IS NOT NULL) t LEFT JOIN g ON {_SKEL.format(c='t.text')} = g.key""")
def j09_skeleton_patch(spark, sf_dir):
    terms = table(spark, sf_dir, "glossary").where("term is not null")
    gold = terms.groupBy(X.skeleton(F.col("term")).alias("key")).agg(F.min("term").alias("gold"))
    lines = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "text").distinct()
    safe = terms.select(F.col("term").alias("text")).distinct().withColumn("safe", F.lit(True))
    met = lines.join(gold, X.skeleton(F.col("text")) == F.col("key"), "left").join(safe, "text", "left")
    return met.select("line_id", F.coalesce(F.when(F.col("safe").isNull(), F.col("gold")), F.col("text")).alias("text"))


@query("""WITH w AS (SELECT DISTINCT line_id, text, regexp_extract_all(lower(text), '[\\p{L}]+', 0) AS ws FROM pdf_lines WHERE text IS NOT NULL),
p AS (SELECT line_id, ws, unnest(generate_series(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 2),
n AS (SELECT line_id, k, array_to_string(ws[i:i + k - 1], ' ') AS gram FROM (SELECT *, unnest([2, 3, 4]) AS k FROM p) WHERE i + k - 1 <= len(ws)),
m AS (SELECT DISTINCT line_id, term, k FROM n JOIN glossary ON gram = lower(term)),
r AS (SELECT *, row_number() OVER (PARTITION BY line_id ORDER BY k DESC, term) AS q FROM m) SELECT line_id, term FROM r WHERE q = 1""")
def j10_longest_contained_term(spark, sf_dir):
    lines = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "text").distinct()
    ws = lines.select("line_id", F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0)).alias("ws")).where("size(ws) >= 2")
    gram = F.flatten(F.transform(F.array(*[F.lit(k) for k in (2, 3, 4)]), lambda k: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("ws") - k + 1, F.lit(0)) + F.lit(0), F.when(F.size("ws") - k + 1 >= 1, F.lit(1)).otherwise(F.lit(-1))),
        lambda i: F.when((i >= 1) & (i + k - 1 <= F.size("ws")), F.struct(k.alias("k"), F.array_join(F.slice("ws", F.greatest(i, F.lit(1)), k), " ").alias("g"))))))
    met = ws.select("line_id", F.explode(F.array_distinct(gram)).alias("x")).where("x is not null").join(
        table(spark, sf_dir, "glossary").select("term", F.lower("term").alias("g")), F.col("x.g") == F.col("g")
    )
    w = Window.partitionBy("line_id").orderBy(F.desc("x.k"), "term")
    return met.withColumn("q", F.row_number().over(w)).where("q = 1").select("line_id", "term")


@query(f"""WITH s AS (SELECT *, lead(lower(trim(title))) OVER w AS nt, lead(lo) OVER w AS nl FROM ({_SPANS}) WINDOW w AS (PARTITION BY doc_id ORDER BY lo, hi, group_id))
SELECT doc_id, group_id FROM s WHERE lower(trim(title)) = nt AND nl <= hi + 1""")
def j11_same_title_next(spark, sf_dir):
    w = Window.partitionBy("doc_id").orderBy("lo", "hi", "group_id")
    s = spans(spark, sf_dir).withColumns({"t": F.lower(F.trim("title")), "nl": F.lead("lo").over(w)}).withColumn("nt", F.lead("t").over(w))
    return s.where("t = nt and nl <= hi + 1").select("doc_id", "group_id")


@query("""SELECT id, received_at, coalesce(extraction.chunk_size, 25) AS chunk_size, coalesce(output."mode", CASE WHEN profile = 'page_png' THEN 'page_png' ELSE 'markdown' END) AS output_mode FROM jobs""")
def j12_profile_override(spark, sf_dir):
    profile = F.when(F.col("profile") == "page_png", "page_png").otherwise("markdown")
    return table(spark, sf_dir, "jobs").select(
        "id", "received_at", F.coalesce("extraction.chunk_size", F.lit(25)).alias("chunk_size"), F.coalesce("output.mode", profile).alias("output_mode")
    )


@query("""WITH m AS (SELECT job_id, snapshot_no, id, max(page) AS page FROM manifest_entries WHERE job_id IS NOT NULL AND snapshot_no IS NOT NULL AND id IS NOT NULL GROUP BY ALL),
p AS (SELECT job_id, snapshot_no, lead(snapshot_no) OVER (PARTITION BY job_id ORDER BY snapshot_no) AS next_no FROM (SELECT DISTINCT job_id, snapshot_no FROM manifest_entries WHERE job_id IS NOT NULL AND snapshot_no IS NOT NULL)),
a AS (SELECT m.job_id, p.next_no AS snapshot_no, m.id, m.page FROM m JOIN p USING (job_id, snapshot_no) WHERE p.next_no IS NOT NULL),
b AS (SELECT m.* FROM m JOIN p ON m.job_id = p.job_id AND m.snapshot_no = p.next_no)
SELECT coalesce(a.job_id, b.job_id) AS job_id, coalesce(a.snapshot_no, b.snapshot_no) AS snapshot_no, coalesce(a.id, b.id) AS id,
  CASE WHEN b.id IS NULL THEN 'only_old' WHEN a.id IS NULL THEN 'only_new' WHEN a.page IS DISTINCT FROM b.page THEN 'changed' ELSE 'same' END AS state
FROM a FULL OUTER JOIN b ON a.job_id = b.job_id AND a.snapshot_no = b.snapshot_no AND a.id = b.id""")
def j13_build_diff(spark, sf_dir):
    """Every delivered snapshot against the job's next delivered one, whose number is snapshot_no."""
    rows = table(spark, sf_dir, "manifest_entries").where("job_id is not null and snapshot_no is not null")
    next_no = F.lead("snapshot_no").over(Window.partitionBy("job_id").orderBy("snapshot_no"))
    pairs = rows.select("job_id", "snapshot_no").distinct().withColumn("next_no", next_no).where("next_no is not null")
    pages = rows.where("id is not null").groupBy("job_id", "snapshot_no", "id").agg(F.max("page").alias("page"))
    old = pages.join(pairs, ["job_id", "snapshot_no"]).select("job_id", F.col("next_no").alias("snapshot_no"), "id", "page")
    new = pages.join(pairs.select("job_id", F.col("next_no").alias("snapshot_no")), ["job_id", "snapshot_no"])
    return L.reduced_diff(old, new, ["job_id", "snapshot_no", "id"], ["page"])


@query("""SELECT DISTINCT t.tok_id FROM page_toks t WHERE t.y0 IS NOT NULL AND t.doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM pdf_lines l WHERE l.doc_id = t.doc_id AND l.page = t.page AND l.y0 IS NOT NULL AND l.y1 IS NOT NULL AND least(l.y1, t.y0 + 10) - greatest(l.y0, t.y0) > 4)""")
def j14_orphan_boxes(spark, sf_dir):
    toks = table(spark, sf_dir, "page_toks").where("y0 is not null and doc_id is not null").select("tok_id", "doc_id", "page", F.col("y0").alias("ty")).distinct()
    lines = table(spark, sf_dir, "pdf_lines").where("y0 is not null and y1 is not null").select("doc_id", "page", "y0", "y1").distinct()
    # Both sides meet by the bands of 20 points that they reach, so a token only sees the lines at its height.
    bands = lambda lo, hi: F.explode(F.sequence(F.floor(lo / 20), F.floor(F.greatest(lo, hi) / 20))).alias("band")
    placed = toks.select("tok_id", "doc_id", "page", "ty", bands(F.col("ty"), F.col("ty") + 10))
    tall = lines.where("y1 > y0").select("doc_id", "page", "y0", "y1", bands(F.col("y0"), F.col("y1")))
    met = placed.join(tall, ["doc_id", "page", "band"]).where(F.least("y1", F.col("ty") + 10) - F.greatest("y0", "ty") > 4)
    return toks.join(met.select("tok_id").distinct(), "tok_id", "left_anti").select("tok_id").distinct()


@query(f"""SELECT p.doc_id, p.page, string_agg(s.group_id, ',' ORDER BY s.lo, s.group_id) AS groups, count(*) AS n FROM ({_PAGES}) p JOIN ({_SPANS}) s ON p.doc_id = s.doc_id AND p.page BETWEEN s.lo AND s.hi GROUP BY ALL""")
def j15_groups_on_page(spark, sf_dir):
    met = points_in_intervals(pages(spark, sf_dir), spans(spark, sf_dir), ["doc_id"], "page", "lo", "hi")
    names = F.transform(F.array_sort(F.collect_list(F.struct("lo", "group_id"))), lambda x: x["group_id"])
    return met.groupBy("doc_id", "page").agg(F.array_join(names, ",").alias("groups"), F.count(F.lit(1)).alias("n"))


# Aggregations


@query("SELECT doc_id, page, floor(0.85 * sum(length(text)))::BIGINT AS expected FROM (SELECT DISTINCT line_id, doc_id, page, text FROM pdf_lines WHERE text IS NOT NULL) GROUP BY ALL")
def g05_expected_chars(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "doc_id", "page", "text").distinct()
    return rows.groupBy("doc_id", "page").agg(F.floor(F.sum(F.length("text")) * F.lit(0.85)).alias("expected"))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY GROUPING SETS ((lang), (source))")
def g07_counters(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.groupingSets([[docs.lang], [docs.source]], docs.lang, docs.source).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, group_id, count(*) AS n FROM span_groups GROUP BY ALL HAVING count(*) > 1")
def g08_duplicate_ids(spark, sf_dir):
    return table(spark, sf_dir, "span_groups").groupBy("doc_id", "group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""SELECT doc_id, CASE WHEN len(t) = 0 THEN 1.0 ELSE round(len(list_filter(t, lambda w: list_contains(b, w)))::DOUBLE / len(t), 6) END AS overlap FROM
(SELECT doc_id, list_distinct(regexp_extract_all(lower(title), '[a-z]{4,}')) AS t, list_distinct(regexp_extract_all(lower(text), '[a-z]{4,}')) AS b FROM documents WHERE title IS NOT NULL AND text IS NOT NULL)""")
def g09_vocabulary_overlap(spark, sf_dir):
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z]{4,}"), F.lit(0)))
    rows = table(spark, sf_dir, "documents").where("title is not null and text is not null").select("doc_id", words("title").alias("t"), words("text").alias("b"))
    share = F.when(F.size("t") == 0, F.lit(1.0)).otherwise(F.round(F.size(F.array_intersect("t", "b")) / F.size("t"), 6))
    return rows.select("doc_id", share.alias("overlap"))


@query("SELECT coalesce(lang, '') AS lang, count(*) AS total, count_if(text IS NOT NULL AND trim(text, chr(32) || chr(10)) <> '') AS passed, count_if(text IS NULL OR trim(text, chr(32) || chr(10)) = '') AS failed FROM documents GROUP BY 1")
def g10_summary(spark, sf_dir):
    full = F.col("text").isNotNull() & (F.btrim("text", F.lit(" \n")) != "")
    rows = table(spark, sf_dir, "documents").withColumn("lang", F.coalesce("lang", F.lit("")))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total"), F.count_if(full).alias("passed"), F.count_if(~full).alias("failed"))


@query("SELECT count(*) AS n_lines, count(DISTINCT line_id) AS unique_lines, count(DISTINCT doc_id) AS docs, sum(length(text)) AS chars, count_if(text = '') AS blank FROM pdf_lines")
def g11_rollup(spark, sf_dir):
    return table(spark, sf_dir, "pdf_lines").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("line_id").alias("unique_lines"), F.count_distinct("doc_id").alias("docs"),
        F.sum(F.length("text")).alias("chars"), F.count_if(F.col("text") == "").alias("blank"),
    )


@query("SELECT doc_id, list_sort(list(s))[(len(list(s)) // 2 + 1)::INT] AS body_size FROM (SELECT doc_id, spans[1].size AS s FROM pdf_lines WHERE spans[1].size IS NOT NULL) GROUP BY doc_id")
def g12_body_size(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").select("doc_id", F.get("spans", F.lit(0))["size"].alias("s")).where("s is not null")
    counts = rows.groupBy("doc_id", "s").agg(F.count(F.lit(1)).alias("n"))  # per size, so that a long document stays small
    w = Window.partitionBy("doc_id").orderBy("s")
    ranked = counts.withColumns({"upto": F.sum("n").over(w), "all": F.sum("n").over(Window.partitionBy("doc_id"))})
    return ranked.where("upto > floor(all / 2)").groupBy("doc_id").agg(F.min("s").alias("body_size"))


@query(f"""WITH k AS (SELECT DISTINCT line_id, doc_id, page, line_no, text, {_SKEL.format(c='text')} AS key FROM pdf_lines WHERE text IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page, key ORDER BY line_no, line_id) AS q FROM k WHERE length(key) >= 4) SELECT line_id, key FROM r WHERE q = 1""")
def g13_distinct_by_skeleton(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").where("text is not null").select("line_id", "doc_id", "page", "line_no", "text").distinct()
    keyed = rows.withColumn("key", X.skeleton(F.col("text"))).where("length(key) >= 4")
    w = Window.partitionBy("doc_id", "page", "key").orderBy("line_no", "line_id")
    return keyed.withColumn("q", F.row_number().over(w)).where("q = 1").select("line_id", "key")


@query("SELECT doc_id, page, sum(len(regexp_extract_all(text, '[A-CL][12]\\+?')))::BIGINT AS marks FROM pdf_lines GROUP BY ALL")
def g14_marks_per_page(spark, sf_dir):
    return table(spark, sf_dir, "pdf_lines").groupBy("doc_id", "page").agg(F.sum(F.regexp_count("text", F.lit(r"[A-CL][12]\+?"))).alias("marks"))


_KNOWN = "[" + ",".join(f"'{w}'" for w in sorted(R.TITLE_WORDS)) + "]"
_ODD = "[" + ",".join(f"'{w}'" for w in sorted(R.TOKEN_REPAIRS)) + "]"
_TSCORE = (
    "CASE WHEN {{c}} IS NULL THEN NULL WHEN len(regexp_extract_all(lower({{c}}), '[a-z]{{{{3,}}}}')) = 0 THEN 0.0 ELSE list_sum(list_transform(regexp_extract_all(lower({{c}}), '[a-z]{{{{3,}}}}'), "
    "lambda w: CASE WHEN list_contains({k}, w) THEN 1.0::DOUBLE WHEN list_contains({k}, reverse(w)) OR list_contains({o}, w) THEN -0.35::DOUBLE ELSE 0.0::DOUBLE END)) / len(regexp_extract_all(lower({{c}}), '[a-z]{{{{3,}}}}')) END"
).format(k=_KNOWN, o=_ODD)


@query(f"SELECT job_id, id, title, round({_TSCORE.format(c='title')}, 6) AS score FROM manifest_entries")
def g02_title_score(spark, sf_dir):
    return table(spark, sf_dir, "manifest_entries").select("job_id", "id", "title", F.round(R.title_score(F.col("title")), 6).alias("score"))


@query(f"""WITH p AS (SELECT s.doc_id, s.group_id, trim(s.title, ' ') AS h, trim(regexp_replace(j.title, '[ \t\n\r\f]+', ' ', 'g'), ' ') AS t FROM (SELECT doc_id, group_id, max(title) AS title FROM ({_SPANS}) GROUP BY ALL) s LEFT JOIN ({_JOBS}) j ON s.doc_id = j.id),
q AS (SELECT *, {_TSCORE.format(c='h')} AS hs, {_TSCORE.format(c='t')} AS ts FROM p)
SELECT doc_id, group_id, CASE WHEN coalesce(t, '') = '' THEN h WHEN regexp_matches(t, '^(?i:pre-)?[A-Ca-c][12]\\+?$') THEN h WHEN coalesce(h, '') = '' THEN t WHEN ts > hs + 0.02 THEN t WHEN hs > ts + 0.02 THEN h WHEN length(t) > length(h) + 5 THEN t ELSE h END AS title FROM q""")
def g15_preferred_title(spark, sf_dir):
    own = spans(spark, sf_dir).groupBy("doc_id", "group_id").agg(F.max("title").alias("t"))
    met = own.join(jobs(spark, sf_dir).select(F.col("id").alias("doc_id"), F.col("title").alias("jt")), "doc_id", "left")
    return met.select("doc_id", "group_id", R.preferred_title(F.col("t"), F.col("jt")).alias("title"))


@query("SELECT publisher, line_id, n FROM (SELECT publisher, line_id, length(text) AS n, row_number() OVER (PARTITION BY publisher ORDER BY length(text) DESC NULLS LAST, line_id) AS k FROM (SELECT DISTINCT publisher, line_id, text FROM pdf_lines)) WHERE k = 1")
def g16_argmax(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").select("publisher", "line_id", F.length("text").alias("n"))
    best = F.max(F.struct(F.coalesce("n", F.lit(-1)).alias("m"), (-F.col("line_id")).alias("i"), F.col("n").alias("n")))  # no sort, ties keep the first
    return rows.groupBy("publisher").agg(best.alias("b")).select("publisher", (-F.col("b.i")).alias("line_id"), "b.n")


@query("SELECT publisher, count(*) AS rows_n, count_if(coalesce(len(product.default_product_tiers), 0) = 0) AS without_tiers, count(*) < 50 AS sparse FROM jobs GROUP BY publisher")
def g18_registry_completeness(spark, sf_dir):
    bare = F.coalesce(F.size("product.default_product_tiers"), F.lit(0)) <= 0
    return table(spark, sf_dir, "jobs").groupBy("publisher").agg(
        F.count(F.lit(1)).alias("rows_n"), F.count_if(bare).alias("without_tiers"), (F.count(F.lit(1)) < 50).alias("sparse")
    )


# Sorts and top-k


@query("SELECT tok_id, row_number() OVER (PARTITION BY doc_id, page ORDER BY round(y0, 1), x0, tok_id) AS n FROM (SELECT DISTINCT tok_id, doc_id, page, y0, x0 FROM page_toks WHERE y0 IS NOT NULL AND x0 IS NOT NULL)")
def t01_reading_sort(spark, sf_dir):
    toks = table(spark, sf_dir, "page_toks").where("y0 is not null and x0 is not null").select("tok_id", "doc_id", "page", "y0", "x0").distinct()
    return toks.select("tok_id", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(F.round("y0", 1), "x0", "tok_id")).alias("n"))


@query(f"SELECT doc_id, string_agg(group_id, ',' ORDER BY lo, group_id) AS ids FROM ({_SPANS}) GROUP BY doc_id")
def t02_registry_sort(spark, sf_dir):
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("lo", "group_id"))), lambda x: x["group_id"])
    return spans(spark, sf_dir).groupBy("doc_id").agg(F.array_join(ordered, ",").alias("ids"))


@query("SELECT term_id, row_number() OVER (ORDER BY length(term) DESC, term_id) AS n FROM glossary")
def t03_longest_first(spark, sf_dir):
    ordered = F.array_sort(F.collect_list(F.struct((-F.length("term")).alias("l"), "term_id"))).alias("o")  # a fixed list of terms
    ranked = table(spark, sf_dir, "glossary").agg(ordered).select(F.posexplode("o").alias("p", "v"))
    return ranked.select("v.term_id", (F.col("p") + 1).alias("n"))


@query("SELECT doc_id, array_to_string(list_sort(list_distinct(list(page)))[1:12], ',') AS sample FROM pdf_lines WHERE page IS NOT NULL GROUP BY doc_id")
def t04_samples(spark, sf_dir):
    return pages(spark, sf_dir).groupBy("doc_id").agg(F.array_join(F.slice(F.sort_array(F.collect_set("page")), 1, 12), ",").alias("sample"))


@query("SELECT job_id, max(snapshot_no) + 1 AS next_no FROM manifest_entries GROUP BY job_id")
def t05_next_version(spark, sf_dir):
    return table(spark, sf_dir, "manifest_entries").groupBy("job_id").agg((F.max("snapshot_no") + 1).alias("next_no"))


# Set operations


@query(f"(SELECT doc_id, page, 'only_lines' AS side FROM ({_PAGES}) EXCEPT SELECT doc_id, page, 'only_lines' FROM page_toks) UNION ALL (SELECT DISTINCT doc_id, page, 'only_toks' FROM page_toks WHERE page IS NOT NULL EXCEPT SELECT doc_id, page, 'only_toks' FROM pdf_lines)")
def e01_symmetric_difference(spark, sf_dir):
    a, b = pages(spark, sf_dir), table(spark, sf_dir, "page_toks").where("page is not null").select("doc_id", "page")
    return a.subtract(b).withColumn("side", F.lit("only_lines")).unionByName(b.subtract(a).withColumn("side", F.lit("only_toks")))


@query(f"""WITH u AS (SELECT doc_id, lo AS page, 1 AS prio, group_id AS name FROM ({_SPANS}) UNION ALL SELECT job_id, page, 2, id FROM manifest_entries WHERE page IS NOT NULL AND id IS NOT NULL AND job_id IS NOT NULL UNION ALL SELECT doc_id, start_page, 3, chunk_id FROM chunks WHERE start_page IS NOT NULL)
SELECT doc_id, page, name, prio FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY prio, name) AS k FROM u) WHERE k = 1""")
def e02_priority_union(spark, sf_dir):
    parts = [
        spans(spark, sf_dir).select("doc_id", F.col("lo").alias("page"), F.lit(1).alias("prio"), F.col("group_id").alias("name")),
        table(spark, sf_dir, "manifest_entries").where("page is not null and id is not null and job_id is not null").select(F.col("job_id").alias("doc_id"), "page", F.lit(2).alias("prio"), F.col("id").alias("name")),
        table(spark, sf_dir, "chunks").where("start_page is not null").select("doc_id", F.col("start_page").alias("page"), F.lit(3).alias("prio"), F.col("chunk_id").alias("name")),
    ]
    first = F.min(F.struct("prio", "name")).alias("b")  # smallest priority, then name: aggregated before the shuffle
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("doc_id", "page").agg(first).select("doc_id", "page", "b.name", "b.prio")


@query("SELECT doc_id, len(list_intersect(list_distinct(regexp_extract_all(lower(title), '[a-z]{5,}')), list_distinct(regexp_extract_all(lower(text), '[a-z]{5,}')))) AS shared FROM documents WHERE title IS NOT NULL AND text IS NOT NULL")
def e03_shared_words(spark, sf_dir):
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit("[a-z]{5,}"), F.lit(0))
    return table(spark, sf_dir, "documents").where("title is not null and text is not null").select("doc_id", F.size(F.array_intersect(words("title"), words("text"))).alias("shared"))


@query(f"SELECT doc_id, group_id AS artifact, max(CASE WHEN span_type = 'section_block' THEN 400 ELSE 80 END) AS min_chars FROM ({_SPANS}) GROUP BY ALL UNION ALL SELECT doc_id, chunk_id, 80 FROM chunks GROUP BY ALL")
def e04_required_artifacts(spark, sf_dir):
    floor = F.max(F.when(F.col("span_type") == "section_block", 400).otherwise(80)).alias("min_chars")
    groups = spans(spark, sf_dir).groupBy("doc_id", F.col("group_id").alias("artifact")).agg(floor)
    return groups.unionByName(table(spark, sf_dir, "chunks").groupBy("doc_id", F.col("chunk_id").alias("artifact")).agg(F.lit(80).alias("min_chars")))


@query("SELECT id, received_at, array_to_string(list_distinct(list_filter(list_concat(coalesce(product.default_product_tiers, []), coalesce(product.audiences, [])), lambda x: x IS NOT NULL)).list_sort(), ',') AS tags FROM jobs")
def e05_ordered_union(spark, sf_dir):
    empty = F.array().cast("array<string>")
    both = F.array_distinct(F.concat(F.coalesce("product.default_product_tiers", empty), F.coalesce("product.audiences", empty)))
    return table(spark, sf_dir, "jobs").select("id", "received_at", F.array_join(F.array_sort(F.filter(both, lambda x: x.isNotNull())), ",").alias("tags"))


@query(f"""WITH s AS (SELECT doc_id, lo, hi, max(hi) OVER (PARTITION BY doc_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ({_SPANS})),
i AS (SELECT *, sum(CASE WHEN r IS NULL OR lo > r + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS i FROM s) SELECT doc_id, min(lo) AS lo, max(hi) AS hi, count(*) AS n FROM i GROUP BY doc_id, i""")
def w08_coverage(spark, sf_dir):
    return coalesce_intervals(spans(spark, sf_dir), ["doc_id"], "lo", "hi")
