"""Queries of assertions, dispatch and registries over whole tables, with oracle SQL."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import repairs as R
from ..functions import text as X
from ..operators import issues as I
from ..session import table
from .joins import _JOBS, _PAGES, jobs, pages
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


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def rows(spark, sf_dir):
    return table(spark, sf_dir, "pdf_lines").select("line_id", "doc_id", "page", "line_no", "y0", "x0", "text").distinct()


_ROWS = "SELECT DISTINCT line_id, doc_id, page, line_no, y0, x0, text FROM pdf_lines"
_GATES = " UNION ALL ".join(
    f"SELECT '{c}' AS \"check\", '{s}' AS severity, doc_id::VARCHAR AS doc_id, NULL::INT AS page, len(regexp_extract_all(text, '{p}'))::VARCHAR AS detail "
    f"FROM documents WHERE len(regexp_extract_all(text, '{p}')) > 0"
    for c, s, p in I.GATES
)
_CHARS = "length(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\f]+', '', 'g'))"


def chars(c="text"):
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), "[ \t\n\r\f]+", ""))


@query(_GATES)
def v08_text_gates(spark, sf_dir):
    return I.text_gates(docs(spark, sf_dir))


@query(f"SELECT \"check\", severity, count(*) AS n FROM ({_GATES}) GROUP BY GROUPING SETS ((\"check\"), (severity))")
def v11_regression_summary(spark, sf_dir):
    return I.summary(I.text_gates(docs(spark, sf_dir)))


@query(f"SELECT d.source, count(i.doc_id) AS hard, count(i.doc_id) = 0 AS passed FROM documents d LEFT JOIN (SELECT doc_id, severity FROM ({_GATES}) WHERE severity = 'hard') i ON d.doc_id::VARCHAR = i.doc_id GROUP BY d.source")
def v12_gate_by_source(spark, sf_dir):
    hard = I.text_gates(docs(spark, sf_dir)).where("severity = 'hard'").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    met = docs(spark, sf_dir).select("source", F.col("doc_id").cast("string").alias("doc_id")).join(hard, "doc_id", "left")
    n = F.coalesce(F.sum("n"), F.lit(0))
    return met.groupBy("source").agg(n.alias("hard"), (n == 0).alias("passed"))


@query(f"""SELECT t.doc_id, t.page, t.n AS expected, coalesce(l.n, 0) AS found, CASE WHEN coalesce(l.n, 0) < 0.4 * t.n THEN 'element_under_extracted' WHEN coalesce(l.n, 0) < 0.5 * t.n THEN 'missing_trailing_prose' ELSE 'ok' END AS state
FROM (SELECT doc_id, page, sum({_CHARS}) AS n FROM (SELECT DISTINCT tok_id, doc_id, page, text FROM page_toks) GROUP BY ALL) t LEFT JOIN (SELECT doc_id, page, sum({_CHARS}) AS n FROM ({_ROWS}) GROUP BY ALL) l ON t.doc_id = l.doc_id AND t.page = l.page""")
def v01_reading_coverage(spark, sf_dir):
    toks = table(spark, sf_dir, "page_toks").select("tok_id", "doc_id", "page", "text").distinct().groupBy("doc_id", "page").agg(F.sum(chars()).alias("expected"))
    lines = rows(spark, sf_dir).groupBy("doc_id", "page").agg(F.sum(chars()).alias("n"))
    met = toks.join(lines, ["doc_id", "page"], "left").withColumn("found", F.coalesce("n", F.lit(0))).drop("n")
    return I.classified(met, "state", {
        "element_under_extracted": F.col("found") < 0.4 * F.col("expected"), "missing_trailing_prose": F.col("found") < 0.5 * F.col("expected"),
    }, "ok")


@query(f"""SELECT doc_id, page, sum({_CHARS}) AS chars, CASE WHEN sum({_CHARS}) = 0 THEN 'empty_page_section' WHEN sum({_CHARS}) < 300 THEN 'page_under_extracted' ELSE 'ok' END AS state FROM ({_ROWS}) GROUP BY ALL""")
def v02_page_coverage(spark, sf_dir):
    made = rows(spark, sf_dir).groupBy("doc_id", "page").agg(F.sum(chars()).alias("chars"))
    return I.classified(made, "state", {"empty_page_section": F.col("chars") == 0, "page_under_extracted": F.col("chars") < 300}, "ok")


@query(f"""WITH s AS ({_SPANS}), d AS (SELECT doc_id, group_id, count(*) AS n FROM span_groups WHERE doc_id IS NOT NULL GROUP BY ALL)
SELECT 'span_duplicate' AS "check", 'hard' AS severity, doc_id, NULL::INT AS page, group_id AS detail FROM d WHERE n > 1
UNION ALL SELECT 'span_swapped', 'soft', doc_id, start_page, group_id FROM span_groups WHERE start_page > end_page AND doc_id IS NOT NULL
UNION ALL SELECT 'span_beyond_document', 'soft', s.doc_id, s.hi, s.group_id FROM s JOIN ({_JOBS}) j ON s.doc_id = j.id WHERE s.hi > j.pages""")
def v03_span_integrity(spark, sf_dir):
    raw = table(spark, sf_dir, "span_groups").where("doc_id is not null")
    again = raw.groupBy("doc_id", "group_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    beyond = spans(spark, sf_dir).join(jobs(spark, sf_dir).select(F.col("id").alias("doc_id"), "pages"), "doc_id").where("hi > pages")
    return I.united([
        I.issue(again, "span_duplicate", "hard", detail=F.col("group_id")),
        I.issue(raw.where("start_page > end_page"), "span_swapped", "soft", page=F.col("start_page"), detail=F.col("group_id")),
        I.issue(beyond, "span_beyond_document", "soft", page=F.col("hi"), detail=F.col("group_id")),
    ])


@query(f"SELECT doc_id, trim(text, ' ') AS note, count(*) AS n FROM ({_ROWS}) WHERE regexp_matches(trim(text, ' '), '^[0-9]{{1,3}}[.)] ') GROUP BY ALL HAVING count(*) > 1")
def v04_repeated_notes(spark, sf_dir):
    note = F.trim("text")
    return rows(spark, sf_dir).where(note.rlike(r"^[0-9]{1,3}[.)] ")).groupBy("doc_id", note.alias("note")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""SELECT doc_id, 'must_have' AS kind, title AS phrase FROM documents WHERE title IS NOT NULL AND NOT contains(coalesce(text, ''), title)
UNION ALL SELECT doc_id, 'must_not_have', 'https:// ' FROM documents WHERE title IS NOT NULL AND contains(text, 'https:// ')
UNION ALL SELECT doc_id, 'max_count', 'The working paper' FROM documents WHERE title IS NOT NULL AND (length(text) - length(replace(text, 'The working paper', ''))) / 17.0 > 2""")
def v06_golden(spark, sf_dir):
    specs = docs(spark, sf_dir).where("title is not null").select(
        "doc_id", F.array("title").alias("must_have"), F.array(F.lit("https:// ")).alias("must_not_have"),
        F.create_map(F.lit("The working paper"), F.lit(2)).alias("max_count"),
    )
    return I.golden(docs(spark, sf_dir), specs, ["doc_id"])


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '(?m)^#[^\n]*\n#')) AS heading_after_heading, len(regexp_extract_all(text, '(?m)^Page [0-9]+$')) AS page_footers, len(regexp_extract_all(text, '\n\n\n')) AS wide_gaps FROM documents WHERE text IS NOT NULL""")
def v07_adjacent(spark, sf_dir):
    n = lambda p: F.regexp_count("text", F.lit(p))
    return docs(spark, sf_dir).where("text is not null").select(
        "doc_id", n(r"(?m)^#[^\n]*\n#").alias("heading_after_heading"), n(r"(?m)^Page [0-9]+$").alias("page_footers"), n(r"\n\n\n").alias("wide_gaps")
    )


@query(f"""SELECT l.doc_id, l.page, round(t.n / l.n, 6) AS ratio, CASE WHEN t.n < 0.25 * l.n THEN 'hard' WHEN t.n < 200 AND l.n > 800 THEN 'soft' ELSE 'ok' END AS severity FROM
(SELECT doc_id, page, sum({_CHARS})::DOUBLE AS n FROM ({_ROWS}) GROUP BY ALL) l JOIN (SELECT doc_id, page, sum({_CHARS})::DOUBLE AS n FROM (SELECT DISTINCT tok_id, doc_id, page, text FROM page_toks) GROUP BY ALL) t ON t.doc_id = l.doc_id AND t.page = l.page WHERE l.n > 0""")
def v09_prose_mass(spark, sf_dir):
    mass = lambda df, c: df.groupBy("doc_id", "page").agg(F.sum(chars()).cast("double").alias(c))
    toks = mass(table(spark, sf_dir, "page_toks").select("tok_id", "doc_id", "page", "text").distinct(), "t")
    met = mass(rows(spark, sf_dir), "l").where("l > 0").join(toks, ["doc_id", "page"])
    made = I.classified(met, "severity", {"hard": F.expr("t < 0.25 * l"), "soft": F.expr("t < 200 and l > 800")}, "ok")
    return made.select("doc_id", "page", F.round(F.col("t") / F.col("l"), 6).alias("ratio"), "severity")


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '!\[[^\]]*\]\(assets/[^)]+\)')) AS assets, len(list_distinct(regexp_extract_all(text, '<!-- db:id=([^\s]+)', 1))) AS ids FROM documents WHERE text IS NOT NULL""")
def v10_chunk_validator(spark, sf_dir):
    return docs(spark, sf_dir).where("text is not null").select(
        "doc_id", F.regexp_count("text", F.lit(r"!\[[^\]]*\]\(assets/[^)]+\)")).alias("assets"), F.size(F.array_distinct(X.db_ids(F.col("text")))).alias("ids")
    )


_NEEDS = [("The working paper", 100, False), ("threshold", 10, False), ("lorem ipsum", 0, True), ("https:// ", 0, True)]


@query(" UNION ALL ".join(
    f"SELECT '{p}' AS phrase, sum((length(text) - length(replace(text, '{p}', ''))) // {len(p)})::BIGINT AS found, sum((length(text) - length(replace(text, '{p}', ''))) // {len(p)}) {'= 0' if b else f'>= {n}'} AS ok FROM documents" for p, n, b in _NEEDS))
def v13_need_ban(spark, sf_dir):
    rules = spark.createDataFrame(_NEEDS, "phrase string, least int, banned boolean")
    return I.need_ban(docs(spark, sf_dir), rules)


_PAGE_WORDS = "SELECT doc_id, page, list_distinct(flatten(list(regexp_extract_all(lower({c}), '[a-z0-9]{{{n},}}')))) AS w, sum(length({c})) AS chars FROM (SELECT DISTINCT {k}, doc_id, page, text FROM {t} WHERE text IS NOT NULL) GROUP BY ALL"


def page_words(df, key, n):
    """Distinct words of n characters or more and the number of characters of every page; words are made rows first."""
    once = df.where("text is not null").select(key, "doc_id", "page", "text").distinct()
    words = F.array_distinct(F.flatten(F.collect_list(F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]{%d,}" % n), F.lit(0)))))
    return once.groupBy("doc_id", "page").agg(words.alias("w"), F.sum(F.length("text")).alias("chars"))


@query(f"""SELECT p.doc_id, p.page, CASE WHEN p.chars > 200 AND m.chars < 80 THEN 'empty_or_near_empty' WHEN len(p.w) > 40 AND len(list_filter(p.w, lambda x: NOT list_contains(m.w, x))) > 25
  AND len(list_filter(p.w, lambda x: NOT list_contains(m.w, x)))::DOUBLE / len(p.w) > 0.35 THEN 'missing_vocabulary' WHEN m.chars > 2.2 * p.chars THEN 'much_longer' ELSE 'ok' END AS kind
FROM ({_PAGE_WORDS.format(c="text", n=4, k="line_id", t="pdf_lines")}) p JOIN ({_PAGE_WORDS.format(c="text", n=4, k="tok_id", t="page_toks")}) m ON p.doc_id = m.doc_id AND p.page = m.page""")
def v14_structural_audit(spark, sf_dir):
    """The text of a page's lines against that of its tokens: empty, missing words, or much longer; the first that holds."""
    p = page_words(table(spark, sf_dir, "pdf_lines"), "line_id", 4)
    m = page_words(table(spark, sf_dir, "page_toks"), "tok_id", 4).withColumnsRenamed({"w": "mw", "chars": "mc"})
    lost = F.size(F.array_except("w", "mw"))
    return I.classified(p.join(m, ["doc_id", "page"]), "kind", {
        "empty_or_near_empty": (F.col("chars") > 200) & (F.col("mc") < 80),
        "missing_vocabulary": (F.size("w") > 40) & (lost > 25) & (lost / F.size("w") > 0.35),
        "much_longer": F.col("mc") > F.lit(2.2) * F.col("chars"),
    }, "ok").select("doc_id", "page", "kind")


@query(f"""SELECT m.doc_id, m.page, CASE WHEN p.chars IS NULL OR p.chars < 100 THEN 'blank_or_cover' WHEN len(list_filter(p.w, lambda x: list_contains(m.w, x)))::DOUBLE / greatest(len(p.w), 1) > 0.55 THEN 'collapsed'
WHEN len(list_filter(p.w, lambda x: list_contains(m.w, x))) = 0 THEN 'truly_missing' ELSE 'weak_overlap' END AS class
FROM ({_PAGE_WORDS.format(c="text", n=5, k="tok_id", t="page_toks")}) m LEFT JOIN ({_PAGE_WORDS.format(c="text", n=5, k="line_id", t="pdf_lines")}) p ON p.doc_id = m.doc_id AND p.page = m.page WHERE m.chars <= 120""")
def v15_empty_pages(spark, sf_dir):
    """Pages whose tokens hold 120 characters or less: blank, covered by the lines, missing or weakly covered."""
    m = page_words(table(spark, sf_dir, "page_toks"), "tok_id", 5).where("chars <= 120").select("doc_id", "page", F.col("w").alias("mw"))
    p = page_words(table(spark, sf_dir, "pdf_lines"), "line_id", 5)
    both = F.size(F.array_intersect("w", "mw"))
    return I.classified(m.join(p, ["doc_id", "page"], "left"), "class", {
        "blank_or_cover": F.col("chars").isNull() | (F.col("chars") < 100),
        "collapsed": both / F.greatest(F.size("w"), F.lit(1)) > 0.55, "truly_missing": both == 0,
    }, "weak_overlap").select("doc_id", "page", "class")


@query(f"SELECT doc_id, \"check\", CASE WHEN severity = 'hard' THEN 'review' WHEN detail::INT > 5 THEN 'check' WHEN \"check\" = 'V-SOFT-HYPHEN' THEN 'skip' ELSE 'info' END AS verdict FROM ({_GATES})")
def v16_verdicts(spark, sf_dir):
    found = I.text_gates(docs(spark, sf_dir))
    return I.classified(found, "verdict", {
        "review": F.col("severity") == "hard", "check": F.col("detail").cast("int") > 5, "skip": F.col("check") == "V-SOFT-HYPHEN",
    }, "info").select("doc_id", "check", "verdict")


@query(f"SELECT t.term, count(l.line_id) AS places FROM glossary t LEFT JOIN (SELECT line_id, text FROM ({_ROWS})) l ON l.text = t.term GROUP BY t.term")
def v19_phrase_presence(spark, sf_dir):
    found = rows(spark, sf_dir).groupBy(F.col("text").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf_dir, "glossary").select("term").join(found, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("places"))


# Dispatch


_TYPE = "CASE WHEN trim(text, ' ') = '' THEN 'blank' WHEN y0 > 750 OR y0 < 60 THEN 'furniture' WHEN regexp_matches(trim(text, ' '), '^(Figure|Table) [0-9]+') THEN 'caption' WHEN regexp_matches(trim(text, ' '), '^([-*•▪–] |[0-9]+[.)] )') THEN 'list_item' WHEN regexp_matches(trim(text, ' '), '^[A-Z][A-Z ,&-]{3,}$') THEN 'heading' ELSE 'prose' END"


def typed(spark, sf_dir):
    t = F.trim("text")
    return I.classified(rows(spark, sf_dir).where("text is not null"), "type", {
        "blank": t == "", "furniture": (F.col("y0") > 750) | (F.col("y0") < 60), "caption": t.rlike("^(Figure|Table) [0-9]+"),
        "list_item": t.rlike("^([-*•▪–] |[0-9]+[.)] )"), "heading": t.rlike("^[A-Z][A-Z ,&-]{3,}$"),
    }, "prose")


@query(f"SELECT line_id, {_TYPE} AS type FROM ({_ROWS}) WHERE text IS NOT NULL")
def d01_dispatch(spark, sf_dir):
    return typed(spark, sf_dir).select("line_id", "type")


@query(f"SELECT doc_id, group_id, lo AS page FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, group_id ORDER BY lo, hi, title NULLS FIRST) AS k FROM ({_SPANS})) WHERE k = 1")
def d02_emit_once(spark, sf_dir):
    return spans(spark, sf_dir).groupBy("doc_id", "group_id").agg(F.min("lo").alias("page"))


@query(f"SELECT line_id, row_number() OVER (PARTITION BY doc_id, page ORDER BY CASE type WHEN 'heading' THEN 0 WHEN 'furniture' THEN 2 ELSE 1 END, y0 NULLS FIRST, x0 NULLS FIRST, type, line_id) AS seq FROM (SELECT *, {_TYPE} AS type FROM ({_ROWS}) WHERE text IS NOT NULL)")
def d04_mixed_order(spark, sf_dir):
    bucket = F.when(F.col("type") == "heading", 0).when(F.col("type") == "furniture", 2).otherwise(1)
    w = Window.partitionBy("doc_id", "page").orderBy("bucket", "y0", "x0", "type", "line_id")
    return typed(spark, sf_dir).withColumn("bucket", bucket).select("line_id", F.row_number().over(w).alias("seq"))


@query(f"SELECT doc_id, group_id, CASE WHEN span_type = 'section_block' THEN 'callout' WHEN regexp_matches(coalesce(title, ''), '(?i)^table [0-9]+') THEN 'numbered_table' WHEN starts_with(group_id, 'scale') THEN 'scale' ELSE 'table' END AS route FROM (SELECT DISTINCT doc_id, group_id, span_type, title FROM ({_SPANS}))")
def d05_table_routing(spark, sf_dir):
    base = spans(spark, sf_dir).select("doc_id", "group_id", "span_type", "title").distinct()
    return I.classified(base, "route", {
        "callout": F.coalesce(F.col("span_type") == "section_block", F.lit(False)), "numbered_table": F.coalesce("title", F.lit("")).rlike("(?i)^table [0-9]+"),
        "scale": F.col("group_id").startswith("scale"),
    }, "table").select("doc_id", "group_id", "route")


@query(f"SELECT DISTINCT p.doc_id, p.page FROM ({_PAGES}) p JOIN ({_SPANS}) s ON p.doc_id = s.doc_id AND p.page > s.lo AND p.page <= s.hi AND s.span_type = 'continuation'")
def d06_continuation_pages(spark, sf_dir):
    inner = spans(spark, sf_dir).where("span_type = 'continuation' and hi > lo").select("doc_id", F.explode(F.sequence(F.col("lo") + 1, "hi")).alias("page"))
    return pages(spark, sf_dir).join(inner, ["doc_id", "page"], "left_semi")


@query(f"SELECT doc_id, string_agg(coalesce(title, ''), ' / ' ORDER BY lo, group_id, coalesce(title, '')) AS merged FROM ({_SPANS}) WHERE span_type = 'section_block' GROUP BY doc_id")
def d07_section_blocks(spark, sf_dir):
    part = F.array_sort(F.collect_list(F.struct("lo", "group_id", F.coalesce("title", F.lit("")).alias("t"))))
    blocks = spans(spark, sf_dir).where("span_type = 'section_block'").groupBy("doc_id").agg(part.alias("p"))
    return blocks.select("doc_id", F.array_join(F.transform("p", lambda x: x["t"]), " / ").alias("merged"))


@query("SELECT doc_id, coalesce(title, CASE WHEN text IS NOT NULL AND trim(text, ' ') <> '' THEN left(text, 40) END, '<!-- pending -->') AS shown, CASE WHEN title IS NOT NULL THEN 'vision' WHEN text IS NOT NULL AND trim(text, ' ') <> '' THEN 'geometry' ELSE 'pending' END AS status FROM documents")
def d08_fallback_chain(spark, sf_dir):
    has = F.col("text").isNotNull() & (F.trim("text") != "")
    status = F.when(F.col("title").isNotNull(), "vision").when(has, "geometry").otherwise("pending")
    return docs(spark, sf_dir).select("doc_id", F.coalesce("title", F.when(has, F.left("text", F.lit(40))), F.lit("<!-- pending -->")).alias("shown"), status.alias("status"))


_FIXED = r"regexp_replace(text, '([\p{L}\p{N}_])-[ \t\n\r\f]+([\p{L}\p{N}_])', '\1\2', 'g')"


@query(rf"""SELECT doc_id, array_to_string(list_filter([CASE WHEN {_FIXED} <> text THEN 'hyphenation' END, CASE WHEN contains(text, chr(173)) THEN 'soft hyphens' END, CASE WHEN regexp_matches(text, '[ﬁﬂ]') THEN 'ligatures' END, CASE WHEN contains(text, '  ') THEN 'double spaces' END], lambda x: x IS NOT NULL), ',') AS fixes FROM documents WHERE text IS NOT NULL""")
def d11_fix_labels(spark, sf_dir):
    t = F.col("text")
    labels = F.array(
        F.when(X.join_hyphens(t) != t, "hyphenation"), F.when(F.contains(t, F.lit("­")), "soft hyphens"),
        F.when(t.rlike("[ﬁﬂ]"), "ligatures"), F.when(F.contains(t, F.lit("  ")), "double spaces"),
    )
    return docs(spark, sf_dir).where("text is not null").select("doc_id", F.array_join(F.filter(labels, lambda x: x.isNotNull()), ",").alias("fixes"))


@query(f"SELECT l.doc_id, l.page, count(*) AS n_lines, max(j.title) AS title, max(j.pages) AS pages FROM ({_ROWS}) l JOIN ({_JOBS}) j ON l.doc_id = j.id WHERE l.page BETWEEN 10 AND 20 GROUP BY ALL")
def d12_page_debugger(spark, sf_dir, first=10, last=20):
    """What is known of the pages asked for; choosing pages is what the debugger is for."""
    some = rows(spark, sf_dir).where(F.col("page").between(first, last)).groupBy("doc_id", "page").agg(F.count(F.lit(1)).alias("n_lines"))
    return some.join(jobs(spark, sf_dir).select(F.col("id").alias("doc_id"), "title", "pages"), "doc_id")


@query(f"SELECT DISTINCT s.doc_id, s.group_id FROM ({_SPANS}) s ANTI JOIN ({_PAGES}) p ON s.doc_id = p.doc_id AND s.lo = p.page")
def d13_pending(spark, sf_dir):
    seen = pages(spark, sf_dir).withColumnRenamed("page", "lo")
    return spans(spark, sf_dir).join(seen, ["doc_id", "lo"], "left_anti").select("doc_id", "group_id").distinct()


# Page classes, zones and gates of the inventory


@query(f"""WITH c AS (SELECT doc_id, page, sum(length(coalesce(text, ''))) AS n, count(*) AS k FROM ({_ROWS}) WHERE page IS NOT NULL GROUP BY ALL), s AS (SELECT DISTINCT ON (doc_id, page) doc_id, page, span_type, lo FROM (SELECT doc_id, span_type, group_id, lo, hi, unnest(generate_series(lo, hi)) AS page FROM ({_SPANS})) ORDER BY doc_id, page, hi - lo DESC, group_id, lo)
SELECT c.doc_id, c.page, CASE WHEN c.page <= 2 THEN 'toc' WHEN c.n < 50 AND c.k < 5 THEN 'blank' WHEN s.span_type = 'section_block' THEN 'section_block' WHEN s.span_type = 'continuation' AND c.page > s.lo THEN 'multi_page_table' WHEN s.span_type = 'series' THEN CASE WHEN c.n > 400 THEN 'mixed' ELSE 'single_table' END ELSE 'pure_text' END AS content_type FROM c LEFT JOIN s ON c.doc_id = s.doc_id AND c.page = s.page""")
def f01_page_class(spark, sf_dir):
    from ..operators.lines import longest_cover

    text = rows(spark, sf_dir).where("page is not null").groupBy("doc_id", "page").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("n"), F.count(F.lit(1)).alias("k"))
    span = longest_cover(pages(spark, sf_dir), spans(spark, sf_dir), ["doc_id"], "page", "lo", "hi", ["group_id", "lo"]).select("doc_id", "page", "span_type", "lo")
    st, series = F.coalesce("span_type", F.lit("")), F.when(F.col("n") > 400, "mixed").otherwise("single_table")
    kind = (
        F.when(F.col("page") <= 2, "toc").when((F.col("n") < 50) & (F.col("k") < 5), "blank").when(st == "section_block", "section_block")
        .when((st == "continuation") & (F.col("page") > F.col("lo")), "multi_page_table").when(st == "series", series).otherwise("pure_text")
    )
    return text.join(span, ["doc_id", "page"], "left").select("doc_id", "page", kind.alias("content_type"))


@query("SELECT doc_id, bool_or(rotated) AS any_rotated, count_if(rotated) AS n_rotated FROM span_groups GROUP BY doc_id")
def f02_rotation(spark, sf_dir):
    return table(spark, sf_dir, "span_groups").groupBy("doc_id").agg(F.bool_or("rotated").alias("any_rotated"), F.count_if("rotated").alias("n_rotated"))


@query(f"SELECT doc_id, page, coalesce(min(CASE WHEN y0 > 842 * 0.88 OR (y0 > 842 * 0.62 AND regexp_matches(trim(text, ' '), '^[0-9]{{1,3}}\\. ')) THEN y0 END), 842 * 0.88) AS band FROM ({_ROWS}) GROUP BY ALL")
def f04_footer_band(spark, sf_dir):
    low = (F.col("y0") > 842 * 0.88) | ((F.col("y0") > 842 * 0.62) & F.trim("text").rlike(r"^[0-9]{1,3}\. "))
    return rows(spark, sf_dir).groupBy("doc_id", "page").agg(F.coalesce(F.min(F.when(low, F.col("y0"))), F.lit(842 * 0.88)).alias("band"))


_STARTS = r"^(#{1,6} |[-*] |>|!\[|<!--|\||```|---|\*\*[^*]+\*\*$)"
_RUNS_ON = "^(The|This|In|Here|As|It) |^However"


@query(f"""WITH n AS (SELECT *, lead(trim(text, ' ')) OVER (PARTITION BY doc_id, page ORDER BY line_no, line_id) AS nx FROM ({_ROWS}) WHERE text IS NOT NULL)
SELECT line_id, coalesce(trim(text, ' ') = '' OR nx = '' OR regexp_matches(nx, '{_STARTS}') OR (regexp_matches(trim(text, ' '), '[.!?;:]$') AND length(nx) < 60 AND NOT regexp_matches(nx, '[.!?;:]$') AND regexp_matches(nx, '^[A-Z]') AND NOT regexp_matches(nx, '{_RUNS_ON}')), false) AS breaks FROM n""")
def f07_paragraph_break(spark, sf_dir):
    w = Window.partitionBy("doc_id", "page").orderBy("line_no", "line_id")
    rows_ = rows(spark, sf_dir).where("text is not null").withColumn("t", F.trim("text")).withColumn("nx", F.lead("t").over(w))
    signed = F.col("t").rlike("[.!?;:]$") & (F.length("nx") < 60) & ~F.col("nx").rlike("[.!?;:]$") & F.col("nx").rlike("^[A-Z]") & ~F.col("nx").rlike(_RUNS_ON)
    breaks = (F.col("t") == "") | (F.col("nx") == "") | F.col("nx").rlike(_STARTS) | signed
    return rows_.select("line_id", F.coalesce(breaks, F.lit(False)).alias("breaks"))


@query("""WITH b AS (SELECT doc_id, page, min(y0) AS a, max(y0) AS z FROM page_toks WHERE y0 IS NOT NULL GROUP BY ALL)
SELECT DISTINCT l.line_id FROM pdf_lines l ANTI JOIN (SELECT l.line_id FROM pdf_lines l JOIN b ON l.doc_id = b.doc_id AND l.page = b.page WHERE least(l.y1, b.z) - greatest(l.y0, b.a) > 0.5 * (l.y1 - l.y0) AND l.y0 IS NOT NULL AND l.y1 IS NOT NULL) x ON l.line_id = x.line_id""")
def f14_exclusive_regions(spark, sf_dir):
    lines = table(spark, sf_dir, "pdf_lines").select("line_id", "doc_id", "page", "y0", "y1").distinct()
    box = table(spark, sf_dir, "page_toks").where("y0 is not null").groupBy("doc_id", "page").agg(F.min("y0").alias("a"), F.max("y0").alias("z"))
    met = lines.join(box, ["doc_id", "page"], "left")
    inside = (F.least("y1", "z") - F.greatest("y0", "a") > 0.5 * (F.col("y1") - F.col("y0"))) & F.col("a").isNotNull() & F.col("y0").isNotNull() & F.col("y1").isNotNull()
    return met.groupBy("line_id").agg(F.bool_or(F.coalesce(inside, F.lit(False))).alias("hit")).where("not hit").select("line_id")


@query("SELECT line_id, extracted_at, y0 < 842 * 0.38 AND (x0 + x1) / 2 < 595 * 0.48 AND x1 - x0 < 595 * 0.62 AS top_left, y0 < 842 * 0.42 AND x1 - x0 >= 595 * 0.55 AS top_full FROM pdf_lines")
def f18_placement(spark, sf_dir):
    w, h, width = 595.0, 842.0, F.col("x1") - F.col("x0")
    left = (F.col("y0") < h * 0.38) & ((F.col("x0") + F.col("x1")) / 2 < w * 0.48) & (width < w * 0.62)
    full = (F.col("y0") < h * 0.42) & (width >= w * 0.55)
    return table(spark, sf_dir, "pdf_lines").select("line_id", "extracted_at", left.alias("top_left"), full.alias("top_full"))


_MARKS = "[" + ",".join(f"'{m}'" for m in R.ID_MARKS) + "]"
_TOKENS = "[" + ",".join(f"'{w}'" for w in sorted(R.FORWARD) if len(w) > 3 or w in R.TOKEN_REPAIRS) + "]"


@query(f"""SELECT job_id, snapshot_no, id, len(list_filter({_MARKS}, lambda m: contains(lower(id), m))) > 0 OR len(list_intersect(regexp_split_to_array(lower(id), '[_-]'), {_TOKENS})) > 0 AS garbled FROM manifest_entries WHERE id IS NOT NULL
UNION ALL SELECT doc_id, NULL, group_id, len(list_filter({_MARKS}, lambda m: contains(lower(group_id), m))) > 0 OR len(list_intersect(regexp_split_to_array(lower(group_id), '[_-]'), {_TOKENS})) > 0 FROM span_groups WHERE group_id IS NOT NULL""")
def f19_garbled_ids(spark, sf_dir):
    entries = table(spark, sf_dir, "manifest_entries").where("id is not null").select("job_id", "snapshot_no", "id")
    groups = table(spark, sf_dir, "span_groups").where("group_id is not null").select(F.col("doc_id").alias("job_id"), F.lit(None).cast("int").alias("snapshot_no"), F.col("group_id").alias("id"))
    return entries.unionByName(groups).withColumn("garbled", R.garbled_id(F.col("id")))


@query("SELECT id, received_at, coalesce(extraction.features['figures'], false) AS figures, output.\"mode\" = 'markdown' AND ends_with(lower(source.file), '.pdf') AS ready FROM jobs")
def f21_f22_feature_and_ready_gates(spark, sf_dir):
    ready = (F.col("output.mode") == "markdown") & F.lower("source.file").endswith(".pdf")
    return table(spark, sf_dir, "jobs").select("id", "received_at", F.coalesce(F.col("extraction.features")["figures"], F.lit(False)).alias("figures"), ready.alias("ready"))


@query(f"SELECT p.doc_id, p.page, p.page < b.first_span AS in_contents FROM ({_PAGES}) p JOIN (SELECT doc_id, min(lo) AS first_span FROM ({_SPANS}) GROUP BY doc_id) b ON p.doc_id = b.doc_id")
def f23_toc_zone(spark, sf_dir):
    first = spans(spark, sf_dir).groupBy("doc_id").agg(F.min("lo").alias("first_span"))
    return pages(spark, sf_dir).join(first, "doc_id").select("doc_id", "page", (F.col("page") < F.col("first_span")).alias("in_contents"))


# Sinks as relations


_NO = "CASE WHEN length({c}::VARCHAR) < 3 THEN lpad({c}::VARCHAR, 3, '0') ELSE {c}::VARCHAR END"


@query(f"SELECT doc_id, chunk_id, start_page, e AS end_page, 'chunks/' || chunk_id || '_pages_' || {_NO.format(c='start_page')} || '-' || {_NO.format(c='e')} || '.pdf' AS out_path FROM (SELECT c.*, coalesce(c.end_page, j.pages) AS e FROM chunks c LEFT JOIN ({_JOBS}) j ON c.doc_id = j.id)")
def k01_chunk_paths(spark, sf_dir):
    """An open end is the document's last page; where that is unknown too, the path is null."""
    ends = jobs(spark, sf_dir).select(F.col("id").alias("doc_id"), "pages")
    chunks = table(spark, sf_dir, "chunks").join(ends, "doc_id", "left").withColumn("end_page", F.coalesce("end_page", "pages"))
    path = F.concat(F.lit("chunks/"), "chunk_id", F.lit("_pages_"), X.padded(F.col("start_page"), 3), F.lit("-"), X.padded(F.col("end_page"), 3), F.lit(".pdf"))
    return chunks.select("doc_id", "chunk_id", "start_page", "end_page", path.alias("out_path"))


@query(f"SELECT j.id, max(j.title) AS title, max(j.pages) AS page_count, count(m.id) AS entries FROM ({_JOBS}) j LEFT JOIN (SELECT DISTINCT job_id, id FROM manifest_entries WHERE id IS NOT NULL) m ON j.id = m.job_id GROUP BY j.id")
def k03_manifest(spark, sf_dir):
    n = table(spark, sf_dir, "manifest_entries").where("id is not null").select(F.col("job_id").alias("id"), F.col("id").alias("e")).distinct().groupBy("id").agg(F.count("e").alias("n"))
    return jobs(spark, sf_dir).join(n, "id", "left").select("id", "title", F.col("pages").alias("page_count"), F.coalesce("n", F.lit(0)).alias("entries"))


@query(f"SELECT doc_id, group_id AS id, title AS display_caption, lo AS page_start, hi AS page_end, array_to_string(generate_series(lo, hi), ',') AS merged_from_pages, '#' || group_id AS anchor FROM ({_SPANS})")
def k04_registry(spark, sf_dir):
    return spans(spark, sf_dir).select(
        "doc_id", F.col("group_id").alias("id"), F.col("title").alias("display_caption"), F.col("lo").alias("page_start"), F.col("hi").alias("page_end"),
        F.array_join(F.sequence("lo", "hi"), ",").alias("merged_from_pages"), F.concat(F.lit("#"), "group_id").alias("anchor"),
    )


@query(f"SELECT j.id, j.profile, count(DISTINCT s.group_id) AS records, count(DISTINCT c.chunk_id) AS chunks FROM ({_JOBS}) j LEFT JOIN ({_SPANS}) s ON j.id = s.doc_id LEFT JOIN chunks c ON j.id = c.doc_id GROUP BY ALL")
def k05_job_envelope(spark, sf_dir):
    count = lambda df, c, n: df.select(F.col("doc_id").alias("id"), c).distinct().groupBy("id").agg(F.count(c).alias(n))
    met = jobs(spark, sf_dir).select("id", "profile").join(count(spans(spark, sf_dir), "group_id", "records"), "id", "left")
    met = met.join(count(table(spark, sf_dir, "chunks"), "chunk_id", "chunks"), "id", "left")
    return met.na.fill(0, ["records", "chunks"])


@query("SELECT m.job_id, m.v AS approved_version, count(*) AS entries FROM (SELECT job_id, max(snapshot_no) AS v FROM manifest_entries GROUP BY job_id) m JOIN manifest_entries e ON m.job_id = e.job_id AND m.v = e.snapshot_no GROUP BY ALL")
def k07_approved(spark, sf_dir):
    rows_ = table(spark, sf_dir, "manifest_entries").select("job_id", F.col("snapshot_no").alias("approved_version"))
    per = rows_.groupBy("job_id", "approved_version").agg(F.count(F.lit(1)).alias("entries"))
    best = F.max(F.struct("approved_version", "entries")).alias("b")
    return per.groupBy("job_id").agg(best).where("job_id is not null and b.approved_version is not null").select("job_id", "b.approved_version", "b.entries")


@query("SELECT tok_id, round(x0 / 595 * 1000, 3) AS crop_left, round(y0 / 842 * 1000, 3) AS crop_top FROM page_toks")
def k08_crop_fractions(spark, sf_dir):
    return table(spark, sf_dir, "page_toks").select("tok_id", F.round(F.col("x0") / 595 * 1000, 3).alias("crop_left"), F.round(F.col("y0") / 842 * 1000, 3).alias("crop_top"))


@query(f"SELECT doc_id, group_id AS slug, lo AS page, CASE WHEN rotated THEN 270 ELSE 0 END AS rotation, CASE WHEN rotated THEN 'pending' ELSE 'complete' END AS status FROM (SELECT DISTINCT doc_id, group_id, least(coalesce(start_page, end_page), coalesce(end_page, start_page)) AS lo, rotated FROM span_groups WHERE start_page IS NOT NULL OR end_page IS NOT NULL)")
def k09_handoff(spark, sf_dir):
    base = table(spark, sf_dir, "span_groups").where("start_page is not null or end_page is not null")
    lo = F.least(F.coalesce("start_page", "end_page"), F.coalesce("end_page", "start_page"))
    made = base.select("doc_id", F.col("group_id").alias("slug"), lo.alias("page"), "rotated").distinct()
    return made.select("doc_id", "slug", "page", F.when(F.col("rotated"), 270).otherwise(0).alias("rotation"), F.when(F.col("rotated"), "pending").otherwise("complete").alias("status"))


@query(f"SELECT \"check\" AS type, count(*) AS n, count(DISTINCT doc_id) AS docs FROM ({_GATES}) GROUP BY 1")
def k10_report(spark, sf_dir):
    return I.text_gates(docs(spark, sf_dir)).groupBy(F.col("check").alias("type")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("docs"))


@query(f"SELECT doc_id, 'status: ' || CASE WHEN bool_or(severity = 'hard') THEN 'fail' ELSE 'pass' END || chr(10) || 'failures: ' || count(*) AS yaml FROM ({_GATES}) GROUP BY doc_id")
def k11_status_yaml(spark, sf_dir):
    found = I.text_gates(docs(spark, sf_dir)).groupBy("doc_id").agg(F.bool_or(F.col("severity") == "hard").alias("bad"), F.count(F.lit(1)).alias("n"))
    return found.select("doc_id", F.concat(F.lit("status: "), F.when(F.col("bad"), "fail").otherwise("pass"), F.lit("\nfailures: "), F.col("n").cast("string")).alias("yaml"))


@query("SELECT doc_id, coalesce(title, text) AS body, CASE WHEN title IS NOT NULL THEN 'override' WHEN text IS NOT NULL THEN 'auto' ELSE 'none' END AS origin FROM documents")
def s10_override(spark, sf_dir):
    over = docs(spark, sf_dir).where("title is not null").select("doc_id", F.col("title").alias("o"))
    origin = F.when(F.col("o").isNotNull(), "override").when(F.col("text").isNotNull(), "auto").otherwise("none")
    return docs(spark, sf_dir).select("doc_id", "text").join(over, "doc_id", "left").select("doc_id", F.coalesce("o", "text").alias("body"), origin.alias("origin"))


@query("SELECT DISTINCT c.job_id, c.candidate FROM (SELECT job_id, candidate, row_number() OVER (PARTITION BY job_id ORDER BY rank, candidate) AS k FROM (SELECT job_id, unnest([id, replace(id, '-', '_')]) AS candidate, unnest([1, 2]) AS rank FROM manifest_entries WHERE id IS NOT NULL AND job_id IS NOT NULL)) c WHERE k = 1")
def s11_asset_resolver(spark, sf_dir):
    base = table(spark, sf_dir, "manifest_entries").where("id is not null and job_id is not null")
    cand = base.select("job_id", F.explode(F.array(F.struct(F.lit(1).alias("rank"), F.col("id").alias("candidate")), F.struct(F.lit(2).alias("rank"), F.replace(F.col("id"), F.lit("-"), F.lit("_")).alias("candidate")))).alias("c"))
    return cand.groupBy("job_id").agg(F.min("c").alias("c")).select("job_id", "c.candidate")


@query("SELECT doc_id, CASE WHEN length(text) > 200 THEN 'native' ELSE 'ocr' END AS seeded_from FROM documents")
def s12_native_seeding(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.when(F.length("text") > 200, "native").otherwise("ocr").alias("seeded_from"))
