"""Registered queries of this subpackage: QUERIES by name, SQL where the oracle can express them."""

from pyspark.sql import functions as F

from ..session import table
from . import tables
from .boundaries import boundaries, split_items
from .leakage import leaked
from .look_alikes import matching_terms
from .packing import byte_pieces, fill, program_report, split_texts
from .quality import COMMON, failed_rules, kind_of, statistics
from .repeated_lines import cleaned_documents, repeated_lines
from .scans import defects, lexicon, paragraphs, text_rows


def p1_found(spark, sf_dir):
    docs = tables.jobs(spark, sf_dir).where("not scanned").select(F.col("id").alias("doc"), F.col("publisher").alias("source"))
    rows = tables.lines(spark, sf_dir, "line_id", F.col("doc_id").alias("doc"), "text")
    return repeated_lines(rows, docs)


def p1_documents(spark, sf_dir):
    rows = tables.lines(spark, sf_dir, "line_id", F.col("doc_id").alias("doc"), "page", "line_no", "text")
    return cleaned_documents(rows, p1_found(spark, sf_dir))


def p3_found(spark, sf_dir):
    found = boundaries(tables.chunks(spark, sf_dir), tables.span_groups(spark, sf_dir), 25)
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("chunk_id"), "cut_page")


def p3_pieces(spark, sf_dir):
    texts = tables.lines(spark, sf_dir, "line_id", F.col("doc_id").alias("doc"), "page", "text").dropDuplicates(["line_id"])
    texts = texts.where("text is not null and doc is not null and page is not null")
    made = split_items(tables.chunks(spark, sf_dir), tables.span_groups(spark, sf_dir), 25, 2, texts=texts)
    return made.withColumnsRenamed({"doc": "doc_id", "item": "chunk_id"})


def p4_found(spark, sf_dir):
    rows = table(spark, sf_dir, "pdf_lines").select(F.lit("line").alias("kind"), F.col("line_id").alias("row_id"), "text")
    toks = table(spark, sf_dir, "page_toks").select(F.lit("tok").alias("kind"), F.col("tok_id").alias("row_id"), "text")
    return matching_terms(rows.unionByName(toks), table(spark, sf_dir, "glossary"))


def _words(spark, sf_dir):
    return lexicon(text_rows(tables.layout_rows(spark, sf_dir, scanned=False)), tables.reference_texts(spark, sf_dir))


def p5_found(spark, sf_dir):
    return defects(tables.layout_rows(spark, sf_dir, scanned=True), _words(spark, sf_dir))


def p5_paragraphs(spark, sf_dir):
    rows = tables.layout_rows(spark, sf_dir, scanned=True)
    return paragraphs(rows, _words(spark, sf_dir)).withColumnRenamed("doc", "doc_id")


CAPACITY = 8192


def _texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item"), "text")


def p6_fill(spark, sf_dir):
    return fill(_texts(spark, sf_dir), byte_pieces(CAPACITY), CAPACITY).withColumnRenamed("item", "doc_id")


def p6_found(spark, sf_dir):
    return split_texts(fill(_texts(spark, sf_dir), byte_pieces(CAPACITY), CAPACITY)).select(F.col("item").alias("doc_id"))


def p6_report(spark, sf_dir):
    """Containers used, the fewest possible by volume, the share of room that stays empty, and the program's value and bound."""
    value, bound, configurations = program_report(_texts(spark, sf_dir), byte_pieces(CAPACITY), CAPACITY)
    filled = p6_fill(spark, sf_dir).groupBy("container").agg(F.sum("size").alias("used"))
    fewest = F.ceil(F.sum("used") / CAPACITY)
    return filled.agg(
        F.count(F.lit(1)).alias("containers"), fewest.alias("fewest_by_volume"), F.max("used").alias("fullest"),
        F.round(1 - F.sum("used") / (F.count(F.lit(1)) * CAPACITY), 6).alias("empty_share"),
        F.lit(round(value, 3)).alias("program_value"), F.lit(round(bound, 3)).alias("program_bound"),
        F.lit(configurations).alias("configurations"),
    )


def p7_leaks(spark, sf_dir):
    return leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p7_found(spark, sf_dir):
    return p7_leaks(spark, sf_dir).where("kind in ('exact', 'altered')").select("doc_id", "item_id")


STATS = ["doc_id", "n_words", "mean_word_length", "symbol_ratio", "punct_line_share", "bullet_line_share", "common_word_share"]


def p8_statistics(spark, sf_dir):
    return statistics(table(spark, sf_dir, "documents").select("doc_id", "text")).select(*STATS)


RULE_STATS = ["n_common_words", "mark_word_ratio", "ellipsis_line_share", "letter_word_share"]


def p8_rules(spark, sf_dir):
    """Every document with its statistics and the published rules that it fails."""
    made = failed_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(*STATS, *RULE_STATS, F.array_join("failed_rules", "; ").alias("failed_rules"))


def p8_report(spark, sf_dir):
    """Every document with its statistics, the published rules it fails, its kind and the line rules that say so."""
    made = failed_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("k", kind_of(F.col("text")))
    return made.select(*STATS, "failed_rules", "k.kind", "k.reasons", "k.share")


def p8_found(spark, sf_dir):
    kind = kind_of(F.col("text"))["kind"]
    listed = F.filter(F.array(kind), lambda k: k.isin("list", "table", "junk"))  # no filter on it, which would work it out twice
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(listed).alias("kind"))


QUERIES = {
    "p1_found": p1_found, "p1_documents": p1_documents, "p3_found": p3_found, "p3_pieces": p3_pieces,
    "p4_found": p4_found, "p5_found": p5_found, "p5_paragraphs": p5_paragraphs, "p6_found": p6_found, "p6_fill": p6_fill, "p6_report": p6_report,
    "p7_found": p7_found, "p7_leaks": p7_leaks, "p8_found": p8_found, "p8_statistics": p8_statistics, "p8_rules": p8_rules, "p8_report": p8_report,
}
_COMMON = "[" + ",".join(f"'{w}'" for w in sorted(set(COMMON))) + "]"
_LOW = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda w: w <> '')"
_N = r"len(regexp_extract_all(text, '{p}'))"
_N_WORDS, _N_LINES = _N.format(p=r"[^ \t\n\r\f]+"), _N.format(p=r"(?m)^.*[^ \t\n\r\f].*$")


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} > 0 THEN round(({a})::DOUBLE / {b}, 6) END"


_STATS = f"""doc_id, CAST({_N_WORDS} AS INTEGER) AS n_words,
  {_ratio("length(regexp_replace(text, '[ \\t\\n\\r\\f]', '', 'g'))", _N_WORDS)} AS mean_word_length,
  {_ratio("length(regexp_replace(text, '[\\p{L}\\p{M}\\p{N}\\s]', '', 'g'))", "length(text)")} AS symbol_ratio,
  {_ratio(_N.format(p="(?m)[.!?:;][ \\t]*\\r?$"), _N_LINES)} AS punct_line_share,
  {_ratio(_N.format(p="(?m)^[ \\t]*[-*•▪–][ \\t]"), _N_LINES)} AS bullet_line_share,
  {_ratio(f"len(list_filter({_LOW}, lambda w: list_contains({_COMMON}, w)))", f"len({_LOW})")} AS common_word_share"""


SQL = {
    "p3_found": """
WITH j AS (SELECT id, pages FROM (SELECT id, source.expected_page_count AS pages, row_number() OVER (PARTITION BY id ORDER BY received_at DESC NULLS LAST) AS k FROM jobs) WHERE k = 1),
c AS (SELECT doc_id, chunk_id, start_page AS lo, coalesce(end_page, pages) AS hi FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_id ORDER BY delivered_at DESC NULLS LAST) AS k FROM chunks) LEFT JOIN j ON doc_id = j.id WHERE k = 1),
g AS (SELECT DISTINCT doc_id, span_type, least(coalesce(start_page, end_page), coalesce(end_page, start_page)) AS lo, greatest(coalesce(start_page, end_page), coalesce(end_page, start_page)) AS hi FROM span_groups),
p AS (SELECT * FROM g WHERE span_type IN ('continuation', 'section_block') OR (span_type = 'series' AND hi - lo + 1 >= 10))
SELECT DISTINCT c.doc_id, c.chunk_id, g.lo AS cut_page FROM c JOIN g ON c.doc_id = g.doc_id AND g.lo > c.lo AND g.lo <= c.hi
WHERE c.hi - c.lo + 1 > 25 AND NOT EXISTS (SELECT 1 FROM p WHERE p.doc_id = g.doc_id AND p.lo < g.lo AND p.hi >= g.lo)""",
    "p6_found": "SELECT doc_id FROM documents WHERE strlen(text) > 8192",
    "p8_statistics": f"SELECT {_STATS} FROM documents",
    "p8_rules": f"""
WITH s AS (SELECT {_STATS}, CAST(len(list_filter({_LOW}, lambda w: list_contains({_COMMON}, w))) AS INTEGER) AS n_common_words,
  {_ratio(_N.format(p="#|[.][.][.]|…"), _N_WORDS)} AS mark_word_ratio,
  {_ratio(_N.format(p="(?m)(?:[.][.][.]|…)[ \\t]*\\r?$"), _N_LINES)} AS ellipsis_line_share,
  {_ratio(_N.format(p="[^ \\t\\n\\r\\f\\p{L}]*\\p{L}[^ \\t\\n\\r\\f]*"), _N_WORDS)} AS letter_word_share
FROM documents)
SELECT *, CASE WHEN n_words IS NOT NULL THEN concat_ws('; ',
  CASE WHEN n_words < 50 THEN 'too few words' END, CASE WHEN n_words > 100000 THEN 'too many words' END,
  CASE WHEN coalesce(mean_word_length NOT BETWEEN 3 AND 10, true) THEN 'mean word length' END,
  CASE WHEN coalesce(mark_word_ratio > 0.1, true) THEN 'symbols for words' END,
  CASE WHEN coalesce(bullet_line_share > 0.9, true) THEN 'bullet lines' END,
  CASE WHEN coalesce(ellipsis_line_share > 0.3, true) THEN 'ellipsis lines' END,
  CASE WHEN coalesce(letter_word_share < 0.8, true) THEN 'words without letters' END,
  CASE WHEN n_common_words < 2 THEN 'common words' END,
  CASE WHEN coalesce(punct_line_share < 0.12, true) THEN 'line ends' END) END AS failed_rules FROM s""",
}
