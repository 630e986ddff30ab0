"""Queries of the scalar functions over whole tables, each with the SQL that says the same."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..session import table

QUERIES: dict = {}
SQL: dict = {}


def add(name, source, key, column, expression, sql, where=None):
    """A query of one expression over one column of a table, with its key; sql is the expression of the oracle."""

    def query(spark, sf_dir):
        df = table(spark, sf_dir, source)
        df = df.where(where) if where else df
        return df.select(key, expression(F.col(column)).alias("result"))

    QUERIES[name] = query
    SQL[name] = f"SELECT {key}, {sql.replace('$c', column)} AS result FROM {source}" + (f" WHERE {where}" if where else "")


_SLUG = "trim(regexp_replace(lower($c), '[^a-z0-9]+', '_', 'g'), '_')"
_HYPHEN = r"regexp_replace($c, '([\p{L}\p{N}_])-[ \t\n\r\f]+([\p{L}\p{N}_])', '\1\2', 'g')"
_WORDS = "[" + ",".join(f"'{w}'" for w in X.SCORE_WORDS) + "]"
_SCORE = (
    f"CASE WHEN $c IS NULL THEN NULL WHEN len(regexp_extract_all($c, '[A-Za-z]{{3,}}')) = 0 THEN 0.0 ELSE "
    f"len(list_filter(regexp_extract_all($c, '[A-Za-z]{{3,}}'), lambda w: list_contains({_WORDS}, lower(w))))::DOUBLE "
    f"/ len(regexp_extract_all($c, '[A-Za-z]{{3,}}')) END"
)

add("c01_slugify", "manifest_entries", "id", "title", lambda c: X.slugify(c), f"CASE WHEN {_SLUG} = '' THEN 'untitled' ELSE {_SLUG} END")
add("c01_slugify_prefix", "span_groups", "group_id", "title", lambda c: X.slugify(c, "scale"), f"CASE WHEN {_SLUG} = '' THEN 'scale' ELSE 'scale_' || {_SLUG} END")
add(
    "c02_broken_words", "documents", "doc_id", "text", X.fix_broken_words,
    f"replace(replace(replace(replace(replace({_HYPHEN}, '–' || chr(173), '–'), chr(173), ''), 'ﬁ', 'fi'), 'ﬂ', 'fl'), '  ', ' ')",
)


def _typo_sql(column):
    out = column
    for was, now in X.TYPOS:
        out = f"replace({out}, '{was}', '{now}')"
    out = rf"regexp_replace({out}, '\n-\*\*', chr(10) || '- **', 'g')"
    out = rf"regexp_replace({out}, '\x{{feff}}[ \t\n\r\f]*Page[ \t\n\r\f]+([0-9]+)', '<!-- Page \1 -->', 'g')"
    out = rf"regexp_replace({out}, '([\p{{L}}\p{{N}}_])-[ \t\n\r\f]+([\p{{L}}\p{{N}}_])', '\1\2', 'g')"
    return rf"replace(regexp_replace({out}, '\.([A-Z])', '. \1', 'g'), chr(173), '')"


add("c03_typos", "documents", "doc_id", "text", X.fix_typos, _typo_sql("$c"))
add("c06_bullets", "pdf_lines", "line_id", "text", X.bullet_line, r"regexp_replace($c, '^([ \t]*)(?:[fF]|▶|▸|►|•|▪|‣)[ \t]+', '\1- ')")
add("c16_db_ids", "documents", "doc_id", "text", lambda c: F.array_join(X.db_ids(c), ","), r"array_to_string(regexp_extract_all($c, '<!-- db:id=([^\s]+)', 1), ',')")
add(
    "c18_heading_depth", "pdf_lines", "line_id", "text", X.heading_depth,
    r"CASE WHEN regexp_matches(trim($c), '^[0-9]+(\.[0-9]+)+\.[ \t]+') THEN least(len(string_split(regexp_extract(trim($c), '^([0-9]+(?:\.[0-9]+)*)\.[ \t]+', 1), '.')) + 1, 6) END",
)
add(
    "c25_skeleton", "pdf_lines", "line_id", "text", X.skeleton,
    r"trim(lower(regexp_replace(regexp_replace(regexp_replace($c, '[‘’]', '''', 'g'), '[ˈˎˋˏˊˇ·ˌ''`´,.\x22|$]+', '', 'g'), '[^A-Za-z0-9]+', ' ', 'g')))",
)
add(
    "c29_comparable", "documents", "doc_id", "text", X.comparable,
    r"trim(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace($c, '(?s)<!--.*?-->', ' ', 'g'), '!\[[^\]]*\]\([^)]*\)', ' ', 'g'), '[|`#>*_\-\[\]()]+', ' ', 'g')), '[ \t\n\r\f]+', ' ', 'g'))",
)
add("c27_document_page", "pdf_lines", "line_id", "page", lambda c: X.document_page(c, 6), "CASE WHEN $c > 6 THEN $c - 6 END")
add(
    "c31_product_tiers", "pdf_lines", "line_id", "page", lambda c: F.array_join(X.product_tiers(c), ","),
    "CASE WHEN $c IS NULL THEN '' WHEN $c BETWEEN 177 AND 181 THEN 'base' WHEN $c BETWEEN 173 AND 190 THEN 'assessment_action,context' WHEN $c BETWEEN 191 AND 241 THEN 'detailed,context' WHEN $c BETWEEN 47 AND 170 THEN 'assessment_action,detailed' ELSE 'context' END",
)
add(
    "c39_punctuation", "documents", "doc_id", "text", X.fix_punctuation,
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace($c, '[ \t]+([,.;:!?])', '\1', 'g'), '“[ \t]+', '“', 'g'), '[ \t]+”', '”', 'g'), '([,;])(\p{L})', '\1 \2', 'g')",
)
add("g01_english_score", "documents", "doc_id", "text", lambda c: F.round(X.english_score(c), 9), f"round({_SCORE}, 9)")
add(
    "f11_gibberish", "documents", "doc_id", "text", X.is_gibberish,
    rf"length(regexp_replace($c, '^[ \t\n\r\f]+|[ \t\n\r\f]+$', '', 'g')) >= 40 AND (({_SCORE}) < 0.05 OR (({_SCORE}) < 0.08 AND "
    f"len(list_filter(regexp_extract_all($c, '[a-z]{{4,}}'), lambda w: NOT list_contains({_WORDS}, w))) > 10))",
)
add(
    "g04_measurable_chars", "documents", "doc_id", "text", X.measurable_chars,
    r"length(regexp_replace(regexp_replace(regexp_replace(regexp_replace($c, '(?s)<!--.*?-->', '', 'g'), '!\[[^\]]*\]\([^)]*\)', '', 'g'), '(?m)^#+[^\n]*$', '', 'g'), '[ \t\n\r\f]+', '', 'g'))",
)
add(
    "g17_health_counts", "documents", "doc_id", "text",
    lambda c: F.concat_ws(",", F.regexp_count(c, F.lit(r"\\[*_]")), F.regexp_count(c, F.lit(r"\x{200b}")), F.regexp_count(c, F.lit(r"\x{a0}")), F.regexp_count(c, F.lit("Ã|�")), F.regexp_count(c, F.lit("```"))),
    r"concat_ws(',', len(regexp_extract_all($c, '\\[*_]')), len(regexp_extract_all($c, '\x{200b}')), len(regexp_extract_all($c, '\x{a0}')), len(regexp_extract_all($c, 'Ã|�')), len(regexp_extract_all($c, '```')))",
    where="text is not null",
)
add(
    "k12_run_log", "documents", "doc_id", "text",
    lambda c: F.concat_ws(":", F.octet_length(c), F.octet_length(X.fix_broken_words(c)), F.upper(F.sha2(c, 256))),
    f"concat_ws(':', strlen($c), strlen({'replace(replace(replace(replace(replace(' + _HYPHEN + ', ' + chr(39) + '–' + chr(39) + ' || chr(173), ' + chr(39) + '–' + chr(39) + '), chr(173), ' + chr(39) * 2 + '), ' + chr(39) + 'ﬁ' + chr(39) + ', ' + chr(39) + 'fi' + chr(39) + '), ' + chr(39) + 'ﬂ' + chr(39) + ', ' + chr(39) + 'fl' + chr(39) + '), ' + chr(39) + '  ' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')'}), upper(sha256($c)))",
    where="text is not null",
)
_LAST = r"list_extract(list_filter(list_transform(string_split(regexp_replace(regexp_replace($c, '(?s)<!--.*?-->', '', 'g'), '\*[^\n]*Page[^\n]*\*', '', 'g'), chr(10)), lambda x: regexp_replace(x, '^[ \t\r\f]+|[ \t\r\f]+$', '', 'g')), lambda x: x <> '' AND NOT regexp_matches(x, '^(\||#|```|-)')), -1)"
add("c34_cutoffs", "documents", "doc_id", "text", X.cutoff, rf"CASE WHEN length({_LAST}) >= 25 AND regexp_matches({_LAST}, '[a-z,;]$') AND NOT regexp_matches({_LAST}, '^[*>]') THEN {_LAST} END")
add(
    "c13_table_rows", "documents", "doc_id", "text",
    lambda c: F.array_join(F.transform(F.filter(F.transform(X.lines_of(c), X.table_rows), lambda r: r.isNotNull()), lambda r: F.array_join(r, "¦")), "\n"),
    r"array_to_string(list_transform(list_filter(string_split($c, chr(10)), lambda x: starts_with(trim(x), '|') AND length(trim(x)) > 1 AND NOT regexp_matches(trim(x), '^[|: -]+$')), "
    r"lambda x: array_to_string(list_transform(string_split(regexp_replace(regexp_replace(trim(x), '^\|', ''), '\|$', ''), '|'), lambda y: trim(y)), '¦')), chr(10))",
)
add(
    "c35_first_match_line", "documents", "doc_id", "text",
    lambda c: F.when(F.instr(c, "the ") > 0, X.line_of_position(c, F.instr(c, "the ") - 1)),
    "CASE WHEN instr($c, 'the ') > 0 THEN length(left($c, instr($c, 'the ') - 1)) - length(replace(left($c, instr($c, 'the ') - 1), chr(10), '')) + 1 END",
)
add(
    "f03_line_zone", "pdf_lines", "line_id", "text",
    lambda c: F.when(F.trim(c) == "", "skip")
    .when((F.col("y0") >= 842 * 0.88) & c.rlike(r"(?i)page[ \t]+\**[0-9]+|^[ \t]*[0-9]+[ \t]*\|?$"), "page_marker")
    .when((F.col("y0") > 842 * 0.62) & F.trim(c).rlike(r"^[0-9]{1,3}\.[ \t]"), "footnote").otherwise("body"),
    r"CASE WHEN trim($c) = '' THEN 'skip' WHEN y0 >= 842 * 0.88 AND regexp_matches($c, '(?i)page[ \t]+\**[0-9]+|^[ \t]*[0-9]+[ \t]*\|?$') THEN 'page_marker' "
    r"WHEN y0 > 842 * 0.62 AND regexp_matches(trim($c), '^[0-9]{1,3}\.[ \t]') THEN 'footnote' ELSE 'body' END",
    where="text is not null",
)
add(
    "f05_footnote_continuation", "pdf_lines", "line_id", "text",
    lambda c: (F.trim(c) != "") & ~F.trim(c).rlike(r"^[0-9]{1,3}\.[ \t]") & ~F.trim(c).rlike(r"(?i)page[ \t]+[0-9]+")
    & (F.trim(c).rlike(r"^\p{Ll}") | F.trim(c).rlike(r"^(www\.|http|available at)") | ((F.length(F.trim(c)) < 90) & ~F.trim(c).endswith("."))),
    r"trim($c) <> '' AND NOT regexp_matches(trim($c), '^[0-9]{1,3}\.[ \t]') AND NOT regexp_matches(trim($c), '(?i)page[ \t]+[0-9]+') AND "
    r"(regexp_matches(trim($c), '^\p{Ll}') OR regexp_matches(trim($c), '^(www\.|http|available at)') OR (length(trim($c)) < 90 AND NOT ends_with(trim($c), '.')))",
)
_STARTER = r"^(#{1,6} |<!--|!\[|---|\||```|- |\* |> |[0-9]{1,3}\. |Page [0-9]|Level [A-C][12])"
add("f06_block_starter", "pdf_lines", "line_id", "text", lambda c: F.trim(c).rlike(_STARTER), f"regexp_matches(trim($c), '{_STARTER}')")
add(
    "f08_list_item", "pdf_lines", "line_id", "text",
    lambda c: F.trim(c).rlike(r"^([-*•▪–·‣▶►] ?|[0-9]{1,3}[.)] |[a-z]\) )"),
    r"regexp_matches(trim($c), '^([-*•▪–·‣▶►] ?|[0-9]{1,3}[.)] |[a-z]\) )')",
)
add(
    "f09_heading", "pdf_lines", "line_id", "text",
    lambda c: F.trim(c).rlike(r"^[0-9]+(\.[0-9]+)+\.? +[A-Z]") | (F.trim(c).rlike(r"^[A-Z][A-Z0-9 ,:()&/-]{3,80}$")) | (F.coalesce(F.get("spans", F.lit(0))["size"], F.lit(0.0)) >= 12.5),
    r"regexp_matches(trim($c), '^[0-9]+(\.[0-9]+)+\.? +[A-Z]') OR regexp_matches(trim($c), '^[A-Z][A-Z0-9 ,:()&/-]{3,80}$') OR coalesce(spans[1].size, 0.0) >= 12.5",
    where="text is not null",
)
_CHROME = r"(?i)^(page[ \t]+[0-9]+|[0-9]+[ \t]*\|?|[–-] ?[0-9]+ ?[–-])$"


def f10_chrome_filter(spark, sf_dir):
    return table(spark, sf_dir, "pdf_lines").where(~F.trim("text").rlike(_CHROME)).groupBy("publisher").agg(F.count(F.lit(1)).alias("kept"))


QUERIES["f10_chrome_filter"] = f10_chrome_filter
SQL["f10_chrome_filter"] = f"SELECT publisher, count(*) AS kept FROM pdf_lines WHERE NOT regexp_matches(trim(text), '{_CHROME}') GROUP BY publisher"
add(
    "f12_table_readable", "documents", "doc_id", "text",
    lambda c: (X.english_score(c) >= 0.08) & ((F.regexp_count(c, F.lit(r"\b(?:Pre-A1|[ABC][12]\+?)")) >= 1) | (X.english_score(c) > 0.15)),
    rf"({_SCORE}) >= 0.08 AND (len(regexp_extract_all($c, '\b(?:Pre-A1|[ABC][12]\+?)')) >= 1 OR ({_SCORE}) > 0.15)",
)
add(
    "f13_diagram_label", "pdf_lines", "line_id", "text",
    lambda c: F.trim(c).rlike(r"^(Pre-A1|[ABCL][12]\+?)$") | (F.trim(c).rlike(r"^[A-Za-z-]+( [A-Za-z-]+){0,2}$") & ~F.trim(c).rlike(r"[.!?;:]$")),
    r"regexp_matches(trim($c), '^(Pre-A1|[ABCL][12]\+?)$') OR (regexp_matches(trim($c), '^[A-Za-z-]+( [A-Za-z-]+){0,2}$') AND NOT regexp_matches(trim($c), '[.!?;:]$'))",
)
_CAPTION = r"^(\*\*)?(Figure|FIGURE|Table|TABLE) [0-9]+( [–-]|:|\.)? "
add("f17_caption", "pdf_lines", "line_id", "text", lambda c: F.trim(c).rlike(_CAPTION), rf"regexp_matches(trim($c), '{_CAPTION}')")
add("f20_tone_marks", "pdf_lines", "line_id", "text", lambda c: c.rlike("[ˇˎˏ·ˈˌˋˊ↗↘]"), "regexp_matches($c, '[ˇˎˏ·ˈˌˋˊ↗↘]')")
add("f24_chapter_opener", "pdf_lines", "line_id", "text", lambda c: F.trim(c).rlike("^(?i:chapter|appendix) [0-9]+"), "regexp_matches(trim($c), '^(?i:chapter|appendix) [0-9]+')")
add("c08_reverse_line", "manifest_entries", "id", "title", lambda c: F.array_join(F.reverse(F.split(F.trim(c), " +")), " "), "array_to_string(list_reverse(regexp_split_to_array(trim($c), ' +')), ' ')")
add(
    "c19_toc_entry", "manifest_entries", "id", "title", lambda c: X.toc_entry(c, F.col("page")),
    r"""CASE WHEN upper(trim($c, ' ')) = 'CONTENTS' THEN '## Contents'
    WHEN upper(trim($c, ' ')) = 'LIST OF TABLES AND FIGURES' THEN '## List of tables and figures' WHEN upper(trim($c, ' ')) = 'LIST OF FIGURES' THEN '## List of figures' WHEN upper(trim($c, ' ')) = 'LIST OF TABLES' THEN '## List of tables'
    WHEN upper(trim($c, ' ')) = 'FOREWORD' THEN '## Foreword' || coalesce(' — ' || page::VARCHAR, '')
    WHEN starts_with(upper(trim($c, ' ')), 'PREFACE') THEN '## Preface with acknowledgements' || coalesce(' — ' || page::VARCHAR, '')
    WHEN regexp_matches(upper(trim($c, ' ')), '^(CHAPTER|APPENDIX)[ \t]+[0-9]+:') OR upper(trim($c, ' ')) = 'APPENDICES' THEN '## ' || CASE WHEN upper(trim($c, ' ')) = 'APPENDICES' THEN 'APPENDICES' ELSE trim($c, ' ') END || coalesce(' — ' || page::VARCHAR, '')
    WHEN regexp_matches(trim($c, ' '), '^[0-9]+(\.[0-9]+)+\.[ \t]+') THEN repeat('#', least(len(string_split(regexp_extract(trim($c, ' '), '^([0-9]+(?:\.[0-9]+)*)\.[ \t]+', 1), '.')) + 1, 6)::INT) || ' ' || trim($c, ' ') || coalesce(' — ' || page::VARCHAR, '')
    WHEN regexp_matches(upper(trim($c, ' ')), '^(FIGURE|TABLE)[ \t]+[0-9]+') THEN '### ' || trim($c, ' ') || coalesce(' — ' || page::VARCHAR, '')
    WHEN regexp_matches(trim($c, ' '), '^[A-Z0-9 ,:()–/&.-]+$') AND length(trim($c, ' ')) > 3 AND NOT regexp_matches(trim($c, ' '), '^[0-9]+(\.[0-9]+)*\.[ \t]+') THEN '- ' || trim($c, ' ') || coalesce(' — ' || page::VARCHAR, '')
    ELSE trim($c, ' ') || coalesce(' — ' || page::VARCHAR, '') END""",
    where="title is not null",
)
_BASE = (
    r"list_filter([trim($c, ' '), regexp_replace(trim($c, ' '), '([0-9])\.[ \t]+', '\1 ', 'g'), regexp_replace(trim($c, ' '), '\.[ \t]+', ' ', 'g'), trim(regexp_replace(trim($c, ' '), '^[0-9. \t]+', ''), ' '), "
    r"CASE WHEN contains($c, '.') AND length(trim(string_split(trim($c, ' '), '.')[-1], ' ')) > 2 THEN trim(string_split(trim($c, ' '), '.')[-1], ' ') ELSE '' END], lambda x: x <> '')"
)
add(
    "c28_header_variants", "manifest_entries", "id", "title", lambda c: F.size(X.header_variants(c)),
    f"len(list_distinct(list_filter(list_concat({_BASE}, list_concat(list_transform({_BASE}, lambda x: '### ' || x), list_transform({_BASE}, lambda x: '#### ' || x))), lambda x: length(x) >= 3)))",
    where="title is not null",
)


def _pages():
    """A span group's pages as a list like '3-5', put right; a missing page is the other one."""
    ends = F.coalesce("start_page", "end_page"), F.coalesce("end_page", "start_page")
    return F.concat(F.least(*ends).cast("string"), F.lit("-"), F.greatest(*ends).cast("string"))


add(
    "c33_page_list", "span_groups", "group_id", "title",
    lambda c: F.array_join(X.page_list(F.concat(_pages(), F.lit(",1"))), ","),
    "array_to_string(list_concat(range(least(coalesce(start_page, end_page), coalesce(end_page, start_page)), greatest(coalesce(start_page, end_page), coalesce(end_page, start_page)) + 1), [1]), ',')",
    where="start_page is not null or end_page is not null",
)
add(
    "c30_span_text", "pdf_lines", "line_id", "spans", X.span_text,
    # every span as a letter for bold or plain and its text, folded from an empty start
    r"""list_reduce(list_prepend('', list_transform(list_filter($c, lambda s: replace(coalesce(s.text, ''), chr(173), '') <> ''),
      lambda s: CASE WHEN regexp_matches(lower(coalesce(s.font, '')), 'dingbat|wingding|arrows|symbol|zapf') THEN 'p' || replace(replace(s.text, '3', '▶'), chr(173), '')
      WHEN coalesce(s.flags, 0) & 16 <> 0 OR regexp_matches(lower(coalesce(s.font, '')), 'bold|black|heavy') THEN 'b' || replace(s.text, chr(173), '') ELSE 'p' || replace(s.text, chr(173), '') END)),
      lambda acc, x: CASE WHEN ends_with(acc, '**') AND x[1] = 'b' AND length(acc) > 4 THEN acc[:-3] || x[2:] || '**' WHEN x[1] = 'b' THEN acc || '**' || x[2:] || '**' ELSE acc || x[2:] END)""",
    where="spans is not null",
)
add(
    "c15_artifact_header", "span_groups", "group_id", "title",
    lambda c: X.artifact_header(F.col("group_id"), F.coalesce(c, F.lit("")), F.coalesce("span_type", F.lit("")), F.array(F.lit("base"), F.lit("context")), F.coalesce(F.col("start_page").cast("string"), F.lit(""))),
    "'<!-- db:id=' || group_id || ' type=' || coalesce(span_type, '') || ' product_tier=base,context pages=' || coalesce(start_page::VARCHAR, '') || ' -->' || chr(10) || '### ' || coalesce($c, '') || ' | ' || group_id || chr(10)",
    where="group_id is not null",
)
