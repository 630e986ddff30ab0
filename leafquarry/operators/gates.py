"""Gates over the pages of Markdown texts: golden specifications, contracts given as rows, and checks of whole chunks.

What one document must hold is data: a specification or a rule is a row that names a document and a page, so one join
by (doc_id, page) tests any number of them and nothing about a document is code. All gates give issue rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .issues import issue, united

# Markers, figures, boxes and page feet as the texts write them.
MARK = r"<!--\s*page:([0-9]+)\s*-->"
FIRST_FIGURE = r"(?s)(?:!\[[^\]]*\]\([^)]*figure_[0-9]+[^)]*\.png\)|<!--\s*db:id=figure_).*"
FIGURE_NUMBER = r"(?i)<!--\s*db:id=figure_[0-9]+_|###\s+Figure\s+[0-9]+\b"
BOX = r"(?ms)(^>\s*\*\*.*)"
FOOT = r"(?m)^[0-9]{1,2}\.\s|Page\s+\*\*"
SPEC = (
    "doc_id string, page int, must_have array<string>, must_not_have array<string>, must_not_have_after_image array<string>, "
    "must_not_have_after_diagram_fence array<string>, max_title_count map<string,int>, max_heading_count map<string,int>, "
    "figure_order array<int>, callout_placement string"
)
RULE = "doc_id string, page int, rule string, subject string, object string"
_ISSUES = "array<struct<check:string,detail:string>>"


def page_bodies(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, page, body of the pages of texts whose pages end with their marker; of two of one number the first counts."""
    parts = F.split(text, MARK, -1)
    numbers = F.regexp_extract_all(text, F.lit(MARK), F.lit(1))
    rows = docs.select("doc_id", F.posexplode(F.transform(numbers, lambda n, i: F.struct(n.try_cast("int").alias("page"), F.get(parts, i).alias("body")))).alias("k", "p"))
    return rows.groupBy("doc_id", F.col("p.page").alias("page")).agg(F.min_by("p.body", "k").alias("body")).where("page is not null")


def _found(check: str, detail: Column) -> Column:
    return F.struct(F.lit(check).alias("check"), detail.alias("detail"))


def _each(phrases: str, bad, check: str = "V-ADJ-GOLDEN", label: str = "") -> Column:
    """Issues of the phrases of an array for which `bad` holds."""
    said = F.coalesce(F.col(phrases), F.array().cast("array<string>"))
    return F.transform(F.filter(said, lambda p: F.coalesce(bad(p), F.lit(False)) & (p != "")), lambda p: _found(check, F.concat(F.lit(label or phrases + ": "), p)))


def _counted(limits: str, times) -> Column:
    pairs = F.coalesce(F.map_entries(limits), F.array().cast("array<struct<key:string,value:int>>"))
    return F.transform(F.filter(pairs, lambda e: times(e["key"]) > e["value"]), lambda e: _found("V-ADJ-GOLDEN", F.concat(F.lit(limits + ": "), e["key"])))


def _when(test: Column, check: str, detail: str) -> Column:
    return F.when(F.coalesce(test, F.lit(False)), F.array(_found(check, F.lit(detail)))).otherwise(F.array().cast(_ISSUES))


def after_image(body: Column) -> Column:
    """The body from its first figure on; empty where it has none."""
    return F.regexp_extract(body, FIRST_FIGURE, 0)


def after_diagram(body: Column) -> Column:
    """The body behind its last text diagram; empty where it has none."""
    return F.regexp_extract(body, r"(?s)\A.*(?m:^```text[^\n]*$).*?(?m:^```[ \t]*$)(.*)\z", 1)


def golden_issues(bodies: DataFrame, specs: DataFrame) -> DataFrame:
    """Issues of golden specifications (columns of SPEC, null asserts nothing): phrases that must or must not stand on a
    page, behind its figure or its diagram, counts of titles and headings, the order of figures, the place of a box."""
    body = F.col("body")
    lines = lambda b: F.split(b, "\n")
    times = lambda p: (F.length(body) - F.length(F.replace(body, p, F.lit("")))) / F.length(p)
    headings = lambda p: F.when(p.startswith("###"), F.size(F.filter(lines(body), lambda x: F.lower(F.rtrim(x)) == F.lower(F.rtrim(p))))).otherwise(times(p))
    numbers = F.transform(F.regexp_extract_all(body, F.lit(FIGURE_NUMBER), F.lit(0)), lambda x: F.regexp_extract(x, "([0-9]+)", 1).cast("int"))
    seen, wanted = F.array_distinct(numbers), F.coalesce("figure_order", F.array().cast("array<int>"))
    disordered = F.filter(wanted, lambda n: F.array_contains(seen, n)) != F.filter(seen, lambda n: F.array_contains(wanted, n))
    box = F.regexp_extract(body, BOX, 1)
    inner = F.split(F.split(box, r"\n[0-9]{1,2}\.\s", 2)[0], r"\nPage\s+\*\*", 2)[0]
    long_prose = F.exists(lines(inner), lambda x: (F.length(F.trim(x)) > 120) & ~F.trim(x).rlike(r"^(?:>|<!--|#|\*|\|)"))
    at_end, at_top = (F.col("callout_placement") == "end_body") & (box != ""), (F.col("callout_placement") == "top_left") & (box != "")
    every = F.concat(
        _each("must_have", lambda p: ~F.contains(body, p)), _each("must_not_have", lambda p: F.contains(body, p)),
        _each("must_not_have_after_image", lambda p: F.contains(after_image(body), p)), _each("must_not_have_after_diagram_fence", lambda p: F.contains(after_diagram(body), p)),
        _counted("max_title_count", times), _counted("max_heading_count", headings), _when(disordered, "V-ADJ-GOLDEN", "figure_order"),
        _when(at_end & ~box.rlike(FOOT), "V-ADJ-CALLOUT-PLACE", "not before the page's foot"),
        _when(at_end & long_prose, "V-ADJ-CALLOUT-PLACE", "prose behind it"),
        _when(at_top & (F.length(body) - F.length(box) > F.length(body) * 0.45), "V-ADJ-CALLOUT-PLACE", "late on the page"),
    )
    met = specs.join(bodies.select("doc_id", "page", "body"), ["doc_id", "page"], "left")
    found = F.when(body.isNull(), F.array(_found("V-ADJ-GOLDEN", F.lit("page missing")))).otherwise(every)
    return _rows(met, found)


def _rows(df: DataFrame, found: Column) -> DataFrame:
    rows = df.select("doc_id", "page", F.explode(found).alias("x"))
    return issue(rows, F.col("x.check"), "hard", page=F.col("page"), detail=F.col("x.detail"))


def contract_issues(bodies: DataFrame, rules: DataFrame) -> DataFrame:
    """Issues of contracts on pages, one rule a row (columns of RULE).

    id: the page holds the artifact `subject`. figures: it holds all of the ids in `subject`, parted by commas. quoted:
    the title `subject`, if it is there, stands in bold at the start of a quote. order: `subject` stands before
    `object`, both present. link: within 400 characters behind `subject`, if it is there, stands `object`.
    no_label: behind the page's diagram no bold text holds `subject`.
    """
    body, subject, other, rule = F.col("body"), F.col("subject"), F.col("object"), F.col("rule")
    at = lambda x: F.instr(body, x)
    has = lambda x: F.contains(body, x)
    missing = F.filter(F.split(subject, ","), lambda x: ~has(F.trim(x)))
    quote = F.exists(F.split(body, "\n"), lambda x: x.rlike(r"^>\s*\*\*.*\*\*") & F.contains(F.lower(x), F.lower(F.left(subject, F.lit(18)))))
    near = F.contains(F.substring(body, at(subject), F.length(subject) + 400), other)
    bold = F.exists(F.regexp_extract_all(after_diagram(body), F.lit(r"\*\*[^*]+\*\*"), F.lit(0)), lambda x: F.contains(F.lower(x), F.lower(subject)))
    case = (
        F.when(body.isNull(), _found("V-PAGE-MISSING", rule))
        .when((rule == "id") & ~has(F.concat(F.lit("id="), subject)), _found("V-KNOWN-TABLE", subject))
        .when((rule == "figures") & (F.size(missing) > 0), _found("V-FIG-MULTI", F.array_join(missing, ",")))
        .when((rule == "quoted") & F.contains(F.lower(body), F.lower(F.left(subject, F.lit(20)))) & ~quote, _found("V-CALLOUT-FMT", subject))
        .when((rule == "order") & ((at(subject) == 0) | (at(other) == 0) | (at(subject) > at(other))), _found("V-ORDER", subject))
        .when((rule == "link") & has(subject) & ~near, _found("V-LINK-GUIDE", subject))
        .when((rule == "no_label") & bold, _found("V-FIG-SOUP", subject))
    )
    met = rules.join(bodies.select("doc_id", "page", "body"), ["doc_id", "page"], "left")
    return _rows(met, F.filter(F.array(case), lambda x: x.isNotNull()))


# Gates over whole texts as (code, pattern); every place is an issue.
TEXT_GATES = [
    ("V-URL-SPACE", r"https?://\s+\S+"),
    ("V-URL-SPACE", r"(?i)https?://[^\s\)\]<>\"']*\.\s+(?:aspx|html?|php|pdf|json)\b"),
    ("V-URL-SPACE", r"https?://[^\s\)\]<>\"']*\s+[0-9a-fA-F]{4,}\b"),
    ("V-EMPTY-TABLE", r"\|\s*\|\n\|\s*---\s*\|\s*\n\|\s*\|"),
]


def text_issues(docs: DataFrame) -> DataFrame:
    """Issues of whole texts: blanks inside web addresses, empty tables, pictures far from their artifact's marker."""
    places = F.concat(*[_places(c, p) for c, p in TEXT_GATES])
    pieces = F.split("text", r"(?=!\[[^\]]*\]\(assets/figures/figure_)", -1)
    ids = lambda x: F.regexp_extract(x, r"^!\[[^\]]*\]\(assets/figures/(figure_[^)/]+)\.png\)", 1)
    before = lambda i: F.right(F.array_join(F.slice(pieces, F.lit(1), i), ""), F.lit(2000))
    far = F.transform(pieces, lambda x, i: F.when((i > 0) & (ids(x) != "") & ~F.contains(before(i), F.concat(F.lit("db:id="), ids(x))), _found("V-FIG-PNG-LOC", ids(x))))
    rows = docs.where("text is not null").select("doc_id", F.lit(None).cast("int").alias("page"), F.concat(places, F.filter(far, lambda x: x.isNotNull())).alias("_f"))
    return _rows(rows, F.col("_f"))


def _places(check: str, pattern: str) -> Column:
    return F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), lambda x: _found(check, F.left(x, F.lit(80))))


def chunk_issues(docs: DataFrame, assets: DataFrame) -> DataFrame:
    """Issues of chunks: ids that occur more than once, unreadable text right under a third-level heading, and pictures
    whose file is not among the assets (doc_id, path)."""
    known = docs.where("text is not null")
    ids = known.select("doc_id", F.explode(X.db_ids(F.col("text"))).alias("i")).groupBy("doc_id", "i").count().where("count > 1")
    sections = F.regexp_extract_all("text", F.lit(r"###[^\n]+\n\n([\s\S]{0,800})"), F.lit(1))
    unread = known.select("doc_id", F.explode(F.filter(sections, lambda s: X.is_gibberish(s))).alias("s"))
    asked = known.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"!\[[^\]]*\]\((assets/[^)]+)\)"), F.lit(1))).alias("path"))
    lost = asked.join(assets.select("doc_id", "path"), ["doc_id", "path"], "left_anti")
    return united([
        issue(ids, "duplicate_id", "hard", detail=F.col("i")), issue(unread, "gibberish", "hard", detail=F.left("s", F.lit(120))),
        issue(lost, "missing_asset", "hard", detail=F.col("path")),
    ])


def regression(issues: DataFrame, docs: DataFrame) -> DataFrame:
    """The verdict on every document: doc_id, hard, soft, passed (no hard issue), codes (the checks that failed, in order)."""
    counts = issues.groupBy("doc_id").agg(
        F.count_if(F.col("severity") == "hard").alias("hard"), F.count_if(F.col("severity") == "soft").alias("soft"), F.array_join(F.array_sort(F.collect_set("check")), ",").alias("codes")
    )
    met = docs.select(F.col("doc_id").cast("string").alias("doc_id")).distinct().join(counts, "doc_id", "left")
    return met.select("doc_id", F.coalesce("hard", F.lit(0)).alias("hard"), F.coalesce("soft", F.lit(0)).alias("soft"), (F.coalesce("hard", F.lit(0)) == 0).alias("passed"), F.coalesce("codes", F.lit("")).alias("codes"))


def enriched(issues: DataFrame, docs: DataFrame) -> DataFrame:
    """Issues with the line and the surroundings of their detail in the text; null where it does not stand there."""
    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    at = F.instr("text", F.col("detail"))
    met = issues.join(texts, "doc_id", "left")
    here = lambda c: F.when(at > 0, c)
    return met.select("check", "severity", "doc_id", "page", "detail", here(X.line_of_position(F.col("text"), at - 1)).alias("line_no"), here(X.snippet(F.col("text"), at - 1)).alias("snippet"))
