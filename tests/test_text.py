import pytest
from pyspark.sql import functions as F

from leafquarry.functions import repairs as R
from leafquarry.functions import text as X


def one(spark, fn, *values):
    names = [f"c{i}" for i in range(len(values))]
    row = spark.createDataFrame([values], ", ".join(f"{n} {'int' if isinstance(v, int) else 'string'}" for n, v in zip(names, values)))
    return row.select(fn(*[F.col(n) for n in names]).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("fn", "value", "want"),
    [
        (lambda c: X.slugify(c, "scale"), "Strategies: explain (new) concept!", "scale_strategies_explain_new_concept"),
        (X.slugify, "***", "untitled"),
        (lambda c: X.slugify(c, "scale"), "***", "scale"),
        (X.fix_broken_words, "Schöpfö- ärger a- b- c", "Schöpföärger ab- c"),
        (X.sanitize_urls, "https:// a.org/x", "https://a.org/x"),
        (X.sanitize_urls, "https://a.org/1680667a2d.24.ALTE book", "https://a.org/1680667a2d\n24. ALTE book"),
        (X.bullet_line, "▶ item", "- item"),
        (X.reverse_word, "(cfiiceps)", "(speciifc)"),
        (X.reverse_line, "nettirw a txet", "text a written"),
        (X.escape_cell, "Turntaking\nCo-operating", "Turntaking<br>Co-operating"),
        (X.escape_cell, "long phrase\ncontinues | here", "long phrase continues \\| here"),
        (X.heading_depth, "3.1.1. Oral", 4),
        (X.numbered_heading, "3.1.1. Oral", "#### 3.1.1. Oral"),
        (X.skeleton, "The ˇanimal over ·there | is my ˎdog.", "the animal over there is my dog"),
        (X.page_list, "1,3-5, x", [1, 3, 4, 5]),
        (X.midword_high, "pre'fer don't", "preˈfer don't"),
        (X.bold_normal, "**Bold** **joined** text", "**Bold joined** text"),
        (X.english_score, "", 0.0),
        (X.is_gibberish, "short", False),
        (X.cutoff, "# t\nEnds here.\n- x", None),
        (X.cutoff, "A line of prose that ends without", "A line of prose that ends without"),
        (X.cutoff, "Too short", None),
        (R.tone_marks, "'people ad,dress I \"yes", "ˈpeople adˎdress | ˇyes"),
        (R.fix_reversed_title, "txet nettirw gnidnatsrednU", "Understanding written text"),
        (R.fix_reversed_title, "Understanding written text", "Understanding written text"),
    ],
)
def test_scalars(spark, fn, value, want):
    assert one(spark, fn, value) == want


def test_null_stays_null(spark):
    df = spark.createDataFrame([(None,)], "c string")
    for fn in (X.slugify, X.fix_broken_words, X.fix_typos, X.sanitize_urls, X.bullet_line, X.skeleton, X.english_score, R.tone_marks, R.fix_reversed_title):
        assert df.select(fn(F.col("c")).alias("r")).first()["r"] is None
    assert df.select(X.escape_cell(F.col("c")).alias("r")).first()["r"] == ""


def test_tables(spark):
    df = spark.createDataFrame([([["a", "b"], ["1"]],), ([["", ""], ["", ""]],), ([],)], "t array<array<string>>")
    got = [r["r"] for r in df.select(X.table_markdown(F.col("t")).alias("r")).collect()]
    assert got == ["| a | b |\n| --- | --- |\n| 1 |  |", "", ""]
    assert one(spark, X.table_rows, "| a |  b||") == ["a", "b", ""]
    assert one(spark, X.table_rows, "| --- |") is None


def test_spans(spark):
    df = spark.createDataFrame([([("Bold ", "Serif-Bold", 0), ("more", "x", 16), (" plain", "x", 0), ("3", "Wingdings", 0)],)], "s array<struct<text:string,font:string,flags:int>>")
    assert df.select(X.span_text(F.col("s")).alias("r")).first()["r"] == "**Bold more** plain▶"


@pytest.mark.parametrize(
    ("token", "url", "trail"),
    [
        ("https://a.org/x).", "https://a.org/x", ")."), ("https://a.org/x**", "https://a.org/x", "**"), ("no url.", "no url.", ""), ("https://a.org/x.12", "https://a.org/x", ".12"),
        ("https://a.org/x12", "https://a.org/x12", ""), ("http://…", "http://…", ""), ("https://", "https://", ""),
    ],
)
def test_urls_peel(spark, token, url, trail):
    assert tuple(one(spark, R.peel_url, token)) == (url, trail)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("See https://a.org/x /y/z.html and more", "See https://a.org/x/y/z.html and more"), ("(https://a.org/x) next. aspx", "(https://a.org/x) next. aspx"),
        ("https://a.org/details. aspx?id=1 text", "https://a.org/details.aspx?id=1 text"), ("https://a.org/1680 667a2d rest", "https://a.org/1680667a2d rest"),
        ("https://a.org/x. The next", "https://a.org/x. The next"), ("https://a.org/x.Next one", "https://a.org/x. Next one"),
        ("a https://a.org/x.7.Éloge b http:// b.org/q", "a https://a.org/x\n7. Éloge b http://b.org/q"), ("12.Title\nplain 3.4", "12. Title\nplain 3.4"), ("", ""), ("no address here", "no address here"),
    ],
)
def test_urls_closed(spark, text, want):
    assert one(spark, X.sanitize_urls, text) == want


def test_footnotes_after_urls(spark):
    assert one(spark, X.split_glued_footnotes, "at https://a.org/x 12. Title, https://b.org 3 x") == "at https://a.org/x\n12. Title, https://b.org 3 x"


@pytest.mark.parametrize(
    ("title", "want"),
    [
        (").cte ,smargaid ,shparg( ni atad gninialpxE", "Explaining data in graphs, diagrams (etc.)"), ("Plain title, of two parts", "Plain title, of two parts"),
        ("GNITIRW", "WRITING"), ("puorg a ni gnitaroballoC", "Collaborating in a group"), ("", ""), ("level", "level"),
    ],
)
def test_titles_read_backwards(title, want):
    assert R.forward_title(title) == want


def test_garbled_ids(spark):
    df = spark.createDataFrame([("scale_gnittup_a_case",), ("table_txet",), ("scale_writing",), ("a-nettirw-b",), (None,)], "i string")
    assert [r["r"] for r in df.select(R.garbled_id(F.col("i")).alias("r")).collect()] == [True, True, False, True, False]


def test_no_number_is_cut(spark):
    assert one(spark, X.page_list, "1234567,3-4,99999999999,2-x") == [1234567, 3, 4]
    assert tuple(one(spark, X.toc_title_page, "- Title — 12345")) == ("Title", 12345)
    assert [b["id"] for b in one(spark, X.artifact_bodies, "x<!-- db:id=a -->1<!-- db:id=b t -->2")] == ["a", "b"] and one(spark, X.artifact_bodies, "") == []


def test_bands_and_stacks():
    assert R.stitched(["The quick brown fox jumps", "brown fox jumps over it", None, "", "over it"]) == ["The quick brown fox jumps over it"]
    box = lambda x, y, h: {"x0": x, "y0": y, "x1": x + 50, "y1": y + h}
    assert len(R.stacked([box(0, 0, 10), box(0, 22, 10)])) == 1
    assert len(R.stacked([box(0, 0, 10), box(0, 22.1, 10)])) == 2


def test_reading_order_is_a_merge():
    el = lambda k, x0, y0, x1, y1: {"kind": k, "x0": x0, "y0": y0, "x1": x1, "y1": y1}
    page = [el("table", 300, 100, 500, 200), el("prose", 50, 120, 250, 130), el("prose", 50, 300, 500, 310), el("prose", 50, 20, 500, 30)]
    assert R.reading_order(page, 595) == [3, 1, 0, 2]


def test_first_difference():
    assert R.first_difference("abc", "abc") == -1
    assert R.first_difference("abc", "abd") == 2
    assert R.first_difference("", "x") == 0


def test_title_scores_and_opcodes(spark):
    assert one(spark, lambda c: R.title_score(c), "written text") > one(spark, lambda c: R.title_score(c), "nettirw txet") and one(spark, R.title_score, "") == 0.0
    df = spark.createDataFrame([(["a", "b", "c"], ["a", "x", "c", "d"]), (None, ["a"])], "o array<string>, n array<string>")
    got = [[(x.tag, x.old_from, x.old_to, x.new_from, x.new_to) for x in r["r"]] for r in df.select(R.opcodes(F.col("o"), F.col("n")).alias("r")).collect()]
    assert got == [[("equal", 0, 1, 0, 1), ("replace", 1, 2, 1, 2), ("equal", 2, 3, 2, 3), ("insert", 3, 3, 3, 4)], [("insert", 0, 0, 0, 1)]]


def test_clean_ids(spark):
    df = spark.createDataFrame([("scale_nettirw_txet", "txet nettiW"), ("table_02_changes", "Table 2")], "i string, t string")
    got = [r["r"] for r in df.select(R.clean_id(F.col("i"), F.col("t")).alias("r")).collect()]
    assert got[0].startswith("scale_") and "txet" not in got[0] and got[1] == "table_02_changes"


def test_fills_and_titles(spark):
    df = spark.createDataFrame([([0.81, 0.82, 0.91],), ([1.0, 1.0, 1.0],), ([0.0, 0.0, 0.0],), ([0.9],), (None,)], "f array<double>")
    assert [r["r"] for r in df.select(X.is_callout_fill(F.col("f")).alias("r")).collect()] == [True, False, False, False, False]
    two = spark.createDataFrame([("nettirw txet", "written text"), ("written text", "B2"), ("written text", None), (None, "x")], "h string, t string")
    assert [r["r"] for r in two.select(R.preferred_title(F.col("h"), F.col("t")).alias("r")).collect()] == ["written text", "written text", "written text", "x"]
