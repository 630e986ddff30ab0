import random

from pyspark.sql import functions as F

from leafquarry.operators import lines as L
from leafquarry.operators.formatting import format_documents

GAPS = [(1, 100.0, "a"), (2, 112.0, "b"), (3, 126.9, "c"), (4, 141.9, "d"), (5, 159.0, "- item"), (6, 170.0, "tail"), (7, 182.0, "")]


def test_no_repeats(spark):
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(["a", "a", "", "", "b", "b", "a"])], "doc_id string, line_no int, line string")
    assert [r.line for r in L.no_repeats(df, ["doc_id"]).orderBy("line_no").collect()] == ["a", "", "", "b", "a"]


def test_gap_paragraphs(spark):
    df = spark.createDataFrame([("d", *g) for g in GAPS], "doc_id string, line_no int, y0 double, text string")
    made = L.gap_paragraphs(df, ["doc_id"], "y0", "text", ["line_no"]).orderBy("paragraph").collect()
    assert [r.text for r in made] == ["a b c", "d", "- item tail"]


def test_rows_are_anchored_at_their_start(spark):
    entries = [(100.0, 300.0, "right"), (102.9, 10.0, "b"), (100.0, 5.0, "a"), (103.1, 10.0, "next")]
    df = spark.createDataFrame([([*map(tuple, entries)],)], "e array<struct<y:double,x:double,text:string>>")
    got = df.select(L.merge_same_row(F.col("e"), 3.0, 200.0).alias("r")).first()["r"]
    assert [(x.y, x.text) for x in got] == [(100.0, "a b"), (100.0, "right"), (103.1, "next")]


def test_chunk_ranges():
    assert L.chunk_ranges(60, []) == [(1, 25), (26, 50), (51, 60)]
    assert L.chunk_ranges(60, [(20, 30)]) == [(1, 30), (31, 55), (56, 60)]
    for seed in range(40):
        rng = random.Random(seed)
        spans = [(a, a + rng.randint(1, 40)) for a in (rng.randint(1, 150) for _ in range(6))]
        made = L.chunk_ranges(170, spans)
        assert [p for a, b in made for p in range(a, b + 1)] == list(range(1, 171))


def test_rebuild_round_trip(spark):
    texts = [(1, "a\n\nb"), (2, ""), (3, None), (4, "\n"), (5, "x" * 200_000 + "\ny")]
    df = spark.createDataFrame(texts, "doc_id int, text string")
    assert {r.doc_id: r.text for r in L.rebuilt(L.exploded(df), ["doc_id"]).collect()} == {k: t for k, t in texts if t is not None}


def test_page_bodies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "<p1>"), (3, "b"), (4, "<p2>"), (5, "c")], "line_no int, line string").withColumn("doc_id", F.lit(1))
    page = F.nullif(F.regexp_extract("line", r"^<p(\d+)>$", 1), F.lit(""))
    before = [r.page for r in L.page_of_line(df, ["doc_id"], page).orderBy("line_no").collect()]
    after = [r.page for r in L.page_of_line(df, ["doc_id"], page, after=True).orderBy("line_no").collect()]
    assert before == ["1", "1", "2", "2", None] and after == [None, "1", "1", "2", "2"]


def test_format_is_idempotent_and_keeps_fences(spark):
    text = "# Title\ntext\ntext\n• one\n\n• two\n```\n• raw\n• raw\n```\n\n\n\n<!-- page:1 -->\n*Page 1*\n<!-- page:1 -->\nsee https:// a.org/x **a** **b**"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id int, text string")
    once = format_documents(docs)
    got = {r.doc_id: r.text for r in once.collect()}
    assert set(got) == {1, 3}
    assert "```\n• raw\n• raw\n```" in got[1]
    assert "- one\n- two" in got[1] and "# Title\n\ntext\n- one" in got[1] and got[1].count("<!-- page:1 -->") == 1
    assert "https://a.org/x **a b**" in got[1] and "*Page 1*\n<!-- page:1 -->" in got[1]
    again = format_documents(spark.createDataFrame(list(got.items()), "doc_id int, text string"))
    assert {r.doc_id: r.text for r in again.collect()} == got


def test_format_is_idempotent_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    once = {r.doc_id: r.text for r in format_documents(docs).collect()}
    assert len(once) == docs.where("text is not null").count()
    again = format_documents(spark.createDataFrame(list(once.items()), "doc_id long, text string"))
    assert {r.doc_id: r.text for r in again.collect()} == once
