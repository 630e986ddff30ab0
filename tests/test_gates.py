from leafquarry.operators import gates as G


def test_pages_of_a_text(spark, rows):
    df = spark.createDataFrame([("d", "a<!-- page:1 -->b<!--page:2-->c<!-- page:1 -->d"), ("e", None), ("f", ""), ("g", "no page")], "doc_id string, text string")
    assert rows(G.page_bodies(df)) == [("d", 1, "a"), ("d", 2, "b")]


def test_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame([("d", "x<!-- page:1 -->", "clash"), ("e", None, "")], "doc_id string, text string, page string")
    bodies = G.page_bodies(docs)
    specs = spark.createDataFrame([("d", 1, *[None] * 8), ("e", 1, ["x"], *[None] * 7)], G.SPEC)
    assert [(r.doc_id, r.detail) for r in G.golden_issues(bodies, specs).collect()] == [("e", "page missing")]
    rules = spark.createDataFrame([("d", 1, "unknown", None, None), ("d", 1, "id", None, None)], G.RULE)
    assert G.contract_issues(bodies, rules).count() == 0 and G.contract_issues(bodies, rules.limit(0)).count() == 0
    assert G.text_issues(docs).count() == 0 and G.chunk_issues(docs, spark.createDataFrame([], "doc_id string, path string")).count() == 0


def test_verdict_and_surroundings(spark, rows):
    docs = spark.createDataFrame([("d", "line\nsee https:// a.org"), ("e", "fine")], "doc_id string, text string")
    found = G.text_issues(docs)
    assert rows(G.regression(found, docs)) == [("d", 1, 0, False, "V-URL-SPACE"), ("e", 0, 0, True, "")]
    one = G.enriched(found, docs).first()
    assert one.line_no == 2 and one.snippet == "line see https:// a.org"
