from leafquarry.llm.look_alikes import consistent, matching_terms

TEXTS = "kind string, row_id long, text string, term string"


def test_terms(spark, rows):
    terms = spark.createDataFrame([(1, "café dialogue"), (2, "cafe dialogue"), (3, "co-operating"), (4, "cooperating"), (5, None), (None, "x")], "term_id long, term string")
    texts = [("line", 1, "café dialogue"), ("line", 2, "café dialogue"), ("line", 3, "сafe dialogue"), ("line", 4, "co‐operating"), ("tok", 5, "co­operating"),
             ("tok", 6, "CAFÉ DIALOGUE"), ("tok", 7, None), ("tok", 8, ""), ("line", 2, "café dialogue"), ("line", 9, "a" * 100_000)]
    df = spark.createDataFrame([(*t, "clash") for t in texts], TEXTS)
    assert rows(matching_terms(df, terms)) == [("line", 2, 1), ("line", 3, 2), ("line", 4, 3), ("tok", 5, 4)]
    assert matching_terms(df.limit(0), terms).count() == 0 == matching_terms(df, terms.limit(0)).count()
    assert consistent(df, fold_case=True).where("row_id = 6").first().text_form == "café dialogue"
