import unicodedata

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leafquarry.functions.look import LOOKALIKES, fold_look, look, look_casefold, squeezed


def test_same_look_same_form():
    for other in ("Ｈeading", "Неading", "Head​ing", "Hea­ding", "Heading﻿"):
        assert fold_look(other) == "Heading"
    assert fold_look("eﬃcient ﬁling") == "efficient filing"
    assert fold_look("résumé") == "résumé" != fold_look("resume")
    assert fold_look("task‑based　level") == "task-based level"
    assert fold_look("устная речь") == fold_look("уcтнaя peчь")
    assert fold_look("a\U0001d173b\U0001bca0c\u180ed") == "abcd" and fold_look("\u13aa\u13f4\u13df") == "GoC"[:0] + fold_look("\u13aa") + "BC"
    assert fold_look("Case") != fold_look("case")
    assert fold_look("a–b") != fold_look("a-b")


@given(st.text())
def test_folding_is_idempotent_and_composed(text):
    once = fold_look(text)
    assert fold_look(once) == once
    assert unicodedata.is_normalized("NFC", once)
    assert not any(c in LOOKALIKES for c in once)


def test_columns_keep_null_and_empty(spark, rows):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "Ａ  ｂ "), (4, "Ａ  ｂ ")], "k int, t string")
    made = df.select("k", look(F.col("t")).alias("a"), look_casefold(F.col("t")).alias("b"), squeezed(look(F.col("t"))).alias("c"))
    assert rows(made) == [(1, None, None, None), (2, "", "", ""), (3, "A  b ", "a  b ", "A b"), (4, "A  b ", "a  b ", "A b")]
