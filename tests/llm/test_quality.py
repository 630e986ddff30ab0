import pytest
from pyspark.sql import functions as F

from leafquarry.llm.quality import failed_rules, kind_of, statistics

PROSE = "The working group found that readers who compare the two versions also notice what has changed between them. "


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        (PROSE * 3, "prose"), ((PROSE * 3).replace(". ", " "), "prose"), ("\n".join((PROSE * 3)[i : i + 50] for i in range(0, 300, 50)), "prose"),
        ("Die Lernende ergänzt die Übung, und die Rückmeldung beschreibt es für ein größeres Publikum.", "prose"),
        ("- one thing\n- another thing\n- third thing", "list"), ("1. paraphrase of tasks\n2. level of readers\n3. scale", "list"),
        ("accuracy\nactivity\nappendix\nbenchmark", "list"), ("Accuracy, emergent ...... 88\nReader, global ......... 9", "list"),
        ("- Can compare abstract activities\n- Can review frameworks;", "list"), ("| A | b |\n| --- | --- |\n| 1 | 2 |", "table"), ("B2;369;82%\nC1;n/a;✓", "table"),
        ("A1\tgrammar\t361\nB2\t\t5", "table"), ("A1        grammar      361\nB2        level        5", "table"),
        ("3689 66185 6252 1116 9482", "junk"), ("xvzk ghtrp bcdfg lmnpq rstvw", "junk"), ("%@=.+$~%^:+&:>~@&_#+//>@|^@", "junk"),
        ("task level " * 60, "junk"), ("L" + "Ã�Â�" * 40, "junk"), ("KkQ4homBusoG0opLi4yFd4AVajJR5xRxoBRjfoYEtaOX0M1zGs4mduu\n" * 2, "junk"), ("aaaa" * 30, "junk"),
        (PROSE * 4 + "\n- a thing\n- b thing", "prose"), (PROSE + "\n" + "- a thing of note\n" * 20, "list"),
    ],
)
def test_kinds(spark, text, kind):
    assert spark.createDataFrame([(text,)], "text string").select(kind_of(F.col("text"))["kind"]).first()[0] == kind


def test_null_and_blank(spark):
    df = spark.createDataFrame([(None,), ("  \n\t",), ("",), ("\u3000\u2028\r\n",)], "text string")
    assert {r[0] for r in df.select(kind_of(F.col("text"))).collect()} == {None}


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "The cat sat. \n- a b\n\nend", "x"), (4, "x " * 300_000, "x")], "k int, text string, kind string")
    got = {r.k: r for r in statistics(df).withColumn("q", kind_of(F.col("text"))).collect()}
    assert got[1].n_words is None and got[1].q is None and got[2].n_words == 0 and got[2].mean_word_length is None
    assert got[3].n_words == 7 and got[3].punct_line_share == pytest.approx(1 / 3, abs=1e-5) and got[3].bullet_line_share == pytest.approx(1 / 3, abs=1e-5)
    assert got[4].q.kind == "junk" and got[4].n_words == 300_000
    assert kind_of(F.col("text")) is not None and df.limit(0).select(kind_of(F.col("text"))).count() == 0
