import random

import pytest
from pyspark.sql import functions as F

from leafquarry.llm import scans as S

WORDS = {w: 50 for w in "the level of each register is linked to a transactional glossary and portfolio interaction criterion replaces tasks should self assessment curriculum another in for review formal".split()}
WORDS |= {"self-assessment": 60}
ROWS = "kind string, row_id long, doc string, page int, no int, y0 double, x0 double, size double, text string, form string"


@pytest.fixture(scope="module")
def decoder():
    return S.Decoder(WORDS)


@pytest.mark.parametrize(
    ("noisy", "right"),
    [
        ("gl0ssary", ("glossary",)), ("portfo1io", ("portfolio",)), ("replaccs", ("replaces",)), ("curriculurn", ("curriculum",)), ("cr1terion", ("criterion",)),
        ("hnked", ("linked",)), ("anotlier", ("another",)), ("shoulcl", ("should",)), ("transactionallevel", ("transactional", "level")), ("tasksshould", ("tasks", "should")),
        ("level", ("level",)), ("levels", ("levels",)), ("self-assessment", ("self-assessment",)), ("self-asse5sment", ("self-assessment",)), ("zzqqy", None), ("lével", ("lével",)),
    ],
)
def test_words(decoder, noisy, right):
    assert decoder.decode(noisy) == right


def test_capitals_of_sharp_s():
    assert S.Decoder({"größenvergleich": 9, "level": 9}).decode("grössenvergleich") == ("grössenvergleich",)


@pytest.mark.parametrize(
    ("form", "right", "misread"),
    [
        ("the learn3r’s gl0ssary", "the learner’s glossary", True), ("the learner’s glossary", "the learner’s glossary", False), ("the register’s level", "the register’s level", False), ("Glossary–Portfo1io.", "Glossary–Portfolio.", True),
        ("the glossary–portfolio", "the glossary–portfolio", False), ("gl0ssарy", "gl0ssарy", False), ("the–γλ0σσα", "the–γλ0σσα", False),
    ],
)
def test_apostrophes_and_dashes(form, right, misread):
    assert S.decode_stream(S.Decoder(WORDS | {"learner's": 50}), [form], None, None) == [(right, False, misread)]


def test_lexicon_writes_one_apostrophe(spark):
    assert S.lexicon(spark.createDataFrame([("The learner’s level",), ("A learner's level",)], "form string"), rate=1e-9)["learner's"] == 2


def test_splits_and_breaks(decoder):
    assert decoder.joins("inter", "action") and decoder.joins("glos", "sary") and not decoder.joins("the", "level")
    assert decoder.break_at("glos", "sary") and not decoder.break_at("self", "assessment") and not decoder.break_at("self", "asse5sment")
    assert decoder.break_at("port", "fo1io")


def test_a_stream_is_read_as_a_whole(decoder):
    read = S.decode_stream(decoder, ["The inter action of gl0s-", "sary tasksshould be self-", "assessment cri-"], "port-", "terion")
    assert read == [("The interaction of glossary", True, True), ("tasks should be self-", False, True), ("assessment criterion", True, False)]
    assert S.decode_stream(decoder, ["folio level"], "port-", None) == [("level", False, False)]
    assert S.decode_stream(decoder, [], None, None) == [] and S.decode_stream(decoder, [""], "a", "b") == [("", False, False)]


def test_the_path_weighs_words_against_their_neighbours():
    d = S.Decoder({"contra": 300, "contrast": 2, "state": 500, "ate": 40})
    # the first two can be one word and the last two can; read from the left the rarer word would win
    assert d.joins("contra", "st") and d.joins("st", "ate")
    assert S.decode_stream(d, ["contra st ate"], None, None) == [("contra state", False, True)]


def test_many_confusions_and_long_words():
    d = S.Decoder({"misunderstandings": 5, "a" * 40: 3, "level": 9, "filling": 2})
    assert d.confused("rn1sunder5tand1ng5") == "misunderstandings" and d.confused("fi11in9") == "filling"
    assert d.decode("a" * 40 + "level") == ("a" * 40, "level")
    assert d.confused("x" * 3000) is None


def brute_breaks(lines):
    n, best = len(lines), (9e9, [])
    for mask in range(1 << (n - 1)):
        at = [0, *(i for i in range(1, n) if mask >> (i - 1) & 1)]
        best = min(best, (round(S.paragraph_cost(lines, at), 6), at))
    return best


def test_paragraph_choice_against_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        lines = [(rng.choice(["short", "A longer row of text that ends.", "lower case row of text going on", "- item", "TITLE"]), rng.choice([None, 70.0, 90.0]), rng.choice([10.5, 14.0]), rng.random() < 0.3) for _ in range(rng.randint(1, 9))]
        assert round(S.paragraph_cost(lines, S.break_rows(lines)), 6) == brute_breaks(lines)[0]
    many = [("a long row of running text that never ends, with more of it", 70.0 + 10 * (i % 2), 10.5, False) for i in range(5000)]
    assert S.break_rows(many) == [0]  # however much joining costs in all


def rows(spark, data):
    return spark.createDataFrame([(*r, "clash") for r in data], ROWS)


def test_defects(spark):
    data = [
        ("line", 1, "d", 1, 1, 30.0, 70.0, 8.5, "The register guide"), ("line", 2, "d", 1, 2, 90.0, 70.0, 10.5, "Each gl0ssary is linked to a port-"),
        ("line", 3, "d", 1, 3, 100.0, 70.0, 10.5, ""), ("line", 4, "d", 1, 4, 110.0, 70.0, 10.5, "folio and the inter action of self-"), ("line", 5, "d", 1, 5, 780.0, 70.0, 8.5, "I5"),
        ("line", 6, "d", 2, 1, 90.0, 70.0, 10.5, "assessment tasks. The regi­"), ("line", 7, "d", 2, 2, 100.0, 70.0, 10.5, "ster"), ("line", 7, "d", 2, 2, 100.0, 70.0, 10.5, "ster"),
        ("line", 8, "d", 2, 3, None, 70.0, 8.5, "2"), ("line", 9, "d", 2, 4, None, 70.0, 10.5, None), ("tok", 1, "d", 1, 1, 100.0, 1.0, 10.5, "crit¬"),
        ("tok", 2, "d", 1, 2, 100.0, 1.0, 10.5, "erion"), ("line", 10, "e", 1, 1, 100.0, 1.0, None, "23"),
    ]
    got = {(r.kind, r.row_id, r.defect) for r in S.defects(rows(spark, data), WORDS).collect()}
    assert got == {
        ("line", 1, "furniture"), ("line", 2, "hyphen"), ("line", 2, "misread"), ("line", 4, "misread"), ("line", 5, "furniture"),
        ("line", 6, "hyphen"), ("line", 8, "furniture"), ("tok", 1, "hyphen"),
    }


def test_paragraphs_are_continuous(spark):
    data = [
        ("line", 1, "d", 1, 1, 90.0, 70.0, 10.5, "Each glossary is linked to the level of a cri-"), ("line", 2, "d", 1, 2, 100.0, 70.0, 10.5, "terion and the portfolio."),
        ("line", 3, "d", 1, 3, 110.0, 70.0, 10.5, ""), ("line", 4, "d", 1, 4, 120.0, 70.0, 10.5, "Another register should replace the interaction"), ("line", 5, "d", 1, 5, 130.0, 70.0, 10.5, "of tasks."),
    ]
    got = [r.text for r in S.paragraphs(rows(spark, data), WORDS).orderBy("paragraph_no").collect()]
    assert got == ["Each glossary is linked to the level of a criterion and the portfolio.", "Another register should replace the interaction of tasks."]


def test_paragraphs_of_tokens(spark):
    data = [("line", 1, "d", 1, 1, 90.0, 70.0, 10.5, "The register is linked."), ("tok", 1, "d", 1, 1, 90.0, 70.0, 10.5, "Each gl0ssary is for"), ("tok", 2, "d", 1, 2, 100.0, 70.0, 10.5, "review.")]
    got = {(r.kind, r.doc, r.page, r.text) for r in S.paragraphs(rows(spark, data), WORDS).collect()}
    assert got == {("line", "d", 1, "The register is linked."), ("tok", "d", 1, "Each glossary is for review.")}


def test_paragraphs_query_reads_tokens(spark, tmp_path):
    from leafquarry.llm.queries import p5_paragraphs

    lines = [(1, "d", 1, 1, 90.0, 70.0, "The register is linked.", [("x", 10.5)])]
    toks = [(1, "d", 1, 1, 90.0, 70.0, 10.5, "Each glossary is for review.")]
    made = {
        "jobs": ([("d", "p", "page_png", "t", (3,), None)], "id string, publisher string, profile string, title string, source struct<expected_page_count: int>, received_at timestamp"),
        "pdf_lines": (lines, "line_id long, doc_id string, page int, line_no int, y0 double, x0 double, text string, spans array<struct<text: string, size: double>>"),
        "page_toks": (toks, "tok_id long, doc_id string, page int, tok_no int, y0 double, x0 double, size double, text string"),
        "glossary": ([("glossary",)], "term string"),
    }
    for name, (data, kind) in made.items():
        spark.createDataFrame(data, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    assert {(r.kind, r.doc_id, r.text) for r in p5_paragraphs(spark, str(tmp_path)).collect()} == {("line", "d", lines[0][6]), ("tok", "d", toks[0][7])}


def test_lexicon(spark):
    text = [("The level of self-assessment",)] * 3 + [("taneous level",), ("a port-",)]
    made = S.lexicon(spark.createDataFrame(text, "form string"), spark.createDataFrame([("Guide",), ("Guide",)], "form string"), 1e-9)
    assert made["level"] == 4 and made["self-assessment"] == 3 and made["guide"] == 2 and "taneous" not in made and "port" not in made


def test_empty(spark):
    none = rows(spark, [])
    assert S.defects(none, {}).count() == 0 and S.paragraphs(none, {}).count() == 0
    assert S.lexicon(none.select("form")) == {}
    assert S.defects(rows(spark, [("line", 1, "d", None, None, 100.0, 1.0, 10.0, "the level")]), {}).where(F.lit(True)).count() == 0
