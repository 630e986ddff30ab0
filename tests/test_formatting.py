import pytest

from leafquarry.operators import formatting as M

STEP = dict(M.STEPS)


@pytest.mark.parametrize(
    ("step", "text", "want"),
    [
        ("inline bullets and list runs", "Aims: one; f second aim; f third\n►first ► second", "Aims: one;\n- second aim;\n- third\n- first\n- second"),
        ("inline bullets and list runs", "a list:f**Bold**", "a list:\n\n- **Bold**"),
        ("inline bullets and list runs", "- one; - two; f three;\nplain; - x", "- one\n- two\n- three\nplain;\n- x"),
        ("bold and section wraps", "under various\n\n**constraints** of\n\nSections\n\n5.1.1.3 and", "under various **constraints** of\n\nSections 5.1.1.3 and"),
        ("repeated lines", "a\na\n\n\nb\na", "a\n\n\nb\na"),
        ("repeated page markers", "<!-- page:1 -->\ntext\n<!-- page:1 -->\n<!-- page:2 -->", "<!-- page:1 -->\ntext\n<!-- page:2 -->"),
        ("soft wraps", "A line that goes\non here.\nAnother line.\n\nfree\n# Head\ntail", "A line that goes on here.\nAnother line.\n\nfree\n# Head\ntail"),
        ("soft wraps", "```\na line\nb line\n```", "```\na line\nb line\n```"),
        ("list repair", "- an item that\nruns on\n\n- next\n\n\nA paragraph of its own.", "- an item that runs on\n- next A paragraph of its own."),
        ("list repair", "- an item.\n\n- next.\n\nA paragraph of its own.", "- an item.\n- next.\n\nA paragraph of its own."),
        ("footnotes are no headings", "### 14. Title\n### 3.1. Title", "14. Title\n### 3.1. Title"),
        ("headings", "CHAPTER 2: Aims\n3.1.1. Oral\n# 3.1. x", "## CHAPTER 2: Aims\n#### 3.1.1. Oral\n# 3.1. x"),
        ("contents", "CONTENTS\n\nFOREWORD — 7\n\nAppendix 1: \n(a scale) — 9\n2.1. Aims — 12\n<!-- page:3 -->\nFIGURE 3 — 4\n<!-- page:12 -->\nFOREWORD — 7", "## Contents\n\n## Foreword — 7\n## Appendix 1: (a scale) — 9\n### 2.1. Aims — 12\n<!-- page:3 -->\n### FIGURE 3 — 4\n<!-- page:12 -->\nFOREWORD — 7"),
        ("named sections", "FOREWORD\nPREFACE WITH ACKNOWLEDGEMENTS\nforeword", "## Foreword\n## Preface with acknowledgements\nforeword"),
        ("trailing captions", "see 14. Page **21**\nPage **22**", "see 14.\n\nPage **21**\nPage **22**"),
        ("sections behind markers", "### 3.1. RECEPTION\n<!-- page:47 -->\n\n#### 3.1.1. Oral", "<!-- page:47 -->\n### 3.1. RECEPTION\n\n#### 3.1.1. Oral"),
        ("sections behind markers", "### 3.1. RECEPTION\n<!-- page:47 -->\ntext", "### 3.1. RECEPTION\n<!-- page:47 -->\ntext"),
        ("paragraph spacing", "One.\nTwo.\n- a\n- b\n**Bold**\nThree.", "One.\n\nTwo.\n- a\n- b\n**Bold**\n\nThree."),
        ("page blocks", "text\n<!-- page:4 -->\n\n*Page 4*\nmore\n*Page 5*\n<!-- page:5 -->\nend", "text\n\n*Page 4*\n<!-- page:4 -->\n\nmore\n\n*Page 5*\n<!-- page:5 -->\n\nend"),
        ("chapter openings", "text\nChapter 3\nTHE ACTION\nAPPROACH\nbody\nChapter 4 says more", "text\n\n## Chapter 3\nTHE ACTION APPROACH\n\nbody\nChapter 4 says more"),
        ("chapter openings", "Chapter 5 KEY ASPECTS\n\nbody", "## Chapter 5\nKEY ASPECTS\n\nbody"),
        ("heading spacing", "a\n# H\nb\n## Chapter 2\nTITLE\n# x\n## y", "a\n\n# H\n\nb\n\n## Chapter 2\nTITLE\n\n# x\n\n## y"),
        ("level callouts", "Level C2, termed Mastery,\nis not native.\nNext line", "- Level C2, termed Mastery, is not native.\nNext line"),
        ("leads glued to lists, collapsed quotes, web addresses and footnotes", "- signals (gestures, etc.). The linked concepts are described in the section above and in all the sections that follow it here", "- signals (gestures, etc.).\n\nThe linked concepts are described in the section above and in all the sections that follow it here"),
        ("leads glued to lists, collapsed quotes, web addresses and footnotes", "- signals (etc.). The end", "- signals (etc.). The end"),
        ("leads glued to lists, collapsed quotes, web addresses and footnotes", "> **Title** > > body > more\na > b", "> **Title**\n>\n> body\n>\n> more\na > b"),
        ("leads glued to lists, collapsed quotes, web addresses and footnotes", "see https:// a.org/x\n1.Title", "see https://a.org/x\n1. Title"),
        ("leads glued to lists, collapsed quotes, web addresses and footnotes", "at https://a.org/x 12. Title", "at https://a.org/x\n12. Title"),
        ("blank before captions", "note\nPage **3**", "note\n\nPage **3**"),
        ("labels under pictures", "![f](a.png)\nSustained monologue\nReading aloud\n\n## Next\nShort label", "![f](a.png)\n\n## Next\nShort label"),
        ("labels under pictures", "```text\nLeaf one\n```\nleaf one\nLeaf two\n# H\nleaf one", "```text\nLeaf one\n```\nLeaf two\n# H\nleaf one"),
        ("repeated box titles", "> **Can do**\n>\n> Can do\n> text", "> **Can do**\n>\n> text"),
        ("repeated box titles", "> **Can do**\n>\n> Can do: what it means", "> **Can do**\n>\n> what it means"),
        ("bold marks", "**a** **b**", "**a b**"),
        ("blank runs", "a\n\n \n\nb", "a\n\nb"),
        ("list blanks", "- a\n\n- b\n\nc", "- a\n- b\n\nc"),
    ],
)
def test_steps(spark, step, text, want):
    docs = spark.createDataFrame([(1, text)], "doc_id int, text string")
    made = M.format_documents(docs, [(step, STEP.get(step))]).first()["text"]
    assert made == want


def test_documents_stay_apart_and_nulls_go(spark):
    docs = spark.createDataFrame([(1, "Chapter 1"), (2, "TITLE\n- a"), (3, None), (4, "")], "doc_id int, text string")
    got = {r.doc_id: r.text for r in M.format_documents(docs).collect()}
    assert got == {1: "## Chapter 1", 2: "TITLE\n- a", 4: ""}


def test_pages_from_layout_lines(spark):
    rows = [
        ("d", 1, 1, "3.1. Reception activities", 10.5), ("d", 1, 2, "Readers com-", 10.5), ("d", 1, 3, "pare two versions", 10.5), ("d", 1, 4, "and notice.", 10.5), ("d", 1, 5, "", None),
        ("d", 1, 6, "• one item that", 10.5), ("d", 1, 7, "runs on", 10.5), ("d", 1, 8, "• two", 10.5), ("d", 2, 1, "A tall line", 14.0), ("d", 2, 2, "Text of it.", 10.5),
        ("d", 2, 3, "Figure 3 – The tree", 10.5), ("d", 2, 4, "Short label", 10.5), ("d", 2, 5, "KEY ASPECTS", 10.5), ("d", None, 1, "no page", 10.5), ("d", 3, 1, None, 10.5),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id string, page int, line_no int, text string, size double, line string")
    got = {r.page: r.markdown for r in M.page_markdown(df).collect()}
    assert got == {
        1: "### 3.1. Reception activities\n\nReaders compare two versions and notice.\n\n- one item that runs on\n- two", None: "no page",
        2: "## A tall line\n\nText of it.\n\n![Figure 3 – The tree](assets/figures/figure_03.png)\n\n## KEY ASPECTS",
    }
