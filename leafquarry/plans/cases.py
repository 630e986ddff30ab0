"""Queries on written cases, for operators whose input does not occur in the tables.

cases.jsonl holds them, one a line: operator, input (text, or JSON where the operator takes a structure) and the result,
written by hand from the operator's description. A query gives case_no, input and result; its SQL gives the written results, so the oracle is
no second version of the operator. The same operators are tested on null and empty input in tests/.
"""

import json
import re
from pathlib import Path

from pyspark.sql import functions as F

from ..functions import repairs as R
from ..functions import text as X
from ..operators import gates as G
from ..operators.formatting import STEPS, format_documents, page_markdown
from ..operators.issues import text_gates
from ..sources import files
from ..session import table

QUERIES: dict = {}
SQL: dict = {}
CASES: dict[str, list[dict]] = {}
for _line in (Path(__file__).parent / "cases.jsonl").read_text(encoding="utf-8").splitlines():
    _case = json.loads(_line)
    CASES.setdefault(_case["op"], []).append(_case)


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, separators=(",", ":"))


def _literal(value: str | None) -> str:
    return "NULL::VARCHAR" if value is None else "'" + value.replace("'", "''") + "'"


def add(name, fn):
    """A query of fn (column of the input to a column; structures as JSON) over the cases of the operator."""
    rows = [(n, _text(c["input"]), _text(c["want"])) for n, c in enumerate(CASES[name], 1)]

    def query(spark, sf_dir):
        df = spark.createDataFrame([r[:2] for r in rows], "case_no int, input string")
        return df.select("case_no", "input", fn(F.col("input")).alias("result"))

    QUERIES[name] = query
    values = ", ".join(f"({n}::INTEGER, {_literal(i)}, {_literal(w)})" for n, i, w in rows)
    SQL[name] = f"SELECT * FROM (VALUES {values}) AS t(case_no, input, result)"


_ROWS = "array<array<string>>"
add("c04_urls", lambda c: X.split_glued_footnotes(X.sanitize_urls(c)))
add("c05_peel_url", lambda c: F.to_json(R.peel_url(c)))
add("c07_bold", X.bold_normal)
add("c09_reversed_title", R.fix_reversed_title)
add("c11_escape_cell", X.escape_cell)
add("c12_table_markdown", lambda c: X.table_markdown(F.from_json(c, _ROWS)))
add("c14_stacked_cells", lambda c: F.to_json(X.expanded_levels(F.from_json(c, "array<string>")[0], F.from_json(c, "array<string>")[1])))
add("c17_artifact_bodies", lambda c: F.to_json(X.artifact_bodies(c)))
add("c24_tone_marks", R.tone_marks)
add("c26_midword", X.midword_high)
add("c32_toc_parse", lambda c: F.to_json(X.figure_entry(c)))
add("f15_fill", lambda c: X.is_callout_fill(F.from_json(c, "array<double>")).cast("string"))
add("f17_captions", lambda c: X.is_caption(c).cast("string"))
add("f24_chapter_openers", lambda c: X.is_chapter_opener(c).cast("string"))


def add_steps(name, *steps):
    """A query of format steps (all in order where none is named) over the cases of an operator."""
    chosen = [step for step in STEPS if step[0] in steps] if steps else STEPS
    rows = [(n, _text(c["input"]), _text(c["want"])) for n, c in enumerate(CASES[name], 1)]

    def query(spark, sf_dir):
        docs = spark.createDataFrame([r[:2] for r in rows], "doc_id int, text string")
        return format_documents(docs, chosen).select(F.col("doc_id").alias("case_no"), F.col("text").alias("result"))

    QUERIES[name] = query
    SQL[name] = "SELECT * FROM (VALUES " + ", ".join(f"({n}::INTEGER, {_literal(w)})" for n, _, w in rows) + ") AS t(case_no, result)"


add_steps("c20_chapter_openings", "chapter openings")
add_steps("c21_blockquotes", "leads glued to lists, collapsed quotes, web addresses and footnotes", "repeated box titles")
add_steps("c23_level_callouts", "level callouts")
add_steps("w02_page_markers", "repeated page markers")
add_steps("w18_sections", "sections behind markers")
add_steps("w19_page_captions", "page blocks")
add_steps("w22_labels", "labels under pictures")
add_steps("d10_whole_order")


def _pages(spark, op, schema):
    rows = [(json.dumps(x, ensure_ascii=False),) for c in CASES[op] for x in (c["input"] if isinstance(c["input"], list) else [c["input"]])]
    return spark.createDataFrame(rows, "j string").select(F.from_json("j", schema).alias("j")).select("j.*")


def relation(name, columns):
    """A query over the cases of an operator as one relation; its SQL gives the written rows (`rows` of the last case)."""

    def register(fn):
        QUERIES[name] = fn
        wanted = [row for c in CASES[name] for row in c["want"]]
        cast = lambda v, t: f"{_literal(_text(v))}" if t == "VARCHAR" else f"{'NULL' if v is None else json.dumps(v)}::{t}"
        values = ", ".join("(" + ", ".join(cast(v, t) for v, t in zip(row, columns.values(), strict=True)) + ")" for row in wanted)
        SQL[name] = f"SELECT * FROM (VALUES {values}) AS t({', '.join(f'\"{c}\"' for c in columns)})"
        return fn

    return register


_ISSUE = {"check": "VARCHAR", "doc_id": "VARCHAR", "page": "INTEGER", "detail": "VARCHAR"}


@relation("v07_golden_pages", _ISSUE)
def v07_golden_pages(spark, sf_dir):
    docs = _pages(spark, "v07_golden_pages", "doc_id string, text string")
    fields = re.sub(r"(\w+) ((?:array|map)<[^>]+>|string|int)", r"\1:\2", G.SPEC.removeprefix("doc_id string, "))
    specs = _pages(spark, "v07_golden_pages", f"doc_id string, specs array<struct<{fields}>>")
    rows = specs.select("doc_id", F.explode("specs").alias("s")).select("doc_id", "s.*")
    return G.golden_issues(G.page_bodies(docs), rows).select(*_ISSUE)


@relation("v08_contracts", _ISSUE)
def v08_contracts(spark, sf_dir):
    docs = _pages(spark, "v08_contracts", "doc_id string, text string")
    rules = _pages(spark, "v08_contracts", "doc_id string, rules array<struct<page:int,rule:string,subject:string,object:string>>")
    rows = rules.select("doc_id", F.explode("rules").alias("r")).select("doc_id", "r.*")
    return G.contract_issues(G.page_bodies(docs), rows).unionByName(G.text_issues(docs)).select(*_ISSUE)


@relation("v10_chunks", {"check": "VARCHAR", "doc_id": "VARCHAR", "detail": "VARCHAR"})
def v10_chunks(spark, sf_dir):
    docs = _pages(spark, "v10_chunks", "doc_id string, text string")
    assets = _pages(spark, "v10_chunks", "doc_id string, assets array<string>").select("doc_id", F.explode("assets").alias("path"))
    return G.chunk_issues(docs, assets).select("check", "doc_id", "detail")


@relation("d09_layout_pages", {"doc_id": "VARCHAR", "page": "INTEGER", "markdown": "VARCHAR"})
def d09_layout_pages(spark, sf_dir):
    return page_markdown(_pages(spark, "d09_layout_pages", "doc_id string, page int, line_no int, text string, size double"))


@relation("s02_page_tables", {"doc_id": "VARCHAR", "page": "INTEGER", "table_index": "INTEGER", "rows": "VARCHAR"})
def s02_page_tables(spark, sf_dir):
    made = files.page_tables(_pages(spark, "s02_page_tables", files.LAYOUT))
    return made.select("doc_id", "page", "table_index", F.to_json("rows").alias("rows"))


@relation("s03_page_drawings", {"doc_id": "VARCHAR", "page": "INTEGER", "n_drawings": "INTEGER", "h_rules": "INTEGER", "v_rules": "INTEGER"})
def s03_page_drawings(spark, sf_dir):
    return files.drawing_rules(_pages(spark, "s03_page_drawings", files.LAYOUT))


@relation("s04_page_links", {"doc_id": "VARCHAR", "page": "INTEGER", "uri": "VARCHAR", "anchor": "VARCHAR"})
def s04_page_links(spark, sf_dir):
    return files.page_links(_pages(spark, "s04_page_links", files.LAYOUT))


@relation("f02_page_rotation", {"doc_id": "VARCHAR", "page": "INTEGER", "orientation": "VARCHAR"})
def f02_page_rotation(spark, sf_dir):
    return files.page_rotation(_pages(spark, "f02_page_rotation", files.LAYOUT))


@relation("s05_best_rotation", {"doc_id": "VARCHAR", "page": "INTEGER", "angle": "INTEGER"})
def s05_best_rotation(spark, sf_dir):
    return files.best_rotation(_pages(spark, "s05_best_rotation", "doc_id string, page int, angle int, text string")).select("doc_id", "page", "angle")


def v11_regression(spark, sf_dir):
    """The verdict on every document by the gates over whole texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return G.regression(text_gates(docs).unionByName(G.text_issues(docs)), docs)


QUERIES["v11_regression"] = v11_regression
