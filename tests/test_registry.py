import ast
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_import_the_subpackage():
    for path in (ROOT / "leafquarry").rglob("*.py"):
        if path.parent.name != "llm":
            for node in ast.walk(ast.parse(path.read_text())):
                names = [node.module or ""] if isinstance(node, ast.ImportFrom) else [a.name for a in node.names] if isinstance(node, ast.Import) else []
                assert not any("llm" in n for n in names), path


def test_core_queries_run(spark):
    from leafquarry.plans import registered

    for name, query in registered()[0].items():
        made = query(spark, "/root/testdata/sf0.001")
        assert made.columns, name
        made.write.format("noop").mode("overwrite").save()


def test_written_cases(spark, rows):
    """Every query on written cases gives the written results."""
    from leafquarry.plans import cases

    for name, written in cases.CASES.items():
        if "case_no" in cases.QUERIES[name](spark, "").columns:
            got = [r["result"] for r in cases.QUERIES[name](spark, "").orderBy("case_no").collect()]
            assert got == [cases._text(c["want"]) for c in written], name
        else:
            got = rows(cases.QUERIES[name](spark, ""))
            want = sorted((tuple(cases._text(v) if isinstance(v, (list, dict)) else v for v in row) for c in written for row in c["want"]), key=lambda t: tuple((x is None, str(x)) for x in t))
            assert got == want, name


def test_entry(spark):
    assert entry.entry(spark).columns == ["job_id", "snapshot_no", "id", "change_type"]
