"""Assertions that emit issue rows of one shape, and the gate that reads them.

Every check returns rows (check, severity, doc_id, page, detail); checks are united by name and counted in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1000
COLUMNS = ["check", "severity", "doc_id", "page", "detail"]
# Text gates as (code, severity, pattern that must not occur).
GATES = [
    ("V-URL-SPACE", "hard", r"https?://[ \t]"),
    ("V-EMPTY-TABLE", "hard", r"(?m)^\|[ |]*\|[ \t]*$"),
    ("V-MOJIBAKE", "hard", r"Ã.|�"),
    ("V-SOFT-HYPHEN", "soft", r"\x{ad}"),
    ("V-ZERO-WIDTH", "soft", r"[\x{200b}-\x{200d}\x{2060}\x{feff}]"),
    ("V-TRIPLE-BLANK", "soft", r"\n[ \t]*\n[ \t]*\n[ \t]*\n"),
    ("V-BROKEN-WORD", "soft", r"[\p{L}]-\n[\p{Ll}]"),
    ("V-HEADING-GLUE", "soft", r"(?m)^#{1,6}[^# \n]"),
]


def issue(df: DataFrame, check: str | Column, severity: str | Column, doc: str = "doc_id", page: Column | None = None, detail: Column | None = None) -> DataFrame:
    """df as issue rows."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    none = F.lit(None)
    return df.select(
        lit(check).alias("check"), lit(severity).alias("severity"), F.col(doc).cast("string").alias("doc_id"),
        (none if page is None else page).cast("int").alias("page"), (none if detail is None else detail).cast("string").alias("detail"),
    )


def united(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def text_gates(docs: DataFrame, doc: str = "doc_id", text: str = "text", gates: Sequence[tuple[str, str, str]] = GATES) -> DataFrame:
    """All text gates in one pass over the texts: an issue per document and failing gate, with the number of places."""
    said = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(s).alias("s"), F.regexp_count(text, F.lit(p)).alias("n")) for c, s, p in gates])
    failing = docs.select(F.col(doc).alias("doc_id"), F.explode(F.filter(said, lambda g: g["n"] > 0)).alias("g"))
    return issue(failing, F.col("g.c"), F.col("g.s"), detail=F.col("g.n"))


def golden(bodies: DataFrame, specs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Issues of golden specifications.

    bodies: on, text. specs: on, must_have and must_not_have (arrays), max_count (map of phrase to number). A specified
    body that is missing fails every must_have. Null arrays and maps assert nothing.
    """
    met = specs.join(bodies.select(*on, "text"), list(on), "left").withColumn("text", F.coalesce("text", F.lit("")))
    count = lambda p: F.when(F.length(p) > 0, (F.length("text") - F.length(F.replace(F.col("text"), p, F.lit("")))) / F.length(p)).otherwise(F.lit(0.0))
    rule = lambda kind: lambda p: F.struct(F.lit(kind).alias("k"), p.alias("p"))
    none = F.array().cast("array<struct<k:string,p:string>>")
    missing = F.transform(F.filter("must_have", lambda p: ~F.contains("text", p)), rule("must_have"))
    present = F.transform(F.filter("must_not_have", lambda p: F.contains("text", p)), rule("must_not_have"))
    over = F.transform(F.filter(F.map_entries("max_count"), lambda e: count(e["key"]) > e["value"]), lambda e: rule("max_count")(e["key"]))
    rows = met.select(*on, F.explode(F.concat(*[F.coalesce(x, none) for x in (missing, present, over)])).alias("x"))
    return rows.select(*on, F.col("x.k").alias("kind"), F.col("x.p").alias("phrase"))


def summary(issues: DataFrame) -> DataFrame:
    """Issues counted by check and by severity in one pass (the other column is null)."""
    return issues.groupingSets([[F.col("check")], [F.col("severity")]], F.col("check"), F.col("severity")).agg(F.count(F.lit(1)).alias("n"))


def passed(issues: DataFrame) -> bool:
    """Whether no hard issue exists; stops at the first."""
    return issues.where("severity = 'hard'").isEmpty()


def need_ban(docs: DataFrame, rules: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Residual assertions: phrases needed at least n times over all texts, or banned. rules: phrase, least, banned.

    The rules are a reviewed list of at most MAX_RULES and travel as one array, so the texts are read once; a longer
    list raises and runs in parts. Result: phrase, found, ok.
    """
    listed = rules.limit(MAX_RULES + 1).collect()
    if len(listed) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules; run them in parts")
    table = {r.phrase: (r.least, r.banned) for r in listed}
    times = lambda p: F.sum((F.length(text) - F.length(F.replace(F.col(text), F.lit(p), F.lit("")))) / len(p))
    counts = docs.agg(*[F.coalesce(times(p), F.lit(0)).cast("long").alias(f"c{i}") for i, p in enumerate(table)])
    rows = F.array(*[
        F.struct(F.lit(p).alias("phrase"), F.col(f"c{i}").alias("found"), (F.col(f"c{i}") == 0 if banned else F.col(f"c{i}") >= least).alias("ok"))
        for i, (p, (least, banned)) in enumerate(table.items())
    ])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def classified(df: DataFrame, out: str, rules: Mapping[str, Column], other: str) -> DataFrame:
    """df with the name of the first rule that holds."""
    case = reduce(lambda acc, kv: acc.when(kv[1], kv[0]), list(rules.items())[1:], F.when(next(iter(rules.values())), next(iter(rules))))
    return df.withColumn(out, case.otherwise(other))
