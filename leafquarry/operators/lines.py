"""Ordered operators on rows of text: islands, sessions, dedupes and joins of wrapped lines as window expressions.

Every window is partitioned by a document or a page. Order is data: rebuilt texts sort by their line numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEFORE = (Window.unboundedPreceding, -1)
SO_FAR = (Window.unboundedPreceding, 0)
AFTER = (1, Window.unboundedFollowing)


def exploded(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One row per line: keep, line_no (from 1), line. Null texts give no rows."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n", -1)).alias("pos", "line")).select(
        *keep, (F.col("pos") + 1).alias("line_no"), "line"
    )


def rebuilt(lines: DataFrame, by: Sequence[str], line: str = "line", order: str = "line_no", out: str = "text") -> DataFrame:
    """Texts of lines in order; null lines are dropped."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(line))))
    return lines.groupBy(*by).agg(F.array_join(F.transform(rows, lambda r: r[line]), "\n").alias(out))


def no_repeats(lines: DataFrame, by: Sequence[str], line: str = "line", order: str = "line_no") -> DataFrame:
    """Lines without those equal to the line before; runs of blank lines stay."""
    prev = F.lag(line).over(Window.partitionBy(*by).orderBy(order))
    return lines.withColumn("_p", prev).where((F.trim(line) == "") | F.col("_p").isNull() | (F.col("_p") != F.col(line))).drop("_p")


def islands(df: DataFrame, by: Sequence[str], order: Sequence[str], starts: Column, out: str = "island") -> DataFrame:
    """df with the number of the island each row is in; a row starts one where `starts` is true."""
    w = Window.partitionBy(*by).orderBy(*order)
    flagged = df.withColumn("_s", F.coalesce(starts, F.lit(True)).cast("int"))
    return flagged.withColumn(out, F.sum("_s").over(w.rowsBetween(*SO_FAR))).drop("_s")


def gap_paragraphs(rows: DataFrame, by: Sequence[str], y: str, text: str, order: Sequence[str], gap: float = 15.0) -> DataFrame:
    """Paragraphs of layout rows: a vertical gap of `gap` or more, a blank row or a list item starts a new one."""
    w = Window.partitionBy(*by).orderBy(*order)
    known = rows.withColumns({"_py": F.lag(y).over(w), "_pt": F.lag(text).over(w)})
    item = F.trim(text).rlike(r"^([#*•-]|[0-9]+(\.[0-9]+)+\.?\s|[0-9]{1,2}\.\s+\S)")
    start = F.col("_py").isNull() | (F.col(y) - F.col("_py") >= gap) | (F.trim("_pt") == "") | item
    full = islands(known, by, order, start, "paragraph").where(F.trim(text) != "")
    said = F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.trim(text).alias("_t"))))
    return full.groupBy(*by, "paragraph").agg(
        F.array_join(F.transform(said, lambda r: r["_t"]), " ").alias("text"), F.count(F.lit(1)).alias("n_rows")
    )


def merge_same_row(entries: Column, tolerance: float, middle: float) -> Column:
    """Fragments on one visual row joined, left and right of the middle apart: array of (y, x, text).

    entries: array of (y, x, text). A row reaches `tolerance` below its first fragment, so this is a fold, not a lag.
    """
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct(e["y"].alias("y"), e["x"].alias("x"), e["text"].alias("text"))))
    empty = F.array().cast("array<struct<top:double,y:double,x:double,text:string>>")

    def step(acc, e):
        last = F.try_element_at(acc, F.lit(-1))
        top = F.when(last.isNotNull() & (e["y"] - last["top"] <= tolerance), last["top"]).otherwise(e["y"])
        return F.concat(acc, F.array(F.struct(top.alias("top"), e["y"].alias("y"), e["x"].alias("x"), e["text"].alias("text"))))

    placed = F.aggregate(ordered, empty, step)
    tops = F.array_distinct(F.transform(placed, lambda p: p["top"]))

    def halves(top):
        def one(left):
            part = F.array_sort(F.transform(
                F.filter(placed, lambda p: (p["top"] == top) & ((p["x"] < middle) if left else (p["x"] >= middle))),
                lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["text"].alias("text")),
            ))
            said = F.array_join(F.filter(F.transform(part, lambda p: F.trim(p["text"])), lambda t: t != ""), " ")
            first = F.try_element_at(part, F.lit(1))
            return F.when(F.size(part) > 0, F.struct(first["y"].alias("y"), first["x"].alias("x"), said.alias("text")))

        return F.filter(F.array(one(True), one(False)), lambda h: h.isNotNull())

    return F.flatten(F.transform(tops, halves))


def column_order(rows: DataFrame, by: Sequence[str], x: str, y: str, middle: float, least: int = 5) -> DataFrame:
    """Reading order (column `reading_no`): left column first where both hold at least `least` rows, else by height."""
    page = Window.partitionBy(*by)
    left = F.col(x) < middle
    two = (F.sum(left.cast("int")).over(page) >= least) & (F.sum((~left).cast("int")).over(page) >= least)
    half = F.when(two, F.when(left, 0).otherwise(1)).otherwise(0)
    return rows.withColumn("_half", half).withColumn(
        "reading_no", F.row_number().over(Window.partitionBy(*by).orderBy("_half", y, x))
    ).drop("_half")


def page_of_line(lines: DataFrame, by: Sequence[str], page: Column, order: str = "line_no", after: bool = False) -> DataFrame:
    """lines with the page they belong to, from marker lines whose page number is `page`.

    after=False: the body of a page stands before its marker (the next marker at or after the line). after=True: it
    follows the marker (the last one at or before the line).
    """
    w = Window.partitionBy(*by).orderBy(order)
    if after:
        return lines.withColumn("page", F.last(page, True).over(w.rowsBetween(*SO_FAR)))
    return lines.withColumn("page", F.first(page, True).over(w.rowsBetween(0, Window.unboundedFollowing)))


def join_wrapped(lines: DataFrame, by: Sequence[str], starter: Column, line: str = "line", order: str = "line_no") -> DataFrame:
    """Soft-wrapped lines joined with spaces: by, block_no, text. Blank and starter lines begin a block, fences stay whole."""
    w = Window.partitionBy(*by).orderBy(order)
    mark = F.trim(line).startswith("```")
    marked = lines.withColumn("_f", F.sum(mark.cast("int")).over(w.rowsBetween(*SO_FAR)))
    inside = (F.col("_f") % 2 == 1) | mark
    prev = F.lag(line).over(w)
    state = marked.withColumns({"_in": inside, "_blank": F.trim(line) == "", "_prev": prev})
    start = F.col("_in") | F.col("_blank") | starter | F.col("_prev").isNull() | (F.trim("_prev") == "") | F.lag("_in").over(w)
    blocks = islands(state.withColumn("_start", start), by, [order], F.col("_start"), "block_no").where("_in or not _blank")
    said = F.array_sort(F.collect_list(F.struct(F.col(order), F.when(F.col("_in"), F.col(line)).otherwise(F.trim(line)).alias("_t"))))
    return blocks.groupBy(*by, "block_no").agg(F.array_join(F.transform(said, lambda r: r["_t"]), " ").alias("text"))


def chain_titles(spans: Column) -> Column:
    """Title of a merged chain of (lo, hi, title) in order: the longer part's at each step, ties keep the chain's."""
    seed = F.struct(F.lit(None).cast("int").alias("lo"), F.lit(None).cast("int").alias("hi"), F.lit(None).cast("string").alias("title"))
    step = lambda a, s: F.when(a["lo"].isNull(), F.struct(s["lo"].alias("lo"), s["hi"].alias("hi"), s["title"].alias("title"))).otherwise(
        F.struct(
            F.least(a["lo"], s["lo"]).alias("lo"), F.greatest(a["hi"], s["hi"]).alias("hi"),
            F.when(a["hi"] - a["lo"] >= s["hi"] - s["lo"], a["title"]).otherwise(s["title"]).alias("title"),
        )
    )
    return F.aggregate(spans, seed, step)["title"]


def merge_chains(spans: DataFrame, by: Sequence[str], lo: str = "lo", hi: str = "hi", title: str = "title") -> DataFrame:
    """Touching or overlapping spans of one group merged: by, lo, hi, title, n."""
    known = spans.where(F.col(lo).isNotNull() & F.col(hi).isNotNull()).select(*by, F.col(lo).cast("int").alias("lo"), F.col(hi).cast("int").alias("hi"), F.col(title).alias("title"))
    w = Window.partitionBy(*by).orderBy("lo", "hi", "title")
    reach = F.max("hi").over(w.rowsBetween(*BEFORE))
    made = islands(known.withColumn("_r", reach), by, ["lo", "hi", "title"], F.col("lo") > F.col("_r") + 1, "_i")
    ordered = F.array_sort(F.collect_list(F.struct("lo", "hi", "title")))
    return made.groupBy(*by, "_i").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), chain_titles(ordered).alias("title"), F.count(F.lit(1)).alias("n")
    ).drop("_i")


def page_runs(pages: DataFrame, by: Sequence[str], page: str = "page") -> DataFrame:
    """Runs of consecutive pages: by, first_page, last_page, n_pages; pages count once, null pages not at all."""
    once = pages.where(F.col(page).isNotNull()).select(*by, F.col(page).alias("_p")).distinct()
    numbered = once.withColumn("_g", F.col("_p") - F.row_number().over(Window.partitionBy(*by).orderBy("_p")))
    return numbered.groupBy(*by, "_g").agg(
        F.min("_p").alias("first_page"), F.max("_p").alias("last_page"), F.count(F.lit(1)).alias("n_pages")
    ).drop("_g")


def chunk_ranges(pages: int, protected: list[tuple[int, int]], size: int = 25) -> list[tuple[int, int]]:
    """Ranges of about `size` pages that end and start outside protected ranges; pages skipped by neither are lost.

    A range that would end inside a protected one is extended to its end, once, by the first such range in order; one
    that would start inside a protected range starts there only because the range before was not extended past it.
    """
    made, pos = [], 1
    protected = sorted(protected)
    while pos <= pages:
        end = min(pos + size - 1, pages)
        end = next((e for s, e in protected if s <= end < e), end)
        made.append((pos, min(end, pages)))
        pos = min(end, pages) + 1
    return made


RANGES = T.ArrayType(T.StructType([T.StructField("lo", T.IntegerType()), T.StructField("hi", T.IntegerType())]))


def span_safe_ranges(docs: DataFrame, groups: DataFrame, size: int = 25) -> DataFrame:
    """Span-safe chunk ranges per document: doc, chunk_no, lo, hi. docs: doc, pages; groups: doc, lo, hi (protected)."""
    per = groups.groupBy("doc").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"))

    @F.arrow_udf(RANGES)
    def ranges(pages: pa.Array, spans: pa.Array) -> pa.Array:
        made = [
            [{"lo": a, "hi": b} for a, b in chunk_ranges(n, [(s["lo"], s["hi"]) for s in own or []], size)]
            for n, own in zip(pages.to_pylist(), spans.to_pylist(), strict=True)
        ]
        return pa.array(made, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))

    made = docs.where("pages is not null").join(per, "doc", "left").select("doc", F.posexplode(ranges("pages", "spans")).alias("no", "r"))
    return made.select("doc", (F.col("no") + 1).alias("chunk_no"), F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))


def longest_cover(pages: DataFrame, spans: DataFrame, on: list[str], page: str, lo: str, hi: str, order: Sequence[str]) -> DataFrame:
    """Of the spans that cover a page the longest, the first in `order` among equals. Interval keys, no range join."""
    from .intervals import points_in_intervals

    met = points_in_intervals(pages, spans, on, page, lo, hi)
    w = Window.partitionBy(*on, page).orderBy((F.col(hi) - F.col(lo)).desc(), *order)
    return met.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def overlapping_pairs(spans: DataFrame, by: Sequence[str], ident: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """Whether a span overlaps another of its group: by, ident, lo, hi, overlaps; by neighbours in order, not by pairs."""
    w = Window.partitionBy(*by).orderBy(lo, hi, ident)
    ahead = F.max(hi).over(w.rowsBetween(*BEFORE)) >= F.col(lo)
    behind = F.min(lo).over(w.rowsBetween(*AFTER)) <= F.col(hi)
    return spans.select(*by, ident, lo, hi, F.coalesce(ahead, F.lit(False)).alias("_a"), F.coalesce(behind, F.lit(False)).alias("_b")).select(
        *by, ident, lo, hi, (F.col("_a") | F.col("_b")).alias("overlaps")
    )


def reduced_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys with their state between two builds: only_old, only_new, changed or same."""
    side = lambda df, n: df.select(*keys, F.xxhash64(*[F.col(v) for v in values]).alias(n)).groupBy(*keys).agg(F.min(n).alias(n))
    both = side(old, "_o").join(side(new, "_n"), list(keys), "full_outer")
    state = F.when(F.col("_n").isNull(), "only_old").when(F.col("_o").isNull(), "only_new").when(F.col("_o") != F.col("_n"), "changed").otherwise("same")
    return both.select(*keys, state.alias("state"))
