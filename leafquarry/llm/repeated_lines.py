"""Lines repeated across the documents of one source.

Every source's documents get dense numbers in shards of bounded size. A line's documents are a compressed bitmap:
only the 64-bit words that are not zero are kept, one row (source, line form, shard, word number, word) each, built
by a bit_or with map-side combine. Words of variant lines are united by the common form of the lines, the exact
cardinality is the sum of the words' bit counts, and lines are deleted by looking their document's bit up in the
bitmaps of the lines over the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.look import look_casefold, squeezed
from ..session import cut

SHARD_DOCS = 16384  # documents numbered by one task; bounds the work of a hot source's numbering
WORD = 64


def line_form(text: Column) -> Column:
    """Form under which lines are the same: apart from look, case, outer and repeated spaces and the digits in them."""
    return F.regexp_replace(squeezed(look_casefold(text)), r"\p{Nd}+", "0")


def numbered_documents(docs: DataFrame) -> DataFrame:
    """docs (source, doc, each doc once) with shard and dense number within the shard, and the source's size."""
    sizes = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    sharded = docs.join(sizes, "source").withColumn(
        "shard", F.pmod(F.xxhash64("doc"), F.ceil(F.col("n_docs") / SHARD_DOCS)).cast("int")
    )
    number = F.row_number().over(Window.partitionBy("source", "shard").orderBy("doc")) - 1
    return (
        sharded.withColumn("no", number)
        .withColumn("word_no", F.floor(F.col("no") / WORD).cast("int"))
        .withColumn("bit", F.pmod(F.col("no"), F.lit(WORD)).cast("int"))
    )


def _placed(lines: DataFrame, docs: DataFrame) -> DataFrame:
    """line_id, source, the two halves of the form's hash, and the place of the line's document in the bitmaps."""
    form = lines.where(F.col("text").rlike(r"\p{L}")).withColumn("form", line_form(F.col("text")))
    hashed = form.select("line_id", "doc", F.xxhash64("form").alias("h1"), F.xxhash64(F.lit(7), "form").alias("h2"))
    return hashed.join(docs.select("doc", "source", "n_docs", "shard", "word_no", "bit"), "doc")


def bitmaps(placed: DataFrame) -> DataFrame:
    """Compressed bitmaps: one row per source, form, shard and word with at least one document."""
    word = F.expr("bit_or(shiftleft(1L, bit))").alias("word")
    return placed.groupBy("source", "h1", "h2", "shard", "word_no").agg(word, F.first("n_docs").alias("n_docs"))


def repeated(bits: DataFrame, min_docs: int, share: tuple[int, int]) -> DataFrame:
    """Forms whose exact document count reaches both thresholds: source, h1, h2, docs, n_docs."""
    counted = bits.groupBy("source", "h1", "h2").agg(
        F.sum(F.bit_count("word").cast("long")).alias("docs"), F.first("n_docs").alias("n_docs")
    )
    return counted.where((F.col("docs") >= min_docs) & (F.col("docs") * share[1] >= F.col("n_docs") * share[0]))


def repeated_lines(lines: DataFrame, docs: DataFrame, min_docs: int = 5, share: tuple[int, int] = (1, 5)) -> DataFrame:
    """Ids of the lines that occur in at least min_docs and at least the share (a fraction) of their source's documents.

    lines: line_id, doc, text; docs: doc, source, one row per document that counts. Lines without a letter, with a
    null text or of a document that is not in docs are never repeated lines; a null source is a source of its own
    under the name ''. A line delivered twice counts once. Result: line_id, each once.
    """
    known = docs.where("doc is not null").select("doc", F.coalesce("source", F.lit("")).alias("source"))
    numbered = numbered_documents(known)
    placed = cut(_placed(lines.where("text is not null and line_id is not null"), numbered))  # lines are read and folded once
    bits = bitmaps(placed)
    over = repeated(bits, min_docs, share).select("source", "h1", "h2")
    held = bits.join(over, ["source", "h1", "h2"], "left_semi").select("source", "h1", "h2", "shard", "word_no", "word")
    found = placed.join(held, ["source", "h1", "h2", "shard", "word_no"])
    return found.where(F.expr("(shiftrightunsigned(word, bit) & 1L) = 1L")).select("line_id").distinct()


def cleaned_documents(lines: DataFrame, found: DataFrame) -> DataFrame:
    """Every document without the found lines: doc, page, text (the remaining lines of the page in order), kept, removed.

    lines: line_id, doc, page, line_no, text. A page is the unit of assembly, so no task holds a whole document.
    """
    once = lines.select("line_id", "doc", "page", "line_no", "text").dropDuplicates(["line_id"])
    once = once.join(found.select("line_id", F.lit(True).alias("hit")), "line_id", "left")
    kept = F.when(F.col("hit").isNull(), F.struct("line_no", "line_id", F.coalesce("text", F.lit("")).alias("t")))
    ordered = F.transform(F.array_sort(F.collect_list(kept)), lambda x: x["t"])
    return once.groupBy("doc", "page").agg(
        F.array_join(ordered, "\n").alias("text"),
        F.count_if(F.col("hit").isNull()).alias("kept"),
        F.count("hit").alias("removed"),
    )
