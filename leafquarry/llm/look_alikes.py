"""Visually identical text written with different characters: texts that look like a term of a list.

Method: compatibility normalisation to the composed form, mapped white space and hyphens, look-alike letters of other
scripts mapped to one script and default-ignorable characters removed, worked out once per distinct value of each
Arrow batch; full case folding on request. Equal forms are then found with one hash join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.look import look, look_casefold


def consistent(df: DataFrame, text: str = "text", out: str = "text_form", fold_case: bool = False) -> DataFrame:
    """df with the consistent form of its text column. Null stays null, empty stays empty, other columns stay."""
    return df.withColumn(out, (look_casefold if fold_case else look)(F.col(text)))


def matching_terms(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """Texts that look like a term as a whole but are written with other characters.

    texts: kind, row_id, text; terms: term_id, term. Result: kind, row_id, term_id, each once however often a row
    was delivered. Rows with a null text, term or id match nothing. Two terms of the same look are both reported
    unless the text is written exactly as the one in question. The plan joins by form; Spark broadcasts the terms
    only while their measured size is under its threshold and shuffles both sides by form otherwise.
    """
    said = consistent(texts.select("kind", "row_id", "text").where("text is not null and row_id is not null"))
    known = consistent(terms.select("term_id", "term").where("term is not null and term_id is not null"), "term", "term_form")
    return (
        said.join(known, F.col("text_form") == F.col("term_form"))
        .where(F.col("text") != F.col("term"))
        .select("kind", "row_id", "term_id")
        .distinct()
    )
