"""Per-document text statistics, the rules a text fails, and whether it is natural prose, a list, a table or junk.

Everything is a built-in column expression. The statistics of a text are tested against published fixed thresholds, and
every failed rule is recorded. Those rules tell prose from junk by averages over the whole text but cannot name lists
and tables, so the same kind of statistics (letters, digits, symbols, cells, bullets, length, common words, vowels,
repetition) is also taken per line: a line is put under the first line rule whose threshold it fails, the characters
under each rule are summed, and the kind that holds most characters decides where prose holds less than half.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The commonest words of English, French, German and Spanish.
COMMON = (
    "the of and to a in that is was for it with as on be at by this are from or an which not but have had has they their "
    "le la les de des du et un une en est que qui dans pour pas ne sur au aux il elle avec ce se par "
    "der die das und den dem ein eine einer nicht mit von zu ist im auf für sich es als auch "
    "el los las del y que se por con para su al lo como más una no son"
).split()
# Fixed thresholds of published rules for whole texts.
RULES = {
    "too few words": lambda s: s["n_words"] < 50,
    "too many words": lambda s: s["n_words"] > 100_000,
    "mean word length": lambda s: ~s["mean_word_length"].between(3, 10),
    "symbols for words": lambda s: s["mark_word_ratio"] > 0.1,
    "bullet lines": lambda s: s["bullet_line_share"] > 0.9,
    "ellipsis lines": lambda s: s["ellipsis_line_share"] > 0.3,
    "words without letters": lambda s: s["letter_word_share"] < 0.8,
    "common words": lambda s: s["n_common_words"] < 2,
    "line ends": lambda s: s["punct_line_share"] < 0.12,
}
# Fixed thresholds of the line rules.
LETTER_SHARE = 0.55  # letters among characters that are not white space, below which a line without cells is junk
DIGIT_SHARE = 0.6
ODD_SHARE = 0.2  # characters of broken encodings, or symbols no cell holds
VOWELLESS_SHARE = 0.45  # words of three letters or more without a vowel
LONG_TOKEN = 40  # letters and digits without a break: encoded data
REPEAT_SHARE = 0.12  # distinct pairs of neighbouring words among all, in texts of at least REPEAT_WORDS words
REPEAT_WORDS = 12
ITEM_WORDS = 14  # words of a list item at most
PHRASE_WORDS = 4  # words of an unmarked item at most
CELL_WORDS = 5  # words of a table cell on average at most
# Line rules in the order in which they are tried, and the kind of the lines that fail them.
LINE_RULES = {
    "leader line": "list", "rule": "table", "cells": "table", "bullet": "list", "broken encoding": "junk", "encoded data": "junk",
    "numbers": "junk", "symbols": "junk", "no words": "junk", "short lines": "list",
}
KINDS = ("list", "table", "junk")

_SPACES = "\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
_BREAKS = "\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029\r"
_BULLET = r"^(?:[-*+•▪–—·‣◦●○■□➢►]|\(?\d{1,4}[.)]|\(?[A-Za-z][.)]|\(?[ivxlcIVXLC]{1,6}[.)])\s+\S"
_LEADER = r"\.\s?\.\s?\.\s*[\divxlc]+$|…\s*\d+$"
_DIRTY_CELL = r"[^\p{L}\p{N}_✓✗×–—%€$£°+\-.,:/()'’& |]"
_VOWELS = "aeiouyàáâãäåæèéêëìíîïòóôõöøœùúûüýÿαεηιουωάέήίόύώϊϋаеёиоуыэюяіїє"
_MARKED = r"[|\t;\uFFFDÃÂâ_=^~`]|   |\.\.|^[^\p{L}\p{N}_“\"'¿¡(]|^\S{0,5}[.)]\s|^[(]|[\x00-\x1f]"


def _trimmed(x: Column) -> Column:
    return F.trim(x, F.lit(" \t"))


def _many(x: Column, pattern: str) -> Column:
    return F.regexp_count(x, F.lit(pattern))


def _plain_prose(s: Column, words: Column) -> Column:
    """Whether a line is so plainly prose that no other rule can hold: common words, no separators, no mark at its start."""
    common = F.size(F.filter(words, lambda w: w.isin(*[w for w in COMMON if len(w) > 1])))
    return (F.size(words) >= 5) & ~s.rlike(_MARKED) & (common * 7 >= F.size(words))


def _clean(s: Column, separator: str) -> Column:
    """Whether a line without its separators and line-break tags holds only what a cell holds."""
    return ~F.regexp_replace(s, rf"\s*{separator}\s*|<br>", "").rlike(_DIRTY_CELL)


def _cells(line: Column, s: Column, n_words: Column) -> Column:
    """Cells of a line if it is a row: at least two, clean and short, whatever the separator; or null."""
    inner = F.trim(s, F.lit("|"))
    tabs, semis = F.split(line, "\t"), F.split(line, ";")
    few = ~s.rlike(r"(?:^|;)\s*(?:[^;\s]+\s+){3}[^;\s]")
    filled = ((F.size(semis) >= 3) & s.rlike(r"[^;\s]")) | few
    short = ~s.rlike(r"(?:^|,)\s*(?:[^,\s]+\s+){2}[^,\s]")
    listed = short & ~line.contains(", ") & ~s.rlike(r"[.!?]$") & _clean(line, ",")
    return (
        F.when(inner.contains("|") & _clean(inner, r"\|"), F.split(inner, r"\|"))
        .when(line.contains("\t") & (n_words <= CELL_WORDS * F.size(tabs)) & _clean(line, r"\t"), tabs)
        .when(line.contains(";") & filled & (n_words <= CELL_WORDS * F.size(semis)) & _clean(line, ";"), semis)
        .when(s.rlike(r"\S(?: {3,}|\t+ *)\S"), F.split(s, r" {3,}|\t"))
        .when((_many(line, ",") >= 2) & listed, F.split(line, ","))
    )


def _once(x: Column, of) -> Column:
    """of(x) with x worked out once, however often it is used."""
    return F.transform(F.array(x), of)[0]


def _row(cells: Column) -> Column:
    """Whether cells hold values instead of noise: four fifths of the filled ones are words, numbers or marks."""
    full = lambda row: F.filter(F.transform(row, _trimmed), lambda c: c != "")
    good = lambda row: F.filter(row, lambda c: _clean(c, r"\|") & c.rlike(r"[\p{L}\p{N}_✓✗×–—-]"))
    valued = lambda row: _once(full(row), lambda r: F.size(good(r)) >= 0.8 * F.size(r))
    return _once(cells, lambda row: row.isNotNull() & valued(row))


def _noise(line: Column, m: Column) -> Column:
    """The junk rule a line fails, or null; m holds its counts."""
    solid, letters, digits, words = m["solid"], m["letters"], m["digits"], m["words"]
    low = F.lower(line)
    broken = line.rlike(r"[\uFFFDÃÂâ]") & (_many(line, r"\uFFFD|[ÃÂâ][\u0080-\u00BF\u20AC\u2122\u0153\u017E\u0178\uFFFD]") * 2 > ODD_SHARE * solid)
    control = line.rlike(r"[\x00-\x08\x0e-\x1f\x7f]") & (_many(line, r"[\x00-\x08\x0e-\x1f\x7f]") > ODD_SHARE * solid)
    tokens = F.regexp_extract_all(line, F.lit(r"(?<!\S)[A-Za-z0-9+/=_-]{%d,}(?!\S)" % LONG_TOKEN), F.lit(0))
    coded = F.filter(tokens, lambda t: t.rlike("^[0-9a-f]+$") | F.regexp_replace(t, "^[^A-Za-z]*[A-Za-z]", "").rlike("[A-Z0-9+/=]") & t.rlike("[A-Za-z]"))
    encoded = line.rlike(r"\S{%d}" % LONG_TOKEN) & (F.length(F.array_join(coded, "")) * 2 > solid)
    dense = (solid >= 10) & (letters < 0.75 * solid) & (letters <= 3 * words) & (words >= 4)
    without = rf"(?<!\p{{L}})[\p{{L}}&&[^{_VOWELS}]]{{3,}}(?!\p{{L}})"
    long_words, vowelless = _many(low, r"\p{L}{3,}"), _many(low, without)
    return (
        F.when(broken | control, "broken encoding").when(encoded, "encoded data")
        .when((digits >= DIGIT_SHARE * solid) & (letters < 0.2 * solid), "numbers")
        .when((solid >= 2) & ((letters + digits < LETTER_SHARE * solid) | dense), "symbols")
        .when(low.rlike(without) & (long_words >= 3) & (vowelless > VOWELLESS_SHARE * long_words), "no words")
        .when((words <= 2) & (letters > 0.8 * solid) & low.rlike(r"\p{L}{%d,}" % (LONG_TOKEN + 1)), "encoded data")
    )


def _shape_rule(x: Column) -> Column:
    """The line rule that the shape of a line fails (leader, rule or cells), or null."""
    line, s, m = x["line"], x["s"], x["m"]
    leader = s.rlike(r"\.\.|\. \.|…") & s.rlike(_LEADER) & (m["words"] <= ITEM_WORDS)
    ruled = s.contains("|") & s.rlike(r"^[\s|:+=_-]{3,}$")
    return F.when(leader, "leader line").when(ruled, "rule").when(s.rlike(r"[|\t;]|   |,.*,") & _row(_cells(line, s, x["n"])), "cells")


def _mark_rule(x: Column) -> Column:
    """The line rule that a line of no other shape fails: a bullet's, unless it is noise, or a noise rule's; or null."""
    bullet = x["s"].rlike(_BULLET) & (x["n"] <= ITEM_WORDS + 1)
    said = lambda noise: F.when(bullet & ~(noise.isNotNull() & (x["m"]["words"] < 2)), "bullet").otherwise(noise)
    return _once(_noise(x["line"], x["m"]), said)


def _measured(lines: Column) -> Column:
    """Lines as structs: the rule each fails, its length, and what a run of short lines is judged by."""
    first = F.transform(lines, lambda x: F.struct(x.alias("line"), _trimmed(x).alias("s"), F.split(F.lower(_trimmed(x)), r"\s+").alias("w")))
    second = F.transform(first, lambda x: F.struct(x["line"], x["s"], F.size(x["w"]).alias("n"), _plain_prose(x["s"], x["w"]).alias("plain")))
    solid = lambda x: F.length(F.regexp_replace(x["line"], r"\s", ""))
    digits = lambda x: F.length(x["line"]) - F.length(F.regexp_replace(x["line"], r"\p{Nd}", ""))
    lettered = lambda x: F.filter(F.split(x["line"], r"[^\p{L}]+"), lambda w: w != "")
    counts = lambda x: _once(lettered(x), lambda w: F.struct(
        solid(x).alias("solid"), F.length(F.array_join(w, "")).alias("letters"), digits(x).alias("digits"), F.size(w).alias("words")
    ))
    third = F.transform(second, lambda x: F.struct(x["line"], x["s"], x["n"], F.when(~x["plain"], counts(x)).alias("m")))
    fourth = F.transform(third, lambda x: F.struct(x["line"], x["s"], x["n"], x["m"], F.when(x["m"].isNotNull(), _shape_rule(x)).alias("shape")))
    marked = lambda x: F.when(x["m"].isNotNull() & x["shape"].isNull(), _mark_rule(x)).otherwise(x["shape"])
    fifth = F.transform(fourth, lambda x: F.struct(x["line"], x["s"], x["n"], marked(x).alias("rule")))
    short = lambda x: x["rule"].isNull() & (x["n"] <= ITEM_WORDS) & ~x["s"].startswith("#")
    said = lambda x: F.filter(F.split(F.lower(x["s"]), r"[^\p{L}]+"), lambda w: w != "")
    sixth = F.transform(fifth, lambda x: F.struct(x["line"], x["s"], x["n"], x["rule"], F.when(short(x), said(x)).alias("said")))
    return F.transform(
        sixth,
        lambda x: F.struct(
            x["rule"], F.length(x["line"]).cast("long").alias("chars"), x["n"].cast("long").alias("n"), F.size(x["said"]).cast("long").alias("said"),
            F.size(F.filter(x["said"], lambda w: w.isin(*COMMON))).cast("long").alias("common"), x["said"].isNotNull().alias("short"),
            (x["said"].isNotNull() & F.right(x["s"], F.lit(1)).isin(*".;!?")).cast("long").alias("whole"),
            (x["said"].isNotNull() & F.left(x["s"], F.lit(1)).rlike(r"\p{Lu}")).cast("long").alias("upper"),
        ),
    )


_RUN = ("chars", "lines", "n", "said", "common", "whole", "upper")
_SUMS = (*LINE_RULES, "prose")


def _flushed(acc: Column) -> list[Column]:
    """The sums of characters once the open run of short lines is given to the list or to prose."""
    r = {k: acc[f"run {k}"] for k in _RUN}
    mean, total = r["said"] / r["lines"], F.greatest(F.lit(1), r["said"])
    phrases = (mean <= PHRASE_WORDS) & (r["common"] / total < 0.2)
    sentences = (mean <= 8) & (r["whole"] >= 0.8 * r["lines"]) & (r["upper"] >= 0.8 * r["lines"])
    items = (r["lines"] >= 3) & (r["n"] <= 9 * r["lines"]) & (phrases | sentences)
    more = lambda k: F.when(items, r["chars"]).otherwise(0) if k == "short lines" else F.when(items, 0).otherwise(r["chars"]) if k == "prose" else F.lit(0)
    return [(acc[k] + more(k)).cast("long").alias(k) for k in _SUMS]


def line_shares(lines: Column) -> Column:
    """Struct of the characters of the lines under every line rule and in prose; one pass, whatever the number of lines.

    Runs of unmarked short lines are list items unless they read on from line to line like wrapped prose.
    """
    zero = F.struct(*[F.lit(0).cast("long").alias(k) for k in _SUMS], *[F.lit(0).cast("long").alias(f"run {k}") for k in _RUN])

    def step(acc: Column, x: Column) -> Column:
        added = [(acc[f"run {k}"] + (F.lit(1) if k == "lines" else x[k])).cast("long").alias(f"run {k}") for k in _RUN]
        grown = F.struct(*[acc[k].alias(k) for k in _SUMS], *added)
        closed = F.transform(F.array(F.struct(*_flushed(acc))), lambda a: F.struct(
            *[(a[k] + F.when(F.coalesce(x["rule"], F.lit("prose")) == k, x["chars"]).otherwise(0)).cast("long").alias(k) for k in _SUMS],
            *[F.lit(0).cast("long").alias(f"run {k}") for k in _RUN],
        ))[0]
        return F.when(x["short"], grown).otherwise(closed)

    return F.aggregate(_measured(lines), zero, step, lambda acc: F.struct(*_flushed(acc)))


def _few_pairs(words: Column) -> Column:
    """Whether few distinct pairs of neighbouring words hold most of a text."""
    n = F.size(words)
    few = (n >= REPEAT_WORDS) & (F.size(F.array_distinct(words)) - 1 <= F.greatest(F.lit(4), REPEAT_SHARE * n))  # pairs are at least as many
    pairs = F.array_sort(F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b)))
    zero = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("distinct"), F.array().cast("array<int>").alias("top"))
    tops = lambda acc: F.slice(F.sort_array(F.concat(acc["top"], F.array(acc["run"])), asc=False), 1, 4)
    step = lambda acc, p: F.when(acc["last"] == p, F.struct(p.alias("last"), (acc["run"] + 1).alias("run"), acc["distinct"], acc["top"])).otherwise(
        F.struct(p.alias("last"), F.lit(1).alias("run"), (acc["distinct"] + 1).alias("distinct"), tops(acc).alias("top"))
    )
    held = F.aggregate(pairs, zero, step, lambda acc: F.struct(acc["distinct"], F.aggregate(tops(acc), F.lit(0), lambda a, x: a + x).alias("top")))
    wordy = _once(held, lambda h: (h["distinct"] <= 4) | ((h["distinct"] < REPEAT_SHARE * (n - 1)) & (h["top"] > 0.6 * (n - 1))))
    return F.when(few, wordy).otherwise(F.lit(False))


def repeats(text: Column) -> Column:
    """Whether a text is endless repetition: few distinct pairs of words hold most of it, or at most three characters do."""
    words = F.split(F.lower(F.trim(text, F.lit(" \t\n"))), r"\s+")
    start = F.split(F.regexp_replace(F.substring(text, 1, 64), r"\s", ""), "")  # more characters than three here settle it
    others = reduce(lambda x, _: F.replace(x, F.substring(x, 1, 1), F.lit("")), range(3), F.regexp_replace(text, r"\s", ""))
    marks = (F.size(F.array_distinct(start)) <= 3) & (F.length(F.regexp_replace(text, r"\s", "")) >= 40) & (F.length(others) == 0)
    return marks | _once(words, _few_pairs)


def _judged(spaced: Column) -> Column:
    """kind_of a text with plain spaces and line ends."""
    lines = F.filter(F.split(spaced, "\n"), lambda x: x.rlike(r"\S"))
    total = lambda s: F.greatest(F.lit(1), reduce(lambda a, b: a + b, [s[j] for j in _SUMS]))
    shares = _once(line_shares(lines), lambda s: F.struct(*[(s[k] / total(s)).alias(k) for k in _SUMS]))
    of = lambda s, kind: reduce(lambda a, b: a + b, [s[k] for k, v in LINE_RULES.items() if v == kind])
    reasons = lambda s: F.filter(F.array(*[F.when(s[k] > 0.1, F.lit(k)) for k in LINE_RULES]), lambda r: r.isNotNull())
    said = lambda s: F.struct(*[of(s, k).alias(k) for k in KINDS], s["prose"].alias("prose"), reasons(s).alias("reasons"))
    top = lambda s: F.when(s["prose"] >= 0.5, "prose").when((s["table"] >= s["list"]) & (s["table"] >= s["junk"]), "table").when(s["list"] >= s["junk"], "list").otherwise("junk")
    share = lambda s: F.when(s["prose"] >= 0.5, s["prose"]).otherwise(F.greatest(*[s[k] for k in KINDS]))
    judged = _once(_once(shares, said), lambda s: F.struct(top(s).alias("kind"), s["reasons"], F.round(share(s), 6).alias("share")))
    repeated = F.struct(F.lit("junk").alias("kind"), F.array(F.lit("repetition")).alias("reasons"), F.lit(1.0).alias("share"))
    return F.when(spaced.isNull() | ~spaced.rlike(r"\S"), None).when(repeats(spaced), repeated).otherwise(judged)


def kind_of(text: Column) -> Column:
    """Struct (kind, reasons, share): prose, list, table or junk, the line rules that more than a tenth of the
    characters fail, and the kind's share of the characters. Null for null and blank texts."""
    return _once(F.translate(text, _SPACES + _BREAKS, " " * len(_SPACES) + "\n" * len(_BREAKS)), _judged)


def failed_rules(df: DataFrame) -> DataFrame:
    """df with its statistics (see statistics) and failed_rules, the names of the published rules that a text fails, in order.

    A null text fails none; a rule whose statistic is null (a text without words) counts as failed where it asks for words.
    """
    made = statistics(df)
    tests = [F.when(F.coalesce(rule(made), F.lit(name != "too many words")), F.lit(name)) for name, rule in RULES.items()]
    failed = F.when(F.col("n_words").isNotNull(), F.filter(F.array(*tests), lambda x: x.isNotNull()))
    return made.withColumn("failed_rules", failed)


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """df with n_words, mean_word_length, symbol_ratio, punct_line_share, bullet_line_share, common_word_share, and for the
    published rules n_common_words, mark_word_ratio, ellipsis_line_share and letter_word_share.

    Words are runs of anything but white space; symbols are characters that are neither letters, digits nor white
    space; lines are those that are not blank. Null texts have null statistics; a text without words has 0 words
    and null means. All expressions are built in.
    """
    t = F.col(text)
    n_words = F.regexp_count(t, F.lit(r"[^ \t\n\r\f]+"))
    solid = F.length(F.regexp_replace(t, r"[ \t\n\r\f]", ""))
    n_lines = F.regexp_count(t, F.lit(r"(?m)^.*[^ \t\n\r\f].*$"))
    n_end = F.regexp_count(t, F.lit(r"(?m)[.!?:;][ \t]*\r?$"))
    n_bullet = F.regexp_count(t, F.lit(r"(?m)^[ \t]*[-*•▪–][ \t]"))
    n_sym = F.length(F.regexp_replace(t, r"[\p{L}\p{M}\p{N}\s]", ""))
    low = F.filter(F.split(F.lower(t), r"[^\p{L}]+"), lambda w: w != "")
    common = F.size(F.filter(low, lambda w: w.isin(*COMMON)))
    ratio = lambda a, b: F.when(b > 0, F.round(a / b, 6))
    return df.withColumns(
        {
            "n_words": n_words,
            "mean_word_length": ratio(solid, n_words),
            "symbol_ratio": ratio(n_sym, F.length(t)),
            "punct_line_share": ratio(n_end, n_lines),
            "bullet_line_share": ratio(n_bullet, n_lines),
            "common_word_share": ratio(common, F.size(low)),
            "n_common_words": common,
            "mark_word_ratio": ratio(F.regexp_count(t, F.lit(r"#|\.\.\.|…")), n_words),
            "ellipsis_line_share": ratio(F.regexp_count(t, F.lit(r"(?m)(?:\.\.\.|…)[ \t]*\r?$")), n_lines),
            "letter_word_share": ratio(F.regexp_count(t, F.lit(r"[^ \t\n\r\f\p{L}]*\p{L}[^ \t\n\r\f]*")), n_words),
        }
    )
