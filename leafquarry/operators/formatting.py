"""The fixed order of format steps on Markdown lines, and steps that only make sense within it.

Rows are the lines that hold something (doc_id, line_no, line), with the number of blank lines before each (gap) and
whether it is fenced; inside fences blank lines are rows too. So the line before and the line after are one step away,
and spacing is arithmetic on the gap, not rows that come and go. Every step is a DataFrame transform; the order is part
of the result, so it is an explicit list. Fenced blocks are carried through untouched. One document's lines are one
window partition, as order is; the steps share one shuffle, and no frame reaches ahead of the next line.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .lines import BEFORE, SO_FAR

Step = Callable[[DataFrame], DataFrame]

# Forms of lines.
HEADING = r"^#{1,6}\s"
ITEM = r"^(?:[-*•▪–·‣▶►] |[0-9]{1,3}[.)] )"
MARKER = r"^<!--\s*page:([0-9]+)\s*-->$"
CAPTION = r"^\*?Page \**[0-9]+\**\*?$"
CAPS = r"^[A-Z0-9 ,:–\-/&()]+$"
STARTER = (
    r"^(?:#{1,6}\s|<!--|!\[|-{3,}\s*$|\||```|[-*] |>|[0-9]+\.\s|\*?Page \**[0-9]|\*\*[^*]+\*\*$|(?:C2|C1|B2\+?|B1\+?|A2\+?|A1\+?|Pre-A1)$"
    r"|(?:CHAPTER|APPENDIX|FIGURE|TABLE)\s+[0-9]|FOREWORD|PREFACE|CONTENTS$|LIST OF |[0-9]+(?:\.[0-9]+)+\.\s+[A-Z])"
)
NEXT_ITEM = r";\s+(?:f|-)\s+(?=[A-Za-z“\"'(\[])"  # the next item of a list inside a line
SPLIT_SECTION = r"(?i)\b(?:sections?|chapters?|appendix)$"
SENTENCE_END = r"[.!?;:)\]\"']\s*$"
CONTENTS_PAGES = 10  # the contents end at this page at the latest


def _doc():
    return Window.partitionBy("doc_id").orderBy("line_no")


def with_fences(lines: DataFrame) -> DataFrame:
    """lines with `fenced`: inside a fenced block or a fence itself."""
    mark = F.trim("line").startswith("```")
    return lines.withColumn("fenced", ((F.sum(mark.cast("int")).over(_doc().rowsBetween(*SO_FAR)) % 2) == 1) | mark)


def with_gaps(lines: DataFrame) -> DataFrame:
    """Rows of the lines that hold something or are fenced: doc_id, line_no, gap, fenced, line."""
    full = with_fences(lines).where(F.col("fenced") | (F.trim("line") != "") | F.col("alone"))
    gap = F.col("line_no") - F.coalesce(F.lag("line_no").over(_doc()), F.lit(0)) - 1
    return full.select("doc_id", "line_no", gap.alias("gap"), "fenced", "line")


def _is(pattern: str, c: str = "line") -> Column:
    return F.trim(c).rlike(pattern)


def on_prose(fn: Callable[[Column], Column]) -> Step:
    """A step that rewrites every line outside fences."""
    return lambda df: df.withColumn("line", F.when(F.col("fenced"), F.col("line")).otherwise(F.transform(F.array("line"), fn)[0]))


def _parted(fn: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: F.split(fn(x), "\n", -1)


def into_lines(*fns: Callable[[Column], Column]) -> Step:
    """A step that rewrites every line outside fences as one or more lines, parted by line feeds, by one function after
    the other."""

    def step(df: DataFrame) -> DataFrame:
        pieces = F.array("line")
        for fn in fns:
            pieces = F.flatten(F.transform(pieces, _parted(fn)))
        full = F.filter(F.transform(pieces, lambda x, i: F.struct(x.alias("line"), i.alias("i"))), lambda x: F.trim(x["line"]) != "")
        spaced = lambda own: F.transform(own, lambda x, j: F.struct(
            x["line"].alias("line"), F.when(j == 0, F.col("gap") + x["i"]).otherwise(x["i"] - F.get(own, j - 1)["i"] - 1).alias("gap")
        ))
        many = F.when(F.col("fenced") | (F.trim("line") == ""), F.array(F.struct("line", "gap"))).otherwise(F.transform(F.array(full), spaced)[0])
        made = df.select("doc_id", "line_no", "fenced", F.posexplode(many).alias("_k", "x")).select("doc_id", "line_no", "_k", "fenced", "x.line", "x.gap")
        return _plain(made.withColumn("line_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no", "_k"))))

    return step


def near_lines(df: DataFrame) -> DataFrame:
    """df with the lines before and after each (_p, _n)."""
    return df.withColumns({"_p": F.lag("line").over(_doc()), "_n": F.lead("line").over(_doc())})


def _plain(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "line_no", "gap", "fenced", "line")


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def joined_to_previous(df: DataFrame, joins: Column) -> DataFrame:
    """Lines where `joins` holds (over near_lines) are put behind the line before them."""
    flagged = near_lines(df).withColumn("_j", _sure(joins & ~F.col("fenced") & F.col("_p").isNotNull()))
    grouped = flagged.withColumn("_i", F.sum((~F.col("_j")).cast("int")).over(_doc().rowsBetween(*SO_FAR)))
    parts = F.array_sort(F.collect_list(F.struct("line_no", "line", "gap")))
    text = F.array_join(F.transform(parts, lambda x, i: F.when(i > 0, F.trim(x["line"])).otherwise(F.rtrim(x["line"]))), " ")
    one = F.when(F.size(parts) > 1, text).otherwise(F.get(parts, F.lit(0))["line"])
    return grouped.groupBy("doc_id", "_i").agg(
        F.min("line_no").alias("line_no"), F.get(parts, F.lit(0))["gap"].alias("gap"), F.bool_or("fenced").alias("fenced"), one.alias("line")
    ).drop("_i")


def with_blanks(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """A blank line before and after the lines (over near_lines) where the conditions hold, unless one stands there."""
    seen = near_lines(df).withColumns({"_b": _sure(before & ~F.col("fenced") & F.col("_p").isNotNull()), "_a": _sure(after & ~F.col("fenced"))})
    asked = F.col("_b") | _sure(F.lag("_a").over(_doc()))
    return _plain(seen.withColumn("gap", F.when(asked, F.greatest("gap", F.lit(1))).otherwise(F.col("gap"))))


def without(df: DataFrame, dropped: Column) -> DataFrame:
    """df without the rows where `dropped` holds; the blank lines before one stay before the next row."""
    flagged = df.withColumn("_d", _sure(dropped & ~F.col("fenced")))
    held = F.when(F.lag("_d").over(_doc()), F.lag("gap").over(_doc()))
    return _plain(flagged.withColumn("_g", F.greatest("gap", F.coalesce(held, F.lit(0)))).where("not _d").withColumn("gap", F.col("_g")))


def drop_repeats(df: DataFrame) -> DataFrame:
    """A line equal to the one right before it goes."""
    return without(near_lines(df), (F.col("_p") == F.col("line")) & (F.col("gap") == 0))


def drop_repeated_markers(df: DataFrame) -> DataFrame:
    """A page marker equal to the last page marker before it goes, whatever stands between."""
    page = F.regexp_extract(F.trim("line"), MARKER, 1)
    marked = df.withColumn("_m", F.when((page != "") & ~F.col("fenced"), page))
    return without(marked.withColumn("_l", F.last("_m", True).over(_doc().rowsBetween(*BEFORE))), F.col("_m") == F.col("_l"))


def bullets_inline(line: Column) -> Column:
    """Bullet glyphs inside a line, and the letter f that a symbol font leaves between items, start list items."""
    arrows = F.regexp_replace(F.regexp_replace(line, "(?<=\\S)[ \t]*►[ \t]*", "\n- "), "^([ \t]*)►[ \t]*", "$1- ")
    after_list = F.regexp_replace(arrows, NEXT_ITEM, ";\n- ")
    return F.regexp_replace(after_list, r":\s*f(?=\*\*)", ":\n\n- ")


def list_runs(line: Column) -> Column:
    """An item that holds further items after semicolons, as items of their own without the semicolons."""
    parts = F.split(F.substring(F.trim(line), F.lit(3), F.length(line)), r";\s+(?:f|-)\s+(?=[A-Za-z])")
    item = lambda p: F.concat(F.lit("- "), F.regexp_replace(F.trim(p), ";+$", ""))
    run = F.trim(line).startswith("- ") & (F.size(parts) > 1)
    return F.when(run, F.array_join(F.transform(F.filter(parts, lambda p: F.trim(p) != ""), item), "\n")).otherwise(line)


def join_split_bold(df: DataFrame) -> DataFrame:
    """Paragraphs that were parted at a bold word or between a section's name and its number."""
    bold = F.col("_p").rlike("[a-z,;:%0-9]$") & F.col("line").rlike(r"^\*\*[a-z]")
    goes_on = F.col("_p").rlike(r"\*\*[^*]+\*\*$") & ~F.col("_p").rlike(r"^\*\*[^*]+\*\*$") & F.col("line").rlike("^[a-z]")
    numbered = F.col("_p").rlike(SPLIT_SECTION) & F.col("line").rlike(r"^[0-9]+(?:\.[0-9]+)+")
    return joined_to_previous(df, (F.col("gap") > 0) & (bold | goes_on | numbered))


def join_wraps(df: DataFrame) -> DataFrame:
    """Soft-wrapped prose: a line right under a line of prose that ends no sentence, or that starts in lower case."""
    prose = lambda c: ~_is(STARTER, c) & ~_is(ITEM, c)
    title = (F.length(F.trim("_p")) < 60) & _is(CAPS, "_p")
    runs_on = F.col("line").rlike(r"^\s*\p{Ll}") | ~F.col("_p").rlike(SENTENCE_END)
    entry = F.col("_p").rlike(r" — [0-9]+\s*$")  # of a table of contents
    return joined_to_previous(df, (F.col("gap") == 0) & prose("_p") & prose("line") & runs_on & ~title & ~entry & ~_is(CAPS))


def _led_by(df: DataFrame, own: Column, tail: Column) -> DataFrame:
    """df with `_in`: a line where `tail` holds, and the last line before it where it does not hold is an `own` one."""
    seen = near_lines(df).withColumn("_t", _sure(tail & ~F.col("fenced"))).withColumn("_own", F.when(~F.col("_t"), _sure(own & ~F.col("fenced"))))
    return seen.withColumn("_in", F.col("_t") & _sure(F.last("_own", True).over(_doc().rowsBetween(*SO_FAR)))).drop("_p", "_n", "_t", "_own")


def repair_lists(df: DataFrame) -> DataFrame:
    """Wrapped tails of list items go back to their items; blank lines between two items go."""
    tail = ~_is(STARTER) & ~_is(ITEM) & (F.col("line").rlike(r"^\s*\p{Ll}") | ~F.col("_p").rlike(SENTENCE_END)) & ~_is(CAPS)
    return tighten_lists(joined_to_previous(_led_by(df, _is(r"^[-*•▪–·‣▶►] "), tail), F.col("_in")))


def tighten_lists(df: DataFrame) -> DataFrame:
    """Blank lines between two list items go."""
    item = lambda c: _is(r"^([-*] |[0-9]+[.)] )", c)
    both = item("line") & item("_p") & ~F.col("fenced")
    return _plain(near_lines(df).withColumn("gap", F.when(_sure(both), 0).otherwise(F.col("gap"))))


def demote_footnotes(line: Column) -> Column:
    """A footnote is no heading."""
    return F.regexp_replace(line, r"^\s*#{1,6}\s+(?=[0-9]{1,2}\.\s)", "")


def promote_headings(line: Column) -> Column:
    """Chapters and numbered sections become headings of their depth."""
    s = F.trim(line)
    own = ~s.rlike(HEADING) & X.heading_depth(s).isNotNull()
    return F.when(s.rlike(r"(?i)^chapter\s+[0-9]+:"), F.concat(F.lit("## "), s)).when(own, X.numbered_heading(s)).otherwise(line)


def named_sections(line: Column) -> Column:
    """Sections with a name of their own."""
    s = F.trim(line)
    return F.when(s == "FOREWORD", "## Foreword").when(s == "PREFACE WITH ACKNOWLEDGEMENTS", "## Preface with acknowledgements").otherwise(line)


def _contents() -> tuple[Column, Column]:
    """Whether a line is the contents' heading, and whether it stands in them."""
    head = F.trim("line").isin("## Contents", "CONTENTS") & ~F.col("fenced")
    page = F.regexp_extract(F.trim("line"), MARKER, 1).try_cast("int")
    event = F.when(head, 1).when(page >= CONTENTS_PAGES, 0)
    return head, F.coalesce(F.last(event, True).over(_doc().rowsBetween(*SO_FAR)), F.lit(0)) == 1


def format_contents(df: DataFrame) -> DataFrame:
    """Entries between the contents' heading and the marker of a page from CONTENTS_PAGES on, formatted one by one.

    Blank lines go there; an entry behind one that ends with a colon, or that starts with a bracket, is its second line.
    """
    head, zone = _contents()
    entry = zone & ~head & ~_is(MARKER) & ~_is(CAPTION) & ~F.col("fenced")
    seen = df.withColumn("_e", entry).withColumn("_2", F.lag("_e").over(_doc()))
    second = F.col("_e") & F.col("_2") & (F.col("_p").rlike(r":\s*(?: — [0-9]+)?$") | _is(r"^(?:- |#+ )?\("))
    merged = joined_to_previous(seen.withColumn("line", F.when(F.col("_e"), F.regexp_replace("line", r"^\s*(?:- |#+ )(?=\()", "")).otherwise(F.col("line"))), second)
    whole = merged.withColumn("_e", entry).withColumn("_h", head)
    split = X.toc_title_page(F.regexp_replace("line", r" — ([0-9]+) (\(.*)$", " $2 — $1"))
    made = F.transform(F.array(split), lambda x: X.toc_entry(x["title"], x["page"]))[0]
    line = F.when(F.col("_e"), made).when(F.col("_h"), "## Contents").otherwise(F.col("line"))
    gap = F.when(F.col("_e"), F.when(F.lag("_h").over(_doc()), 1).otherwise(0)).otherwise(F.col("gap"))
    return _plain(whole.withColumn("_gap", gap).withColumn("line", line).withColumn("gap", F.col("_gap")))


def split_trailing_captions(line: Column) -> Column:
    """A page caption at the end of a line of text becomes a line of its own."""
    return F.regexp_replace(line, r"^(?!\*?Page )(.*\S)[ \t]+(\*?Page \*\*[0-9]+\*\*\*?)[ \t]*$", "$1\n\n$2")


def _exchanged(df: DataFrame, first: Column) -> DataFrame:
    """Rows where `first` holds change places with the next ones, which follow them without a blank line."""
    seen = df.withColumn("_f", _sure(first)).withColumn("_s", _sure(F.lag("_f").over(_doc())))
    line = F.when(F.col("_f"), F.lead("line").over(_doc())).when(F.col("_s"), F.lag("line").over(_doc())).otherwise(F.col("line"))
    return _plain(seen.withColumn("line", line).withColumn("gap", F.when(F.col("_s"), 0).otherwise(F.col("gap"))))


def move_sections_behind_markers(df: DataFrame) -> DataFrame:
    """A section heading right before a page marker moves behind it where its first subsection follows there."""
    after = near_lines(df).withColumn("_n2", F.lead("line", 2).over(_doc()))
    head = _is(r"^###\s+[0-9]+\.[0-9]+\.") & ~F.col("fenced")
    return _exchanged(after, head & _is(MARKER, "_n") & _is(r"^#{4,6}\s+[0-9]+\.[0-9]+\.[0-9]+", "_n2"))


def space_paragraphs(df: DataFrame) -> DataFrame:
    """A blank line between two lines of prose and after a line that is all bold."""
    prose = lambda c: ~_is(STARTER, c) & ~_is(ITEM, c)
    return with_blanks(df, (prose("line") & prose("_p")) | _is(r"^\*\*[^*]+\*\*$", "_p"), F.lit(False))


_OPENER = r"^(?:- *)?(?i:chapter)\s+([0-9]+)(?:\s+([^a-z:]*))?$"


def chapter_openings(df: DataFrame) -> DataFrame:
    """'Chapter 3' with a title in capitals, on its line or the next ones, as a heading and the title under it."""
    opened = lambda c: F.regexp_replace(F.regexp_replace(F.trim(c), _OPENER, "## Chapter $1\n$2"), "\n$", "")
    parted = into_lines(lambda c: F.when(F.trim(c).rlike(_OPENER), opened(c)).otherwise(c))(df)
    title = _is(CAPS) & ~_is(MARKER)
    led = _led_by(parted, _is(r"^## Chapter [0-9]+$"), title)
    under = joined_to_previous(led, F.col("_in") & F.col("_p").rlike(CAPS))
    made = near_lines(under)
    close = F.when(_sure(_is(r"^## Chapter [0-9]+$", "_p") & _is(CAPS)), 0).otherwise(F.col("gap"))
    return with_blanks(_plain(made.withColumn("gap", close)), _is(r"^## Chapter [0-9]+$"), _is(CAPS) & _is(r"^## Chapter [0-9]+$", "_p"))


def space_headings(df: DataFrame) -> DataFrame:
    """A blank line before and after headings that stand against text; a chapter keeps its title right under it, and the
    entries of the contents stay together."""
    first, zone = _contents()
    seen = df.withColumn("_z", zone & ~first)
    head = F.col("line").startswith("#")
    title = _is(r"^## Chapter [0-9]+$") & _is(CAPS, "_n")
    return with_blanks(seen, head & ~F.col("_z"), head & ~F.col("_z") & ~F.col("_n").startswith("#") & ~title)


def level_callouts(df: DataFrame) -> DataFrame:
    """A paragraph on a level ('Level C2, ...') with the lines up to its sentence's end, as a list item."""
    # How such paragraphs start.
    starts = _is(r"^(?:Level C2,|Level A1 \(Breakthrough\))")
    tail = (F.col("gap") == 0) & ~_is(STARTER) & ~_is(ITEM) & ~_is("^Level ") & ~F.col("_p").rlike(SENTENCE_END)
    led = _led_by(df, starts, tail)
    marked = led.withColumn("line", F.when(starts & ~F.col("fenced"), F.concat(F.lit("- "), F.trim("line"))).otherwise(F.col("line")))
    return joined_to_previous(marked, F.col("_in"))


def glued_leads(line: Column) -> Column:
    """A long sentence glued behind the closing bracket of a list item becomes a paragraph of its own."""
    return F.when(F.trim(line).startswith("- "), F.regexp_replace(line, r"^(.*?(?:\.\)\.?|\)\.))\s+((?:The|A|This|In) .{76,})$", "$1\n\n$2")).otherwise(line)


def open_quotes(line: Column) -> Column:
    """Quoted lines that were collapsed into one, each on a line of its own with an empty one between."""
    parts = F.filter(F.transform(F.split(line, r"\s+>\s*"), lambda p: F.trim(F.regexp_replace(p, r"^\s*>+\s*", ""))), lambda p: p != "")
    many = line.rlike(r"^\s*>.*\S\s+>\s") & (F.size(parts) > 1)
    return F.when(many, F.array_join(F.transform(parts, lambda p: F.concat(F.lit("> "), p)), "\n>\n")).otherwise(line)


def drop_repeated_titles(df: DataFrame) -> DataFrame:
    """The title of a quoted box that stands under it once more, alone or before its first sentence."""
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, r"^\s*>\s*", ""), "[*“”\"]", ""))
    said = df.withColumn("_q", F.when(~_is(r"^>\s*$"), F.col("line")))
    seen = said.withColumn("_b", F.last("_q", True).over(_doc().rowsBetween(*BEFORE)))
    title = bare(F.regexp_extract("_b", r"^>\s*\*\*(.+?)\*\*\s*$", 1))
    own = bare(F.col("line"))
    asked = _sure((title != "") & ~F.col("fenced") & F.col("_q").isNotNull())
    rest = F.regexp_replace(F.substring(own, F.length(title) + 1, F.length("line")), "^[ :–-]+", "")
    glued = asked & F.lower(own).startswith(F.lower(title)) & (own != title) & (rest != "")
    cut = F.when(_sure(glued), F.concat(F.lit("> "), rest)).otherwise(F.col("line"))
    return without(seen.withColumn("_same", asked & (F.lower(own) == F.lower(title))).withColumn("line", cut), F.col("_same"))


def drop_labels_under_pictures(df: DataFrame) -> DataFrame:
    """Short labels that follow a picture or a text diagram go, up to the next structure or sentence of prose.

    A label has at most six words and no end of a sentence; behind a diagram only labels that stand in it go.
    """
    fence = F.trim("line").startswith("```")
    structure = _is(r"^(?:#|<!--|>|\||- |\*?Page )") | ((F.length("line") > 80) & F.col("line").rlike(r"[.?!]$"))
    event = F.when(fence, "fence").when(~F.col("fenced") & _is(r"^!\["), "picture").when(~F.col("fenced") & structure, "prose")
    state = df.withColumn("_e", event).withColumns({
        "_l": F.last("_e", True).over(_doc().rowsBetween(*SO_FAR)), "_seg": F.sum(_sure(F.col("_e") == "prose").cast("int")).over(_doc().rowsBetween(*SO_FAR)),
    })
    form = F.lower(F.trim(F.regexp_replace("line", r"[^\p{L}\p{N} ]", "")))
    inside = F.collect_set(F.when(F.col("fenced") & ~fence, form)).over(Window.partitionBy("doc_id", "_seg"))
    label = F.col("_e").isNull() & (F.size(F.split(F.trim("line"), r"\s+")) <= 6) & ~F.col("line").rlike(r"[.?!:;]$") & ~_is(ITEM)
    known = state.withColumn("_k", F.array_contains(inside, form))
    return without(known, label & ((F.col("_l") == "picture") | ((F.col("_l") == "fence") & F.col("_k"))))


def space_captions(df: DataFrame) -> DataFrame:
    """A blank line before a page caption, so that no footnote or text is glued to it."""
    return with_blanks(df, _is(CAPTION), F.lit(False))


def caption_first(df: DataFrame) -> DataFrame:
    """A visible page caption that follows its machine marker, blank lines aside, moves before it."""
    number = lambda c: F.regexp_extract(F.trim(c), r"([0-9]+)", 1)
    return _exchanged(near_lines(df), _is(MARKER) & _is(CAPTION, "_n") & (number("line") == number("_n")) & ~F.col("fenced"))


def page_blocks(df: DataFrame) -> DataFrame:
    """Caption, machine marker and blank lines around them; caption and marker of a page stay together."""
    lone = _is(MARKER) & ~_sure(_is(CAPTION, "_p"))
    return with_blanks(caption_first(df), lone | _is(CAPTION), _is(MARKER))


def collapse_blanks(df: DataFrame) -> DataFrame:
    """One blank line at most, none before the first line."""
    first = F.lag("line").over(_doc()).isNull()
    return _plain(df.withColumn("gap", F.when(first & ~F.col("fenced"), 0).otherwise(F.least("gap", F.lit(1)))))


STEPS: list[tuple[str, Step]] = [
    ("literal repairs", on_prose(lambda c: X.replace_all(c, X.TYPOS))),
    ("inline bullets and list runs", into_lines(list_runs, bullets_inline)),
    ("bold and section wraps", join_split_bold),
    ("repeated lines", drop_repeats),
    ("repeated page markers", drop_repeated_markers),
    ("soft wraps", join_wraps),
    ("bullets", on_prose(X.bullet_line)),
    ("list repair", repair_lists),
    ("footnotes are no headings", on_prose(demote_footnotes)),
    ("headings", on_prose(promote_headings)),
    ("contents", format_contents),
    ("named sections", on_prose(named_sections)),
    ("trailing captions", into_lines(split_trailing_captions)),
    ("sections behind markers", move_sections_behind_markers),
    ("paragraph spacing", space_paragraphs),
    ("page blocks", page_blocks),
    ("chapter openings", chapter_openings),
    ("heading spacing", space_headings),
    ("inline bullets again", into_lines(bullets_inline)),
    ("list repair again", repair_lists),
    ("level callouts", level_callouts),
    ("leads glued to lists, collapsed quotes, web addresses and footnotes", into_lines(glued_leads, open_quotes, X.sanitize_urls, X.split_glued_footnotes)),
    ("blank before captions", space_captions),
    ("labels under pictures", drop_labels_under_pictures),
    ("repeated box titles", drop_repeated_titles),
    ("bold marks", on_prose(X.bold_normal)),
    ("page blocks again", page_blocks),
    ("blank runs", collapse_blanks),
    ("list blanks", tighten_lists),
]


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line of the texts: doc_id, line_no (from 1), line, alone (the first line of a text that is all blank)."""
    lines = F.split("text", "\n", -1)
    rows = docs.where("text is not null").select("doc_id", F.col("text").rlike(r"\S").alias("_s"), F.posexplode(lines).alias("_k", "line"))
    return rows.select("doc_id", (F.col("_k") + 1).alias("line_no"), "line", (~F.col("_s") & (F.col("_k") == 0)).alias("alone"))


def texts_of(rows: DataFrame) -> DataFrame:
    """doc_id, text of rows with gaps."""
    parts = F.array_sort(F.collect_list(F.struct("line_no", "gap", "line")))
    text = F.array_join(F.transform(parts, lambda x: F.concat(F.repeat(F.lit("\n"), x["gap"].cast("int")), x["line"])), "\n")
    return rows.groupBy("doc_id").agg(F.when(text.rlike(r"\S"), text).otherwise("").alias("text"))


def format_documents(docs: DataFrame, steps: Sequence[tuple[str, Step]] = STEPS) -> DataFrame:
    """doc_id, text of every document after all steps in order; null texts are left out, blank ones come out empty.

    Formatting twice changes nothing more. Blank lines at the end of a text go.
    """
    made = with_gaps(line_rows(docs.select("doc_id", "text")))
    for _, step in steps:
        made = made.transform(step)
    return texts_of(made)


PAGE_STEPS = ("soft wraps", "bullets", "list repair", "paragraph spacing", "heading spacing", "labels under pictures", "blank runs")


def page_markdown(lines: DataFrame, taller: float = 1.5) -> DataFrame:
    """Markdown of pages from their layout lines: doc_id, page, markdown.

    lines: doc_id, page, line_no, text, size; blank texts part paragraphs. A line is a heading if it is numbered, all
    capitals, or `taller` points above the median size of its document, which is its depth too; a figure's caption
    becomes the figure's picture, under which short labels go; items, wraps and hyphens at line ends are repaired as
    in the format order. Pages are told apart by their number, null included; a page without text has no row.
    """
    body = lines.groupBy("doc_id").agg(F.percentile_approx("size", 0.5).alias("_body"))
    t = F.trim("text")
    number = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)+)\.?\s+\p{Lu}", 1)
    depth = F.least(F.size(F.split(number, r"\.")) + 1, F.lit(4))
    tall = F.coalesce(F.col("size") >= F.col("_body") + taller, F.lit(False)) & (F.length(t) <= 90)
    figure = F.concat(F.lit("!["), F.regexp_replace(t, r"[\[\]*]", ""), F.lit("](assets/figures/figure_"), F.lpad(F.regexp_extract(t, "([0-9]+)", 1), 2, "0"), F.lit(".png)"))
    capitals = t.rlike(r"^[A-Z][A-Z ,&-]{3,}$")
    line = F.when(X.is_caption(t), figure).when(number != "", F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), t)).when(tall | capitals, F.concat(F.lit("## "), t)).otherwise(F.rtrim("text"))
    keyed = lines.where("text is not null").join(body, "doc_id", "left").select("doc_id", "page", "line_no", line.alias("line"))
    rows = keyed.select(F.to_json(F.struct("doc_id", "page")).alias("doc_id"), "line_no", "line", F.lit(False).alias("alone"))
    made = with_gaps(rows)
    for name, step in STEPS:
        if name in PAGE_STEPS:
            made = made.transform(step)
    made = with_blanks(made, _is(r"^!\["), F.lit(False))
    key = F.from_json("doc_id", "doc_id string, page int")
    texts = texts_of(made).select(key.alias("k"), X.join_hyphens(F.col("text")).alias("markdown"))
    return texts.select("k.doc_id", "k.page", "markdown")
