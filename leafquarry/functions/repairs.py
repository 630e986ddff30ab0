"""Repairs whose next step depends on the last: Arrow UDFs over whole batches, worked out once per distinct value."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words of titles.
TITLE_WORDS = frozenset(
    "the and can for with understand language text information simple able their from that this have been which when "
    "about into through using other people different communicate interaction mediation production reception reading "
    "writing oral level descriptors competence activities strategies learner learning written structure cultural "
    "appropriateness explain explaining concept concepts new public putting specific diagrams graphs data publication "
    "process control understanding repertoire sociolinguistic translating sign group case debate announcements "
    "collaborating relaying spoken speech signed media psychology argument leading phonology coherence fluency accuracy "
    "range vocabulary description relating online overall conversation discussion comprehension communication examples "
    "domains education pragmatic linguistic phonological grammatical lexical discourse signalling monitoring planning "
    "compensating turntaking cooperating interpreting facilitating mediating processing creative literature response "
    "personal expressing sustained monologue interviewing transactions collaboration plurilingual pluricultural scale "
    "framework companion volume appendix to a or of in".split()
)
# Whole tokens that reversal alone does not restore.
TOKEN_REPAIRS = {"cfiiceps": "specific", "speciifc": "specific", "cte": "etc"}
# Marks of an id that was read backwards.
ID_MARKS = (
    "gnittup", "cilbup", "_ni_", "cfiiceps", "smargaid", "shparg", "noitacil", "noitamrofni", "cte_smargaid", "cte_",
    "gninialpxe", "nialpxe", "nettirw", "ssenetairporppa", "larutluc", "erutcurts", "stpecnoc", "collaborating_ni",
    "_ot_nialpxe", "ot_nialpxe", "_wen_", "strategies_ot_", "translating_a_nettirw", "sign_text_erutcurts",
    "sociolinguistic_ssenetairporppa",
)
# What a backwards letter run stands for, from the words above; a word that reads both ways stays as it is.
FORWARD = {w[::-1]: w for w in TITLE_WORDS if len(w) > 1 and w[::-1] not in TITLE_WORDS} | TOKEN_REPAIRS
_LETTERS = re.compile("[A-Za-z]+")


def _arrow(kind: T.DataType, arrow: pa.DataType, one):
    @F.arrow_udf(kind)
    def run(values: pa.Array) -> pa.Array:
        coded = (values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values).dictionary_encode()
        return pa.array([None if v is None else one(v) for v in coded.dictionary.to_pylist()], arrow).take(coded.indices)

    return run


def peel_url(token: Column) -> Column:
    """Struct (url, trail): a greedy web address without what was glued to its end (marks, stops, a footnote's number
    after one of them) and that end; the two together are the token. Other tokens are all url."""
    end = r"(?:[*“”\"'>,;:)\].]|(?<=[)\].,;:])\d{1,2})+$"
    url = F.when(token.rlike("^https?://"), F.concat(F.substring(token, 1, 8), F.regexp_replace(F.substring(token, F.lit(9), F.length(token)), end, ""))).otherwise(token)
    return F.when(token.isNotNull(), F.struct(url.alias("url"), F.substring(token, F.length(url) + 1, F.length(token)).alias("trail")))


def readable(text: str) -> float:
    """Share of words of a title that are known; reversed known words count against it."""
    words = re.findall("[A-Za-z]{3,}", text.lower())
    worth = [1.0 if w in TITLE_WORDS else -0.35 if w[::-1] in TITLE_WORDS or w in TOKEN_REPAIRS else 0.0 for w in words]
    return sum(worth) / len(words) if words else 0.0


def title_score(title: Column) -> Column:
    """`readable` as a built-in expression; 0 for a title without words, null for null."""
    words = F.regexp_extract_all(F.lower(title), F.lit("[a-z]{3,}"), F.lit(0))
    known = sorted(TITLE_WORDS)
    turned = lambda w: F.reverse(w).isin(*known) | w.isin(*TOKEN_REPAIRS)
    worth = F.aggregate(words, F.lit(0.0), lambda a, w: a + F.when(w.isin(*known), 1.0).when(turned(w), -0.35).otherwise(0.0))
    return F.when(F.size(words) > 0, worth / F.size(words)).otherwise(F.when(title.isNotNull(), F.lit(0.0)))


def preferred_title(header: Column, other: Column) -> Column:
    """Of two titles the more readable one; nearly equal ones by length. A missing or level-only second title loses."""
    h, t = F.trim(header), F.trim(F.regexp_replace(other, r"[ \t\n\r\f]+", " "))
    hs, ts = title_score(h), title_score(t)
    return (
        F.when(F.coalesce(t, F.lit("")) == "", h).when(t.rlike(r"^(?i:pre-)?[A-Ca-c][12]\+?$"), h)
        .when(F.coalesce(h, F.lit("")) == "", t).when(ts > hs + 0.02, t).when(hs > ts + 0.02, h)
        .when(F.length(t) > F.length(h) + 5, t).otherwise(h)
    )


def _turned(run: str) -> str:
    """A letter run as it reads forward; a run that is no known backwards word and no capitalised word from its end stays."""
    made = FORWARD.get(run.lower())
    if made is None and len(run) > 4 and run[:-1].islower() and run[-1].isupper() and run.lower() not in TITLE_WORDS:
        made = run[::-1].lower()
    if made is None:
        return run
    if len(run) > 1 and run.isupper():
        return made.upper()
    return made.capitalize() if run[0].isupper() or run[-1].isupper() else made


def _other_side(word: str) -> str:
    """A word with the marks around its letters on the other side, where reading from the far end puts them."""
    first, last = (next((i for i, ch in order if ch.isalnum()), 0) for order in (enumerate(word), reversed(list(enumerate(word)))))
    return word[last + 1 :][::-1] + word[first : last + 1] + word[:first][::-1]


def _tidy(title: str) -> str:
    """A closing etc. in brackets of its own; no blank before a mark."""
    open_list = re.sub(r"\(([^()]*?),?\s*etc\.?\)$", r"\1 (etc.)", title)
    return re.sub(r"\s+(?=[,.;:])", "", re.sub(r",?\s+etc\.?$", " (etc.)", open_list)).strip(" ,")


def forward_title(title: str) -> str:
    """The forward-reading form of a title that was read backwards, word by word and then in order; others stay."""
    words = title.split()
    made = [_LETTERS.sub(lambda m: _turned(m.group()), w) for w in words]
    changed = sum(a != b for a, b in zip(words, made, strict=True))
    if len(words) > 1 and changed >= max(1, len(words) // 3):
        starts = [next((m.group()[0] for m in [_LETTERS.search(w)] if m), "") for w in (made[0], made[-1])]
        if starts[1].isupper() and not starts[0].isupper():
            made = [_other_side(w) for w in reversed(made)]
    return _tidy(" ".join(made)) if changed else " ".join(made) if words else title


def fix_reversed_title(title: Column) -> Column:
    return _arrow(T.StringType(), pa.string(), forward_title)(title)


def garbled_id(slug: Column) -> Column:
    """Whether an id still holds words read backwards: one of the known marks, or a token that stands for another."""
    low = F.lower(slug)
    marked = low.rlike("|".join(re.escape(m) for m in ID_MARKS))
    long = [w for w in FORWARD if len(w) > 3 or w in TOKEN_REPAIRS]
    return F.coalesce(marked | F.exists(F.split(low, "[_-]"), lambda t: t.isin(*sorted(long))), F.lit(False))


def clean_id(slug: Column, title: Column) -> Column:
    """The id of an artifact; re-derived from its repaired title where one of its tokens reads backwards."""
    from .text import slugify

    garbled = garbled_id(slug)
    prefix = F.split(slug, "_")[0]
    return F.when(garbled, F.concat(prefix, F.lit("_"), slugify(fix_reversed_title(title)))).otherwise(slug)


def stitched(texts: list[str | None]) -> list[str]:
    """Bands of one box joined where the end of one is the start of the next (12 to 100 characters), repeats dropped."""
    made: list[str] = []
    for text in texts:
        t = " ".join((text or "").split())
        if not t or any(t in m for m in made):
            continue
        if made and made[-1] in t:
            made[-1] = t
            continue
        size = next((k for k in range(min(100, len(t), len(made[-1])), 11, -1) if made[-1].endswith(t[:k])), 0) if made else 0
        if size:
            made[-1] += t[size:]
        else:
            made.append(t)
    return [m for i, m in enumerate(made) if not any(later.startswith(m) for later in made[i + 1 :])]


def stitch_bands(texts: Column) -> Column:
    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else stitched(v) for v in values.to_pylist()], pa.list_(pa.string()))

    return run(texts)


BOX = T.StructType([T.StructField(c, T.DoubleType()) for c in ("x0", "y0", "x1", "y1")])


def stacked(boxes: list[dict], gap: float = 12.0, tolerance: float = 8.0) -> list[dict]:
    """Boxes over each other in one column merged: each box goes to the first stack whose last box it follows."""
    stacks: list[list[dict]] = []
    for b in sorted(boxes, key=lambda b: (round(b["x0"]), b["y0"], b["x1"], b["y1"])):
        home = next(
            (s for s in stacks if abs(b["x0"] - s[-1]["x0"]) <= tolerance and abs(b["x1"] - s[-1]["x1"]) <= tolerance and b["y0"] <= s[-1]["y1"] + gap),
            None,
        )
        if home is None:
            stacks.append([b])
        else:
            home.append(b)
    pick = lambda s, f, k: f(b[k] for b in s)
    made = [{"x0": pick(s, min, "x0"), "y0": pick(s, min, "y0"), "x1": pick(s, max, "x1"), "y1": pick(s, max, "y1")} for s in stacks]
    return sorted(made, key=lambda b: (b["y0"], b["x0"]))


def merge_stacks(boxes: Column, gap: float = 12.0, tolerance: float = 8.0) -> Column:
    kind = pa.list_(pa.struct([(c, pa.float64()) for c in ("x0", "y0", "x1", "y1")]))

    @F.arrow_udf(T.ArrayType(BOX))
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else stacked(v, gap, tolerance) for v in values.to_pylist()], kind)

    return run(boxes)


def reading_order(elements: list[dict], width: float) -> list[int]:
    """Positions of elements (kind, x0, y0, x1, y1) in reading order.

    Prose and tables are two queues by height; the higher head goes first, except that prose beside a table that
    starts left of it within the table's band goes first whatever its height. That rule is no total order, so it is a
    merge and not a sort.
    """
    by = lambda k: sorted((i for i, e in enumerate(elements) if (e["kind"] == "table") == k), key=lambda i: (elements[i]["y0"], elements[i]["x0"], i))
    prose, tables, out = by(False), by(True), []
    while prose and tables:
        p, t = elements[prose[0]], elements[tables[0]]
        beside = p["x1"] <= t["x0"] + 0.02 * width and t["y0"] - 2 <= p["y0"] <= t["y1"]
        out.append(prose.pop(0) if beside or p["y0"] <= t["y0"] else tables.pop(0))
    return out + prose + tables


def in_reading_order(elements: Column, width: float) -> Column:
    """Array of 0-based positions of the elements of a page."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else reading_order(v, width) for v in values.to_pylist()], pa.list_(pa.int32()))

    return run(elements)


def opcodes(old: Column, new: Column) -> Column:
    """Aligned difference of two arrays of lines: array of (tag, old_from, old_to, new_from, new_to)."""
    names = ["tag", "old_from", "old_to", "new_from", "new_to"]
    kind = T.ArrayType(T.StructType([T.StructField(n, T.StringType() if n == "tag" else T.IntegerType()) for n in names]))
    arrow = pa.list_(pa.struct([(n, pa.string() if n == "tag" else pa.int32()) for n in names]))

    @F.arrow_udf(kind)
    def run(olds: pa.Array, news: pa.Array) -> pa.Array:
        made = []
        for a, b in zip(olds.to_pylist(), news.to_pylist(), strict=True):
            ops = SequenceMatcher(a=a or [], b=b or [], autojunk=False).get_opcodes()
            made.append([dict(zip(names, op, strict=True)) for op in ops])
        return pa.array(made, arrow)

    return run(old, new)


def first_difference(a: str, b: str) -> int:
    """0-based position of the first differing character, -1 when equal; found by halving, not by characters."""
    if a == b:
        return -1
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


def first_diff(a: Column, b: Column) -> Column:
    @F.arrow_udf(T.IntegerType())
    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        pairs = zip(left.to_pylist(), right.to_pylist(), strict=True)
        return pa.array([None if x is None or y is None else first_difference(x, y) for x, y in pairs], pa.int32())

    return run(a, b)


def tone_marks(text: Column) -> Column:
    """Capture marks of a scanned transcript as tone marks, in a fixed order of patterns."""
    # Patterns and replacements in the order they apply.
    steps = [
        (r"\x{a0}", " "), ("[‘’]", "'"), ("[“”]", '"'), (r"\$+(?=[A-Za-z])", "ˎ"),
        (r'(^|[\s(|/>])["„]+ *(?=[A-Za-z])', "$1ˇ"), (r"(^|[\s(|/>])['`´]+(?=[A-Za-z])", "$1ˈ"),
        (r"(^|[\s(|/>]),(?=[A-Za-z])", "$1ˎ"), (r"(?<=[A-Za-z]),(?=[A-Za-z])", "ˎ"),
        (r"(^|[\s(|/>])\.(?=[A-Za-z])", "$1·"), (r"(?<=[A-Za-z])\.(?=[A-Za-z])", "·"), (r"/\.", "/·"),
        (r"\s+[I|]\s+", " | "), (" {2,}", " "),
    ]
    for pattern, to in steps:
        text = F.regexp_replace(text, pattern, to)
    return F.trim(text)
