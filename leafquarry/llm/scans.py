"""Repair of text from scanned pages.

A lexicon of frequent words is counted over all text that was not scanned (words above a fixed rate, so it has a proven
bound). The body rows of a page, furniture aside, are one stream of words without line ends, with the last word of the
page before and the first one of the page after at its ends. The stream is decoded by one lattice: an arc reads a word
as it stands, as another word that recognition turned into it, as several run together, as one with the next word
(split by a space) or, over a line end, as one without its hyphen. The cheapest path under the lexicon is the text.
Confusions are searched along the prefixes of lexicon words, so every reading within the stated number of them is seen.
Paragraph boundaries of a page are chosen by dynamic programming over its rows. A page is the largest thing a task
assembles.
"""

from __future__ import annotations

import math
import re
import unicodedata
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.look import look
from ..session import cut

RATE = 4e-5  # share of all words above which a word is in the lexicon: at most 1 / RATE = 25,000 words
TOP, FOOT = 70.0, 750.0  # furniture stands above or below these heights
SMALL = 9.0  # size below which a row without a height counts as furniture
KEPT = 500_000  # words whose readings a worker keeps before it starts over
UNKNOWN = 16.0  # cost of a word that nothing fits
NOISE = 6.0  # cost of one misreading
PLAIN = 9.0  # cost of a known form that the lexicon does not count by itself
MARKS = "-¬"
# What a recogniser writes and what it stands for.
CONFUSIONS = [
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("8", "b"), ("6", "g"), ("9", "g"), ("3", "e"), ("4", "a"), ("2", "z"),
    ("c", "e"), ("e", "c"), ("q", "g"), ("f", "t"), ("t", "f"), ("l", "i"), ("i", "l"), ("rn", "m"), ("m", "rn"),
    ("cl", "d"), ("d", "cl"), ("li", "h"), ("h", "li"), ("ii", "u"), ("u", "ii"), ("m", "in"), ("in", "m"), ("vv", "w"),
    ("w", "vv"), ("fi", "ti"), ("tl", "th"), ("nn", "m"), ("n", "u"), ("u", "n"), ("h", "b"), ("b", "h"), ("|", "l"), ("!", "l"), ("$", "s"), ("im", "nn"),
]
_BY_FIRST: dict[str, list[tuple[str, str]]] = {}
for _was, _meant in CONFUSIONS:
    _BY_FIRST.setdefault(_was[0], []).append((_was, _meant))
_TOKEN = re.compile(r"[^\s]+")
_STRIP = ".,;:?!()[]{}\"'“”‘’«»…*_`"
_LETTER = re.compile(r"[^\W\d_]")
_HIGH = re.compile(r"[^\W\d_\x00-\u024f]")  # letters that may be of another script
_DASH = re.compile(r"([–—])")  # between words, each of them decoded by itself
_CODE = re.compile(r"(?:pre-)?[a-l]\d[+.]?\d?$|[ivxlcdm]+$|\d+$", re.IGNORECASE)
DECODED = T.StructType([
    T.StructField("text", T.StringType()), T.StructField("hyphen", T.BooleanType()), T.StructField("misread", T.BooleanType()),
])


def text_rows(rows: DataFrame) -> DataFrame:
    """Rows with `form` (consistent look, a soft hyphen at the end kept as a break mark) and `furniture`.

    rows: kind, row_id, doc, page, no, y0, x0, size, text; other columns are left out. Rows without a text, or with a
    blank one, hold nothing.
    """
    rows = rows.select("kind", "row_id", "doc", "page", "no", "y0", "x0", "size", "text")
    broken = F.regexp_replace("text", r"\u00ad[\s\u200b-\u200d\u2060\ufeff\u00ad]*$", "¬")
    placed = F.col("y0").isNotNull() & ((F.col("y0") < TOP) | (F.col("y0") > FOOT)) & (F.coalesce("size", F.lit(0.0)) < 10)
    floating = F.col("y0").isNull() & (F.col("size") < SMALL)
    return (
        rows.withColumn("form", F.trim(F.regexp_replace(look(broken), r"\s+", " ")))
        .where("form is not null and form <> ''")
        .withColumn("furniture", placed | F.coalesce(floating, F.lit(False)))
    )


def lexicon(clean: DataFrame, sure: DataFrame | None = None, rate: float = RATE) -> dict[str, int]:
    """Words and hyphened compounds of the clean text (column form) above the rate, with their counts.

    The first word of a row that starts in lower case and the last one before a hyphen may be halves and do not count.
    sure: reference texts (titles, terms; column form) that hold no halves and count in full.
    """
    inner = F.regexp_replace(F.regexp_replace("form", r"^\p{Ll}[^ ]* ?", ""), r"[^ ]*[-¬]$", "")
    words = F.expr(r"regexp_extract_all(replace(lower(_inner), '’', '\''), '\\p{L}+(?:[\'’]\\p{L}+)*(?:-\\p{L}+(?:[\'’]\\p{L}+)*)*', 0)")
    texts = clean.select(inner.alias("_inner"))
    if sure is not None:
        texts = texts.unionByName(sure.select(F.col("form").alias("_inner")))
    found = texts.select(F.explode(words).alias("w"))
    counts = cut(found.groupBy("w").agg(F.count(F.lit(1)).alias("n")))  # read twice, counted once
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(2, math.ceil(total * rate))
    made: dict[str, int] = {}
    for r in counts.where(F.col("n") >= least).collect():
        made[r.w] = made.get(r.w, 0) + r.n
        if "-" in r.w:
            for part in r.w.split("-"):
                made[part] = made.get(part, 0) + r.n
    return made


def _plain(word: str) -> str:
    """A word without accents, and with the two letters that a sharp s becomes in capitals."""
    word = word.replace("ß", "ss")
    return "".join(ch for ch in unicodedata.normalize("NFD", word) if not unicodedata.combining(ch))


class Decoder:
    """Cheapest readings of noisy words under a lexicon; results are kept per distinct word."""

    def __init__(self, words: dict[str, int]) -> None:
        self.words = words
        self.plain = {_plain(w) for w in words}
        total = max(1, sum(words.values()))
        self.cost = {w: -math.log(n / total) for w, n in words.items()}
        self.longest = max(map(len, words), default=0)
        self.prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
        self.letters = sorted({ch for w in words for ch in w})
        self.tokens: dict[str, Word] = {}
        self.memo: dict[str, tuple[str, ...] | None] = {}
        self.single: dict[str, str | None] = {}

    def known(self, w: str) -> bool:
        """Whether w is a lexicon word, a compound of them, or their plural, singular or possessive."""
        return (
            w in self.words or w + "s" in self.words or (w[-1:] == "s" and w[:-1] in self.words) or (w[-2:] == "'s" and w[:-2] in self.words)
            or ("-" in w and all(p in self.words for p in w.split("-")))
        )

    def confused(self, w: str) -> str | None:
        """The likeliest lexicon word that recognition could have turned into w, itself not a lexicon word.

        The fewest confusions of the table decide, at most one for every two characters, then the commonest word;
        where none helps, one unknown edit (a character or two for another or two) of a word of four or more.
        """
        if w not in self.single:
            hits: set[str] = set()
            for most in range(1, len(w) // 2 + 2 if len(w) >= 5 else 2):
                hits, cut_short = self._within(w, most)
                if hits or not cut_short:
                    break
            best = min(hits, key=lambda x: (self.cost[x], x), default=None)
            if best is None and len(w) >= 4:
                best = min(self._edited(w), key=lambda x: (abs(len(x) - len(w)), self.cost[x], x), default=None)
            self.single[w] = best
        return self.single[w]

    def _within(self, w: str, most: int) -> tuple[set[str], bool]:
        """Lexicon words at exactly `most` confusions from w, and whether more confusions could still lead on."""
        hits, more, seen = set(), False, {(0, "", 0)}
        open_ = [(0, "", 0)]
        while open_:
            i, made, n = open_.pop()
            if i == len(w):
                if n == most and made in self.words:
                    hits.add(made)
                continue
            steps = [(i + 1, made + w[i], n)]
            for was, meant in _BY_FIRST.get(w[i], ()):
                if w.startswith(was, i):
                    if n < most:
                        steps.append((i + len(was), made + meant, n + 1))
                    elif made + meant in self.prefixes:
                        more = True
            for step in steps:
                if step[1] in self.prefixes and step not in seen:
                    seen.add(step)
                    open_.append(step)
        return hits, more

    def _edited(self, w: str) -> set[str]:
        """Lexicon words of four letters or more that one or two characters of w at one place make, read as one or two others."""
        hits = set()
        for i in range(len(w)):
            if w[:i] not in self.prefixes:
                break
            ones = [w[:i] + ch for ch in self.letters if w[:i] + ch in self.prefixes]
            hits.update(x for o in ones if (x := o + w[i + 1 :]) in self.words)
            hits.update(x for o in ones if (x := o + w[i + 2 :]) in self.words and i + 1 < len(w))
            hits.update(x for o in ones for ch in self.letters if o + ch in self.prefixes and (x := o + ch + w[i + 1 :]) in self.words)
        return {x for x in hits if len(x) >= 4}

    def decode(self, w: str) -> tuple[str, ...] | None:
        """The words that w stands for if it is misread, (w,) if it is not, None if nothing fits."""
        if w in self.memo:
            return self.memo[w]
        self.memo[w] = made = self._decode(w)
        return made

    def _decode(self, w: str) -> tuple[str, ...] | None:
        if self.known(w) or _plain(w) in self.plain or ("-" in w and all(_plain(p) in self.plain for p in w.split("-"))):
            return (w,)
        if "-" in w:
            parts = [self.decode(p) if p else (p,) for p in w.split("-")]
            if all(parts):
                flat = ["-".join(x) if len(x) == 1 else " ".join(x) for x in parts]
                return tuple("-".join(flat).split(" "))
            return None
        options: list[tuple[float, tuple[str, ...]]] = []
        whole = self.confused(w)
        if whole:
            options.append((6.0 + self.cost[whole], (whole,)))
        n = len(w)
        if n >= 4:  # run together: dynamic programming over the stream, no confusions inside first
            best: list[tuple[float, int] | None] = [(0.0, 0)] + [None] * n
            for j in range(1, n + 1):
                for i in range(max(0, j - self.longest), j):
                    if best[i] is not None and (j - i > 1 or w[i:j] == "a") and w[i:j] in self.words:
                        c = best[i][0] + self.cost[w[i:j]] + (4.0 if i else 0.0) + (6.0 if j - i <= 2 else 0.0)
                        if best[j] is None or c < best[j][0]:
                            best[j] = (c, i)
            if best[n] is not None:
                parts, j = [], n
                while j:
                    parts.append(w[best[j][1] : j])
                    j = best[j][1]
                options.append((best[n][0], tuple(parts[::-1])))
            if not options:
                for i in range(2, n - 1):
                    a, b = w[:i], w[i:]
                    if a in self.words and len(b) >= 4 and (x := self.confused(b)):
                        options.append((10 + self.cost[a] + self.cost[x], (a, x)))
                    elif b in self.words and len(a) >= 4 and (x := self.confused(a)):
                        options.append((10 + self.cost[b] + self.cost[x], (x, b)))
        return min(options)[1] if options else None

    def word(self, token: str) -> Word:
        """A token's word, made once."""
        if token not in self.tokens:
            if len(self.tokens) >= KEPT:  # what is kept only saves time
                for kept in (self.tokens, self.memo, self.single):
                    kept.clear()
            self.tokens[token] = Word(self, token)
        return self.tokens[token]

    def joins(self, a: str, b: str) -> bool:
        """Whether a and b, next to each other, are one word split by a space."""
        if not a or not b or "-" in a or "-" in b:
            return False
        whole = a + b
        if whole not in self.words and a in self.words and b in self.words or _DASH.search(whole):
            return False
        if whole in self.words:
            if a not in self.words or b not in self.words:
                return True
            return self.cost[whole] + 2.0 < self.cost[a] + self.cost[b] - 6.0
        if a in self.words and b in self.words or len(whole) < 6:
            return False
        if (a in self.words or self.confused(a)) and (b in self.words or self.confused(b)):
            return False
        return self.decode(a) is None and self.decode(b) is None and self.confused(whole) is not None

    def break_at(self, head: str, tail: str) -> bool:
        """Whether the hyphen between head (before the row's end) and tail (the next row's start) must go."""
        head, tail = head.rsplit("-", 1)[-1], tail.split("-", 1)[0]
        if not head or not tail:
            return False
        whole, compound = head + tail, f"{head}-{tail}"
        if whole in self.words:
            return self.words[whole] >= self.words.get(compound, 0)
        if compound in self.words or any(c.startswith(compound + "-") or c.endswith("-" + compound) for c in self.compounds):
            return False
        if head in self.words and tail in self.words:
            return False
        if self.confused(whole):
            return True
        halves = (head in self.words or self.confused(head)) and (tail in self.words or self.confused(tail))
        return not (halves and f"{self.confused(head) or head}-{self.confused(tail) or tail}" in self.words)

    @property
    def compounds(self) -> list[str]:
        if not hasattr(self, "_compounds"):
            self._compounds = [w for w in self.words if "-" in w]
        return self._compounds


def _foreign(core: str) -> bool:
    """Whether a letter is not Latin: case and look-alikes mix in other scripts, nothing is decoded."""
    return any(not unicodedata.name(ch, "").startswith("LATIN") for ch in _HIGH.findall(core))


def _low(core: str) -> str:
    """A word as the lexicon writes it."""
    return core.lower().replace("’", "'")


def _core(token: str) -> tuple[str, str, str]:
    core = token.strip(_STRIP)
    at = token.find(core) if core else len(token)
    return token[:at], core, token[at + len(core) :]


def _goes_on(tail: str, token: str) -> bool:
    """Whether a row's first word can be the rest of a broken one: it has letters and no capital at its start."""
    return bool(tail) and len(_LETTER.findall(tail)) * 2 >= len(tail) and (token[0].islower() or token[0].isdigit() and len(tail) > 2)


def _cased(word: str, like: str) -> str:
    word = word.replace("'", "’") if "’" in like else word
    return word.upper() if like.isupper() and len(like) > 1 else word[:1].upper() + word[1:] if like[:1].isupper() else word


class Word:
    """A word as it stands: the token, its parts, whether it is outside the decoding, and how it reads by itself."""

    __slots__ = ("alone", "core", "lead", "low", "outside", "token", "trail")

    def __init__(self, d: Decoder, token: str) -> None:
        self.token = token
        self.lead, self.core, self.trail = _core(token)
        self.low = _low(self.core)
        plain = self.core.isascii() and self.core.isalpha() and not _CODE.match(self.core)
        self.outside = not plain and (not _LETTER.search(self.core) or bool(_CODE.match(self.core)) or _foreign(self.core))
        self.alone = self._read(d)
        self.outside |= bool(_DASH.search(self.core))  # its parts are read one by one

    def _read(self, d: Decoder) -> tuple[float, str, bool]:
        """Cost, text and whether it was misread of the word read by itself."""
        core, low = self.core, self.low
        if self.outside:
            return 0.0, self.token, False
        if _DASH.search(core):
            read = [Word(d, part).alone for part in _DASH.split(core)]
            return sum(c for c, _, _ in read), self.lead + "".join(t for _, t, _ in read) + self.trail, any(bad for _, _, bad in read)
        made = d.decode(low)
        if made is None:
            inner = re.search(r"[^\W\d_]\d|\d[^\W\d_]", core)
            return UNKNOWN, self.token, bool(inner) and len(core) >= 4 and sum(ch.isdigit() for ch in core) * 2 < len(core)
        if made == (low,):
            return d.cost.get(low, PLAIN), self.token, False
        return NOISE + sum(d.cost.get(w, PLAIN) for w in made), self.lead + _cased(" ".join(made), core) + self.trail, True


def _joined(d: Decoder, a: Word, b: Word) -> tuple[float, str] | None:
    """Cost and text of two neighbouring words of a row as one that a space split; None where they are two."""
    if a.trail or b.lead or not b.core or a.outside or not d.joins(a.low, b.low):
        return None
    whole = a.low + b.low
    right = whole if whole in d.words else d.confused(whole)
    return d.cost[right] + (0.0 if right == whole else NOISE), a.lead + _cased(right, a.core) + b.trail


def _unbroken(d: Decoder, a: Word, b: Word) -> tuple[float, str, int] | None:
    """Cost, text and misread part (0, 1, 2) of the last word of a row and the first of the next as one; None where the
    hyphen is the word's own."""
    if a.token[-1:] not in MARKS or len(a.token) < 2:
        return None
    lead, head, _ = _core(a.token[:-1])
    if not head or not _goes_on(b.low, b.token) or not d.break_at(_low(head), b.low):
        return None
    whole = _low(head + b.core).rsplit("-", 1)[-1]
    right = whole if whole in d.words else d.confused(whole)
    text = lead + (_cased(right, head) if right and "-" not in head + b.core else head + b.core) + b.trail
    return (d.cost[right] if right else PLAIN), text, _edit_in(d, _low(head), b.low)


def decode_stream(d: Decoder, forms: list[str], before: str | None, after: str | None) -> list[tuple[str, bool, bool]]:
    """(repaired text, hyphen, misread) of every row of a page, by the cheapest path through the lattice of its words.

    before: last word of the text flow before the page; after: first one after it. A broken word is given to the row it
    starts in: there its hyphen goes and the rest of the word is added; the next row loses it.
    """
    words, at = [before] if before else [], [-1] if before else []
    for row, form in enumerate(forms):
        tokens = _TOKEN.findall(form)
        words += tokens
        at += [row] * len(tokens)
    if after:
        words.append(after)
        at.append(len(forms))
    words = [d.word(t) for t in words]
    n = len(words)
    paths: list[tuple[float, int, tuple]] = [(0.0, 0, ())] + [(float("inf"), 0, ())] * n
    for i, word in enumerate(words):
        cost = paths[i][0]
        arcs = [(1, *word.alone, False, 0)]
        if i + 1 < n:
            if at[i] == at[i + 1]:
                if made := _joined(d, word, words[i + 1]):
                    arcs.append((2, *made, True, False, 0))
            elif at[i] + 1 == at[i + 1] and (whole := _unbroken(d, word, words[i + 1])):
                arcs.append((2, whole[0], whole[1], False, True, whole[2]))
        for size, c, *rest in arcs:
            if cost + c < paths[i + size][0]:
                paths[i + size] = (cost + c, i, tuple(rest))
    texts: list[list[str]] = [[] for _ in forms]
    flags = [[False, False] for _ in forms]
    j = n
    while j > 0:
        _, i, (text, misread, hyphen, part) = paths[j]
        row, end = at[i], at[j - 1]
        if 0 <= row < len(forms):
            texts[row].append(text)
            flags[row][0] |= hyphen
            flags[row][1] |= misread or part == 1
        if 0 <= end < len(forms):
            flags[end][1] |= part == 2
        j = i
    return [(" ".join(t[::-1]), *f) for t, f in zip(texts, flags, strict=True)]


def _edit_in(d: Decoder, head: str, tail: str) -> int:
    """In which part a broken word was misread: 1 the head, 2 the tail, 0 none or unknown."""
    head, tail = head.rsplit("-", 1)[-1], tail.split("-", 1)[0]
    whole = head + tail
    if whole in d.words or _plain(whole) in d.plain:
        return 0
    right = d.confused(whole)
    if not right:
        return 0
    return 2 if right.startswith(head) else 1


PAGE_ROWS = T.ArrayType(T.StructType([
    T.StructField("row_id", T.LongType()), T.StructField("no", T.IntegerType()), T.StructField("x0", T.DoubleType()), T.StructField("size", T.DoubleType()),
    *DECODED.fields,
]))


def pages_of(rows: DataFrame) -> DataFrame:
    """kind, doc, page, furniture (row ids), lines (body rows in order), before and after (words of the pages around).

    One exchange brings the rows of a page together; the words at its ends come from a table of one row a page.
    """
    line = F.struct("no", "row_id", "form", "x0", "size")
    side = lambda test: F.collect_set(F.when(test, line))
    pages = rows.groupBy("kind", "doc", "page").agg(
        F.array_sort(side(~F.col("furniture"))).alias("lines"), F.array_distinct(F.transform(side(F.col("furniture")), lambda x: x["row_id"])).alias("furniture")
    )
    # Of one row id the first row stays.
    pages = pages.withColumn("lines", F.filter("lines", lambda x, i: (i == 0) | ~F.coalesce(F.get("lines", i - 1)["row_id"] == x["row_id"], F.lit(False))))
    word = lambda at, k: F.substring_index(F.element_at("lines", at)["form"], " ", k)
    ends = pages.where(F.size("lines") > 0).select("kind", "doc", "page", word(1, 1).alias("first"), word(-1, -1).alias("last"))
    over = Window.partitionBy("kind", "doc").orderBy("page")
    keys = ["kind", "doc", "page"]
    around = ends.select(*[F.col(c).alias(f"_{c}") for c in keys], F.lag("last").over(over).alias("before"), F.lead("first").over(over).alias("after"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
    return pages.join(around, same, "left").select(*keys, "lines", "furniture", "before", "after")


def decoded(rows: DataFrame, words: dict[str, int]) -> DataFrame:
    """Pages of scanned documents (kind, doc, page, furniture) with their body rows decoded: rows of row_id, no, x0, size, text, hyphen, misread."""
    held = rows.sparkSession.sparkContext.broadcast(words)
    kept: dict = {}
    kind = pa.list_(pa.struct([("row_id", pa.int64()), ("no", pa.int32()), ("x0", pa.float64()), ("size", pa.float64()), ("text", pa.string()), ("hyphen", pa.bool_()), ("misread", pa.bool_())]))

    @F.arrow_udf(PAGE_ROWS)
    def run(lines: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
        if "d" not in kept:
            kept["d"] = Decoder(held.value)
        made = []
        for page, b, a in zip(lines.to_pylist(), before.to_pylist(), after.to_pylist(), strict=True):
            read = decode_stream(kept["d"], [x["form"] for x in page], b, a)
            made.append([
                {"row_id": x["row_id"], "no": x["no"], "x0": x["x0"], "size": x["size"], "text": t, "hyphen": h, "misread": m}
                for x, (t, h, m) in zip(page, read, strict=True)
            ])
        return pa.array(made, kind)

    return pages_of(text_rows(rows)).select("kind", "doc", "page", "furniture", run.asNondeterministic()("lines", "before", "after").alias("rows"))


def defects(rows: DataFrame, words: dict[str, int]) -> DataFrame:
    """kind, row_id, defect (furniture, hyphen, misread) of the rows of scanned documents, each once.

    Rows delivered twice count once; rows with a null or blank text have no defect; a null page or number sorts first.
    """
    found = lambda x, name: F.struct(x["row_id"].alias("row_id"), F.lit(name).alias("defect"))
    flagged = lambda name: F.transform(F.filter("rows", lambda x: x[name]), lambda x: found(x, name))
    edge = F.transform("furniture", lambda r: F.struct(r.alias("row_id"), F.lit("furniture").alias("defect")))
    every = F.concat(edge, flagged("hyphen"), flagged("misread"))
    return decoded(rows, words).select("kind", F.explode(every).alias("f")).select("kind", "f.row_id", "f.defect")


def _row_costs(lines: list[tuple[str, float | None, float | None, bool]]) -> tuple[list[float], list[float], list[float]]:
    """Costs of joining each row to the one before, of breaking there, and of a row as a paragraph of its own.

    lines: text, x0, size, whether a blank row stands before. The cost of a break grows with signs that the text
    runs on (no end of sentence, lower-case start, full line before), that of a join with signs of a new paragraph;
    a paragraph of a single short row that is no heading costs extra, which is what couples neighbouring choices.
    """
    widest = max((len(t) for t, *_ in lines), default=0)
    join_cost, break_cost = [0.0], [0.0]
    for (p, px, ps, _), (t, x, s, gap) in zip(lines, lines[1:], strict=False):
        ended = p.rstrip()[-1:] in ".!?:"
        marked = bool(re.match(r"[-–•▪*·]\s|\d+[.)]\s", t))
        differs = ps is not None and s is not None and abs(ps - s) > 1.0
        join_cost.append(3.0 * gap + 4.0 * marked + 4.0 * differs + 1.5 * (ended and len(p) < 0.75 * widest) + 1.0 * (x is not None and px is not None and x - px > 8))
        break_cost.append(2.0 * (not ended) + 3.0 * t[:1].islower() + 1.0 * (len(p) > 0.85 * widest))
    return join_cost, break_cost, [1.0 if len(t) < 20 and not t.isupper() else 0.0 for t, *_ in lines]


def paragraph_cost(lines: list[tuple[str, float | None, float | None, bool]], starts: list[int]) -> float:
    """Cost of the paragraphs of a page that start at the given rows."""
    join_cost, break_cost, lonely = _row_costs(lines)
    total = 0.0
    for a, b in zip(starts, [*starts[1:], len(lines)], strict=True):
        total += break_cost[a] + sum(join_cost[a + 1 : b]) + (lonely[a] if b - a == 1 else 0.0)
    return total


def break_rows(lines: list[tuple[str, float | None, float | None, bool]]) -> list[int]:
    """Rows of a page that start a paragraph, by dynamic programming over the cost of breaking or joining at each row."""
    n = len(lines)
    if not n:
        return []
    join_cost, break_cost, lonely = _row_costs(lines)
    # Whether a row starts a paragraph couples with its neighbours only through paragraphs of one row, so two costs
    # are enough: of the best choice up to a row that starts one, and up to a row that does not.
    starts, inside = [0.0] * n, [float("inf")] * n
    came = [[False, False] for _ in range(n)]  # whether the row before starts a paragraph, by what this row does
    for i in range(1, n):
        alone = starts[i - 1] + lonely[i - 1]
        came[i][1] = alone <= inside[i - 1]
        starts[i] = break_cost[i] + min(alone, inside[i - 1])
        came[i][0] = starts[i - 1] <= inside[i - 1]
        inside[i] = join_cost[i] + min(starts[i - 1], inside[i - 1])
    begins = starts[-1] + lonely[-1] < inside[-1]
    found = []
    for i in range(n - 1, -1, -1):
        if begins:
            found.append(i)
        begins = came[i][begins]
    return found[::-1]


def paragraphs(rows: DataFrame, words: dict[str, int]) -> DataFrame:
    """Readable paragraphs of the scanned documents: kind, doc, page, paragraph_no, text; furniture is left out.

    rows as for text_rows, with x0; lines and tokens are texts of their own; a word broken over a page border is whole in the page it starts on.
    """
    pages = decoded(rows, words)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def build(batch: pa.Array) -> pa.Array:
        made = []
        for page in batch.to_pylist():
            gaps = [b["no"] is not None and a["no"] is not None and b["no"] - a["no"] > 1 for a, b in zip(page, page[1:], strict=False)]
            rows = [(x["text"], x["x0"], x["size"], gap) for x, gap in zip(page, [False, *gaps], strict=False) if x["text"].strip()]
            at = [*break_rows(rows), len(rows)]
            made.append([" ".join(r[0] for r in rows[a:b]) for a, b in zip(at, at[1:], strict=False)])
        return pa.array(made, pa.list_(pa.string()))

    return pages.select("kind", "doc", "page", F.posexplode(build("rows")).alias("paragraph_no", "text"))
