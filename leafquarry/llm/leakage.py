"""Evaluation passages that occur in a corpus, whole, in part, altered or with other values in their slots.

Words are compared apart from case, punctuation, look and line breaks. In every text numbers, units and names become
typed placeholders, so that a re-parameterised question keeps its template. A word is a name if the evaluation texts
write it as one, or if they do not know it and the text writes it with a capital. Windows of five template words are
hashed on both sides and joined by Spark; windows with a word that no evaluation text holds are not even sent. Two
windows on one diagonal make a candidate pair, and only candidate pairs see their texts again, for the evidence: equal
words, edits within the limit, or a template run whose slots were refilled one to one.

The evaluation set is worked through in blocks of a bounded number of words. What a worker holds is the vocabulary of
one block, whatever the number of blocks; texts and windows of the set never reach the driver.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.look import fold_look

WINDOW = 5  # a passage of n >= 20 words with at most n / 8 edits keeps a run of six words, so two windows side by side
EXACT_WORDS = 12
ALTERED_WORDS = 20
ONE_IN = 8
TEMPLATE_WORDS = 20  # words of a template run that shows a re-parameterised passage
LITERAL_SHARE = 0.5  # share of them that are no placeholders
BLOCK_WORDS = 200_000  # words of the evaluation texts worked through at once; bounds the vocabulary of a block
NUMBER, UNIT, NAME = 1, 2, 3  # placeholders
# Units of measure that become one placeholder.
UNITS = frozenset("mm cm m km metre metres meter meters mile miles g kg gram grams tonne tonnes l litre litres hour hours minute minutes second seconds euro euros pound pounds percent degrees".split())
_BROKEN = re.compile("[-\u2010\u2011\xac\xad\uff0d][ \\t]*\\r?\\n\\s*(?=\\w)")
_INNER = re.compile(r"(?<=\w)[-'’](?=\w)")
_WORD = re.compile(r"\w+")
_NUMBER = re.compile(r"\d+\Z")

FOUND = "doc_id bigint, item_id bigint, kind string, run int, words int, edits int, slots_consistent boolean"
_FOUND = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("kind", pa.string()), ("run", pa.int32()), ("words", pa.int32()), ("edits", pa.int32()), ("slots_consistent", pa.bool_()),
])


class _Splits(dict):
    """Translation of characters for splitting: letters and digits stay, hyphens and apostrophes go, others part words."""

    def __missing__(self, code: int) -> int | None:
        ch = chr(code)
        made = code if ch.isalnum() or unicodedata.combining(ch) else None if ch in "-'’" else 32
        self[code] = made
        return made


_SPLITS = _Splits()


def _parts(text: str) -> list[str]:
    """Words of a text in their case: look-alikes folded, words broken at line ends rejoined, inner hyphens dropped."""
    if "\n" in text:
        text = _BROKEN.sub("", text)
    text = fold_look(text)
    if "--" in text:
        text = text.replace("--", " ")
    return text.translate(_SPLITS).split()


def words_of(text: str) -> list[str]:
    """Words of a text under full case folding."""
    return [w.casefold() for w in _parts(text)]


def capitals_in(text: str) -> Iterator[tuple[str, bool, bool]]:
    """Words of an evaluation text with whether they stand in capitals inside a sentence, and whether in lower case."""
    inside = False
    for token in fold_look(_BROKEN.sub("", text)).split():
        for w in _parts(token):
            yield w.casefold(), inside and w[0].isupper(), not w[0].isupper()
            inside = True
        if token.rstrip(")\"'”’")[-1:] in ".!?:":
            inside = False


class Vocabulary:
    """Codes of the words of a block of evaluation texts: placeholders for numbers, units and names, own numbers for others."""

    def __init__(self, names: Iterable[str], others: Iterable[str], slots: bool = True) -> None:
        self.slots = slots
        self.ids = {w: n + 10 for n, w in enumerate(sorted({*others} if slots else {*others, *names}))}
        if slots:
            self.ids |= dict.fromkeys(names, NAME) | dict.fromkeys(UNITS, UNIT)
            self.ids = {w: NUMBER if _NUMBER.match(w) else k for w, k in self.ids.items()}

    def code(self, parts: list[str]) -> np.ndarray:
        """Codes of the words of a text given in their case; 0 for a word that is in no evaluation text."""
        get = self.ids.get
        coded = [get(w, 0) for w in parts]
        if 0 in coded:
            for i, w in enumerate(parts):
                if not coded[i]:
                    coded[i] = get(w.casefold(), 0) or (self._slot(w) if self.slots else 0)
        return np.array(coded, dtype=np.int64)

    @staticmethod
    def _slot(word: str) -> int:
        return NUMBER if word[0].isdigit() and _NUMBER.match(word) else NAME if word[0].isupper() else 0


def windows(coded: np.ndarray, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the windows whose words are all known. A window with less than two words that are no
    placeholders says too little, so the words behind its placeholders count in it."""
    n = len(coded) - WINDOW + 1
    if n < 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    known = np.concatenate([[0], np.cumsum(coded > 0)])
    full = np.nonzero(known[WINDOW:] - known[:-WINDOW] == WINDOW)[0]
    h = np.zeros(len(full), dtype=np.int64)
    for j in range(WINDOW):
        h = h * np.int64(1_000_003) + coded[full + j]
    literal = np.concatenate([[0], np.cumsum(coded >= 10)])
    for i in np.nonzero(literal[full + WINDOW] - literal[full] < 2)[0]:
        said = " ".join(w.casefold() for w in parts[full[i] : full[i] + WINDOW])
        h[i] = np.int64(int.from_bytes(blake2b(said.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True))
    return h, full


def equal_runs(a: list[str], b: list[str], diagonals: list[int], least: int) -> list[tuple[int, int, int]]:
    """Longest stretches of equal words on the diagonals (position in a minus position in b): length, end in a, end in b."""
    runs = []
    for d in diagonals:
        run, stop = 0, min(len(b), len(a) - d)
        for j in range(max(0, -d), stop):
            if a[j + d] == b[j]:
                run += 1
            else:
                if run >= least:
                    runs.append((run, j + d, j))
                run = 0
        if run >= least:
            runs.append((run, stop + d, stop))
    return runs


def reach(a: list[str], b: list[str], most: int) -> list[tuple[int, int, int]]:
    """Furthest prefix of b that some prefix of a equals with 0, 1, ... most edits, ending in an equal word.

    Furthest-reaching points per diagonal, one round per edit. Each entry: words of b, words of a, edits used.
    """
    n, m = len(a), len(b)
    points, best = {0: 0}, (0, 0, 0)
    out = []
    for e in range(most + 1):
        if e:
            made: dict[int, int] = {}
            for d, j in points.items():
                for d2, j2 in ((d, j + 1), (d - 1, j + 1), (d + 1, j)):  # changed, dropped, added
                    if j2 <= m and 0 <= j2 + d2 <= n and j2 > made.get(d2, -1):
                        made[d2] = j2
            points = made
        for d, j in points.items():
            start = j
            while j < m and j + d < n and a[j + d] == b[j]:
                j += 1
            points[d] = j
            if j > start and j > best[0]:
                best = (j, j + d, e)
        out.append(best)
    return out


class Side:
    """The words of a text as they are compared, and the codes of its template, worked out when asked for."""

    def __init__(self, text: str, vocabulary: Vocabulary) -> None:
        self.parts, self.vocabulary, self._codes = _parts(text), vocabulary, None
        self.words = [w.casefold() for w in self.parts]

    @property
    def codes(self) -> list[int]:
        if self._codes is None:
            self._codes = self.vocabulary.code(self.parts).tolist()
        return self._codes


def evidence(said: Side, item: Side, diagonals: list[int]) -> tuple | None:
    """How an item leaked into a text: kind, run, words, edits, slots replaced alike; or None."""
    return _check(said.words, item.words, diagonals) or _refilled(said, item, diagonals)


def _check(words: list[str], item: list[str], diagonals: list[int]) -> tuple | None:
    """Evidence by the words themselves: a long equal run, or a passage within the limit of edits."""
    runs = equal_runs(words, item, sorted(diagonals), WINDOW + 1)
    if not runs:
        return None
    run = max(runs)[0]
    if run >= EXACT_WORDS:
        return "exact", run, run, 0, True
    best = None
    for n, i, j in runs:
        most = len(item) // ONE_IN
        span = len(item) + most
        after = reach(words[i : i + span], item[j:], most)
        before = reach(words[max(0, i - n - span) : i - n][::-1], item[: j - n][::-1], most)
        for rb, ra, re_ in after:
            for lb, la, le in before:
                total, edits = n + rb + lb, re_ + le
                edge = max(0, min(ALTERED_WORDS - total, len(item) - total))  # changed words at the ends count with the passage
                if total + edge >= ALTERED_WORDS and ONE_IN * (edits + edge) <= total + edge and (best is None or total > best[0]):
                    best = (total, edits, words[i - n - la : i + ra], item[j - n - lb : j + rb])
    if best is None:
        return None
    return "altered", run, best[0], best[1], _slots_consistent(best[2], best[3])


def _refilled(said: Side, meant: Side, diagonals: list[int]) -> tuple | None:
    """Evidence by the template: a long run of equal template words whose slots were refilled one to one."""
    best, words, item, codes = None, said.words, meant.words, meant.codes
    for n, i, j in equal_runs(said.codes, codes, sorted(diagonals), TEMPLATE_WORDS):
        slots = [k for k in range(n) if 0 < codes[j - n + k] < 10]
        pairs = {(item[j - n + k], words[i - n + k]) for k in slots}
        changed = sum(item[j - n + k] != words[i - n + k] for k in slots)
        one_to_one = len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
        if changed and one_to_one and n - len(slots) >= LITERAL_SHARE * n and (best is None or n > best[2]):
            best = ("refilled", max((r[0] for r in equal_runs(words[i - n : i], item[j - n : j], [0], 1)), default=0), n, changed, True)
    return best


def _slots_consistent(said: list[str], meant: list[str]) -> bool:
    """Whether every replaced word of the passage was replaced by one and the same word."""
    other: dict[str, set[str]] = defaultdict(set)
    for kind, i1, i2, j1, j2 in SequenceMatcher(None, meant, said, autojunk=False).get_opcodes():
        if kind == "replace" and i2 - i1 == j2 - j1:
            for was, now in zip(meant[i1:i2], said[j1:j2], strict=True):
                other[was].add(now)
    return all(len(v) == 1 for v in other.values())


def vocabulary_of(items: DataFrame, slots: bool = True) -> Vocabulary:
    """The vocabulary of the items of a block; words that stand with a capital inside sentences, never without, are names."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("w", T.StringType()), T.StructField("inner", T.BooleanType()), T.StructField("low", T.BooleanType())])))
    def capitals(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("w", pa.string()), ("inner", pa.bool_()), ("low", pa.bool_())]))
        return pa.array([[{"w": w, "inner": i, "low": n} for w, i, n in sorted({*capitals_in(t or "")})] for t in texts.to_pylist()], kind)

    seen = items.select(F.explode(capitals("text")).alias("c")).groupBy("c.w").agg((F.max("c.inner") & ~F.max("c.low")).alias("name"))
    rows = seen.collect()  # distinct words of one block
    return Vocabulary([r.w for r in rows if r.name], [r.w for r in rows if not r.name], slots)


def hashed_windows(texts: DataFrame, key: list[str], vocabulary) -> DataFrame:
    """key columns, h and pos of every template window of the texts (column text); vocabulary is a broadcast one."""

    @F.arrow_udf(T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("pos", T.IntegerType())])))
    def run(batch: pa.Array) -> pa.Array:
        hashes, places, ends = [], [], [0]
        for text in batch.to_pylist():
            parts = _parts(text or "")
            h, at = windows(vocabulary.value.code(parts), parts)
            hashes.append(h)
            places.append(at)
            ends.append(ends[-1] + len(h))
        h, at = (np.concatenate([np.zeros(0, dtype=np.int64), *x]) for x in (hashes, places))
        flat = pa.StructArray.from_arrays([pa.array(h), pa.array(at.astype(np.int32))], ["h", "pos"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)

    return texts.select(*key, F.explode(run.asNondeterministic()("text")).alias("w")).select(*key, "w.h", "w.pos")


def _block_leaks(texts: DataFrame, items: DataFrame, slots: bool) -> DataFrame:
    vocabulary = texts.sparkSession.sparkContext.broadcast(vocabulary_of(items, slots))
    meant = hashed_windows(items, ["item_id"], vocabulary).withColumnRenamed("pos", "at")
    hits = hashed_windows(texts, ["doc_id", "copy"], vocabulary).join(meant, "h")
    diagonals = hits.groupBy("doc_id", "copy", "item_id", (F.col("pos") - F.col("at")).alias("d")).count().where("count >= 2")
    pairs = diagonals.groupBy("doc_id", "copy", "item_id").agg(F.array_sort(F.collect_list("d")).alias("ds"))
    asked = pairs.join(items.select("item_id", F.col("text").alias("item")), "item_id")
    shown = texts.join(asked, ["doc_id", "copy"]).select("doc_id", "item_id", "text", "item", "ds")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[str | None, Side | None] = (None, None)
        meant: dict[str, Side] = {}  # of the items of one block
        for batch in batches:
            out = []
            for doc_id, item_id, text, item, ds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held[0] != text:
                    held = (text, Side(text, vocabulary.value))
                if item not in meant:
                    meant[item] = Side(item, vocabulary.value)
                if made := evidence(held[1], meant[item], ds):
                    out.append((doc_id, item_id, *made))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _FOUND, strict=True)], schema=_FOUND)

    return shown.mapInArrow(verify, FOUND)


def leaked(documents: DataFrame, items: DataFrame, block_words: int = BLOCK_WORDS, slots: bool = True) -> DataFrame:
    """Documents that hold a passage of an evaluation text: doc_id, item_id and the evidence, one row per pair.

    kind is `exact` with at least twelve consecutive words of the item, `altered` with at least twenty of which at most
    one in eight was changed, misspelt, added or dropped, and `refilled` with at least twenty words of its template
    whose numbers, units or names were replaced one to one. run is the longest run of equal words; words and edits
    describe the passage. documents: doc_id, text; items: item_id, text, the evaluation set. The documents are read
    once for every block of block_words words of the set, and once more where they hold candidates. slots switches
    the placeholders off. Null ids or texts, and texts too short to hold a passage, give no rows; of several texts
    under one id each counts; empty tables give an empty result.
    """
    known = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    size = known.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0
    texts = documents.where("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64("text").alias("copy"))
    blocks = max(1, -(-size // block_words))
    made = None
    for k in range(blocks):
        part = known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k) if blocks > 1 else known
        found = _block_leaks(texts, part, slots)
        made = found if made is None else made.unionByName(found)
    rank = F.struct((F.col("kind") == "refilled").alias("r"), -F.col("words"), "kind", "run", "edits")
    best = F.min_by(F.struct("kind", "run", "words", "edits", "slots_consistent"), rank).alias("b")
    return made.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")
