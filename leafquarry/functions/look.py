"""One consistent form for text that looks the same.

`fold_look` maps compatibility forms (full-width letters, ligatures), decomposed accents, default-ignorable
characters, special spaces and hyphens and look-alike letters of other scripts to one form. Case and accents stay.
The work is done once per distinct value of an Arrow batch, by a Python loop over those values.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts and the Latin letter each looks like (base letters; accents are apart).
LOOKALIKES = {
    # Cyrillic
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "һ": "h", "ӏ": "l", "ѵ": "v",
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ӏ": "I", "Ѵ": "V",
    # Greek
    "α": "a", "ο": "o", "ν": "v", "ι": "i", "ρ": "p", "υ": "u", "γ": "y", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϳ": "J",
    # Armenian
    "օ": "o", "հ": "h", "ո": "n", "ս": "u", "ց": "g", "զ": "q", "Տ": "S", "Օ": "O", "Լ": "L",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M",
    "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    # Latin letters of phonetic alphabets
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i",
}
# Hyphens that look like the plain one, and spaces that compatibility normalisation leaves alone.
HYPHENS = "\u2010\u2011\u2043\u02d7\u2212\ufe63\uff0d"
SPACES = "\u1680\u2028\u2029\x85"
# Default-ignorable code points.
IGNORABLE = (
    "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164"
    "\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
)
_DROP = re.compile(f"[{IGNORABLE}]")
_EARLY = {ord(c): "-" for c in HYPHENS} | {ord(c): " " for c in SPACES}
_FIRST = re.compile(f"[{HYPHENS}{SPACES}{IGNORABLE}]")
_LATE = {ord(k): v for k, v in LOOKALIKES.items()}
_SCRIPTS = [*range(0x250, 0x5D0), *range(0x1F00, 0x2000)]
_SECOND = re.compile(
    "[" + "".join({*LOOKALIKES, *(chr(c) for c in _SCRIPTS if unicodedata.normalize("NFD", chr(c))[0] in LOOKALIKES)}) + "]"
)


def fold_look(text: str) -> str:
    """The consistent form of one text; texts of the same look have the same form."""
    if text.isascii():
        return text
    if _FIRST.search(text):
        text = _DROP.sub("", text).translate(_EARLY)
    text = unicodedata.normalize("NFKC", text)
    if text.isascii() or not _SECOND.search(text):
        return text
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(_LATE))


def per_distinct(values: pa.Array, one) -> pa.Array:
    """one() of every value, called once per distinct value; null stays null."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    coded = values.dictionary_encode()
    made = pa.array([None if v is None else one(v) for v in coded.dictionary.to_pylist()], pa.string())
    return made.take(coded.indices)


@F.arrow_udf(T.StringType())
def _look(values: pa.Array) -> pa.Array:
    return per_distinct(values, fold_look)


@F.arrow_udf(T.StringType())
def _look_casefold(values: pa.Array) -> pa.Array:
    return per_distinct(values, lambda t: fold_look(fold_look(t).casefold()))


def look(text: Column) -> Column:
    """Column of the consistent form; null for null, empty for empty."""
    return _look.asNondeterministic()(text)  # keeps filters on the result from working it out a second time


def look_casefold(text: Column) -> Column:
    """Consistent form under full case folding, for comparisons without case."""
    return _look_casefold.asNondeterministic()(text)


def squeezed(text: Column) -> Column:
    """Outer spaces removed, inner runs of white space made one space."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))
