"""Letters without their accents, by Unicode's own tables; three ways that differ where their uses do.

``to_ascii`` takes letters apart by compatibility (NFKD) and keeps ASCII alone:
``Łódź`` becomes ``odz``. ``without_marks`` takes them apart by canon (NFD) and
drops combining marks: ``Łodz``, and a Greek or Cyrillic letter stays one.
``unaccented`` also writes letters that have no parts in plain ones: ``Lodz``.

The tables are made at import from ``unicodedata`` for all letters but Hangul
syllables. A text in ASCII is returned as it is.
"""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters that Unicode does not take apart, and what they are written as.
WRITTEN_AS = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "ẞ": "SS", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d",
    "Þ": "TH", "þ": "th", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q", "Ŋ": "N", "ŋ": "n", "Ŧ": "T", "ŧ": "t", "ƒ": "f", "ȷ": "j", "ə": "e", "Ə": "E",
    "‘": "'", "’": "'", "‚": ",", "“": '"', "”": '"', "„": ",,", "«": "<<", "»": ">>", "‹": "<", "›": ">", "–": "-", "—": "-", "−": "-",
}
_LETTERS = [chr(c) for c in range(0x80, 0x20000) if not 0xAC00 <= c < 0xE000]


def _ascii(letter: str) -> str:
    return unicodedata.normalize("NFKD", letter).encode("ascii", "ignore").decode()


def _markless(letter: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn")


def _uncombined(letter: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))


def _plain(letter: str) -> str:
    if letter in WRITTEN_AS:
        return WRITTEN_AS[letter]
    parts = _markless(letter)
    if "LATIN" in unicodedata.name(letter, "") and _ascii(letter):
        return _ascii(letter)
    return WRITTEN_AS.get(parts, parts)


class _Table:
    """What a way makes of each letter: one letter or none (for translate), or several."""

    def __init__(self, of) -> None:
        made = {a: b for a in _LETTERS if (b := of(a)) != a}
        gone = "".join(a for a, b in made.items() if not b)
        one = {a: b for a, b in made.items() if len(b) == 1}
        self.before, self.after = "".join(one) + gone, "".join(one.values())
        self.several = {a: b for a, b in made.items() if len(b) > 1}

    def apply(self, c: Column) -> Column:
        if self.several:
            signs, letters = "".join(self.several), F.split(F.lit("\t".join(self.several.values())), "\t")
            at = lambda p: F.call_function("instr", F.lit(signs), p)
            there = F.filter(F.array_distinct(F.split(c, "")), lambda p: (p != "") & (at(p) > 0))
            spread = F.aggregate(there, c, lambda text, p: F.replace(text, p, F.get(letters, at(p) - 1)))
            c = F.when(F.length(F.translate(c, signs, "")) < F.length(c), spread).otherwise(c)
        return F.translate(c, self.before, self.after)


@cache
def _table(of) -> _Table:
    return _Table(of)


def _unless_ascii(c: Column, folded: Column) -> Column:
    return F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)


def to_ascii(c: Column) -> Column:
    """Letters taken apart by compatibility, all that is not ASCII dropped."""
    return _unless_ascii(c, F.regexp_replace(_table(_ascii_kept).apply(c), r"[^\x00-\x7F]", ""))


def _ascii_kept(letter: str) -> str:
    return _ascii(letter) or letter  # what has no ASCII in it goes at the end


def without_marks(c: Column) -> Column:
    """Letters taken apart by canon, combining marks dropped."""
    return _unless_ascii(c, _table(_markless).apply(c))


def uncombined(c: Column) -> Column:
    """Letters taken apart by compatibility, combining marks dropped."""
    return _unless_ascii(c, _table(_uncombined).apply(c))


def unaccented(c: Column) -> Column:
    """Latin letters in plain ones, ligatures written out, other scripts without marks."""
    return _unless_ascii(c, _table(_plain).apply(c))
