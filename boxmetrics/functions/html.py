"""Text and fields of web pages by pattern."""

from __future__ import annotations

import json
from collections import defaultdict
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxmetrics.functions.text import squeeze

HIDDEN = r"(?is)<script.*?</script>|<style.*?</style>"
_NAME = r"^([^\t\n\f <&#;]{1,32};)"


@cache
def _names() -> tuple[str, str]:
    """HTML5's named references: by first letter as JSON, and a pattern of those that need no semicolon, long ones first."""
    by_letter: dict[str, dict[str, str]] = defaultdict(dict)
    for name, text in html5.items():
        by_letter[name[0]][name] = text
    open_names = sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True)
    return json.dumps(by_letter), "^(" + "|".join(open_names) + ")"


@cache
def _windows_letters() -> str:
    """What numbers 128 to 159 stand for: letters of the Windows code page, or themselves where it has none."""
    return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def _letter(number: Column) -> Column:
    """The character of a code point; what is none becomes U+FFFD, controls and non-characters nothing."""
    high = number.bitwiseAND(0xFFFF)
    none = (number < 9) | number.between(0x0E, 0x1F) | (number == 0x0B) | (number == 0x7F) | number.between(0xFDD0, 0xFDEF) | (high >= 0xFFFE)
    wrong = number.isNull() | (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    windows = F.substr(F.lit(_windows_letters()), (number - 0x7F).cast("int"), F.lit(1))
    made = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(wrong, "�").when(number.between(0x80, 0x9F), windows).when(none, "").otherwise(made)


def _reference(piece: Column) -> Column:
    """What stands behind an ampersand, with the reference it may begin with written out."""
    known, open_names = _names()
    name, bare = F.regexp_extract(piece, _NAME, 1), F.regexp_extract(piece, open_names, 1)
    lists = F.from_json(F.lit(known), "map<string,map<string,string>>")
    find = lambda n: F.try_element_at(F.try_element_at(lists, F.substring(n, 1, 1)), n)
    rest = lambda n: F.substr(piece, F.length(n) + 1)
    ten, hexa = F.regexp_extract(piece, r"^(#[0-9]+;?)", 1), F.regexp_extract(piece, r"^(#[xX][0-9a-fA-F]+;?)", 1)
    of_ten = F.regexp_replace(ten, "[#;]", "").try_cast("long")
    digits = F.regexp_replace(F.regexp_replace(hexa, "[#xX;]", ""), "^0+", "")
    of_hex = F.when(F.length(digits) <= 8, F.conv(F.concat(F.lit("0"), digits), 16, 10).cast("long"))
    number = F.when(ten != "", F.concat(_letter(of_ten), rest(ten))).when(hexa != "", F.concat(_letter(of_hex), rest(hexa)))
    named = F.coalesce(F.concat(find(name), rest(name)), F.when(bare != "", F.concat(find(bare), rest(bare))))
    return F.coalesce(F.when(piece.startswith("#"), number).otherwise(named), F.concat(F.lit("&"), piece))


def unescape(c: Column) -> Column:
    """All character references of HTML5 written out, each once: ``&amp;lt;`` becomes ``&lt;``.

    Named ones with a semicolon, the old ones without, decimal and hexadecimal
    numbers; an ampersand that begins none stays.
    """
    pieces = F.transform(F.split(c, "&"), lambda p, i: F.when(i == 0, p).otherwise(_reference(p)))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)


def to_text(html: Column) -> Column:
    """What a reader sees: no scripts or styles, tags as blanks, character references written out."""
    return squeeze(unescape(F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), "<[^>]+>", " ")))


def element(html: Column, tag: str) -> Column:
    """The text of the first element of this tag, null without one."""
    return F.nullif(squeeze(unescape(F.regexp_extract(html, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1))), F.lit(""))


def attribute(html: Column, tag: str, name: str) -> Column:
    return F.nullif(F.regexp_extract(html, rf'(?i)<{tag}[^>]* {name}="([^"]*)"', 1), F.lit(""))
