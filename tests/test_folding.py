"""Accents, character references and fixpoints on cases written out, and over all letters by Python's own library."""

import html
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from boxmetrics.functions import folding as fo
from boxmetrics.functions import html as ht
from boxmetrics.functions import text as tx

from .test_forms import apply

FORMS = {
    # as written: to_ascii, without_marks, unaccented
    "Dvořák": ("Dvorak", "Dvorak", "Dvorak"),
    "Łódź": ("odz", "Łodz", "Lodz"),
    "Iğdır": ("Igdr", "Igdır", "Igdir"),
    "İzmir": ("Izmir", "Izmir", "Izmir"),
    "Straße": ("Strae", "Straße", "Strasse"),
    "Ærø œuvre": ("r uvre", "Ærø œuvre", "AEro oeuvre"),
    "ﬁlm Ǆ ½": ("film DZ 12", "ﬁlm Ǆ ½", "film DZ ½"),
    "Phạm Văn Đồng": ("Pham Van ong", "Pham Van Đong", "Pham Van Dong"),
    "Ήλιος Пётр": (" ", "Ηλιος Петр", "Ηλιος Петр"),
    "ｆｕｌｌ": ("full", "ｆｕｌｌ", "full"),
    "": ("", "", ""),
    "plain": ("plain", "plain", "plain"),
    None: (None, None, None),
}


@pytest.mark.parametrize("i, f", list(enumerate((fo.to_ascii, fo.without_marks, fo.unaccented))))
def test_forms(spark, i, f):
    assert apply(spark, f, list(FORMS)) == [v[i] for v in FORMS.values()]


def test_all_letters_equal_the_library(spark):
    letters = [chr(c) for c in range(1, 0x20000) if not 0xAC00 <= c < 0xE000]
    words = ["".join(letters[i : i + 7]) for i in range(0, len(letters), 7)]
    ascii_ = [unicodedata.normalize("NFKD", w).encode("ascii", "ignore").decode() for w in words]
    nfd = ["".join(c for c in unicodedata.normalize("NFD", w) if unicodedata.category(c) != "Mn") for w in words]
    assert apply(spark, fo.to_ascii, words) == ascii_
    got = apply(spark, fo.without_marks, words)
    assert [unicodedata.normalize("NFC", g) for g in got] == [unicodedata.normalize("NFC", w) for w in nfd]


def test_keys_of_titles_and_names(spark):
    cases = {"Łódź, La": ("la lodz", "la odz"), "Straße (2019)": ("strasse", "strae"), "Dvořák": ("dvorak", "dvorak"), "Iğdır, unos": ("unos igdir", "unos igdr")}
    assert list(zip(apply(spark, tx.title_key, list(cases)), apply(spark, tx.ascii_title_key, list(cases)), strict=True)) == list(cases.values())
    assert apply(spark, tx.bare_key, ["Łódź Été", "ﬁn"]) == ["odzete", "n"]
    assert apply(spark, tx.person_words, ["Šárka O'Neil"]) == ["sarka o neil"]
    assert apply(spark, tx.upper_key, ["ﬁn  straße ł é"]) == ["FIN STRASSE Ł E"]
    assert apply(spark, tx.search_key, ["The Łódź: Été 4K"]) == ["łodz ete"]


def test_notes_go_until_none_is_left(spark):
    cases = {"Film - - - - - -": "Film", "Film -:-:-:": "Film", "Film 4(x)k": "Film", "Film (a) 4K (b) 3D HD encore -": "Film", "Film encore HD film  fest sing-a-long - : -": "Film", "4K": "4K", " - ": ""}
    assert apply(spark, tx.without_events, list(cases)) == list(cases.values())
    assert apply(spark, tx.without_events, ["Film" + " -" * 500]) == ["Film"]


REFERENCES = ["&oacute;", "&ntilde;", "&#233;", "&#xe9;", "&#XE9", "&amp;lt;", "&amp;amp;", "&lt", "&notit;", "&notin;", "&nosuch;", "& ", "&", "&&amp;&", "&#0;", "&#128;", "&#150;", "&#129;", "&#xD800;", "&#x110000;", "&#99999999999999999999;", "&#xFFFFFFFFFFFF;", "&#11;", "&#xFFFE;", "&#x1F600;", "&CounterClockwiseContourIntegral;", "&nbsp;", "&copy2024", "&AMP", "&fjlig;", "&#;", "&#x;", "&hellip;x&mdash;", "a&b;c", "&#000065;", "&#x0000000000041;"]


def test_references_equal_the_library(spark):
    rng = random.Random(3)
    mixed = ["".join(rng.choice([*REFERENCES, "x", ";", " ", "<b>", "&"]) for _ in range(rng.randrange(12))) for _ in range(400)]
    names = ["&" + n for n in html.entities.html5]
    cases = REFERENCES + mixed + names
    assert apply(spark, ht.unescape, cases) == [html.unescape(c) for c in cases]


def test_text_of_a_page(spark):
    page = "<p>Caf&eacute;&nbsp;&amp; m&#225;s</p><script>x<y;</script><STYLE>b{}</STYLE>fin&hellip;"
    assert apply(spark, ht.to_text, [page]) == ["Café & más fin…"]
