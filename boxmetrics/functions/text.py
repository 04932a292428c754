"""Title and name normalisers as named variants of one chain of built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxmetrics.functions import folding as fo

# Accented letters and what they become; vowels alone, where n with a tilde is a letter of its own.
MARKED_VOWELS, VOWELS = "áéíóúüÁÉÍÓÚÜ", "aeiouuAEIOUU"
# Articles that titles carry behind a comma, those shown again before a title, and those not searched by.
ARTICLES = "el|la|los|las|un|una|unos|unas"
SHOWN_ARTICLES = "El|La|Los|Las|Un|Una|Els|Les"
LEADING_ARTICLES = "el|la|los|las|the|a|un|una"
# Small words that tell nothing of a title; sign-offs that a feed adds to one.
SMALL_WORDS = [*ARTICLES.split("|"), "y", "e", "de", "del", "en"]
SIGN_OFFS = "Entertainment|European|phoenix|avalon"
# Notes that event screenings add to a title, and what they may follow.
EVENT_WORDS = [r"\d+[ºth°]?\s*aniversario\b", r"\d+[ºth°]?\s*anniversary\b", r"\b4k\b", r"\b3d\b", r"\bhd\b", r"sing-?a-?long\b", r"film\s+fest\b", r"encore\b"]
EVENT_NOTES = r"(?i)\s*\(.*?\)|\s+(?:" + "|".join(EVENT_WORDS) + r")|\s*[-:]\s*$"
BLANKS = r"[\s\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"  # what Unicode calls white space


def unaccent(c: Column) -> Column:
    """Lower case without accents; ligatures and letters such as ł are written in plain ones."""
    return fo.unaccented(F.lower(c))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def strip_marks(c: Column) -> Column:
    """Vowels without accents; other letters, n with a tilde among them, stay."""
    return F.translate(c, MARKED_VOWELS, VOWELS)


def title_key(c: Column) -> Column:
    """Match key: what is in brackets goes, a trailing ", article" moves to the front, no accents, words only."""
    c = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\([^)]*\)", " "))
    c = F.regexp_replace(c, rf"(?i)^(.*),\s*({ARTICLES})$", "$2 $1")
    return F.trim(F.regexp_replace(unaccent(c), "[^a-z0-9]+", " "))


def ascii_title_key(c: Column) -> Column:
    """As ``title_key``, but letters that have no ASCII in them are dropped: ß and ł leave nothing."""
    c = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\([^)]*\)", " "))
    c = F.regexp_replace(c, rf"(?i)^(.+),\s*({ARTICLES})$", "$2 $1")
    return F.trim(F.regexp_replace(F.lower(fo.to_ascii(c)), "[^a-z0-9]+", " "))


def shown_title(c: Column) -> Column:
    """The title with its ", Article" put back in front; the article must be written as a name's."""
    return F.regexp_replace(c, rf"^(.*), ({SHOWN_ARTICLES})$", "$2 $1")


def without_events(c: Column) -> Column:
    """A title without brackets and event notes, taken away until none is left: one may bare another."""
    c = F.trim(F.coalesce(c, F.lit("")))
    once = lambda t: F.trim(F.regexp_replace(t, EVENT_NOTES, ""))
    rounds = F.sequence(F.lit(1), F.length(c))  # each round but the last makes the title shorter
    all_gone = F.aggregate(rounds, c, lambda t, _: F.when(t.rlike(EVENT_NOTES), once(t)).otherwise(t))
    return F.when(c.rlike(EVENT_NOTES), all_gone).otherwise(c)


def search_key(c: Column) -> Column:
    """Comparison key of a film: no event notes, accents or punctuation, one leading article dropped."""
    c = F.regexp_replace(F.trim(F.lower(fo.without_marks(without_events(c)))), rf"^(?:{LEADING_ARTICLES}) ", "")
    return squeeze(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", ""))


def without_noise(c: Column) -> Column:
    """A title without brackets, shooting notes and the sign-offs of feeds."""
    c = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\([^)]*\)", " "))
    c = F.regexp_replace(c, r"(?is)\s+se realiza siguiendo\b.*$", "")
    for name in SIGN_OFFS.split("|"):  # each once, in this order
        c = F.trim(F.regexp_replace(c, rf"(?i) {name}$", ""))
    return F.btrim(squeeze(c), F.lit(" ,"))


def article_first(c: Column) -> Column:
    """ "Tribu, La" and "tribu la" begin with their article; a title of one word stays."""
    c = F.trim(c)
    comma, bare = rf"(?i)^(.+),\s*({ARTICLES})$", rf"(?i)^(.*\S)\s+({ARTICLES})$"
    return F.when(c.rlike(comma), F.regexp_replace(c, comma, "$2 $1")).otherwise(F.regexp_replace(c, bare, "$2 $1"))


def title_variants(c: Column) -> Column:
    """Ways to search for a title, in the order of trust, none twice; last the parts before a subtitle."""
    base = without_noise(c)
    moved = article_first(base)
    words = lambda t: F.regexp_replace(t, r"[^\p{L}\p{N}_\s]", " ")
    plain = fo.to_ascii
    forms = [moved, base, words(moved), words(base), plain(moved), plain(base), plain(words(moved)), plain(words(base)), F.upper(moved), F.upper(base)]
    whole = F.array_distinct(F.filter(F.array(*[F.btrim(squeeze(f), F.lit(" ,")) for f in forms]), lambda v: v != ""))
    heads = F.transform(whole, lambda v: F.trim(F.regexp_extract(v, r"^([^:;]*)", 1)))
    return F.array_distinct(F.concat(whole, F.filter(heads, lambda v: v != "")))


def telling_words(c: Column) -> Column:
    """The words of a title that can be matched: over two letters and no small words, in order."""
    key = squeeze(F.regexp_replace(F.lower(fo.to_ascii(article_first(without_noise(c)))), r"[^a-z0-9\s]", " "))
    return F.filter(F.split(key, " "), lambda w: (F.length(w) > 2) & ~w.isin(SMALL_WORDS))


def contained_share(words: Column, text: Column) -> Column:
    """Share of the words that stand in the text, within longer words too; no words, no share."""
    return F.when(F.size(words) == 0, 0.0).otherwise(F.size(F.filter(words, lambda w: text.contains(w))) / F.size(words))


def strict_share(a: Column, b: Column) -> Column:
    """Common words over the larger word set, so that a short title is not found in a longer one."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))


def upper_key(c: Column) -> Column:
    """Upper case without marks, blanks squeezed."""
    return squeeze(fo.uncombined(F.upper(F.coalesce(c, F.lit("")))))


# Letters that a broken word is split between; gaps that a page's layout leaves in a figure.
CAPITALS = "A-ZÁÉÍÓÚÑ"
FIGURE_GAPS = ((r"(?<=\d)\.\s+(?=\d{3})", "."), (r"(?<=\d)\s+(?=\d{3}(?:\D|$))", ""))


def undashed(c: Column) -> Column:
    """Words in capitals that a line end has split are joined again."""
    return F.regexp_replace(squeeze(c), f"(?<=[{CAPITALS}])- (?=[{CAPITALS}])", "")


def rejoined_thousands(c: Column) -> Column:
    """Figures that a line's layout has split at their thousands are joined again."""
    c = squeeze(F.replace(c, F.lit("\u00a0"), F.lit(" ")))
    for gap, mark in FIGURE_GAPS:
        c = F.regexp_replace(c, gap, mark)
    return squeeze(c)


def search_safe(c: Column) -> Column:
    """A title for a web search: no brackets or signs."""
    return squeeze(F.regexp_replace(F.regexp_replace(c, r"\([^)]*\)", " "), r"[^\p{L}\p{N}_\s]", " "))


# How reports' file names begin.
TOP_NAMES = r"^(?i)top-?25-"
DOMESTIC_NAMES = r"^(?i)(?:top-?espa[nñ]i?o?l-|topepaniol-|cineespan[iío]l-|cineespa[nñ]i?ol-)"


def report_kind(name: Column) -> Column:
    """Which report a file is, by its name; null for any other file."""
    return F.when(name.rlike(TOP_NAMES), "top").when(name.rlike(DOMESTIC_NAMES), "domestic")


def stored_name(name: Column, year: Column) -> Column:
    """The name a file is kept under: one without a year gets that of its section in front."""
    return F.when(name.rlike(r"\d{4}") | year.isNull(), name).otherwise(F.concat(year.cast("string"), F.lit("_"), name))


def alnum_key(c: Column) -> Column:
    """Letters and digits only, without accents."""
    return F.regexp_replace(unaccent(c), "[^a-z0-9]", "")


def bare_key(c: Column) -> Column:
    """Letters and digits only, combining marks taken off first; letters that have no plain form are dropped."""
    return F.regexp_replace(F.lower(fo.without_marks(c)), "[^a-z0-9]", "")


def raw_key(c: Column) -> Column:
    """Letters and digits only; accented letters are deleted, not replaced."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def head_key(c: Column) -> Column:
    """What stands before the first comma, without brackets and a leading article."""
    c = F.regexp_replace(F.substring_index(c, ",", 1), r"\([^)]*\)", "")
    return F.regexp_replace(unaccent(F.trim(c)), rf"^(?:{ARTICLES})\s+", "")


def person_words(c: Column) -> Column:
    """A person's name for comparing: no accents, signs as blanks."""
    return squeeze(F.regexp_replace(F.lower(fo.without_marks(F.trim(c))), r"[^\p{L}\p{N}_\s]", " "))


def person_query(c: Column) -> Column:
    """ "Surname, Name" turned round at the first comma."""
    return F.trim(F.regexp_replace(F.trim(c), r"^([^,]*),\s*(.*)$", "$2 $1"))


def person_likeness(straight: Column, turned: Column, other: Column) -> Column:
    """:func:`person_score` of names that are not empty, from the :func:`person_words` of the one, of it turned round, and of the other."""
    words = lambda v: F.filter(F.split(v, " "), lambda w: w != "")
    best = F.greatest(strict_share(words(straight), words(other)), strict_share(words(turned), words(other)))
    return F.when((straight == other) | (turned == other), 1.0).otherwise(best)


def person_score(a: Column, b: Column) -> Column:
    """1 if the names are equal, as written or turned round; else common words over the larger set, the better of both ways."""
    like = person_likeness(person_words(a), person_words(person_query(a)), person_words(b))
    return F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == ""), 0.0).otherwise(like)


def person_key(c: Column) -> Column:
    """Trimmed, no trailing dots, "Surname, Name" turned round, no accents."""
    c = F.regexp_replace(F.trim(c), r"\.+$", "")
    return squeeze(unaccent(F.regexp_replace(c, r"^([^,]*),\s*(.*)$", "$2 $1")))


def undoubled(c: Column) -> Column:
    """A title that is one half said twice becomes that half."""
    return F.regexp_replace(c, r"(?i)^(.+)\s+\1$", "$1")


def token_overlap(a: Column, b: Column) -> Column:
    """1 for equal, 0.8 if one holds the other, else common words over the larger word set."""
    x, y = (F.array_distinct(F.split(v, " ")) for v in (a, b))
    return F.when(a == b, 1.0).when(a.contains(b) | b.contains(a), 0.8).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y)))


def spanish_number(c: Column, digits: int = 2) -> Column:
    """1234567.5 as 1.234.567,50; null as a dash."""
    return F.coalesce(F.translate(F.format_number(c, digits), ",.", ".,"), F.lit("—"))


def parse_euros(c: Column) -> Column:
    """"4.094.999,17 €" to a decimal; what is no number to null."""
    return F.translate(F.regexp_replace(c, r"[.€\s]", ""), ",", ".").try_cast("decimal(18,2)")


def parse_digits(c: Column) -> Column:
    """The digits of a text as a whole number; none to null."""
    return F.regexp_replace(c, "[^0-9]", "").try_cast("long")


def short_euros(c: Column) -> Column:
    """1200000 as 1,2 M€, 345000 as 345 k€, less as it is; null as a dash."""
    one = F.translate(F.format_number(c / 1_000_000, 1), ",.", ".,")
    return F.when(c.isNull(), "—").when(F.abs(c) >= 1_000_000, F.concat(one, F.lit(" M€"))).when(F.abs(c) >= 1_000, F.concat(F.format_number(F.round(c / 1_000), 0), F.lit(" k€"))).otherwise(F.concat(F.translate(F.format_number(c, 0), ",.", ".,"), F.lit(" €")))


def percent(c: Column, digits: int = 1) -> Column:
    """12.34 as 12,3 %; null as a dash."""
    return F.when(c.isNull(), "—").otherwise(F.concat(F.translate(F.format_number(c, digits), ",.", ".,"), F.lit(" %")))


def local_time(c: Column, zone: str = "Europe/Madrid") -> Column:
    """A UTC time as dd/mm/yyyy hh:mm of the zone; null as a dash."""
    return F.coalesce(F.date_format(F.from_utc_timestamp(c, zone), "dd/MM/yyyy HH:mm"), F.lit("—"))
