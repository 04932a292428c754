"""Numbers, durations and years read from printed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _token_number(t: Column) -> Column:
    """One token as a plain number; what is no number stays as it is.

    With a comma, dots are thousands. With dots only they are thousands too if no
    later group is longer than three signs, so that 12.5 becomes 125.
    """
    groups = F.split(t, r"\.")
    dotted = (F.size(groups) > 1) & F.forall(F.slice(groups, 2, F.size(groups)), lambda g: F.length(g) <= 3)
    plain = F.when(t.contains(","), F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).when(dotted, F.replace(t, F.lit("."), F.lit(""))).otherwise(t)
    shown = F.regexp_replace(F.regexp_replace(plain.try_cast("decimal(38,10)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(t.isin("", "-"), "").otherwise(F.coalesce(F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), shown), t))


def clean_number(c: Column) -> Column:
    """A printed figure as a plain number: signs of money and percent go, a lone dash is empty.

    Of several tokens, as when a neighbouring column runs over, the last that is not empty counts.
    """
    bare = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[€%]", ""))
    found = F.filter(F.transform(F.split(bare, r"\s+"), _token_number), lambda n: n != "")
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def parse_minutes(c: Column) -> Column:
    """The whole number before "min"; without one null."""
    return F.nullif(F.regexp_extract(c, r"(?i)(\d+)\s*min", 1), F.lit("")).try_cast("int")


def parse_decimal(c: Column) -> Column:
    """A number with a decimal comma or point; blank or no number to null."""
    return F.replace(F.trim(c), F.lit(","), F.lit(".")).try_cast("double")


def year_of_name(name: Column, known: dict[str, int] | None = None) -> Column:
    """The year a file name is known for, else the first 20xx in it."""
    found = F.nullif(F.regexp_extract(name, r"(20\d{2})", 1), F.lit("")).try_cast("int")
    for n, year in (known or {}).items():
        found = F.when(name == n, year).otherwise(found)
    return found


def guarded_between(c: Column, low: int, high: int) -> Column:
    """Whether a text is a whole number within the bounds; any other text is not."""
    return F.coalesce(c.rlike("^[0-9]+$") & c.try_cast("long").between(low, high), F.lit(False))
