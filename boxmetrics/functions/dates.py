"""Dates and periods read from names and headers; what is no date becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from boxmetrics.functions import text as tx

# Spanish month names in order.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()


def parse_day(c: Column) -> Column:
    """dd/MM/yyyy, else ISO."""
    return F.coalesce(F.try_to_date(c, "d/M/yyyy"), F.try_to_date(c, "yyyy-M-d"))


def parse_short_day(c: Column, pivot: int) -> Column:
    """dd/MM/yy; two-digit years up to ``pivot`` are of this century."""
    yy = F.regexp_extract(c, r"^\d{1,2}/\d{1,2}/(\d{2})$", 1).try_cast("int")
    full = F.when(yy <= pivot, yy + 2000).otherwise(yy + 1900)
    return F.try_to_date(F.concat_ws("/", F.regexp_extract(c, r"^(\d{1,2}/\d{1,2})/", 1), full.cast("string")), "d/M/yyyy")


def month_number(name: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), tx.strip_marks(F.lower(name)))
    return F.nullif(at, F.lit(0))


def month_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(day))


def period(c: Column, pattern: str) -> Column:
    """Struct (start, end) from first day, last day, month and year, in that order of groups.

    A first day after the last one lies in the month before, which may be in the year before.
    """
    first, last = (F.regexp_extract(c, pattern, i).try_cast("int") for i in (1, 2))
    month, year = month_number(F.regexp_extract(c, pattern, 3)), F.regexp_extract(c, pattern, 4)
    at = lambda d: F.try_to_date(F.concat_ws("-", year, month.cast("string"), d.cast("string")), "yyyy-M-d")
    end = at(last)
    before = F.add_months(F.trunc(end, "month"), -1)
    start = F.when(first <= last, at(first)).otherwise(F.date_add(before, first - 1))
    return F.struct(start.alias("start"), end.alias("end"))


# Months misspelt in file names.
MISSPELT = {"npviembre": "noviembre", "npvienbre": "noviembre"}
_NAMES = "|".join(MONTHS)


def file_period(name: Column, section_year: Column | None = None) -> Column:
    """Struct (start, end) of a report, from the parts of its file name.

    Days stand before their month: two for one month, or one before each of two
    months. A year may follow a month, else the first year in the name counts,
    else that of the section it was found in. December to January ends a year
    later; a first day after the last one is of the month before. A day and month
    written together are taken apart. What is no period is null.
    """
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, tx.TOP_NAMES, ""), tx.DOMESTIC_NAMES, ""), r"\.pdf", "")
    parts = F.concat(F.lit("-"), F.translate(tx.strip_marks(F.lower(bare)), "_", "-"), F.lit("-"))
    for wrong, right in MISSPELT.items():
        parts = F.replace(parts, F.lit(wrong), F.lit(right))
    parts = F.regexp_replace(parts, rf"(?<=-)(\d{{1,2}})({_NAMES})(\d{{4}})?(?=-)", "$1-$2-$3")
    month = rf"^(.*?-)({_NAMES})(-.*)$"
    cut = lambda c: [F.regexp_extract(c, month, i) for i in (1, 2, 3)]
    before, m1, after = cut(parts)
    middle, m2, rest = cut(after)
    number = lambda c, p: F.regexp_extract(c, p, 1).try_cast("int")
    first, last = r"-(\d{1,2})(?=-)", r"^.*-(\d{1,2})(?=-)"
    year = F.coalesce(number(parts, r"-(\d{4})(?=-)"), section_year if section_year is not None else F.lit(None).cast("int"))
    own = lambda c: F.coalesce(number(c, r"^-(\d{4})-"), year)
    n1, n2 = month_number(m1), month_number(m2)
    d1, d2 = number(before, first), number(before, last)
    same = day_of(year, n1, d2)
    y2 = own(rest) + F.when((own(after) == own(rest)) & (n1 == 12) & (n2 == 1), 1).otherwise(0)
    single, double = m2 == "", (m2 != "") & ~rest.rlike(rf"-(?:{_NAMES})-")
    earlier = F.date_add(F.add_months(F.trunc(same, "month"), -1), d1 - 1)
    start = F.when(single & (d1 > d2), earlier).when(single, day_of(year, n1, d1)).when(double, day_of(own(after), n1, d2))
    end = F.when(single, same).when(double, day_of(y2, n2, number(middle, first)))
    whole = start.isNotNull() & end.isNotNull()
    return F.struct(F.when(whole, start).alias("start"), F.when(whole, end).alias("end"))


def day_of(year: Column, month: Column, day: Column) -> Column:
    """A date from its parts; null where there is no such day."""
    return F.try_to_date(F.concat_ws("-", year.cast("string"), month.cast("string"), F.coalesce(day.cast("string"), F.lit("x"))), "yyyy-M-d")


def header_period(text: Column) -> Column:
    """Struct (start, end) from "d - d Month yyyy", else from "d Month - d Month yyyy"; December to January begins a year earlier."""
    letters = "[A-Za-záéíóúñÁÉÍÓÚÑ]+"
    near = period(text, rf"(\d{{1,2}})\s*[-–]\s*(\d{{1,2}})\s+({letters})\s+(\d{{4}})")
    far = rf"(\d{{1,2}})\s+({letters})\s*(?:\d{{4}})?\s*[-–]\s*(\d{{1,2}})\s+({letters})\s+(\d{{4}})"
    part = lambda i: F.regexp_extract(text, far, i)
    m1, m2, y2 = month_number(part(2)), month_number(part(4)), part(5).try_cast("int")
    y1 = F.when((m1 == 12) & (m2 == 1), y2 - 1).otherwise(y2)
    start, end = day_of(y1, m1, part(1).try_cast("int")), day_of(y2, m2, part(3).try_cast("int"))
    whole = near["start"].isNotNull() & near["end"].isNotNull()
    return F.struct(F.when(whole, near["start"]).otherwise(start).alias("start"), F.when(whole, near["end"]).otherwise(end).alias("end"))


def report_period(text: Column, name: Column, section_year: Column | None = None) -> Column:
    """Struct (start, end, origin): what the report says of itself, else its file name, else nulls."""
    content, file = header_period(text), file_period(name, section_year)
    said, named = content["start"].isNotNull() & content["end"].isNotNull(), file["start"].isNotNull()
    origin = F.when(said, "content").when(named, "name").otherwise("none")
    return F.struct(*[F.when(said, content[k]).otherwise(file[k]).alias(k) for k in ("start", "end")], origin.alias("origin"))


def parse_yearbook_day(c: Column, year: int) -> Column:
    """dd/mm/yy or dd/mm/yyyy, by slashes or dashes; years of two digits are not after ``year``."""
    c = F.replace(F.regexp_replace(c, r"\s", ""), F.lit("-"), F.lit("/"))
    return F.when(c.rlike(r"/\d{4}$"), F.try_to_date(c, "d/M/yyyy")).otherwise(parse_short_day(c, year % 100))


def last_weekend(today: Column) -> Column:
    """Struct (start, end) of the last Friday to Sunday that is over; on a Sunday that of the week before."""
    sunday = F.date_sub(today, F.weekday(today) + 1)
    return F.struct(F.date_sub(sunday, 2).alias("start"), sunday.alias("end"))


def weekend_start(day: Column) -> Column:
    """The Friday of the weekend the day lies in; null for Monday to Thursday."""
    return F.when(F.weekday(day) >= 4, F.date_sub(day, F.weekday(day) - 4))


def weekend_of(day: Column) -> Column:
    """The Friday on or before the day."""
    return F.date_sub(day, F.pmod(F.weekday(day) + 3, F.lit(7)))
