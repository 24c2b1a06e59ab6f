"""Dates out of texts and names, and how two dates of one note relate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats in which dates are written, in the order in which they are tried.
FORMATS = ["dd/MM/yyyy", "dd.MM.yyyy", "yyyy-MM-dd", "dd-MM-yyyy"]


def parse_date(c: Column) -> Column:
    """A date in any of FORMATS, null if there is none such or it isn't in the calendar."""
    return F.coalesce(*[F.try_to_timestamp(F.trim(c), F.lit(f)).cast("date") for f in FORMATS])


def day_month_year(c: Column) -> Column:
    """DD/MM/YYYY of a date written in any of FORMATS."""
    return F.date_format(parse_date(c), "dd/MM/yyyy")


def _built(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_timestamp(F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def filename_date(name: Column) -> Column:
    """The first year-month-day of this century in a name, with - or _ between."""
    pattern = r"(20\d{2})[-_](\d{2})[-_](\d{2})"
    return _built(*[F.regexp_extract(name, pattern, k) for k in (1, 2, 3)])


def meta_date(value: Column) -> Column:
    pattern = r"D:(\d{4})(\d{2})(\d{2})"
    return _built(*[F.regexp_extract(value, pattern, k) for k in (1, 2, 3)])


#: The date of a letterhead, and any date, as notes write them.
LETTERHEAD = r"(?i)Luxembourg,?\s+([0-3]?\d[./-][01]?\d[./-]20\d{2})"
ANY_DATE = r"\b([0-3]?\d[./][01]?\d[./]20\d{2})\b"


def visible_raw(text: Column) -> Column:
    """The date as written after the city of the letterhead, else the first date in the text."""
    head, any_ = F.regexp_extract(text, LETTERHEAD, 1), F.regexp_extract(text, ANY_DATE, 1)
    return F.coalesce(F.nullif(head, F.lit("")), F.nullif(any_, F.lit("")))


def visible_date(text: Column) -> Column:
    parts = F.split(visible_raw(text), r"[./-]")
    return F.when(F.size(parts) == 3, _built(F.get(parts, 2), F.get(parts, 1), F.get(parts, 0)))


def path_year(path: Column) -> Column:
    return F.regexp_extract(path, r"(?:^|[/\\])(\d{4})(?:[/\\]|$)", 1).try_cast("int")


def swapped(d: Column) -> Column:
    """Day and month exchanged; null where the day is no month."""
    return F.when(F.dayofmonth(d) <= 12, _built(F.year(d).cast("string"), F.dayofmonth(d).cast("string"), F.month(d).cast("string")))


def date_status(database: Column, visible: Column, file: Column) -> Column:
    return (
        F.when(database.isNull(), "missing_db_date")
        .when(visible.isNull(), "no_visible_date")
        .when(database == visible, "db_matches_visible")
        .when(database == swapped(visible), "db_is_visible_day_month_swap")
        .when(file.isNotNull() & (database == file) & (visible != file), "db_matches_filename_not_visible")
        .when(file.isNotNull() & (visible == file), "visible_matches_filename_db_differs")
        .otherwise("db_visible_mismatch")
    )
