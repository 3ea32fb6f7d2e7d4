"""Date parsing with the survey scripts' conventions (unparseable -> NULL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import col, to_num

SPREADSHEET_ORIGIN = "1899-12-30"  # fixed value: day 0 of spreadsheet serial dates


def parse_date(c: Column | str, fmt: str) -> Column:
    """Text to date with a Spark datetime pattern; NULL when it does not parse."""
    return F.try_to_date(col(c).cast("string"), fmt)


def parse_date_2digit_year(c: Column | str, fmt: str, pivot: int = 68) -> Column:
    """Like :func:`parse_date` for patterns with a two-digit year (``yy``).

    Two-digit years 00..``pivot`` are 20xx and the rest 19xx (POSIX ``%y``),
    whereas Spark's ``yy`` always reads 20xx.
    """
    d = parse_date(c, fmt)
    return F.when(F.year(d) > F.lit(2000 + pivot), F.add_months(d, -1200)).otherwise(d)


def from_serial_day(c: Column | str, origin: str = SPREADSHEET_ORIGIN) -> Column:
    """Spreadsheet serial day number (text or number) to date."""
    n = to_num(c)
    return F.date_add(F.to_date(F.lit(origin)), F.floor(n).cast("int"))


def mixed_date(c: Column | str, fmt: str = "d.M.yyyy", marker: str = ".") -> Column:
    """Text holding either a formatted date (it contains ``marker``; its year
    may have two digits) or a spreadsheet serial day number."""
    c = col(c)
    written = F.coalesce(parse_date(c, fmt), parse_date_2digit_year(c, fmt.replace("yyyy", "yy")))
    return F.when(c.contains(marker), written).otherwise(from_serial_day(c))


def parse_ymd_h(c: Column | str) -> Column:
    """``yyyy-MM-dd[ HH]`` text to timestamp, truncated forms allowed."""
    c = col(c).cast("string")
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH")),
                      F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))


def format_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(col(c), fmt)
