"""Column expressions shared by the plans. All are built-in JVM functions; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmill.schema import DATE_FORMAT


def parse_sales_date(text: Column) -> Column:
    """Date of an ``M/d/yyyy`` or ISO text; null, not an error, where it is no date."""
    iso = F.when(text.rlike("^\\s*\\d{4}-\\d{1,2}-\\d{1,2}\\s*$"), text.try_cast("date"))
    return F.coalesce(F.try_to_date(text, DATE_FORMAT), iso)


def sales_date_text(date: Column) -> Column:
    """A date as ``M/d/yyyy``, from its parts: formatting by pattern goes through a timestamp."""
    year = F.year(date)
    parts = F.concat_ws("/", F.month(date), F.day(date), year)
    return F.when(year.between(1000, 9999), parts).otherwise(F.date_format(date, DATE_FORMAT))


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` to two digits, null where ``whole`` is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 2)


def margin_pct(profit: Column, revenue: Column) -> Column:
    return percent_of(profit, revenue)


def plain_number(value: Column) -> Column:
    """A double as text without an exponent, as spreadsheets and other databases write it.

    Spark writes ``d.ddEn`` from 1e7 on and below 1e-3; the digits are the shortest that read back as
    the same double, so only the point has to move.
    """
    text = value.cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    lead = F.regexp_extract(text, r"(\d)\.\d+E", 1)
    rest = F.regexp_replace(F.regexp_extract(text, r"\.(\d+)E", 1), "^0$", "")
    power = F.regexp_extract(text, r"E(-?\d+)$", 1).try_cast("int")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), lead, rest)
    whole = F.concat(lead, F.left(F.rpad(rest, F.greatest(power, F.lit(1)), "0"), power))
    point = F.substring(rest, power + 1, F.length(rest))
    large = F.concat(whole, F.lit("."), F.when(point != "", point).otherwise("0"))
    moved = F.concat(sign, F.when(power < 0, small).otherwise(large))
    return F.when(power.isNull(), text).otherwise(moved)
