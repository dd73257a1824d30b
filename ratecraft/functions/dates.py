"""Date-part column builders (C1–C4).  All are JVM-side expressions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Three-letter day and month names and their numbers.
DAY_NUMBERS = {"mon": 1, "tue": 2, "wed": 3, "thu": 4, "fri": 5, "sat": 6, "sun": 7}
MONTH_NUMBERS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
                 "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12}


def _lookup(c: Column, table: dict) -> Column:
    m = F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, F.lower(c)).cast("int")


def day_of_week_number(c: Column) -> Column:
    """Day name → 1..7, case-insensitive; anything else → null."""
    return _lookup(c, DAY_NUMBERS)


def month_number(c: Column) -> Column:
    """Month name → 1..12, case-insensitive; anything else → null."""
    return _lookup(c, MONTH_NUMBERS)


def time_to_seconds(c: Column) -> Column:
    """``hh:mm:ss`` → seconds; not three parts → 0; a non-numeric part → null."""
    parts = F.split(c, ":")

    def part(k):
        return F.trim(F.element_at(parts, k)).try_cast("int")

    secs = part(1) * 3600 + part(2) * 60 + part(3)
    return F.when(F.size(parts) != 3, F.lit(0)).otherwise(secs).cast("int")


def birthday_to_age(c: Column, as_of_year: int | None = None) -> Column:
    """C4: ``"<text>, <yyyy>"`` → as_of_year − yyyy; ``unknown``, no comma or age ≤ 0 → 0.

    ``as_of_year`` defaults to the current year (the reference reads the clock).
    """
    year_now = as_of_year if as_of_year is not None else datetime.date.today().year
    year = F.trim(F.element_at(F.split(c, ","), 2)).try_cast("int")
    age = F.lit(year_now) - year
    return (F.when(F.lower(c) == "unknown", F.lit(0))
            .when(~c.contains(","), F.lit(0))
            .when(age > 0, age)
            .when(age.isNull(), F.lit(None))
            .otherwise(F.lit(0))).cast("int")
