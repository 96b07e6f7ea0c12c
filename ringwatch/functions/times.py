"""Time functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Layouts of times besides ISO, in the order in which they are tried.
LAYOUTS = [
    "MMM d HH:mm:ss Z yyyy", "M/d/yyyy[ H:mm[:ss]]", "d.M.yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]", "MMM d, yyyy[ H:mm[:ss]]", "yyyyMMdd",
]


def parse_time(text: Column, layouts: list[str] = LAYOUTS) -> Column:
    """Timestamp of a text in ISO form or one of the layouts; null where it cannot be read.

    The name of a weekday before a time is passed over. Where both can be, the month comes before the day.
    """
    plain = F.trim(F.regexp_replace(text, r"^\s*(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+", ""))
    digits = plain.rlike(r"^\d+$")
    iso = F.when(~digits, F.try_to_timestamp(plain))
    return F.coalesce(iso, *[F.try_to_timestamp(plain, F.lit(layout)) for layout in layouts])


def week_of(ts: Column) -> Column:
    """Monday of the week as a date; no time zone is involved."""
    return F.date_sub(F.next_day(ts.cast("date"), "MON"), 7)
