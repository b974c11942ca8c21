"""Instants, calendar parts and calendar texts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def from_epoch_ns(nanos: Column) -> Column:
    """Epoch nanoseconds to an instant; exact to the microsecond, free of any time zone."""
    thousand = F.lit(1000).cast("long")
    micros = F.call_function("div", nanos - F.pmod(nanos, thousand), thousand)
    return F.timestamp_add("MICROSECOND", micros, F.expr(EPOCH))


def to_epoch_ns(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), ts) * F.lit(1000).cast("long")


def date_of(ts: Column) -> Column:
    return F.to_date(ts)


def year_month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def year_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy")


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def proleptic_ordinal(day: Column) -> Column:
    """Days counted from 0001-01-01 = 1."""
    return F.date_diff(day, F.expr("DATE '0001-01-01'")) + F.lit(1)


def leap_day_of_year(day: Column) -> Column:
    """Day of year as in a leap year: common years skip number 60."""
    is_leap = (F.year(day) % 4 == 0) & ((F.year(day) % 100 != 0) | (F.year(day) % 400 == 0))
    return F.dayofyear(day) + F.when(~is_leap & (F.month(day) > 2), 1).otherwise(0)
