"""Dates and times. ``as_of`` is always given by the caller, so that a rerun gives the same result."""

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

AsOf = date | datetime | str


def months_before(as_of: AsOf, months: int, column_type: T.DataType | None = None) -> Column:
    """The moment ``months`` calendar months before ``as_of``, time of day kept.

    It is a constant that Catalyst folds, so a comparison with it reaches the scan. With a
    ``column_type`` of TIMESTAMP_NTZ it has that type, and no time zone takes part.
    """
    kind = column_type if isinstance(column_type, T.TimestampNTZType) else T.TimestampType()
    return F.lit(str(as_of)).cast(kind) - F.make_ym_interval(F.lit(0), F.lit(int(months)))


def day_slice_start(day: Column | AsOf, size: int) -> Column:
    """1-based start of the weekday's slice of a weekly list, Monday first."""
    moment = day if isinstance(day, Column) else F.lit(str(day)).cast("date")
    return F.weekday(moment) * F.lit(size) + F.lit(1)


def at_date(moment: Column | str) -> Column:
    """ISO text with seconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def updated_millis(moment: Column | str) -> Column:
    """Epoch milliseconds, rounded to the nearest one (halves to the even one)."""
    column = F.col(moment) if isinstance(moment, str) else moment
    micros = F.unix_micros(column.cast("timestamp"))
    return F.bround(micros.cast("decimal(20,0)") / F.lit(1000), 0).cast("bigint")
