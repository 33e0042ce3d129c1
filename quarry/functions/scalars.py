"""Column helpers where the two SQL dialects of the course differ, or where
exactness matters (money, averages, NULL order).  All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Exact two-decimal money value (test data stores doubles)."""
    return col(c).cast(MONEY)


def cents(c) -> Column:
    """Money as a whole number of cents (long): exact and fast to add."""
    return F.round(col(c) * 100).cast("long")


def from_cents(c) -> Column:
    """Cents back to an exact two-decimal value."""
    return (col(c).cast("decimal(36,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(38,2)")


def div_round_half_up(num, den) -> Column:
    """Integer ``num/den`` rounded half away from zero, in exact integer math
    (38 digits; NULL when a side is NULL or den is 0).

    Used for averages of money in cents so Spark and SQL agree digit by digit.
    """
    n, d = col(num).cast("decimal(36,0)"), col(den).cast("decimal(19,0)")
    twice = (F.abs(n) * 2).cast("decimal(38,0)") + d
    q = F.call_function("div", twice.cast("decimal(38,0)"), F.nullif((d * 2).cast("decimal(20,0)"), F.lit(0)))
    return (F.when(n < 0, -q).otherwise(q)).cast("long")


def sum_cents(c) -> Column:
    """Sum of a cents column with 38 digits (a long sum overflows near 10^12
    rows of money)."""
    return F.sum(col(c).cast("decimal(19,0)"))


def avg_money(sum_cents, n) -> Column:
    """ROUND(AVG(money), 2) from a cents sum and a count; NULL when n == 0."""
    return from_cents(F.when(col(n) > 0, div_round_half_up(sum_cents, n)))


def asc_sql(c) -> Column:
    """ASC with SQL-server NULL placement (NULLs last)."""
    return col(c).asc_nulls_last()


def desc_sql(c) -> Column:
    """DESC with SQL-server NULL placement (NULLs first)."""
    return col(c).desc_nulls_first()


def months_between_whole(end, start) -> Column:
    """Whole months between two dates (AGE + EXTRACT / TRUNC(MONTHS_BETWEEN)),
    truncated toward zero when the end lies before the start."""
    e, s = F.to_date(col(end)), F.to_date(col(start))
    m = (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))
    short = F.when((m > 0) & (F.dayofmonth(e) < F.dayofmonth(s)), 1).when(
        (m < 0) & (F.dayofmonth(e) > F.dayofmonth(s)), -1).otherwise(0)
    return (m - short).cast("int")


def epoch_millis(ts) -> Column:
    """Unix epoch milliseconds of a TIMESTAMP_NTZ wall-clock value, read as
    UTC and independent of the session time zone (floor of the microseconds)."""
    t = col(ts)
    day_ms = F.unix_date(F.to_date(t)).cast("long") * 86400000
    tod_ms = (F.hour(t) * 3600000 + F.minute(t) * 60000).cast("long")
    sec_ms = F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long")
    return day_ms + tod_ms + sec_ms
