"""Column helpers with one fixed result type each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeweir.schemas import MONEY_SUM


def money_sum(x: Column | str) -> Column:
    return F.sum(x).cast(MONEY_SUM)


def mean(total: Column, count: Column) -> Column:
    """Exact decimal total over count, as double (AVG without summing doubles)."""
    return F.when(count != 0, total.cast("double") / count)


def day(ts: Column | str) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def month(ts: Column | str) -> Column:
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def weekday(date: Column | str) -> Column:
    """Day of week counted from Sunday = 0."""
    return (F.dayofweek(date) - 1).cast("bigint")


def days_between(later: Column, earlier: Column | str) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def email_domain(email: Column | str) -> Column:
    return F.split_part(email, F.lit("@"), F.lit(2))


def rounded(x: Column | str, places: int = 2) -> Column:
    col = F.col(x) if isinstance(x, str) else x
    return F.round(col.cast("decimal(28,6)"), places).cast("decimal(20,2)")


def tier(total: Column | str, silver_from, gold_from) -> Column:
    """Bronze below ``silver_from``, Silver below ``gold_from``, else Gold."""
    col = F.col(total) if isinstance(total, str) else total
    return F.when(col < silver_from, "Bronze").when(col < gold_from, "Silver").otherwise("Gold")
