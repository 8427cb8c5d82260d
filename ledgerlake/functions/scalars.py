"""Scalar column helpers shared by every operator.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums take each amount at two places (money has no smaller unit); amounts that do not fit
# are summed as doubles beside them.
MONEY = "decimal(18,2)"
MONEY_WIDE = "decimal(38,2)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: str | Column) -> Column:
    """Order-independent sum of a money column, returned as double.

    The sum runs on ``decimal(18,2)``, so partial sums from any partitioning
    add up to the same value; non-finite amounts (NaN, infinity) pass
    through as a double sum the way plain double arithmetic would.
    """
    c = col(c)
    finite = c.try_cast(MONEY)
    exact = F.sum(finite).cast("double")
    rest = F.sum(F.when(c.isNotNull() & finite.isNull(), c))
    return F.coalesce(rest + F.coalesce(exact, F.lit(0.0)), exact)


def money_avg(c: str | Column) -> Column:
    """money_sum / count of non-null values; null for no values."""
    return F.try_divide(money_sum(c), F.count(col(c)))


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (null counts in neither)."""
    return F.sum(F.when(cond, 1).otherwise(0))


def ratio_pct(num: str | Column, den: str | Column, places: int = 2) -> Column:
    """round(num / den * 100, places); null when den is 0 or null."""
    return F.round(F.try_divide(col(num), col(den)) * F.lit(100), places)


def ratio(num: str | Column, den: str | Column, places: int = 2) -> Column:
    return F.round(F.try_divide(col(num), col(den)), places)


def money_text(c: str | Column) -> Column:
    """Money as fixed two-decimal text, e.g. 245010.00; a finite or infinite amount that
    no decimal holds keeps its plain text, so it is never lost."""
    c = col(c)
    return F.coalesce(c.try_cast(MONEY_WIDE).cast("string"),
                      F.when(~F.isnan(c), c.cast("string")))


def hour_of(ts: str | Column, is_text: bool) -> Column:
    """Hour of a timestamp; text input takes characters 12-13, and any
    failure (null, short, not a number) gives 12."""
    ts = col(ts)
    if is_text:
        return F.coalesce(F.substring(ts, 12, 2).try_cast("int"), F.lit(12))
    return F.coalesce(F.hour(ts), F.lit(12))


def ts_literal(value: dt.datetime | str) -> Column:
    """A wall-clock timestamp literal (timestamp_ntz, no zone shift)."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(value).cast("timestamp_ntz")


def date_literal(value: dt.date | str) -> Column:
    if isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast("date")


def json_string_array(arr: str | Column) -> Column:
    """JSON text of an array of plain strings, spaced like the reference
    (``["a", "b"]``). Elements must not need escaping."""
    quoted = F.transform(col(arr), lambda x: F.concat(F.lit('"'), x, F.lit('"')))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
