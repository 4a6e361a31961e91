"""Column expressions shared by the operators.  All are built-in Spark
functions, so they stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Fixed value: the month length used to turn day gaps into lifetime months.
DAYS_PER_MONTH = 30.44


def col_or_name(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI mode would raise)."""
    return F.try_divide(col_or_name(num), col_or_name(den))


def row_sum(cols) -> Column:
    """Sum across columns in one expression (null if any input is null).
    Names are taken literally, dots and all."""
    return reduce(add, [c if isinstance(c, Column) else F.col(f"`{c}`") for c in cols])


def lifetime_month(ts, first_ts) -> Column:
    """Whole months since the first activity, counted from 1.

    ``int(datediff(ts, first) / 30.44 + 1)``: day gaps 0 and 30 give 1, 31
    gives 2, 61 gives 3.  ``datediff`` counts calendar days.
    """
    days = F.datediff(F.to_date(col_or_name(ts)), F.to_date(col_or_name(first_ts)))
    return (days / F.lit(DAYS_PER_MONTH) + F.lit(1)).cast("int")


def md5_unit(key, seed) -> Column:
    """A uniform number in [0, 1) from the key alone, stable under any
    partitioning or row order (unlike ``randomSplit``)."""
    salted = F.concat(col_or_name(key).cast("string"), F.lit(":"), F.lit(str(seed)))
    head = F.substring(F.md5(salted), 1, 8)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(4294967296.0)


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every floating column; used at output only."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.round(F.col(f"`{f.name}`"), places).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def q(name: str) -> Column:
    """Column by a name that may hold special characters (``/``, spaces)."""
    return F.col(f"`{name}`")
