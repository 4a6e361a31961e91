"""Questions about long and wide time series: extremes, ranges, yearly
means, joining two series and correlating them per group."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import q, safe_div
from .reshape import melt


def rows_at_max(df: DataFrame, value: str) -> DataFrame:
    """Every row whose ``value`` equals the global maximum (ties kept).

    The maximum is a scalar subquery: one aggregate, planned once, feeding
    the filter of the same query (no value returns to the driver).
    """
    top = df.select(F.max(q(value))).scalar()
    return df.where(q(value) == top)


def rows_at_max_sql(spark: SparkSession, df: DataFrame, value: str) -> DataFrame:
    """``rows_at_max`` in SQL: a scalar subquery in the WHERE clause."""
    return spark.sql(f"SELECT * FROM {{t}} WHERE `{value}` = (SELECT MAX(`{value}`) FROM {{t}})", t=df)


def row_at_max(df: DataFrame, value: str, tie_break: Sequence[str]) -> DataFrame:
    """One row holding the maximum; ties resolved by ``tie_break`` columns
    (ascending), so the same row comes back on every run.  A top-1, not a
    sort of the table."""
    order = [q(value).desc()] + [q(c).asc() for c in tie_break]
    return df.where(q(value).isNotNull()).orderBy(*order).limit(1)


def value_range_top(df: DataFrame, group: str, value: str, n: int = 10,
                    out: str = "value_range") -> DataFrame:
    """Groups with the largest ``max - min`` of ``value``; ties broken by the
    group key so the result is deterministic.  Plans as partial/final hash
    aggregation and a ``TakeOrderedAndProject`` (a top-k, never a full sort)."""
    agg = (df.where(q(value).isNotNull())
             .groupBy(q(group))
             .agg((F.max(q(value)) - F.min(q(value))).alias(out)))
    return agg.orderBy(F.col(out).desc(), q(group).asc()).limit(n)


def value_range_top_sql(spark: SparkSession, df: DataFrame, group: str, value: str,
                        n: int = 10, out: str = "value_range") -> DataFrame:
    """The same question in SQL; the frame is bound as a parameter, so no
    session-global view name is registered."""
    text = (f"SELECT `{group}`, MAX(`{value}`) - MIN(`{value}`) AS `{out}` "
            f"FROM {{t}} WHERE `{value}` IS NOT NULL GROUP BY `{group}` "
            f"ORDER BY `{out}` DESC, `{group}` ASC LIMIT {int(n)}")
    return spark.sql(text, t=df)


def yearly_average(df: DataFrame, date_col: str, group: str, value: str,
                   start: int, end: int, out: str = "avg_value") -> DataFrame:
    """Mean of ``value`` per group and calendar year within ``[start, end]``.

    The range of years is also written on the date column itself, where the
    scan can use it.
    """
    year = F.year(q(date_col)).alias("year")
    inside = (q(date_col) >= F.make_date(F.lit(start), F.lit(1), F.lit(1))) & (
        q(date_col) < F.make_date(F.lit(end + 1), F.lit(1), F.lit(1)))
    base = (df.where(q(value).isNotNull() & inside)
              .select(q(group), year, q(value))
              .where(F.col("year").between(start, end)))
    return base.groupBy(q(group), "year").agg(F.avg(q(value)).alias(out))


def yearly_average_sql(spark: SparkSession, df: DataFrame, date_col: str, group: str, value: str,
                       start: int, end: int, out: str = "avg_value") -> DataFrame:
    """``yearly_average`` in SQL, with the year taken in a derived table.  The
    range of years is also a range of dates there, which reaches the scan."""
    start, end = int(start), int(end)
    text = (f"SELECT `{group}`, year, AVG(`{value}`) AS `{out}` FROM ("
            f"SELECT `{group}`, year(`{date_col}`) AS year, `{value}` FROM {{t}} "
            f"WHERE `{value}` IS NOT NULL AND `{date_col}` >= make_date({start}, 1, 1) "
            f"AND `{date_col}` < make_date({end + 1}, 1, 1)) AS tmp WHERE year BETWEEN {start} AND {end} "
            f"GROUP BY `{group}`, year ORDER BY `{group}`, year")
    return spark.sql(text, t=df)


def wide_years_to_long(df: DataFrame, id_col: str, year_cols: Sequence[str],
                       value_name: str) -> DataFrame:
    """Wide year columns to ``(id, year int, value)``, null cells dropped."""
    long = melt(df, [id_col], year_cols, "year", value_name)
    return (long.select(q(id_col), F.col("year").cast("int").alias("year"), q(value_name))
                .dropna())


def join_yearly(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("country", "year"),
                start: int | None = None, end: int | None = None) -> DataFrame:
    """Inner equi-join of two yearly series on shared key names."""
    joined = left.join(right, list(keys), "inner")
    if start is not None and end is not None:
        joined = joined.where(F.col("year").between(start, end))
    return joined


def corr_by_group(df: DataFrame, group: str, x: str, y: str, out: str = "correlation") -> DataFrame:
    """Pearson correlation per group.

    Rows with a null in ``x`` or ``y`` are dropped first.  A group with no
    spread in either variable (or a single row) gives null instead of a
    division-by-zero error.
    """
    clean = df.where(q(x).isNotNull() & q(y).isNotNull())
    vx, vy = F.var_pop(q(x)), F.var_pop(q(y))
    r = F.when((vx > 0) & (vy > 0), safe_div(F.covar_pop(q(x), q(y)), F.sqrt(vx * vy)))
    return clean.groupBy(q(group)).agg(r.alias(out))


def mean_of(df: DataFrame, col: str, out: str) -> DataFrame:
    """Unweighted mean of a column, nulls skipped; one row."""
    return df.agg(F.avg(q(col)).alias(out))
