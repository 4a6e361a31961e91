import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from cohortlab.operators import series, reshape
from cohortlab.plans.guards import plan_text


def _readings(spark):
    d = dt.date
    data = [
        (d(1990, 1, 1), "A", 5.0), (d(1990, 2, 1), "A", 9.0), (d(1991, 1, 1), "A", None),
        (d(1990, 1, 1), "B", 9.0), (d(1992, 1, 1), "B", 1.0),
        (d(1990, 1, 1), "C", 9.0),                                  # single reading, three-way tie
        (d(1950, 1, 1), "D", 3.0), (d(2030, 1, 1), "D", 4.0),       # years outside the range
    ]
    return spark.createDataFrame(data, "dt date, country string, value double")


def test_rows_at_max_keeps_ties(spark):
    out = series.rows_at_max(_readings(spark), "value").collect()
    assert sorted(r.country for r in out) == ["A", "B", "C"]


def test_range_top_df_equals_sql_and_skips_nulls(spark):
    df = _readings(spark)
    a = [tuple(r) for r in series.value_range_top(df, "country", "value", 10).collect()]
    b = [tuple(r) for r in series.value_range_top_sql(spark, df, "country", "value", 10).collect()]
    assert a == b
    assert a[0] == ("B", 8.0) and ("C", 0.0) in a
    assert "TakeOrderedAndProject" in plan_text(series.value_range_top(df, "country", "value", 2))


def test_yearly_average_range_and_nulls(spark):
    out = series.yearly_average(_readings(spark), "dt", "country", "value", 1960, 2014).collect()
    got = {(r.country, r.year): r.avg_value for r in out}
    assert got == {("A", 1990): 7.0, ("B", 1990): 9.0, ("B", 1992): 1.0, ("C", 1990): 9.0}


def test_wide_years_to_long_drops_null_cells(spark):
    wide = spark.createDataFrame([("A", 1.0, None), ("B", 2.0, 3.0)], "country string, `1960` double, `1961` double")
    out = sorted(tuple(r) for r in series.wide_years_to_long(wide, "country", ["1960", "1961"], "v").collect())
    assert out == [("A", 1960, 1.0), ("B", 1960, 2.0), ("B", 1961, 3.0)]
    plan = plan_text(reshape.melt(wide, ["country"], ["1960", "1961"]))
    assert "Expand" in plan and "Exchange" not in plan


def test_corr_guarded(spark):
    x = np.arange(6.0)
    y = np.array([1.0, 3.0, 2.0, 5.0, 4.0, 6.0])
    data = [("ok", float(a), float(b)) for a, b in zip(x, y)]
    data += [("flat", 1.0, 2.0), ("flat", 2.0, 2.0), ("one", 1.0, 1.0), ("nul", None, 1.0), ("nul", 2.0, 3.0)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    got = {r.g: r.correlation for r in series.corr_by_group(df, "g", "x", "y").collect()}
    assert math.isclose(got["ok"], float(np.corrcoef(x, y)[0, 1]), rel_tol=1e-12)
    assert got["flat"] is None and got["one"] is None and got["nul"] is None
    mean = series.mean_of(series.corr_by_group(df, "g", "x", "y"), "correlation", "m").first().m
    assert math.isclose(mean, got["ok"])


def test_pivot_counts_absent_and_unknown(spark):
    df = spark.createDataFrame([("u", "a"), ("u", "a"), ("u", "zz"), ("v", "b")], "k string, c string")
    out = {r.k: (r.a, r.b) for r in reshape.pivot_counts(df, ["k"], "c", ["a", "b"]).collect()}
    assert out == {"u": (2, None), "v": (None, 1)}


def test_sql_twins(spark):
    df = _readings(spark)
    a = sorted(tuple(r) for r in series.rows_at_max(df, "value").collect())
    b = sorted(tuple(r) for r in series.rows_at_max_sql(spark, df, "value").collect())
    assert a == b and len(a) == 3
    y1 = sorted(tuple(r) for r in series.yearly_average(df, "dt", "country", "value", 1960, 2014).collect())
    y2 = sorted(tuple(r) for r in series.yearly_average_sql(spark, df, "dt", "country", "value", 1960, 2014).collect())
    assert y1 == y2
    first = series.row_at_max(df, "value", ["dt", "country"]).collect()
    assert [(r.country, r.value) for r in first] == [("B", 9.0)]   # earliest date, then country


def test_years_reach_the_scan_as_dates(spark, tmp_path):
    from cohortlab.operators import series as S
    from cohortlab.plans.guards import plan_text
    spark.sql("select date'1995-03-01' as dt, 'a' as country, 1.0D as value union all select date'2003-01-01', 'a', 2.0D").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    for df in (S.yearly_average(t, "dt", "country", "value", 1995, 2001),
               S.yearly_average_sql(spark, t, "dt", "country", "value", 1995, 2001)):
        pushed = next(line for line in plan_text(df).splitlines() if "PushedFilters" in line)
        assert "GreaterThanOrEqual(dt,1995-01-01)" in pushed and "LessThan(dt,2002-01-01)" in pushed
        assert [tuple(r) for r in df.collect()] == [("a", 1995, 1.0)]


def test_wide_columns_with_one_stripped_name(spark):
    from cohortlab.operators.reshape import wide_to_pairs
    wide = spark.createDataFrame([("pizza", "taco", None), ("rice", None, 7)], "`Food` string, `Food ` string, ` Cash` int")
    got = sorted(tuple(r) for r in wide_to_pairs(wide).collect())
    assert got == [("Cash", "7"), ("Food", "pizza"), ("Food", "rice"), ("Food", "taco")]
    twice = wide.toDF("Food", "Food", "Cash")
    assert sorted(tuple(r) for r in wide_to_pairs(twice).collect()) == got
