"""Registered queries over the climate-style series (readings, emissions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round_doubles
from ..operators import series
from ..session import shared_dir
from ..sources import files, views

YEARS = (1996, 2000)


def _yearly(spark, sf_dir):
    return series.yearly_average(views.readings(spark, sf_dir), "dt", "country", "value", *YEARS)


def _emissions_long(spark, sf_dir):
    wide = views.emissions_wide(spark, sf_dir)
    return series.wide_years_to_long(wide, "country", [str(y) for y in views.EMISSION_YEARS], "emissions")


def _yearly_join(spark, sf_dir):
    return series.join_yearly(_yearly(spark, sf_dir), _emissions_long(spark, sf_dir),
                              ("country", "year"), *YEARS)


def q_rows_at_max(spark, sf_dir):
    return round_doubles(series.rows_at_max(views.readings(spark, sf_dir), "value"))


def q_rows_at_max_sql(spark, sf_dir):
    return round_doubles(series.rows_at_max_sql(spark, views.readings(spark, sf_dir), "value"))


def q_row_at_max_first(spark, sf_dir):
    return round_doubles(series.row_at_max(views.readings(spark, sf_dir), "value", ["dt", "country"]))


def q_yearly_average_sql(spark, sf_dir):
    return round_doubles(series.yearly_average_sql(spark, views.readings(spark, sf_dir), "dt", "country",
                                                   "value", *YEARS))


def q_range_top10(spark, sf_dir):
    return round_doubles(series.value_range_top(views.readings(spark, sf_dir), "country", "value", 10))


def q_range_top10_sql(spark, sf_dir):
    return round_doubles(series.value_range_top_sql(spark, views.readings(spark, sf_dir), "country", "value", 10))


def q_yearly_average(spark, sf_dir):
    return round_doubles(_yearly(spark, sf_dir).orderBy("country", "year"))


def q_melt_years(spark, sf_dir):
    # money sums: two places absorb summation-order noise between engines
    return round_doubles(_emissions_long(spark, sf_dir), 2)


def q_yearly_join(spark, sf_dir):
    j = _yearly_join(spark, sf_dir)
    return j.select("country", "year", F.round("avg_value", 6).alias("avg_value"),
                    F.round("emissions", 2).alias("emissions"))


def q_corr_by_group(spark, sf_dir):
    return round_doubles(series.corr_by_group(_yearly_join(spark, sf_dir), "country", "avg_value", "emissions"))


def q_mean_corr(spark, sf_dir):
    corr = series.corr_by_group(_yearly_join(spark, sf_dir), "country", "avg_value", "emissions")
    return round_doubles(series.mean_of(corr, "correlation", "mean_correlation"))


def q_csv_inferred_scan(spark, sf_dir):
    """Orders written as CSV to the shared folder, scanned back with a header
    and inferred types, which are those of the values: keys that fit are ints."""
    src = files.read_table(spark, sf_dir, "orders")
    path = files.write_csv(src, shared_dir(spark, "csv-orders"))
    return files.read_csv(spark, path)


def q_parquet_gzip_roundtrip(spark, sf_dir):
    path = files.write_parquet_gzip(views.readings(spark, sf_dir), shared_dir(spark, "readings-gzip"))
    return round_doubles(files.read_parquet(spark, path))


QUERIES = {
    "rows_at_max": q_rows_at_max,
    "rows_at_max_sql": q_rows_at_max_sql,
    "row_at_max_first": q_row_at_max_first,
    "yearly_average_sql": q_yearly_average_sql,
    "range_top10": q_range_top10,
    "range_top10_sql": q_range_top10_sql,
    "yearly_average": q_yearly_average,
    "melt_years": q_melt_years,
    "yearly_join": q_yearly_join,
    "corr_by_group": q_corr_by_group,
    "mean_corr": q_mean_corr,
    "csv_inferred_scan": q_csv_inferred_scan,
    "parquet_gzip_roundtrip": q_parquet_gzip_roundtrip,
}

_W = views.sql_with
_Y0, _Y1 = YEARS
_YEARLY = f"""yearly AS (
    SELECT country, CAST(year(dt) AS INTEGER) AS year, AVG(value) AS avg_value
    FROM readings WHERE value IS NOT NULL AND year(dt) BETWEEN {_Y0} AND {_Y1}
    GROUP BY 1, 2)"""
_JOINED = f"""joined AS (
    SELECT y.country, y.year, y.avg_value, e.emissions
    FROM yearly y JOIN emissions_long e ON y.country = e.country AND y.year = e.year
    WHERE y.year BETWEEN {_Y0} AND {_Y1})"""
_CORR = """corr_g AS (
    SELECT country,
           CASE WHEN var_pop(avg_value) > 0 AND var_pop(emissions) > 0
                THEN covar_pop(avg_value, emissions) / sqrt(var_pop(avg_value) * var_pop(emissions)) END AS correlation
    FROM joined WHERE avg_value IS NOT NULL AND emissions IS NOT NULL GROUP BY country)"""

ORACLE = {
    "rows_at_max": _W("readings") + """
        SELECT dt, country, round(value, 6) AS value FROM readings
        WHERE value = (SELECT MAX(value) FROM readings)""",
    "range_top10": _W("readings") + """
        SELECT country, round(MAX(value) - MIN(value), 6) AS value_range FROM readings
        WHERE value IS NOT NULL GROUP BY country ORDER BY MAX(value) - MIN(value) DESC, country LIMIT 10""",
    "yearly_average": _W("readings") + f"""
        SELECT country, CAST(year(dt) AS INTEGER) AS year, round(AVG(value), 6) AS avg_value
        FROM readings WHERE value IS NOT NULL AND year(dt) BETWEEN {_Y0} AND {_Y1}
        GROUP BY 1, 2 ORDER BY 1, 2""",
    "melt_years": _W("emissions_long") + """
        SELECT country, year, round(emissions, 2) AS emissions FROM emissions_long""",
    "yearly_join": _W("readings", "emissions_long") + f", {_YEARLY}, {_JOINED}" + """
        SELECT country, year, round(avg_value, 6) AS avg_value, round(emissions, 2) AS emissions FROM joined""",
    "corr_by_group": _W("readings", "emissions_long") + f", {_YEARLY}, {_JOINED}, {_CORR}" + """
        SELECT country, round(correlation, 6) AS correlation FROM corr_g""",
    "mean_corr": _W("readings", "emissions_long") + f", {_YEARLY}, {_JOINED}, {_CORR}" + """
        SELECT round(AVG(correlation), 6) AS mean_correlation FROM corr_g""",
    "csv_inferred_scan": """SELECT * REPLACE (CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey)
        FROM orders""",
    "parquet_gzip_roundtrip": _W("readings") + """
        SELECT dt, country, round(value, 6) AS value FROM readings""",
}
ORACLE["range_top10_sql"] = ORACLE["range_top10"]
ORACLE["rows_at_max_sql"] = ORACLE["rows_at_max"]
ORACLE["yearly_average_sql"] = ORACLE["yearly_average"]
ORACLE["row_at_max_first"] = _W("readings") + """
        SELECT dt, country, round(value, 6) AS value FROM readings WHERE value IS NOT NULL
        ORDER BY value DESC, dt, country LIMIT 1"""
