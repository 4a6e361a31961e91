"""Contract views: how the library's inputs are derived from the given tables.

Each view exists twice: as a Spark DataFrame function (used by the queries)
and as a SQL common-table expression (used by the DuckDB oracle).  The two
must describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.guards import broadcast_if_bounded, spread_if_narrow
from .files import read_table

# Fixed values of the contract.
TX_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
READING_YEARS = (1995, 2001)
EMISSION_YEARS = list(range(1995, 2002))
IV_TREATED_SEGMENTS = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
PURCHASE_THRESHOLD = 450000.0


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def nation(spark, sf_dir) -> DataFrame:
    """25 rows by definition; broadcast after a bounded check all the same."""
    return broadcast_if_bounded(_t(spark, sf_dir, "nation").select("n_nationkey", "n_name"), 1000)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long time series ``dt, country, value`` (one reading per order)."""
    o = spread_if_narrow(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice"))
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
             .select(F.to_date("o_orderdate").alias("dt"),
                     F.col("n_name").alias("country"),
                     F.col("o_totalprice").alias("value")))


def emissions_wide(spark: SparkSession, sf_dir: str, years=EMISSION_YEARS) -> DataFrame:
    """Wide series: one column per year (``"1995"`` ..), key ``country``."""
    li = spread_if_narrow(_t(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_extendedprice"))
    s = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Summed per supplier first: raw rows of a hot supplier never meet in a join.
    sums = (li.withColumn("year", F.year("l_shipdate")).where(F.col("year").isin(list(years)))
              .groupBy("l_suppkey", "year").agg(F.sum("l_extendedprice").alias("price")))
    joined = (sums.join(s, sums.l_suppkey == s.s_suppkey)
                  .join(nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")))
    # Explicit pivot values: one aggregation, no job to discover the years.
    wide = joined.groupBy(F.col("n_name").alias("country")).pivot("year", list(years)).agg(F.sum("price"))
    return wide.select("country", *[F.col(f"`{y}`").alias(str(y)) for y in years])


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled two-sided transactions ``user1, user2, transaction_time,
    selected_match_type``: customer pays supplier, category = part type."""
    li = spread_if_narrow(_t(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey"))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_type")
    # the orders last: the lines of an order end up beside each other, so what
    # counts a user's rows by day combines them before its shuffle
    return (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
              .join(o, F.col("l_orderkey") == o.o_orderkey)
              .select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("user1"),
                      F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("user2"),
                      F.col("o_orderdate").alias("transaction_time"),
                      F.col("p_type").alias("selected_match_type")))


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments with free text: one story per document."""
    d = _t(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("story_id"),
                    F.col("source").alias("user1"),
                    F.lit(None).cast("string").alias("user2"),
                    F.col("lang").alias("transaction_type"),
                    F.col("text").alias("description"),
                    F.lit(None).cast("timestamp").alias("datetime"))


def trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A/B table: ``test, income, gender, gamer, purchase`` per customer."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    top = (_t(spark, sf_dir, "orders").groupBy("o_custkey")
           .agg(F.max("o_totalprice").alias("max_price")))
    j = c.join(top, c.c_custkey == top.o_custkey, "left")
    return j.select(
        "c_custkey",
        (F.col("c_custkey") % 2).alias("test"),
        F.col("c_acctbal").alias("income"),
        (F.col("c_nationkey") % 2).alias("gender"),
        (F.col("c_mktsegment") == "BUILDING").cast("int").alias("gamer"),
        F.coalesce((F.col("max_price") > F.lit(PURCHASE_THRESHOLD)).cast("int"), F.lit(0)).alias("purchase"),
        "c_mktsegment")


def iv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encouragement table: ``instrument, treatment, outcome``."""
    t = trial(spark, sf_dir)
    treated = ((F.col("test") == 1) & F.col("c_mktsegment").isin(IV_TREATED_SEGMENTS)).cast("int")
    return t.select("c_custkey",
                    F.col("test").cast("int").alias("instrument"),
                    treated.alias("treatment"),
                    F.col("purchase").alias("outcome"))


# ---------------------------------------------------------------- SQL twins
def _in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


SQL_VIEWS = {
    "readings": """readings AS (
        SELECT CAST(o.o_orderdate AS DATE) AS dt, n.n_name AS country, o.o_totalprice AS value
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "emissions_long": """emissions_long AS (
        SELECT n.n_name AS country, CAST(year(l.l_shipdate) AS INTEGER) AS year,
               SUM(l.l_extendedprice) AS emissions
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey
        WHERE year(l.l_shipdate) BETWEEN %d AND %d
        GROUP BY 1, 2)""" % (EMISSION_YEARS[0], EMISSION_YEARS[-1]),
    "tx": """tx AS (
        SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS user1, 'S' || CAST(l.l_suppkey AS VARCHAR) AS user2,
               o.o_orderdate AS transaction_time, p.p_type AS selected_match_type
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey)""",
    "stories": """stories AS (
        SELECT doc_id AS story_id, source AS user1, CAST(NULL AS VARCHAR) AS user2,
               lang AS transaction_type, text AS description, CAST(NULL AS TIMESTAMP) AS datetime
        FROM documents)""",
    "trial": """trial AS (
        SELECT c.c_custkey, c.c_custkey %% 2 AS test, c.c_acctbal AS income,
               c.c_nationkey %% 2 AS gender, CAST(c.c_mktsegment = 'BUILDING' AS INTEGER) AS gamer,
               COALESCE(CAST(m.max_price > %s AS INTEGER), 0) AS purchase, c.c_mktsegment
        FROM customer c LEFT JOIN (SELECT o_custkey, MAX(o_totalprice) AS max_price
                                   FROM orders GROUP BY o_custkey) m
          ON c.c_custkey = m.o_custkey)""" % PURCHASE_THRESHOLD,
    "iv": """iv AS (
        SELECT c_custkey, CAST(test AS INTEGER) AS instrument,
               CAST(test = 1 AND c_mktsegment IN (%s) AS INTEGER) AS treatment,
               purchase AS outcome
        FROM trial)""" % _in_list(IV_TREATED_SEGMENTS),
}

# Views that other views need first.
SQL_DEPENDS = {"iv": ["trial"]}


def sql_with(*names: str) -> str:
    """``WITH`` clause defining the named contract views (and their inputs)."""
    ordered: list[str] = []

    def add(n):
        for d in SQL_DEPENDS.get(n, []):
            add(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(SQL_VIEWS[n] for n in ordered) + "\n"
