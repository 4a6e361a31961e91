"""Wide <-> long reshaping, pivoted counts, shares of a total, prefixes."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q, row_sum, safe_div


def melt(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str],
         var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide to long: one row per (id, value column).  Plans as a single
    ``Expand`` in the same stage as the scan (no shuffle)."""
    return df.unpivot([q(c) for c in id_vars], [q(c) for c in value_vars], var_name, value_name)


def pivot_counts(df: DataFrame, keys: Sequence[str], pivot_col: str,
                 categories: Sequence[str]) -> DataFrame:
    """Rows per key and category, one column per category (null when none).

    The category list is explicit: no job runs to discover it, the schema does
    not depend on the data, and labels outside the list are ignored.
    """
    return (df.groupBy(*[q(k) for k in keys])
              .pivot(pivot_col, list(categories))
              .agg(F.count(F.lit(1))))


def running_sums(df: DataFrame, partition: Sequence[str], order: str,
                 cols: Sequence[str]) -> DataFrame:
    """Running totals from the first row of each partition, nulls as 0."""
    from pyspark.sql import Window
    w = (Window.partitionBy(*[q(p) for p in partition]).orderBy(q(order))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    others = [q(c) for c in df.columns if c not in cols]
    summed = df.select(*others, *[F.sum(q(c)).over(w).alias(c) for c in cols])
    return summed.fillna(0, subset=list(cols))


def shares(df: DataFrame, cols: Sequence[str], prefix: str = "") -> DataFrame:
    """Each column divided by the row total of ``cols`` (null for a zero total)."""
    total = row_sum(cols)
    others = [q(c) for c in df.columns if c not in cols]
    return df.select(*others, *[safe_div(q(c), total).alias(prefix + c) for c in cols])


def prefix_columns(df: DataFrame, prefix: str, exclude: Iterable[str] = ()) -> DataFrame:
    exclude = set(exclude)
    return df.select(*[q(c) if c in exclude else q(c).alias(prefix + c) for c in df.columns])


def wide_to_pairs(df: DataFrame, label_name: str = "label", token_name: str = "token") -> DataFrame:
    """Every column of a wide table to ``(label, token)`` rows, nulls dropped.

    Column names are stripped of surrounding blanks (labels arrive padded).
    Columns are told apart by their place, so two that share a name once it is
    stripped both give their rows.
    """
    labels = [c.strip() for c in df.columns]
    if not labels:
        return df.select(F.lit("").alias(label_name), F.lit("").alias(token_name)).where(F.lit(False))
    placed = df.toDF(*[f"c{i}" for i in range(len(labels))])
    long = (placed.select(*[F.col(c).cast("string") for c in placed.columns])
                  .unpivot([], placed.columns, "place", token_name))
    name = F.array(*[F.lit(x) for x in labels])[F.substring("place", 2, 10).cast("int")]
    return long.select(name.alias(label_name), q(token_name)).dropna(subset=[token_name])
