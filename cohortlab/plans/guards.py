"""Physical-plan guards: size-checked broadcast, salting for hot keys, and
plan inspection used by the tests."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it has at most this many rows and bytes (as
# JSON text).  The check takes rows until the bound is passed; it is never a
# full count, and nothing is gathered in one task.
DEFAULT_BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def is_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    sizes = df.select(F.length(F.to_json(F.struct("*")))).take(max_rows + 1)
    return len(sizes) <= max_rows and sum(n or 0 for (n,) in sizes) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when its row count is proven small, else ``df`` as is
    (the planner then shuffles both sides; AQE may still broadcast at run time
    from measured sizes)."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


# A key with more rows than this on the large side of a lookup join is split
# into tasks of about so many rows; the list of such keys has at most
# ``MAX_HOT_KEYS`` entries.
HOT_KEY_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000


def hot_keys(per_key: DataFrame, key: str, count_col: str, hot_rows: int = HOT_KEY_ROWS,
             max_keys: int = MAX_HOT_KEYS) -> DataFrame:
    """``_hot, _parts``: the keys above ``hot_rows`` rows and into how many
    parts each is split, ``ceil(rows / hot_rows)``.  Where the list would be
    longer than ``max_keys``, the threshold is raised tenfold until it is not
    (there are at most ``rows / hot_rows`` such keys)."""
    while True:
        hot = per_key.where(F.col(count_col) > F.lit(hot_rows)).select(
            F.col(key).alias("_hot"), F.ceil(F.col(count_col) / F.lit(hot_rows)).cast("int").alias("_parts"))
        if is_bounded(hot, max_keys):
            return hot
        hot_rows *= 10


def salted_lookup_join(big: DataFrame, per_key: DataFrame, big_key: str, key: str,
                       how: str = "inner", buckets: int = 16,
                       salt_from: list[str] | None = None, count_col: str | None = None,
                       hot_rows: int = HOT_KEY_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Join a large table to a table with one row per key, splitting hot keys.

    A hot key's rows on the large side get a salt from a hash of the
    ``salt_from`` columns, and its ``per_key`` row is repeated once per salt.

    With ``count_col`` (the number of ``big`` rows per key, or an upper bound,
    carried by ``per_key``) only the keys of :func:`hot_keys` are split, each
    into as many parts as its rows ask for; their list is broadcast, every
    other key joins unsalted and nothing is replicated for it.  Without it
    every key is salted and ``per_key`` grows by ``buckets``.  A list of hot
    keys counted elsewhere may be given as ``hot``; ``per_key`` may then hold
    several rows per key.

    Rows without a key match nothing and are spread by the hash alone.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in (salt_from or big.columns)])
    if count_col is not None or hot is not None:
        hot = F.broadcast(hot_keys(per_key, key, count_col, hot_rows) if hot is None else hot)
        marked = big.join(hot, big[big_key] == F.col("_hot"), "left")
        salt = F.pmod(row_hash, F.coalesce("_parts", F.lit(1)))
        small = per_key.join(hot, per_key[key] == F.col("_hot"), "left").withColumn(
            "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_parts", F.lit(1)).cast("bigint") - 1)))
        salted_small = small.drop("_hot", "_parts")
    elif buckets <= 1:
        return big.join(per_key, big[big_key] == per_key[key], how)
    else:
        marked, salt = big, F.pmod(row_hash, F.lit(buckets))
        salted_small = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(buckets - 1).cast("bigint"))))
    salted_big = marked.withColumn("_salt", F.when(marked[big_key].isNull(), row_hash).otherwise(salt)).drop("_hot", "_parts")
    cond = [salted_big[big_key] == salted_small[key], salted_big["_salt"] == salted_small["_salt"]]
    joined = salted_big.join(salted_small, cond, how)
    return joined.drop(salted_big["_salt"]).drop(salted_small["_salt"])


def spread_if_narrow(df: DataFrame) -> DataFrame:
    """Round-robin ``df`` over the cluster's cores when its scan yields fewer
    partitions than that (one large row group, say), before CPU-heavy row
    work.  On cluster-sized inputs the scan already has more partitions and
    this is a no-op.  Round-robin, not by key, so no hot key can concentrate."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def materialize(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder
    and read it back.

    For an intermediate with several consumers: it is computed once, the
    consumers read columnar files (with column pruning), and the lineage is
    cut, so a lost executor costs a file re-read, not a recomputation.  The
    folder stays until :func:`discard`, or to the end of the
    :func:`cohortlab.session.scratch` block that it was written in.  ``codec``
    is Parquet's compression, where texts are worth another than the session's.
    """
    from ..session import shared_dir
    path = shared_dir(df.sparkSession, purpose)
    df.write.mode("errorifexists").parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_folder = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what :func:`materialize` wrote for ``df``, once nothing will read
    it again (a step that the next one replaces, say)."""
    from ..session import delete_folder
    delete_folder(df.sparkSession, df.written_folder)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text: ``explain`` output captured from stdout."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
