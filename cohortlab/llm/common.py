"""Helpers shared by the corpus operators: row keys, distributed ranks and
connected components.

A document row is known by ``(doc_id, hash of its text)``: ``doc_id`` may be
null or repeated, so joins back to the rows are null-safe on both parts.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.plans.guards import discard, materialize

# White space of every contract here: space, tab, \n, \v, \f, \r.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark) -> None:
    """Make this package importable in the Python workers, wherever the driver
    found it: Spark hands every executor a copy."""
    sc = spark.sparkContext
    if getattr(sc, "_cohortlab_shipped", False):
        return
    import cohortlab
    root = Path(cohortlab.__file__).parent
    # The driver serves the file itself, so the folder must outlast this call.
    folder = tempfile.TemporaryDirectory()
    file = Path(folder.name, "cohortlab_code.zip")
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(file))
    sc._cohortlab_shipped = folder


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, k, text``: the columns the operators work on, whatever else
    the caller's table holds; null text becomes empty."""
    text = text_of(text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("k"),
                       text.alias("text"))


def join_rows(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the row key ``(doc_id, k)``, null-safe; the key is kept once."""
    other = right.withColumnsRenamed({"doc_id": "_doc_id", "k": "_k"})
    on = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("k") == F.col("_k"))
    return left.join(other, on, how).drop("_doc_id", "_k")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_ranked(df: DataFrame, order: list, purpose: str) -> DataFrame:
    """``df`` range-sorted on ``order`` and written, with ``rank`` (from 0)
    over the whole table.

    Sampled splitters deal the rows out, each task sorts its range, and the
    ranges' sizes (one row per task) give the offsets; no task holds more
    than its range.  ``order`` must end in a column that spreads ties.
    """
    n = partitions(df)
    sorted_ = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    kept = materialize(sorted_.withColumn("_seq", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("_seq", 33)
    sizes = [(r["p"], r["n"]) for r in kept.groupBy(part.alias("p")).count()
             .withColumnRenamed("count", "n").collect()]        # one row per task
    offsets, at = [], 0
    for p, size in sorted(sizes):
        offsets.append((p, at))
        at += size
    if not offsets:
        return kept.withColumn("rank", F.lit(None).cast("long")).drop("_seq")
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets, "_p long, _at long")
    return (kept.withColumn("_p", part).join(F.broadcast(starts), "_p")
            .withColumn("rank", F.col("_at") + F.col("_seq") - F.shiftleft(F.col("_p"), 33))
            .drop("_p", "_at", "_seq"))


MOST_CLASHES = 1_000_000


def part_clashes(rows: DataFrame, purpose: str) -> tuple[DataFrame, frozenset]:
    """``rows`` with ``node, check`` (two halves of a 128-bit hash) so that a
    node stands for one hash, and the nodes that stood for several: those take
    the other half.  They are a few in 1e10 different hashes, and counted
    before they are taken to the driver."""
    twice = rows.groupBy("node").agg(F.min("check").alias("lo"), F.max("check").alias("hi")).where("lo <> hi").select("node")
    apart = frozenset(r["node"] for r in twice.take(MOST_CLASHES + 1))
    if not apart:
        return rows, apart
    if len(apart) > MOST_CLASHES:
        raise RuntimeError("more equal halves of hashes than a 64-bit hash can give")
    clash = rows.sparkSession.createDataFrame([(n,) for n in apart], "_clash long")
    parted = (rows.join(F.broadcast(clash), F.col("node") == F.col("_clash"), "left")
              .withColumn("node", F.when(F.col("_clash").isNull(), F.col("node")).otherwise(F.col("check"))).drop("_clash"))
    return materialize(parted, purpose), apart


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Distributed union-find: ``node, component`` (smallest node reachable)
    for every node of ``edges`` (``a, b`` long).

    Alternates the large-star and small-star steps (Kiveris et al., 2014):
    each is one aggregation and one join on the edge list, rounds grow with
    the logarithm of the longest chain, and every round is written to the
    shared folder, so a lost executor costs a re-read.
    """
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .distinct())
    e = materialize(e, "cc-edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        last, e = e, materialize(large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .where("u <> v")
                        .unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "cc-edges")
        discard(last)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
