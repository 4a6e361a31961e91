"""Exact duplicates by a content sort (SQL functions only).

Sampled splitters range-partition the normalised texts, each task sorts its
range externally, and every row is compared in full with its neighbour; runs
of equal neighbours are the groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import SPACE, partitions, text_of
from cohortlab.plans.guards import materialize

PREFIX = 24      # leading characters in the range key; the hash orders equal prefixes


def equal_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 carry: bool = False) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``
    (and the input row as struct ``row`` with ``carry``).

    Texts are equal when identical without white space; null counts as empty.
    Of a group the row with the most code points, then the smallest doc_id
    (nulls last), stays; of fully repeated rows exactly one stays.  An empty
    table gives no rows; other columns of ``docs`` play no part.

    Range key: ``(prefix, hash, salt)`` of the normalised text.  ``salt`` is 0
    but for groups larger than half a task's share of the rows, whose copies
    are cut into chunks of that size, so no group fills a task.  The chunks
    (at most two per task) meet in a second neighbour comparison.
    """
    norm = F.regexp_replace(text_of(text_col), SPACE + "+", "")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"),
                       F.length(text_of(text_col)).cast("long").alias("chars"),
                       *([F.struct("*").alias("row")] if carry else []))
    base = base.withColumn("h", F.xxhash64("norm"))
    n = partitions(docs)
    counts = base.groupBy("h").agg(F.count("*").alias("n"))
    # Documents in all, from the same pass: rows of the hash table hold their counts.
    counts = materialize(counts, "exact-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    chunk = max(1, total // (2 * n))
    hot = counts.where(F.col("n") > chunk).select(            # fewer than 2n rows
        F.col("h"), F.ceil(F.col("n") / chunk).cast("int").alias("salts"))
    spread = F.pmod(F.xxhash64("doc_id", "chars", F.monotonically_increasing_id()), F.col("salts")).cast("int")
    base = (base.join(F.broadcast(hot), "h", "left")
            .withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(spread)))
    key = [F.substring("norm", 1, PREFIX), F.col("h"), F.col("salt")]
    dealt = (base.withColumn("p", key[0]).repartitionByRange(n, "p", "h", "salt"))
    place = Window.partitionBy("p", "h", "salt")
    order = [F.col("norm"), F.col("chars").desc(), F.col("doc_id").asc_nulls_last()]
    run = place.orderBy(*order)
    dealt = (dealt.withColumn("new", F.coalesce((F.lag("norm").over(run) != F.col("norm")).cast("int"), F.lit(1)))
             .withColumn("run", F.sum("new").over(run.rowsBetween(Window.unboundedPreceding, 0))))
    mine = Window.partitionBy("p", "h", "salt", "run")
    first = mine.orderBy(*order)
    split = F.col("salts").isNotNull()
    runs = materialize(
        dealt.withColumn("at", F.row_number().over(first))
        .withColumn("run_size", F.count("*").over(mine))
        .select("doc_id", "chars", "h", "salt", "run", "at", "run_size", split.alias("split"),
                F.first("doc_id").over(first).alias("run_keep"),
                F.when(split & (F.col("at") == 1), F.col("norm")).alias("norm"),
                F.sha2("norm", 256).alias("text_sha256"), *(["row"] if carry else [])), "exact-runs")
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] + (["row"] if carry else [])
    whole = (runs.where(~F.col("split"))
             .select("*", F.col("run_keep").alias("keep_id"), F.col("run_size").alias("group_size"),
                     (F.col("at") == 1).alias("kept")).select(*out))
    # Chunks of a split group: neighbouring run heads are compared in full again.
    heads = runs.where(F.col("split") & (F.col("at") == 1))
    near = Window.partitionBy("h").orderBy("norm", *order[1:], "salt")
    heads = (heads.withColumn("new", F.coalesce((F.lag("norm").over(near) != F.col("norm")).cast("int"), F.lit(1)))
             .withColumn("grp", F.sum("new").over(near.rowsBetween(Window.unboundedPreceding, 0))))
    together = Window.partitionBy("h", "grp")
    best = together.orderBy(*order[1:], "salt")
    heads = heads.select("h", "salt", "run", F.first("doc_id").over(best).alias("keep_id"),
                         F.sum("run_size").over(together).alias("group_size"),
                         (F.row_number().over(best) == 1).alias("best"))
    cut = (runs.where("split").join(F.broadcast(heads), ["h", "salt", "run"])   # at most 4n heads
           .withColumn("kept", F.col("best") & (F.col("at") == 1)).select(*out))
    return whole.unionByName(cut)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns as they were."""
    return equal_groups(docs, id_col, text_col, carry=True).where("kept").select("row.*")
