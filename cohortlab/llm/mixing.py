"""Mixing sources to target weights by entropy balancing (SQL functions only).

Rates ``exp(lambda[source] + theta . features)`` meet every source's word
target; the dual is convex, and Newton steps on it are sums over documents.
The rates are then rounded into whole copies.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import WORD, range_ranked, text_of
from cohortlab.plans.guards import materialize

MOST_REPAIRS = 12                # a source whose words lie in a few documents needs several
GOLDEN = 0.6180339887498949      # step of the low-discrepancy sequence


def targets(sources: DataFrame, budget: float, cap: float) -> DataFrame:
    """Adds ``target``: ``weight``'s share of ``budget`` times all sizes,
    stopped at ``cap`` times the source's size, the excess shared again among
    the others by weight until none is above."""
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, most = None, F.col("source_size") * F.lit(float(cap))
    while True:
        full = F.lit(False) if level is None else most <= F.lit(level) * F.col("weight")
        left = sources.agg(F.sum(F.when(full, most)).alias("used"),
                           F.sum(F.when(~full, F.col("weight"))).alias("weights")).first()
        if not left["weights"]:
            return sources.withColumn("target", F.least(most, F.lit(budget * total)))
        now = (budget * total - (left["used"] or 0.0)) / left["weights"]
        if level is not None and now <= level * (1 + 1e-12):
            return sources.withColumn("target", F.least(most, F.lit(level) * F.col("weight")))
        level = now


def newton(cells: DataFrame, sources: DataFrame, features: dict[str, float] | None = None,
           tolerance: float = 1e-10, max_steps: int = 60) -> tuple[DataFrame, list[float]]:
    """Solve the dual.  ``cells``: words by source and feature values;
    ``sources``: ``source, target``.  Returns ``source, target, lam`` and theta.

    Each step is one aggregation of the cells by source.  Sources meet only in
    the features' block, so the step eliminates them (Schur complement): the
    driver solves a system as large as the number of features, and the
    sources' table stays distributed however many there are.
    """
    features = features or {}
    names = list(features)
    theta = [0.0] * len(names)
    state = materialize(sources.select("source", "target", F.lit(0.0).alias("lam")), "mix-dual")
    goal = state.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    pairs = list(itertools.combinations_with_replacement(range(len(names)), 2))
    for _ in range(max_steps):
        tilt = F.col("lam")
        for t, c in zip(theta, names):
            tilt = tilt + F.lit(t) * F.col(c)
        w = F.col("words") * F.exp(tilt)
        sums = (cells.join(state, cells["cell_source"].eqNullSafe(state["source"]))
                .groupBy("source", "target", "lam")
                .agg(F.sum(w).alias("a"), *[F.sum(w * F.col(c)).alias(f"b{i}") for i, c in enumerate(names)],
                     *[F.sum(w * F.col(names[i]) * F.col(names[j])).alias(f"c{i}_{j}") for i, j in pairs]))
        delta = [0.0] * len(names)
        if names:
            import numpy as np
            parts = sums.agg(
                *[F.sum(F.col(f"c{i}_{j}") - F.col(f"b{i}") * F.col(f"b{j}") / F.col("a")).alias(f"s{i}_{j}") for i, j in pairs],
                *[F.sum(F.col(f"b{i}") * F.col("target") / F.col("a")).alias(f"r{i}") for i in range(len(names))]).first()
            s = np.zeros((len(names),) * 2)
            for i, j in pairs:
                s[i, j] = s[j, i] = parts[f"s{i}_{j}"] or 0.0
            rhs = np.array([features[c] * goal - (parts[f"r{i}"] or 0.0) for i, c in enumerate(names)])
            delta = list(np.linalg.lstsq(s, rhs, rcond=1e-12)[0])
        step = F.col("target") / F.col("a") - F.lit(1.0)
        for i, d in enumerate(delta):
            step = step - F.lit(float(d)) * F.col(f"b{i}") / F.col("a")
        # A long way up is cut: beyond one unit the quadratic model overshoots.
        moved = materialize(sums.select("source", "target", F.least(F.lit(1.0), step).alias("step"), "lam"), "mix-dual")
        state = moved.select("source", "target", (F.col("lam") + F.col("step")).alias("lam"))
        theta = [t + d for t, d in zip(theta, delta)]
        worst = moved.agg(F.max(F.abs("step")).alias("m")).first()["m"] or 0.0
        if max([worst, *map(abs, delta)]) < tolerance:
            break
    return state, theta


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), budget: float = 1.5, cap: int = 2,
        features: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """One row per document: ``doc_id, k, source, size, source_size, target, rate, copies, taken``.

    ``size`` is the number of words (null text: 0).  Sources in code-point
    order (null last) weigh ``weights`` in turn and share ``budget`` times all
    words; see :func:`targets`.  ``features`` maps numeric columns to the
    word-weighted means that the mix should have.  No document is taken more
    than ``cap`` times; ``taken = copies * size``.

    Repeated rows (same id, text and source) get the same copies; an empty
    table gives no rows; a source without words has target 0 and takes none.
    Ranks follow a total order, so reruns agree whatever the partitioning.
    """
    names = list(features or {})
    words = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("k"),
        F.col(source_col).alias("source"), F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(names)])
    fs = [f"_f{i}" for i in range(len(names))]
    items = materialize(words.groupBy("doc_id", "k", "source", "size", *fs).agg(F.count("*").alias("rows")), "mix-items")
    all_words = F.sum(F.col("size") * F.col("rows"))
    ranked = range_ranked(items.groupBy("source").agg(all_words.alias("source_size")),
                          [F.col("source").asc_nulls_last()], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int"))
    sources = materialize(targets(materialize(ranked.withColumn("weight", weight), "mix-weights"), budget, cap)
                          .select("source", "source_size", "target"), "mix-targets")
    cells = materialize(items.where("size > 0").groupBy(F.col("source").alias("cell_source"), *fs)
                        .agg(all_words.cast("double").alias("words")), "mix-cells")
    dual, theta = newton(cells, sources.where("target > 0"),
                         dict(zip(fs, (features or {}).values())))
    tilt = F.col("lam")
    for t, c in zip(theta, fs):
        tilt = tilt + F.lit(t) * F.col(c)
    # Rounding: along each source's documents in order of size, a low-discrepancy
    # sequence decides who gets the extra copy, so errors cancel between neighbours.
    placed = range_ranked(items, [F.col("source").asc_nulls_last(), F.col("size").desc(),
                                  F.col("doc_id").asc_nulls_last(), F.col("k")], "mix-ranks")
    known = sources.join(dual.select(F.col("source").alias("s2"), "lam"),
                         F.col("source").eqNullSafe(F.col("s2")), "left").drop("s2")
    known = materialize(known.withColumnRenamed("source", "s1"), "mix-rates")
    rated = (placed.join(known, F.col("source").eqNullSafe(F.col("s1"))).drop("s1")
             .withColumn("rate", F.when(F.col("size") == 0, 0.0)
                         .otherwise(F.least(F.lit(float(cap)), F.coalesce(F.exp(tilt), F.lit(0.0))))))
    # rate 2 - 1e-12 is 2: the tolerance of the solver must not cost a copy
    base = F.floor(F.col("rate") + 1e-9)
    u = F.col("rank") * F.lit(GOLDEN)
    copies = base + (u - F.floor(u) < F.col("rate") - base).cast("int")
    rounded = materialize(rated.withColumn("copies", copies.cast("int")), "mix-rounded")
    for _ in range(MOST_REPAIRS):
        fixed = materialize(_repair(rounded, known, cap), "mix-repair")
        if fixed.isEmpty():
            break
        rounded = materialize(rounded.join(fixed, "rank", "left").withColumn(
            "copies", F.col("copies") + F.coalesce(F.col("change"), F.lit(0))).drop("change"), "mix-rounded")
    return (rounded.withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
            .withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("doc_id", "k", "source", "size", "source_size", "target", "rate", "copies", "taken"))


def _repair(rounded: DataFrame, known: DataFrame, cap: int) -> DataFrame:
    """``rank, change``: single copies more or fewer that close what rounding
    left open in each source.  Candidates are one document per source and
    quarter power of two of its words, tried from the largest down."""
    words = F.col("size") * F.col("rows")
    step = F.floor(F.log2(words.cast("double")) * 4)
    entry = F.struct(words.alias("words"), (-F.col("rank")).alias("r"))
    ladder = (rounded.where("size > 0").groupBy("source", step.alias("step"))
              .agg(F.max(F.when(F.col("copies") < cap, entry)).alias("more"),
                   F.max(F.when(F.col("copies") > 0, entry)).alias("less"),
                   F.sum(F.col("copies") * words).alias("got")))
    per = ladder.groupBy("source").agg(
        F.sum("got").alias("got"),
        F.sort_array(F.collect_list("more"), asc=False).alias("more"),     # at most 4 x 63 entries
        F.sort_array(F.collect_list("less"), asc=False).alias("less"))
    gap = F.col("target") - F.col("got")
    per = (per.join(known.select("s1", "target"), F.col("source").eqNullSafe(F.col("s1")))
           .withColumn("sign", F.when(gap > 0, 1).otherwise(-1)).withColumn("open", F.abs(gap))
           .withColumn("tries", F.when(gap > 0, F.col("more")).otherwise(F.col("less"))))
    chosen = F.expr("""aggregate(tries, named_struct('open', open, 'picked', cast(array() as array<bigint>)),
        (s, x) -> if(x.words <= s.open, named_struct('open', s.open - x.words, 'picked', array_append(s.picked, -x.r)), s),
        s -> s.picked)""")
    return per.select(F.explode(chosen).alias("rank"), F.col("sign").alias("change"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", **settings) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, columns as they were."""
    plan = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    plan = (plan.where("copies > 0").select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"),
                                            F.col("source").alias("_s"), "copies").distinct())
    row = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("k"),
                      F.col(source_col).alias("source"), F.struct("*").alias("row"))
    return (row.join(plan, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("k") == F.col("_k"))
                     & F.col("source").eqNullSafe(F.col("_s")))
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*"))
