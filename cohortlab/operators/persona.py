"""Spending personas from a two-sided transaction table.

A transaction ``(user1, user2, transaction_time, selected_match_type)`` is seen
from both ends (``both_sides``).  A user's *lifetime month* counts 30.44-day
months from the user's first transaction.  The *self persona* is the share of
each category among the user's own transactions in a month range; the
*community persona* averages, over the months of first contact, the category
shares of the friends' other transactions.

Two forms are provided:

* windowed operators that follow the step-by-step definition
  (``pivot_counts`` -> ``cumulative_counts`` -> ``category_shares`` ->
  ``latest_month_rows``; ``monthly_average`` -> ``running_average``);
* closed forms (``self_persona``, ``community_persona``) that reach the same
  numbers from pair-level aggregates.  The step-by-step definition joins every
  first-contact row with every other transaction of the friend, which grows
  with (pairs x friend degree); the closed form only ever holds one row per
  (user, friend) pair, and all of its aggregations combine map-side, so a hub
  user holding a third of the rows costs no single task more than its share.
  Lookups of per-user values into pair tables are salted for the same reason.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import DAYS_PER_MONTH
from ..functions.columns import lifetime_month as month_expr
from ..functions.columns import q, row_sum, safe_div
from ..plans.guards import HOT_KEY_ROWS, hot_keys, materialize, salted_lookup_join
from ..sources.files import write_through
from . import reshape

# The nine spending categories of the labelled payments.
CATEGORIES = ["Activity", "Cash", "Event", "Food", "Illegal/Sarcasm", "People",
              "Transportation", "Travel", "Utility"]

USER, FRIEND, TIME, CAT, MONTH = "user", "friend", "transaction_time", "selected_match_type", "lifetime_month"


# ---------------------------------------------------------------- edges
def both_sides(df: DataFrame, a: str = "user1", b: str = "user2", time: str = TIME,
               category: str = CAT) -> DataFrame:
    """Each transaction once from each end: ``user, friend, time, category``.

    One scan: every row emits its two orientations through ``inline`` (a
    ``Generate`` in the scan's stage), instead of a union that would compute
    the input twice.  A self-transaction gives two equal rows.
    """
    sides = F.array(F.struct(q(a).alias(USER), q(b).alias(FRIEND)),
                    F.struct(q(b).alias(USER), q(a).alias(FRIEND)))
    return df.select(F.inline(sides), q(time).alias(TIME), q(category).alias(CAT))


def first_activity(edges: DataFrame) -> DataFrame:
    """``user, first_time, _rows``: earliest transaction and row count per
    user (combined map-side, so a hot user is pre-reduced before the
    shuffle)."""
    return (edges.where(F.col(USER).isNotNull())
                 .groupBy(USER).agg(F.min(TIME).alias("first_time"), F.count(F.lit(1)).alias("_rows")))


def with_lifetime_month(edges: DataFrame) -> DataFrame:
    """Adds ``lifetime_month`` to every edge row.

    Same value as ``first(time) over (partition by user order by time)``, but
    as an aggregate joined back with a salted lookup: a window partitioned by
    user would put all rows of a hot user into one task.
    """
    edges = materialize(edges, "edges")           # read twice from here, the inputs behind it once
    first = materialize(first_activity(edges).withColumnRenamed(USER, "_fu"), "first-activity")
    joined = salted_lookup_join(edges, first, USER, "_fu", "left", count_col="_rows")
    return (joined.withColumn(MONTH, month_expr(TIME, "first_time"))
                  .drop("_fu", "first_time", "_rows"))


def month_range(edges_m: DataFrame, start: int, end: int) -> DataFrame:
    """Edge rows whose lifetime month lies in ``[start, end]``."""
    return edges_m.where(F.col(MONTH).between(start, end))


def first_contacts(edges_m: DataFrame) -> DataFrame:
    """Rows at the earliest time of each (user, friend) pair, ties kept.

    The pair minimum is an aggregate; rows are matched back on
    ``(user, friend, time)``, so a hot pair's rows spread over partitions by
    their times and only tied rows share a key.  ``edges_m`` is read twice:
    the minimum needs no month, so it comes from what
    :func:`with_lifetime_month` has written, without its join.
    """
    clean = edges_m.where(F.col(USER).isNotNull() & F.col(FRIEND).isNotNull())
    mins = (clean.groupBy(USER, FRIEND).agg(F.min(TIME).alias("_t0"))
                 .withColumnRenamed(USER, "_u").withColumnRenamed(FRIEND, "_f"))
    cond = [F.col(USER) == F.col("_u"), F.col(FRIEND) == F.col("_f"), F.col(TIME) == F.col("_t0")]
    return clean.join(mins, cond, "inner").drop("_u", "_f", "_t0")


# ---------------------------------------------------------------- pair aggregates
def edge_days(edges: DataFrame) -> DataFrame:
    """``user, friend, day, category``: the transactions behind ``edges``, each
    from the end whose user comes first, written once to the shared folder.
    What the personas derive from it is aggregated from this end and turned
    round afterwards (:func:`both_ways`), so half as much is mixed.  Rows
    without a user are left out, those without a friend or a category are kept."""
    user, friend = F.col(USER), F.col(FRIEND)
    one_end = edges.where(user.isNotNull() & (friend.isNull() | (user <= friend)))
    return materialize(one_end.select(USER, FRIEND, F.to_date(TIME).alias("day"), CAT), "edge-days")


def both_ways(one_end: DataFrame) -> DataFrame:
    """Rows of one end of each pair from both ends.  A user's dealings with
    itself are there from both already, and a missing friend has no end."""
    there = F.struct(F.col(USER).alias(USER), F.col(FRIEND).alias(FRIEND))
    back = F.struct(F.col(FRIEND).alias(USER), F.col(USER).alias(FRIEND))
    ends = F.when(F.col(USER) < F.col(FRIEND), F.array(there, back)).otherwise(F.array(there))
    return one_end.select(F.inline(ends), *[q(c) for c in one_end.columns if c not in (USER, FRIEND)])


def user_stats(days: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row per user of :func:`edge_days`: first active day (rows without a
    friend included), count per category and in total over all partners, and
    the number of rows ``_rows`` (which bounds the user's rows on either side
    of a lookup).  Combined map-side."""
    known = F.col(FRIEND).isNotNull()
    return both_ways(days).groupBy(USER).agg(
        F.min("day").alias("first_day"),
        *[F.count(F.when(known & (F.col(CAT) == F.lit(k)), 1)).alias(k) for k in categories],
        F.count(F.when(known, 1)).alias("_all"), F.count(F.lit(1)).alias("_rows"))


def with_clocks(days: DataFrame, first: DataFrame) -> DataFrame:
    """:func:`edge_days` with the first days of both ends, ``_fd0`` the user's
    and ``_fd1`` the friend's (null without a friend), from one row per user
    ``_fu, first_day, _rows``.  Months are known at each row from then on, so
    what lies outside a range is left out before anything is mixed by user."""
    for end, clock in ((USER, "_fd0"), (FRIEND, "_fd1")):
        days = salted_lookup_join(days, first.withColumnRenamed("first_day", clock), end, "_fu", "left",
                                  salt_from=[USER, FRIEND, "day", CAT], count_col="_rows").drop("_fu", "_rows")
    return days


def clocked_days(edges: DataFrame, categories: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The transactions behind ``edges`` with the clocks of both ends, and the
    statistics of their users, which are written to the shared folder."""
    days = edge_days(edges)
    stats = materialize(user_stats(days, categories), "user-stats")
    return with_clocks(days, stats.select(F.col(USER).alias("_fu"), "first_day", "_rows")), stats


def both_clocks(one_end: DataFrame) -> DataFrame:
    """:func:`both_ways` of rows with the clocks of both ends: either end has
    its own as ``first_day``."""
    there = F.struct(F.col(USER).alias(USER), F.col(FRIEND).alias(FRIEND), F.col("_fd0").alias("first_day"))
    back = F.struct(F.col(FRIEND).alias(USER), F.col(USER).alias(FRIEND), F.col("_fd1").alias("first_day"))
    ends = F.when(F.col(USER) < F.col(FRIEND), F.array(there, back)).otherwise(F.array(there))
    return one_end.select(F.inline(ends), *[q(c) for c in one_end.columns if c not in (USER, FRIEND, "_fd0", "_fd1")])


def _cat_count(k: str) -> Column:
    return F.count(F.when(F.col(CAT) == F.lit(k), 1))


def pair_table(days: DataFrame, categories: Sequence[str], clocks: Sequence[str] = ()) -> DataFrame:
    """One row per (user, friend) of :func:`edge_days`: first-contact day
    ``d0``, the pair's count per category and in total (all times).  Rows
    without a friend form the (user, null) row.  Both ends of a pair see the
    same counts, because
    ``both_sides`` emits every transaction in both orientations; the row is
    that of the end in ``days`` (:func:`both_ways` gives the other).
    ``clocks`` are columns that are the same in all rows of a pair and stay."""
    return days.groupBy(USER, FRIEND, *clocks).agg(F.min("day").alias("d0"), *[_cat_count(k).alias(k) for k in categories],
                                          F.count(F.lit(1)).alias("_all"))


def friend_shares(edges: DataFrame | None, categories: Sequence[str] = CATEGORIES,
                  start: int | None = None, end: int | None = None,
                  clocked: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``user, friend, lifetime_month`` + the friend's category shares over
    the friend's transactions with anyone but the user.

    ``lifetime_month`` is the user's month of first contact with the friend;
    with ``start``/``end`` only pairs first met in that range are kept.  A
    pair whose friend has no other transaction at all is dropped; one whose
    friend has others, none in ``categories``, keeps null shares.

    Every transaction takes the first days of both its ends, so pairs know
    their months where they are counted and only those of the range are mixed
    again, for their friends' counts.  ``clocked`` is the
    :func:`clocked_days` of ``edges`` where it is there already.
    """
    cats = list(categories)
    days, stats = clocked_days(edges, cats) if clocked is None else clocked
    pairs = pair_table(days.where(F.col(FRIEND).isNotNull()), cats, ("_fd0", "_fd1"))
    pm = both_clocks(pairs).withColumn(MONTH, month_expr("d0", "first_day")).where(F.col(MONTH).isNotNull())
    if start is not None and end is not None:
        pm = pm.where(F.col(MONTH).between(start, end))
    totals = stats.select(F.col(USER).alias("_fu"), *[q(k).alias("_n_" + k) for k in cats + ["_all"]], "_rows")
    joined = salted_lookup_join(pm.drop("first_day"), totals, FRIEND, "_fu", "inner", salt_from=[USER, FRIEND],
                                count_col="_rows")
    other = {k: F.col("_n_" + k) - q(k) for k in cats}
    total = row_sum(other.values())
    out = joined.select(USER, FRIEND, MONTH,
                        *[safe_div(other[k], total).alias(k) for k in cats],
                        (F.col("_n__all") - F.col("_all")).alias("_others"))
    return out.where(F.col("_others") > 0).drop("_others")


def month_day_window(start: int, end: int) -> tuple[int, int]:
    """Smallest and largest day gap whose lifetime month lies in
    ``[start, end]`` (same arithmetic as ``lifetime_month``)."""
    def month(x: int) -> int:
        return int(x / DAYS_PER_MONTH + 1)
    lo = next(x for x in range(0, int((start + 1) * DAYS_PER_MONTH) + 2) if month(x) >= start)
    hi = max(x for x in range(lo, int((end + 1) * DAYS_PER_MONTH) + 2) if month(x) <= end)
    return lo, hi


def _friend_window_counts(daily: DataFrame, queries: DataFrame, cats: list[str]) -> DataFrame:
    """``user, friend, lifetime_month, <k>.., _all``: the friend's counts on days
    ``[lo, hi]`` of each query row (``user, friend, lifetime_month, lo, hi`` and
    the pair's own counts ``<k>.., _all`` on these days), less the own.

    An as-of lookup into per-friend prefix sums without a range join: the
    friend's daily rows (``daily``: one per user and day) and the query bounds are unioned and ordered by day
    within ``(friend, salt)``; a running sum over the daily rows gives each
    bound its prefix count.  Both bounds of a query are in one part and are
    met there, the own counts on the upper one, so nothing is mixed again.
    Friends with more window bounds than
    ``HOT_KEY_ROWS`` (a bounded, broadcast list) are split into as many parts
    as their bounds ask for: their daily rows (at most one per active day) are
    repeated per part and their bounds spread over the parts by hash; every
    other friend stays in one partition with nothing repeated."""
    cols = cats + ["_all"]
    asked = queries.groupBy(F.col(FRIEND).alias("_qf")).agg((F.count(F.lit(1)) * 2).alias("_nq"))
    hot = F.broadcast(hot_keys(asked, "_qf", "_nq", HOT_KEY_ROWS))

    def mark(df):
        return df.join(hot, df["_f"] == F.col("_hot"), "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))

    data = mark(daily.select(F.col(USER).alias("_f"), F.col("day").alias("_x"), *[q(k) for k in cols]))
    data = (data.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
                .select("_f", "_x", *[q(k) for k in cols], F.lit(0).alias("_t"),
                        F.lit(None).cast("string").alias("_u"), F.lit(None).cast("int").alias(MONTH), "_salt"))
    # the lower bound (_t 1) brings nothing, the upper one (_t 2) the pair's own counts
    bounds = F.array(F.struct(F.lit(1).alias("t"), F.date_sub("lo", 1).alias("x")),
                     F.struct(F.lit(2).alias("t"), F.col("hi").alias("x")))
    qs = mark(queries.select(F.col(FRIEND).alias("_f"), F.col(USER).alias("_u"), MONTH, *[q(k) for k in cols],
                             F.explode(bounds).alias("_q")))
    qs = qs.select("_f", F.col("_q.x").alias("_x"),
                   *[F.when(F.col("_q.t") == 2, q(k)).otherwise(F.lit(0).cast("bigint")).alias(k) for k in cols],
                   F.col("_q.t").alias("_t"), "_u", MONTH,
                   F.pmod(F.xxhash64("_u", "_f"), F.col("_parts")).cast("int").alias("_salt"))
    w = (Window.partitionBy("_f", "_salt").orderBy("_x", "_t")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    so_far = [F.sum(F.when(F.col("_t") == 0, q(k)).otherwise(0)).over(w) for k in cols]
    run = (data.unionByName(qs)
               .select("_f", "_salt", "_u", MONTH, "_t",
                       *[F.when(F.col("_t") == 2, s - q(k)).otherwise(-s).alias(k) for s, k in zip(so_far, cols)])
               .where("_t > 0"))
    return (run.groupBy("_f", "_salt", "_u", MONTH).agg(*[F.sum(q(k)).alias(k) for k in cols])
               .select(F.col("_u").alias(USER), F.col("_f").alias(FRIEND), MONTH, *[q(k) for k in cols]))


def _pair_windows(days: DataFrame, cats: list[str], start: int, end: int) -> DataFrame:
    """``user, friend, lifetime_month, lo, hi, <k>.., _all``: the pairs first
    met in months ``[start, end]`` of the user, the days of these months, and
    the pair's own counts on them.

    Every transaction takes the first days of both its ends, and one
    aggregate at one end of the pair, combined map-side, counts for both."""
    first = materialize(both_ways(days).groupBy(F.col(USER).alias("_fu")).agg(
        F.min("day").alias("first_day"), F.count(F.lit(1)).alias("_rows")), "first-days")
    rows = with_clocks(days.where(F.col(FRIEND).isNotNull()), first)
    xlo, xhi = month_day_window(start, end)
    kinds = [F.col(CAT) == F.lit(k) for k in cats] + [F.lit(True)]
    cols = cats + ["_all"]

    def counts(i):
        inside = F.col("day").between(F.date_add(f"_fd{i}", xlo), F.date_add(f"_fd{i}", xhi))
        return [F.count(F.when(inside & kind, 1)).alias(f"_n{i}_{k}") for k, kind in zip(cols, kinds)]
    pairs = rows.groupBy(USER, FRIEND, "_fd0", "_fd1").agg(F.min("day").alias("d0"), *counts(0), *counts(1))

    def side(user, friend, i):
        return F.struct(F.col(user).alias(USER), F.col(friend).alias(FRIEND), F.col(f"_fd{i}").alias("first_day"),
                        *[q(f"_n{i}_{k}").alias(k) for k in cols])
    there, back = side(USER, FRIEND, 0), side(FRIEND, USER, 1)
    ends = F.when(F.col(USER) < F.col(FRIEND), F.array(there, back)).otherwise(F.array(there))
    return (pairs.select("d0", F.inline(ends)).withColumn(MONTH, month_expr("d0", "first_day"))
                 .where(F.col(MONTH).between(start, end))
                 .select(USER, FRIEND, MONTH, F.date_add("first_day", xlo).alias("lo"),
                         F.date_add("first_day", xhi).alias("hi"), *[q(k) for k in cols]))


def friend_shares_within_lifetime(edges: DataFrame, categories: Sequence[str] = CATEGORIES,
                                  start: int = 1, end: int = 12) -> DataFrame:
    """``friend_shares`` counting only the friend's transactions whose
    lifetime month on the *user's* clock (days since the user's first day)
    lies in ``[start, end]``, as the reference's comment intends (its code
    computes that month but never filters on it).  The user's clock starts at
    the user's first transaction."""
    cats = list(categories)
    days = edge_days(edges)
    pm = materialize(_pair_windows(days, cats, start, end), "pair-windows")
    daily = both_ways(days.where(F.col(FRIEND).isNotNull())).groupBy(USER, "day").agg(
        *[_cat_count(k).alias(k) for k in cats], F.count(F.lit(1)).alias("_all"))
    other = _friend_window_counts(daily, pm, cats).where(F.col("_all") > 0)
    return other.select(USER, FRIEND, MONTH, *[safe_div(q(k), row_sum(cats)).alias(k) for k in cats])


# A pair of at most so many categories carries its own counts with it, as a list
# that this bounds; the counts of the others stay rows.
CARRIED_CATEGORIES = 16


def friend_activity(edges: DataFrame, hot_rows: int = HOT_KEY_ROWS, carried: int = CARRIED_CATEGORIES) -> DataFrame:
    """``user, friend, category, n``: how many transactions of each category
    the friend made with others, counted once per first-contact row of the
    pair (the row count of joining first contacts to the friend's other
    transactions, without materialising that join).

    All inputs come from one reduction to (user, friend, time, category)
    counts at one end of each pair, written once to the shared folder.  A pair meets its friend's
    categories as rows, however many there are: a friend with more than
    ``hot_rows`` rows of the result is split into parts of about so many.  A
    pair of up to ``carried`` categories brings its own counts along, so the
    rows of the result are not mixed again; for the other pairs the own counts
    are taken off by a second equi-join.
    """
    base = materialize(edges.where(F.col(USER) <= F.col(FRIEND))
                            .groupBy(USER, FRIEND, TIME, CAT).agg(F.count(F.lit(1)).alias("c")),
                       "edge-counts")
    # per category its rows and how many of them are the earliest; a pair has no more rows here than categories
    own = materialize(base.groupBy(USER, FRIEND, CAT).agg(F.sum("c").alias("own"), F.min(TIME).alias("_t0"),
                                                          F.min_by("c", TIME).alias("ct")), "pair-categories")
    pair = Window.partitionBy(USER, FRIEND)
    few = F.col("_cats") <= carried
    pairs = (own.withColumn("_first", F.min("_t0").over(pair)).withColumn("_cats", F.count(F.lit(1)).over(pair))
                .where(F.col("_first").isNotNull())
                .groupBy(USER, FRIEND).agg(
                    F.sum(F.when(F.col("_t0") == F.col("_first"), F.col("ct"))).alias("ties"), F.max("_cats").alias("_cats"),
                    F.collect_list(F.when(few, F.struct(F.col(CAT).alias("c"), F.col("own").alias("n")))).alias("mine")))
    pairs = both_ways(materialize(pairs, "activity-pairs"))
    own = own.select(USER, FRIEND, CAT, "own")
    each = materialize(both_ways(own).groupBy(F.col(USER).alias("_fu"), F.col(CAT).alias("category")).agg(F.sum("own").alias("all")),
                       "user-categories")
    met = pairs.groupBy(F.col(FRIEND).alias("_f")).agg(F.count(F.lit(1)).alias("pairs"))
    size = (each.groupBy("_fu").agg(F.count(F.lit(1)).alias("cats")).join(met, F.col("_fu") == F.col("_f"))
                .select("_fu", (F.col("pairs") * F.col("cats")).alias("_rows")))
    hot = hot_keys(materialize(size, "activity-sizes"), "_fu", "_rows", hot_rows)

    def expand(some):
        return salted_lookup_join(some, each, FRIEND, "_fu", salt_from=[USER, FRIEND], hot=hot).drop("_fu")
    known = F.aggregate("mine", F.lit(0).cast("bigint"),
                        lambda got, x: got + F.when(x["c"].eqNullSafe(F.col("category")), x["n"]).otherwise(0))
    n = F.col("ties") * (F.col("all") - known)
    out = expand(pairs.where(few).drop("_cats")).select(USER, FRIEND, "category", n.alias("n"))
    rest = pairs.where(~few).select(USER, FRIEND, "ties")
    if not rest.isEmpty():
        mine = both_ways(own).select(F.col(USER).alias("_u"), F.col(FRIEND).alias("_f"), F.col(CAT).alias("_c"), "own")
        same = (F.col(USER) == F.col("_u")) & (F.col(FRIEND) == F.col("_f")) & F.col("category").eqNullSafe(F.col("_c"))
        n = F.col("ties") * (F.col("all") - F.coalesce("own", F.lit(0)))
        out = out.unionByName(expand(rest).join(mine, same, "left").select(USER, FRIEND, "category", n.alias("n")))
    return out.where(F.col("n") > 0)


# ---------------------------------------------------------------- self persona
def _daily_months(edges: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``user, day, <k>.., lifetime_month``: a user's counts by day.

    Rows are first reduced to (user, day) counts, combined map-side, so a hot
    user's volume never reaches one task.  The first day is a window over
    those rows: a user has at most one row per active day, so the window
    partitions stay bounded whatever the user's volume, and no join is needed.
    """
    rows = edges.where(F.col(USER).isNotNull()).withColumn("day", F.to_date(TIME))
    daily = rows.groupBy(USER, "day").agg(*[_cat_count(k).alias(k) for k in categories])
    return daily.withColumn(MONTH, month_expr("day", F.min("day").over(Window.partitionBy(USER))))


def self_persona(edges: DataFrame | None, start: int = 1, end: int = 12,
                 categories: Sequence[str] = CATEGORIES, clocked: DataFrame | None = None) -> DataFrame:
    """``user`` + share of each category among the user's transactions whose
    lifetime month lies in ``[start, end]`` (null shares for a zero total).
    With ``clocked``, the transactions of :func:`clocked_days`, a user's rows
    are counted as they come, combined map-side."""
    inside = F.col(MONTH).between(start, end)
    if clocked is None:
        dm = _daily_months(edges, categories).where(inside)
        sums = dm.groupBy(USER).agg(*[F.sum(q(k)).alias(k) for k in categories])
    else:
        rows = both_clocks(clocked).withColumn(MONTH, month_expr("day", "first_day")).where(inside)
        sums = rows.groupBy(USER).agg(*[_cat_count(k).alias(k) for k in categories])
    return reshape.shares(sums, categories)


def community_persona(edges: DataFrame | None, start: int = 1, end: int = 12,
                      categories: Sequence[str] = CATEGORIES, prefix: str = "c_",
                      clocked: tuple[DataFrame, DataFrame] | None = None,
                      within_user_lifetime: bool = False) -> DataFrame:
    """``user`` + ``c_<category>``: mean over the user's months (of first
    contact, within ``[start, end]``) of the mean over friends met that month
    of the friend's shares.  Both means are unweighted; nulls are skipped.
    ``within_user_lifetime`` counts only the friends' transactions that fall
    in months ``[start, end]`` of the user's lifetime.  ``clocked`` as in
    :func:`friend_shares`."""
    if within_user_lifetime:
        fs = friend_shares_within_lifetime(edges, categories, start, end)
    else:
        fs = friend_shares(edges, categories, start, end, clocked)
    monthly = fs.groupBy(USER, MONTH).agg(*[F.avg(q(k)).alias(k) for k in categories])
    return monthly.groupBy(USER).agg(*[F.avg(q(k)).alias(prefix + k) for k in categories])


def persona(edges: DataFrame, start: int = 1, end: int = 12,
            categories: Sequence[str] = CATEGORIES, path: str | None = None,
            mode: str = "errorifexists") -> DataFrame:
    """Self persona left-joined with the community persona, gaps as 0, both
    from one reading of the edges, written once with the clocks of both ends.  With ``path`` the result is written as
    gzip Parquet and the written table returned."""
    days, stats = clocked_days(edges, categories)
    days = materialize(days, "clocked-days")
    selfp = self_persona(None, start, end, categories, days)
    comm = community_persona(None, start, end, categories, clocked=(days, stats))
    out = selfp.join(comm, USER, "left").fillna(0)
    return write_through(out, path, mode) if path else out


def persona_before_after(edges: DataFrame, start: int, end: int, categories: Sequence[str] = CATEGORIES,
                         path: str | None = None, mode: str = "errorifexists") -> DataFrame:
    """Self persona up to month ``start`` beside (``c_`` prefixed) the self
    persona of months ``(start, end]``; users absent afterwards get 0.
    Both come from one pass over a user's days.  ``path`` as in :func:`persona`."""
    dm = _daily_months(edges, categories)
    before, after = F.col(MONTH).between(1, start), F.col(MONTH).between(start + 1, end)
    later = [f"c_{k}" for k in categories]
    sums = (dm.groupBy(USER).agg(*[F.sum(F.when(before, q(k))).alias(k) for k in categories],
                                 *[F.sum(F.when(after, q(k))).alias(c) for k, c in zip(categories, later)],
                                 F.count(F.when(before, 1)).alias("_days"))
              .where(F.col("_days") > 0).drop("_days"))
    out = reshape.shares(reshape.shares(sums, categories), later).select(USER, *[q(c) for c in (*categories, *later)]).fillna(0)
    return write_through(out, path, mode) if path else out


def calculate_persona(transactions: DataFrame, start: int = 1, end: int = 12,
                      categories: Sequence[str] = CATEGORIES, path: str | None = None,
                      mode: str = "errorifexists", user1: str = "user1", user2: str = "user2") -> DataFrame:
    """From labelled two-sided transactions (``user1, user2,
    transaction_time, selected_match_type``): with ``start == 1`` the self
    and community personas of months ``[1, end]``; otherwise the self persona
    up to ``start`` beside the ``c_`` self persona of ``(start, end]``.
    With ``path`` the result is written as gzip Parquet and the written table
    returned."""
    edges = both_sides(transactions, user1, user2)
    make = persona if start == 1 else persona_before_after
    return make(edges, start, end, categories, path, mode)


# ---------------------------------------------------------------- windowed forms
def pivot_counts(edges_m: DataFrame, keys: Sequence[str] = (USER, MONTH),
                 categories: Sequence[str] = CATEGORIES, category_col: str = CAT) -> DataFrame:
    return reshape.pivot_counts(edges_m, keys, category_col, categories)


def cumulative_counts(counts: DataFrame, partition: Sequence[str] = (USER,),
                      categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Running sums per partition over ``lifetime_month``; nulls become 0.
    Input rows are already one per (key, month), so partitions are small."""
    return reshape.running_sums(counts, partition, MONTH, categories)


def category_shares(counts: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    return reshape.shares(counts, categories)


def monthly_average(pair_shares: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Mean over friends per (user, month): the window average over a whole
    (user, month) partition followed by ``distinct`` is this aggregate."""
    return pair_shares.groupBy(USER, MONTH).agg(*[F.avg(q(k)).alias(k) for k in categories])


def running_average(monthly: DataFrame, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Mean of the monthly rows up to each month (RANGE frame, as the
    default frame of an ordered window)."""
    w = (Window.partitionBy(USER).orderBy(MONTH)
               .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return monthly.select(USER, MONTH, *[F.avg(q(k)).over(w).alias(k) for k in categories])


def latest_month_rows(df: DataFrame, end: int) -> DataFrame:
    """Per user, the row at month ``end`` or at the user's last month
    (months beyond ``end`` are cut first, so one row per user remains)."""
    w = Window.partitionBy(USER)
    cut = df.where(F.col(MONTH) <= end)
    last = cut.withColumn("_max", F.max(MONTH).over(w))
    return (last.where((F.col(MONTH) == end) | (F.col(MONTH) == F.col("_max")))
                .drop("_max", MONTH))


def self_persona_windowed(edges: DataFrame, start: int = 1, end: int = 12,
                          categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """Step-by-step self persona: pivot, running sums, shares, last month."""
    em = month_range(with_lifetime_month(edges), start, end)
    counts = pivot_counts(em, (USER, MONTH), categories)
    return latest_month_rows(category_shares(cumulative_counts(counts, (USER,), categories),
                                             categories), end)


def community_persona_windowed(edges: DataFrame, start: int = 1, end: int = 12,
                               categories: Sequence[str] = CATEGORIES,
                               prefix: str = "c_") -> DataFrame:
    """Step-by-step community persona from the pair shares."""
    fs = friend_shares(edges, categories, start, end)
    ra = running_average(monthly_average(fs, categories), categories)
    out = latest_month_rows(ra, end)
    return reshape.prefix_columns(out, prefix, [USER])
