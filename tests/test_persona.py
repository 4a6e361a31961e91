import datetime as dt
import math
import random

import pandas as pd
import pytest

from pyspark.sql import functions as F

from cohortlab.operators import persona as P
from cohortlab.plans.guards import plan_text

CATS = ["Food", "Travel", "Cash"]
T0 = dt.datetime(2020, 1, 1, 9, 0)


def _random_edges(seed=7, n=300, users=12):
    rnd = random.Random(seed)
    names = [f"u{i}" for i in range(users)]
    rows = []
    for _ in range(n):
        a, b = rnd.choice(names), rnd.choice(names)          # self-edges included
        day = rnd.choice([0, 0, 3, 30, 31, 60, 61, 90, 200, 400])
        cat = rnd.choice(CATS + ["Unknown", None])
        rows.append((a, b, T0 + dt.timedelta(days=day), cat))
    rows.append(("u1", None, T0, "Food"))                    # no friend
    return rows


SCHEMA = "user1 string, user2 string, transaction_time timestamp, selected_match_type string"


@pytest.fixture(scope="module")
def edges(spark):
    return P.both_sides(spark.createDataFrame(_random_edges(), SCHEMA))


def _month(days):
    return int(days / 30.44 + 1)


def _brute(rows, start, end):
    """The step-by-step definition, row by row, in pandas."""
    tx = pd.DataFrame(rows, columns=["user1", "user2", "t", "cat"])
    a = tx.rename(columns={"user1": "user", "user2": "friend"})
    b = tx.rename(columns={"user2": "user", "user1": "friend"})
    bs = pd.concat([a[["user", "friend", "t", "cat"]], b[["user", "friend", "t", "cat"]]], ignore_index=True)
    bs = bs[bs.user.notna()]
    first = bs.groupby("user").t.min()
    bs["month"] = [_month((t.normalize() - first[u].normalize()).days) for u, t in zip(bs.user, bs.t)]
    # self persona
    sel = bs[(bs.month >= start) & (bs.month <= end)]
    selfp = {}
    for u, g in sel.groupby("user"):
        counts = {k: int((g.cat == k).sum()) for k in CATS}
        tot = sum(counts.values())
        selfp[u] = {k: (counts[k] / tot if tot else None) for k in CATS}
    # community persona
    pairs = bs[bs.friend.notna()]
    t0 = pairs.groupby(["user", "friend"]).t.transform("min")
    m1 = pairs[pairs.t == t0]
    m1 = m1[(m1.month >= start) & (m1.month <= end)]
    j = m1.merge(pairs, left_on="friend", right_on="user", suffixes=("", "_2"))
    j = j[j.friend_2 != j.user]
    comm = {}
    for u, gu in j.groupby("user"):
        monthly = []
        for m, gm in gu.groupby("month"):
            shares = []
            for f, gf in gm.groupby("friend"):
                c = {k: int((gf.cat_2 == k).sum()) for k in CATS}
                tot = sum(c.values())
                shares.append({k: (c[k] / tot if tot else None) for k in CATS})
            monthly.append({k: _mean([s[k] for s in shares]) for k in CATS})
        comm[u] = {k: _mean([m[k] for m in monthly]) for k in CATS}
    return selfp, comm


def _mean(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def _with_month_by_window(edges):
    """The step-by-step definition: the first time of each user by a window."""
    from pyspark.sql import Window
    from cohortlab.functions.columns import lifetime_month
    return edges.withColumn(P.MONTH, lifetime_month(P.TIME, F.min(P.TIME).over(Window.partitionBy(P.USER))))


def test_lifetime_month_boundaries(spark):
    days = [0, 30, 31, 60, 61, 365]
    rows = [("a", "b", T0 + dt.timedelta(days=d, hours=d % 5), "Food") for d in days]
    e = P.with_lifetime_month(P.both_sides(spark.createDataFrame(rows, SCHEMA)))
    got = sorted(r.lifetime_month for r in e.where("user = 'a'").collect())
    assert got == [1, 1, 2, 2, 3, 12]
    w = _with_month_by_window(P.both_sides(spark.createDataFrame(rows, SCHEMA)))
    assert sorted(r.lifetime_month for r in w.where("user = 'a'").collect()) == got


def test_both_sides_doubles_rows(spark):
    rows = [("a", "a", T0, "Food"), ("a", "b", T0, "Cash")]
    out = P.both_sides(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 4
    assert sum(1 for r in out if r.user == "a" and r.friend == "a") == 2


@pytest.mark.parametrize("start,end", [(1, 12), (1, 6), (2, 3)])
def test_closed_form_matches_row_by_row(spark, edges, start, end):
    selfp, comm = _brute(_random_edges(), start, end)
    got_self = {r.user: r.asDict() for r in P.self_persona(edges, start, end, CATS).collect()}
    got_comm = {r.user: r.asDict() for r in P.community_persona(edges, start, end, CATS).collect()}
    assert set(got_self) == set(selfp)
    assert set(got_comm) == set(comm)
    for u in selfp:
        assert all(_close(got_self[u][k], selfp[u][k]) for k in CATS), u
    for u in comm:
        assert all(_close(got_comm[u]["c_" + k], comm[u][k]) for k in CATS), u


def test_windowed_forms_agree_with_closed_forms(spark, edges):
    a = {r.user: r for r in P.self_persona(edges, 1, 12, CATS).collect()}
    b = {r.user: r for r in P.self_persona_windowed(edges, 1, 12, CATS).collect()}
    assert set(a) == set(b)
    for u in a:
        assert all(_close(a[u][k], b[u][k]) for k in CATS)
    c = {r.user: r for r in P.community_persona(edges, 1, 12, CATS).collect()}
    d = {r.user: r for r in P.community_persona_windowed(edges, 1, 12, CATS).collect()}
    assert set(c) == set(d)
    for u in c:
        assert all(_close(c[u]["c_" + k], d[u]["c_" + k]) for k in CATS)


def test_persona_unchanged_by_repartition(spark, edges):
    a = sorted(tuple(r) for r in P.persona(edges, 1, 12, CATS).collect())
    b = sorted(tuple(r) for r in P.persona(edges.repartition(7), 1, 12, CATS).collect())
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert x[0] == y[0] and all(_close(p, q) for p, q in zip(x[1:], y[1:]))
    for r in a:                                  # shares sum to 1 or are all 0
        s = sum(r[1:1 + len(CATS)])
        assert _close(s, 1.0) or _close(s, 0.0)


def test_friend_activity_matches_row_join(spark, edges):
    rows = _random_edges()
    tx = pd.DataFrame(rows, columns=["user1", "user2", "t", "cat"])
    a = tx.rename(columns={"user1": "user", "user2": "friend"})
    b = tx.rename(columns={"user2": "user", "user1": "friend"})
    bs = pd.concat([a, b], ignore_index=True)[["user", "friend", "t", "cat"]]
    bs = bs[bs.user.notna() & bs.friend.notna()]
    m1 = bs[bs.t == bs.groupby(["user", "friend"]).t.transform("min")]
    j = m1.merge(bs, left_on="friend", right_on="user", suffixes=("", "_2"))
    j = j[j.friend_2 != j.user]
    want = {(u, f, c if isinstance(c, str) else None): n
            for (u, f, c), n in j.groupby(["user", "friend", "cat_2"], dropna=False).size().items()}
    got = {(r.user, r.friend, r.category): r.n for r in P.friend_activity(edges).collect()}
    assert got == want


def test_no_cartesian_or_nested_loop(spark, edges):
    plan = plan_text(P.persona(edges, 1, 12, CATS))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_before_after(spark, edges):
    out = {r.user: r for r in P.persona_before_after(edges, 2, 12, CATS).collect()}
    before = {r.user: r for r in P.self_persona(edges, 1, 2, CATS).collect()}
    assert set(out) == set(before)
    for r in out.values():
        assert all(r["c_" + k] is not None for k in CATS)


def test_calculate_persona_dispatch(spark):
    tx = spark.createDataFrame(_random_edges(), SCHEMA)
    a = sorted(tuple(r) for r in P.calculate_persona(tx, 1, 12, CATS).collect())
    b = sorted(tuple(r) for r in P.persona(P.both_sides(tx), 1, 12, CATS).collect())
    assert a == b
    c = sorted(tuple(r) for r in P.calculate_persona(tx, 3, 12, CATS).collect())
    d = sorted(tuple(r) for r in P.persona_before_after(P.both_sides(tx), 3, 12, CATS).collect())
    assert c == d


def _brute_within(rows, start, end):
    """Community persona counting only the friend's transactions inside the
    user's months [start, end] (user's clock from the user's first day)."""
    tx = pd.DataFrame(rows, columns=["user1", "user2", "t", "cat"])
    a = tx.rename(columns={"user1": "user", "user2": "friend"})
    b = tx.rename(columns={"user2": "user", "user1": "friend"})
    bs = pd.concat([a[["user", "friend", "t", "cat"]], b[["user", "friend", "t", "cat"]]], ignore_index=True)
    bs = bs[bs.user.notna()]
    first = bs.groupby("user").t.min()
    bs["month"] = [_month((t.normalize() - first[u].normalize()).days) for u, t in zip(bs.user, bs.t)]
    pairs = bs[bs.friend.notna()]
    t0 = pairs.groupby(["user", "friend"]).t.transform("min")
    m1 = pairs[pairs.t == t0]
    m1 = m1[(m1.month >= start) & (m1.month <= end)]
    j = m1.merge(pairs, left_on="friend", right_on="user", suffixes=("", "_2"))
    j = j[j.friend_2 != j.user]
    j = j[[start <= _month((t2.normalize() - first[u].normalize()).days) <= end
           if (t2.normalize() - first[u].normalize()).days >= 0 else False
           for u, t2 in zip(j.user, j.t_2)]]
    comm = {}
    for u, gu in j.groupby("user"):
        monthly = []
        for m, gm in gu.groupby("month"):
            shares = []
            for f, gf in gm.groupby("friend"):
                c = {k: int((gf.cat_2 == k).sum()) for k in CATS}
                tot = sum(c.values())
                shares.append({k: (c[k] / tot if tot else None) for k in CATS})
            monthly.append({k: _mean([s[k] for s in shares]) for k in CATS})
        comm[u] = {k: _mean([m[k] for m in monthly]) for k in CATS}
    return comm


@pytest.mark.parametrize("start,end", [(1, 12), (2, 3)])
def test_within_user_lifetime_matches_row_by_row(spark, edges, start, end):
    want = _brute_within(_random_edges(), start, end)
    got = {r.user: r.asDict() for r in P.community_persona(edges, start, end, CATS,
                                                           within_user_lifetime=True).collect()}
    assert set(got) == set(want)
    for u in want:
        assert all(_close(got[u]["c_" + k], want[u][k]) for k in CATS), u


def test_hub_with_a_hundred_thousand_categories(spark):
    """A hub's categories are rows, never one list."""
    n = 100_000
    hub = spark.range(n).select(F.lit("hub").alias("user1"), F.concat(F.lit("f"), (F.col("id") % 3).cast("string")).alias("user2"),
                                F.lit("2020-01-01 00:00:00").cast("timestamp").alias("transaction_time"),
                                F.concat(F.lit("cat"), F.col("id").cast("string")).alias("selected_match_type"))
    edges = P.both_sides(hub)
    got = P.friend_activity(edges, hot_rows=10_000)
    per = {r.user: (r.rows, r.total) for r in got.where("friend = 'hub'").groupBy("user")
           .agg(F.count("*").alias("rows"), F.sum("n").alias("total")).collect()}
    mine = {r.user2: r["count"] for r in hub.groupBy("user2").count().collect()}
    # every transaction of a pair has the same time, so each is a first-contact row
    assert per == {u: (n - k, k * (n - k)) for u, k in mine.items()}
    assert "collect_list" not in plan_text(got)


def test_written_persona_is_read_back(spark, edges, tmp_path):
    out = P.persona(edges, 1, 12, CATS, path=str(tmp_path / "p"))
    assert str(tmp_path) in out.inputFiles()[0]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, P.persona(edges, 1, 12, CATS).collect()), key=str)


def test_nine_categories_with_a_slash(spark):
    """The labelled payments' own category names, one of which holds a slash."""
    import datetime as dt
    rows = [(f"u{i % 5}", f"u{(i * 3 + 1) % 7}", dt.datetime(2020, 1, 1) + dt.timedelta(days=i % 300), P.CATEGORIES[i % 9]) for i in range(200)]
    t = spark.createDataFrame(rows, "user1 string, user2 string, transaction_time timestamp, selected_match_type string")
    out = P.calculate_persona(t)
    assert "c_Illegal/Sarcasm" in out.columns and len(out.columns) == 19
    assert all(abs(sum(r[k] for k in P.CATEGORIES) - 1) < 1e-9 for r in out.collect())


def test_pairs_are_reduced_from_one_end(spark, edges):
    """Personas keep and mix one row per transaction, not one per end."""
    rows = _random_edges()
    days = P.edge_days(edges)
    loops = sum(a == b for a, b, _, _ in rows)
    assert days.count() == len(rows) + loops
    pairs = P.pair_table(days, CATS)
    assert pairs.count() == len({tuple(sorted((a, b), key=str)) for a, b, _, _ in rows})
    ends = P.both_ways(days)
    want = edges.where("user is not null").select("user", "friend", F.to_date("transaction_time").alias("day"), "selected_match_type")
    assert ends.exceptAll(want).count() == 0 and want.exceptAll(ends).count() == 0


def test_before_and_after_come_from_one_pass(spark, edges):
    """Two exchanges, by day and by user, for both ranges of months."""
    plan = plan_text(P.persona_before_after(edges, 2, 12, CATS), "simple")
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_windows_count_frequent_pairs_in_parts(spark, monkeypatch):
    """A pair's own days meet its windows as they come; frequent pairs are split."""
    from cohortlab.plans import guards
    edges = P.both_sides(spark.createDataFrame(_random_edges(11, 500, 4), SCHEMA))
    want = {tuple(r) for r in P.friend_shares_within_lifetime(edges, CATS, 1, 2).collect()}
    monkeypatch.setattr(guards.hot_keys, "__defaults__", (3, guards.MAX_HOT_KEYS))
    got = P.friend_shares_within_lifetime(edges, CATS, 1, 2).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want and want
    assert "pair-days" not in plan_text(P.friend_shares_within_lifetime(edges, CATS, 1, 2))


def test_activity_keeps_one_end(spark, edges, monkeypatch):
    """The counts behind it are of one end of each pair."""
    named, write = {}, P.materialize

    def noted(df, purpose):
        named[purpose] = write(df, purpose)
        return named[purpose]
    monkeypatch.setattr(P, "materialize", noted)
    P.friend_activity(edges).collect()
    kept = named["edge-counts"]
    assert kept.where("user > friend").count() == 0 and kept.count() > 0


def test_activity_carries_a_pairs_own_counts(spark, edges):
    """Pairs of few categories bring their own counts; the rows of the result meet no table of pairs again."""
    want = {tuple(r) for r in P.friend_activity(edges).collect()}
    for carried in (0, 1, 2):                    # the rest by the equi-join
        got = [tuple(r) for r in P.friend_activity(edges, hot_rows=20, carried=carried).collect()]
        assert len(got) == len(want) and set(got) == want and want
    plan = plan_text(P.friend_activity(edges))
    assert "user-categories" in plan and "pair-categories" not in plan
    assert "pair-categories" in plan_text(P.friend_activity(edges, carried=1))


def test_activity_without_a_first_contact(spark):
    """Rows without a time count for the friend, never as a first contact; equal categories may be null."""
    rows = [("a", "b", None, "Food"), ("b", "c", T0, None), ("b", "c", T0, None), ("c", "d", T0, "Cash")]
    got = {tuple(r) for r in P.friend_activity(P.both_sides(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got == {("c", "b", "Food", 2), ("b", "c", "Cash", 2), ("d", "c", None, 2)}


def test_windows_are_met_where_they_are_counted(spark, edges):
    """Beyond the days and the windows nothing is mixed: own counts come with
    a window's upper bound, both bounds meet in their part.  The other two
    exchanges count the bounds of a friend, for the list of frequent ones."""
    plan = plan_text(P.friend_shares_within_lifetime(edges, CATS, 1, 2), "simple")
    assert plan.count("Exchange hashpartitioning") == 4 and "SortMergeJoin" not in plan


def test_first_contacts_write_nothing_more(spark, edges, monkeypatch):
    """The rows are written once, by the lifetime month; the earliest times come from these."""
    em = P.with_lifetime_month(edges)
    monkeypatch.setattr(P, "materialize", lambda df, purpose: pytest.fail(f"writes {purpose}"))
    got = sorted(map(tuple, P.first_contacts(em).collect()), key=str)
    rows = [r for r in em.collect() if r.user is not None and r.friend is not None]
    t0 = {}
    for r in rows:
        t0[r.user, r.friend] = min(t0.get((r.user, r.friend), r.transaction_time), r.transaction_time)
    assert got == sorted((tuple(r) for r in rows if r.transaction_time == t0[r.user, r.friend]), key=str) and got


def test_personas_know_months_before_they_are_mixed(spark, edges, monkeypatch):
    """The clocks of both ends go with every transaction, so neither pairs nor
    days are mixed by user to learn their months; frequent users are split."""
    from cohortlab.plans import guards
    want = sorted(map(tuple, P.persona(edges, 1, 3, CATS).collect()), key=str)
    named, write = {}, P.materialize

    def noted(df, purpose):
        named[purpose] = write(df, purpose)
        return named[purpose]
    monkeypatch.setattr(P, "materialize", noted)
    out = P.persona(edges, 1, 3, CATS)
    assert set(named) == {"edge-days", "user-stats", "clocked-days"} and "Window" not in plan_text(out)
    first = {}
    for r in edges.where("user is not null").collect():
        first[r.user] = min(first.get(r.user, r.transaction_time.date()), r.transaction_time.date())
    days = named["clocked-days"].collect()
    assert len(days) == named["edge-days"].count() and any(r.friend is None for r in days)
    assert all((r._fd0, r._fd1) == (first[r.user], first.get(r.friend)) for r in days)
    monkeypatch.setattr(guards.hot_keys, "__defaults__", (3, guards.MAX_HOT_KEYS))
    got = sorted(map(tuple, P.persona(edges, 1, 3, CATS).collect()), key=str)
    assert [r[0] for r in got] == [r[0] for r in want] and want
    assert all(_close(x, y) for g, w in zip(got, want) for x, y in zip(g[1:], w[1:]))


def test_personas_of_rows_without_a_time_or_a_friend(spark):
    """Rows without a time count among a friend's, in no month; a user known
    from rows without a friend alone has a self persona and no community."""
    rows = [("a", "b", T0, "Food"), ("a", "b", None, "Cash"), ("b", "c", T0, "Travel"), ("d", None, T0, "Cash"),
            ("e", "b", None, "Food"), (None, "c", T0, "Food"), ("c", "c", T0, "Cash")]
    got = {r.user: tuple(r)[1:] for r in P.persona(P.both_sides(spark.createDataFrame(rows, SCHEMA)), 1, 12, CATS).collect()}
    assert set(got) == {"a", "b", "c", "d"}                      # e has no first day
    assert got["d"] == (0, 0, 1, 0, 0, 0)
    assert got["a"][:3] == (1, 0, 0) and got["a"][3:] == (0.5, 0.5, 0)     # of b, but for a: Travel and e's Food
    assert got["c"][:3] == (0.25, 0.25, 0.5)
