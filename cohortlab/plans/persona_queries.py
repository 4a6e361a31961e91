"""Registered queries over the two-sided transaction view ``tx``."""

from __future__ import annotations


from ..functions.columns import round_doubles
from ..operators import persona as P
from ..sources import views

CATS = views.TX_CATEGORIES
START, END = 1, 12
LATER_END = 24


def _edges(spark, sf_dir):
    return P.both_sides(views.tx(spark, sf_dir))


def _edges_m(spark, sf_dir):
    return P.with_lifetime_month(_edges(spark, sf_dir))


def _pair_shares(spark, sf_dir):
    return P.friend_shares(_edges(spark, sf_dir), CATS, START, END)


def q_both_sides(spark, sf_dir):
    return _edges(spark, sf_dir)


def q_lifetime_month(spark, sf_dir):
    return _edges_m(spark, sf_dir)


def q_month_range(spark, sf_dir):
    return P.month_range(_edges_m(spark, sf_dir), 2, 6)


def q_first_contacts(spark, sf_dir):
    return P.first_contacts(_edges_m(spark, sf_dir))


def q_friend_activity(spark, sf_dir):
    return P.friend_activity(_edges(spark, sf_dir))


def q_pivot_counts(spark, sf_dir):
    return P.pivot_counts(P.month_range(_edges_m(spark, sf_dir), START, END), (P.USER, P.MONTH), CATS)


def q_cumulative_counts(spark, sf_dir):
    return P.cumulative_counts(q_pivot_counts(spark, sf_dir), (P.USER,), CATS)


def q_category_shares(spark, sf_dir):
    return round_doubles(P.category_shares(q_cumulative_counts(spark, sf_dir), CATS))


def q_monthly_average(spark, sf_dir):
    return round_doubles(P.monthly_average(_pair_shares(spark, sf_dir), CATS))


def q_running_average(spark, sf_dir):
    return round_doubles(P.running_average(P.monthly_average(_pair_shares(spark, sf_dir), CATS), CATS))


def q_latest_month_rows(spark, sf_dir):
    ra = P.running_average(P.monthly_average(_pair_shares(spark, sf_dir), CATS), CATS)
    return round_doubles(P.latest_month_rows(ra, END))


def q_self_persona(spark, sf_dir):
    return round_doubles(P.self_persona(_edges(spark, sf_dir), START, END, CATS))


def q_community_persona(spark, sf_dir):
    return round_doubles(P.community_persona(_edges(spark, sf_dir), START, END, CATS))


def q_community_persona_within_lifetime(spark, sf_dir):
    return round_doubles(P.community_persona(_edges(spark, sf_dir), START, END, CATS,
                                             within_user_lifetime=True))


def q_persona(spark, sf_dir):
    return round_doubles(P.persona(_edges(spark, sf_dir), START, END, CATS))


def q_persona_before_after(spark, sf_dir):
    return round_doubles(P.persona_before_after(_edges(spark, sf_dir), END, LATER_END, CATS))


QUERIES = {
    "both_sides": q_both_sides,
    "lifetime_month": q_lifetime_month,
    "month_range": q_month_range,
    "first_contacts": q_first_contacts,
    "friend_activity": q_friend_activity,
    "pivot_counts": q_pivot_counts,
    "cumulative_counts": q_cumulative_counts,
    "category_shares": q_category_shares,
    "monthly_average": q_monthly_average,
    "running_average": q_running_average,
    "latest_month_rows": q_latest_month_rows,
    "self_persona": q_self_persona,
    "community_persona": q_community_persona,
    "community_persona_within_lifetime": q_community_persona_within_lifetime,
    "persona": q_persona,
    "persona_before_after": q_persona_before_after,
}


# ---------------------------------------------------------------- SQL twins
def _cols(fmt: str, sep: str = ", ") -> str:
    return sep.join(fmt.format(k=k) for k in CATS)


_BASE = views.sql_with("tx") + """,
bs AS (SELECT user1 AS "user", user2 AS friend, transaction_time, selected_match_type FROM tx
       UNION ALL
       SELECT user2 AS "user", user1 AS friend, transaction_time, selected_match_type FROM tx),
bsm AS (SELECT *, CAST(trunc(date_diff('day', CAST(MIN(transaction_time) OVER (PARTITION BY "user") AS DATE),
                                      CAST(transaction_time AS DATE)) / 30.44 + 1) AS INTEGER) AS lifetime_month
        FROM bs),
fc AS (SELECT "user", friend, transaction_time, selected_match_type, lifetime_month FROM (
         SELECT *, MIN(transaction_time) OVER (PARTITION BY "user", friend) AS t0 FROM bsm
         WHERE "user" IS NOT NULL AND friend IS NOT NULL) WHERE transaction_time = t0)"""

_TOTAL = " + ".join(f'"{k}"' for k in CATS)


def _selfp(name: str, lo: int, hi: int, prefix: str = "", places: int | None = 6) -> str:
    known = ", ".join(f"'{k}'" for k in CATS)
    share = ('COUNT(*) FILTER (WHERE selected_match_type = \'{k}\') / '
             'NULLIF(COUNT(*) FILTER (WHERE selected_match_type IN (' + known + ')), 0)')
    if places is not None:
        share = f"round({share}, {places})"
    shares = _cols(share + ' AS "' + prefix + '{k}"')
    return f"""{name} AS (SELECT "user" AS {prefix}user_key, {shares} FROM bsm
        WHERE "user" IS NOT NULL AND lifetime_month BETWEEN {lo} AND {hi} GROUP BY "user")"""


_WITHIN = f"""
firsts AS (SELECT "user", CAST(MIN(transaction_time) AS DATE) AS fd FROM bs GROUP BY 1),
rw AS (SELECT m1."user", m1.friend, m1.lifetime_month, m2.selected_match_type AS fcat
       FROM fc m1 JOIN bs m2 ON m1.friend = m2."user" AND m2.friend <> m1."user"
       JOIN firsts f ON f."user" = m1."user"
       WHERE m1.lifetime_month BETWEEN {START} AND {END}
         AND date_diff('day', f.fd, CAST(m2.transaction_time AS DATE)) >= 0
         AND CAST(trunc(date_diff('day', f.fd, CAST(m2.transaction_time AS DATE)) / 30.44 + 1) AS INTEGER)
             BETWEEN {START} AND {END}),"""

_ROWWISE = f"""
rw AS (SELECT m1."user", m1.friend, m1.lifetime_month, m2.selected_match_type AS fcat
       FROM fc m1 JOIN bs m2 ON m1.friend = m2."user" AND m2.friend <> m1."user"
       WHERE m1.lifetime_month BETWEEN {START} AND {END}),
pc AS (SELECT "user", friend, lifetime_month, {_cols('COUNT(*) FILTER (WHERE fcat = \'{k}\') AS "{k}"')}
       FROM rw GROUP BY 1, 2, 3),
ps AS (SELECT "user", friend, lifetime_month, {_cols('"{k}" / NULLIF(' + _TOTAL + ', 0) AS "{k}"')} FROM pc),
mo AS (SELECT "user", lifetime_month, {_cols('AVG("{k}") AS "{k}"')} FROM ps GROUP BY 1, 2),
cp AS (SELECT "user", {_cols('AVG("{k}") AS "c_{k}"')} FROM mo GROUP BY 1)"""

_ROWWISE_W = _WITHIN + _ROWWISE[_ROWWISE.index("pc AS"):]

_PIVOT = f"""pv AS (SELECT "user", lifetime_month,
        {_cols('NULLIF(COUNT(*) FILTER (WHERE selected_match_type = \'{k}\'), 0) AS "{k}"')}
        FROM bsm WHERE lifetime_month BETWEEN {START} AND {END} GROUP BY 1, 2),
cu AS (SELECT "user", lifetime_month,
        {_cols('CAST(COALESCE(SUM("{k}") OVER w, 0) AS BIGINT) AS "{k}"')}
        FROM pv WINDOW w AS (PARTITION BY "user" ORDER BY lifetime_month
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

_RUNNING = """ra AS (SELECT "user", lifetime_month, {cols} FROM mo
        WINDOW w AS (PARTITION BY "user" ORDER BY lifetime_month
                     RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""".format(
    cols=_cols('AVG("{k}") OVER w AS "{k}"'))

def persona_sql(places: int | None = 6) -> str:
    """Self persona left-joined with the row-wise community persona."""
    c = 'COALESCE(round(cp."c_{k}", %d), 0) AS "c_{k}"' % places if places is not None \
        else 'COALESCE(cp."c_{k}", 0) AS "c_{k}"'
    return _BASE + ", " + _ROWWISE + ", " + _selfp("sp", START, END, "", places) + f"""
        SELECT sp.user_key AS "user", {_cols('COALESCE(sp."{k}", 0) AS "{k}"')}, {_cols(c)}
        FROM sp LEFT JOIN cp ON sp.user_key = cp."user" """


ORACLE = {
    "both_sides": _BASE + " SELECT * FROM bs",
    "lifetime_month": _BASE + " SELECT * FROM bsm",
    "month_range": _BASE + " SELECT * FROM bsm WHERE lifetime_month BETWEEN 2 AND 6",
    "first_contacts": _BASE + " SELECT * FROM fc",
    "friend_activity": _BASE + """
        SELECT m1."user", m1.friend, m2.selected_match_type AS category, COUNT(*) AS n
        FROM fc m1 JOIN bs m2 ON m1.friend = m2."user" AND m2.friend <> m1."user"
        GROUP BY 1, 2, 3""",
    "pivot_counts": _BASE + ", " + _PIVOT + " SELECT * FROM pv",
    "cumulative_counts": _BASE + ", " + _PIVOT + " SELECT * FROM cu",
    "category_shares": _BASE + ", " + _PIVOT + f""" SELECT "user", lifetime_month,
        {_cols('round("{k}" / NULLIF(' + _TOTAL + ', 0), 6) AS "{k}"')} FROM cu""",
    "monthly_average": _BASE + ", " + _ROWWISE + f""" SELECT "user", lifetime_month,
        {_cols('round("{k}", 6) AS "{k}"')} FROM mo""",
    "running_average": _BASE + ", " + _ROWWISE + ", " + _RUNNING + f""" SELECT "user", lifetime_month,
        {_cols('round("{k}", 6) AS "{k}"')} FROM ra""",
    "latest_month_rows": _BASE + ", " + _ROWWISE + ", " + _RUNNING + f""" SELECT "user",
        {_cols('round("{k}", 6) AS "{k}"')} FROM (
          SELECT *, MAX(lifetime_month) OVER (PARTITION BY "user") AS mx FROM ra WHERE lifetime_month <= {END})
        WHERE lifetime_month = {END} OR lifetime_month = mx""",
    "self_persona": _BASE + ", " + _selfp("sp", START, END) + """
        SELECT user_key AS "user", * EXCLUDE (user_key) FROM sp""",
    "community_persona": _BASE + ", " + _ROWWISE + f""" SELECT "user",
        {_cols('round("c_{k}", 6) AS "c_{k}"')} FROM cp""",
    "community_persona_within_lifetime": _BASE + ", " + _ROWWISE_W + f""" SELECT "user",
        {_cols('round("c_{k}", 6) AS "c_{k}"')} FROM cp""",
    "persona": persona_sql(6),
    "persona_before_after": _BASE + ", " + _selfp("b", 1, END) + ", "
        + _selfp("a", END + 1, LATER_END, "c_") + f"""
        SELECT b.user_key AS "user", {_cols('COALESCE(b."{k}", 0) AS "{k}"')},
               {_cols('COALESCE(a."c_{k}", 0) AS "c_{k}"')}
        FROM b LEFT JOIN a ON b.user_key = a.c_user_key""",
}
