"""Registered queries over the A/B (``trial``) and encouragement (``iv``) views."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import round_doubles
from ..operators import experiment as X
from ..sources import views

VARIABLES = ["income", "gender", "gamer"]
PRICE = 37.5                     # fixed value


def _trial(spark, sf_dir):
    return views.trial(spark, sf_dir)


def _iv(spark, sf_dir):
    return views.iv(spark, sf_dir)


QUERIES = {
    "trial_balance": lambda s, d: round_doubles(X.balance(_trial(s, d), "test", VARIABLES)),
    "trial_ttest": lambda s, d: round_doubles(X.ttest(_trial(s, d), "test", VARIABLES)),
    "trial_ttest_verdict": lambda s, d: round_doubles(X.ttest_verdict(_trial(s, d), "test", VARIABLES)),
    "rate_by_segment": lambda s, d: round_doubles(
        X.rate_by_segment(_trial(s, d), "test", ["gender", "gamer"], "purchase")),
    "rate_difference_all": lambda s, d: round_doubles(X.rate_difference(_trial(s, d), "test", "purchase")),
    "rate_difference_segment": lambda s, d: round_doubles(
        X.rate_difference(_trial(s, d), "test", "purchase", ["gender"], (1,), (0,))),
    "rate_difference_gamer": lambda s, d: round_doubles(
        X.rate_difference(_trial(s, d), "test", "purchase", ["gamer"], (1,), (0,))),
    "rate_difference_two_segments": lambda s, d: round_doubles(
        X.rate_difference(_trial(s, d), "test", "purchase", ["gender", "gamer"], (0, 1), (1, 1))),
    "expected_revenue": lambda s, d: round_doubles(X.expected_revenue(_trial(s, d), "test", "purchase", PRICE)),
    "expected_revenue_segment": lambda s, d: round_doubles(
        X.expected_revenue(_trial(s, d), "test", "purchase", PRICE, ["gender"], F.col("gamer") == 1)),
    "itt_effect": lambda s, d: round_doubles(X.effect(_iv(s, d), "instrument", "outcome")),
    "as_treated_effect": lambda s, d: round_doubles(X.effect(_iv(s, d), "treatment", "outcome")),
    "per_protocol_effect": lambda s, d: round_doubles(
        X.effect(_iv(s, d), "treatment", "outcome", F.col("instrument") == 1)),
    "wald_estimate": lambda s, d: round_doubles(X.wald(_iv(s, d), "instrument", "treatment", "outcome")),
    "itt_standard_error": lambda s, d: round_doubles(X.itt_standard_error(_iv(s, d), "instrument", "outcome")),
    "wald_standard_error": lambda s, d: round_doubles(
        X.wald_standard_error(_iv(s, d), "instrument", "treatment", "outcome")),
}

_T = views.sql_with("trial")
_I = views.sql_with("iv")


def _r(expr: str, name: str) -> str:
    return f"round({expr}, 6) AS {name}"


_BAL = " UNION ALL ".join(
    f"""SELECT '{v}' AS variable, {_r(f'AVG({v}) FILTER (WHERE test = 0)', 'control')},
        {_r(f'AVG({v}) FILTER (WHERE test = 1)', 'test')},
        {_r(f'(AVG({v}) FILTER (WHERE test = 1) - AVG({v}) FILTER (WHERE test = 0)) / NULLIF(AVG({v}) FILTER (WHERE test = 0), 0) * 100', 'pct_diff')}
        FROM trial""" for v in VARIABLES)

_TT = " UNION ALL ".join(
    f"""SELECT '{v}' AS variable, COUNT({v}) FILTER (WHERE test = 0) AS n0, COUNT({v}) FILTER (WHERE test = 1) AS n1,
        AVG({v}) FILTER (WHERE test = 0) AS mean0, AVG({v}) FILTER (WHERE test = 1) AS mean1,
        VAR_SAMP({v}) FILTER (WHERE test = 0) AS var0, VAR_SAMP({v}) FILTER (WHERE test = 1) AS var1
        FROM trial""" for v in VARIABLES)


def _rate(cond: str) -> str:
    return f"AVG(purchase) FILTER (WHERE {cond}) * 100"


def _dd(a: str, b: str) -> str:
    ta, ca, tb, cb = _rate(f"test = 1 AND {a}"), _rate(f"test = 0 AND {a}"), _rate(f"test = 1 AND {b}"), _rate(f"test = 0 AND {b}")
    d = f"(({ta}) - ({ca})) - (({tb}) - ({cb}))"
    return (_T + f"SELECT {_r(ta, 'test_rate_a')}, {_r(ca, 'control_rate_a')}, {_r(tb, 'test_rate_b')}, "
            f"{_r(cb, 'control_rate_b')}, {_r(d, 'diff')}, {_r(f'abs({d})', 'abs_diff')} FROM trial")


def _effect(group: str, where: str = "TRUE") -> str:
    r1 = f"AVG(outcome) FILTER (WHERE {group} = 1) * 100"
    r0 = f"AVG(outcome) FILTER (WHERE {group} = 0) * 100"
    return _I + f"SELECT {_r(r1, 'rate1')}, {_r(r0, 'rate0')}, {_r(f'({r1}) - ({r0})', 'diff')} FROM iv WHERE {where}"


_CLEAN_IV = "iv_c AS (SELECT * FROM iv WHERE instrument IS NOT NULL AND treatment IS NOT NULL AND outcome IS NOT NULL)"

ORACLE = {
    "trial_balance": _T + _BAL,
    "trial_ttest": _T + f""", m AS ({_TT})
        SELECT variable, n0, n1, round(mean0, 6) AS mean0, round(mean1, 6) AS mean1,
               round((mean0 - mean1) / NULLIF(sqrt(((n0 - 1) * var0 + (n1 - 1) * var1) / NULLIF(n0 + n1 - 2, 0)
                     * (1.0 / n0 + 1.0 / n1)), 0), 6) AS t,
               n0 + n1 - 2 AS df FROM m""",
    # The p-value by Simpson's rule over the density, 2000 steps from 0 to |t|.
    "trial_ttest_verdict": _T + f""", m AS ({_TT}),
        s AS (SELECT variable, n0 + n1 - 2 AS df,
                     (mean0 - mean1) / NULLIF(sqrt(((n0 - 1) * var0 + (n1 - 1) * var1) / NULLIF(n0 + n1 - 2, 0)
                     * (1.0 / n0 + 1.0 / n1)), 0) AS t FROM m),
        area AS (SELECT variable, SUM(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                            * pow(1 + pow(t * i / 2000, 2) / df, -(df + 1) / 2.0)) * abs(t) / 6000
                            * exp(lgamma((df + 1) / 2.0) - lgamma(df / 2.0)) / sqrt(df * pi()) AS half
                 FROM s, range(0, 2001) g(i) GROUP BY variable, t, df),
        p AS (SELECT variable, t, df, 1 - 2 * half AS p_value FROM s JOIN area USING (variable))
        SELECT variable, round(t, 6) AS t, df, round(p_value, 6) AS p_value,
               CASE WHEN p_value < 0.05 THEN '{X.REJECT}' WHEN p_value IS NOT NULL THEN '{X.KEEP}' END AS verdict FROM p""",
    "rate_by_segment": _T + "SELECT test, gender, gamer, round(AVG(purchase), 6) AS rate FROM trial GROUP BY 1, 2, 3",
    "rate_difference_all": _T + f"""SELECT {_r(_rate('test = 1'), 'test_rate')}, {_r(_rate('test = 0'), 'control_rate')},
        {_r(f"({_rate('test = 1')}) - ({_rate('test = 0')})", 'diff')},
        {_r(f"abs(({_rate('test = 1')}) - ({_rate('test = 0')}))", 'abs_diff')} FROM trial""",
    "rate_difference_segment": _dd("gender = 1", "gender = 0"),
    "rate_difference_gamer": _dd("gamer = 1", "gamer = 0"),
    "rate_difference_two_segments": _dd("gender = 0 AND gamer = 1", "gender = 1 AND gamer = 1"),
    "expected_revenue": _T + f"""SELECT {_r(f'{PRICE} * AVG(purchase) FILTER (WHERE test = 0)', 'control_revenue')},
        {_r(f'{PRICE} * AVG(purchase) FILTER (WHERE test = 1)', 'test_revenue')},
        {_r(f'{PRICE} * AVG(purchase) FILTER (WHERE test = 1) - {PRICE} * AVG(purchase) FILTER (WHERE test = 0)', 'difference')}
        FROM trial""",
    "expected_revenue_segment": _T + f"""SELECT gender,
        {_r(f'{PRICE} * AVG(purchase) FILTER (WHERE test = 0)', 'control_revenue')},
        {_r(f'{PRICE} * AVG(purchase) FILTER (WHERE test = 1)', 'test_revenue')},
        {_r(f'{PRICE} * AVG(purchase) FILTER (WHERE test = 1) - {PRICE} * AVG(purchase) FILTER (WHERE test = 0)', 'difference')}
        FROM trial WHERE gamer = 1 GROUP BY gender""",
    "itt_effect": _effect("instrument"),
    "as_treated_effect": _effect("treatment"),
    "per_protocol_effect": _effect("treatment", "instrument = 1"),
    "wald_estimate": _I + f""", {_CLEAN_IV},
        w AS (SELECT covar_samp(instrument, outcome) / NULLIF(covar_samp(instrument, treatment), 0) AS b,
                     AVG(outcome) AS my, AVG(treatment) AS mx FROM iv_c)
        SELECT round(b, 6) AS estimate, round(my - b * mx, 6) AS intercept FROM w""",
    "itt_standard_error": _I + """SELECT round(sqrt(
            (AVG(outcome) FILTER (WHERE instrument = 1)) * (1 - AVG(outcome) FILTER (WHERE instrument = 1))
              / NULLIF(COUNT(outcome) FILTER (WHERE instrument = 1), 0)
          + (AVG(outcome) FILTER (WHERE instrument = 0)) * (1 - AVG(outcome) FILTER (WHERE instrument = 0))
              / NULLIF(COUNT(outcome) FILTER (WHERE instrument = 0), 0)), 6) AS standard_error
        FROM iv WHERE instrument IS NOT NULL AND outcome IS NOT NULL""",
    "wald_standard_error": _I + f""", {_CLEAN_IV},
        w AS (SELECT covar_samp(instrument, outcome) / NULLIF(covar_samp(instrument, treatment), 0) AS b,
                     AVG(outcome) AS my, AVG(treatment) AS mx, AVG(instrument) AS mz FROM iv_c)
        SELECT round(sqrt(SUM(power(c.outcome - ((SELECT my FROM w) - (SELECT b FROM w) * (SELECT mx FROM w))
                                     - (SELECT b FROM w) * c.treatment, 2) * power(c.instrument - (SELECT mz FROM w), 2)))
                     / NULLIF(abs(SUM((c.instrument - (SELECT mz FROM w)) * (c.treatment - (SELECT mx FROM w)))), 0), 6)
               AS standard_error
        FROM iv_c c""",
}
