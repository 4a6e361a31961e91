"""Experiment evaluation as distributed aggregates.

Every estimate is one aggregation over the table (two for the robust 2SLS
error), with arms and segments as conditional aggregates; only a handful of
result rows exist at the end.  Means are kept at full precision; rounding is
for presentation.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q, safe_div
from ..functions.stats import t_pvalue

# The verdict texts of the balance t-test.
REJECT = "Reject H0. Control and test groups are not similar"
KEEP = "Fail to reject H0. Control and test groups are similar."


def _in_arm(arm: str, value, x) -> Column:
    return F.when(q(arm) == F.lit(value), x if isinstance(x, Column) else q(x))


def _rows(per_variable: dict[str, dict[str, Column]]) -> Column:
    """An array of structs, one per variable, for ``inline`` (a stack)."""
    return F.array(*[F.struct(F.lit(v).alias("variable"), *[c.alias(n) for n, c in cols.items()])
                     for v, cols in per_variable.items()])


def balance(df: DataFrame, arm: str, variables: Sequence[str]) -> DataFrame:
    """``variable, control, test, pct_diff``: arm means and the test's
    percentage difference from control, all variables in one pass."""
    aggs = df.agg(*[F.avg(_in_arm(arm, 0, v)).alias(f"c_{i}") for i, v in enumerate(variables)],
                  *[F.avg(_in_arm(arm, 1, v)).alias(f"t_{i}") for i, v in enumerate(variables)])
    rows = {v: {"control": F.col(f"c_{i}"), "test": F.col(f"t_{i}")} for i, v in enumerate(variables)}
    long = aggs.select(F.inline(_rows(rows)))
    return long.withColumn("pct_diff", safe_div(F.col("test") - F.col("control"), F.col("control")) * 100)


def ttest(df: DataFrame, arm: str, variables: Sequence[str]) -> DataFrame:
    """Two-sample t-test with pooled variance (control minus test), per
    variable: ``variable, n0, n1, mean0, mean1, t, df``.  Nulls of a
    variable are skipped for that variable."""
    aggs = []
    for i, v in enumerate(variables):
        for a in (0, 1):
            x = _in_arm(arm, a, v)
            aggs += [F.count(x).alias(f"n{a}_{i}"), F.avg(x).alias(f"m{a}_{i}"),
                     F.var_samp(x).alias(f"v{a}_{i}")]
    one = df.agg(*aggs)
    rows = {v: {"n0": F.col(f"n0_{i}"), "n1": F.col(f"n1_{i}"), "mean0": F.col(f"m0_{i}"),
                "mean1": F.col(f"m1_{i}"), "var0": F.col(f"v0_{i}"), "var1": F.col(f"v1_{i}")}
            for i, v in enumerate(variables)}
    long = one.select(F.inline(_rows(rows)))
    n0, n1 = F.col("n0"), F.col("n1")
    dof = n0 + n1 - 2
    pooled = safe_div((n0 - 1) * F.col("var0") + (n1 - 1) * F.col("var1"), dof)
    se = F.sqrt(pooled * (safe_div(F.lit(1.0), n0) + safe_div(F.lit(1.0), n1)))
    t = safe_div(F.col("mean0") - F.col("mean1"), se)
    return long.select("variable", "n0", "n1", "mean0", "mean1", t.alias("t"), dof.alias("df"))


def ttest_verdict(df: DataFrame, arm: str, variables: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """``variable, t, df, p_value, verdict`` (two-sided p from Student's t)."""
    tt = ttest(df, arm, variables)
    p = t_pvalue(F.col("t"), F.col("df").cast("double"))
    out = tt.select("variable", "t", "df", F.nanvl(p, F.lit(None).cast("double")).alias("p_value"))
    verdict = F.when(F.col("p_value") < F.lit(alpha), F.lit(REJECT)).otherwise(F.lit(KEEP))
    return out.withColumn("verdict", F.when(F.col("p_value").isNotNull(), verdict))


def rate_by_segment(df: DataFrame, arm: str, segments: Sequence[str], target: str,
                    out: str = "rate") -> DataFrame:
    return df.groupBy(q(arm), *[q(s) for s in segments]).agg(F.avg(q(target)).alias(out))


def _cell(segments: Sequence[str], values: Sequence) -> Column:
    cond = F.lit(True)
    for s, v in zip(segments, values):
        cond = cond & (q(s) == F.lit(v))
    return cond


def rate_difference(df: DataFrame, arm: str, target: str, segments: Sequence[str] = (),
                    cell_a: Sequence = (), cell_b: Sequence = ()) -> DataFrame:
    """Purchase-rate differences in percent, one row.

    Without segments: ``test_rate, control_rate, diff, abs_diff``.  With
    segments: rates in cell ``a`` and cell ``b`` and the difference in
    differences ``(test_a - control_a) - (test_b - control_b)``.
    """
    def rate(a, cell):
        return F.avg(F.when(cell & (q(arm) == F.lit(a)), q(target))) * 100

    if not segments:
        r = df.agg(rate(1, F.lit(True)).alias("test_rate"), rate(0, F.lit(True)).alias("control_rate"))
        diff = F.col("test_rate") - F.col("control_rate")
    else:
        ca, cb = _cell(segments, cell_a), _cell(segments, cell_b)
        r = df.agg(rate(1, ca).alias("test_rate_a"), rate(0, ca).alias("control_rate_a"),
                   rate(1, cb).alias("test_rate_b"), rate(0, cb).alias("control_rate_b"))
        diff = ((F.col("test_rate_a") - F.col("control_rate_a"))
                - (F.col("test_rate_b") - F.col("control_rate_b")))
    return r.withColumn("diff", diff).withColumn("abs_diff", F.abs(diff))


def expected_revenue(df: DataFrame, arm: str, target: str, price: float,
                     by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """``[by..,] control_revenue, test_revenue, difference``: price times the
    purchase rate of each arm."""
    base = df if where is None else df.where(where)
    aggs = [(F.lit(price) * F.avg(_in_arm(arm, 0, target))).alias("control_revenue"),
            (F.lit(price) * F.avg(_in_arm(arm, 1, target))).alias("test_revenue")]
    r = base.groupBy(*[q(b) for b in by]).agg(*aggs) if by else base.agg(*aggs)
    return r.withColumn("difference", F.col("test_revenue") - F.col("control_revenue"))


def effect(df: DataFrame, group: str, outcome: str, where: Column | None = None) -> DataFrame:
    """Outcome rate (percent) for ``group`` = 1 and 0 and their difference:
    intent-to-treat (group = instrument), as-treated (group = treatment),
    per-protocol (group = treatment, ``where`` instrument = 1)."""
    base = df if where is None else df.where(where)
    r = base.agg((F.avg(_in_arm(group, 1, outcome)) * 100).alias("rate1"),
                 (F.avg(_in_arm(group, 0, outcome)) * 100).alias("rate0"))
    return r.withColumn("diff", F.col("rate1") - F.col("rate0"))


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & q(c).isNotNull()
    return cond


def wald(df: DataFrame, z: str, x: str, y: str) -> DataFrame:
    """Two-stage least squares with one instrument and an intercept:
    ``estimate = cov(z, y) / cov(z, x)`` (null for a zero first stage) and
    its ``intercept``.  Equals the Wald ratio of rate differences, and the
    offered-and-treated ratio when nobody un-offered is treated."""
    base = df.where(_all_not_null([z, x, y]))
    b = safe_div(F.covar_samp(q(z), q(y)), F.covar_samp(q(z), q(x)))
    r = base.agg(b.alias("estimate"), F.avg(q(y)).alias("_my"), F.avg(q(x)).alias("_mx"))
    return r.select("estimate", (F.col("_my") - F.col("estimate") * F.col("_mx")).alias("intercept"))


def itt_standard_error(df: DataFrame, z: str, y: str) -> DataFrame:
    """``sqrt(pA(1-pA)/nA + pB(1-pB)/nB)`` for the offered (A) and not offered
    (B) outcome rates."""
    base = df.where(_all_not_null([z, y]))
    pa, pb = F.avg(_in_arm(z, 1, y)), F.avg(_in_arm(z, 0, y))
    na, nb = F.count(_in_arm(z, 1, y)), F.count(_in_arm(z, 0, y))
    se = F.sqrt(safe_div(pa * (1 - pa), na) + safe_div(pb * (1 - pb), nb))
    return base.agg(se.alias("standard_error"))


def wald_standard_error(df: DataFrame, z: str, x: str, y: str) -> DataFrame:
    """Heteroskedasticity-robust (un-debiased) standard error of the 2SLS
    slope: ``sqrt(sum(e^2 (z - zbar)^2)) / |sum((z - zbar)(x - xbar))|`` with
    ``e = y - a - b x``.  The first-pass moments come from one aggregate used
    as a single scalar subquery (a struct), so the data is read twice in all
    and nothing returns to the driver."""
    base = df.where(_all_not_null([z, x, y]))
    m = base.select(F.struct(
        F.avg(q(z)).alias("zbar"), F.avg(q(x)).alias("xbar"), F.avg(q(y)).alias("ybar"),
        safe_div(F.covar_samp(q(z), q(y)), F.covar_samp(q(z), q(x))).alias("b"))).scalar()
    b = m["b"]
    a = m["ybar"] - b * m["xbar"]
    e = q(y) - a - b * q(x)
    dz = q(z) - m["zbar"]
    num = F.sqrt(F.sum(e * e * dz * dz))
    den = F.abs(F.sum(dz * (q(x) - m["xbar"])))
    return base.agg(safe_div(num, den).alias("standard_error"))
