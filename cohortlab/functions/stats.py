"""Student-t tail probabilities as an Arrow-batched pandas UDF.

Spark has no built-in t distribution.  With ``t = sqrt(df) * tan(angle)`` the
density becomes a power of the cosine, so the two-sided p-value is

    integral of cos(u) ** (df - 1) from angle to pi/2, over the same from 0,

and no gamma function is needed.  Both integrals use one double-exponential
rule, which bears the steep integrand of large ``df`` and the unbounded one of
``df`` below 1 at the ends.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The rule on (0, 1): share of the way still to go, its mirror, and the weights.
_STEPS = np.linspace(-4.5, 4.5, 721)
_LEFT = 1.0 / (1.0 + np.exp(np.pi * np.sinh(_STEPS)))
_GONE = _LEFT[::-1]
_WEIGHTS = np.pi * np.cosh(_STEPS) * _LEFT * _GONE


def _cosine_power(angle: float, width: float, power: float) -> float:
    """Integral of ``cos ** power`` over the ``width`` between ``angle`` and
    pi/2, up to the rule's step.  Near either end the small angle is the exact one."""
    from_end = width * _GONE
    with np.errstate(divide="ignore"):
        log_cos = np.where(from_end < 0.5, np.log(np.sin(from_end)),
                           0.5 * np.log1p(-np.sin(angle + width * _LEFT) ** 2))
    return float(width * np.sum(_WEIGHTS * np.exp(power * log_cos)))


def t_two_sided_p(t: float, df: float) -> float:
    if t is None or df is None or not np.isfinite(t) or not df or df <= 0:
        return float("nan")
    angle, width = math.atan2(abs(t), math.sqrt(df)), math.atan2(math.sqrt(df), abs(t))
    return min(1.0, _cosine_power(angle, width, df - 1.0) / _cosine_power(0.0, math.pi / 2, df - 1.0))


@F.pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, df: pd.Series) -> pd.Series:
    """Two-sided p-value column from t and degrees-of-freedom columns."""
    out = [t_two_sided_p(float(a), float(b)) if pd.notna(a) and pd.notna(b) else float("nan")
           for a, b in zip(t, df)]
    return pd.Series(out, dtype="float64")
