"""Registered queries: regress a user's own shares on the community shares."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import q, round_doubles
from ..operators import persona as P
from ..operators import regress as R
from ..plans.guards import materialize
from ..session import shared_dir
from ..sources import views
from . import persona_queries

CATS = views.TX_CATEGORIES
FEATURES = R.design_features(CATS)
TARGETS = [R.LABEL + k for k in CATS]
TRAIN_FRACTION, SEED = 0.8, 0


def _inputs(spark, sf_dir):
    pers = P.persona(P.both_sides(views.tx(spark, sf_dir)), 1, 12, CATS)
    return R.regression_inputs(pers, CATS)


def _split(spark, sf_dir):
    """Train and test parts of the assembled inputs.  The inputs are written
    once to the shared folder, so fitting and forecasting read the same files
    instead of recomputing the persona for each part."""
    inputs = materialize(R.assemble(_inputs(spark, sf_dir), FEATURES), "regression-inputs")
    return R.hash_split(inputs, "user", TRAIN_FRACTION, SEED)


def _fitted(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return R.fit_targets(train, TARGETS, checkpoint=False), test


def q_regression_inputs(spark, sf_dir):
    return round_doubles(_inputs(spark, sf_dir))


def q_hash_split(spark, sf_dir):
    return _inputs(spark, sf_dir).select("user", R.hash_split_column("user", TRAIN_FRACTION, SEED).alias("part"))


def q_fit_targets(spark, sf_dir):
    models, _ = _fitted(spark, sf_dir)
    return round_doubles(R.coefficients(spark, models, FEATURES))


def q_fit_single_feature(spark, sf_dir):
    """Each target on its own community share, on the training part."""
    train, _ = _split(spark, sf_dir)
    fits = [F.struct(F.lit(R.LABEL + k).alias("target"), F.regr_slope(q(R.LABEL + k), q(R.FEATURE + k)).alias("slope"),
                     F.regr_intercept(q(R.LABEL + k), q(R.FEATURE + k)).alias("intercept")) for k in CATS]
    return round_doubles(train.agg(F.array(*fits).alias("fits")).select(F.inline("fits")))


def _forecast(spark, sf_dir):
    models, test = _fitted(spark, sf_dir)
    return R.forecast(models, test).drop("features")


def q_forecast(spark, sf_dir):
    return round_doubles(_forecast(spark, sf_dir))


def q_forecast_error(spark, sf_dir):
    return round_doubles(R.forecast_error(_forecast(spark, sf_dir), CATS))


def q_forecast_score(spark, sf_dir):
    return round_doubles(R.score(R.forecast_error(_forecast(spark, sf_dir), CATS), CATS))


def q_forecast_score_inputs(spark, sf_dir):
    """Community shares, instead of the modelled shares, against the forecast."""
    return round_doubles(R.score(R.forecast_error(_forecast(spark, sf_dir), CATS, R.FEATURE), CATS))


def q_model_roundtrip(spark, sf_dir):
    models, _ = _fitted(spark, sf_dir)
    base = shared_dir(spark, "models")
    R.save_models(models, base, "v1")
    loaded = R.load_models(base, "v1", TARGETS)
    return round_doubles(R.coefficients(spark, loaded, FEATURES))


QUERIES = {
    "regression_inputs": q_regression_inputs,
    "hash_split": q_hash_split,
    "fit_targets": q_fit_targets,
    "fit_single_feature": q_fit_single_feature,
    "forecast": q_forecast,
    "forecast_error": q_forecast_error,
    "forecast_score": q_forecast_score,
    "forecast_score_inputs": q_forecast_score_inputs,
    "model_roundtrip": q_model_roundtrip,
}

_PERSONA = persona_queries.persona_sql(None)
_INPUTS = ("SELECT \"user\", " + ", ".join(f'"{k}" AS "label_{k}"' for k in CATS) + ", "
           + ", ".join(f'"c_{k}"' for k in CATS) + f" FROM ({_PERSONA}) p")
_INPUTS_R = ("SELECT \"user\", " + ", ".join(f'round("label_{k}", 6) AS "label_{k}"' for k in CATS) + ", "
             + ", ".join(f'round("c_{k}", 6) AS "c_{k}"' for k in CATS) + f" FROM ({_INPUTS}) r")
_UNIT = "(('0x' || substr(md5(\"user\" || ':' || '{seed}'), 1, 8))::BIGINT / 4294967296.0)".format(seed=SEED)


def _least_squares() -> str:
    """CTEs that fit all targets by residuals: each feature in turn is taken
    out of the later features and of the targets.  ``z<n>`` holds every row's
    residuals ``x<j>`` and one row's worth of means and slopes."""
    xs, ys = range(len(FEATURES)), range(len(TARGETS))
    ctes = [f"d AS MATERIALIZED (SELECT *, {_UNIT} < {TRAIN_FRACTION} AS train FROM ({_INPUTS}) i)",
            "m AS MATERIALIZED (SELECT " + ", ".join(
                [f'avg("{f}") AS mx{j}' for j, f in enumerate(FEATURES)]
                + [f'avg("{t}") AS my{t_}' for t_, t in enumerate(TARGETS)]) + " FROM d WHERE train)",
            "z0 AS MATERIALIZED (SELECT d.*, " + ", ".join(
                [f'"{f}" - mx{j} AS x{j}' for j, f in enumerate(FEATURES)]
                + [f'"{t}" - my{t_} AS y{t_}' for t_, t in enumerate(TARGETS)]) + " FROM d, m)"]
    for i in xs:
        later = [j for j in xs if j > i]
        ctes.append(f"s{i} AS MATERIALIZED (SELECT " + ", ".join(
            [f"sum(x{i} * x{j}) / sum(x{i} * x{i}) AS g{i}_{j}" for j in later]
            + [f"sum(x{i} * y{t}) / sum(x{i} * x{i}) AS b{t}_{i}" for t in ys]) + f" FROM z{i} WHERE train)")
        ctes.append(f"z{i + 1} AS MATERIALIZED (SELECT z{i}.* REPLACE (" + ", ".join(
            [f"x{j} - g{i}_{j} * x{i} AS x{j}" for j in later]
            + [f"y{t} - b{t}_{i} * x{i} AS y{t}" for t in ys]) + f") FROM z{i}, s{i})")
    return ",\n".join(ctes)


def _coefficients_sql() -> str:
    """Back-substitution of the slopes, from the last feature to the first."""
    n = len(FEATURES)
    ctes, rows = [], []
    at = "all_s"
    ctes.append(f"all_s AS MATERIALIZED (SELECT * FROM m, {', '.join(f's{i}' for i in range(n))})")
    for j in reversed(range(n)):
        cols = ", ".join(f"b{t}_{j}" + "".join(f" - g{j}_{i} * c{t}_{i}" for i in range(j + 1, n)) + f" AS c{t}_{j}"
                         for t in range(len(TARGETS)))
        ctes.append(f"c{j} AS MATERIALIZED (SELECT *, {cols} FROM {at})")
        at = f"c{j}"
    for t, target in enumerate(TARGETS):
        rows += [f"SELECT '{target}' AS target, '{f}' AS feature, round(c{t}_{j}, 6) AS coefficient FROM {at}"
                 for j, f in enumerate(FEATURES)]
        rows.append(f"SELECT '{target}', 'intercept', round(my{t}"
                    + "".join(f" - c{t}_{j} * mx{j}" for j in range(n)) + f", 6) FROM {at}")
    return f"WITH {_least_squares()},\n" + ",\n".join(ctes) + "\n" + " UNION ALL ".join(rows)


def _forecast_sql(tail: str) -> str:
    """The test rows with their forecasts: a target less what is left of it."""
    predicted = ", ".join(f'"label_{k}" - y{t} AS "{k}_predict"' for t, k in enumerate(CATS))
    held = ", ".join(f'"{c}"' for c in ["user", *TARGETS, *[R.FEATURE + k for k in CATS]])
    return (f"WITH {_least_squares()},\nf AS (SELECT {held}, {predicted} FROM z{len(FEATURES)} WHERE NOT train)\n" + tail)


def _rounded(cols: list[str]) -> str:
    return ", ".join(f'round("{c}", 6) AS "{c}"' for c in cols)


def _errors_sql(prefix: str) -> str:
    squares = {k: f'("{prefix}{k}" - "{k}_predict") * ("{prefix}{k}" - "{k}_predict")' for k in CATS}
    return ("SELECT *, " + ", ".join(f'{e} AS "{k}_diff_square"' for k, e in squares.items()) + ", "
            + " + ".join(squares.values()) + " AS total_difference_square FROM f")


def _score_sql(prefix: str) -> str:
    return _forecast_sql("SELECT round(avg(total_difference_square), 6) AS mean_total_squared_error, "
                         + ", ".join(f'round(sqrt(avg("{k}_diff_square")), 6) AS "rmse_{k}"' for k in CATS)
                         + f" FROM ({_errors_sql(prefix)}) e")


_SHOWN = [*TARGETS, *[R.FEATURE + k for k in CATS], *[k + R.PREDICT for k in CATS]]

ORACLE = {
    "regression_inputs": _INPUTS_R,
    "hash_split": f"""SELECT "user", CASE WHEN {_UNIT} < {TRAIN_FRACTION} THEN 'train' ELSE 'test' END AS part
        FROM ({_INPUTS}) i""",
    "fit_single_feature": " UNION ALL ".join(
        f"""SELECT 'label_{k}' AS target, round(regr_slope("label_{k}", "c_{k}"), 6) AS slope,
                   round(regr_intercept("label_{k}", "c_{k}"), 6) AS intercept
            FROM ({_INPUTS}) i WHERE {_UNIT} < {TRAIN_FRACTION}""" for k in CATS),
    "fit_targets": _coefficients_sql(),
    "model_roundtrip": _coefficients_sql(),
    "forecast": _forecast_sql(f'SELECT "user", {_rounded(_SHOWN)} FROM f'),
    "forecast_error": _forecast_sql(
        f'SELECT "user", {_rounded([*_SHOWN, *[k + "_diff_square" for k in CATS], "total_difference_square"])} '
        f"FROM ({_errors_sql(R.LABEL)}) e"),
    "forecast_score": _score_sql(R.LABEL),
    "forecast_score_inputs": _score_sql(R.FEATURE),
}
