"""One linear model per category: regress a user's own share of a category
on the community shares, forecast, score, and save/load the model family.

Ordinary least squares needs only means and covariances: one aggregate over
the training rows gives those of all features and targets, and the small
systems are solved together on the driver.  The models are Spark ML's.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
from pyspark.ml.common import _py2java
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.columns import md5_unit, q, row_sum
from ..plans.guards import materialize

LABEL, FEATURE, PREDICT = "label_", "c_", "_predict"


def regression_inputs(persona_df: DataFrame, categories: Sequence[str], key: str = "user") -> DataFrame:
    """``user, label_<k>..., c_<k>...`` all as doubles."""
    return persona_df.select(q(key), *[q(k).cast("double").alias(LABEL + k) for k in categories],
                             *[q(FEATURE + k).cast("double").alias(FEATURE + k) for k in categories])


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def hash_split_column(key: str, train_fraction: float = 0.8, seed: int = 0):
    """``'train'`` / ``'test'`` from an MD5 bucket of the key: the same rows
    land in the same part under any partitioning, order or re-run."""
    return F.when(md5_unit(key, seed) < F.lit(train_fraction), F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, key: str = "user", train_fraction: float = 0.8,
               seed: int = 0) -> tuple[DataFrame, DataFrame]:
    part = df.withColumn("_part", hash_split_column(key, train_fraction, seed))
    return (part.where(F.col("_part") == "train").drop("_part"),
            part.where(F.col("_part") == "test").drop("_part"))


def design_features(categories: Sequence[str], drop: str | None = None) -> list[str]:
    """Feature columns of an identifiable model.  The shares of a user add up
    to 1, so beside an intercept one category (``drop``, the last unless
    named) is left out."""
    gone = categories[-1] if drop is None else drop
    return [FEATURE + k for k in categories if k != gone]


def prepare_model_data(persona_df: DataFrame, categories: Sequence[str], train_fraction: float = 0.8,
                       seed: int = 0, key: str = "user", drop: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: targets and features as doubles, the ``c_`` shares of
    :func:`design_features` assembled into ``features``, split by an MD5 bucket
    of the key."""
    inputs = assemble(regression_inputs(persona_df, categories, key), design_features(categories, drop))
    return hash_split(inputs, key, train_fraction, seed)


def moments(df: DataFrame, features: Sequence[Column], targets: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means of features and targets, and the features' covariances with each
    other and with the targets: one aggregate, whatever their number.  Rows
    with a null in any of them are left out."""
    x, y = [f"x{i}" for i in range(len(features))], [f"y{i}" for i in range(len(targets))]
    rows = df.select(*[c.cast("double").alias(n) for c, n in zip(features, x)],
                     *[q(t).cast("double").alias(n) for t, n in zip(targets, y)]).dropna()
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x) + len(y))]
    both = x + y
    got = rows.agg(*[F.avg(c) for c in both], *[F.covar_pop(both[i], both[j]) for i, j in pairs]).first()
    if got[0] is None:
        raise ValueError("no rows to fit")
    cov = np.zeros((len(x), len(both)))
    for (i, j), value in zip(pairs, got[len(both):]):
        cov[i, j] = value
        if j < len(x):
            cov[j, i] = value
    return np.array(got[:len(both)]), cov[:, :len(x)], cov[:, len(x):]


def least_squares(mean: np.ndarray, xx: np.ndarray, xy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (features x targets) and intercepts of all targets, from
    one factorisation.  A feature without spread gets 0; features that depend
    on each other have no unique coefficients and raise."""
    p = len(xx)
    out = np.zeros(xy.shape)
    live = np.flatnonzero(np.diag(xx) > 0)
    if len(live):
        scale = np.sqrt(np.diag(xx)[live])
        corr = xx[np.ix_(live, live)] / np.outer(scale, scale)
        if np.linalg.matrix_rank(corr, tol=1e-10, hermitian=True) < len(live):
            raise ValueError("the features depend on each other: leave one out")
        out[live] = np.linalg.solve(corr, xy[live] / scale[:, None]) / scale[:, None]
    return out, mean[p:] - mean[:p] @ out


def fit_targets(train: DataFrame, targets: Sequence[str], features_col: str = "features",
                checkpoint: bool = True, **lr_params) -> dict[str, LinearRegressionModel]:
    """One linear model per target column (``label_<k>``).

    Ordinary least squares of all targets come from one aggregate over the
    training rows.  With ``lr_params`` (regularisation, say) each target is
    fitted by Spark ML's ``LinearRegression`` on rows written once."""
    if lr_params:
        data = materialize(train, "train") if checkpoint else train
        return {t: LinearRegression(featuresCol=features_col, labelCol=t, predictionCol="prediction", **lr_params).fit(data)
                for t in targets}
    size = train.schema[features_col].metadata.get("ml_attr", {}).get("num_attrs")
    if size is None:
        size = len(train.select(features_col).where(q(features_col).isNotNull()).first()[0])
    values = vector_to_array(q(features_col))
    coefs, intercepts = least_squares(*moments(train, [values[i] for i in range(size)], targets))
    return {t: _model(train.sparkSession, coefs[:, i], float(intercepts[i]), features_col, t)
            for i, t in enumerate(targets)}


def _model(spark: SparkSession, coefs: np.ndarray, intercept: float, features_col: str, target: str) -> LinearRegressionModel:
    """A Spark ML model with these numbers, to transform with, save and load."""
    params = LinearRegression(featuresCol=features_col, labelCol=target, predictionCol="prediction")
    vector = _py2java(spark.sparkContext, Vectors.dense(coefs))
    model = LinearRegressionModel(JavaWrapper._new_java_obj("org.apache.spark.ml.regression.LinearRegressionModel",
                                                            params.uid, vector, intercept))
    return model.setFeaturesCol(features_col).setPredictionCol("prediction")


def coefficients(spark: SparkSession, models: dict[str, LinearRegressionModel],
                 feature_names: Sequence[str]) -> DataFrame:
    """``target, feature, coefficient`` (intercept as feature ``intercept``).
    The models are a few numbers each; the table is built from them."""
    rows = []
    for target, m in models.items():
        rows += [(target, f, float(c)) for f, c in zip(feature_names, m.coefficients.toArray())]
        rows.append((target, "intercept", float(m.intercept)))
    schema = StructType([StructField("target", StringType()), StructField("feature", StringType()),
                         StructField("coefficient", DoubleType())])
    return spark.createDataFrame(rows, schema)


def forecast(models: dict[str, LinearRegressionModel], df: DataFrame) -> DataFrame:
    """Adds ``<k>_predict`` for every model by chaining ``transform`` on the
    same frame: no joins, so repeated users cannot multiply rows."""
    out = df
    for target, m in models.items():
        name = target[len(LABEL):] if target.startswith(LABEL) else target
        out = m.copy().setPredictionCol(name + PREDICT).transform(out)
    return out


def forecast_error(df: DataFrame, categories: Sequence[str], actual_prefix: str = LABEL) -> DataFrame:
    """Per row ``<k>_diff_square`` and ``total_difference_square``.

    ``actual_prefix`` picks the column compared with ``<k>_predict``:
    ``label_`` (the modelled variable) by default; ``c_`` compares the
    community share instead."""
    sq = {f"{k}_diff_square": F.pow(q(actual_prefix + k) - q(k + PREDICT), 2) for k in categories}
    out = df.withColumns(sq)
    return out.withColumn("total_difference_square", row_sum(list(sq)))


def score(errors: DataFrame, categories: Sequence[str]) -> DataFrame:
    """One row: mean of the per-row total squared error and the RMSE of each
    target."""
    return errors.agg(F.avg("total_difference_square").alias("mean_total_squared_error"),
                      *[F.sqrt(F.avg(q(f"{k}_diff_square"))).alias(f"rmse_{k}") for k in categories])


def save_models(models: dict[str, LinearRegressionModel], base: str, version: str) -> list[str]:
    """Save under ``base/version/<target>``; existing models are replaced."""
    paths = []
    for target, m in models.items():
        path = f"{base.rstrip('/')}/{version}/{_safe(target)}"
        m.write().overwrite().save(path)
        paths.append(path)
    return paths


def load_models(base: str, version: str, targets: Sequence[str]) -> dict[str, LinearRegressionModel]:
    """Load in the caller's target order (never in directory order)."""
    return {t: LinearRegressionModel.load(f"{base.rstrip('/')}/{version}/{_safe(t)}") for t in targets}


def _safe(name: str) -> str:
    """A path segment of its own for every name."""
    return name.replace("_", "__").replace("/", "_-")
