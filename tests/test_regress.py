import math

from pyspark.sql import functions as F

from cohortlab.operators import regress as R
from cohortlab.plans.guards import plan_text
from cohortlab.session import shared_dir


def _persona(spark, n=400):
    rows = []
    for i in range(n):
        a = (i % 7) / 7.0
        rows.append((f"u{i}", a, 1 - a, 0.3 * a + 0.1, 0.9 - 0.3 * a))
    return spark.createDataFrame(rows, "user string, A double, B double, c_A double, c_B double")


def test_hash_split_stable(spark):
    df = _persona(spark)
    a = {r.user: r.p for r in df.select("user", R.hash_split_column("user", 0.8, 0).alias("p")).collect()}
    b = {r.user: r.p for r in df.repartition(5).select("user", R.hash_split_column("user", 0.8, 0).alias("p")).collect()}
    assert a == b
    share = sum(v == "train" for v in a.values()) / len(a)
    assert 0.7 < share < 0.9


def test_fit_forecast_save_load(spark):
    cats = ["A", "B"]
    inputs = R.assemble(R.regression_inputs(_persona(spark), cats), ["c_A"])
    train, test = R.hash_split(inputs, "user")
    models = R.fit_targets(train, ["label_A", "label_B"])
    coef = {(r.target, r.feature): r.coefficient for r in R.coefficients(spark, models, ["c_A"]).collect()}
    assert math.isclose(coef[("label_A", "c_A")], 1 / 0.3, rel_tol=1e-6)
    fc = R.forecast(models, test)
    assert "Join" not in plan_text(fc.drop("features"))
    err = R.forecast_error(fc, cats)
    sc = R.score(err, cats).first()
    assert sc.mean_total_squared_error < 1e-10
    base = shared_dir(spark, "models-test")
    R.save_models(models, base, "v1")
    loaded = R.load_models(base, "v1", ["label_A", "label_B"])
    assert list(loaded) == ["label_A", "label_B"]
    assert all(math.isclose(loaded[t].intercept, models[t].intercept) for t in loaded)


def test_prepare_model_data(spark):
    train, test = R.prepare_model_data(_persona(spark), ["A", "B"])
    assert train.count() + test.count() == 400
    assert "features" in train.columns and "label_A" in train.columns


def test_coefficients_do_not_depend_on_partitioning(spark):
    rows = [(f"u{i}", *[x / 100 for x in (i % 50, 30 - i % 30, 70 + i % 30 - i % 50)],
             *[x / 100 for x in ((7 * i) % 41, (3 * i) % 37, 100 - (7 * i) % 41 - (3 * i) % 37)]) for i in range(300)]
    df = spark.createDataFrame(rows, "user string, A double, B double, D double, c_A double, c_B double, c_D double")
    cats, fits = ["A", "B", "D"], []
    for parts in (1, 7):
        train, _ = R.prepare_model_data(df.repartition(parts), cats)
        models = R.fit_targets(train, [R.LABEL + k for k in cats])
        fits.append({(r.target, r.feature): r.coefficient
                     for r in R.coefficients(spark, models, R.design_features(cats)).collect()})
    assert len(fits[0]) == 9 and ("label_A", "c_D") not in fits[0]
    assert all(abs(v - fits[1][k]) < 1e-9 for k, v in fits[0].items())


def test_model_paths_differ():
    assert len({R._safe(x) for x in ("a/b", "a_b", "a_-b", "a__b", "a_/b")}) == 5


def _features(spark, n=300):
    import random
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        x = [rnd.random(), rnd.gauss(2, 1), rnd.random() * 1e-3]
        rows.append((f"u{i}", *x, x[0] * 2 - x[1] + rnd.random(), x[2] * 500 + rnd.random(), 3.0))
    return R.assemble(spark.createDataFrame(rows, "user string, a double, b double, c double, label_p double, label_q double, label_r double"),
                      ["a", "b", "c"])


def test_one_pass_equals_one_fit_per_target(spark):
    from pyspark.ml.regression import LinearRegression
    train, targets = _features(spark), ["label_p", "label_q", "label_r"]
    models = R.fit_targets(train, targets)
    for t in targets:
        ml = LinearRegression(featuresCol="features", labelCol=t, solver="normal", tol=1e-12).fit(train)
        assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(models[t].coefficients, ml.coefficients))
        assert math.isclose(models[t].intercept, ml.intercept, rel_tol=1e-9, abs_tol=1e-9)


def test_a_far_off_feature_keeps_its_digits(spark):
    import numpy as np
    df = _features(spark).withColumn("b", F.col("b") + 1e4).drop("features")
    got = R.fit_targets(R.assemble(df, ["a", "b", "c"]), ["label_p"])["label_p"]
    x = np.array([[r.a, r.b, r.c, 1.0] for r in df.collect()])
    y = np.array([r.label_p for r in df.collect()])
    left = y - x @ np.append(got.coefficients.toArray(), got.intercept)
    assert abs(left.sum()) < 1e-7 and np.abs((x[:, :3] - x[:, :3].mean(axis=0)).T @ left).max() < 1e-7


def test_jobs_do_not_grow_with_the_targets(spark):
    train = _features(spark).cache()
    train.count()
    sc, jobs = spark.sparkContext, []
    for targets in (["label_p"], ["label_p", "label_q", "label_r"]):
        sc.setJobGroup(f"fit-{len(targets)}", "")
        R.fit_targets(train, targets)
        jobs.append(len(sc.statusTracker().getJobIdsForGroup(f"fit-{len(targets)}")))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_dependent_and_constant_features(spark):
    import pytest
    df = _features(spark).withColumn("d", F.col("a") * 2 + F.col("c")).withColumn("one", F.lit(1.0)).drop("features")
    with pytest.raises(ValueError, match="depend"):
        R.fit_targets(R.assemble(df, ["a", "c", "d"]), ["label_p"])
    assert R.fit_targets(R.assemble(df, ["a", "one"]), ["label_p"])["label_p"].coefficients[1] == 0
