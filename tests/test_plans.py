import datetime as dt
import os

from pyspark.sql import functions as F

from cohortlab.operators import persona as P
from cohortlab.plans.guards import broadcast_if_bounded, hot_keys, is_bounded, materialize, plan_text, salted_lookup_join
from test_persona import CATS, SCHEMA, _brute, _close

T0 = dt.datetime(2020, 1, 1)


def _hub_rows(n=600):
    """User 'hub' is one end of a third of all transactions."""
    rows = []
    for i in range(n):
        other = f"u{i % 40}"
        a = "hub" if i % 3 == 0 else f"u{(i * 7) % 40}"
        rows.append((a, other, T0 + dt.timedelta(days=(i * 13) % 500), CATS[i % 3]))
    return rows


def test_salted_lookup_spreads_hot_key(spark):
    big = spark.createDataFrame([("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(3000)],
                                "k string, v long")
    small = spark.createDataFrame([("hot", 1)] + [(f"k{i}", 2) for i in range(3000)], "key string, w long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        j = salted_lookup_join(big, small, "k", "key", "inner", buckets=8)
        hot = j.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert j.count() == 6000
        assert len(hot) > 1 and max(r["count"] for r in hot) < 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_persona_with_hub_matches_brute_force(spark):
    rows = _hub_rows()
    edges = P.both_sides(spark.createDataFrame(rows, SCHEMA))
    selfp, comm = _brute(rows, 1, 12)
    got = {r.user: r for r in P.persona(edges, 1, 12, CATS).collect()}
    assert set(got) == set(selfp)
    for u in selfp:
        assert all(_close(got[u][k], selfp[u][k] or 0.0) for k in CATS)
        assert all(_close(got[u]["c_" + k], (comm.get(u) or {}).get(k) or 0.0) for k in CATS)


def test_broadcast_only_when_bounded(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).withColumnRenamed("id", "k")
        small = spark.range(10).withColumnRenamed("id", "k")
        assert "BroadcastHashJoin" in plan_text(left.join(broadcast_if_bounded(small, 100), "k"))
        assert "BroadcastHashJoin" not in plan_text(left.join(broadcast_if_bounded(left.select("k"), 100), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_materialize_writes_under_checkpoint_dir(spark):
    df = materialize(spark.range(5), "unit")
    assert df.count() == 5
    base = spark.sparkContext.getCheckpointDir().replace("file:", "")
    assert all(base in f for f in df.inputFiles())
    assert "Scan parquet" in plan_text(df)


def test_targeted_salting_splits_only_hot_keys(spark):
    big = spark.createDataFrame([("hot", i) for i in range(3000)] + [(f"k{i}", i) for i in range(300)],
                                "k string, v long")
    small = (big.groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n"))
                .withColumn("w", F.lit(1)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        j = salted_lookup_join(big, small, "k", "key", "inner", buckets=8, count_col="n", hot_rows=100)
        assert j.count() == 3300
        hot = j.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(hot) > 1
        plan = plan_text(j)
        assert "BroadcastHashJoin" in plan      # the bounded hot-key list
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _task_rows(spark, hot, ordinary, nulls=0):
    """Rows per task of a left lookup whose hot key has ``hot`` rows."""
    rows = [("hot", i) for i in range(hot)] + [(f"k{i}", i) for i in range(ordinary)] + [(None, i) for i in range(nulls)]
    big = spark.createDataFrame(rows, "k string, v long")
    small = big.where("k is not null").groupBy(F.col("k").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "200"}
    before = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        j = salted_lookup_join(big, materialize(small, "unit-keys"), "k", "key", "left", count_col="n", hot_rows=500)
        got = j.groupBy("k", F.spark_partition_id().alias("p")).count().collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(r["count"] for r in got) == len(rows)
    return {key: [r["count"] for r in got if r["k"] == key] for key in ("hot", None)}


def test_hot_key_parts_grow_with_its_rows(spark):
    few, many = _task_rows(spark, 2000, 300)["hot"], _task_rows(spark, 20000, 300)["hot"]
    assert 3 <= len(few) <= 4 and len(many) >= 8 * len(few)
    assert max(many) <= 3 * max(few)


def test_rows_without_a_key_are_spread(spark):
    nulls = _task_rows(spark, 600, 300, nulls=3000)[None]
    assert len(nulls) > 100 and max(nulls) < 100


def test_threshold_is_raised_until_the_hot_list_is_short(spark):
    per_key = spark.range(100).select("id", (F.col("id") * 10).alias("n"))
    assert hot_keys(per_key, "id", "n", 10, max_keys=1000).count() == 98
    short = hot_keys(per_key, "id", "n", 10, max_keys=95).collect()
    assert len(short) == 89 and max(r["_parts"] for r in short) == 10


def test_broadcast_bound_counts_bytes(spark):
    long = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s"))
    assert is_bounded(long, 10) and not is_bounded(long, 9) and not is_bounded(long, 10, max_bytes=5000)


def test_within_lifetime_with_hub_matches_brute_force(spark):
    from test_persona import _brute_within
    rows = _hub_rows()
    edges = P.both_sides(spark.createDataFrame(rows, SCHEMA))
    want = _brute_within(rows, 1, 12)
    got = {r.user: r for r in P.community_persona(edges, 1, 12, CATS,
                                                  within_user_lifetime=True).collect()}
    assert set(got) == set(want)
    for u in want:
        assert all(_close(got[u]["c_" + k], want[u][k]) for k in CATS)


def test_within_lifetime_salted_branch(spark, monkeypatch):
    from test_persona import _brute_within
    monkeypatch.setattr(P, "HOT_KEY_ROWS", 10)      # every busy friend counts as hot
    rows = _hub_rows()
    edges = P.both_sides(spark.createDataFrame(rows, SCHEMA))
    want = _brute_within(rows, 1, 12)
    got = {r.user: r for r in P.community_persona(edges, 1, 12, CATS,
                                                  within_user_lifetime=True).collect()}
    assert set(got) == set(want)
    for u in want:
        assert all(_close(got[u]["c_" + k], want[u][k]) for k in CATS)


def test_spread_if_narrow(spark):
    from cohortlab.plans.guards import spread_if_narrow
    target = spark.sparkContext.defaultParallelism
    narrow = spark.range(100).coalesce(1)
    assert spread_if_narrow(narrow).rdd.getNumPartitions() == target
    wide = spark.range(100).repartition(target + 3)
    assert spread_if_narrow(wide) is wide


def test_scratch_leaves_the_shared_folder_empty(spark, tmp_path):
    import os
    import __spark_entry__ as E
    from cohortlab.session import scratch
    from conftest import SF_SMALL
    base = spark.sparkContext.getCheckpointDir() or materialize(spark.range(1), "x") and spark.sparkContext.getCheckpointDir()
    folder = base.replace("file:", "")
    for key in ("persona", "friend_activity", "label_documents_join_path", "forecast", "model_roundtrip"):
        before = set(os.listdir(folder))
        with scratch(spark):
            rows = E.queries()[key](spark, SF_SMALL).count()
            assert rows and set(os.listdir(folder)) > before
        assert set(os.listdir(folder)) == before, key


def test_discard_deletes_one_step(spark):
    import os
    from cohortlab.plans.guards import discard
    step = materialize(spark.range(3), "step")
    place = step.written_folder.replace("file:", "")
    assert os.path.isdir(place)
    discard(step)
    assert not os.path.exists(place)
