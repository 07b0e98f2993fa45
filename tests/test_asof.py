"""Point-in-time joins against a row-by-row search."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import asof
from millrace.operators.asof import as_of_join, latest_per_entity

T0 = datetime(2024, 1, 1)
SPINE = "id int, k string, ts timestamp_ntz"
LOG = "k string, f_ts timestamp_ntz, created timestamp_ntz, a int, b string"


def at(minutes):
    return None if minutes is None else T0 + timedelta(minutes=minutes)


def make(seed, entities=("x", "y", None), n=120):
    rnd = random.Random(seed)
    spine = [(i, rnd.choice(entities), at(rnd.choice([None, *range(40)]))) for i in range(n)]
    log = [
        (rnd.choice(entities), at(rnd.choice([None, *range(40)])), at(rnd.randrange(1000)), rnd.choice([None, i]), f"b{i}")
        for i in range(n)
    ]
    return spine, log


def expected(spine, log, ttl=None):
    out = {}
    for i, k, ts in spine:
        seen = [r for r in log if k is not None and ts is not None and r[0] == k and r[1] is not None and r[1] <= ts]
        best = max(seen, key=lambda r: (r[1], r[2]), default=None)
        if best and ttl is not None and best[1] < ts - ttl:
            best = None
        out[i] = (best[3], best[4]) if best else (None, None)
    return out


@pytest.mark.parametrize("hot_rows", [None, 1, 60])
@pytest.mark.parametrize("ttl", [None, timedelta(minutes=3)])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_row_by_row_search(spark, hot_rows, ttl, seed):
    spine, log = make(seed)
    got = as_of_join(
        spark.createDataFrame(spine, SPINE), spark.createDataFrame(log, LOG), ["k"], "ts", "f_ts", ["a", "b"],
        created_ts="created", ttl=ttl, hot_rows=hot_rows,
    )
    assert got.columns == ["id", "k", "ts", "a", "b"]
    assert {r.id: (r.a, r.b) for r in got.collect()} == expected(spine, log, ttl)


def test_one_entity_holds_most_rows(spark):
    """The hot entity is cut at many moments, the rest stays in the plain plan; both agree."""
    n = 6000
    spine = spark.range(n).selectExpr(
        "cast(id as int) as id", "case when id % 10 < 8 then 'hot' else 'k' || id % 7 end as k",
        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 7919 % 100000) as ts",
    )
    log = spark.range(n).selectExpr(
        "case when id % 10 < 8 then 'hot' else 'k' || id % 7 end as k",
        "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id * 104729 % 100000) as f_ts",
        "cast(id as int) as a", "cast(id as string) as b",
    )
    args = (["k"], "ts", "f_ts", ["a", "b"])
    plain = as_of_join(spine, log, *args, hot_rows=None)
    sliced = as_of_join(spine, log, *args, hot_rows=2000)
    assert sliced.count() == n
    assert plain.exceptAll(sliced).count() == 0
    assert sliced.where("a is not null").count() > n / 2


def test_one_moment_holds_most_rows(spark):
    spine = spark.range(3000).selectExpr("cast(id as int) as id", "'hot' as k", "timestamp_ntz'2024-01-02' as ts")
    log = spark.range(3000).selectExpr(
        "'hot' as k", "timestamp_ntz'2024-01-01' as f_ts", "timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id) as c", "cast(id as int) as a"
    )
    got = as_of_join(spine, log, ["k"], "ts", "f_ts", ["a"], created_ts="c", hot_rows=10)
    assert [tuple(r) for r in got.groupBy("a").count().collect()] == [(2999, 3000)]


def test_never_looks_ahead(spark):
    spine, log = make(3)
    got = as_of_join(
        spark.createDataFrame(spine, SPINE), spark.createDataFrame(log, LOG), ["k"], "ts", "f_ts", ["a"], matched_ts="seen"
    )
    assert got.where("seen > ts").count() == 0
    assert got.count() == len(spine)


def test_own_nulls_are_kept(spark):
    spine = spark.createDataFrame([(1, "x", at(5))], SPINE)
    log = spark.createDataFrame([("x", at(1), at(1), 7, "old"), ("x", at(2), at(2), None, "new")], LOG)
    row = as_of_join(spine, log, ["k"], "ts", "f_ts", ["a", "b"]).first()
    assert (row.a, row.b) == (None, "new")


def test_ttl_bounds_are_inclusive(spark):
    spine = spark.createDataFrame([(1, "x", at(10)), (2, "x", at(11))], SPINE)
    log = spark.createDataFrame([("x", at(0), at(0), 7, "b")], LOG)
    got = as_of_join(spine, log, ["k"], "ts", "f_ts", ["a"], ttl=timedelta(minutes=10))
    assert {r.id: r.a for r in got.collect()} == {1: 7, 2: None}


def test_empty_sides(spark):
    spine, log = make(4)
    empty_log = spark.createDataFrame([], LOG)
    got = as_of_join(spark.createDataFrame(spine, SPINE), empty_log, ["k"], "ts", "f_ts", ["a"])
    assert got.count() == len(spine) and got.where("a is not null").count() == 0
    none = as_of_join(spark.createDataFrame([], SPINE), spark.createDataFrame(log, LOG), ["k"], "ts", "f_ts", ["a"])
    assert none.count() == 0


def test_plain_plan_shuffles_once(spark):
    spine, log = make(5)
    df = as_of_join(
        spark.createDataFrame(spine, SPINE), spark.createDataFrame(log, LOG), ["k"], "ts", "f_ts", ["a"], hot_rows=None
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_missing_keys_do_not_gather(spark):
    """Two views in a row, most spine rows without a key: all rows come back, unmatched."""
    spine = spark.range(2000).selectExpr("cast(id as int) as id", "case when id % 10 = 0 then 'x' end as k", "timestamp_ntz'2024-01-02' as ts")
    log = spark.createDataFrame([("x", at(1), at(1), 7, "b"), (None, at(1), at(1), 8, "n")], LOG)
    one = as_of_join(spine, log, ["k"], "ts", "f_ts", ["a"], hot_rows=50)
    two = as_of_join(one, log, ["k"], "ts", "f_ts", ["b"], hot_rows=50)
    assert two.count() == 2000
    assert two.where("k is null and (a is not null or b is not null)").count() == 0
    assert two.where("k = 'x' and a = 7 and b = 'b'").count() == 200


def test_two_views_take_one_shuffle_and_run_nothing(spark):
    """Two logs with two lifetimes: the rows of two single joins, one wide exchange, no job before the action."""
    spine, log = make(5)
    spine_df, log_df = spark.createDataFrame(spine, SPINE), spark.createDataFrame(log, LOG)
    other = log_df.select("k", F.col("f_ts").alias("when"), F.col("a").alias("c")).where("a % 2 = 0")
    logs = [
        asof.Log(log_df, "f_ts", {"a": "a", "b": "b"}, "created", timedelta(hours=3), "seen"),
        asof.Log(other, "when", {"c": "c"}, ttl=timedelta(hours=1)),
    ]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "building the join")
    both = {hot: asof.as_of_joins(spine_df, logs, ["k"], "ts", hot) for hot in (None, 3, 10)}
    assert tracker.getJobIdsForGroup("build") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    one = as_of_join(spine_df, log_df, ["k"], "ts", "f_ts", ["a", "b"], "created", timedelta(hours=3), "seen", hot_rows=None)
    want = as_of_join(one, other, ["k"], "ts", "when", ["c"], ttl=timedelta(hours=1), hot_rows=None).collect()
    for hot, got in both.items():
        assert sorted(map(str, got.select(*one.columns, "c").collect())) == sorted(map(str, want)), hot
    assert both[None]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_name_clash_is_refused(spark):
    spine, log = make(6)
    with pytest.raises(ValueError):
        as_of_join(spark.createDataFrame(spine, SPINE), spark.createDataFrame(log, LOG), ["k"], "ts", "f_ts", ["id"])


def test_latest_per_entity_is_stable_under_full_ties(spark):
    rows = [("x", at(1), at(1), i, "b") for i in range(5)]
    df = spark.createDataFrame(rows, LOG)
    for parts in (1, 3):
        got = latest_per_entity(df.repartition(parts), ["k"], "f_ts", ["a"], "created").first()
        assert got.a == 4
    assert latest_per_entity(df.where(F.lit(False)), ["k"], "f_ts", ["a"]).count() == 0
