"""Quality, merging, snapshots, warehouse, feature store, streaming and models on edge tables."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from millrace.operators import quality, schema, union
from millrace.operators.derive import total_services
from millrace.operators.expectations import Expectation, load_suite, unexpected_samples, validate
from millrace.plans import churn_definitions as churn
from millrace.plans import feature_store as fs
from millrace.plans import learning
from millrace.plans.customers import customer_view, merge_sources
from millrace.session import scratch_path
from millrace.sources import readers, snapshots, warehouse
from millrace.streaming.ingest import read_landed, read_quarantine, start_file_ingest
from millrace.streaming.push import read_offline, read_online, start_view_push

D = datetime(2024, 1, 1)


def test_clean_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`  A b` int, c int")
    assert schema.clean_names(df, {"A_b": "Ab"}).columns == ["ab", "c"]
    with pytest.raises(ValueError, match="collide"):
        schema.clean_names(spark.createDataFrame([(1, 2)], "a int, `a ` int"))
    with pytest.raises(ValueError, match="12 names for 2"):
        readers.read_extract(df)


def test_stacking_aligns_text_with_numbers(spark):
    left = spark.createDataFrame([(1, "n/a")], "id int, v string")
    right = spark.createDataFrame([(2, 5, True)], "id long, v int, extra boolean")
    out = union.stack_by_name(left, right)
    assert out.columns == ["id", "v", "extra"]
    assert {(r.id, r.v, r.extra) for r in out.collect()} == {(1, "n/a", None), (2, "5", True)}
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_merge_keeps_all_rows_and_left_order(spark):
    a = spark.createDataFrame([("1", 0, " ", "Yes")], "customerID string, SeniorCitizen int, TotalCharges string, Churn string")
    b = spark.createDataFrame([("1", 1, 0)], "customerID string, SeniorCitizen int, Churn int")
    out = merge_sources(a, b)
    assert out.columns == a.columns
    assert [tuple(r) for r in out.collect()] == [("1", "No", None, "Yes"), ("1", "Yes", None, "No")]


def test_quality_edge_tables(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert {(r.column_name, r.n_missing, r.pct_missing) for r in quality.missing(empty).collect()} == {("a", 0, None), ("b", 0, None)}
    assert quality.duplicates(empty, ["a"]).first().n_duplicates == 0
    nulls = spark.createDataFrame([(None, None), (None, None)], "a int, b string")
    assert quality.duplicates(nulls, ["a"]).first().n_duplicates == 1
    assert quality.iqr_outliers(nulls, ["a"]).first().is_binary is True
    assert quality.range_check(nulls, {"a": (0, 1)}).first().is_binary is True
    assert quality.set_check(nulls, {"b": ["x"]}).first().n_invalid == 2
    found = quality.invalid_values(spark.createDataFrame([("x",), ("y",), (None,)], "b string"), {"b": ["x"]})
    assert {(r.value, r.n) for r in found.collect()} == {("y", 1), (None, 1)}


def test_report_on_empty_and_short_lists(spark):
    empty = spark.createDataFrame([], "a int, b string, k string")
    rules = quality.Rules(ranges={"a": (0, 1)}, sets={"b": ["x"]}, key="k")
    assert quality.quality_report(empty, rules).count() >= 3
    df = spark.createDataFrame([(i, f"v{i % 6}", str(i % 9)) for i in range(20)], "a int, b string, k string")
    free = quality.Rules(key="k")
    listed = quality.quality_report(df, free).where("check_order = 5").collect()
    assert {(r.column_name, r.check, r.message, r.n, r.final) for r in listed} == {
        ("b", "values", "Unique values: 6, listed as rows.", 6, True), *(("b", "value", f"v{i}", 4 if i < 2 else 3, True) for i in range(6)),
    }
    strict = quality.Rules(sets={"b": ["v0"]}, key="missing_key")
    rows = quality.quality_report(df, strict).collect()
    report = {(r.column_name, r.check): r.message for r in rows}
    assert report[("b", "set")].endswith("Found: 5 different ones, listed as rows.")
    assert {(r.message, r.n) for r in rows if r.check == "invalid value"} == {(f"v{i}", 4 if i < 2 else 3) for i in range(1, 6)}
    assert report[("missing_key", "duplicates")] == "missing_key column not found."


def test_booleans_stack_with_numbers_as_numbers(spark):
    flags, numbers = spark.createDataFrame([(True,), (None,)], "x boolean"), spark.createDataFrame([(2,)], "x int")
    for both in (union.stack_by_name(flags, numbers), union.stack_by_name(numbers, flags)):
        assert both.dtypes == [("x", "int")] and sorted(str(r.x) for r in both.collect()) == ["1", "2", "None"]


def test_a_listed_value_is_no_message(spark):
    df = spark.createDataFrame([("not found",), ("out of",), ("not found",), ("x",), ("x",)] * 4, "b string")
    advised = quality.resolutions(quality.quality_report(df, quality.Rules())).where("check = 'value'").collect()
    assert len(advised) == 3 and {r.resolution for r in advised} == {quality.ADVICE["other"]}


def test_suites_and_sets_without_values_to_show(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    rules = [Expectation("expect_column_values_to_not_be_null", {"column": "b"})]
    assert unexpected_samples(df, rules).collect() == []
    assert quality.invalid_values(df, {"absent": ["x"]}).collect() == []


def test_cardinality_of_an_empty_table_and_of_signed_zeros(spark):
    empty = quality.cardinality(spark.createDataFrame([], "a int, b string")).collect()
    assert {(r.column_name, r.n_distinct, r.n_unique, r.n_rows) for r in empty} == {("a", 0, 0, 0), ("b", 0, 0, 0)}
    zeros = spark.createDataFrame([(0.0, None), (-0.0, "x")], "a double, b string")
    assert {(r.column_name, r.n_distinct, r.n_unique) for r in quality.cardinality(zeros).collect()} == {("a", 1, 1), ("b", 1, 2)}


def test_duplicate_marks_on_one_hot_key(spark):
    df = spark.range(2000).selectExpr("id", "case when id % 3 > 0 then null else id end as k")
    marked = quality.mark_duplicates(df, ["k"], ["id"])
    first = df.where("k is null").agg(F.min("id")).first()[0]
    assert marked.count() == 2000
    assert [r.id for r in marked.where("k is null and not is_duplicate").collect()] == [first]
    assert marked.where("k is not null and is_duplicate").count() == 0


def test_approximate_cardinality_option(spark):
    df = spark.range(10_000).selectExpr("id", "id % 5 as few")
    got = {r.column_name: r.n_distinct for r in quality.cardinality(df, relative_error=0.02).collect()}
    assert got["few"] == 5 and abs(got["id"] - 10_000) < 1_000


def test_suite_document_and_unknown_rules(spark):
    document = json.dumps({"expectations": [
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "a", "min_value": 0, "max_value": 2, "mostly": 0.5}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "gone"}},
        {"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": "a", "value_set": [1, 2]}},
    ]})
    df = spark.createDataFrame([(1,), (9,), (None,)], "a int")
    rows = validate(df, load_suite(document)).collect()
    assert [r.success for r in rows] == [True, False, False]
    assert (rows[0].unexpected_count, rows[0].unexpected_percent) == (1, 50.0)
    assert rows[1].found is False
    with pytest.raises(ValueError, match="unknown expectation"):
        validate(df, [Expectation("expect_magic", {"column": "a"})])
    assert (len(churn.SUITE_A), len(churn.SUITE_B)) == (24, 15)


def test_suite_is_one_pass(spark):
    df = spark.createDataFrame([("1", 0, "Male")], "customerID string, SeniorCitizen int, gender string")
    plan = validate(df, churn.SUITE_A)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_total_services_counts_backup_twice(spark):
    df = spark.createDataFrame([(True, True, None, False, True)], ", ".join(
        f"{c} boolean" for c in ("onlinesecurity_yes", "onlinebackup_yes", "techsupport_yes", "streamingtv_yes", "streamingmovies_yes")))
    assert tuple(df.select(total_services(), total_services(dedupe=True)).first()) == (4, 3)


def test_fingerprint_ignores_order_and_partitioning(spark):
    df = spark.range(500).selectExpr("id", "case when id % 3 = 0 then null else cast(id as string) end as t")
    a = snapshots.fingerprint(df).first()
    b = snapshots.fingerprint(df.orderBy(F.desc("id")).repartition(7)).first()
    assert a == b
    changed = snapshots.fingerprint(df.withColumn("t", F.coalesce("t", F.lit("")))).first()
    assert changed.content_hash != a.content_hash


def test_row_hash_keeps_cells_apart(spark):
    rows = [("a|1=b", "c"), ("a", "1=b|c"), (None, "x"), ("", "x"), ("~", "x")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(snapshots.row_hash(["a", "b"])).distinct().count() == 5


def test_snapshot_versions(spark):
    zone = scratch_path(spark, "versions")
    with pytest.raises(Exception):
        snapshots.latest_snapshot(spark, zone)
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k int, v string")
    new = spark.createDataFrame([(2, "b"), (3, "x"), (4, None), (5, "e")], "k int, v string")
    first = snapshots.publish(old, zone, "t", datetime(2024, 1, 1, 10))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        snapshots.publish(old, zone, "t", datetime(2024, 1, 1, 10))
    second = snapshots.publish(new, zone, "t", datetime(2024, 1, 1, 11))
    assert snapshots.latest_snapshot(spark, zone).endswith(second.split("/", 3)[-1])
    diff = snapshots.snapshot_diff(spark.read.parquet(first), spark.read.parquet(second), ["k"])
    assert {tuple(r) for r in diff.collect()} == {(1, "removed"), (3, "changed"), (4, "changed"), (5, "added")}


def test_size_gate_rejects_small_objects(spark):
    zone = scratch_path(spark, "gate")
    spark.range(3).selectExpr("cast(id as string) as value").coalesce(1).write.text(f"{zone}/small")
    spark.range(2000).selectExpr("cast(id as string) as value").write.text(f"{zone}/large")
    got = {r.folder.rsplit("/", 1)[-1]: r.accepted for r in snapshots.size_gate(spark, zone).collect()}
    assert got == {"small": False, "large": True}


def test_insert_if_absent_appends(spark):
    """Only fresh rows are written, part files that are there stay as they are, and only buckets of the batch's keys are read."""
    kept = warehouse.KeyedTable(spark, scratch_path(spark, "keyed"), "k", buckets=8, fan=3)
    kept.insert_if_absent(spark.createDataFrame([("a", 1)], "k string, v int"), ["v"])
    before = {r.path: r.modified for r in snapshots.files(spark, kept.log.root, "*.parquet").collect()}
    batch = spark.createDataFrame([("a", 9, 1), ("b", 5, 2), ("b", 6, 1)], "k string, v int, n int")
    assert [tuple(r) for r in kept.insert_if_absent(batch, ["n"]).collect()] == [("b", 6)]
    after = {r.path: r.modified for r in snapshots.files(spark, kept.log.root, "*.parquet").collect()}
    assert before.items() <= after.items()
    for i in range(6):
        kept.insert_if_absent(spark.createDataFrame([(x, i, 0) for x in ("a", "b", f"c{i}")], "k string, v int, n int"), ["n"])
    assert {tuple(r) for r in kept.read().collect()} == {("a", 1), ("b", 6), *((f"c{i}", i) for i in range(6))}
    version = kept.log.newest()
    assert len(version["data"]) == 8 and len(version["folders"]) < 8 + 8
    plan = kept.known(version, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_key_bucket" in plan and "_key_bucket#" in plan
    bad = spark.createDataFrame([(None, 9, 1)], "k string, v int, n int")
    with pytest.raises(Exception, match="k is missing"):
        kept.insert_if_absent(bad, ["n"])


def test_warehouse_table_lifecycle(spark):
    warehouse.ensure_table(spark, "seed_customers", warehouse.CUSTOMER_TABLE_SCHEMA)
    warehouse.ensure_table(spark, "seed_customers", warehouse.CUSTOMER_TABLE_SCHEMA)
    assert len(spark.table("seed_customers").columns) == 16
    assert not warehouse.table_exists(spark, "no_such_table")
    where = scratch_path(spark, "refreshed")
    one = warehouse.full_refresh(spark.range(3), "refreshed", where)
    two = warehouse.full_refresh(one.where("id > 0"), "refreshed", where)
    assert [r.id for r in warehouse.peek(two, ["id"]).collect()] == [1, 2]


def test_jdbc_needs_bounds_for_a_split_scan(spark):
    with pytest.raises(ValueError, match="bounds"):
        readers.read_jdbc(spark, "jdbc:none:x", "customers", partition_column="id")


def test_csv_blank_cells(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("id,total",), ("1, ",), ("2, 3.5",), ("3,",)], "value string").coalesce(1).write.text(path)
    got = readers.read_csv(spark, path, "id int, total string", strip_blanks=True)
    assert {r.id: r.total for r in got.collect()} == {1: None, 2: "3.5", 3: None}


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NA", float("nan")), ("x", 1.0)], "t string, x double")
    assert [tuple(r) for r in schema.normalize_nulls(df, readers.MISSING_TOKENS).collect()] == [(None, None), ("x", 1.0)]


USER = fs.Entity("user", ("k",))
LOG = "k string, t timestamp_ntz, c timestamp_ntz, v int"


def _view(df, **kw):
    return fs.FeatureView("view", USER, (fs.Feature("v", T.IntegerType()),), fs.FeatureSource("log", "t", df=df, created="c"), **kw)


def test_materializing_in_steps_equals_at_once(spark):
    rows = [(f"k{i % 4}", D + timedelta(hours=i * 7 % 50), D + timedelta(hours=i), i) for i in range(60)]
    log = spark.createDataFrame(rows, LOG)
    view = _view(log)
    mid, end = D + timedelta(hours=20), D + timedelta(hours=45)
    step = fs.materialize_increment(view, log, None, mid)
    step = fs.materialize_increment(view, log, mid, end, step)
    once = fs.materialize_increment(view, log, None, end)
    assert step.exceptAll(once).count() == 0 and step.count() == once.count() == 4
    late = spark.createDataFrame([("k0", D - timedelta(days=9), D, -1)], LOG)
    assert fs.materialize_increment(view, late, None, end, once).exceptAll(once).count() == 0


def test_online_lookup_keeps_unknown_entities(spark):
    online = spark.createDataFrame([("a", D, D, 1)], LOG)
    asked = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    got = fs.online_lookup(asked, online, [_view(online)])
    assert sorted((r.k, r.v or 0) for r in got.collect()) == [("a", 1), ("a", 1), ("b", 0)]


def test_feature_references(spark):
    log = spark.createDataFrame([("a", D, D, 1)], LOG)
    with pytest.raises(KeyError):
        fs.feature_list([_view(log)], ["view:w"])
    with pytest.raises(KeyError):
        _view(log)[["w"]]
    view = customer_view(log)
    assert len(view.features) == 36 and len(churn.MODEL_SIGNATURE) == 35


def test_on_demand_needs_its_request_columns(spark):
    log = spark.createDataFrame([("a", D, D, 1)], LOG)
    request = fs.RequestSource("r", T.StructType([T.StructField("plus", T.LongType())]))
    demand = fs.OnDemandView("d", (_view(log), request), (fs.Feature("w", T.DoubleType()),), {"w": F.col("v") + F.col("plus")})
    spine = spark.createDataFrame([("a", D)], "k string, event_timestamp timestamp_ntz")
    with pytest.raises(ValueError, match="plus"):
        fs.historical_features(spine, [demand])
    assert fs.historical_features(spine.withColumn("plus", F.lit(5)), [demand]).first().w == 6.0
    assert fs.batch_scoring(spine.select("k").withColumn("plus", F.lit(5)), [demand]).first().w == 6.0


def test_batch_scoring_respects_ttl(spark):
    log = spark.createDataFrame([("a", D, D, 1)], LOG)
    keys = spark.createDataFrame([("a",)], "k string")
    fresh = fs.batch_scoring(keys, [_view(log, ttl=timedelta(days=1))], D + timedelta(days=1)).first()
    stale = fs.batch_scoring(keys, [_view(log, ttl=timedelta(days=1))], D + timedelta(days=1, seconds=1)).first()
    assert (fresh.v, stale.v) == (1, None)


def test_schema_conformance(spark):
    df = spark.createDataFrame([(True, "1.5", 3)], "flag boolean, amount string, extra int")
    declared = T.StructType([T.StructField("flag", T.IntegerType()), T.StructField("amount", T.DoubleType()), T.StructField("gone", T.StringType())])
    status = {r["column_name"]: r["status"] for r in schema.schema_report(df, declared)}
    assert status == {"flag": "cast", "amount": "cast", "gone": "missing", "extra": "undeclared"}
    two = T.StructType(declared.fields[:2])
    assert tuple(schema.conform(df, two).first()) == (1, 1.5)
    with pytest.raises(ValueError, match="gone"):
        schema.conform(df, declared)
    bad = spark.createDataFrame([(True, "x")], "flag boolean, amount string")
    with pytest.raises(Exception, match="does not fit"):
        schema.conform(bad, two).collect()
    assert schema.conform(bad, two, required=False).first().amount is None


def test_file_ingest_takes_each_file_once(spark):
    inbox, zone, state = (scratch_path(spark, n) for n in ("inbox", "zone", "state"))
    df = spark.range(10).selectExpr("id", "timestamp_ntz'2024-03-05' + make_interval(0,0,0,cast(id as int)) as ts")

    def run():
        start_file_ingest(spark, inbox, zone, state, df.schema, F.col("ts")).awaitTermination()
        return spark.read.option("basePath", zone).parquet(zone).count()

    df.where("id < 4").write.mode("append").parquet(inbox)
    assert run() == 4
    assert run() == 4
    df.where("id >= 4").write.mode("append").parquet(inbox)
    assert run() == 10


@pytest.mark.parametrize("fan", [2, 3, 50])
def test_push_is_incremental_and_ignores_late_events(spark, fan):
    inbox, off, on, state = (scratch_path(spark, n) for n in ("in", "off", "on", "state"))
    schema_ = T.StructType([T.StructField("k", T.StringType()), T.StructField("t", T.TimestampNTZType()), T.StructField("v", T.IntegerType())])
    view = fs.FeatureView("view", USER, (fs.Feature("v", T.IntegerType()),), fs.FeatureSource("log", "t"))

    def push(rows):
        spark.createDataFrame(rows, schema_).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema_).parquet(inbox)
        source = fs.PushSource("pushed", view.source)
        start_view_push(stream, source, view, off, on, state, fan=fan).awaitTermination()
        return {r.k: r.v for r in read_online(spark, on, ["k"], "t", ["v"]).collect()}

    assert push([("a", D, 1), ("b", D, 2)]) == {"a": 1, "b": 2}
    assert push([("a", D - timedelta(days=1), 9), ("b", D + timedelta(days=1), 3), ("c", D, 4)]) == {"a": 1, "b": 3, "c": 4}
    assert push([("c", D + timedelta(days=2), 5)]) == {"a": 1, "b": 3, "c": 5}
    assert read_offline(spark, off).count() == 6


def test_models_are_versioned(spark):
    rows = spark.range(400).selectExpr("cast(id as string) as k", "cast(id % 20 as double) as x", "cast(id % 20 > 9 as double) as label")
    model = learning.fit_logistic(rows, ["x"])
    zone = scratch_path(spark, "models")
    assert learning.latest_version(spark, zone) is None
    assert learning.save_model(spark, model, zone) == 1
    assert learning.save_model(spark, model, zone) == 2
    again = learning.load_model(zone, learning.latest_version(spark, zone))
    want = [r.prediction for r in model.transform(rows).select("prediction").collect()]
    assert [r.prediction for r in again.transform(rows).select("prediction").collect()] == want
    assert learning.train_and_score(rows, "k", ["x"], learning.fit_logistic).first().accuracy == 1.0


def test_logistic_solves_the_stated_objective(spark):
    """Gradient of 1/2 |w|^2 + C * sum(weight * loss) vanishes at the fitted weights."""
    import numpy as np

    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 2))
    y = (x @ [1.5, -1.0] + rnd.normal(size=300) > 0.8).astype(float)
    df = spark.createDataFrame([(str(i), float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "k string, a double, b double, label double")
    model = learning.fit_logistic(df, ["a", "b"]).stages[-1]
    w, b0 = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    p = 1 / (1 + np.exp(-(x @ w + b0)))
    gradient = w + x.T @ (weight * (p - y))
    assert np.abs(gradient).max() < 0.05
