"""Versions: visible whole or not at all; marks that survive a crash; parts that are merged and expire."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from millrace.plans import feature_store as fs
from millrace.session import scratch_path
from millrace.sources import snapshots, warehouse
from millrace.sources.versions import Folder, LevelledTable, VersionConflict, VersionLog
from millrace.streaming.ingest import read_landed, read_quarantine, start_file_ingest
from millrace.streaming.push import read_offline, read_online, start_push

D = datetime(2024, 1, 1)


def test_parts_are_merged_by_levels_and_expire(spark):
    table = LevelledTable(spark, scratch_path(spark, "levels"), fan=2, keep=2)
    listed = []
    for i in range(9):
        version = table.append(spark.range(10 * i, 10 * i + 10), batch=i)
        listed.append((len(Folder(spark, f"{table.log.root}/_versions").names()), len(Folder(spark, f"{table.log.root}/data").names())))
        assert table.read().count() == 10 * i + 10 and version["batch"] == i
    assert [len(level) for level in version["levels"]] == [1, 0, 0, 1]
    assert max(n for n, _ in listed) <= 2 + 2 and max(n for _, n in listed) <= 8  # hidden checksums of the local file system included


def test_a_half_written_version_is_not_seen(spark):
    table = LevelledTable(spark, scratch_path(spark, "half"))
    with pytest.raises(FileNotFoundError):
        table.read()
    table.append(spark.range(3))
    spark.range(100).write.parquet(f"{table.log.root}/data/crashed")
    assert table.read().count() == 3
    assert table.log.sweep(older_than=3600) == [] and table.log.sweep(older_than=0) == ["crashed"]
    assert table.read().count() == 3


def test_two_writers_cannot_both_win(spark):
    table = LevelledTable(spark, scratch_path(spark, "race"), keep=1)
    seen = table.append(spark.range(1))
    table.publish_after(seen, spark.range(2))
    with pytest.raises(VersionConflict):
        table.publish_after(seen, spark.range(5))
    table.append(spark.range(4))
    with pytest.raises(VersionConflict):  # its number is free again, but was taken
        table.publish_after(seen, spark.range(5))
    assert table.read().count() == 7


def test_materialization_remembers_its_end(spark):
    entity = fs.Entity("user", ("k",), T.StringType())
    rows = [("a", D + timedelta(days=i), i) for i in range(6)] + [("b", D + timedelta(days=2), 20)]
    log = spark.createDataFrame(rows, "k string, t timestamp_ntz, v int")
    view = fs.FeatureView("view", entity, (fs.Feature("v", T.IntegerType()),), fs.FeatureSource("log", "t", df=log))
    root = scratch_path(spark, "online")
    day = lambda i: D + timedelta(days=i)
    step = lambda i, **how: {r.k: r.v for r in fs.materialize(view, log, root, day(i), **how).collect()}
    numbers = lambda: fs.online_table(spark, view, root).log.newest()["version"]
    assert step(1) == {"a": 1} and step(3) == {"a": 3, "b": 20}
    assert (step(3), step(2), numbers()) == ({"a": 3, "b": 20}, {"a": 3, "b": 20}, 2)
    log.write.parquet(f"{root}/data/half-written")
    assert step(5, start=day(4)) == {"a": 5, "b": 20} and numbers() == 3
    entries = list(VersionLog(spark, root).history())
    assert [(e["start"], e["end"]) for e in entries[::-1]] == [(None, day(1).isoformat()), (day(1).isoformat(), day(3).isoformat()), (day(3).isoformat(), day(5).isoformat())]


def test_the_newest_snapshot_is_a_complete_one(spark):
    zone = scratch_path(spark, "zone")
    first = snapshots.publish(spark.range(3), zone, "t", datetime(2024, 1, 1))
    spark.range(9).write.parquet(f"{zone}/20240102_000000/t")  # written, not published
    assert snapshots.latest_snapshot(spark, zone) == first
    snapshots.publish(spark.range(1), zone, "t_Done", datetime(2024, 1, 3))
    assert snapshots.latest_snapshot(spark, zone) == first


def test_version_diff_reads_only_buckets_that_differ(spark):
    zone = scratch_path(spark, "tree")
    old = spark.range(1000).selectExpr("id as k", "cast(id % 7 as string) as v", "cast(null as int) as w")
    new = old.where("k <> 5").withColumn("v", F.when(F.col("k") == 9, "x").otherwise(F.col("v"))).unionByName(spark.sql("select 5000L as k, 'n' as v, 1 as w"))
    for df, day in ((old, 1), (new, 2), (new, 3)):
        snapshots.publish(df, zone, "t", datetime(2024, 1, day), key=["k"], buckets=32)
    same, second, first = VersionLog(spark, zone, keep=None).history()
    diff = snapshots.version_diff(spark, zone, first, second)
    assert {tuple(r) for r in diff.collect()} == {(5, "removed"), (9, "changed"), (5000, "added")}
    assert "PartitionFilters: [_bucket" in diff._jdf.queryExecution().executedPlan().toString().replace("isnotnull(_bucket", "_bucket")
    assert snapshots.version_diff(spark, zone, second, same).count() == 0
    assert snapshots.snapshot_diff(old, new, ["k"]).count() == 3


def test_a_replayed_batch_adds_nothing(spark):
    inbox, off, on, state = (scratch_path(spark, n) for n in ("in", "off", "on", "state"))
    schema = "k string, t timestamp_ntz, v int"
    spark.createDataFrame([("a", D, 1)], schema).write.parquet(inbox)

    def push(checkpoint):
        stream = spark.readStream.schema(schema).parquet(inbox)
        start_push(stream, ["k"], "t", ["v"], off, on, checkpoint).awaitTermination()

    push(state)
    # As after a crash between the stores and the commit of the batch: it comes again.
    commits = Folder(spark, f"{state}/commits")
    for name in commits.names():
        commits.delete(name)
    push(state)
    assert read_offline(spark, off).count() == 1 and read_online(spark, on, ["k"], "t", ["v"]).count() == 1
    push(scratch_path(spark, "another"))  # a stream of its own
    assert read_offline(spark, off).count() == 2


def test_a_refresh_can_be_read_at_every_moment(spark):
    where = scratch_path(spark, "refreshed")
    before = warehouse.full_refresh(spark.range(3), "always_there", where)
    for n in (5, 7, 9):
        now = warehouse.full_refresh(spark.range(n), "always_there", where)
        assert now.count() == n == spark.table("always_there").count()
        assert before.count() == (3 if n == 5 else n - 2)  # readers of the version before can go on
        before = now
    folders = [n for n in Folder(spark, where).names() if n.startswith("v-")]
    assert len(folders) == 2
    assert warehouse.full_refresh(spark.range(2).selectExpr("cast(id as string) as id"), "always_there", where).dtypes == [("id", "string")]
    spark.sql("drop table always_there")


def test_small_files_go_to_quarantine(spark):
    inbox, zone, aside, state = (scratch_path(spark, n) for n in ("inbox", "zone", "aside", "state"))
    df = spark.range(500).selectExpr("id", "timestamp_ntz'2024-03-05 10:00:00' as ts")
    df.where("id < 400").coalesce(1).write.mode("append").csv(inbox)
    df.where("id >= 490").coalesce(1).write.mode("append").csv(inbox)
    run = lambda: start_file_ingest(spark, inbox, zone, state, df.schema, F.col("ts"), "csv", quarantine=aside).awaitTermination()
    run()
    run()
    assert {r.id for r in read_landed(spark, zone, df.schema).collect()} == set(range(400))
    bad = read_quarantine(spark, aside, df.schema).collect()
    assert {r.id for r in bad} == set(range(490, 500)) and {r.file_size < 1024 for r in bad} == {True}
