"""Queries: streaming ingestion and push, run to completion on files of the event log."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.registry import query, table
from millrace.session import scratch_path
from millrace.streaming.ingest import read_landed, read_quarantine, start_file_ingest
from millrace.streaming.push import read_offline, read_online, start_push


def _inbox(df, spark) -> str:
    """The table as a folder of arriving files, one or more per day."""
    path = scratch_path(spark, "inbox")
    df.withColumn("arrival", F.to_date("ts")).hint("rebalance", "arrival").write.partitionBy("arrival").parquet(path)
    return path


# Two files a day, a large one and one of few users; a line is the three columns with commas and its end.
DROPS = "select event_id, user_id, ts, case when user_id % 15 = 0 then 1 else 0 end as grp, length(event_id || ',' || user_id || ',' || strftime(ts, '%Y-%m-%d %H:%M:%S')) + 1 as bytes from events"


@query(
    "stream_file_ingest",
    f"with d as ({DROPS}), s as (select *, sum(bytes) over (partition by strftime(ts, '%Y%m%d'), grp) as size from d) "
    "select event_id, user_id, case when size >= 1024 then strftime(ts, '%Y') end as year, case when size >= 1024 then strftime(ts, '%m') end as month, "
    "case when size >= 1024 then strftime(ts, '%d') end as day, size < 1024 as quarantined, case when size < 1024 then size::bigint end as file_size from s",
)
def stream_file_ingest(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    inbox, zone, checkpoint = scratch_path(spark, "inbox"), scratch_path(spark, "landed"), scratch_path(spark, "progress")
    quarantine = scratch_path(spark, "quarantine")
    keyed = df.withColumns({"arrival": F.substring("at", 1, 10), "grp": (F.col("user_id") % 15 == 0).cast("int")})
    keyed.repartition("arrival", "grp").write.partitionBy("arrival", "grp").csv(inbox)
    for _ in range(2):  # the second run finds nothing new
        start_file_ingest(
            spark, inbox, zone, checkpoint, df.schema, F.col("at").cast("timestamp_ntz"), "csv", files_per_trigger=40, quarantine=quarantine
        ).awaitTermination()
    good = read_landed(spark, zone, df.schema).select("event_id", "user_id", "year", "month", "day", F.lit(False).alias("quarantined"))
    bad = read_quarantine(spark, quarantine, df.schema).select("event_id", "user_id", F.lit(True).alias("quarantined"), "file_size")
    return good.unionByName(bad, allowMissingColumns=True)


@query(
    "stream_push_latest",
    "select user_id, max(ts) as ts, arg_max(event_id, ts) as event_id, arg_max(value, ts) as value, "
    "count(*) as n_offline from events group by 1",
)
def stream_push_latest(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    inbox = _inbox(df, spark)
    offline, online = scratch_path(spark, "offline"), scratch_path(spark, "online")
    events = spark.readStream.schema(df.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 6).parquet(inbox)
    start_push(
        events, ["user_id"], "ts", ["event_id", "value"], offline, online, scratch_path(spark, "progress"), fan=2
    ).awaitTermination()
    counts = read_offline(spark, offline).groupBy("user_id").agg(F.count(F.lit(1)).alias("n_offline"))
    return read_online(spark, online, ["user_id"], "ts", ["event_id", "value"]).join(counts, "user_id")
