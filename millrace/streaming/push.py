"""Pushed events: appended to the offline log and merged into the online table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.asof import latest_per_entity
from millrace.plans.feature_store import FeatureView, PushSource
from millrace.sources.versions import LevelledTable

#: Batches, or merged parts of a level, that are merged into one.
FAN = 8


def _online(spark: SparkSession, online: str, keys, ts, columns, created_ts, fan: int = FAN) -> LevelledTable:
    return LevelledTable(spark, online, lambda rows: latest_per_entity(rows, keys, ts, columns, created_ts), fan)


def start_push(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    columns: Sequence[str],
    offline: str,
    online: str,
    checkpoint: str,
    created_ts: str | None = None,
    fan: int = FAN,
    continuous: str | None = None,
) -> StreamingQuery:
    """Feed a stream of events to both stores.

    Each batch becomes a part of the offline log, whole, and of the online table, reduced to its
    newest row per entity: the work follows the size of the batch, not of the table. ``fan``
    parts are merged into one of the next level, online again to the newest rows, and merged
    parts expire. A version of a store remembers the last batch of each stream in it, so a
    replayed batch adds nothing. The newest event per entity wins, whenever it arrives.
    """
    carried = [*keys, ts, *([created_ts] if created_ts else []), *columns]

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(*carried)
        newest = latest_per_entity(rows, keys, ts, columns, created_ts)
        for table, part in ((LevelledTable(spark, offline, fan=fan), rows), (_online(spark, online, keys, ts, columns, created_ts, fan), newest)):
            version = table.log.newest()
            taken = dict(version["taken"]) if version else {}
            if taken.get(checkpoint, -1) < number:
                table.publish_after(version, part, taken=taken | {checkpoint: number})

    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return (
        events.writeStream.foreachBatch(take)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_view_push(
    events: DataFrame, source: PushSource, view: FeatureView, offline: str, online: str, checkpoint: str, **options
) -> StreamingQuery:
    """Push events to a feature view whose source is a push source."""
    batch = source.batch
    keys = list(view.entity.join_keys)
    return start_push(
        events, keys, batch.timestamp, view.names, offline, online, checkpoint, batch.created, **options
    )


def read_online(
    spark: SparkSession, online: str, keys: Sequence[str], ts: str, columns: Sequence[str], created_ts: str | None = None
) -> DataFrame:
    """The online table: the parts of its newest version, newest row per entity."""
    return _online(spark, online, keys, ts, columns, created_ts).read()


def read_offline(spark: SparkSession, offline: str) -> DataFrame:
    return LevelledTable(spark, offline).read()
