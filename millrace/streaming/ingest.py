"""Process each arriving file exactly once: land it by date, or set it aside if it is too small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.scalars import date_parts
from millrace.sources.landing import DAILY_KEYS, read_raw
from millrace.sources.snapshots import MIN_LANDED_BYTES


def start_file_ingest(
    spark: SparkSession,
    inbox: str,
    zone: str,
    checkpoint: str,
    schema: T.StructType,
    ts: Column,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    continuous: str | None = None,
    quarantine: str | None = None,
    min_bytes: int = MIN_LANDED_BYTES,
) -> StreamingQuery:
    """Stream new files of ``inbox`` into ``zone/batch=/year=/month=/day=``.

    Rows of files below ``min_bytes`` go to ``quarantine/batch=`` instead, with path and size of
    their file; without ``quarantine`` all files are taken. The checkpoint remembers the files
    already taken, and outputs are named by the batch: a batch that is repeated after a crash
    replaces its own output, so a restart neither repeats nor loses a file. Without
    ``continuous`` (a trigger interval such as "1 hour") the query takes what is there and ends.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    arriving = reader.format(fmt).load(inbox)
    facts = [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size")]
    small = F.col("file_size") < min_bytes if quarantine else F.lit(False)

    def land(batch: DataFrame, number: int) -> None:
        dated = batch.where(~small).drop("file_path", "file_size").withColumns(date_parts(ts))
        dated.write.mode("overwrite").partitionBy(*DAILY_KEYS).parquet(f"{zone}/batch={number}")
        if quarantine:
            batch.where(small).write.mode("overwrite").parquet(f"{quarantine}/batch={number}")

    writer = arriving.select(*schema.names, *facts).writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": continuous} if continuous else {"availableNow": True}
    return writer.trigger(**trigger).start()


def read_landed(spark: SparkSession, zone: str, schema: T.StructType) -> DataFrame:
    """What the stream has landed, with its days as text."""
    return read_raw(spark, zone, schema, keys=("batch", *DAILY_KEYS)).drop("batch")


def read_quarantine(spark: SparkSession, quarantine: str, schema: T.StructType) -> DataFrame:
    full = T.StructType([*schema.fields, T.StructField("file_path", T.StringType()), T.StructField("file_size", T.LongType())])
    return read_raw(spark, quarantine, full, keys=("batch",)).drop("batch")
