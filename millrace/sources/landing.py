"""The raw zone: ``zone/source/year=YYYY/month=MM/day=DD``, by the hour with ``hour=HH`` below, in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.scalars import date_parts

DAILY_KEYS = ("year", "month", "day")
HOURLY_KEYS = (*DAILY_KEYS, "hour")


def land_raw(df: DataFrame, ts: Column, zone: str, source: str, fmt: str = "parquet") -> str:
    """Append to the daily partitions of a source's raw zone.

    The rebalance hint sizes the written files: small days share tasks and a day that holds
    much of the data is split over several.
    """
    path = f"{zone.rstrip('/')}/{source}"
    parts = df.withColumns(date_parts(ts))
    writer = parts.hint("rebalance", *DAILY_KEYS).write.mode("append").partitionBy(*DAILY_KEYS).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return path


def land_hourly(df: DataFrame, ts: Column, zone: str, source: str, fmt: str = "parquet") -> str:
    """Append to the hourly partitions: year, month, day and hour, a folder level each."""
    path = f"{zone.rstrip('/')}/{source}"
    parts = df.withColumns({**date_parts(ts), "hour": F.date_format(ts, "HH")})
    parts.hint("rebalance", *HOURLY_KEYS).write.mode("append").partitionBy(*HOURLY_KEYS).format(fmt).save(path)
    return path


def read_raw(spark: SparkSession, path: str, schema: T.StructType, keys=DAILY_KEYS, fmt: str = "parquet") -> DataFrame:
    """Read a raw zone with its partition keys as text, so ``month=03`` stays ``03``."""
    full = T.StructType([*schema.fields, *[T.StructField(k, T.StringType()) for k in keys]])
    reader = spark.read.schema(full)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)
