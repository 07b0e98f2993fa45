"""Versioned snapshots in a folder zone: publish, find the latest, fingerprint, compare."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.sources.versions import VersionConflict, VersionLog

MIN_LANDED_BYTES = 1024
#: Buckets of a snapshot with a key, and the column that names them.
BUCKETS, BUCKET = 64, "_bucket"


def publish(
    df: DataFrame, zone: str, name: str, at: datetime, fmt: str = "parquet", key: Sequence[str] = (), buckets: int = BUCKETS
) -> str:
    """Write to ``zone/<yyyyMMdd_HHmmss>/name``, then make it known as a version; an existing one is an error.

    With ``key`` the rows lie in ``buckets`` folders by the hash of their key, and the version
    holds the row count and the sum of row hashes of each: see ``version_diff``.
    """
    zone = zone.rstrip("/")
    folder = f"{at:%Y%m%d_%H%M%S}/{name}"
    path = f"{zone}/{folder}"
    spark, marks = df.sparkSession, {"name": name, "at": at.isoformat(), "format": fmt}
    if key:
        df = df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
    writer = df.write.mode("errorifexists").format(fmt)
    if key:
        writer = writer.partitionBy(BUCKET)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    if key:
        columns = sorted(set(df.columns) - {BUCKET})
        sums = spark.read.parquet(path).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"), F.sum(_hash_number(row_hash(columns))).cast("string").alias("h"))
        marks |= {"key": list(key), "columns": columns, "buckets": buckets, "sums": {r[BUCKET]: [r["n"], r["h"]] for r in sums.collect()}}
    log = VersionLog(spark, zone, keep=None)
    while True:
        try:
            log.publish([folder], log.newest(), **marks)
            return path
        except VersionConflict:  # another snapshot came in between
            continue


def version_diff(spark: SparkSession, zone: str, old: dict, new: dict) -> DataFrame:
    """``snapshot_diff`` of two versions published with one key: only buckets whose sums differ are read."""
    if any(old[x] != new[x] for x in ("key", "buckets")):
        raise ValueError("the versions have different keys or buckets")
    differ = sorted(int(b) for b in {*old["sums"], *new["sums"]} if old["columns"] != new["columns"] or old["sums"].get(b) != new["sums"].get(b))

    def read(version: dict) -> DataFrame:
        whole = spark.read.parquet(f"{zone.rstrip('/')}/{version['folders'][0]}")
        return whole.where(F.col(BUCKET).isin(differ) if differ else F.lit(False)).drop(BUCKET)

    return snapshot_diff(read(old), read(new), old["key"])


def files(spark: SparkSession, zone: str, pattern: str | None = None) -> DataFrame:
    """(path, folder, name, modified, bytes) of the files under a zone; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    listed = reader.load(zone).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))
    return listed.select(
        "path",
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "modified",
        "bytes",
    ).where(F.col("name") != "")


def latest_snapshot(spark: SparkSession, zone: str, pattern: str | None = None, skip: str = "Done") -> str:
    """Folder of the newest complete version; processed ones do not count.

    Published versions are known by the zone's log, so one that is still being written is never
    taken, and only the log is read. In a zone without a log, filled by others, it is the folder
    of the most recently modified file.
    """
    zone = zone.rstrip("/")
    published = False
    for version in VersionLog(spark, zone, keep=None).history():
        published = True
        if skip not in version["name"]:
            return f"{zone}/{version['folders'][0]}"
    if published:
        raise FileNotFoundError(f"no unprocessed snapshot in {zone}")
    candidates = files(spark, zone, pattern).where(~F.col("name").contains(skip))
    newest = candidates.agg(F.max_by("folder", F.struct("modified", "path")).alias("folder")).first()["folder"]
    if newest is None:
        raise FileNotFoundError(f"no snapshot under {zone}")
    return newest


def size_gate(spark: SparkSession, zone: str, min_bytes: int = MIN_LANDED_BYTES) -> DataFrame:
    """(folder, n_files, bytes, accepted) per landed object; too small ones are not accepted.

    A landed object is a folder of part files, so it is judged by their total size.
    """
    return (
        files(spark, zone)
        .groupBy("folder")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes"))
        .withColumn("accepted", F.col("bytes") >= min_bytes)
    )


def row_hash(columns: Sequence[str]) -> Column:
    """md5 of the row's cells as text. Each cell is led by its length, so neither NULL and
    empty text nor two cells with a separator inside can be taken for one another."""

    def cell(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.coalesce(F.concat(F.char_length(text), F.lit("="), text), F.lit("~"))

    return F.md5(F.concat_ws("|", *[cell(c) for c in columns]))


def _hash_number(digest: Column) -> Column:
    """60 bits of a digest, in a type whose sum cannot overflow."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(n_rows, content_hash, column_list): the same for any row order or partitioning."""
    columns = list(columns or df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(_hash_number(row_hash(columns))), F.lit(0)).cast("string").alias("content_hash"),
    ).withColumn("column_list", F.lit(",".join(columns)))


def manifest(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Version record of a written snapshot: fingerprint, bytes, file count, path."""
    size = files(spark, path).agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("bytes")).first()
    reader = spark.read.format(fmt)
    df = (reader.option("header", True) if fmt == "csv" else reader).load(path)
    return fingerprint(df).select(
        "*", F.lit(size["n_files"]).alias("n_files"), F.lit(size["bytes"]).alias("bytes"), F.lit(path).alias("path")
    )


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, change) for keys added, removed or changed between two versions.

    Both versions are stacked and aggregated once per key; rows are never paired, so a key
    with many rows cannot multiply them. Repeated keys compare as bags of rows.
    """
    columns = sorted(set(old.columns) | set(new.columns))

    def side(df: DataFrame, sign: int) -> DataFrame:
        full = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])
        return full.select(*key, F.lit(sign).alias("side"), _hash_number(row_hash(columns)).alias("h"))

    both = side(old, 0).unionByName(side(new, 1))

    def total(s: int):
        return F.sum(F.when(F.col("side") == s, F.col("h")))

    per_key = both.groupBy(*key).agg(
        F.count_if(F.col("side") == 0).alias("n_old"),
        F.count_if(F.col("side") == 1).alias("n_new"),
        total(0).alias("h_old"),
        total(1).alias("h_new"),
    )
    change = (
        F.when(F.col("n_old") == 0, "added")
        .when(F.col("n_new") == 0, "removed")
        .when((F.col("n_old") != F.col("n_new")) | (F.col("h_old") != F.col("h_new")), "changed")
    )
    return per_key.select(*key, change.alias("change")).where("change is not null")
