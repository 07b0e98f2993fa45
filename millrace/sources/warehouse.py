"""Warehouse tables: typed full refresh, audit stamp, insert-if-absent, read-back."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.functions.scalars import moment
from millrace.sources.versions import Folder, LevelledTable

AUDIT_COLUMN = "event_timestamp"
KEY_BUCKET = "_key_bucket"

# The seeded customer table. Spark keeps no primary key; see KeyedTable.
CUSTOMER_TABLE_SCHEMA = """
customer_id VARCHAR(50), age INT, city VARCHAR(100), zip_code VARCHAR(20),
latitude DECIMAL(10,6), longitude DECIMAL(10,6), number_of_referrals INT, offer VARCHAR(50),
avg_monthly_long_distance_charges DECIMAL(10,2), avg_monthly_gb_download DECIMAL(10,2),
streaming_music VARCHAR(5), unlimited_data VARCHAR(5), total_refunds DECIMAL(10,2),
total_extra_data_charges DECIMAL(10,2), total_long_distance_charges DECIMAL(10,2),
total_revenue DECIMAL(10,2)
"""


def warehouse_type(dtype: T.DataType) -> T.DataType:
    """Integers to BIGINT, floats to DOUBLE, booleans and timestamps kept, all else to text."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, (T.BooleanType, T.TimestampType, T.TimestampNTZType)):
        return dtype
    return T.StringType()


def to_warehouse_types(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast(warehouse_type(f.dataType)).alias(f.name) for f in df.schema])


def stamp(df: DataFrame, at: datetime | None = None, column: str = AUDIT_COLUMN) -> DataFrame:
    """Add the load time, the same for every row; given before the write, so no update pass."""
    return df.withColumn(column, moment(at) if at is not None else F.current_timestamp().cast("timestamp_ntz"))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """Create the table if there is none, in the warehouse or at ``path``."""
    where = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}")


def full_refresh(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a table by the DataFrame and return it.

    Each refresh goes to a folder of its own, below ``path`` or the warehouse; then the table is
    pointed there, so it can be read at every moment, may be read by the refresh itself, and stays
    as it was if the write fails. The folder before is kept for those who still read it, older ones
    go. Only new columns or types need the table to be made anew.
    """
    spark = df.sparkSession
    base = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}").rstrip("/")
    version = f"v-{uuid4().hex}"
    df.write.parquet(f"{base}/{version}")
    kept = {version}
    if table_exists(spark, name):
        kept.add(_location(spark, name).rstrip("/").rpartition("/")[2])
    written = spark.read.parquet(f"{base}/{version}").schema
    if table_exists(spark, name) and spark.table(name).schema == written:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{base}/{version}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=f"{base}/{version}", source="parquet")
    folders = Folder(spark, base)
    for old in folders.names():
        if old.startswith("v-") and old not in kept:
            folders.delete(old)
    return spark.table(name)


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]


def first_per_key(batch: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``, in a partially aggregated minimum. A missing key is an error, as for any primary key."""
    carried = [*order, *[c for c in batch.columns if c not in order and c != key]]
    refused = F.raise_error(F.lit(f"{key} is missing")).cast(batch.schema[key].dataType)
    checked = batch.withColumn(key, F.when(F.col(key).isNull(), refused).otherwise(F.col(key)))
    first = checked.groupBy(key).agg(F.min(F.struct(*carried)).alias("first"))
    return first.select(key, *[F.col(f"first.{c}").alias(c) for c in batch.columns if c != key])


class KeyedTable:
    """A table with one row per key that batches are appended to: rows whose key is there already are left out.

    Beside the rows lies an index: the keys alone, in ``buckets`` folders by their hash. A batch
    reads the buckets its keys fall in, and writes only its fresh rows and their keys; part files
    that are there stay untouched. Rows and index become visible as one version.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64, fan: int = 8) -> None:
        self.spark, self.key, self.buckets = spark, key, buckets
        self.rows = LevelledTable(spark, root)
        self.index = LevelledTable(spark, root, fan=fan, partition_by=[KEY_BUCKET])
        self.log = self.rows.log

    def insert_if_absent(self, batch: DataFrame, order: Sequence[str]) -> DataFrame:
        """Append the first row by ``order`` of each key that is not in the table; returns the rows written.

        The table has the columns of its first batch; of later ones only these are kept.
        """
        fresh, newest = first_per_key(batch, self.key, order), self.log.newest()
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        if newest:
            asked = [r[0] for r in batch.select(bucket).distinct().collect()]  # at most one row per bucket
            fresh = fresh.join(self.known(newest, asked), self.key, "left_anti")
        columns = newest["columns"] if newest else batch.columns
        part = self.rows.write(fresh.select(*columns))
        written = self.rows.parts([part])
        levels, scratch = self.index.place(newest["levels"] if newest else [], written.select(self.key, bucket.alias(KEY_BUCKET)))
        data = [*(newest["data"] if newest else []), part]
        self.log.publish([*data, *(f for level in levels for f in level)], newest, data=data, levels=levels, columns=columns)
        for folder in scratch:
            Folder(self.spark, self.log.root).delete(folder)
        return written

    def known(self, version: dict, buckets: Sequence[int]) -> DataFrame:
        """The keys of these buckets; the others are not read."""
        return self.index.parts([f for level in version["levels"] for f in level]).where(F.col(KEY_BUCKET).isin(list(buckets))).select(self.key)

    def read(self) -> DataFrame:
        return self.rows.parts(self.log.newest()["data"])


def peek(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)
