"""Readers. Schemas are passed in; nothing is inferred from data at scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T

from millrace.operators.schema import rename_positional

# Header of the database extract, by position.
EXTRACT_COLUMNS = (
    "customerID",
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "tenure",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "Churn",
)

# Text that stands for a missing cell in a CSV file.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SEED_ROW_LIMIT = 10_000


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, strip_blanks: bool = False
) -> DataFrame:
    """A CSV snapshot with a header row.

    ``strip_blanks`` drops blanks after the delimiter, so a blank cell is missing. Without
    a schema the types are inferred, which reads the file twice: for exploration only.
    """
    reader = spark.read.option("header", True).option("nullValue", "")
    if strip_blanks:
        reader = reader.option("ignoreLeadingWhiteSpace", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A database table; with a partition column the scan is split into parallel ranges.

    Credentials come in ``options`` from the caller's secret store, never from code.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned scan needs bounds")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def read_extract(df: DataFrame, names: Sequence[str] = EXTRACT_COLUMNS) -> DataFrame:
    """Give a scanned extract its fixed header by position; the column count must match."""
    return rename_positional(df, names)


def first_rows(df: DataFrame, order: Sequence[str], n: int = SEED_ROW_LIMIT) -> DataFrame:
    """The first n rows in a stated order: each task keeps n, only those meet."""
    return df.orderBy(*order).limit(n)
