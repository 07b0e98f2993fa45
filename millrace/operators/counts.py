"""Value counts and what follows from them: distinct counts, modes, category codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.operators.schema import dtype_of
from millrace.session import cut_lineage

MAX_FITTED_VALUES = 50_000


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value as text, n) for each distinct value, NULL included.

    Partial aggregation collapses repeats before the shuffle, so a value that fills a
    third of the table costs one row per task.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), _as_text(df, c).alias("value")) for c in columns]
    if not cells:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n long")
    return (
        df.select(F.inline(F.array(*cells)))
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _as_text(df: DataFrame, c: str) -> Column:
    """The value as text; -0.0 and 0.0 are one value."""
    float_type = dtype_of(df, c).typeName() in ("double", "float")
    return (F.col(c) + F.lit(0.0) if float_type else F.col(c)).cast("string")


def fit_categories(
    df: DataFrame, columns: Sequence[str], limit: int = MAX_FITTED_VALUES
) -> dict[str, list[tuple[str, int]]] | None:
    """{column: [(value, n), ...]} in alphabetical order, from one job; None beyond ``limit``.

    This is the shape of a fitted encoder: a short list of categories. Columns with more
    distinct values than that stay in Spark.
    """
    rows = value_counts(df, columns).where("value is not null").limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    found: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for r in rows:
        found[r["column_name"]].append((r["value"], r["n"]))
    return {c: sorted(pairs, key=lambda p: p[0].encode()) for c, pairs in found.items()}


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, mode, freq): most frequent value, ties to the smallest."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), "value"))
    return (
        value_counts(df, columns)
        .where("value is not null")
        .groupBy("column_name")
        .agg(best.alias("best"))
        .select("column_name", F.col("best.value").alias("mode"), (-F.col("best.rank")).alias("freq"))
    )


def category_codes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, n, code): 0-based alphabetical codes of the non-missing values.

    The ranking runs over distinct values, never over data rows. They are range-sorted across
    tasks, written once, and numbered by the offset of their partition, so no task holds the
    values of a column.
    """
    counts = value_counts(df, columns).where("value is not null")
    placed = cut_lineage(
        counts.repartitionByRange("column_name", "value")
        .sortWithinPartitions("column_name", "value")
        .withColumn("part", F.spark_partition_id())
        .withColumn("place", F.monotonically_increasing_id())
    )
    earlier = Window.partitionBy("column_name").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("column_name", "part")
        .agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("first_place"))
        .withColumn("offset", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    )
    return placed.join(offsets, ["column_name", "part"]).select(
        "column_name", "value", "n", (F.col("offset") + F.col("place") - F.col("first_place")).alias("code")
    )
