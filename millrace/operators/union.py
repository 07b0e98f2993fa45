"""Bringing two sources to one shape and stacking them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from millrace.functions.scalars import to_number, yes_no
from millrace.operators.schema import dtype_of


def standardize_label(df: DataFrame, column: str) -> DataFrame:
    """Every spelling of the label to Yes/No; no column, no change."""
    if column not in df.columns:
        return df
    return df.withColumn(column, yes_no(F.col(column), dtype_of(df, column)))


def standardize_flag(df: DataFrame, column: str) -> DataFrame:
    """A numeric 0/1 flag to No/Yes; a flag that is already text stays as it is."""
    if column not in df.columns or not isinstance(dtype_of(df, column), T.NumericType):
        return df
    return df.withColumn(column, yes_no(F.col(column), dtype_of(df, column)))


def standardize_number(df: DataFrame, column: str) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, to_number(F.col(column), dtype_of(df, column)))


def standardize_source(df: DataFrame, label: str, flag: str, amount: str) -> DataFrame:
    """The three conversions a source goes through before it is stacked with another."""
    return standardize_number(standardize_flag(standardize_label(df, label), flag), amount)


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """None when Spark widens the pair by itself; a number for a boolean beside a number; else text."""
    if a == b or (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
        return None
    for one, other in ((a, b), (b, a)):
        if isinstance(one, T.BooleanType) and isinstance(other, T.NumericType):
            return other
    return T.StringType()


def stack_by_name(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union of all rows by column name, left's columns first, absent ones NULL.

    Types are aligned up front: left to itself, Spark would resolve text against a number
    as a number and fail on the first bad value. No shuffle.
    """
    casts_left, casts_right = {}, {}
    for name in left.columns:
        if name in right.columns:
            common = _common_type(dtype_of(left, name), dtype_of(right, name))
            if common is not None:
                casts_left[name] = F.col(name).cast(common)
                casts_right[name] = F.col(name).cast(common)
    if casts_left:
        left, right = left.withColumns(casts_left), right.withColumns(casts_right)
    return left.unionByName(right, allowMissingColumns=True)


def distinct_spine(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct (key, timestamp) pairs; Spark removes repeats before the shuffle."""
    return df.select(*columns).distinct()
