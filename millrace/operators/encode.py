"""Scaling and encoding. ``fit_*`` returns a few numbers, ``apply_*`` is a projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from millrace.functions.scalars import to_number
from millrace.operators.counts import category_codes, fit_categories
from millrace.operators.schema import dtype_of
from millrace.session import write_through

MAX_CATEGORIES = 1_000


def zscore_aggregates(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Mean and population deviation per column, to be part of any aggregate over the table."""
    numbers = {c: to_number(F.col(c), dtype_of(df, c)) for c in columns}
    return [F.avg(x).alias(f"mean_{c}") for c, x in numbers.items()] + [
        F.stddev_pop(x).alias(f"dev_{c}") for c, x in numbers.items()
    ]


def zscore_model(row: Row, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    return {c: (row[f"mean_{c}"], row[f"dev_{c}"]) for c in columns}


def fit_zscore(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    return zscore_model(df.agg(*zscore_aggregates(df, columns)).first(), columns) if columns else {}


def apply_zscore(df: DataFrame, model: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / deviation; a column without spread becomes 0."""
    out = {}
    for c, (mean, deviation) in model.items():
        if mean is None:
            continue
        out[c] = (to_number(F.col(c), dtype_of(df, c)) - F.lit(mean)) / F.lit(deviation or 1.0)
    return df.withColumns(out) if out else df


def zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_zscore(df, fit_zscore(df, columns))


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    numbers = {c: to_number(F.col(c), dtype_of(df, c)) for c in columns}
    row = df.agg(
        *[F.min(x).alias(f"lo_{c}") for c, x in numbers.items()],
        *[F.max(x).alias(f"hi_{c}") for c, x in numbers.items()],
    ).first()
    return {c: (row[f"lo_{c}"], row[f"hi_{c}"]) for c in columns}


def apply_minmax(df: DataFrame, model: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x - min) / (max - min); NULL for a constant column."""
    out = {}
    for c, (low, high) in model.items():
        if low is not None:
            x = to_number(F.col(c), dtype_of(df, c))
            out[c] = F.try_divide(x - F.lit(low), F.lit(high) - F.lit(low))
    return df.withColumns(out) if out else df


def minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_minmax(df, fit_minmax(df, columns))


def fit_onehot(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> dict[str, list[str]]:
    """Sorted categories per column. They become columns, so their number is guarded."""
    if not columns:
        return {}
    found = fit_categories(df, columns, limit * len(columns))
    wide = columns if found is None else [c for c, pairs in found.items() if len(pairs) > limit]
    if wide:
        raise ValueError(f"more than {limit} categories in {wide}")
    return {c: [value for value, _ in pairs] for c, pairs in found.items()}


def apply_onehot(df: DataFrame, model: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by booleans ``column_value`` for all categories but the first.

    A missing value and a value not seen at fit time are false everywhere.
    """
    kept = [c for c in df.columns if c not in model]
    flags = [
        F.coalesce(F.col(c).cast("string") == v, F.lit(False)).alias(f"{c}_{v}")
        for c, values in model.items()
        for v in values[1:]
    ]
    return df.select(*kept, *flags)


def onehot(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> DataFrame:
    return apply_onehot(df, fit_onehot(df, columns, limit))


def _with_code(df: DataFrame, column: str, out: str) -> DataFrame:
    """Join the written codes; Spark sees their size and broadcasts them or shuffles."""
    codes = category_codes(df, [column]).select(F.col("value").alias("_value"), F.col("code").alias(out))
    table = write_through(codes, "codes")
    return df.join(table, F.col(column).cast("string") == F.col("_value"), "left").drop("_value")


def with_category_code(df: DataFrame, column: str, out: str) -> DataFrame:
    """Alphabetical code of the value, -1 where it is missing."""
    coded = _with_code(df, column, out)
    return coded.withColumn(out, F.coalesce(F.col(out), F.lit(-1)).cast("int"))


def encode_label(df: DataFrame, column: str, out: str) -> DataFrame:
    """Sorted classes to 0..k-1; a missing label stays missing."""
    coded = _with_code(df, column, out)
    return coded.withColumn(out, F.col(out).cast("int"))
