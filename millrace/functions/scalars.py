"""Column expressions. All stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F, types as T

# What counts as a plain number in text.
NUMBER_PATTERN = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Label spellings.
NO_LABELS = ("0", "No")
YES_LABELS = ("1", "Yes")

# Timestamp layouts.
COMPACT_STAMP = "yyyyMMddHHmmss"
SNAPSHOT_STAMP = "yyyyMMdd_HHmmss"
HOURLY_LAYOUT = "yyyy/MM/dd/HH"

RATIO_EPSILON = 1e-9


def nan_to_null(c: Column) -> Column:
    """Fold NaN into NULL: Spark aggregates would otherwise count it as a value."""
    return F.when(~F.isnan(c), c)


def text_to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL.

    The pattern guards the cast because Spark alone would also read ``1d`` or ``1f``.
    """
    text = F.trim(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def to_number(c: Column, dtype: T.DataType) -> Column:
    """Coerce a column of the given type to double; bad values become NULL."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return nan_to_null(c.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return text_to_number(c.cast("string"))


def yes_no(c: Column, dtype: T.DataType) -> Column:
    """Map 0/1, "0"/"1" and No/Yes to No/Yes; everything else becomes NULL."""
    if isinstance(dtype, T.NumericType):
        return F.when(c == 0, "No").when(c == 1, "Yes")
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "Yes").when(~c, "No")
    return F.when(c.isin(*NO_LABELS), "No").when(c.isin(*YES_LABELS), "Yes")


def label_to_int(c: Column) -> Column:
    """Yes/No to 1/0. A label that is neither is an error, not a NULL."""
    bad = F.raise_error(F.concat(F.lit("label is neither Yes nor No: "), F.coalesce(c, F.lit("NULL"))))
    return F.when(c == "Yes", F.lit(1)).when(c == "No", F.lit(0)).otherwise(bad.cast("int"))


def flag_to_int(c: Column) -> Column:
    """1 where true, 0 where false or missing."""
    return F.when(c, F.lit(1)).otherwise(F.lit(0))


def total(columns: Iterable[Column]) -> Column:
    """Row-wise sum in which a missing value adds nothing."""
    return reduce(add, [F.coalesce(c, F.lit(0)) for c in columns])


def guarded_ratio(num: Column, den: Column, epsilon: float = RATIO_EPSILON) -> Column:
    """num / (den + epsilon), NULL instead of an error when that is still zero."""
    return F.try_divide(num.cast("double"), den.cast("double") + F.lit(epsilon))


def outside(c: Column, low, high) -> Column:
    """Strictly outside [low, high]; NULL is not outside."""
    return F.coalesce((c < low) | (c > high), F.lit(False))


def not_in(c: Column, values: Sequence) -> Column:
    """Not one of the values, where a missing value also counts as not being one."""
    return ~F.coalesce(c.isin(*values), F.lit(False))


def percent(n: Column, of: Column) -> Column:
    return F.try_divide(n * F.lit(100.0), of)


def ensure_text(c: Column, default: str = "N/A") -> Column:
    """A default for missing or empty text."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def moment(at: datetime) -> Column:
    """A zone-free timestamp literal; it folds to a constant and is pushed to the scan."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def hourly_path(ts: Column) -> Column:
    return F.date_format(ts, HOURLY_LAYOUT)


def snapshot_name(ts: Column) -> Column:
    return F.date_format(ts, SNAPSHOT_STAMP)


def date_parts(ts: Column) -> dict[str, Column]:
    """Zero-padded year, month and day as text, the partition keys of the raw zone."""
    return {"year": F.date_format(ts, "yyyy"), "month": F.date_format(ts, "MM"), "day": F.date_format(ts, "dd")}
