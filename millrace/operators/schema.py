"""Schema-level operators: names, types, projections. All are narrow."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def text_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, (T.StringType, T.CharType, T.VarcharType)) and f.name not in skip
    ]


def dtype_of(df: DataFrame, column: str) -> T.DataType:
    return df.schema[column].dataType


def require(df: DataFrame, columns: Iterable[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")


def _rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    seen = {n for n in names if list(names).count(n) > 1}
    if seen:
        raise ValueError(f"renaming makes columns collide: {sorted(seen)}")
    return df.toDF(*names)


def clean_names(df: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Trim names, spaces to underscores, apply ``renames``, then lower case, in one pass."""
    renames = renames or {}
    stripped = [c.strip().replace(" ", "_") for c in df.columns]
    return _rename_all(df, [renames.get(c, c).lower() for c in stripped])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Give the columns fixed names by position; a different column count is an error."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns: {df.columns}")
    return _rename_all(df, list(names))


def integers_to_double(df: DataFrame) -> DataFrame:
    wide = [f.name for f in df.schema if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))]
    return df.withColumns({c: F.col(c).cast("double") for c in wide}) if wide else df


def normalize_nulls(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Turn missing-value spellings in text and NaN in floats into NULL."""
    out = {}
    for f in df.schema:
        if isinstance(f.dataType, T.StringType):
            out[f.name] = F.when(~F.col(f.name).isin(*tokens), F.col(f.name))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out[f.name] = F.when(~F.isnan(f.name), F.col(f.name))
    return df.withColumns(out) if out else df


def schema_report(df: DataFrame, declared: T.StructType) -> list[dict]:
    """How a table differs from a declared schema, column by column."""
    actual = {f.name: f.dataType for f in df.schema}
    report = []
    for f in declared:
        have = actual.get(f.name)
        if have is None:
            status = "missing"
        elif have == f.dataType:
            status = "ok"
        else:
            status = "cast"
        report.append(
            {
                "column_name": f.name,
                "declared": f.dataType.simpleString(),
                "delivered": have.simpleString() if have is not None else None,
                "status": status,
            }
        )
    known = {f.name for f in declared}
    for name, dtype in actual.items():
        if name not in known:
            report.append(
                {"column_name": name, "declared": None, "delivered": dtype.simpleString(), "status": "undeclared"}
            )
    return report


def conform(df: DataFrame, declared: T.StructType, required: bool = True) -> DataFrame:
    """Project to a declared schema in its order with its types.

    A missing column is an error. With ``required`` a NULL, or a value the declared type
    cannot hold, is an error at run time; without it such a value becomes NULL.
    """
    require(df, declared.names)
    out = []
    for f in declared:
        value = F.col(f.name).try_cast(f.dataType)
        if required:
            refused = F.raise_error(F.lit(f"{f.name}: value does not fit {f.dataType.simpleString()}"))
            value = F.when(value.isNull(), refused.cast(f.dataType)).otherwise(value)
        out.append(value.alias(f.name))
    return df.select(*out)


def conforming_rows(df: DataFrame, declared: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Split into rows that fit the declared schema (cast) and rows that do not (untouched)."""
    require(df, declared.names)
    fits = F.lit(True)
    for f in declared:
        fits = fits & F.col(f.name).try_cast(f.dataType).isNotNull()
    good = df.where(fits).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in declared])
    return good, df.where(~fits)
