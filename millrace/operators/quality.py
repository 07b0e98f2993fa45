"""Rule-based data quality. Counting checks of one report share a single aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.scalars import not_in, outside, percent, to_number
from millrace.operators.counts import value_counts
from millrace.operators.quantiles import fit_quantiles
from millrace.operators.schema import dtype_of, numeric_columns, text_columns
from millrace.session import write_through

HIGH_CARDINALITY = 0.9
FENCE_FACTOR = 1.5
FENCE_PROBS = {"low": 0.0, "q25": 0.25, "q75": 0.75, "high": 1.0}

# Message texts of the report and the advice that belongs to them.
MISSING_MESSAGE = "%d missing (%.2f%%)"
SHARE_MESSAGE = "%d out of %d rows (%.2f%%)"
RANGE_SUFFIX = " are outside the expected range ({low}, {high})."
OUTLIER_SUFFIX = " are outliers."
BINARY_MESSAGE = "Binary column; outlier check not applicable."
WIDE_NUMERIC_MESSAGE = "High-cardinality numeric column; details omitted."
WIDE_TEXT_MESSAGE = "High-cardinality column with {n} unique values; details omitted."
INVALID_MESSAGE = "%d invalid values out of %d rows (%.2f%%)."
FOUND_MESSAGE = " Found: %d different ones, listed as rows."
ALL_VALID_SUFFIX = " (All values valid)"
UNIQUE_MESSAGE = "Unique values: %d, listed as rows."
DUPLICATES_MESSAGE = "%d duplicate rows found out of %d rows (%.2f%%)."
NOT_FOUND_SUFFIX = " column not found."
ADVICE = {
    "missing": "Consider imputing missing values (mean/median/mode) or dropping rows if appropriate.",
    "complete": "No action needed.",
    "duplicates": "Consider removing duplicate rows based on '{key}'.",
    "outliers": "Review outlier values; consider transformation or removal if they are errors.",
    "not found": "Ensure the column exists in the data source or update the validation expectations.",
    "invalid values": "Review unexpected categorical values and consider mapping them to valid values.",
    "out of": "Review and correct data entries or adjust the expected range if appropriate.",
    "other": "No specific resolution suggested.",
}


@dataclass(frozen=True)
class Rules:
    """What one source is expected to hold."""

    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    sets: Mapping[str, Sequence[str]] = field(default_factory=dict)
    key: str | None = None
    ignore: Sequence[str] = ()


def _rows(one_row: DataFrame, structs: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*structs)))


def _n() -> Column:
    return F.count(F.lit(1))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column with its position, type and the row count of the table."""
    cells = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("n_rows"),
        )
        for i, f in enumerate(df.schema)
    ]
    return _rows(df.agg(_n().alias("n_rows")), cells)


def missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing cells per column, in one pass without a shuffle of the data."""
    columns = list(columns or df.columns)
    one = df.agg(_n().alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"m_{c}").alias("n_missing"),
            F.col("rows").alias("n_rows"),
            percent(F.col(f"m_{c}"), F.col("rows")).alias("pct_missing"),
        )
        for c in columns
    ]
    return _rows(one, cells)


def cardinality(
    df: DataFrame, columns: Sequence[str] | None = None, relative_error: float | None = None
) -> DataFrame:
    """Distinct counts and the high-cardinality flag; text counts a missing value as one more.

    Exact counts come from the value counts: narrow rows (column, value), summed per task
    before the distinct values are shuffled. ``relative_error`` switches to sketches, which
    shuffle a few kilobytes per column: for a first look at wide tables.
    """
    columns = list(columns or df.columns)
    texts = set(text_columns(df))
    names = df.sparkSession.createDataFrame([(c, c in texts) for c in columns], "column_name string, is_text boolean")
    if relative_error is None:
        counted = value_counts(df, columns).groupBy("column_name").agg(
            F.count("value").alias("n_distinct"), F.max(F.col("value").isNull()).alias("holed"), F.sum("n").alias("n_rows")
        )
    else:
        one = df.agg(
            _n().alias("rows"),
            *[F.approx_count_distinct(c, relative_error).alias(f"d_{c}") for c in columns],
            *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in columns],
        )
        counted = _rows(one, [
            F.struct(F.lit(c).alias("column_name"), F.col(f"d_{c}").alias("n_distinct"), (F.col(f"m_{c}") > 0).alias("holed"), F.col("rows").alias("n_rows"))
            for c in columns
        ])
    found = names.join(counted, "column_name", "left").fillna(0, ["n_distinct", "n_rows"]).fillna(False, ["holed"])
    unique = F.col("n_distinct") + F.col("holed").cast("long")
    judged = F.when(F.col("is_text"), unique).otherwise(F.col("n_distinct"))
    return found.select(
        "column_name", "n_distinct", unique.alias("n_unique"), "n_rows", (judged >= F.lit(HIGH_CARDINALITY) * F.col("n_rows")).alias("high_cardinality")
    )


def unique_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every distinct value with its count, the missing one included, as rows."""
    return value_counts(df, columns)


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; missing keys are equal to each other."""
    per_key = df.groupBy(*key).agg(_n().alias("c"))
    one = per_key.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_rows"), _n().alias("keys"))
    extra = F.col("n_rows") - F.col("keys")
    return one.select(
        extra.alias("n_duplicates"), F.col("n_rows"), percent(extra, F.col("n_rows")).alias("pct_duplicates")
    )


def mark_duplicates(df: DataFrame, key: Sequence[str], order: Sequence[str], flag: str = "is_duplicate") -> DataFrame:
    """Flag every row of a key but the first by ``order`` (which must be unique per key).

    First rows come from a partially aggregated minimum and only repeated keys join back,
    so a key that fills a third of the table is split by the skew join, not sorted in one task.
    """
    first = F.min(F.struct(*order))
    repeated = (
        df.groupBy(*[F.col(k).alias(f"_{k}") for k in key])
        .agg(_n().alias("_c"), first.alias("_first"))
        .where("_c > 1")
        .drop("_c")
    )
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    later = F.col("_first").isNotNull() & (F.struct(*order) != F.col("_first"))
    return df.join(repeated, match, "left").select(*df.columns, later.alias(flag))


def _number(df: DataFrame, c: str) -> Column:
    return to_number(F.col(c), dtype_of(df, c))


def _at_most_two_values(x: Column, low, high) -> Column:
    """True when nothing lies strictly between minimum and maximum; needs no distinct count."""
    if low is None:
        return F.lit(True)
    return F.count_if((x > F.lit(low)) & (x < F.lit(high))) == 0


def range_check(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows outside an expected range per column; absent columns are reported, not failed."""
    present = [c for c in ranges if c in df.columns]
    bounds = df.agg(
        *[F.min(_number(df, c)).alias(f"lo_{c}") for c in present],
        *[F.max(_number(df, c)).alias(f"hi_{c}") for c in present],
        F.lit(1).alias("one"),
    ).first()
    aggregates = [_n().alias("rows")]
    for c in present:
        x = _number(df, c)
        aggregates.append(F.count_if(outside(x, *ranges[c])).alias(f"o_{c}"))
        aggregates.append(_at_most_two_values(x, bounds[f"lo_{c}"], bounds[f"hi_{c}"]).alias(f"b_{c}"))
    return _rows(df.agg(*aggregates), [_range_cell(c, c in present) for c in ranges])


def _range_cell(c: str, present: bool) -> Column:
    n, binary = (F.col(f"o_{c}"), F.col(f"b_{c}")) if present else (F.lit(None).cast("bigint"), F.lit(None).cast("boolean"))
    shown = F.when(~binary, n)
    return F.struct(
        F.lit(c).alias("column_name"),
        F.lit(present).alias("found"),
        binary.alias("is_binary"),
        shown.alias("n_outside"),
        F.col("rows").alias("n_rows"),
        percent(shown, F.col("rows")).alias("pct_outside"),
    )


def set_check(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values outside an expected set per column; a missing value counts as outside."""
    present = [c for c in sets if c in df.columns]
    one = df.agg(_n().alias("rows"), *[F.count_if(not_in(F.col(c), sets[c])).alias(f"i_{c}") for c in present])
    cells = []
    for c in sets:
        n = F.col(f"i_{c}") if c in present else F.lit(None).cast("bigint")
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in present).alias("found"),
                n.alias("n_invalid"),
                F.col("rows").alias("n_rows"),
                percent(n, F.col("rows")).alias("pct_invalid"),
            )
        )
    return _rows(one, cells)


def invalid_values(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """The distinct values found outside each expected set, with counts."""
    present = [c for c in sets if c in df.columns]
    unexpected = [
        (F.col("column_name") == c) & not_in(F.col("value"), [str(v) for v in sets[c]]) for c in present
    ]
    return value_counts(df, present).where(reduce(lambda a, b: a | b, unexpected, F.lit(False)))


def fit_fences(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Outlier fences per column from exact quartiles: q -/+ 1.5 interquartile ranges."""
    fitted = fit_quantiles(df, columns, FENCE_PROBS)
    out = {}
    for c in columns:
        q = fitted.get(c)
        if q is None:
            out[c] = {"low": None, "high": None, "q25": None, "q75": None, "lower": None, "upper": None}
            continue
        spread = FENCE_FACTOR * (q["q75"] - q["q25"])
        out[c] = {**q, "lower": q["q25"] - spread, "upper": q["q75"] + spread}
    return out


def _fence_aggregates(df: DataFrame, fences: Mapping[str, dict]) -> list[Column]:
    out = []
    for c, f in fences.items():
        x = _number(df, c)
        beyond = F.lit(False) if f["lower"] is None else outside(x, F.lit(f["lower"]), F.lit(f["upper"]))
        out.append(F.count_if(beyond).alias(f"t_{c}"))
        out.append(_at_most_two_values(x, f["low"], f["high"]).alias(f"tb_{c}"))
    return out


def iqr_outliers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows strictly beyond the fences, as a share of all rows; binary columns are skipped."""
    fences = fit_fences(df, columns)
    one = df.agg(_n().alias("rows"), *_fence_aggregates(df, fences))
    cells = []
    for c in columns:
        n = F.when(~F.col(f"tb_{c}"), F.col(f"t_{c}"))
        f = fences[c]
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"tb_{c}").alias("is_binary"),
                F.lit(f["q25"]).cast("double").alias("q25"),
                F.lit(f["q75"]).cast("double").alias("q75"),
                n.alias("n_outliers"),
                F.col("rows").alias("n_rows"),
                percent(n, F.col("rows")).alias("pct_outliers"),
            )
        )
    return _rows(one, cells)


def _cardinalities(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> dict:
    """Distinct counts for the report, exact wherever the limit is in question.

    A sketch of 5 % error settles the columns that are below the limit by a factor of
    nearly two; only the others pay for an exact count.
    """
    if not numbers and not texts:
        return {}
    found = {r["column_name"]: r for r in cardinality(df, [*numbers, *texts], relative_error=0.05).collect()}
    unsure = [c for c in (*numbers, *texts) if found[c]["n_unique"] > 0.5 * found[c]["n_rows"]]
    if unsure:
        found.update({r["column_name"]: r for r in cardinality(df, unsure).collect()})
    return found


def _share(n: Column, rows: Column, pattern: str) -> Column:
    return F.format_string(pattern, n, rows, F.coalesce(percent(n, rows), F.lit(0.0)))


def quality_report(df: DataFrame, rules: Rules) -> DataFrame:
    """The whole report as rows: (section, column_name, check, message, n, n_rows, final).

    Jobs over the data: some for the fences, one or two for distinct counts, one aggregate
    for everything that counts rows, one for the listed values, one for duplicates.
    ``final`` marks, per section and column, the check whose message stands when several
    checks hit the same column.

    Values are rows of the report, at any number: each distinct value of a text column
    below the high-cardinality limit (check ``value``) and each one outside its set (``invalid
    value``), with its count as ``n`` and itself as message, NULL for a missing one.
    """
    key = rules.key
    expected_numbers = [c for c in rules.ranges if c in df.columns]
    extra_numbers = numeric_columns(df, exclude=[*rules.ranges, *rules.ignore])
    # A text column with a range is read as numbers, so it is no text here.
    extra_texts = text_columns(df, exclude=[*rules.ranges, *rules.sets, *([key] if key else [])])
    counts_by = _cardinalities(df, extra_numbers, extra_texts)
    wide_numbers = [c for c in extra_numbers if counts_by[c]["high_cardinality"]]
    plain_numbers = [c for c in extra_numbers if c not in wide_numbers]
    expected_sets = [c for c in rules.sets if c in df.columns]
    wide_texts = [c for c in extra_texts if counts_by[c]["high_cardinality"]]
    listed = [c for c in extra_texts if c not in wide_texts]

    fences = fit_fences(df, [*expected_numbers, *plain_numbers])
    rows = F.col("rows")
    aggregates = [_n().alias("rows"), *_fence_aggregates(df, fences)]
    aggregates += [F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in df.columns]
    aggregates += [F.count_if(outside(_number(df, c), *rules.ranges[c])).alias(f"o_{c}") for c in expected_numbers]
    aggregates += [F.count_if(not_in(F.col(c), rules.sets[c])).alias(f"i_{c}") for c in expected_sets]

    cells: list[Column] = []

    def cell(order: int, section: str, column: str | None, check: str, message: Column, n: Column | None = None) -> None:
        cells.append(
            F.struct(
                F.lit(order).alias("check_order"),
                F.lit(section).alias("section"),
                F.lit(column).cast("string").alias("column_name"),
                F.lit(check).alias("check"),
                message.alias("message"),
                (F.lit(None) if n is None else n).cast("bigint").alias("n"),
                rows.alias("n_rows"),
            )
        )

    for c in df.columns:
        n = F.col(f"m_{c}")
        text = F.format_string(MISSING_MESSAGE, n, F.coalesce(percent(n, rows), F.lit(0.0)))
        cell(1, "missing_data", c, "missing", text, n)
    for c, (low, high) in rules.ranges.items():
        if c not in df.columns:
            cell(2, "columns", c, "range", F.lit(c + NOT_FOUND_SUFFIX))
            continue
        n = F.col(f"o_{c}")
        tail = RANGE_SUFFIX.format(low=low, high=high)
        text = F.concat(_share(n, rows, SHARE_MESSAGE), F.lit(tail))
        cell(2, "columns", c, "range", F.when(F.col(f"tb_{c}"), BINARY_MESSAGE).otherwise(text), F.when(~F.col(f"tb_{c}"), n))
    for c in extra_numbers:
        if c in wide_numbers:
            cell(3, "columns", c, "outliers", F.lit(WIDE_NUMERIC_MESSAGE))
        else:
            cell(3, "columns", c, "outliers", *_outlier_text(c, rows))
    for c in rules.sets:
        if c not in df.columns:
            cell(4, "columns", c, "set", F.lit(c + NOT_FOUND_SUFFIX))
            continue
        n = F.col(f"i_{c}")
        text = _share(n, rows, INVALID_MESSAGE)
        cell(4, "columns", c, "set", F.concat(text, F.when(n == 0, ALL_VALID_SUFFIX).otherwise("")), n)
    for c in wide_texts:
        text = WIDE_TEXT_MESSAGE.format(n=counts_by[c]["n_unique"])
        cell(5, "columns", c, "values", F.lit(text))
    for c in [*expected_numbers, *plain_numbers]:
        cell(7, "outliers", c, "outliers", *_outlier_text(c, rows))
    if key and key not in df.columns:
        cell(6, "duplicates", key, "duplicates", F.lit(key + NOT_FOUND_SUFFIX))
    report = _rows(df.agg(*aggregates), cells)

    # Distinct values, counted once: for the numbers in the messages, and as rows.
    values = write_through(value_counts(df, [*listed, *expected_sets]), "report-values")
    unexpected = [(F.col("column_name") == c) & not_in(F.col("value"), [str(v) for v in rules.sets[c]]) for c in expected_sets]
    invalid = values.where(reduce(lambda a, b: a | b, unexpected, F.lit(False)))
    if listed:
        per_column = values.where(F.col("column_name").isin(listed)).groupBy("column_name").agg(_n().alias("n"), F.sum("n").alias("n_rows"))
        report = report.unionByName(_as_rows(per_column, 5, "values", F.format_string(UNIQUE_MESSAGE, "n")))
    if expected_sets:
        kinds = invalid.groupBy("column_name").agg(F.format_string(FOUND_MESSAGE, _n()).alias("found")).withColumn("check", F.lit("set"))
        joined = report.join(kinds, ["column_name", "check"], "left")
        report = joined.withColumn("message", F.concat("message", F.coalesce("found", F.lit("")))).select(*report.columns)
    if key and key in df.columns:
        dup = duplicates(df, [key])
        text = _share(F.col("n_duplicates"), F.col("n_rows"), DUPLICATES_MESSAGE)
        report = report.unionByName(
            dup.select(
                F.lit(6).alias("check_order"),
                F.lit("duplicates").alias("section"),
                F.lit(key).alias("column_name"),
                F.lit("duplicates").alias("check"),
                text.alias("message"),
                F.col("n_duplicates").alias("n"),
                "n_rows",
            )
        )
    last = F.max("check_order").over(_per_column())
    report = report.withColumn("final", F.col("check_order") == last)
    # No check comes after these on their columns.
    n_rows = F.lit(counts_by[listed[0]]["n_rows"] if listed else None).cast("bigint")
    if listed:
        rows_of = values.where(F.col("column_name").isin(listed)).withColumn("n_rows", n_rows)
        report = report.unionByName(_as_rows(rows_of, 5, "value", F.coalesce("value", F.lit("NULL"))).withColumn("final", F.lit(True)))
    if expected_sets:
        total = values.where(F.col("column_name").isin(expected_sets)).groupBy("column_name").agg(F.sum("n").alias("n_rows"))
        rows_of = invalid.join(F.broadcast(total), "column_name")
        report = report.unionByName(_as_rows(rows_of, 4, "invalid value", F.coalesce("value", F.lit("NULL"))).withColumn("final", F.lit(True)))
    return report


def _per_column():
    # Report rows only: a handful per table column.
    return Window.partitionBy("section", "column_name")


def _outlier_text(c: str, rows: Column) -> tuple[Column, Column]:
    n, binary = F.col(f"t_{c}"), F.col(f"tb_{c}")
    text = F.concat(_share(n, rows, SHARE_MESSAGE), F.lit(OUTLIER_SUFFIX))
    return F.when(binary, BINARY_MESSAGE).otherwise(text), F.when(~binary, n)


def _as_rows(counted: DataFrame, order: int, check: str, message: Column) -> DataFrame:
    """Report rows from (column_name, n, n_rows) and what the message needs."""
    return counted.select(
        F.lit(order).alias("check_order"),
        F.lit("columns").alias("section"),
        "column_name",
        F.lit(check).alias("check"),
        message.alias("message"),
        "n",
        "n_rows",
    )


def resolutions(report: DataFrame, key: str | None = None) -> DataFrame:
    """One piece of advice per report row; the first rule that matches decides."""
    message, section = F.col("message"), F.col("section")
    advice = (
        F.when((section == "missing_data") & (F.col("n") == 0), ADVICE["complete"])
        .when(section == "missing_data", ADVICE["missing"])
        .when(section == "duplicates", ADVICE["duplicates"].format(key=key or "key"))
        .when(section == "outliers", ADVICE["outliers"])
    )
    # A listed value is no message, whatever it says.
    advice = advice.when(F.col("check") == "invalid value", ADVICE["invalid values"]).when(F.col("check") == "value", ADVICE["other"])
    for part in ("not found", "invalid values", "out of"):
        advice = advice.when(message.contains(part), ADVICE[part])
    return report.withColumn("resolution", advice.otherwise(ADVICE["other"]))
