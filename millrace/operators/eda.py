"""Exploratory statistics as tables."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.functions.scalars import to_number
from millrace.operators.counts import modes
from millrace.operators.quality import FENCE_FACTOR
from millrace.operators.quantiles import QUARTILES, exact_quantiles, fit_quantiles, long_numbers
from millrace.operators.schema import dtype_of, numeric_columns, text_columns
from millrace.session import short_methods, write_through

GRID_POINTS = 200
#: Bandwidths that a value reaches: exp(-9 * 9 / 2) is 3e-18.
REACH = 9.0


def describe(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq for text; moments and quartiles for numbers."""
    numbers, texts = numeric_columns(df), text_columns(df)
    parts = []
    if numbers:
        moments = long_numbers(df, numbers).groupBy("column_name").agg(
            F.count("x").alias("count"),
            F.avg("x").alias("mean"),
            F.stddev_samp("x").alias("std"),
            F.min("x").alias("min"),
            F.max("x").alias("max"),
        )
        quartiles = exact_quantiles(df, numbers, QUARTILES).drop("n")
        parts.append(moments.join(quartiles, "column_name"))
    if texts:
        counted = df.agg(
            *[F.count(c).alias(f"n_{c}") for c in texts], *[F.count_distinct(F.col(c)).alias(f"u_{c}") for c in texts]
        ).select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("count"), F.col(f"u_{c}").alias("unique")
                        )
                        for c in texts
                    ]
                )
            )
        )
        top = modes(df, texts).withColumnRenamed("mode", "top")
        parts.append(counted.join(top, "column_name", "left"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    for c, t in (("unique", "bigint"), ("top", "string"), ("freq", "bigint"), ("mean", "double"), ("std", "double"),
                 ("min", "double"), ("q25", "double"), ("q50", "double"), ("q75", "double"), ("max", "double")):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    return out.select("column_name", "count", "unique", "top", "freq", "mean", "std", "min", "q25", "q50", "q75", "max")


def binary_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whether a column holds exactly two distinct non-missing values.

    True when minimum and maximum differ and nothing lies between them: two aggregates
    without a shuffle instead of a distinct count per column.
    """
    columns = list(columns or numeric_columns(df))
    numbers = {c: to_number(F.col(c), dtype_of(df, c)) for c in columns}
    ends = df.agg(
        *[F.min(x).alias(f"lo_{c}") for c, x in numbers.items()], *[F.max(x).alias(f"hi_{c}") for c, x in numbers.items()]
    ).first()
    tests = []
    for c, x in numbers.items():
        low, high = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if low is None or low == high:
            tests.append(F.lit(False).alias(f"b_{c}"))
        else:
            tests.append((F.count_if((x > F.lit(low)) & (x < F.lit(high))) == 0).alias(f"b_{c}"))
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"b_{c}").alias("is_binary")) for c in columns]
    return df.agg(F.count(F.lit(1)).alias("rows"), *tests).select(F.inline(F.array(*cells)))


def count_by_label(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(column_name, value, label, n) for each value and label."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.col(label).alias("label"), F.inline(F.array(*cells)))
        .groupBy("column_name", "value", "label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _gram(batches: Iterable[pa.RecordBatch], centres: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums over the rows where both columns of a pair are present, a row per pair for the whole task.

    With M the presence mask and X the centred cells, holes as zeros, the sums of all pairs are
    the products MM', XX', XM' and (X*X)M', batch by batch. A column whose sums over a batch show a spread
    far above rounding has different ends there; only where none did, its least and greatest cells are looked up.
    """
    k = len(centres)
    n, shared, sums, squares = (np.zeros((k, k)) for _ in range(4))
    low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    spread = np.ones((k, k), bool)
    spread[left, right] = spread[right, left] = False
    for batch in batches:
        raw = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float, copy=False)
        mask = ~np.isnan(raw)
        x = np.where(mask, raw - centres[:, None], 0.0)
        m = mask.astype(float)
        with np.errstate(all="ignore"):
            both, sum_of, square_of = m @ m.T, x @ m.T, (x * x) @ m.T
            n += both
            shared += x @ x.T
            sums += sum_of
            squares += square_of
            spread |= square_of - sum_of * sum_of / both > 1e-6 * square_of
        for j in np.flatnonzero(~spread.all(axis=0)):
            rest = ~spread[:, j]
            rows = mask[rest] & mask[j]
            low[rest, j] = np.minimum(low[rest, j], np.min(x[rest], axis=1, where=rows, initial=np.inf))
            high[rest, j] = np.maximum(high[rest, j], np.max(x[rest], axis=1, where=rows, initial=-np.inf))
    low[spread], high[spread] = -np.inf, np.inf
    i, j = left, right
    yield pa.record_batch({
        "pair": np.arange(len(left)), "n": n[i, j], "shared": shared[i, j], "sum_a": sums[i, j], "sum_b": sums[j, i],
        "square_a": squares[i, j], "square_b": squares[j, i], "low_a": low[i, j], "high_a": high[i, j], "low_b": low[j, i], "high_b": high[j, i],
    })


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(col_a, col_b, r) per pair over the rows where both are present; NULL without spread.

    A first pass learns the centre of each column, a second sums products of centred cells for
    all pairs at once, as products of matrices, batch by batch. A task hands on one row per pair,
    and the pairs are summed apart from each other, so a wide table stays a short plan.
    """
    columns = list(dict.fromkeys(c for pair in pairs for c in pair))
    place = {c: i for i, c in enumerate(columns)}
    numbers = df.select(*[to_number(F.col(c), dtype_of(df, c)).alias(f"y{i}") for c, i in place.items()])
    facts = ("avg", "min", "max")
    with short_methods(df.sparkSession):
        seen = numbers.agg(*[F.expr(f"{fact}(y{i}) as {fact}{i}") for i in place.values() for fact in facts]).first()

    def centre(i: int) -> float:
        # A constant column is centred on itself, so its spread is exactly 0.
        low = seen[f"min{i}"]
        return 0.0 if low is None else float(low if low == seen[f"max{i}"] else seen[f"avg{i}"])

    centres = np.array([centre(i) for i in place.values()])
    left, right = np.array([place[a] for a, _ in pairs]), np.array([place[b] for _, b in pairs])
    parts = ["n", "shared", "sum_a", "sum_b", "square_a", "square_b"]
    ends = ["low_a", "high_a", "low_b", "high_b"]
    schema = "pair long, " + ", ".join(f"{c} double" for c in (*parts, *ends))
    blocks = numbers.mapInArrow(lambda batches: _gram(batches, centres, left, right), schema)
    total = blocks.groupBy("pair").agg(
        *[F.sum(c).alias(c) for c in parts], *[(F.min if c.startswith("low") else F.max)(c).alias(c) for c in ends]
    )
    with short_methods(df.sparkSession):
        total = write_through(total, "correlations")
    spread = "(square_{0} - try_divide(sum_{0} * sum_{0}, n))"
    # A column may be constant on the shared rows only: rounding must not give it a spread.
    r = F.expr(
        "case when high_a > low_a and high_b > low_b then try_divide(shared - try_divide(sum_a * sum_b, n), "
        f"sqrt({spread.format('a')} * {spread.format('b')})) end"
    )
    named = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair long, col_a string, col_b string")
    return named.join(total, "pair", "left").select("col_a", "col_b", r.alias("r"))


def correlation_with_label(df: DataFrame, label: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Correlation of every column with the label, strongest first, undefined ones last."""
    columns = list(columns or [*numeric_columns(df, exclude=[label]), label])
    found = pair_correlations(df, [(c, label) for c in columns])
    return found.select(F.col("col_a").alias("column_name"), "r").orderBy(F.desc_nulls_last("r"), "column_name")


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col_a, col_b, r) for all ordered pairs of columns."""
    columns = list(columns or numeric_columns(df))
    return pair_correlations(df, [(a, b) for a in columns for b in columns])


def correlation_change(before: DataFrame, after: DataFrame, label: str) -> DataFrame:
    """Correlations with the label before and after a derivation; a new column has no before."""
    old = correlation_with_label(before, label).withColumnRenamed("r", "r_before")
    new = correlation_with_label(after, label).withColumnRenamed("r", "r_after")
    return old.join(new, "column_name", "full")


def bin_layout(df: DataFrame, column: str) -> tuple[float, float, int]:
    """(low, width, bins): the narrower of the Sturges and Freedman-Diaconis widths."""
    q = fit_quantiles(df, [column], {"low": 0.0, "q25": 0.25, "q75": 0.75, "high": 1.0}).get(column)
    if q is None:
        raise ValueError(f"no values in {column}")
    low, high, n = q["low"], q["high"], q["n"]
    if high == low:
        return low - 0.5, 1.0, 1
    sturges = (high - low) / (math.log2(n) + 1.0)
    freedman = 2.0 * (q["q75"] - q["q25"]) / n ** (1.0 / 3.0)
    chosen = min(sturges, freedman) if freedman > 0 else sturges
    bins = math.ceil((high - low) / chosen)
    return low, (high - low) / bins, bins


def histogram(df: DataFrame, column: str, label: str) -> DataFrame:
    """(label, bin, bin_start, n) with bins shared by all labels; empty bins have no row."""
    low, width, bins = bin_layout(df, column)
    x = to_number(F.col(column), dtype_of(df, column))
    place = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (
        df.where(x.isNotNull())
        .groupBy(F.col(label).alias("label"), place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.lit(low) + F.col("bin") * F.lit(width))
    )


def density(df: DataFrame, column: str, label: str, points: int = GRID_POINTS) -> DataFrame:
    """Gaussian density per label on a shared grid from minimum to maximum, Scott bandwidth.

    Equal values are counted first. A value reaches only the grid points within ``REACH``
    bandwidths: beyond that the kernel is below 1e-17, less than the rounding of a sum. So the more
    rows, and the narrower the bandwidth, the fewer points a row adds to. It does so inside a
    partial aggregate: only labels x grid points rows are shuffled.
    """
    x = to_number(F.col(column), dtype_of(df, column))
    known = df.where(x.isNotNull()).select(F.col(label).alias("label"), x.alias("x"))
    counts = known.groupBy("label", "x").agg(F.count(F.lit(1)).alias("n"))
    ends = known.agg(F.min("x").alias("low"), F.max("x").alias("high")).first()
    low, high = ends["low"] or 0.0, ends["high"] or 0.0
    step = (high - low) / (points - 1)
    spread = known.groupBy(F.col("label").alias("_label")).agg(F.count(F.lit(1)).alias("total"), F.stddev_samp("x").alias("sd"))
    bandwidth = F.col("sd") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    spread = write_through(spread.where("sd > 0").select("_label", "total", bandwidth.alias("bw")), "density-labels")
    at = F.lit(low) + F.col("point") * F.lit(step)
    kernel = F.col("n") * F.exp(-0.5 * F.pow((at - F.col("x")) / F.col("bw"), F.lit(2.0)))
    # A label with a spread lies between two different ends, so the step is not 0.
    first = F.greatest(F.lit(0.0), F.ceil((F.col("x") - REACH * F.col("bw") - F.lit(low)) / F.lit(step or 1.0)))
    last = F.least(F.lit(points - 1.0), F.floor((F.col("x") + REACH * F.col("bw") - F.lit(low)) / F.lit(step or 1.0)))
    near = F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))
    mass = (
        counts.join(spread, F.col("label").eqNullSafe(F.col("_label")))
        .select("label", "x", "n", "bw", F.explode(near).alias("point"))
        .groupBy(F.col("label").alias("_of"), F.col("point").alias("_point"))
        .agg(F.sum(kernel).alias("mass"))
    )
    grid = spread.select(F.col("_label").alias("label"), "total", "bw", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    return grid.join(mass, F.col("label").eqNullSafe(F.col("_of")) & (F.col("point") == F.col("_point")), "left").select(
        "label",
        "point",
        at.alias("x"),
        (F.coalesce("mass", F.lit(0.0)) / (F.col("total") * F.col("bw") * math.sqrt(2.0 * math.pi))).alias("density"),
    )


def box_plot(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Quartiles, whiskers (furthest points inside the fences) and outlier counts per label."""
    quartiles = exact_quantiles(df, columns, QUARTILES, by=[label])
    spread = F.lit(FENCE_FACTOR) * (F.col("q75") - F.col("q25"))
    fences = quartiles.select(
        F.col(label).alias("_label"),
        F.col("column_name").alias("_column"),
        "q25",
        "q50",
        "q75",
        (F.col("q25") - spread).alias("lower"),
        (F.col("q75") + spread).alias("upper"),
    )
    x = F.col("x")
    inside = (x >= F.col("lower")) & (x <= F.col("upper"))
    return (
        long_numbers(df, columns, [label])
        .join(fences, F.col(label).eqNullSafe(F.col("_label")) & (F.col("column_name") == F.col("_column")))
        .groupBy("column_name", F.col(label).alias("label"), "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("n_outliers"),
            F.count(F.lit(1)).alias("n"),
        )
    )
