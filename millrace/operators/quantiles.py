"""Exact quantiles by counting, without gathering or sorting a column.

Radix selection: doubles are mapped to integers of the same order, and the values of each
column and group are counted by their leading bits. The running sum of the counts shows which
leading bits hold each wanted rank; only values with those bits are counted again by their next
bits, until a span holds one distinct value. Counts are summed per task before they are shuffled.

Without groups a scan ends in at most 2^16 counts per column, whatever the table holds, so the
driver picks the spans, and at most four scans serve all columns and ranks. With groups, of which
there may be any number, spans are picked in tasks by a window over at most 2^22 counts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.scalars import to_number
from millrace.operators.schema import dtype_of
from millrace.session import write_through

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
#: How far the key is shifted in each scan, without and with groups.
SHIFTS, GROUP_SHIFTS = (48, 32, 16, 0), (44, 22, 0)


def long_numbers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per non-missing cell: (*by, column_name, x as double)."""
    cells = [
        F.struct(F.lit(c).alias("column_name"), to_number(F.col(c), dtype_of(df, c)).alias("x")) for c in columns
    ]
    return df.select(*by, F.inline(F.array(*cells))).where("x is not null")


def with_order_key(df: DataFrame, x: str, key: str) -> DataFrame:
    """Add ``key``: the double column ``x`` as a bigint of the same order; -0.0 and 0.0 are equal.

    The key is made of exponent and fraction. The exponent is estimated by a logarithm and set
    right by the scaled value; powers of two scale without rounding. Each step is a column of
    its own, so that it is computed once.
    """
    estimate = f"least(1023D, floor(log2(greatest(abs({x}), 2.2250738585072014E-308D))))"
    placed = (
        f"case when abs({x}) = double('inf') then 9218868437227405312 "
        "when _scaled >= 2D then (cast(_power as bigint) + 1023) * 4503599627370496 + cast(_scaled * 2251799813685248D as bigint) "
        "when _scaled < 1D and _power > -1022D then (cast(_power as bigint) + 1021) * 4503599627370496 + cast(_scaled * 9007199254740992D as bigint) "
        "else (cast(_power as bigint) + 1022) * 4503599627370496 + cast(_scaled * 4503599627370496D as bigint) end"
    )
    return (
        df.withColumn("_power", F.expr(estimate))
        .withColumn("_scaled", F.expr(f"abs({x}) / pow(2D, _power)"))
        .withColumn("_key", F.expr(placed))
        .withColumn(key, F.expr(f"case when {x} < 0D then -_key else _key end"))
        .drop("_power", "_scaled", "_key")
    )


def _places(size, probs: Mapping[str, float]) -> list[tuple]:
    """Per probability the ranks around its place among ``size`` values, and how far it lies between them."""
    out = []
    for p in probs.values():
        place = (size - 1) * float(p)
        low = math.floor(place)
        out.append((low, min(low + 1, size - 1), place - low))
    return out


def _between(a: float, z: float, part: float) -> float:
    return a if a == z else a + part * (z - a)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Mapping[str, float] = QUARTILES,
    by: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles per column and group: (*by, column_name, n, *probs)."""
    if by:
        return _grouped_quantiles(df, columns, probs, by)
    fitted = fit_quantiles(df, columns, probs)
    schema = "column_name string, n long, " + ", ".join(f"{p} double" for p in probs)
    return df.sparkSession.createDataFrame([(c, q["n"], *[q[p] for p in probs]) for c, q in fitted.items()], schema)


def fit_quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float] = QUARTILES) -> dict:
    """{column: {"column_name": column, "n": rows, name: quantile, ...}}; columns without values are left out."""
    if not columns:
        return {}
    cells = with_order_key(long_numbers(df, columns), "x", "key")
    sizes: dict[str, int] = {}
    found: dict[tuple[str, int], float] = {}
    # Spans to look into: (column, leading bits) with the ranks wanted there, and the values below it.
    inside: dict[tuple[str, int], tuple[list[int], int]] = {}
    for level, shift in enumerate(SHIFTS):
        counted = _counts(cells, shift, SHIFTS[level - 1] if level else None, list(inside))
        inside_next: dict = {}
        for (column, above), spans in counted.items():
            if not level:
                sizes[column] = sum(n for _, n, _, _ in spans)
                wanted, below = sorted({r for low, high, _ in _places(sizes[column], probs) for r in (low, high)}), 0
            else:
                wanted, below = inside[column, above]
            for prefix, n, low, high in sorted(spans):
                here = [r for r in wanted if below <= r < below + n]
                if here and low == high:
                    found.update({(column, r): low for r in here})
                elif here:
                    inside_next[column, prefix] = (here, below)
                below += n
        inside = inside_next
        if not inside:
            break
    out = {}
    for c in columns:
        if c in sizes:
            values = [_between(found[c, low], found[c, high], part) for low, high, part in _places(sizes[c], probs)]
            out[c] = {"column_name": c, "n": sizes[c], **dict(zip(probs, values))}
    return out


def _counts(cells: DataFrame, shift: int, above: int | None, inside: list[tuple[str, int]]) -> dict:
    """{(column, bits above): [(bits, n, least, largest)]} of the cells in these spans, of all at first."""
    if above is not None:
        by_column: dict[str, list[int]] = {}
        for column, prefix in inside:
            by_column.setdefault(column, []).append(prefix)
        held = [(F.col("column_name") == c) & F.shiftright("key", above).isin(prefixes) for c, prefixes in by_column.items()]
        cells = cells.where(reduce(lambda a, b: a | b, held))
    counted = cells.groupBy("column_name", F.shiftright("key", shift).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    out: dict = {}
    for column, prefix, n, low, high in zip(*(c.to_pylist() for c in counted.toArrow().columns)):
        out.setdefault((column, prefix >> (above - shift) if above is not None else 0), []).append((prefix, n, low, high))
    return out


def _ranks(size: Column, probs: Mapping[str, float]) -> list[tuple[Column, Column, Column]]:
    """As ``_places``, for a column of sizes."""
    out = []
    for p in probs.values():
        place = (size - 1) * F.lit(float(p))
        low = F.floor(place)
        out.append((low, F.least(low + 1, size - 1), place - low))
    return out


def _grouped_quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str]) -> DataFrame:
    groups = [f"_by{i}" for i in range(len(by))]
    cells = with_order_key(long_numbers(df, columns, by).toDF(*groups, "column_name", "x"), "x", "key")
    keys = [*groups, "column_name"]
    spans = _scan(cells, keys, probs, GROUP_SHIFTS[0], None)
    settled = [spans.where("low = high")]
    for above, shift in zip(GROUP_SHIFTS, GROUP_SHIFTS[1:]):
        open_spans = spans.where("low < high")
        if open_spans.isEmpty():
            break
        spans = _scan(cells, keys, probs, shift, (open_spans, above))
        settled.append(spans.where("low = high"))
    found = reduce(DataFrame.unionByName, settled)
    picks, outputs = [], []
    for i, (name, (low, high, part)) in enumerate(zip(probs, _ranks(F.col("size"), probs))):
        for end, rank in (("a", low), ("z", high)):
            picks.append(F.max(F.when(F.array_contains("wanted", rank), F.col("low"))).alias(f"{end}{i}"))
        a, z = F.col(f"a{i}"), F.col(f"z{i}")
        outputs.append(F.when(a == z, a).otherwise(a + part * (z - a)).alias(name))
    named = [F.col(g).alias(b) for g, b in zip(groups, by)]
    return found.groupBy(*keys, "size").agg(*picks).select(*named, "column_name", F.col("size").alias("n"), *outputs)


def _scan(cells: DataFrame, keys: list[str], probs: Mapping[str, float], shift: int, inside: tuple[DataFrame, int] | None) -> DataFrame:
    """The spans of keys with equal leading bits that hold a wanted rank, with their ends and what lies before them."""
    outer = list(keys)
    if inside:
        spans, above = inside
        known = spans.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("prefix").alias("above"), F.col("start").alias("base"), "size")
        match = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.shiftright("key", above) == F.col("above")]
        cells = cells.join(known, reduce(lambda a, b: a & b, match))
        outer += ["above", "base", "size"]
    counted = cells.groupBy(*outer, F.shiftright("key", shift).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )
    before = Window.partitionBy(*outer).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("base") if inside else F.lit(0)
    counted = counted.withColumn("start", base + F.coalesce(F.sum("n").over(before), F.lit(0)))
    if not inside:
        counted = counted.withColumn("size", F.sum("n").over(Window.partitionBy(*outer)))
    ranks = F.array_distinct(F.array(*[r for low, high, _ in _ranks(F.col("size"), probs) for r in (low, high)]))
    wanted = F.filter(ranks, lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
    held = counted.withColumn("wanted", wanted).where(F.size("wanted") > 0)
    return write_through(held.select(*keys, "size", "prefix", "start", "low", "high", "wanted"), "quantile-spans")
