"""Expectation suites: a list of rules compiled into one aggregate over the table."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Expectation:
    kind: str
    kwargs: dict = field(default_factory=dict)

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")


@dataclass(frozen=True)
class _Check:
    """The predicate that makes a row unexpected, and whether missing cells are judged."""

    unexpected: Column
    judges_missing: bool = False


def _between(c: Column, kwargs: dict) -> _Check:
    bad = F.lit(False)
    if kwargs.get("min_value") is not None:
        bad = bad | (c < kwargs["min_value"])
    if kwargs.get("max_value") is not None:
        bad = bad | (c > kwargs["max_value"])
    return _Check(F.coalesce(bad, F.lit(False)))


def _not_null(c: Column, kwargs: dict) -> _Check:
    return _Check(c.isNull(), judges_missing=True)


def _in_set(c: Column, kwargs: dict) -> _Check:
    return _Check(c.isNotNull() & ~c.isin(*kwargs["value_set"]))


# Add an entry to support another row-level expectation.
COLUMN_EXPECTATIONS: dict[str, Callable[[Column, dict], _Check]] = {
    "expect_column_values_to_be_between": _between,
    "expect_column_values_to_not_be_null": _not_null,
    "expect_column_values_to_be_in_set": _in_set,
}
ROW_COUNT = "expect_table_row_count_to_be_between"


def load_suite(document: str | dict) -> list[Expectation]:
    """Read a suite from its JSON document: {"expectations": [{expectation_type, kwargs}]}."""
    parsed = json.loads(document) if isinstance(document, str) else document
    return [Expectation(e["expectation_type"], dict(e.get("kwargs", {}))) for e in parsed["expectations"]]


def _check_of(df: DataFrame, rule: Expectation) -> _Check | None:
    if rule.kind not in COLUMN_EXPECTATIONS:
        raise ValueError(f"unknown expectation: {rule.kind}")
    if rule.column not in df.columns:
        return None
    return COLUMN_EXPECTATIONS[rule.kind](F.col(f"`{rule.column}`"), rule.kwargs)


def validate(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """One result row per rule, from a single pass over the table whatever the suite's size."""
    rows = F.col("rows")
    aggregates = {"rows": F.count(F.lit(1))}
    cells = []
    for i, rule in enumerate(suite):
        present = True
        if rule.kind == ROW_COUNT:
            low, high = rule.kwargs.get("min_value"), rule.kwargs.get("max_value")
            success = F.lit(True)
            if low is not None:
                success = success & (rows >= low)
            if high is not None:
                success = success & (rows <= high)
            n_missing = unexpected = F.lit(None).cast("bigint")
            judged = F.lit(None).cast("bigint")
        else:
            check = _check_of(df, rule)
            present = check is not None
            if present:
                missing_name = f"m_{rule.column}"
                aggregates[missing_name] = F.count_if(F.col(f"`{rule.column}`").isNull())
                aggregates[f"u_{i}"] = F.count_if(check.unexpected)
                n_missing, unexpected = F.col(f"`{missing_name}`"), F.col(f"u_{i}")
                judged = rows if check.judges_missing else rows - n_missing
                allowed = F.lit(1.0 - float(rule.kwargs.get("mostly", 1.0)))
                success = unexpected <= judged * allowed
            else:
                n_missing = unexpected = judged = F.lit(None).cast("bigint")
                success = F.lit(False)
        cells.append(
            F.struct(
                F.lit(i).alias("rule_no"),
                F.lit(rule.kind).alias("expectation"),
                F.lit(rule.column).cast("string").alias("column_name"),
                F.lit(present).alias("found"),
                success.alias("success"),
                rows.alias("element_count"),
                n_missing.alias("missing_count"),
                unexpected.alias("unexpected_count"),
                F.try_divide(unexpected * F.lit(100.0), judged).alias("unexpected_percent"),
            )
        )
    one = df.agg(*[c.alias(name) for name, c in aggregates.items()])
    return one.select(F.inline(F.array(*cells)))


def unexpected_samples(df: DataFrame, suite: Sequence[Expectation], top: int = 20) -> DataFrame:
    """The ``top`` most frequent unexpected values of each rule.

    Repeats are collapsed to (rule, value, count) before anything is ranked; the top list
    is kept by a bounded window, so a rule with very many unexpected values stays parallel.
    """
    cells = []
    for i, rule in enumerate(suite):
        if rule.kind == ROW_COUNT:
            continue
        check = _check_of(df, rule)
        if check is None or check.judges_missing:
            continue
        cells.append(F.struct(F.lit(i).alias("rule_no"), check.unexpected.alias("bad"), F.col(f"`{rule.column}`").cast("string").alias("value")))
    if not cells:
        return df.sparkSession.createDataFrame([], "rule_no int, value string, n long, place int")
    counted = (
        df.select(F.inline(F.array(*cells)))
        .where("bad")
        .groupBy("rule_no", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("rule_no").orderBy(F.desc("n"), "value")
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
