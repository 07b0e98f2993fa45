"""Filling missing values. ``fit_*`` learns a few numbers, ``apply`` is a projection."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.functions.scalars import to_number
from millrace.operators.counts import category_codes, fit_categories, modes
from millrace.operators.quantiles import fit_quantiles
from millrace.operators.schema import dtype_of
from millrace.session import write_through


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Missing cells (NULL or NaN) of each column get the column's value."""
    out = {}
    for c, v in values.items():
        if v is None or c not in df.columns:
            continue
        dtype = dtype_of(df, c)
        known = F.when(~F.isnan(c), F.col(c)) if dtype.typeName() in ("double", "float") else F.col(c)
        out[c] = F.coalesce(known, F.lit(v).cast(dtype) if isinstance(v, str) else F.lit(v))
    return df.withColumns(out) if out else df


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    return {c: q["q50"] for c, q in fit_quantiles(df, columns, {"q50": 0.5}).items()}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    if not columns:
        return {}
    return {r["column_name"]: r["mode"] for r in modes(df, columns).collect()}


def mean_code_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column the category whose alphabetical code is the rounded mean code.

    (column_name, mean_code, code, value). Works on distinct values; halves round to even,
    the result is clipped to the codes that exist. A constant column yields its only value.
    """
    codes = category_codes(df, columns)
    means = (
        codes.groupBy("column_name")
        .agg((F.sum(F.col("n") * F.col("code")) / F.sum("n")).alias("mean_code"), F.max("code").alias("top"))
        .withColumn("code", F.greatest(F.lit(0), F.least(F.col("top"), F.rint("mean_code"))).cast("bigint"))
    )
    return codes.select("column_name", "code", "value").join(
        means.select("column_name", "code", "mean_code"), ["column_name", "code"]
    )


def fit_mean_codes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The category to fill in per column; see ``mean_code_categories``."""
    if not columns:
        return {}
    small = fit_categories(df, columns)
    if small is None:
        return {r["column_name"]: r["value"] for r in mean_code_categories(df, columns).collect()}
    return mean_codes_of(small)


def mean_codes_of(categories: Mapping[str, Sequence[tuple[str, int]]]) -> dict[str, str]:
    """The same from fitted categories: (value, n) pairs in alphabetical order per column."""
    out = {}
    for c, pairs in categories.items():
        if pairs:
            mean = sum(code * n for code, (_, n) in enumerate(pairs)) / sum(n for _, n in pairs)
            out[c] = pairs[min(round(mean), len(pairs) - 1)][0]
    return out


# --- Chained numeric imputation -------------------------------------------------------
#
# Rows that miss the same cells have the same regressions done to them, so one pass over the
# data, summing products of (1, cells) per missingness pattern, holds all the regressions need.
# The table of these (k+1) x (k+1) matrices is the state, and stays distributed. Filling a column
# with a linear combination of the others changes a matrix by the same combination of its rows
# and columns, so a step needs nothing else: tasks bring their patterns up to date and hand on one
# sum over the patterns that have the target; the driver solves one regression with it. The
# state is written anew after each round. A model is the list of regressions, whatever the number
# of patterns. Few columns with holes can't make more than ``FEW_PATTERNS`` patterns, whatever the
# table holds: only then, by the schema and not by the data, the driver itself keeps the state.

#: Patterns that 12 columns with holes have at most.
FEW_PATTERNS = 1 << 12


def fit_chained(df: DataFrame, columns: Sequence[str], rounds: int = 20) -> dict:
    """Learn the regressions of round-robin Bayesian ridge imputation.

    Starts from the means, fits each column with holes on all others (fewest holes first)
    and does so ``rounds`` times. Any number of columns may have holes, in any number of patterns.
    When a round repeats the regressions of the one before it, so do all that follow.
    """
    columns = list(columns)
    k = len(columns)
    numbers = [to_number(F.col(c), dtype_of(df, c)) for c in columns]
    summary = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(x).alias(f"n{i}") for i, x in enumerate(numbers)],
        *[F.avg(x).alias(f"a{i}") for i, x in enumerate(numbers)],
    ).first()
    counts = np.array([summary[f"n{i}"] for i in range(k)])
    if summary["rows"] and (counts == 0).any():
        raise ValueError(f"nothing observed in {[c for c, n in zip(columns, counts) if n == 0]}")
    holed = [i for i in range(k) if counts[i] < summary["rows"]]
    means = np.array([summary[f"a{i}"] for i in range(k)], dtype=float)
    model = {"columns": columns, "holed": holed, "means": means, "steps": []}
    if not holed or k < 2:
        return model
    sums = _pattern_sums(df, numbers, holed, means)
    state = (_HeldPatterns if 1 << len(holed) <= FEW_PATTERNS else _WrittenPatterns)(sums, holed, k)
    order = sorted(holed, key=lambda i: (summary["rows"] - counts[i], i))
    before: list = []
    for done in range(rounds):
        steps: list = []
        for target in order:
            steps.append(_regress(state.known_sum(target, steps), target))
        model["steps"] += steps
        if _same_steps(before, steps):
            model["steps"] += steps * (rounds - 1 - done)
            break
        before = steps
        if done + 1 < rounds:
            state.advance(steps)
    return model


def _pattern(numbers, holed):
    """The missingness pattern of a row: a 1 for each missing cell among the columns with holes."""
    return F.concat(*[F.when(numbers[i].isNull(), "1").otherwise("0") for i in holed])


def _pattern_sums(df, numbers, holed, means) -> DataFrame:
    """(pattern, sums): the product sums of (1, centred cells), holes at the mean, row after row of the square."""
    k = len(numbers)
    centred = df.select(
        _pattern(numbers, holed).alias("pattern"),
        *[F.coalesce(numbers[i] - F.lit(float(means[i])), F.lit(0.0)).alias(f"x{i + 1}") for i in range(k)],
    )
    sums = {(0, 0): "count(1)"}
    sums |= {(0, i): f"sum(x{i})" for i in range(1, k + 1)}
    sums |= {(i, j): f"sum(x{i} * x{j})" for i in range(1, k + 1) for j in range(i, k + 1)}
    found = centred.groupBy("pattern").agg(*[F.expr(f"double({text}) as g_{i}_{j}") for (i, j), text in sums.items()])
    square = ", ".join(f"g_{min(i, j)}_{max(i, j)}" for i in range(k + 1) for j in range(k + 1))
    return found.select("pattern", F.expr(f"array({square})").alias("sums"))


def _advance(square: np.ndarray, missing: np.ndarray, steps: list) -> None:
    """Fill the matrices of many patterns, in place, by the steps (target, weights with the intercept first)."""
    for target, weights in steps:
        at = np.flatnonzero(missing[:, target])
        if len(at):
            g = square[at]
            row = weights @ g
            row[:, target + 1] = row @ weights
            g[:, target + 1, :], g[:, :, target + 1] = row, row
            square[at] = g


def _missing(patterns: pa.Array, holed: list[int], k: int) -> np.ndarray:
    missing = np.zeros((len(patterns), k), bool)
    missing[:, holed] = [[mark == "1" for mark in p] for p in patterns.to_pylist()]
    return missing


class _HeldPatterns:
    """The matrices of a bounded number of patterns."""

    def __init__(self, sums: DataFrame, holed: list[int], k: int) -> None:
        rows = sums.toArrow().combine_chunks()
        self.missing = _missing(rows["pattern"], holed, k)
        self.square = rows["sums"].combine_chunks().flatten().to_numpy().reshape(-1, k + 1, k + 1).copy()
        self.done = 0

    def known_sum(self, target: int, steps: list) -> np.ndarray:
        """The product sums over all rows that have the target, after these steps of the round."""
        _advance(self.square, self.missing, steps[self.done :])
        self.done = len(steps)
        return self.square[~self.missing[:, target]].sum(axis=0)

    def advance(self, steps: list) -> None:
        """End the round of these steps."""
        _advance(self.square, self.missing, steps[self.done :])
        self.done = 0


class _WrittenPatterns:
    """The same for any number of patterns: a table in the shared folder, worked on in tasks."""

    def __init__(self, sums: DataFrame, holed: list[int], k: int) -> None:
        self.state, self.holed, self.k = write_through(sums, "impute-patterns"), holed, k

    def _each(self, steps: list):
        holed, k = self.holed, self.k

        def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
            for batch in batches:
                missing = _missing(batch.column("pattern"), holed, k)
                square = batch.column("sums").flatten().to_numpy().reshape(-1, k + 1, k + 1).copy()
                _advance(square, missing, steps)
                yield batch, square, missing

        return squares

    def known_sum(self, target: int, steps: list) -> np.ndarray:
        each, k = self._each(steps), self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k + 1, k + 1))
            for _, square, missing in each(batches):
                total += square[~missing[:, target]].sum(axis=0)
            yield pa.record_batch({"place": np.arange(total.size), "x": total.ravel()})

        parts = self.state.mapInArrow(run, "place long, x double").groupBy("place").agg(F.sum("x").alias("x")).toArrow()
        total = np.zeros((k + 1) * (k + 1))
        total[parts["place"].to_numpy()] = parts["x"].to_numpy()
        return total.reshape(k + 1, k + 1)

    def advance(self, steps: list) -> None:
        each = self._each(steps)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, square, _ in each(batches):
                ends = pa.array(np.arange(len(square) + 1, dtype=np.int32) * square[0].size)
                yield pa.RecordBatch.from_arrays([batch.column("pattern"), pa.ListArray.from_arrays(ends, pa.array(square.ravel()))], ["pattern", "sums"])

        self.state = write_through(self.state.mapInArrow(run, "pattern string, sums array<double>"), "impute-patterns")


def _regress(g: np.ndarray, target: int) -> tuple[int, np.ndarray]:
    """Bayesian ridge of one column on the others: (target, intercept and weights, 0 at the target)."""
    n = g[0, 0]
    x_index = [i for i in range(1, g.shape[0]) if i != target + 1]
    x_mean, y_mean = g[0, x_index] / n, g[0, target + 1] / n
    xx = g[np.ix_(x_index, x_index)] - n * np.outer(x_mean, x_mean)
    xy = g[x_index, target + 1] - n * x_mean * y_mean
    yy = g[target + 1, target + 1] - n * y_mean**2
    weights = np.zeros(g.shape[0])
    weights[x_index] = bayesian_ridge(xx, xy, yy, n)
    weights[0] = y_mean - weights[x_index] @ x_mean
    return target, weights


def _same_steps(before: list, steps: list) -> bool:
    """Whether two rounds have the same regressions, but for rounding."""
    return bool(before) and all(np.abs(a - b).max() <= 1e-13 * np.abs(b).max() for (_, a), (_, b) in zip(before, steps))


def bayesian_ridge(xx, xy, yy, n, max_iter: int = 300, tol: float = 1e-3, prior: float = 1e-6):
    """Evidence maximisation for ridge regression from centred product sums (MacKay 1992).

    Gamma(prior, prior) hyperpriors on the noise precision and the weight precision.
    """
    values, vectors = np.linalg.eigh(xx)
    values = np.clip(values, 0.0, None)
    rotated = vectors.T @ xy
    noise = 1.0 / (yy / n + np.finfo(float).eps)
    decay = 1.0
    weights = np.zeros(len(xy))

    def solve(noise, decay):
        w = vectors @ (rotated / (values + decay / noise))
        return w, max(yy - 2.0 * w @ xy + w @ xx @ w, 0.0)

    for i in range(max_iter):
        old = weights
        weights, residual = solve(noise, decay)
        used = np.sum(noise * values / (decay + noise * values))
        decay = (used + 2.0 * prior) / (weights @ weights + 2.0 * prior)
        noise = (n - used + 2.0 * prior) / (residual + 2.0 * prior)
        if i and np.sum(np.abs(old - weights)) < tol:
            break
    return solve(noise, decay)[0]


def apply_chained(df: DataFrame, model: dict) -> DataFrame:
    """Fill the holes: the row's pattern fetches its weights, one product sum fills each column.

    The weights of each pattern that the rows have, seen when fitting or not, follow from
    the model's steps and are made in tasks. They reach the rows by a join on the pattern.
    """
    columns, holed = model["columns"], model["holed"]
    numbers = [to_number(F.col(c), dtype_of(df, c)) for c in columns]
    out = {c: numbers[i] for i, c in enumerate(columns)}
    if not model["steps"]:
        out |= {columns[i]: F.coalesce(numbers[i], F.lit(float(model["means"][i]))) for i in holed}
        return df.withColumns(out)
    pattern, weights = "__pattern", {i: f"__weights_{i}" for i in holed}
    schema = ", ".join([f"{pattern} string", *[f"{w} array<double>" for w in weights.values()]])
    found = df.select(_pattern(numbers, holed).alias(pattern)).distinct().where(F.col(pattern).contains("1"))
    table = write_through(found.mapInArrow(_weights_of(model, pattern, weights), schema), "impute-weights")
    joined = df.join(table, _pattern(numbers, holed) == F.col(pattern), "left")
    for i, w in weights.items():
        value = F.get(w, F.lit(0))
        for j in range(len(columns)):
            if j != i:
                value = value + F.get(w, F.lit(j + 1)) * F.coalesce(numbers[j], F.lit(0.0))
        # Cells beyond those of the fit: a column that had no holes then is left as it is.
        out[columns[i]] = F.coalesce(numbers[i], value)
    return joined.withColumns(out).select(*df.columns)


def _weights_of(model: dict, pattern: str, weights: Mapping[int, str]):
    """Per pattern, for each missing column, the constant and the weight of each observed cell; null for the others."""
    k, holed, means = len(model["columns"]), model["holed"], model["means"]
    at_once = max(1, (1 << 22) // (k + 1) ** 2)

    def maps_of(missing: np.ndarray) -> np.ndarray:
        # Observed cells map to themselves; a missing cell starts at the mean, which is 0 here.
        maps = np.broadcast_to(np.eye(k + 1), (len(missing), k + 1, k + 1)).copy()
        at, column = np.nonzero(missing)
        maps[at, column + 1, column + 1] = 0.0
        lacking = [np.flatnonzero(missing[:, i]) for i in range(k)]
        for target, w in model["steps"]:
            maps[lacking[target], target + 1] = w @ maps[lacking[target]]
        # Back from centred cells: means move into the constants.
        maps[:, 1:, 0] += means - maps[:, 1:, 1:] @ means
        return maps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, at_once):
                batch = whole.slice(start, at_once)
                missing = _missing(batch.column(pattern), holed, k)
                maps = maps_of(missing)
                lists = [pa.array([m if gone else None for m, gone in zip(maps[:, i + 1], missing[:, i])], pa.list_(pa.float64())) for i in weights]
                yield pa.RecordBatch.from_arrays([batch.column(pattern), *lists], [pattern, *weights.values()])

    return run


def impute_chained(df: DataFrame, columns: Sequence[str], rounds: int = 20) -> DataFrame:
    return apply_chained(df, fit_chained(df, columns, rounds))
