"""Quantiles, imputation, scaling and statistics against numpy and pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions.scalars import label_to_int, text_to_number
from millrace.operators import counts, eda, encode, impute, metrics
from millrace.operators.quantiles import exact_quantiles, with_order_key


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0, 1.0, 2.0, 2.0], list(range(101)), [5.0] * 40 + [6.0], [float(v) ** 3 for v in range(-50, 51)],
])
def test_quantiles_equal_numpy(spark, values):
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double")
    row = exact_quantiles(df, ["x"], probs).first()
    assert row.n == len(values)
    for name, p in probs.items():
        assert row[name] == pytest.approx(np.quantile(values, p))


def test_quantiles_by_group(spark):
    """Groups, a missing one included; values so near to each other that all four scans are needed."""
    rnd = np.random.default_rng(1)
    near = 1.0 + np.arange(3000) % 700 * 2.0**-52
    values = np.concatenate([rnd.lognormal(size=20_000), -rnd.lognormal(size=500), near, [0.0, -0.0, 5e-324, -5e-324, 1e308]])
    groups = [None if g == 2 else str(g) for g in rnd.integers(0, 3, len(values))]
    df = spark.createDataFrame(list(zip(values.tolist(), groups)), "x double, g string")
    probs = {f"p{i}": i / 40 for i in range(41)}
    got = {r.g: r for r in exact_quantiles(df, ["x"], probs, by=["g"]).collect()}
    for g in (None, "0", "1"):
        part = values[[x == g for x in groups]]
        assert got[g].n == len(part)
        assert [got[g][name] for name in probs] == pytest.approx([np.quantile(part, p) for p in probs.values()], rel=1e-15)


def test_order_key_is_the_order_of_doubles(spark):
    rnd = np.random.default_rng(2)
    bits = rnd.integers(-(2**63), 2**63 - 1, 200_000).view(np.float64)
    powers = [s * np.nextafter(2.0**k, d) for k in range(-1074, 1024) for s in (1, -1) for d in (0, 2.0**k, np.inf)]
    values = np.concatenate([bits[np.isfinite(bits)], powers, [0.0, -0.0, 5e-324, np.inf, -np.inf, np.finfo(float).max]])
    made = with_order_key(spark.createDataFrame(pd.DataFrame({"x": values})), "x", "key").toPandas()
    want = np.abs(made.x.to_numpy()).view(np.int64) * np.where(made.x < 0, -1, 1)
    assert (made.key.to_numpy() == want).all()


def test_all_missing_column_has_no_quantiles(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_quantiles(df, ["x"]).count() == 0


@pytest.mark.parametrize("text,number", [
    ("12", 12.0), (" 12.50 ", 12.5), ("-3", -3.0), (".5", 0.5), ("1e3", 1000.0), ("1d", None), ("1_000", None),
    ("", None), (" ", None), ("n/a", None), ("NaN", None), ("--1", None), ("1,5", None), (None, None),
])
def test_text_to_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_to_number(F.col("t"))).first()[0] == number


def test_unmapped_label_is_an_error(spark):
    df = spark.createDataFrame([("Yes",), ("No",)], "t string")
    assert [r[0] for r in df.select(label_to_int(F.col("t"))).collect()] == [1, 0]
    with pytest.raises(Exception, match="neither"):
        spark.createDataFrame([("maybe",)], "t string").select(label_to_int(F.col("t"))).collect()


def chained_by_rows(x, rounds):
    """The same imputation done row by row on a full matrix."""
    x = x.copy()
    holes = np.isnan(x)
    filled = np.where(holes, np.nanmean(x, axis=0), x)
    order = [c for c in np.argsort(holes.sum(axis=0), kind="stable") if holes[:, c].any()]
    for _ in range(rounds):
        for c in order:
            others = np.delete(filled, c, axis=1)
            known = ~holes[:, c]
            xs, ys = others[known], x[known, c]
            xm, ym = xs.mean(axis=0), ys.mean()
            xc, yc = xs - xm, ys - ym
            w = impute.bayesian_ridge(xc.T @ xc, xc.T @ yc, yc @ yc, len(ys))
            filled[holes[:, c], c] = (others[holes[:, c]] - xm) @ w + ym
    return filled


@pytest.mark.parametrize("columns,held", [(2, True), (4, True), (2, False)])
def test_chained_imputation_equals_the_row_wise_chain(spark, monkeypatch, columns, held):
    monkeypatch.setattr(impute, "FEW_PATTERNS", impute.FEW_PATTERNS if held else 0)
    rnd = np.random.default_rng(columns)
    base = rnd.normal(size=(400, 2))
    x = np.column_stack([base @ rnd.normal(size=2) + 0.3 * rnd.normal(size=400) + 5 for _ in range(columns)])
    x[rnd.random(x.shape) < 0.15] = np.nan
    x[:, -1] = np.where(np.isnan(x[:, -1]), 1.0, x[:, -1])
    names = [f"c{i}" for i in range(columns)]
    pdf = pd.DataFrame(x, columns=names).assign(row=range(400))
    df = spark.createDataFrame(pdf).repartition(5)
    got = impute.impute_chained(df, names).orderBy("row").select(*names).toPandas().to_numpy()
    assert not np.isnan(got).any()
    np.testing.assert_allclose(got, chained_by_rows(x, 20), rtol=1e-8, atol=1e-8)


def test_chained_imputation_with_holes_in_twenty_columns(spark):
    rnd = np.random.default_rng(20)
    x = rnd.normal(size=(300, 2)) @ rnd.normal(size=(2, 20)) + 0.3 * rnd.normal(size=(300, 20))
    x[rnd.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(20)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(row=range(300))).repartition(5)
    got = impute.impute_chained(df, names, rounds=3).orderBy("row").select(*names).toPandas().to_numpy()
    np.testing.assert_allclose(got, chained_by_rows(x, 3), rtol=1e-6, atol=1e-6)


def test_chained_imputation_with_more_patterns_than_ever_fit_a_list(spark):
    """More than 20,000 patterns of holes in 20 columns: one round, against row-wise regressions."""
    rnd = np.random.default_rng(21)
    rows = 24_000
    x = rnd.normal(size=(rows, 3)) @ rnd.normal(size=(3, 20)) + 0.3 * rnd.normal(size=(rows, 20))
    x[rnd.random(x.shape) < 0.4] = np.nan
    names = [f"c{i}" for i in range(20)]
    assert len(np.unique(np.isnan(x), axis=0)) >= 20_000
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(row=range(rows))).repartition(8)
    got = impute.impute_chained(df, names, rounds=1).orderBy("row").select(*names).toPandas().to_numpy()
    np.testing.assert_allclose(got, chained_by_rows(x, 1), rtol=1e-6, atol=1e-6)


def test_patterns_unseen_when_fitting(spark):
    """A row that misses more than any row of the fit did is filled by the same regressions."""
    rnd = np.random.default_rng(22)
    x = rnd.normal(size=(300, 1)) * [1.0, 2.0, -1.0] + 0.1 * rnd.normal(size=(300, 3))
    x[::7, 0], x[3::7, 1] = np.nan, np.nan
    model = impute.fit_chained(spark.createDataFrame(pd.DataFrame(x, columns=["a", "b", "c"])), ["a", "b", "c"])
    row = impute.apply_chained(spark.createDataFrame([(None, None, 3.0)], "a double, b double, c double"), model).first()
    want = {0: model["means"][0], 1: model["means"][1]}
    for target, w in model["steps"]:
        cells = np.array([want[0], want[1], 3.0]) - model["means"]
        want[target] = model["means"][target] + w[0] + w[1:] @ cells
    assert (row.a, row.b, row.c) == (pytest.approx(want[0]), pytest.approx(want[1]), 3.0)


def test_ridge_recovers_a_linear_relation():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(500, 3))
    y = x @ np.array([1.0, -2.0, 0.5]) + 0.01 * rnd.normal(size=500)
    x, y = x - x.mean(axis=0), y - y.mean()
    np.testing.assert_allclose(impute.bayesian_ridge(x.T @ x, x.T @ y, y @ y, 500), [1, -2, 0.5], atol=0.01)


def test_chained_edge_cases(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "a double, b double")
    with pytest.raises(ValueError, match="nothing observed"):
        impute.fit_chained(df, ["a", "b"])
    full = spark.createDataFrame([(1.0, 2.0), (2.0, 5.0)], "a double, b double")
    assert impute.impute_chained(full, ["a", "b"]).collect() == full.collect()
    alone = spark.createDataFrame([(1.0,), (4.0,), (None,)], "a double")
    assert sorted(r[0] for r in impute.impute_chained(alone, ["a"]).collect()) == [1.0, 2.5, 4.0]


def test_mean_code_rounds_half_to_even_and_matches_the_distributed_form(spark):
    rows = [("a",), ("b",), (None,), ("b",), ("c",), ("a",)]
    df = spark.createDataFrame(rows, "v string")
    mean = (0 + 1 + 1 + 2 + 0) / 5
    assert impute.fit_mean_codes(df, ["v"]) == {"v": "abc"[round(mean)]}
    assert [r.value for r in impute.mean_code_categories(df, ["v"]).collect()] == ["b"]
    tie = spark.createDataFrame([("a",), ("b",)], "v string")
    assert impute.fit_mean_codes(tie, ["v"]) == {"v": "a"}
    assert [r.value for r in impute.mean_code_categories(tie, ["v"]).collect()] == ["a"]
    assert impute.fit_mean_codes(spark.createDataFrame([(None,)], "v string"), ["v"]) == {}


def test_codes_are_alphabetical_ranks(spark):
    df = spark.range(5000).selectExpr("cast(id * 7919 % 1300 as string) as v", "cast(id % 3 as string) as w")
    want = {(c, v): i for c, n in (("v", 1300), ("w", 3)) for i, v in enumerate(sorted(map(str, range(n))))}
    rows = counts.category_codes(df, ["v", "w"]).collect()
    assert {(r["column_name"], r["value"]): r["code"] for r in rows} == want and len(rows) == 1303


def test_codes_join(spark):
    df = spark.range(500).selectExpr("id", "case when id % 9 = 0 then null else cast(id % 50 as string) end as v")
    places = {v: i for i, v in enumerate(sorted(map(str, range(50))))}
    rows = encode.with_category_code(df, "v", "code").collect()
    assert len(rows) == 500 and all(r["code"] == places.get(r["v"], -1) for r in rows)


def test_zscore_of_constant_column_is_zero(spark):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in encode.zscore(df, ["x"]).collect()] == [0.0, 0.0, None]
    assert encode.minmax(df, ["x"]).where("x is not null").count() == 0


def test_onehot_properties(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,), ("a",)], "v string")
    out = encode.onehot(df, ["v"])
    assert out.columns == ["v_b", "v_c"]
    assert [tuple(r) for r in out.collect()] == [(False, False), (True, False), (False, True), (False, False), (False, False)]
    with pytest.raises(ValueError, match="more than 2"):
        encode.onehot(df, ["v"], limit=2)
    unseen = spark.createDataFrame([("z",)], "v string")
    assert tuple(encode.apply_onehot(unseen, {"v": ["a", "b"]}).first()) == (False,)


def test_describe_equals_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 2.0, 9.0], "t": ["a", "b", "b", None]})
    got = {r.column_name: r for r in eda.describe(spark.createDataFrame(pdf)).collect()}
    x = pdf.x.describe()
    assert (got["x"]["count"], got["x"]["mean"], got["x"]["q75"]) == (4, x["mean"], x["75%"])
    assert got["x"]["std"] == pytest.approx(x["std"])
    assert (got["t"]["unique"], got["t"]["top"], got["t"]["freq"]) == (2, "b", 2)


def test_correlation_edge_cases(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, None], "b": [2.0, 4.1, 6.0, 1.0], "c": [5.0] * 4, "y": [0, 1, 1, 0]})
    got = {r.column_name: r.r for r in eda.correlation_with_label(spark.createDataFrame(pdf), "y").collect()}
    want = pdf.corr()["y"]
    assert got["c"] is None
    for c in ("a", "b", "y"):
        assert got[c] == pytest.approx(want[c])
    partly = pd.DataFrame({"a": [0.1, 0.1, 0.1, 7.0], "b": [1.0, 2.0, 3.0, None]})
    assert {(r.col_a, r.col_b): r.r for r in eda.correlation_matrix(spark.createDataFrame(partly)).collect()}[("a", "b")] is None
    order = [r.column_name for r in eda.correlation_with_label(spark.createDataFrame(pdf), "y").collect()]
    assert order[0] == "y" and order[-1] == "c"


def test_histogram_counts_everything_and_keeps_the_maximum(spark):
    values = list(np.random.default_rng(2).normal(size=500))
    df = spark.createDataFrame(pd.DataFrame({"x": values, "y": [i % 2 for i in range(500)]}))
    rows = eda.histogram(df, "x", "y").collect()
    edges = np.histogram_bin_edges(values, "auto")
    want, _ = np.histogram(values, edges)
    assert sum(r.n for r in rows) == 500
    assert eda.bin_layout(df, "x")[2] == len(edges) - 1
    for b, n in enumerate(want):
        assert sum(r.n for r in rows if r.bin == b) == n


def test_density_integrates_to_about_one(spark):
    values = list(np.random.default_rng(3).normal(size=300))
    df = spark.createDataFrame(pd.DataFrame({"x": values, "y": [0] * 300}))
    rows = sorted(eda.density(df, "x", "y").collect(), key=lambda r: r.point)
    area = np.trapezoid([r.density for r in rows], [r.x for r in rows])
    assert 0.95 < area <= 1.0
    bw = 300 ** -0.2 * np.std(values, ddof=1)
    at = rows[100].x
    want = np.mean(np.exp(-0.5 * ((at - np.array(values)) / bw) ** 2)) / (bw * math.sqrt(2 * math.pi))
    assert rows[100].density == pytest.approx(want)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = metrics.binary_metrics(df, "y", "p").first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, _ = metrics.split_by_key(df.repartition(7), "k")
    b, rest = metrics.split_by_key(df.coalesce(1), "k")
    assert a.exceptAll(b).count() == 0
    assert b.count() + rest.count() == 2000 and 0.65 < b.count() / 2000 < 0.75


def test_balanced_weights_sum_to_rows(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    weighted = metrics.with_balanced_weight(df, "y")
    assert weighted.agg(F.sum("weight")).first()[0] == pytest.approx(10.0)


def test_forest_is_one_model_wherever_its_nodes_are_finished(spark, monkeypatch):
    """Large nodes are split by jobs, small ones where their rows are; the model is a table that can be saved."""
    from millrace.plans import forest, learning
    from millrace.session import scratch_path

    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(1200, 3))
    labels = np.where(rnd.random(1200) < 0.1, 1.0, (x[:, 0] * x[:, 1] > 0).astype(float))
    rows = [(i, *map(float, r), bool(r[2] > 0), None if i % 50 == 0 else float(y)) for i, (r, y) in enumerate(zip(x, labels))]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, d boolean, label double")
    monkeypatch.setattr(learning, "FOREST_TREES", 12)

    def scored(model):
        return {r.k: (r.prediction, r.probability.toArray().tolist()) for r in model.transform(df).select("k", "prediction", "probability").collect()}

    features = ["a", "b", "c", "d"]
    whole = learning.fit_forest(df, features)
    monkeypatch.setattr(forest, "FINISHED", 60)
    monkeypatch.setattr(forest, "TOGETHER", 7)
    monkeypatch.setattr(forest, "SCORED", 500)
    cut = learning.fit_forest(df, features)
    assert whole.stages[0].ends.count() == 12 < cut.stages[0].ends.count()
    want = scored(whole)
    assert scored(cut) == want
    zone = scratch_path(spark, "forests")
    assert learning.save_model(spark, cut, zone) == 1
    assert scored(learning.load_model(zone, 1)) == want
    right = np.mean([want[r[0]][0] == r[-1] for r in rows if r[-1] is not None])
    assert len(want) == 1200 and right > 0.95
    assert max(len(r.feature) for r in whole.stages[0].ends.collect()) > 100
    with pytest.raises(Exception, match="missing value"):
        learning.fit_forest(df.withColumn("a", F.lit(float("nan"))), features)


def test_forest_of_odd_tables(spark):
    """Three classes, rows that come several times, one class only, no rows to score, no rows to learn."""
    from millrace.plans import learning

    df = spark.range(300).selectExpr("cast(id % 30 as double) as x", "cast(id % 30 div 10 as double) as label", "true as flag")
    model = learning.fit_forest(df, ["x", "flag"])
    assert model.transform(df).where("prediction = label").count() == 300
    assert model.transform(df.where("x < 0")).count() == 0
    one = learning.fit_forest(df.withColumn("label", F.lit(0.0)), ["x", "flag"])
    assert {r.prediction for r in one.transform(df).collect()} == {0.0}
    with pytest.raises(ValueError):
        learning.fit_forest(df.where("x < 0"), ["x", "flag"])


def test_correlations_see_where_columns_are_constant(spark):
    """Constant throughout, on the shared rows only, or almost; wide jobs run in methods that the JVM compiles."""
    from millrace.session import short_methods

    rnd = np.random.default_rng(9)
    x = rnd.normal(size=(3000, 4)) * [1, 1e-7, 1e9, 1] + [0, 1e3, 0, 5]
    frame = pd.DataFrame(x, columns=list("abcd"))
    frame["same"] = 7.25
    frame["part"] = np.where(np.arange(3000) < 1500, 3.5, x[:, 0])
    frame["half"] = np.where(np.arange(3000) < 1500, x[:, 3], np.nan)
    frame["near"] = 1e6 + np.where(np.arange(3000) == 7, 1e-3, 0)
    df = spark.createDataFrame([tuple(None if v != v else v for v in r) for r in frame.to_numpy().tolist()], ", ".join(f"{c} double" for c in frame))
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    got = {(r.col_a, r.col_b): r.r for r in eda.correlation_matrix(df).collect()}
    for a in frame:
        for b in frame:
            if "same" in (a, b) or {a, b} == {"part", "half"}:
                assert got[a, b] is None
            else:
                assert got[a, b] == pytest.approx(frame[a].corr(frame[b]), abs=1e-6)
    with short_methods(spark):
        assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit


def test_stages_run_in_methods_that_the_jvm_compiles(spark, monkeypatch):
    """The limit holds while each stage writes, and not after it."""
    from datetime import datetime

    from millrace.plans import stages

    name, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(name)
    df = spark.createDataFrame([("1", "x", 1.0)], "customerID string, Contract string, tenure double")

    def limit(*args, **kwargs):
        seen.append(int(spark.conf.get(name)))
        return df

    for step in ("land_raw", "write_through", "publish", "quality_report", "full_refresh"):
        monkeypatch.setattr(stages, step, limit)
    for step in ("resolutions", "suite_results", "merge_sources", "impute_merged", "read_snapshot", "prepare", "to_warehouse_types", "stamp"):
        monkeypatch.setattr(stages, step, lambda *args, **kwargs: df)
    zones, at = stages.Zones("/nowhere"), datetime(2024, 3, 1)
    stages.land_stage(df, zones, "a", at)
    stages.validate_stage(df, stages.Rules(key="customerID"), None, zones, "a", at)
    stages.merge_stage(df, df, zones, at)
    stages.prepare_stage(spark, zones, at)
    stages.load_stage(spark, zones, "nowhere", at)
    assert len(seen) == 8 and max(seen) <= 8000
    assert spark.conf.get(name) == before
