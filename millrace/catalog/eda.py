"""Queries: exploratory statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.inputs import DIRTY_ORDERS_SQL, LABELLED_LINES_SQL, dirty_orders, labelled_lines, table
from millrace.catalog.registry import query
from millrace.functions.scalars import guarded_ratio
from millrace.operators import eda

WITH_L = f"with l as ({LABELLED_LINES_SQL}) "
NUMBERS = ("quantity", "price", "discount", "tax", "zero")


def _describe_number(c: str) -> str:
    return (
        f"select '{c}' as column_name, count({c}) as count, cast(null as bigint) as \"unique\", cast(null as varchar) as top, "
        f"cast(null as bigint) as freq, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, "
        f"cast(min({c}) as double) as min, round(quantile_cont({c}, 0.25), 4) as q25, round(quantile_cont({c}, 0.5), 4) as q50, "
        f"round(quantile_cont({c}, 0.75), 4) as q75, cast(max({c}) as double) as max from d"
    )


def _describe_text(c: str) -> str:
    top = f"(select {c} as v, count(*) as n from d where {c} is not null group by 1 order by n desc, v limit 1)"
    return (
        f"select '{c}', count({c}), count(distinct {c}), (select v from {top}), (select n from {top}), "
        "null, null, null, null, null, null, null from d"
    )


@query(
    "eda_describe",
    f"with d as ({DIRTY_ORDERS_SQL}) "
    + " union all ".join(
        [_describe_number(c) for c in ("id", "custkey", "price", "dup_key", "flag", "zero")]
        + [_describe_text(c) for c in ("status", "priority", "price_text", "const")]
    ),
)
def eda_describe(spark, sf_dir):
    described = eda.describe(dirty_orders(spark, sf_dir))
    return described.withColumns({c: F.round(c, 4) for c in ("mean", "std", "q25", "q50", "q75")})


@query(
    "eda_binary_columns",
    WITH_L
    + " union all ".join(
        f"select '{c}' as column_name, count(distinct {c}) = 2 as is_binary from l" for c in (*NUMBERS, "label", "prediction")
    ),
)
def eda_binary_columns(spark, sf_dir):
    return eda.binary_columns(labelled_lines(spark, sf_dir), [*NUMBERS, "label", "prediction"])


@query(
    "eda_count_by_label",
    WITH_L
    + "select 'prediction' as column_name, cast(prediction as varchar) as value, label, count(*) as n from l group by 2, 3 "
    "union all select 'zero', cast(zero as varchar), label, count(*) from l group by 2, 3",
)
def eda_count_by_label(spark, sf_dir):
    return eda.count_by_label(labelled_lines(spark, sf_dir), ["prediction", "zero"], "label")


def corr_sql(a: str, b: str) -> str:
    """Over the rows where both are present, NULL without spread."""
    x, y = f"case when {b} is not null then {a} end", f"case when {a} is not null then {b} end"
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


HOLED = "case when l_orderkey % 7 = 0 then null else price end"


@query(
    "eda_corr_label",
    WITH_L
    + ", h as (select * replace (case when l_orderkey % 7 = 0 then null else price end as price) from l) "
    + " union all ".join(
        f"select '{c}' as column_name, round({corr_sql(c, 'label')}, 6) as r from h" for c in (*NUMBERS, "prediction", "label")
    ),
)
def eda_corr_label(spark, sf_dir):
    df = labelled_lines(spark, sf_dir).withColumn("price", F.expr(HOLED))
    return eda.correlation_with_label(df, "label", [*NUMBERS, "prediction", "label"]).withColumn("r", F.round("r", 6))


@query(
    "eda_corr_matrix",
    WITH_L
    + " union all ".join(
        f"select '{a}' as col_a, '{b}' as col_b, round({corr_sql(a, b)}, 6) as r from l"
        for a in (*NUMBERS, "label")
        for b in (*NUMBERS, "label")
    ),
)
def eda_corr_matrix(spark, sf_dir):
    return eda.correlation_matrix(labelled_lines(spark, sf_dir), [*NUMBERS, "label"]).withColumn("r", F.round("r", 6))


@query(
    "eda_corr_before_after",
    WITH_L
    + ", n as (select *, price / (quantity + 1e-9) as unit_price, discount + tax as rates from l) "
    + " union all ".join(
        f"select '{c}' as column_name, round({corr_sql(c, 'label')}, 6) as r_before, round({corr_sql(c, 'label')}, 6) as r_after from n"
        for c in ("quantity", "price", "discount", "tax", "label")
    )
    + "".join(
        f" union all select '{c}', cast(null as double), round({corr_sql(c, 'label')}, 6) from n" for c in ("unit_price", "rates")
    ),
)
def eda_corr_before_after(spark, sf_dir):
    before = labelled_lines(spark, sf_dir).select("quantity", "price", "discount", "tax", "label")
    after = before.withColumns(
        {"unit_price": guarded_ratio(F.col("price"), F.col("quantity")), "rates": F.col("discount") + F.col("tax")}
    )
    return eda.correlation_change(before, after, "label").withColumns({c: F.round(c, 6) for c in ("r_before", "r_after")})


@query(
    "eda_histogram",
    WITH_L
    + ", s as (select min(price) as low, max(price) as high, count(price) as n, "
    "quantile_cont(price, 0.75) - quantile_cont(price, 0.25) as iqr from l), "
    "w as (select low, high, least((high - low) / (log2(n) + 1), case when iqr > 0 then 2 * iqr / pow(n, 1.0 / 3) end) as width from s), "
    "b as (select low, high, ceil((high - low) / width) as bins, (high - low) / ceil((high - low) / width) as width from w) "
    "select label, cast(least(floor((price - low) / width), bins - 1) as int) as bin, count(*) as n, "
    "round(any_value(low) + cast(least(floor((price - low) / width), bins - 1) as int) * any_value(width), 6) as bin_start "
    "from l, b group by 1, 2",
)
def eda_histogram(spark, sf_dir):
    return eda.histogram(labelled_lines(spark, sf_dir), "price", "label").withColumn("bin_start", F.round("bin_start", 6))


def _kde_sql(column: str) -> str:
    return (
        WITH_L
        + f", c as (select label, {column} as x, count(*) as n from l group by 1, 2), "
        f"e as (select min({column}) as low, max({column}) as high from l), "
        f"s as (select label, count(*) as total, stddev_samp({column}) * pow(count(*), -0.2) as bw from l group by 1), "
        "g as (select cast(unnest(range(200)) as int) as point) "
        "select c.label, point, round(any_value(low) + point * ((any_value(high) - any_value(low)) / 199), 6) as x, "
        "round(sum(n * exp(-0.5 * pow((low + point * ((high - low) / 199) - c.x) / bw, 2))) / (any_value(total) * any_value(bw) * sqrt(2 * pi())), {digits}) as density "
        "from c join s using (label), e, g group by 1, 2"
    )


def _kde(spark, sf_dir, column: str, digits: int):
    found = eda.density(labelled_lines(spark, sf_dir), column, "label")
    return found.withColumns({"x": F.round("x", 6), "density": F.round("density", digits)})


@query("eda_kde", _kde_sql("quantity").replace("{digits}", "6"))
def eda_kde(spark, sf_dir):
    return _kde(spark, sf_dir, "quantity", 6)


@query("eda_kde_price", _kde_sql("price").replace("{digits}", "11"))
def eda_kde_price(spark, sf_dir):
    """A column whose values hardly repeat."""
    return _kde(spark, sf_dir, "price", 11)


# 36 columns with holes of different rows: sums and shifts of the measured ones.
WIDE = {
    f"w{i}": f"case when (l_orderkey + {i} * l_linenumber) % {i % 5 + 7} = 0 then null else "
    f"l_quantity * {i % 7 - 3} + l_extendedprice / {100 + 13 * i} + l_discount * {i * i} + l_tax * {40 - i} end"
    for i in range(36)
}


def _wide_sql() -> str:
    """All pairs by DuckDB's corr over the rows where both are present."""
    wide = ", ".join(f"{e} as {c}" for c, e in WIDE.items())
    pairs = [(a, b) for a in WIDE for b in WIDE]
    cells = ", ".join(f"{{'col_a': '{a}', 'col_b': '{b}', 'r': round(corr({a}, {b}), 6)}}" for a, b in pairs)
    return f"select c.col_a, c.col_b, c.r from (select unnest([{cells}]) as c from (select {wide} from lineitem))"


@query("eda_corr_wide", _wide_sql())
def eda_corr_wide(spark, sf_dir):
    wide = table(spark, sf_dir, "lineitem").selectExpr(*[f"{e} as {c}" for c, e in WIDE.items()])
    return eda.correlation_matrix(wide, list(WIDE)).withColumn("r", F.round("r", 6))


def _box_sql(c: str) -> str:
    return (
        f"select '{c}' as column_name, label, round(q25, 4) as q25, round(q50, 4) as q50, round(q75, 4) as q75, "
        f"min({c}) filter ({c} between lo and hi) as whisker_low, max({c}) filter ({c} between lo and hi) as whisker_high, "
        f"count(*) filter ({c} < lo or {c} > hi) as n_outliers, count(*) as n from l join "
        "(select *, q25 - 1.5 * (q75 - q25) as lo, q75 + 1.5 * (q75 - q25) as hi from (select label, "
        f"quantile_cont({c}, 0.25) as q25, quantile_cont({c}, 0.5) as q50, quantile_cont({c}, 0.75) as q75 from l group by 1)) using (label) "
        "group by label, q25, q50, q75"
    )


@query("eda_boxplot", WITH_L + _box_sql("price") + " union all " + _box_sql("quantity"))
def eda_boxplot(spark, sf_dir):
    return eda.box_plot(labelled_lines(spark, sf_dir), ["price", "quantity"], "label").withColumns(
        {c: F.round(c, 4) for c in ("q25", "q50", "q75")}
    )
