"""Queries: renaming, standardising, stacking, imputing, and the flagship chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.inputs import (
    DIRTY_ORDERS_SQL,
    SOURCE_A,
    SOURCE_A_SQL,
    SOURCE_B,
    SOURCE_B_SQL,
    dirty_orders,
    source_a,
    source_b,
)
from millrace.catalog.registry import query, table
from millrace.functions.scalars import (
    label_to_int,
    COMPACT_STAMP,
    NUMBER_PATTERN,
    date_parts,
    hourly_path,
    snapshot_name,
    to_number,
    yes_no,
)
from millrace.operators import impute
from millrace.operators.schema import clean_names, dtype_of
from millrace.operators.union import distinct_spine, standardize_flag
from millrace.plans.churn_definitions import NO_YES_SERVICE
from millrace.plans.customers import feature_table, impute_merged, merge_sources
from millrace.session import write_through
from millrace.sources.readers import read_extract

NUMBER_SQL = f"case when regexp_matches(trim({{0}}), '{NUMBER_PATTERN}') then try_cast(trim({{0}}) as double) end"
YES_NO_SQL = "case when {0} in ('0', 'No') then 'No' when {0} in ('1', 'Yes') then 'Yes' end"


@query(
    "merge_std_label",
    "select doc_id, case when quality = 0 then 'No' when quality = 1 then 'Yes' end as from_number, "
    + YES_NO_SQL.format("cast(quality as varchar)")
    + " as from_text, "
    + YES_NO_SQL.format("case when toxic = 1 then 'Yes' when quality = 1 then 'maybe' else 'No' end")
    + " as from_words from labels",
)
def merge_std_label(spark, sf_dir):
    df = table(spark, sf_dir, "labels")
    words = F.when(F.col("toxic") == 1, "Yes").when(F.col("quality") == 1, "maybe").otherwise("No")
    text = dtype_of(df.select(F.lit("").alias("t")), "t")
    return df.select(
        "doc_id",
        yes_no(F.col("quality"), dtype_of(df, "quality")).alias("from_number"),
        yes_no(F.col("quality").cast("string"), text).alias("from_text"),
        yes_no(words, text).alias("from_words"),
    )


@query(
    "merge_std_flag",
    "select doc_id, case when quality = 0 then 'No' when quality = 1 then 'Yes' end as number_flag, "
    "cast(toxic as varchar) as text_flag from labels",
)
def merge_std_flag(spark, sf_dir):
    df = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").alias("number_flag"), F.col("toxic").cast("string").alias("text_flag")
    )
    return standardize_flag(standardize_flag(df, "number_flag"), "text_flag")


def merged_sql() -> str:
    """Both sources standardised and stacked."""
    label = "case when \"Churn\" = 0 then 'No' when \"Churn\" = 1 then 'Yes' end as \"Churn\""
    flag = "case when \"SeniorCitizen\" = 0 then 'No' when \"SeniorCitizen\" = 1 then 'Yes' end as \"SeniorCitizen\""
    amount = NUMBER_SQL.format('"TotalCharges"') + ' as "TotalCharges"'
    return (
        f"select * replace ({flag}, {amount}) from ({SOURCE_A_SQL}) "
        f"union all by name select * replace ({flag}, {label}) from ({SOURCE_B_SQL})"
    )


@query("merge_union_by_name", merged_sql())
def merge_union_by_name(spark, sf_dir):
    return merge_sources(source_a(spark, sf_dir), source_b(spark, sf_dir))


@query("set_distinct_spine", "select distinct user_id, date_trunc('day', ts) as event_timestamp from events")
def set_distinct_spine(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").cast("timestamp_ntz").alias("event_timestamp")
    )
    return distinct_spine(log, "user_id", "event_timestamp")


@query("scalar_label_to_int", f"select \"customerID\" as customerid, case when \"Churn\" = 'Yes' then 1 else 0 end as churn from ({SOURCE_A_SQL})")
def scalar_label_to_int(spark, sf_dir):
    return source_a(spark, sf_dir).select(F.col("customerID").alias("customerid"), label_to_int(F.col("Churn")).alias("churn"))


@query(
    "scalar_to_number",
    "select id, " + NUMBER_SQL.format("price_text") + " as amount, "
    + NUMBER_SQL.format("tricky") + f" as tricky from (select *, case when id % 5 = 0 then id || 'd' "
    f"when id % 5 = 1 then '+' || id || '.5' when id % 5 = 2 then id || 'e2' when id % 5 = 3 then '1_' || id "
    f"else ' ' || id || ' ' end as tricky from ({DIRTY_ORDERS_SQL}))",
)
def scalar_to_number(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).selectExpr(
        "id",
        "price_text",
        "case when id % 5 = 0 then id || 'd' when id % 5 = 1 then '+' || id || '.5' "
        "when id % 5 = 2 then id || 'e2' when id % 5 = 3 then '1_' || id else ' ' || id || ' ' end as tricky",
    )
    return df.select(
        "id",
        to_number(F.col("price_text"), dtype_of(df, "price_text")).alias("amount"),
        to_number(F.col("tricky"), dtype_of(df, "tricky")).alias("tricky"),
    )


@query(
    "scalar_time_text",
    "select event_id, strftime(ts, '%Y%m%d%H%M%S') as compact, strftime(ts, '%Y%m%d_%H%M%S') as snapshot, "
    "strftime(ts, '%Y/%m/%d/%H') as hourly, strftime(ts, '%Y') as year, strftime(ts, '%m') as month, "
    "strftime(ts, '%d') as day from events",
)
def scalar_time_text(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(ts, COMPACT_STAMP).alias("compact"),
        snapshot_name(ts).alias("snapshot"),
        hourly_path(ts).alias("hourly"),
        *[c.alias(n) for n, c in date_parts(ts).items()],
    )


@query(
    "proj_clean_names",
    "select p_partkey as part_key, p_name as name, p_type as type_of_part_a, p_size as size from part",
)
def proj_clean_names(spark, sf_dir):
    df = table(spark, sf_dir, "part").selectExpr(
        "p_partkey as ` Part Key`", "p_name as `NAME `", "p_type as `Type of Part (A)`", "p_size as `Size`"
    )
    return clean_names(df, {"Type_of_Part_(A)": "Type_of_Part_A"})


@query("proj_positional_rename", SOURCE_B_SQL)
def proj_positional_rename(spark, sf_dir):
    scanned = source_b(spark, sf_dir)
    return read_extract(scanned.toDF(*[f"db_{i}" for i in range(len(scanned.columns))]))


@query(
    "imp_median",
    f"select id, round(coalesce(price, (select quantile_cont(price, 0.5) from ({DIRTY_ORDERS_SQL}))), 4) as price "
    f"from ({DIRTY_ORDERS_SQL})",
)
def imp_median(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "price")
    filled = impute.fill(df, impute.fit_medians(df, ["price"]))
    return filled.withColumn("price", F.round("price", 4))


@query(
    "imp_mode",
    "select id, coalesce(priority, (select priority from "
    f"(select priority, count(*) as n from ({DIRTY_ORDERS_SQL}) where priority is not null group by 1) "
    f"order by n desc, priority limit 1)) as priority from ({DIRTY_ORDERS_SQL})",
)
def imp_mode(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "priority")
    return impute.fill(df, impute.fit_modes(df, ["priority"]))


def mean_code_sql(column: str, source: str) -> str:
    """The category whose alphabetical code is the mean code, halves rounded to even."""
    codes = (
        f'(select "{column}" as v, count(*) as n, dense_rank() over (order by "{column}") - 1 as code '
        f'from {source} where "{column}" is not null group by 1)'
    )
    return f"(select v from {codes} where code = (select round_even(sum(n * code) / sum(n), 0) from {codes}))"


@query(
    "imp_cat_mean_code",
    f"with d as ({DIRTY_ORDERS_SQL}) select id, coalesce(priority, {mean_code_sql('priority', 'd')}) as priority, "
    f"coalesce(status, {mean_code_sql('status', 'd')}) as status from d",
)
def imp_cat_mean_code(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "priority", "status")
    return impute.fill(df, impute.fit_mean_codes(df, ["priority", "status"]))


@query("imp_cat_constant", f"select id, 'x' as const from ({DIRTY_ORDERS_SQL})")
def imp_cat_constant(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "const")
    return impute.fill(df, impute.fit_mean_codes(df, ["const"]))


@query("imp_numeric_chained")
def imp_numeric_chained(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "case when l_orderkey % 7 = 0 then null else l_quantity end as quantity",
        "case when l_partkey % 5 = 0 then null else l_extendedprice end as price",
        "l_discount as discount",
    )
    return impute.impute_chained(df, ["quantity", "price", "discount"])


# With one holed column a round is one Bayesian ridge regression; its iterations as recursive SQL.
ONE_HOLE_SQL = """
with recursive d as (
  select l_orderkey, l_linenumber, l_quantity as quantity, case when l_partkey % 5 = 0 then null else l_extendedprice end as price from lineitem),
m as (select count(*) as n, avg(quantity) as mx, avg(price) as my from d where price is not null),
g as (select any_value(n)::double as n, any_value(mx) as mx, any_value(my) as my, sum((quantity - mx) * (quantity - mx)) as xx,
  sum((quantity - mx) * (price - my)) as xy, sum((price - my) * (price - my)) as yy from d, m where price is not null),
s as (
  select 0 as i, 1.0 / (yy / n + 2.220446049250313e-16) as noise, cast(1.0 as double) as decay, cast(0.0 as double) as w, cast(null as double) as old from g
  union all
  select i + 1, (n - noise * xx / (decay + noise * xx) + 2e-6) / (greatest(yy - 2 * v * xy + v * v * xx, 0) + 2e-6),
    (noise * xx / (decay + noise * xx) + 2e-6) / (v * v + 2e-6), v, w
  from (select s.*, g.*, xy / (xx + decay / noise) as v from s, g where i < 300 and not coalesce(i > 1 and abs(old - w) < 1e-3, false))),
f as (select xy / (xx + decay / noise) as w, mx, my from s, g order by i desc limit 1)
select l_orderkey, l_linenumber, quantity, round(coalesce(price, my + w * (quantity - mx)), 4) as price from d, f
"""


@query("imp_numeric_one_hole", ONE_HOLE_SQL)
def imp_numeric_one_hole(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity as quantity", "case when l_partkey % 5 = 0 then null else l_extendedprice end as price"
    )
    return impute.impute_chained(df, ["quantity", "price"]).withColumn("price", F.round("price", 4))


@query("merge_impute_chained")
def merge_impute_chained(spark, sf_dir):
    merged = merge_sources(source_a(spark, sf_dir), source_b(spark, sf_dir))
    return impute_merged(write_through(merged, "merged"), chained=True)


# Sorted categories of every one-hot column of the derived customer sources.
CATEGORIES = {
    "gender": ["Female", "Male"],
    "SeniorCitizen": ["No", "Yes"],
    "Partner": ["No", "Yes"],
    "Dependents": ["No", "Yes"],
    "PhoneService": ["No", "Yes"],
    "MultipleLines": ["No", "No phone service", "Yes"],
    "InternetService": ["DSL", "Fiber optic", "No"],
    **{
        c: sorted(NO_YES_SERVICE)
        for c in ("OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies")
    },
    "Contract": ["Month-to-month", "One year", "Quarterly", "Two year"],
    "PaperlessBilling": ["No", "Yes"],
    "PaymentMethod": ["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"],
}
NUMBERS = ("tenure", "MonthlyCharges", "TotalCharges")

# A ratio over a denominator near 0 is known to fewer digits: both engines sum in their own order.
RATIO_DIGITS = "case when abs({r}) < 100 then round({r}, 4) else round({r}, 0) end"


def _flag_name(column: str, value: str) -> str:
    return f"{column}_{value}".replace(" ", "_").replace("(", "").replace(")", "").lower()


def flagship_sql() -> str:
    filled = [f'coalesce(cast("{c}" as double), (select quantile_cont(cast("{c}" as double), 0.5) from m)) as {c.lower()}' for c in NUMBERS]
    filled += [f'coalesce("{c}", {mean_code_sql(c, "m")}) as "{c}"' for c in CATEGORIES]
    scaled = [
        f"({c} - (select avg({c}) from f)) / (select case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end from f) as {c}"
        for c in (n.lower() for n in NUMBERS)
    ]
    flags = [f"\"{c}\" = '{v}' as {_flag_name(c, v)}" for c, values in CATEGORIES.items() for v in values[1:]]
    services = "cast(onlinesecurity_yes as int) + 2 * cast(onlinebackup_yes as int) + cast(techsupport_yes as int) + cast(streamingtv_yes as int) + cast(streamingmovies_yes as int)"
    rounded = ", ".join(f"round({c}, 4) as {c}" for c in (n.lower() for n in NUMBERS))
    return (
        f"with m as materialized ({merged_sql()}), "
        f'f as materialized (select {", ".join(filled)}, "customerID" as customerid, "Churn" as churn from m), '
        f'e as (select {", ".join(scaled + flags)}, customerid, churn from f) '
        f"select * replace ({rounded}), {services} as total_services, "
        f"{RATIO_DIGITS.format(r='(monthlycharges / (totalcharges + 1e-9))')} as monthly_total_ratio, "
        "cast(partner_yes as int) as partner_label, cast(dependents_yes as int) as dependents_label, "
        "cast(partner_yes as int) + cast(dependents_yes as int) as family_label from e"
    )


@query("merge_impute_flagship", flagship_sql())
def merge_impute_flagship(spark, sf_dir):
    features = feature_table(source_a(spark, sf_dir), source_b(spark, sf_dir), chained=False)
    rounded = {c: F.round(c, 4) for c in ("tenure", "monthlycharges", "totalcharges")}
    return features.withColumns({**rounded, "monthly_total_ratio": F.expr(RATIO_DIGITS.format(r="monthly_total_ratio"))})


assert {n for _, n in SOURCE_B} <= {n for _, n in SOURCE_A}
