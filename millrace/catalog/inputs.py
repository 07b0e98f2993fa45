"""Dirty and customer-shaped inputs derived from whole tables.

Each input is a list of (expression, name) pairs that Spark and SQL read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.catalog.registry import table

DIRTY_ORDERS = [
    ("o_orderkey", "id"),
    ("o_custkey", "custkey"),
    ("o_orderstatus", "status"),
    ("nullif(o_orderpriority, '4-NOT SPECIFIED')", "priority"),
    ("case when o_orderkey % 7 = 0 then null else o_totalprice end", "price"),
    (
        "case when o_orderkey % 13 = 0 then ' ' when o_orderkey % 17 = 0 then 'n/a' "
        "else cast(cast(o_totalprice as decimal(18,2)) as string) end",
        "price_text",
    ),
    ("case when o_orderkey % 5 = 0 then null else 'x' end", "const"),
    ("o_orderkey - o_orderkey % 3", "dup_key"),
    ("cast(o_orderkey % 2 as int)", "flag"),
    ("cast(0 as int)", "zero"),
]

_NO_NET = "c_mktsegment = 'MACHINERY'"


def _service(shift: int, every: int) -> str:
    return f"case when {_NO_NET} then 'No internet service' when (c_custkey + {shift}) % {every} = 0 then 'Yes' else 'No' end"


SOURCE_A = [
    ("cast(c_custkey as string)", "customerID"),
    ("case when c_custkey % 11 = 0 then null when c_custkey % 2 = 0 then 'Male' else 'Female' end", "gender"),
    ("cast(c_nationkey % 2 as int)", "SeniorCitizen"),
    ("case when c_nationkey % 3 = 0 then 'Yes' else 'No' end", "Partner"),
    ("case when c_custkey % 4 = 0 then 'Yes' else 'No' end", "Dependents"),
    ("cast(case when c_custkey % 19 = 0 then null else c_custkey % 73 end as int)", "tenure"),
    ("case when c_custkey % 10 = 0 then 'No' else 'Yes' end", "PhoneService"),
    (
        "case when c_custkey % 10 = 0 then 'No phone service' when c_custkey % 3 = 0 then 'Yes' else 'No' end",
        "MultipleLines",
    ),
    (
        "case when c_mktsegment = 'MACHINERY' then 'No' when c_mktsegment in ('AUTOMOBILE', 'BUILDING') "
        "then 'DSL' when c_custkey % 23 = 0 then null else 'Fiber optic' end",
        "InternetService",
    ),
    (_service(0, 3), "OnlineSecurity"),
    (_service(1, 3), "OnlineBackup"),
    (_service(2, 5), "DeviceProtection"),
    (_service(3, 4), "TechSupport"),
    (_service(4, 2), "StreamingTV"),
    (_service(5, 2), "StreamingMovies"),
    (
        "case when c_nationkey % 4 = 0 then 'Two year' when c_nationkey % 4 = 1 then 'One year' "
        "when c_custkey % 29 = 0 then 'Quarterly' else 'Month-to-month' end",
        "Contract",
    ),
    ("case when c_custkey % 5 < 3 then 'Yes' else 'No' end", "PaperlessBilling"),
    (
        "case when c_custkey % 4 = 0 then 'Electronic check' when c_custkey % 4 = 1 then 'Mailed check' "
        "when c_custkey % 4 = 2 then 'Bank transfer (automatic)' else 'Credit card (automatic)' end",
        "PaymentMethod",
    ),
    ("20 + cast(cast(floor(abs(c_acctbal)) as bigint) as double) / 100", "MonthlyCharges"),
    (
        "case when c_custkey % 13 = 0 then ' ' else cast(cast((c_custkey % 73) * "
        "(20 + cast(cast(floor(abs(c_acctbal)) as bigint) as double) / 100) as decimal(18,2)) as string) end",
        "TotalCharges",
    ),
    (
        "case when (c_custkey % 73 < 24 and c_acctbal < 6000) or c_custkey % 17 = 0 then 'Yes' else 'No' end",
        "Churn",
    ),
]

SOURCE_B = [
    ("cast(s_suppkey as string)", "customerID"),
    ("case when s_suppkey % 2 = 0 then 'Male' else 'Female' end", "gender"),
    ("cast(s_nationkey % 2 as int)", "SeniorCitizen"),
    ("case when s_nationkey % 3 = 1 then 'Yes' else 'No' end", "Partner"),
    ("case when s_suppkey % 4 = 1 then 'Yes' else 'No' end", "Dependents"),
    ("cast(s_suppkey % 60 as int)", "tenure"),
    ("case when s_suppkey % 9 = 0 then 'No' else 'Yes' end", "PhoneService"),
    ("case when s_suppkey % 9 = 0 then 'No phone service' when s_suppkey % 2 = 0 then 'Yes' else 'No' end", "MultipleLines"),
    ("case when s_nationkey % 5 = 0 then 'No' when s_nationkey % 5 < 3 then 'DSL' else 'Fiber optic' end", "InternetService"),
    ("case when s_nationkey % 5 = 0 then 'No internet service' when s_suppkey % 2 = 0 then 'Yes' else 'No' end", "OnlineSecurity"),
    ("case when s_nationkey % 5 = 0 then 'No internet service' when s_suppkey % 3 = 0 then 'Yes' else 'No' end", "OnlineBackup"),
    ("cast(case when s_acctbal < 2000 then 1 else 0 end as int)", "Churn"),
]


def _select(pairs) -> list[str]:
    return [f"{expression} as `{name}`" for expression, name in pairs]


def _sql(pairs, source: str) -> str:
    return "select " + ", ".join(f'{expression} as "{name}"' for expression, name in pairs) + f" from {source}"


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*_select(DIRTY_ORDERS))


def source_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_select(SOURCE_A))


def source_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(*_select(SOURCE_B))


DIRTY_ORDERS_SQL = _sql(DIRTY_ORDERS, "orders")
SOURCE_A_SQL = _sql(SOURCE_A, "customer")
SOURCE_B_SQL = _sql(SOURCE_B, "supplier")

LABELLED_LINES = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("l_quantity", "quantity"),
    ("l_extendedprice", "price"),
    ("l_discount", "discount"),
    ("l_tax", "tax"),
    ("cast(0 as int)", "zero"),
    ("cast(case when l_returnflag = 'R' then 1 else 0 end as int)", "label"),
    ("cast(case when l_quantity > 25 then 1 else 0 end as int)", "prediction"),
]


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_select(LABELLED_LINES))


LABELLED_LINES_SQL = _sql(LABELLED_LINES, "lineitem")
