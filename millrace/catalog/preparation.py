"""Queries: scaling, encoding, derived features."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.inputs import DIRTY_ORDERS_SQL, dirty_orders
from millrace.catalog.registry import query, table
from millrace.functions.scalars import guarded_ratio
from millrace.operators import derive, encode


@query(
    "enc_zscore",
    f"with d as ({DIRTY_ORDERS_SQL}) select id, "
    "round((price - (select avg(price) from d)) / (select stddev_pop(price) from d), 4) as price, "
    "cast(0 as double) as zero from d",
)
def enc_zscore(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "price", "zero")
    return encode.zscore(df, ["price", "zero"]).withColumn("price", F.round("price", 4))


@query(
    "enc_minmax",
    "select c_custkey, round((c_acctbal - (select min(c_acctbal) from customer)) / "
    "((select max(c_acctbal) from customer) - (select min(c_acctbal) from customer)), 4) as c_acctbal from customer",
)
def enc_minmax(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return encode.minmax(df, ["c_acctbal"]).withColumn("c_acctbal", F.round("c_acctbal", 4))


@query(
    "enc_onehot",
    "select id, coalesce(priority = '2-HIGH', false) as \"priority_2-HIGH\", "
    "coalesce(priority = '3-MEDIUM', false) as \"priority_3-MEDIUM\", "
    "coalesce(priority = '5-LOW', false) as \"priority_5-LOW\", "
    f"status = 'O' as \"status_O\", status = 'P' as \"status_P\" from ({DIRTY_ORDERS_SQL})",
)
def enc_onehot(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "priority", "status")
    return encode.onehot(df, ["priority", "status"])


@query(
    "enc_label",
    "select p_partkey, p_type, cast(dense_rank() over (order by p_type) - 1 as int) as code from part",
)
def enc_label(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return encode.encode_label(df, "p_type", "code")


@query(
    "enc_category_codes",
    f"with d as ({DIRTY_ORDERS_SQL}), c as (select priority, dense_rank() over (order by priority) - 1 as code "
    "from d where priority is not null group by 1) "
    "select d.id, d.priority, cast(coalesce(c.code, -1) as int) as code from d left join c on d.priority = c.priority",
)
def enc_category_codes(spark, sf_dir):
    df = dirty_orders(spark, sf_dir).select("id", "priority")
    return encode.with_category_code(df, "priority", "code")


# Six boolean flags of a line item stand in for the service flags.
LINE_FLAGS = [
    ("l_quantity > 10", "onlinesecurity_yes"),
    ("l_discount > 0.05", "onlinebackup_yes"),
    ("l_tax > 0.04", "techsupport_yes"),
    ("l_returnflag = 'R'", "streamingtv_yes"),
    ("case when l_linenumber = 1 then null else l_linestatus = 'O' end", "streamingmovies_yes"),
]
_LINE_COLUMNS = ["l_orderkey", "l_linenumber", *[f"{e} as {n}" for e, n in LINE_FLAGS]]


@query(
    "feat_total_services",
    "select l_orderkey, l_linenumber, "
    "a + 2 * b + c + d + coalesce(e, 0) as total_services, a + b + c + d + coalesce(e, 0) as distinct_services from "
    "(select l_orderkey, l_linenumber, "
    + ", ".join(f"cast({e} as int) as {n}" for (e, _), n in zip(LINE_FLAGS, "abcde"))
    + " from lineitem)",
)
def feat_total_services(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").selectExpr(*_LINE_COLUMNS)
    return df.select(
        "l_orderkey",
        "l_linenumber",
        derive.total_services().alias("total_services"),
        derive.total_services(dedupe=True).alias("distinct_services"),
    )


@query(
    "feat_family",
    "select o_orderkey, case when p then 1 else 0 end as partner_label, case when d then 1 else 0 end as dependents_label, "
    "case when p then 1 else 0 end + case when d then 1 else 0 end as family_label from "
    "(select o_orderkey, case when o_orderkey % 7 = 0 then null else o_orderstatus = 'F' end as p, "
    "o_orderpriority in ('1-URGENT', '2-HIGH') as d from orders)",
)
def feat_family(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 7 = 0 then null else o_orderstatus = 'F' end as p",
        "o_orderpriority in ('1-URGENT', '2-HIGH') as d",
    )
    return df.select(
        "o_orderkey", *[c.alias(n) for n, c in derive.family_columns(F.col("p"), F.col("d")).items()]
    )


@query(
    "feat_charge_ratio",
    "select l_orderkey, l_linenumber, round(l_extendedprice / (l_quantity + 1e-9), 4) as ratio, "
    "round(l_tax / (l_discount + 1e-9) / 1e6, 4) as near_zero from lineitem",
)
def feat_charge_ratio(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(guarded_ratio(F.col("l_extendedprice"), F.col("l_quantity")), 4).alias("ratio"),
        F.round(guarded_ratio(F.col("l_tax"), F.col("l_discount")) / 1e6, 4).alias("near_zero"),
    )


@query(
    "feat_customer_spend",
    "select c_custkey, coalesce(cast(sum(cast(o_totalprice as decimal(18,2))) as double), 0) as total_spend, "
    "count(o_orderkey) as n_facts, "
    "round(cast(sum(cast(o_totalprice as decimal(18,2))) as double) / nullif(count(o_orderkey), 0), 8) as mean_spend, "
    "max(o_totalprice) as max_spend from customer left join orders on c_custkey = o_custkey group by 1",
)
def feat_customer_spend(spark, sf_dir):
    spend = derive.spend_per_entity(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), "c_custkey", "o_custkey", "o_totalprice"
    )
    return spend.withColumn("mean_spend", F.round("mean_spend", 8))


@query(
    "feat_activity",
    "select user_id, min(ts) as first_ts, max(ts) as last_ts, "
    "cast(date_diff('day', min(ts), max(ts)) as int) as tenure_days, count(distinct cast(ts as date)) as active_days, "
    "count(*) as n_events, round(count(*) / count(distinct cast(ts as date)), 8) as events_per_active_day "
    "from events group by 1",
)
def feat_activity(spark, sf_dir):
    activity = derive.activity_per_entity(table(spark, sf_dir, "events"), "user_id", "ts")
    return activity.withColumn("events_per_active_day", F.round("events_per_active_day", 8))
