"""Queries: feature store retrieval, materialization and lookup over the event log."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F, types as T

from millrace.catalog.inputs import source_a, source_b
from millrace.catalog.merging import flagship_sql
from millrace.catalog.registry import query, table
from millrace.operators.asof import as_of_join
from millrace.plans import feature_store as fs
from millrace.plans.churn_definitions import MODEL_SIGNATURE
from millrace.plans.customers import churn_service, customer_view, feature_table
from millrace.session import scratch_path, write_through
from millrace.sources.warehouse import stamp

DAY = timedelta(days=1)
USER = fs.Entity("user", ("user_id",), T.LongType())

LOG_SQL = "(select user_id, ts as f_ts, event_id as f_event, value from events where event_type <> 'purchase')"
SPINE_SQL = "(select event_id, user_id, ts from events where event_type = 'purchase')"


def feature_log(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type <> 'purchase'").selectExpr(
        "user_id", "ts as f_ts", "event_id as f_event", "value"
    )


def spine(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type = 'purchase'").select("event_id", "user_id", "ts")


def view(spark, sf_dir, ttl=None, name="user_views") -> fs.FeatureView:
    source = fs.FeatureSource("view_log", "f_ts", df=feature_log(spark, sf_dir))
    fields = (fs.Feature("value", T.DoubleType(), "Amount seen last"), fs.Feature("f_event", T.LongType()))
    return fs.FeatureView(name, USER, fields, source, ttl, {"team": "activity"})


@query(
    "fs_pit_join",
    f"select s.event_id, s.user_id, s.ts, f.value, f.f_event from {SPINE_SQL} s asof left join {LOG_SQL} f "
    "on s.user_id = f.user_id and s.ts >= f.f_ts",
)
def fs_pit_join(spark, sf_dir):
    return fs.historical_features(spine(spark, sf_dir), [view(spark, sf_dir)], ts="ts")


@query(
    "fs_pit_join_ttl",
    "select s.event_id, s.user_id, s.ts, case when f.f_ts >= s.ts - interval 1 day then f.value end as value, "
    "case when f.f_ts >= s.ts - interval 1 day then f.f_event end as f_event "
    f"from {SPINE_SQL} s asof left join {LOG_SQL} f on s.user_id = f.user_id and s.ts >= f.f_ts",
)
def fs_pit_join_ttl(spark, sf_dir):
    return fs.historical_features(spine(spark, sf_dir), [view(spark, sf_dir, DAY)], ts="ts")


TWO_VIEWS_SQL = (
    "select s.event_id, s.user_id, s.ts, case when a.f_ts >= s.ts - interval 1 day then a.value end as amount, "
    "case when a.f_ts >= s.ts - interval 1 day then a.f_event end as amount_event, "
    "case when b.f_ts >= s.ts - interval 2 hour then b.f_event end as error_event "
    f"from {SPINE_SQL} s asof left join {LOG_SQL} a on s.user_id = a.user_id and s.ts >= a.f_ts "
    "asof left join (select user_id, ts as f_ts, event_id as f_event from events where event_type = 'error') b on s.user_id = b.user_id and s.ts >= b.f_ts"
)


def two_views(spark, sf_dir) -> list[fs.FeatureView]:
    amounts = feature_log(spark, sf_dir).select("user_id", "f_ts", F.col("value").alias("amount"), F.col("f_event").alias("amount_event"))
    errors = table(spark, sf_dir, "events").where("event_type = 'error'").selectExpr("user_id", "ts as f_ts", "event_id as error_event")
    fields = (fs.Feature("amount", T.DoubleType()), fs.Feature("amount_event", T.LongType()))
    return [
        fs.FeatureView("amounts", USER, fields, fs.FeatureSource("amount_log", "f_ts", df=amounts), DAY),
        fs.FeatureView("errors", USER, (fs.Feature("error_event", T.LongType()),), fs.FeatureSource("error_log", "f_ts", df=errors), timedelta(hours=2)),
    ]


@query("fs_two_views", TWO_VIEWS_SQL)
def fs_two_views(spark, sf_dir):
    """Two views of one entity with two lifetimes, by one shuffle."""
    return fs.historical_features(spine(spark, sf_dir), two_views(spark, sf_dir), ts="ts")


@query("fs_two_views_sliced", TWO_VIEWS_SQL)
def fs_two_views_sliced(spark, sf_dir):
    return fs.historical_features(spine(spark, sf_dir), two_views(spark, sf_dir), ts="ts", hot_rows=60)


@query(
    "fs_pit_join_sliced",
    f"select s.event_id, s.user_id, s.ts, f.value, f.f_event, f.f_ts as seen_at from {SPINE_SQL} s asof left join {LOG_SQL} f "
    "on s.user_id = f.user_id and s.ts >= f.f_ts",
)
def fs_pit_join_sliced(spark, sf_dir):
    """The plan for very frequent entities: the row count that selects it is set low enough
    for about half of the users to take it."""
    return as_of_join(
        spine(spark, sf_dir), feature_log(spark, sf_dir), ["user_id"], "ts", "f_ts", ["value", "f_event"],
        matched_ts="seen_at", hot_rows=27,
    )


@query(
    "fs_pit_tiebreak",
    "select event_id, user_id, ts, value from (select s.event_id, s.user_id, s.ts, f.value, "
    "row_number() over (partition by s.event_id order by f.f_ts desc nulls last, f.created desc) as place "
    f"from {SPINE_SQL} s left join (select user_id, date_trunc('day', f_ts) as f_ts, f_ts as created, value from {LOG_SQL}) f "
    "on s.user_id = f.user_id and f.f_ts <= s.ts) where place = 1",
)
def fs_pit_tiebreak(spark, sf_dir):
    log = feature_log(spark, sf_dir).select(
        "user_id", F.to_date("f_ts").cast("timestamp_ntz").alias("f_ts"), F.col("f_ts").alias("created"), "value"
    )
    return as_of_join(spine(spark, sf_dir), log, ["user_id"], "ts", "f_ts", ["value"], created_ts="created")


@query(
    "fs_batch_scoring",
    "select c.user_id, timestamp '2024-01-31' as event_timestamp, f.value, f.f_event from "
    f"(select distinct user_id from events) c left join (select user_id, arg_max(value, f_ts) as value, arg_max(f_event, f_ts) as f_event "
    f"from {LOG_SQL} where f_ts <= timestamp '2024-01-31' group by 1) f using (user_id)",
)
def fs_batch_scoring(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return fs.batch_scoring(users, [view(spark, sf_dir)], datetime(2024, 1, 31))


def _online(spark, sf_dir):
    """Materialized to three ends without a start; a repeated end and an earlier one change nothing."""
    v, log, root = view(spark, sf_dir), feature_log(spark, sf_dir), scratch_path(spark, "online")
    for day in (10, 15, 15, 12, 20):
        online = fs.materialize(v, log, root, datetime(2024, 1, day))
    return online


ONLINE_SQL = (
    "(select user_id, max(f_ts) as f_ts, arg_max(value, f_ts) as value, arg_max(f_event, f_ts) as f_event "
    f"from {LOG_SQL} where f_ts <= timestamp '2024-01-20' group by 1)"
)


@query("fs_materialize", f"select * from {ONLINE_SQL}")
def fs_materialize(spark, sf_dir):
    return _online(spark, sf_dir).select("user_id", "f_ts", "value", "f_event")


@query(
    "fs_online_lookup",
    f"select r.user_id, o.value, o.f_event from (select c_custkey as user_id from customer) r left join {ONLINE_SQL} o using (user_id)",
)
def fs_online_lookup(spark, sf_dir):
    requests = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return fs.online_lookup(requests, _online(spark, sf_dir), [view(spark, sf_dir)])


BASKET = fs.RequestSource(
    "basket", T.StructType([T.StructField("pieces", T.LongType()), T.StructField("budget", T.LongType())])
)


def basket_check(stored: fs.FeatureView, batches: bool = False) -> fs.OnDemandView:
    """What a basket of the last viewed item costs, and what is left of the request's budget."""
    fields = (fs.Feature("basket_cost", T.DoubleType()), fs.Feature("budget_left", T.DoubleType()))
    if batches:

        def priced(pdf):
            cost = pdf["value"] * pdf["pieces"]
            return pdf.assign(basket_cost=cost, budget_left=pdf["budget"] - cost)

        return fs.OnDemandView("basket_check", (stored, BASKET), fields, batches=priced)
    cost = F.col("value") * F.col("pieces")
    return fs.OnDemandView("basket_check", (stored, BASKET), fields, {"basket_cost": cost, "budget_left": F.col("budget") - cost})


def _requested(spark, sf_dir):
    return spine(spark, sf_dir).withColumns({"pieces": F.col("event_id") % 5 + 1, "budget": F.col("event_id") % 700 + 100})


ON_DEMAND_SQL = (
    "select s.event_id, s.user_id, s.ts, s.event_id % 5 + 1 as pieces, s.event_id % 700 + 100 as budget, "
    "f.value * (s.event_id % 5 + 1) as basket_cost, (s.event_id % 700 + 100) - f.value * (s.event_id % 5 + 1) as budget_left "
    f"from {SPINE_SQL} s asof left join {LOG_SQL} f on s.user_id = f.user_id and s.ts >= f.f_ts"
)


@query("fs_on_demand", ON_DEMAND_SQL)
def fs_on_demand(spark, sf_dir):
    return fs.historical_features(_requested(spark, sf_dir), [basket_check(view(spark, sf_dir))], ts="ts")


@query("fs_on_demand_batches", ON_DEMAND_SQL)
def fs_on_demand_batches(spark, sf_dir):
    return fs.historical_features(_requested(spark, sf_dir), [basket_check(view(spark, sf_dir), batches=True)], ts="ts")


@query("fs_feature_service", ON_DEMAND_SQL.replace("f.value * (s.event_id % 5 + 1) as basket_cost", "f.value, f.f_event, f.value * (s.event_id % 5 + 1) as basket_cost"))
def fs_feature_service(spark, sf_dir):
    v = view(spark, sf_dir)
    service = fs.FeatureService("basket_offers", (v, basket_check(v)))
    return fs.historical_features(_requested(spark, sf_dir), service, ts="ts")


@query(
    "fs_feature_list",
    f"select s.event_id, s.user_id, s.ts, f.f_event from {SPINE_SQL} s asof left join {LOG_SQL} f "
    "on s.user_id = f.user_id and s.ts >= f.f_ts",
)
def fs_feature_list(spark, sf_dir):
    chosen = fs.feature_list([view(spark, sf_dir)], ["user_views:f_event"])
    return fs.historical_features(spine(spark, sf_dir), chosen, ts="ts")


@query(
    "fs_fresh_view",
    "select s.event_id, s.user_id, s.ts, f.value, f.f_event from "
    f"{SPINE_SQL} s asof left join (select user_id, ts as f_ts, event_id as f_event, value from events "
    "where event_type <> 'purchase') f on s.user_id = f.user_id and s.ts >= f.f_ts",
)
def fs_fresh_view(spark, sf_dir):
    pushed = table(spark, sf_dir, "events").where("event_type = 'click'").selectExpr(
        "user_id", "ts as f_ts", "event_id as f_event", "value"
    )
    batch = view(spark, sf_dir)
    log = batch.source.df.join(pushed.select("f_event"), "f_event", "left_anti").unionByName(pushed)
    fresh = batch.over(fs.FeatureSource("push_log", "f_ts", df=log), "user_views_fresh")
    return fs.historical_features(spine(spark, sf_dir), [fresh], ts="ts")


@query(
    "fs_metadata",
    "with l as (select * from " + LOG_SQL + ") "
    "select 'user_views' as \"view\", 'value' as feature, 'double' as data_type, 'Amount seen last' as description, "
    "'view_log' as source, 'v1' as version, count(*) as n_rows, round(1 - count(value) / count(*), 6) as null_share, "
    "round(min(value), 4) as low, round(max(value), 4) as high, max(f_ts) as newest_event from l union all "
    "select 'user_views', 'f_event', 'bigint', 'N/A', 'view_log', 'v1', count(*), round(1 - count(f_event) / count(*), 6), "
    "round(cast(min(f_event) as double), 4), round(cast(max(f_event) as double), 4), max(f_ts) from l",
)
def fs_metadata(spark, sf_dir):
    listed = fs.feature_metadata(spark, [view(spark, sf_dir)])
    return listed.select(
        "view", "feature", "data_type", "description", "source", "version", "n_rows",
        F.round("null_share", 6).alias("null_share"),
        F.round(F.col("min_value").cast("double"), 4).alias("low"),
        F.round(F.col("max_value").cast("double"), 4).alias("high"),
        "newest_event",
    )


@query(
    "fs_metadata_document",
    "select 'user_views' as \"view\", '[{\"name\":\"f_event\",\"data_type\":\"bigint\",\"description\":\"N/A\",\"source\":\"view_log\",\"version\":\"v1\",\"n_rows\":' || count(*) || '},"
    "{\"name\":\"value\",\"data_type\":\"double\",\"description\":\"Amount seen last\",\"source\":\"view_log\",\"version\":\"v1\",\"n_rows\":' || count(*) || '}]' as features "
    f"from {LOG_SQL}",
)
def fs_metadata_document(spark, sf_dir):
    document = fs.metadata_document(fs.feature_metadata(spark, [view(spark, sf_dir)]))
    path = scratch_path(spark, "metadata")
    document.write.json(path)
    return spark.read.schema("view string, features string").json(path)


def _feature_sums_sql() -> str:
    """Sum and count of each served feature, from the features' own SQL; the types are the declared ones."""
    fields = customer_view().features
    cells = []
    for f in fields:
        number = f"cast({f.name} as double)" if f.name != "churn" else "cast(length(churn) as double)"
        cells.append(
            f"select '{f.name}' as feature, '{f.dtype.simpleString()}' as data_type, count({f.name}) as n, round(sum({number}), 0) as total from x"
        )
    return f"with x as ({flagship_sql()}) " + " union all ".join(c for c in cells if "'monthly_total_ratio'" not in c)


@query("fs_schema_check", _feature_sums_sql())
def fs_schema_check(spark, sf_dir):
    """Flags stored as booleans and amounts stored as doubles are served in their declared types.

    The ratio is left out: its denominators near 0 have no digits that two engines agree on.
    """
    # Ids of the second source made its own, so that each row is an entity.
    own = source_b(spark, sf_dir).withColumn("customerID", F.concat(F.lit("s"), "customerID"))
    loaded = write_through(stamp(feature_table(source_a(spark, sf_dir), own, chained=False), datetime(2024, 3, 1)), "loaded")
    wanted = customer_view(loaded)
    wanted = wanted[[n for n in wanted.names if n != "monthly_total_ratio"]]
    keys = loaded.select("customerid", F.lit(datetime(2024, 3, 2)).cast("timestamp_ntz").alias("event_timestamp"))
    served = fs.historical_features(keys, [wanted])
    delivered = {f.name: f.dataType.simpleString() for f in served.schema}
    cells = []
    for name in wanted.names:
        cells.append(F.struct(
            F.lit(name).alias("feature"), F.lit(delivered[name]).alias("data_type"), F.col(f"n_{name}").alias("n"), F.col(f"t_{name}").alias("total"),
        ))
    sums = [
        x for name in wanted.names
        for x in (F.count(name).alias(f"n_{name}"), F.round(F.sum((F.length(name) if name == "churn" else F.col(name)).cast("double")), 0).alias(f"t_{name}"))
    ]
    return served.agg(*sums).select(F.inline(F.array(*cells)))


@query(
    "fs_customer_training_set",
    "select customerid, count(*) as n, bool_and(known) as known from (select cast(c_custkey as varchar) as customerid, true as known from customer "
    "union all select cast(s_suppkey as varchar), true from supplier) group by 1",
)
def fs_customer_training_set(spark, sf_dir):
    """Distinct keys and load times of the loaded feature table, with all its features as of then."""
    features = feature_table(source_a(spark, sf_dir), source_b(spark, sf_dir), chained=False)
    loaded = write_through(stamp(features, datetime(2024, 3, 1)), "loaded")
    keys = loaded.groupBy("customerid", "event_timestamp").agg(F.count(F.lit(1)).alias("n"))
    got = fs.historical_features(keys, churn_service(customer_view(loaded)))
    known = [F.col(f.name).isNotNull() for f in MODEL_SIGNATURE]
    everything = known[0]
    for k in known[1:]:
        everything = everything & k
    return got.select("customerid", "n", everything.alias("known"))
