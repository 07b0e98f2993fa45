"""Queries: sources, snapshots, the raw zone and warehouse tables, written and read back."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import functions as F

from millrace.catalog.inputs import DIRTY_ORDERS_SQL, dirty_orders
from millrace.catalog.registry import query, table
from millrace.functions.scalars import hourly_path
from millrace.session import scratch_path
from millrace.sources import landing, readers, snapshots, warehouse

CUSTOMER_CSV = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("src_csv_roundtrip", "select * from customer")
def src_csv_roundtrip(spark, sf_dir):
    path = snapshots.publish(
        table(spark, sf_dir, "customer"), scratch_path(spark, "csv"), "customer", datetime(2024, 1, 1), "csv"
    )
    return readers.read_csv(spark, path, CUSTOMER_CSV)


@query(
    "src_blank_to_null",
    f"select id, nullif(trim(price_text), '') as price_text, status from ({DIRTY_ORDERS_SQL})",
)
def src_blank_to_null(spark, sf_dir):
    path = scratch_path(spark, "blank")
    dirty = dirty_orders(spark, sf_dir).select("id", "price_text", "status")
    dirty.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return readers.read_csv(spark, path, "id bigint, price_text string, status string", strip_blanks=True)


@query("src_parquet_scan", "select l_orderkey, l_linenumber, l_extendedprice from lineitem")
def src_parquet_scan(spark, sf_dir):
    df = readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")
    return df.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "src_normalize_nulls",
    f"select id, case when price_text in ('n/a') then null else price_text end as price_text from ({DIRTY_ORDERS_SQL})",
)
def src_normalize_nulls(spark, sf_dir):
    from millrace.operators.schema import normalize_nulls

    return normalize_nulls(dirty_orders(spark, sf_dir).select("id", "price_text"), readers.MISSING_TOKENS)


@query("limit_bounded_read", "select o_orderkey, o_orderstatus from orders order by o_orderkey limit 10000")
def limit_bounded_read(spark, sf_dir):
    return readers.first_rows(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


@query("limit_peek", "select * from customer order by c_custkey limit 5")
def limit_peek(spark, sf_dir):
    return warehouse.peek(table(spark, sf_dir, "customer"), ["c_custkey"])


@query("snap_parquet_roundtrip", "select * from orders")
def snap_parquet_roundtrip(spark, sf_dir):
    path = snapshots.publish(table(spark, sf_dir, "orders"), scratch_path(spark, "snap"), "orders", datetime(2024, 1, 1))
    return readers.read_parquet(spark, path)


@query("snap_latest", "select c_custkey, c_acctbal + 1 as c_acctbal from customer")
def snap_latest(spark, sf_dir):
    zone = scratch_path(spark, "zone")
    base = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    snapshots.publish(base, zone, "customer", datetime(2024, 1, 2))
    snapshots.publish(base.withColumn("c_acctbal", F.col("c_acctbal") + 1), zone, "customer", datetime(2024, 1, 3))
    # Neither a processed version nor one that was never published counts.
    snapshots.publish(base, zone, "customer_Done", datetime(2024, 1, 4))
    base.write.parquet(f"{zone}/20240105_000000/customer")
    return readers.read_parquet(spark, snapshots.latest_snapshot(spark, zone, "*.parquet"))


_CELLS = ", ".join(
    f"coalesce(length(cast({c} as varchar)) || '=' || cast({c} as varchar), '~')"
    for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
)
HASH_SQL = f"cast(('0x' || substr(md5(concat_ws('|', {_CELLS})), 1, 15)) as bigint)"


@query(
    "snap_fingerprint",
    f"select count(*) as n_rows, cast(sum({HASH_SQL}) as varchar) as content_hash, "
    "'c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment' as column_list from customer",
)
def snap_fingerprint(spark, sf_dir):
    return snapshots.fingerprint(table(spark, sf_dir, "customer"))


@query(
    "snap_manifest",
    "select count(*) as n_rows, cast(sum(cast(('0x' || substr(md5(concat_ws('|', length(p_partkey::varchar) || '=' || p_partkey, length(p_name) || '=' || p_name, "
    "length(p_brand) || '=' || p_brand, length(p_size::varchar) || '=' || p_size)), 1, 15)) as bigint)) as varchar) as content_hash, "
    "'p_partkey,p_name,p_brand,p_size' as column_list, sum(length(p_partkey || ',' || p_name || ',' || p_brand || ',' || p_size) + 1)::bigint as body_bytes from part",
)
def snap_manifest(spark, sf_dir):
    """As text, so that SQL can tell the bytes: rows and a header line in each file."""
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    path = snapshots.publish(df, scratch_path(spark, "manifest"), "part", datetime(2024, 1, 1), "csv")
    record = snapshots.manifest(spark, path, "csv")
    header = F.length("column_list") + 1
    return record.select("n_rows", "content_hash", "column_list", (F.col("bytes") - F.col("n_files") * header).alias("body_bytes"))


@query(
    "snap_diff_pruned",
    "select o_orderkey as k, case when o_orderkey % 5000 = 7 then 'removed' when o_orderkey % 5000 = 11 then 'changed' else 'added' end as change "
    "from (select o_orderkey from orders where o_orderkey % 5000 in (7, 11) union all select -o_orderkey from orders where o_orderkey % 5000 = 13)",
)
def snap_diff_pruned(spark, sf_dir):
    """Two published versions with a key that differ in a few rows: buckets with equal sums are not read."""
    zone = scratch_path(spark, "keyed")
    old = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus", "o_totalprice")
    kind = F.col("k") % 5000
    changed = old.where(kind != 7).withColumn("o_orderstatus", F.when(kind == 11, F.lit("?")).otherwise(F.col("o_orderstatus")))
    new = changed.unionByName(old.where(kind == 13).withColumn("k", -F.col("k")))
    for df, day in ((old, 1), (new, 2)):
        snapshots.publish(df, zone, "orders", datetime(2024, 1, day), key=["k"])
    second, first = list(snapshots.VersionLog(spark, zone, keep=None).history())
    return snapshots.version_diff(spark, zone, first, second)


@query(
    "snap_diff",
    "select coalesce(o.k, n.k) as k, case when o.k is null then 'added' when n.k is null then 'removed' else 'changed' end as change "
    "from (select o_custkey as k, count(*) as c, sum(cast(o_totalprice as decimal(18,2))) as v from orders group by 1) o full join "
    "(select c_custkey as k, c_nationkey % 3 as c, cast(0 as decimal(18,2)) as v from customer) n on o.k = n.k "
    "where o.k is null or n.k is null or o.c <> n.c or o.v <> n.v",
)
def snap_diff(spark, sf_dir):
    old = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("v")
    )
    new = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("k"),
        (F.col("c_nationkey") % 3).cast("bigint").alias("c"),
        F.lit(0).cast("decimal(28,2)").alias("v"),
    )
    return snapshots.snapshot_diff(old, new, ["k"])


LANDED = "strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day"


@query("land_partitioned", f"select event_id, user_id, event_type, value, {LANDED} from events")
def land_partitioned(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    path = landing.land_raw(df, F.col("ts"), scratch_path(spark, "raw"), "events")
    return landing.read_raw(spark, path, df.schema).drop("ts")


@query(
    "land_hourly_path",
    "select event_id, strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day, strftime(ts, '%H') as hour, "
    "strftime(ts, '%Y/%m/%d/%H') as hour_path from events",
)
def land_hourly_path(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts")
    path = landing.land_hourly(df, F.col("ts"), scratch_path(spark, "hourly"), "events")
    landed = landing.read_raw(spark, path, df.schema, keys=landing.HOURLY_KEYS)
    return landed.withColumn("hour_path", hourly_path(F.col("ts"))).drop("ts")


@query(
    "ingest_size_gate",
    "select cast(c_nationkey as varchar) as nation, c_mktsegment as segment, sum(length(c_name) + 1) as bytes, "
    "sum(length(c_name) + 1) >= 1024 as accepted from customer group by 1, 2",
)
def ingest_size_gate(spark, sf_dir):
    zone = scratch_path(spark, "gate")
    landed = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("value")
    )
    landed.hint("rebalance", "nation", "segment").write.partitionBy("nation", "segment").text(zone)
    gated = snapshots.size_gate(spark, zone)
    return gated.select(
        F.regexp_extract("folder", "nation=([^/]*)", 1).alias("nation"),
        F.regexp_extract("folder", "segment=([^/]*)", 1).alias("segment"),
        "bytes",
        "accepted",
    )


def _fresh_name(label: str) -> str:
    return f"{label}_{uuid4().hex[:12]}"


@query(
    "wh_full_refresh",
    "select c_custkey, c_mktsegment, c_acctbal * 2 as c_acctbal from customer",
)
def wh_full_refresh(spark, sf_dir):
    name = _fresh_name("customers")
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    where = scratch_path(spark, name)
    first = warehouse.full_refresh(df, name, where)
    if not warehouse.table_exists(spark, name):
        raise RuntimeError(f"{name} was not created")
    return warehouse.full_refresh(first.withColumn("c_acctbal", F.col("c_acctbal") * 2), name, where)


@query(
    "wh_type_map",
    "select o_orderkey, cast(o_custkey as bigint) as o_custkey, cast(o_totalprice as double) as price_float, "
    "o_orderstatus = 'F' as done, o_orderdate, cast(cast(o_totalprice as decimal(18,2)) as varchar) as price_decimal, "
    "cast(cast(o_orderdate as date) as varchar) as day, cast(o_orderkey % 100 as bigint) as small from orders",
)
def wh_type_map(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "cast(o_custkey as int) as o_custkey",
        "o_totalprice as price_float",
        "o_orderstatus = 'F' as done",
        "o_orderdate",
        "cast(o_totalprice as decimal(18,2)) as price_decimal",
        "cast(o_orderdate as date) as day",
        "cast(o_orderkey % 100 as smallint) as small",
    )
    return warehouse.to_warehouse_types(df)


@query("wh_audit_stamp", "select s_suppkey, s_acctbal, timestamp '2024-03-01 12:30:00' as event_timestamp from supplier")
def wh_audit_stamp(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return warehouse.stamp(df, datetime(2024, 3, 1, 12, 30))


@query(
    "wh_ensure_table",
    "select cast(c_custkey as varchar) as customer_id, cast(c_custkey % 90 as int) as age, c_mktsegment as city, "
    "cast(c_acctbal as decimal(10,2)) as total_revenue from customer",
)
def wh_ensure_table(spark, sf_dir):
    """The seeded table is made once; a second call leaves it, and its types hold for what is written."""
    name, where = _fresh_name("seeded"), scratch_path(spark, "seeded")
    for _ in range(2):
        warehouse.ensure_table(spark, name, warehouse.CUSTOMER_TABLE_SCHEMA, where)
    rows = table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as string) as customer_id", "cast(c_custkey % 90 as int) as age", "c_mktsegment as city",
        "cast(c_acctbal as decimal(10,2)) as total_revenue",
    )
    known = set(rows.columns)
    rows.select(*[F.col(f.name) if f.name in known else F.lit(None).cast(f.dataType).alias(f.name) for f in spark.table(name).schema]).write.insertInto(name)
    return spark.table(name).select(*rows.columns)


@query(
    "dml_insert_if_absent",
    "with b as (select o_orderkey // 4 as k, o_orderdate, o_orderkey, o_orderstatus as v from orders), "
    "f as (select k, v, row_number() over (partition by k order by o_orderdate, o_orderkey) as place from b) "
    "select c_custkey as k, c_mktsegment as v from customer union all "
    "select k, v from f where place = 1 and not exists (select 1 from customer where c_custkey = k)",
)
def dml_insert_if_absent(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey as k", "c_mktsegment as v")
    batch = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey div 4 as k", "o_orderdate", "o_orderkey", "o_orderstatus as v"
    )
    kept = warehouse.KeyedTable(spark, scratch_path(spark, "keyed"), "k", buckets=16)
    kept.insert_if_absent(customers, ["v"])
    kept.insert_if_absent(batch, ["o_orderdate", "o_orderkey"])
    return kept.read().select("k", "v")
