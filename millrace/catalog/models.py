"""Queries: split, model matrix, weights, metrics, and the two learners."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import functions as F, types as T

from millrace.catalog.inputs import LABELLED_LINES_SQL, labelled_lines, source_a, source_b
from millrace.catalog.registry import query, table
from millrace.operators import metrics
from millrace.operators.schema import conforming_rows
from millrace.plans import stages
from millrace.plans.churn_definitions import MODEL_FEATURES, RULES_A, RULES_B, SUITE_A, SUITE_B
from millrace.plans.customers import feature_table
from millrace.plans.learning import fit_forest, fit_logistic, model_matrix, train_and_score
from millrace.session import scratch_path, write_through
from millrace.sources.landing import read_raw

SPLIT_SQL = "cast(('0x' || substr(md5('42:' || cast(o_orderkey as varchar)), 1, 8)) as bigint) / 4294967296.0"


@query("ml_split", f"select o_orderkey, {SPLIT_SQL} < 0.7 as in_train from orders")
def ml_split(spark, sf_dir):
    train, test = metrics.split_by_key(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey")
    return train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))


@query(
    "ml_model_matrix",
    "select o_orderkey, cast(o_custkey as double) as o_custkey, "
    "coalesce(case when o_orderkey % 7 = 0 then null else o_totalprice end, 0) as price, "
    "coalesce(case when o_orderkey % 5 = 0 then null else o_orderpriority = '2-HIGH' end, false) as high, "
    "cast(dense_rank() over (order by o_orderstatus) - 1 as double) as label from orders",
)
def ml_model_matrix(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "case when o_orderkey % 7 = 0 then null else o_totalprice end as price",
        "case when o_orderkey % 5 = 0 then null else o_orderpriority = '2-HIGH' end as high",
        "o_orderstatus",
        "o_orderdate as event_timestamp",
    )
    return model_matrix(df, "o_orderstatus", "o_orderkey", ["o_custkey", "price", "high"])


@query(
    "ml_class_weights",
    f"with l as ({LABELLED_LINES_SQL}) select label, count(*) as n, "
    "round((select count(*) from l) / ((select count(distinct label) from l) * count(*)), 6) as weight from l group by 1",
)
def ml_class_weights(spark, sf_dir):
    return metrics.class_weights(labelled_lines(spark, sf_dir), "label").withColumn("weight", F.round("weight", 6))


@query(
    "ml_binary_metrics",
    f"with c as (select count(*) filter (label = 1 and prediction = 1) as tp, count(*) filter (label = 0 and prediction = 1) as fp, "
    "count(*) filter (label = 0 and prediction = 0) as tn, count(*) filter (label = 1 and prediction = 0) as fn "
    f"from ({LABELLED_LINES_SQL})) select tp, fp, tn, fn, round((tp + tn) / (tp + fp + tn + fn), 6) as accuracy, "
    "round(tp / (tp + fp), 6) as \"precision\", round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c",
)
def ml_binary_metrics(spark, sf_dir):
    scored = metrics.binary_metrics(labelled_lines(spark, sf_dir), "label", "prediction")
    return scored.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


SIGNATURE = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DoubleType()), T.StructField("flag", T.BooleanType())])


@query(
    "ml_signature",
    "select id, cast(amount as double) as amount, cast(flag as boolean) as flag, true as fits from "
    "(select o_orderkey as id, case when o_orderkey % 9 = 0 then 'bad' else cast(cast(o_totalprice as decimal(18,2)) as varchar) end as amount, "
    "case when o_orderstatus = 'P' then null else o_orderstatus = 'F' end as flag from orders) "
    "where try_cast(amount as double) is not null and flag is not null union all "
    "select o_orderkey, null, null, false from orders where o_orderkey % 9 = 0 or o_orderstatus = 'P'",
)
def ml_signature(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as id",
        "case when o_orderkey % 9 = 0 then 'bad' else cast(cast(o_totalprice as decimal(18,2)) as string) end as amount",
        "case when o_orderstatus = 'P' then null else o_orderstatus = 'F' end as flag",
    )
    good, refused = conforming_rows(df, SIGNATURE)
    left_out = refused.select("id", F.lit(None).cast("double").alias("amount"), F.lit(None).cast("boolean").alias("flag"))
    return good.withColumn("fits", F.lit(True)).unionByName(left_out.withColumn("fits", F.lit(False)))


def churn_matrix(spark, sf_dir):
    features = feature_table(source_a(spark, sf_dir), source_b(spark, sf_dir), chained=True)
    return write_through(model_matrix(features, "churn", "customerid", MODEL_FEATURES), "matrix")


@query("ml_logreg")
def ml_logreg(spark, sf_dir):
    return train_and_score(churn_matrix(spark, sf_dir), "customerid", MODEL_FEATURES, fit_logistic)


@query("ml_forest")
def ml_forest(spark, sf_dir):
    return train_and_score(churn_matrix(spark, sf_dir), "customerid", MODEL_FEATURES, fit_forest)


@query("ml_all_stages")
def ml_all_stages(spark, sf_dir):
    """Land, validate, merge, prepare, transform, load, retrieve and train, each from files."""
    zones = stages.Zones(scratch_path(spark, "lake"))
    a, b, at = source_a(spark, sf_dir), source_b(spark, sf_dir), datetime(2024, 3, 1, 6)
    raw_a = read_raw(spark, stages.land_stage(a, zones, "a", at), a.schema).select(*a.columns)
    raw_b = read_raw(spark, stages.land_stage(b, zones, "b", at), b.schema).select(*b.columns)
    stages.validate_stage(raw_a, RULES_A, SUITE_A, zones, "a", at)
    stages.validate_stage(raw_b, RULES_B, SUITE_B, zones, "b", at)
    merged = stages.merge_stage(raw_a, raw_b, zones, at)
    processed = stages.prepare_stage(spark, zones, at, merged)
    transformed = stages.transform_stage(spark, zones, at, processed)
    table_name = f"churn_features_{uuid4().hex[:12]}"
    stages.load_stage(spark, zones, table_name, at, transformed)
    return stages.train_stage(spark, zones, table_name)
