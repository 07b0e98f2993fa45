"""The stages from raw sources to scored models, one function per job.

Each stage reads the snapshot it is given and publishes a new one, so runs do not mix; the
latest snapshot of a zone is only a default. Order and timing are left to any scheduler.
Customer tables are wide, so the projections of every stage run in methods that the JVM compiles.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.scalars import moment
from millrace.operators.derive import customer_features
from millrace.operators.eda import correlation_change
from millrace.operators.encode import encode_label
from millrace.operators.expectations import validate
from millrace.operators.quality import Rules, quality_report, resolutions
from millrace.plans import churn_definitions as churn
from millrace.plans.customers import churn_service, customer_view, impute_merged, merge_sources, prepare
from millrace.plans.feature_store import historical_features
from millrace.plans.learning import fit_forest, fit_logistic, model_matrix, save_model, train_and_score
from millrace.session import short_methods, write_through
from millrace.sources.landing import land_raw
from millrace.sources.snapshots import latest_snapshot, publish
from millrace.sources.warehouse import full_refresh, stamp, to_warehouse_types


@dataclass(frozen=True)
class Zones:
    """Folders of the lake, all under one root."""

    root: str

    def __getattr__(self, zone: str) -> str:
        if zone.startswith("_"):
            raise AttributeError(zone)
        return f"{self.root.rstrip('/')}/{zone}"


def read_snapshot(spark: SparkSession, zone: str, path: str | None = None) -> DataFrame:
    return spark.read.parquet(path or latest_snapshot(spark, zone, "*.parquet"))


def land_stage(df: DataFrame, zones: Zones, source: str, at: datetime) -> str:
    with short_methods(df.sparkSession):
        return land_raw(df, moment(at), zones.raw, source)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Text cells of nothing but spaces are missing cells."""
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.when(F.trim(c) != "", F.col(c)) for c in texts})


def suite_results(df: DataFrame, suite) -> DataFrame:
    """The suite's results on a raw source: blank cells count as missing."""
    return validate(blank_to_null(df), suite)


def validate_stage(df: DataFrame, rules: Rules, suite, zones: Zones, source: str, at: datetime) -> tuple[str, str]:
    """Publish the rule report with its advice, and the suite's results."""
    with short_methods(df.sparkSession):
        report = resolutions(quality_report(df, rules), rules.key)
        return (
            publish(report, zones.reports, f"{source}_report", at, "csv"),
            publish(suite_results(df, suite).coalesce(1), zones.reports, f"{source}_suite", at, "csv"),
        )


def merge_stage(source_a: DataFrame, source_b: DataFrame, zones: Zones, at: datetime) -> str:
    with short_methods(source_a.sparkSession):
        merged = write_through(merge_sources(source_a, source_b), "merged")
        return publish(impute_merged(merged), zones.merged, "customers", at)


def prepare_stage(spark: SparkSession, zones: Zones, at: datetime, merged: str | None = None) -> str:
    with short_methods(spark):
        return publish(prepare(read_snapshot(spark, zones.merged, merged)), zones.processed, "customers", at)


def transform_stage(spark: SparkSession, zones: Zones, at: datetime, processed: str | None = None) -> str:
    """Publish the derived features, and how they moved the correlations with the label."""
    label = churn.LABEL.lower()

    def numbers(df: DataFrame) -> DataFrame:
        flags = [f.name for f in df.schema if f.dataType.typeName() == "boolean"]
        coded = encode_label(df, label, "label").drop(label, churn.KEY.lower())
        return coded.withColumns({c: F.col(c).cast("int") for c in flags}).withColumnRenamed("label", label)

    with short_methods(spark):
        before = read_snapshot(spark, zones.processed, processed)
        path = publish(customer_features(before), zones.transformed, "customers", at)
        change = correlation_change(numbers(before), numbers(spark.read.parquet(path)), label)
        publish(change.coalesce(1), zones.reports, "correlations", at, "csv")
        return path


def load_stage(spark: SparkSession, zones: Zones, table: str, at: datetime, transformed: str | None = None) -> DataFrame:
    """Replace the warehouse table, stamped with the load time."""
    with short_methods(spark):
        features = read_snapshot(spark, zones.transformed, transformed)
        return full_refresh(stamp(to_warehouse_types(features), at), table)


def train_stage(spark: SparkSession, zones: Zones, table: str) -> DataFrame:
    """Retrieve the training set as of each row's load time, fit both learners, save them.

    Returns one row of metrics per learner with the version it was saved under.
    """
    view = customer_view(table=table)
    spine = spark.table(table).select("customerid", "event_timestamp").distinct()
    with short_methods(spark):
        training = historical_features(spine, churn_service(view))
        matrix = write_through(model_matrix(training, "churn", "customerid", churn.MODEL_FEATURES), "matrix")
    out = None
    for name, fit in (("logistic_regression", fit_logistic), ("random_forest", fit_forest)):
        fitted = {}

        def keep(train, features, fit=fit, fitted=fitted):
            fitted["model"] = fit(train, features)
            return fitted["model"]

        scored = train_and_score(matrix, "customerid", churn.MODEL_FEATURES, keep)
        version = save_model(spark, fitted["model"], f"{zones.models}/{name}")
        row = scored.select(F.lit(name).alias("model"), F.lit(version).alias("version"), "*")
        out = row if out is None else out.unionByName(row)
    return out
