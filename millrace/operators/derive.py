"""Derived features: narrow expressions, and per-entity aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import flag_to_int, guarded_ratio, total

# The service flags that make up the service total. Backup counts twice in
# the default list; ``dedupe`` counts each once.
SERVICE_FLAGS = (
    "onlinesecurity_yes",
    "onlinebackup_yes",
    "onlinebackup_yes",
    "techsupport_yes",
    "streamingtv_yes",
    "streamingmovies_yes",
)


def total_services(flags: Sequence[str] = SERVICE_FLAGS, dedupe: bool = False) -> Column:
    chosen = list(dict.fromkeys(flags)) if dedupe else list(flags)
    return total(F.col(c).cast("int") for c in chosen)


def family_columns(partner: Column, dependents: Column) -> dict[str, Column]:
    return {
        "partner_label": flag_to_int(partner),
        "dependents_label": flag_to_int(dependents),
        "family_label": flag_to_int(partner) + flag_to_int(dependents),
    }


def customer_features(df: DataFrame, dedupe: bool = False) -> DataFrame:
    """Add the derived columns to a scaled and one-hot encoded customer table."""
    return df.withColumns(
        {
            "total_services": total_services(dedupe=dedupe),
            "monthly_total_ratio": guarded_ratio(F.col("monthlycharges"), F.col("totalcharges")),
            **family_columns(F.col("partner_yes"), F.col("dependents_yes")),
        }
    )


def spend_per_entity(entities: DataFrame, facts: DataFrame, entity_key: str, fact_key: str, amount: str) -> DataFrame:
    """Total, count, mean and maximum spend per entity, zero rows kept.

    Facts are aggregated before the join, so one entity's many facts never meet in a join.
    Sums run on decimals: the same total in any order of the rows.
    """
    money = F.col(amount).cast("decimal(18,2)")
    spend = facts.groupBy(F.col(fact_key).alias(entity_key)).agg(
        F.sum(money).alias("total_spend"), F.count(F.lit(1)).alias("n_facts"), F.max(amount).alias("max_spend")
    )
    joined = entities.select(entity_key).join(spend, entity_key, "left")
    return joined.select(
        entity_key,
        F.coalesce(F.col("total_spend").cast("double"), F.lit(0.0)).alias("total_spend"),
        F.coalesce("n_facts", F.lit(0)).alias("n_facts"),
        F.try_divide(F.col("total_spend").cast("double"), F.col("n_facts")).alias("mean_spend"),
        F.col("max_spend"),
    )


def activity_per_entity(log: DataFrame, key: str, ts: str) -> DataFrame:
    """Tenure in days, active days and events per active day.

    Counts per (entity, day) come first: a busy entity is spread over its days, and the
    second aggregate sees at most one row per entity and day.
    """
    daily = log.groupBy(key, F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
    return daily.groupBy(key).agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        F.datediff(F.max("day"), F.min("day")).alias("tenure_days"),
        F.count(F.lit(1)).alias("active_days"),
        F.sum("n").alias("n_events"),
        (F.sum("n") / F.count(F.lit(1))).alias("events_per_active_day"),
    )
