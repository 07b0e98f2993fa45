"""Classifier metrics, class weights and the reproducible split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import write_through


def binary_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Confusion counts and accuracy, precision, recall, F1 (positive = 1) in one aggregate."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn")
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def share(part, whole):
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    return counts.select(
        "tp",
        "fp",
        "tn",
        "fn",
        share(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): rows / (classes x rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes")).first()
    weight = F.lit(float(totals["rows"] or 0)) / (F.lit(max(totals["classes"], 1)) * F.col("n"))
    return counts.withColumn("weight", weight)


def with_balanced_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add each row's class weight. The counts are written once and joined, however many classes there are."""
    counts = write_through(class_weights(df, label).select(F.col("label").alias("_label"), F.col("weight").alias(out)), "class-weights")
    return df.join(counts, F.col(label) == F.col("_label"), "left").drop("_label")


def split_fraction(key: Column, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the key and the seed only.

    Unlike ``randomSplit`` it gives the same split however the table is partitioned.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def split_by_key(df: DataFrame, key: str, train_share: float = 0.7, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    place = split_fraction(F.col(key), seed)
    return df.where(place < train_share), df.where(place >= train_share)
