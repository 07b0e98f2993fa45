"""Helpers shared by the operators: numbering rows, connected components, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import cut_lineage, write_through


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, label: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within ``keys`` by ``order``, for few keys with very many rows.

    Rows are sorted by range across tasks and written once; a task's first number is the
    sum of the counts of the tasks before it, so no key is gathered anywhere.
    """
    placed = write_through(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id()),
        label,
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*keys, "_part")
        .agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"), "_first", "_offset")
    )
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return placed.join(offsets, same).select(
        *df.columns, (F.col("_offset") + F.col("_place") - F.col("_first")).alias(name)
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node reachable.

    Alternates large-star and small-star steps until every component is a star; both are one
    aggregate and one join on narrow rows, and a hub with very many links is split by the
    skew handling of the join. The links are never gathered.
    """
    links = cut_lineage(
        edges.where("a != b")
        .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        .distinct()
    )
    while not _all_stars(links):
        both = links.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(
            links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo != hi").distinct()
        )
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(smallest, "hi")
            .select(F.col("m").alias("p"), "lo", "hi")
            .select(F.inline(F.array(
                F.struct(F.col("p").alias("lo"), F.col("lo").alias("hi")),
                F.struct(F.col("p").alias("lo"), F.col("hi").alias("hi")),
            )))
            .where("lo != hi")
            .distinct()
        )
        links = cut_lineage(small)
    roots = links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


def _all_stars(links: DataFrame) -> bool:
    """Whether every upper end of the links (lo, hi) has one link only and is no lower end."""
    ends = links.select(F.inline(F.array(
        F.struct(F.col("lo").alias("node"), F.lit(0).alias("up")),
        F.struct(F.col("hi").alias("node"), F.lit(1).alias("up")),
    )))
    per = ends.groupBy("node").agg(F.min("up").alias("least"), F.sum("up").alias("ups"))
    return per.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()
