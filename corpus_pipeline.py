"""The corpus pipeline: toxicity, near duplicates, repeated passages, packing.

Every stage decides on rows, not on doc_ids: toxicity by their text; the others number their rows, by file and
place where they lie in Parquet files, else in a written copy, and the operators get the number in place of the id.
So rows with a null id, repeated rows and several texts under one id are each judged by their own text. Columns other
than doc_id and text travel in one struct, so none can clash with a name that an operator uses. Empty tables give
empty tables.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.llm import chaining, minhash, packing, toxicity
from millrace.llm.common import table
from millrace.session import release, small_batches, write_through

# Iterative and fitted stages have no SQL form.
ORACLE_SQL = None


def _in_files(docs: DataFrame, *columns: Column) -> DataFrame | None:
    """(file, place) and these columns, where ``docs`` is nothing but what stands in Parquet files."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return None
    try:
        at = docs.metadataColumn("_metadata")
        return docs.select(at["file_path"].alias("file"), at["row_index"].alias("place"), *columns)
    except AnalysisException:
        return None


def _numbered(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): a number of its own for each row, in the order of the rows, and the other columns.

    Rows in files keep their file and place whoever reads them, so a written row for each file is enough: the number
    of its first row. Files come in the order in which Spark reads them. Other rows are written once.
    """
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    placed = _in_files(docs, F.col("text"), others)
    if placed is not None:
        seen = placed.select("file", "place", F.monotonically_increasing_id().alias("seen"))
        files = seen.groupBy("file").agg(F.min("seen").alias("seen"), F.count(F.lit(1)).alias("n"), F.max("place").alias("last"))
        before = F.sum("n").over(Window.orderBy("seen").rowsBetween(Window.unboundedPreceding, -1))
        files = write_through(files.select("file", "n", "last", F.coalesce(before, F.lit(0)).alias("first")), "pipeline-rows")
        if files.where("n != last + 1").isEmpty():  # else a file is read more than once
            return placed.join(F.broadcast(files.select("file", "first")), "file").select((F.col("first") + F.col("place")).alias("doc_id"), "text", "row")
        release(files)
    return write_through(docs.select(F.monotonically_increasing_id().alias("doc_id"), "text", others), "pipeline-rows")


def _restored(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in columns])


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.select(F.col("doc_id").alias("gone"))
    return rows.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the toxicity model, fitted on all labelled documents among them, does not reject.

    Null and empty texts are scored like any other; a clean text stays even if a toxic one has its doc_id.
    A score is of the text alone, so a 64-bit hash of the text stands for the row, and no copy of the rows is written.
    """
    with small_batches(spark):
        model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
        rejected = toxicity.score_documents(docs.select(F.xxhash64("text").alias("doc_id"), "text"), model).where("predicted = 1")
        rejected = write_through(rejected.select("doc_id").distinct(), "pipeline-rejected")
    return docs.join(rejected, F.xxhash64(docs["text"]) == rejected["doc_id"], "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the first: copies, repeated rows and rows without an id included.

    Texts without words are no duplicates of each other and stay.
    """
    rows = _numbered(docs)
    gone = minhash.near_duplicates(rows.select("doc_id", "text"), width=5, percent=80).where("not kept")
    return _restored(_without(rows, gone), docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without the passages that an earlier row holds; ``n_chars`` follows the text. A row of nothing else goes, empty ones stay."""
    rows = _numbered(docs)
    kept = _restored(chaining.cut_passages(rows, chaining.repeated_passages(rows.select("doc_id", "text"))), docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document left, in its bin; null and empty texts have no pieces."""
    return packing.pack_documents(docs, 2048)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_passages", cut_repeats), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
