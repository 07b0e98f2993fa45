"""Repeated lines, found with levelled sorted runs of line hashes.

Line keys arrive in batches. A run is a bucketed table, sorted by key hash, with one row per
key: in how many documents it was seen (``n``) and the largest doc_id among them (``top``).
A batch is merge-anti-joined with the runs: keys whose fate no later document can change
(enough documents, and a larger doc_id seen) are left out; the rest are added as a run of
level 0. Two runs of one level are compacted into one of the next, so the runs stay few.
Because runs and batches are bucketed by the same hash, anti-joins and compactions merge
sorted buckets; only the batch itself is shuffled, after it was summed per task.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.session import scratch_path, write_through

#: What is stripped from both ends of a line.
BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, h1, h2, places): each line key of at least ``min_chars`` code points.

    One row per document and key, with the places of its lines. 128 bits stand for a key:
    two hashes with different seeds. Rows that repeat doc_id and text are one document.
    """
    text = F.coalesce("text", F.lit(""))
    each = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n", -1)).alias("place", "line"))
    bare = each.select("doc_id", "text_hash", "place", F.trim("line", F.lit(BLANK)).alias("line")).where(F.length("line") >= min_chars)
    key = F.translate("line", UPPER, LOWER)
    hashed = bare.select("doc_id", "text_hash", "place", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    return hashed.groupBy("doc_id", "text_hash", *KEY).agg(F.collect_set("place").alias("places"))


class LineRuns:
    """Levelled runs of line hashes in the shared folder, merged as batches come in.

    A level holds one run at most: a second one is merged with it into the next level, so
    each row is rewritten once a level and k batches leave about log2(k) runs.
    """

    def __init__(self, spark: SparkSession, min_docs: int):
        self.spark, self.min_docs = spark, min_docs
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[str | None] = []

    def add(self, keys: DataFrame) -> None:
        """Merge-anti-join a batch (doc_id, h1, h2; a row per document and key) with the runs and add its own run."""
        own = keys.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top"))
        for name in filter(None, self.levels):
            known = self.spark.table(name).where(F.col("n") >= self.min_docs).select(*KEY, F.col("top").alias("known_top")).hint("merge")
            settled = F.col("top").isNull() | (F.col("top") <= F.col("known_top"))
            own = own.join(known, (own["h1"] == known["h1"]) & (own["h2"] == known["h2"]) & settled, "left_anti")
        self._place(self._write(own), 0)

    def repeated(self) -> DataFrame:
        """(h1, h2, top) of the keys that at least ``min_docs`` documents hold; leaves a single run."""
        names = [n for n in self.levels if n]
        last = names[0]
        for name in names[1:]:
            last = self._merge(last, name)
        self.levels = [last]
        return self.spark.table(last).where(F.col("n") >= self.min_docs).select(*KEY, "top")

    def drop(self) -> None:
        """Remove the runs; results read from them must have been written."""
        for name in filter(None, self.levels):
            self._remove(name)
        self.levels = []

    def _place(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append(None)
        held, self.levels[level] = self.levels[level], None
        if held:
            self._place(self._merge(held, name), level + 1)
        else:
            self.levels[level] = name

    def _merge(self, one: str, two: str) -> str:
        """Both runs as one, bucket by bucket."""
        a, b = self.spark.table(one).alias("a"), self.spark.table(two).alias("b").hint("merge")
        both = a.join(b, (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")), "full")
        name = self._write(both.select(
            *[F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in KEY],
            (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"),
            F.greatest("a.top", "b.top").alias("top"),
        ))
        self._remove(one)
        self._remove(two)
        return name

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid4().hex}"
        path = scratch_path(self.spark, "line-run")
        rows.write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        return name

    def _remove(self, name: str) -> None:
        where = self.spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
        self.spark.sql(f"DROP TABLE {name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dedup_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, batches: int = 4) -> DataFrame:
    """Documents without their repeated lines: (doc_id, kept, n_lines, n_dropped), a row per row of ``docs``.

    A line's key is the line without ``BLANK`` at both ends and with A-Z lower-cased. Keys of at
    least ``min_chars`` code points that at least ``min_docs`` documents hold lose all lines
    except those in the largest doc_id that holds them. Lines end at line feeds only.

    Null and empty texts are one empty line. Rows that repeat doc_id and text count as one
    document and are all returned; two texts under one doc_id are two documents, and both
    keep the key if that doc_id is the largest. A null doc_id is smaller than any other.
    Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt = line_keys(docs, min_chars).withColumn("batch", F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(batches)).cast("int"))
    lines = _write_batches(dealt)
    runs = LineRuns(spark, min_docs)
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k).select("doc_id", *KEY))
    repeated = write_through(runs.repeated(), "repeated-lines")
    runs.drop()
    dropped = (
        lines.join(repeated, KEY)
        .where(~F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy(F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_hash"))
        .agg(F.flatten(F.collect_list("places")).alias("lost"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.xxhash64("text") == F.col("lost_hash"))
    lost = F.coalesce("lost", F.array().cast("array<int>"))
    both = docs.join(dropped, same, "left").select("doc_id", "text", lost.alias("lost"))
    return both.select("doc_id", F.inline(F.transform(F.array(F.split("text", "\n", -1)), lambda ls: F.struct(
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), "lost"), lambda i: F.get(ls, i)), "\n").alias("kept"),
        F.size(ls).cast("long").alias("n_lines"),
        F.size("lost").cast("long").alias("n_dropped"),
    ))))


def _write_batches(dealt: DataFrame) -> DataFrame:
    path = scratch_path(dealt.sparkSession, "lines")
    dealt.write.partitionBy("batch").parquet(path)
    return dealt.sparkSession.read.schema(dealt.schema).parquet(path)
