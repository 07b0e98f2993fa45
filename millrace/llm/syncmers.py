"""Document fingerprints from closed syncmers; DataFrame expressions only.

A text is a sequence of symbols: words, of at most 16 characters a piece, and single characters
of scripts written without spaces. Of all runs of ``K`` symbols those are chosen whose smallest
inner run of ``S`` symbols (by hash) stands first or last. Whether a run is chosen depends on the
run alone, so an edit changes only the runs it touches. The fingerprint holds all chosen runs in
text order: the 32-bit hash of each, and how many symbols it starts after the one before, as
hexadecimal text. Likeness is the Jaccard likeness of the full sets of hashes. A sketch of the
``SIZE`` smallest hashes is there too, for those who want a short one.

Defined results: a text too short for a run, or without a chosen one, has the hash of its whole
symbol sequence; a text without symbols has the empty fingerprint; equal fingerprints have
likeness 1, an empty one against another 0. Null texts are empty. Rows with one doc_id follow
each other by text; null ids come last; a single row is its own next row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

K, S, SIZE = 5, 2, 128
_SOLO = r"぀-ヿ㐀-䶿一-鿿가-힯"
SYMBOL = rf"[{_SOLO}]|[^\s{_SOLO}]{{1,16}}"
PIECES = 32


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the sketch of column ``text`` as a sorted array of ints, and ``name_at``: all its anchors (at, hash) in text order."""
    words, pairs, every = f"_{name}_words", f"_{name}_pairs", f"{name}_at"
    n = F.size(words)
    low = lambda h: F.shiftright(h, 32).cast("int")
    run = F.arrays_zip(
        F.col(pairs).alias("a"),
        F.slice(pairs, 2, F.greatest(n, F.lit(0))).alias("b"),
        F.slice(pairs, 3, F.greatest(n, F.lit(0))).alias("c"),
        F.slice(pairs, K - S + 1, F.greatest(n, F.lit(0))).alias("d"),
        F.slice(words, 3, F.greatest(n, F.lit(0))).alias("mid"),
        F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))).alias("at"),
    )
    edge = lambda z: F.least(z["a"], z["d"]) <= F.least(z["b"], z["c"])
    chosen = F.transform(
        F.filter(run, lambda z: z["d"].isNotNull() & edge(z)),
        lambda z: F.struct(z["at"].alias("at"), low(F.xxhash64(z["a"], z["d"], z["mid"])).alias("hash")),
    )
    whole = F.array(F.struct(F.lit(0).alias("at"), low(F.xxhash64(words)).alias("hash")))
    return (
        df.withColumn(words, F.transform(F.regexp_extract_all(text, F.lit(SYMBOL), F.lit(0)), lambda w: F.xxhash64(w)))
        .withColumn(
            pairs,
            F.zip_with(
                F.slice(words, 1, F.greatest(n - 1, F.lit(0))),
                F.slice(words, 2, F.greatest(n - 1, F.lit(0))),
                lambda x, y: F.xxhash64(x, y),
            ),
        )
        .withColumn(every, chosen)
        .withColumn(every, F.when((n > 0) & (F.size(every) == 0), whole).otherwise(F.col(every)))
        .withColumn(name, F.slice(F.array_sort(hashes(F.col(every))), 1, SIZE))
        .drop(words, pairs)
    )


def hashes(every: Column) -> Column:
    """The set of hashes of anchors (at, hash)."""
    return F.array_distinct(F.transform(every, lambda z: z["hash"]))


def placed_text(every: Column) -> Column:
    """Anchors (at, hash) as text: eight digits of hash and the distance to the anchor before, in order, with spaces between."""
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(every, i - 1)["at"])
    digits = lambda h: F.lpad(F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")
    return F.array_join(F.transform(every, lambda z, i: F.concat(digits(z["hash"]), F.hex((z["at"] - before(i)).cast("long")))), " ")


def as_text(anchors: Column) -> Column:
    return F.array_join(F.transform(anchors, lambda a: F.lpad(F.hex(a.cast("long").bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes of two sets of hashes."""
    common = F.size(F.array_intersect(a, b))
    return F.when(a == b, F.lit(1.0)).otherwise(common / F.greatest(F.size(a) + F.size(b) - common, F.lit(1)))


def _ranges(docs: DataFrame, parts: int) -> Column:
    """A bucket that falls with doc_id: a piecewise linear map between quantiles, so buckets are even."""
    cuts = docs.agg(F.percentile_approx("doc_id", [i / PIECES for i in range(PIECES + 1)])).first()[0] or [0, 0]
    share = F.lit(0.0)
    for i in range(PIECES if len(cuts) > 2 else 0):
        a, b = cuts[i], cuts[i + 1]
        if a < b:
            share = share + F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("doc_id") - F.lit(a)) / F.lit(float(b - a))))
    width = sum(a < b for a, b in zip(cuts, cuts[1:])) or 1
    return F.when(F.col("doc_id").isNull(), F.lit(parts)).otherwise(F.lit(parts - 1) - F.floor(share / width * F.lit(parts - 1)).cast("int"))


def next_rows(docs: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame] | None = None, derived: Sequence[str] = ()) -> DataFrame:
    """``docs`` with ``next_<column>``: the row after it by descending doc_id, then text; the first after the last.

    One shuffle: rows go to buckets that are ranges of doc_id, and the first row of each
    bucket is also sent, as a guest, to the end of the bucket before it. What ``derive`` adds to
    the rows is made after that shuffle, and the next row's ``derived`` columns are taken in the same buckets.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = _ranges(docs, parts)
    inside = docs.withColumn("_bucket", bucket)
    heads = inside.groupBy("_bucket").agg(F.max("doc_id").alias("_head"))
    by_bucket = Window.orderBy("_bucket")  # at most one row per bucket
    guests = heads.select(
        F.col("_bucket").alias("_of"),
        F.coalesce(F.lag("_bucket").over(by_bucket), F.max("_bucket").over(Window.partitionBy())).alias("_to"),
        "_head",
    )
    visiting = (
        inside.join(F.broadcast(guests), (F.col("_bucket") == F.col("_of")) & F.col("doc_id").eqNullSafe(F.col("_head")))
        .withColumn("_bucket", F.col("_to"))
        .select(*docs.columns, "_bucket", F.lit(True).alias("_guest"))
    )
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col("doc_id").desc_nulls_last(), "text")
    rows = inside.withColumn("_guest", F.lit(False)).unionByName(visiting).select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    if derive:
        rows = derive(rows).select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in derived])
    return rows.where("not _guest").drop("_bucket", "_guest")


def fingerprint(docs: DataFrame) -> DataFrame:
    """(doc_id, text, anchors, anchors_at): texts made non-null, with their sketches and all anchors."""
    return with_anchors(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "anchors")


def edited(text: Column, other: Column) -> Column:
    """The last half of ``text`` replaced by as many characters from the start of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))
