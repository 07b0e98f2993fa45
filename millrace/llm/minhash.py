"""Near duplicates by b-bit MinHash.

Words are runs of non-space bytes with A-Z lower-cased; a document is the set of its distinct
word shingles. Documents with one set form a class, and one of them stands for it, so a group of
copies costs one row from there on. Each class gets ``BANDS * ROWS`` minima; whole minima make
the band keys, and only the lowest ``BITS`` bits of each are kept, packed into longs.

Candidates are never all pairs of a bucket. First every member is paired with the bucket's
smallest. Buckets whose members then still lie in different components go on with 1, then 15,
240, ... pivots, against later members of other components only, until no pair across components is
left that could be alike, judged by the shingles that a class shares with any other. A pair's similarity is first estimated from the packed bits, corrected for
chance collisions; pairs far below the limit (four standard deviations) go, all others are
confirmed on the full sets. A pair at the limit misses every band with probability 5e-8.

Defined results: null, empty and blank texts have no shingles and are linked with nothing;
fewer words than a shingle make one shingle; repeated rows of one doc_id stay as they are; rows of
one doc_id with different texts may be linked on either text (number the rows first where that
can be, as the pipeline does); a null doc_id stays alone with a null component; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import components
from millrace.session import cut_lineage, release, short_lived_shuffles, small_batches, write_through

BANDS, ROWS, BITS = 32, 4, 2
MINIMA = BANDS * ROWS
LONGS = MINIMA * BITS // 64
#: Four standard deviations of the estimate at the usual limit of 0.8.
MARGIN = 0.17
#: Minima of one bit for the classes of open buckets, and four standard deviations of their estimate.
FINE, FINE_MARGIN = 1024, 0.075
REMEMBERED = 200_000
#: Rows handled at a time.
STEP = 512
#: Bits of the filter of wanted documents.
WANTED_BITS = 23


class _Words(dict):
    """64-bit hash of each word met so far."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: dict, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - width + 1)
    out = np.full(n, min(width, len(h)), np.uint64)
    for i in range(min(width, len(h))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out)


def _families() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20)
    return draw.integers(0, 2**63, MINIMA, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, MINIMA, np.uint64)


def signature(s: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, packed low bits) of a shingle set."""
    least = np.full(MINIMA, np.uint64(2**64 - 1))
    for at in range(0, len(s), 256):  # all minima of a few shingles at once: few calls for short texts, bounded memory for long ones
        x = s[at : at + 256, None] * a
        x += b
        x ^= x >> np.uint64(32)
        np.minimum(least, x.min(axis=0), out=least)
    low = _mix(least) & np.uint64(2**BITS - 1)
    per = 64 // BITS
    packed = (low.reshape(LONGS, per) << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64), packed.view(np.int64)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (whole.slice(at, STEP) for whole in batches for at in range(0, len(whole), STEP))


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, key, bands, bits): one row per document; key names its set, null if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (a, b) = _Words(), _families()
        for batch in _steps(batches):
            sizes, keys, bands, bits = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, words, width)
                sizes.append(len(s))
                if not len(s):
                    keys.append(None), bands.append([]), bits.append([])
                    continue
                keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                k, packed = signature(s, a, b)
                bands.append(k), bits.append(packed)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, longs), pa.array(bits, longs)],
                ["doc_id", "n_shingles", "key", "bands", "bits"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n_shingles long, key binary, bands array<long>, bits array<long>")


def _slot(node: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(node), 64 - WANTED_BITS)


def _bit(slot: str) -> Column:
    return F.expr(f"shiftleft(1L, cast({slot} & 63 as int))")


def wanted_bits(nodes: DataFrame) -> np.ndarray:
    """A filter of fixed size (1 MB) that these nodes pass, and few others."""
    slots = nodes.select(_slot("node").alias("slot")).select(F.shiftright("slot", 6).alias("at"), _bit("slot").alias("bits"))
    found = slots.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (WANTED_BITS - 6), np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out


def only_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows (node, ...) of these nodes, and of a few others that pass the filter too: thinned out where they are read.

    The filter is a broadcast row, so texts and sets don't go through Python for it.
    """
    wanted = rows.sparkSession.createDataFrame(pa.table({"wanted": pa.array([wanted_bits(nodes)], pa.list_(pa.int64()))}))
    known = rows.where("node is not null").withColumn("slot", _slot("node"))
    passes = F.get("wanted", F.shiftright("slot", 6).cast("int")).bitwiseAND(_bit("slot")) != 0
    return known.join(F.broadcast(wanted), passes, "left_semi").drop("slot")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in _steps(batches):
            sets = [shingles(t, words, width).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return docs.select("node", "text").mapInArrow(run, "node long, shingles array<long>")


def fine_bits(sets: DataFrame) -> DataFrame:
    """(node, fine): one bit of each of ``FINE`` minima of (node, shingles), for the classes of open buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(21)
        a, b = draw.integers(0, 2**63, FINE, np.uint64) * np.uint64(2) + np.uint64(1), draw.integers(0, 2**63, FINE, np.uint64)
        for batch in _steps(batches):
            out = []
            for s in batch.column("shingles"):
                s = s.values.to_numpy().view(np.uint64)
                least = np.full(FINE, np.uint64(2**64 - 1))
                for at in range(0, len(s), 256):
                    x = s[at : at + 256, None] * a + b
                    least = np.minimum(least, (x ^ (x >> np.uint64(32))).min(axis=0))
                out.append(np.packbits((_mix(least) & np.uint64(1)).astype(bool)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.list_(pa.int64()))], ["node", "fine"])

    return sets.mapInArrow(run, "node long, fine array<long>")


def estimate(a: Column, b: Column, minima: int = MINIMA, bits: int = BITS) -> Column:
    """Similarity from packed low bits: the share of equal lanes, less what chance makes equal."""
    odd = int("01" * 32, 2)
    differ = F.lit(0)
    for i in range(minima * bits // 64):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(odd)) if bits == 2 else x)
    chance = 1.0 / 2**bits
    return (1 - differ / F.lit(float(minima)) - chance) / (1 - chance)


class _Linker:
    """Confirms candidate pairs of classes and keeps the shingle sets fetched so far."""

    def written(self, df: DataFrame, label: str) -> DataFrame:
        out = write_through(df, label)
        self.used.append(out)
        return out

    def __init__(self, docs: DataFrame, reps: DataFrame, width: int, percent: int) -> None:
        self.used: list[DataFrame] = []  # what can go once the components are known
        self.texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
        self.bits = reps.select("node", "bits", F.col("n_shingles").alias("size"))
        self.width, self.percent = width, percent
        self.sets: DataFrame | None = None

    def fetch(self, nodes: DataFrame) -> None:
        """Make the shingle sets of these classes, where not made before."""
        if self.sets is not None:
            nodes = nodes.join(self.sets.select("node"), "node", "left_anti")
        fetched = self.written(shingle_sets(only_nodes(self.texts, nodes), self.width).join(nodes.select("node"), "node", "left_semi"), "minhash-sets")
        self.sets = fetched if self.sets is None else self.sets.union(fetched)

    def own(self, nodes: DataFrame) -> DataFrame:
        """(node, size, own): how many of its shingles no other of these classes has."""
        self.fetch(nodes)
        each = self.sets.join(nodes, "node").select("node", F.size("shingles").alias("size"), F.explode("shingles").alias("shingle"))
        alone = each.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last")).where("node = last").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
        return each.groupBy("node").agg(F.first("size").alias("size")).join(alone, "node", "left").fillna(0, ["own"])

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sizes and packed bits leave a link possible, with their sets fetched."""
        left = self.bits.select(F.col("node").alias("a"), F.col("bits").alias("bits_a"), F.col("size").alias("size_a"))
        right = self.bits.select(F.col("node").alias("b"), F.col("bits").alias("bits_b"), F.col("size").alias("size_b"))
        limit = self.percent / 100
        likely = self.written(
            pairs.join(left, "a")
            .join(right, "b")
            .where((F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * self.percent) & (estimate(F.col("bits_a"), F.col("bits_b")) >= limit - MARGIN))
            .select("a", "b"),
            "minhash-likely",
        )
        self.fetch(likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))).distinct())
        return likely

    def confirm(self, likely: DataFrame) -> DataFrame:
        """The pairs (a, b) that are links; the sets of both must be fetched."""
        likely = self.written(likely.select("a", "b").distinct(), "minhash-pairs")
        held = only_nodes(self.sets, likely.select(F.col("a").alias("node")).union(likely.select(F.col("b").alias("node"))))
        one = held.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
        two = held.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
        shared = F.size(F.array_intersect("set_a", "set_b"))
        return cut_lineage(
            likely.join(one, "a")
            .join(two, "b")
            .where(100 * shared >= self.percent * (F.size("set_a") + F.size("set_b") - shared))
            .select("a", "b")
            .distinct()
        )


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open_buckets(rest: DataFrame, most: int) -> DataFrame:
    """Members of buckets that lie in several components and have places from ``most`` on."""
    more = F.max("place") + 1 if "place" in rest.columns else F.count(F.lit(1))
    per = rest.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), more.alias("n"))
    return rest.join(per.where((F.col("r0") != F.col("r1")) & (F.col("n") > most)).select("bucket"), "bucket")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, growth: int = 16) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Linked: 100 * intersection >= percent * union. component_id is the smallest doc_id
    reachable; kept is true for that document.
    """
    with short_lived_shuffles(docs.sparkSession), small_batches(docs.sparkSession, STEP):
        return _near_duplicates(docs, width, percent, growth)


def _near_duplicates(docs: DataFrame, width: int, percent: int, growth: int) -> DataFrame:
    made = write_through(signatures(docs, width), "minhash-signatures")
    classes = write_through(
        made.where("key is not null and doc_id is not null")
        .groupBy("key")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("bits").alias("bits")),
        "minhash-classes",
    )
    members = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    # Written, so that the joins have a shuffle on either side and their hot buckets can be split.
    stars = write_through(members.groupBy("bucket").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1"), "minhash-stars")
    # Members of buckets of two and more, for all that follows: one shuffle of the band keys.
    shared = write_through(members.join(stars, "bucket"), "minhash-shared")
    pairs = shared.where("node != a").select("a", F.col("node").alias("b")).distinct()
    linker = _Linker(docs, classes, width, percent)
    linker.used += [classes, stars, shared]
    links = linker.confirm(linker.likely(pairs))
    roots = cut_lineage(components(links))

    # Buckets of three and more that are not one component yet. A shingle that no other class
    # left in them has can't be shared, which bounds what a class can have in common with any
    # other: most strays end here. Classes with few such shingles come first as pivots, since
    # they are nearest to what a group was copied from.
    big = shared.where("n > 2").select("bucket", "node", "band")
    rest = linker.written(_open_buckets(_labelled(big, roots), 1), "minhash-rest")
    own = linker.own(rest.select("node").distinct())
    can = F.col("size") - F.col("own")
    rest = rest.join(own, "node").where(100 * can >= percent * F.col("size")).join(fine_bits(linker.sets), "node")
    # Half of each key is enough to see a common bucket; another one looks the same with probability 1e-7.
    halves = classes.select("node", F.transform("bands", lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int")).alias("halves"))
    rest = rest.join(halves, "node").withColumn("earlier", F.slice("halves", 1, F.col("band")))
    order = Window.partitionBy("bucket").orderBy("own", "node")
    rest = linker.written(rest.select("bucket", "node", "root", "size", "fine", "earlier", can.alias("can"), (F.row_number().over(order) - 1).alias("place")), "minhash-rest")
    first, last = 0, 0
    while not rest.isEmpty():
        pivots = rest.where(F.col("place").between(first, last)).select("bucket", *[F.col(c).alias(f"{c}_a") for c in ("node", "root", "size", "fine", "earlier", "can", "place")])
        most = F.least("can", "can_a")
        possible = 100 * most >= percent * (F.col("size") + F.col("size_a") - most)
        alike = estimate(F.col("fine"), F.col("fine_a"), FINE, 1) >= percent / 100 - FINE_MARGIN
        # A pair meets in its first common bucket only. Where that one is not open, the two are in one component or were judged above.
        once = ~F.arrays_overlap("earlier", "earlier_a")
        pairs = pivots.join(rest, "bucket").where((F.col("place") > F.col("place_a")) & (F.col("root") != F.col("root_a")) & possible & alike & once)
        found = linker.confirm(pairs.select(F.col("node_a").alias("a"), F.col("node").alias("b")))
        if not found.isEmpty():
            links = cut_lineage(links.union(found).distinct())
            roots = cut_lineage(components(links))
        rest = linker.written(_open_buckets(_labelled(rest.drop("root"), roots), last + 2), "minhash-rest")
        first, last = last + 1, (last + 1) * growth
    named = write_through(classes.select("key", "node").join(roots, "node", "left").select("key", F.coalesce("root", "node").alias("root")), "minhash-named")
    release(*linker.used)
    return made.select("doc_id", "n_shingles", "key").join(named, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
