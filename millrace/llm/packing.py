"""Best-fit packing with conflicts.

Documents are cut into pieces of at most ``capacity`` words and packed into bins. A bin holds at
most one piece of each source and of each duplicate cluster: it carries both as bitmaps. Bins are
ordered by the room they have left; for a piece, a search starts at the least room that takes it
and goes on to the next bin until one is compatible, which is the tightest that is. Pieces come
largest first. A piece that fits nowhere opens a bin.

A label (source or cluster) with many pieces would make that search step over most bins, so each
such label has an order of its own, of the bins that lack it. Pieces are dealt by hash to groups of
about ``GROUP`` that are packed on their own; a bin never spans groups, so both conflicts hold
everywhere, and one source or cluster of any size is spread over all groups.

Defined results: null and empty texts are one piece of size 1 with no words; a null source or
cluster conflicts with nothing; repeated rows are pieces of their own; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

GROUP = 8192
#: Labels with more pieces than this in a group have an order of their own.
COMMON = 64


class _Order:
    """Bins by room: a bit per room that some bin has, and the bins of each room."""

    def __init__(self) -> None:
        self.rooms = 0
        self.bins: dict[int, set[int]] = {}

    def add(self, room: int, b: int) -> None:
        self.rooms |= 1 << room
        self.bins.setdefault(room, set()).add(b)

    def drop(self, room: int, b: int) -> None:
        found = self.bins[room]
        found.discard(b)
        if not found:
            del self.bins[room]
            self.rooms ^= 1 << room

    def tightest(self, need: int, fits) -> int | None:
        """The bin with least room >= need that fits, the smallest number of equals."""
        left = self.rooms >> need
        while left:
            step = (left & -left).bit_length() - 1
            need += step
            b = min((b for b in self.bins[need] if fits(b)), default=None)
            if b is not None:
                return b
            left >>= step + 1
            need += 1
        return None


def pack_group(items: Iterable[tuple[int, object, object]], capacity: int) -> list[tuple[int, int]]:
    """(bin, place) of each item (size, source, cluster), in the given order."""
    items = list(items)
    bit: dict = {}
    masks, common = [], []
    counts = Counter(x for _, s, c in items for x in (("s", s), ("c", c)) if x[1] is not None)
    for _, s, c in items:
        labels = [x for x in (("s", s), ("c", c)) if x[1] is not None]
        masks.append(sum(1 << bit.setdefault(x, len(bit)) for x in labels))
        common.append(max(((counts[x], x) for x in labels if counts[x] > COMMON), default=(0, None))[1])
    orders = {None: _Order()} | {x: _Order() for x, n in counts.items() if n > COMMON}
    room, held, filled, out = [], [], [], []
    for (size, _, _), mask, label in zip(items, masks, common):
        b = orders[label].tightest(size, lambda b: not held[b] & mask)
        if b is None:
            b = len(room)
            room.append(capacity), held.append(0), filled.append(0)
        else:
            for x, order in orders.items():
                if x is None or not held[b] >> bit[x] & 1:
                    order.drop(room[b], b)
        out.append((b, filled[b]))
        room[b] -= size
        held[b] |= mask
        filled[b] += 1
        if room[b]:
            for x, order in orders.items():
                if x is None or not held[b] >> bit[x] & 1:
                    order.add(room[b], b)
    return out


def pieces(docs: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, source, cluster, piece, start, n_words): cluster is the same for texts of equal words."""
    words = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"\s+", " "))
    cut = docs.select("doc_id", "source", words.alias("w")).select(
        "doc_id", "source", F.xxhash64("w").alias("cluster"),
        F.when(F.col("w") == "", 0).otherwise(F.length("w") - F.length(F.replace("w", F.lit(" "), F.lit(""))) + 1).alias("words"),
    )
    return cut.select("*", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("words") / capacity).cast("int") - 1, F.lit(0)))).alias("piece")).select(
        "doc_id", "source", "cluster", "piece", (F.col("piece") * capacity).alias("start"),
        F.least(F.col("words") - F.col("piece") * capacity, F.lit(capacity)).alias("n_words"),
    )


def pack_documents(docs: DataFrame, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, start, n_words, source, cluster, bin, place): every piece of every document in its bin."""
    cut = pieces(docs, capacity)
    groups = max(1, -(-cut.count() // GROUP))
    dealt = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(groups)))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.assign(size=part["n_words"].clip(lower=1)).sort_values(["size", "doc_id", "piece", "cluster"], ascending=[False, True, True, True], kind="stable")
        source = part["source"].astype(object).where(part["source"].notna(), None)
        found = pack_group(zip(part["size"], source, part["cluster"]), capacity)
        part["bin"] = [g * 2**24 + b for g, (b, _) in zip(part["grp"], found)]
        part["place"] = [p for _, p in found]
        return part[["doc_id", "piece", "start", "n_words", "source", "cluster", "bin", "place"]]

    return dealt.groupBy("grp").applyInPandas(
        run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start int, n_words int, source string, cluster long, bin long, place int"
    )
