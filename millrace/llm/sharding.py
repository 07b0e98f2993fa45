"""Sharding by balanced label propagation.

Documents with equal texts are linked. Every document starts in a shard chosen by its row
number. In each round a linked document wants to go where, of the shards with room, most of its neighbours
are, if that is more than around it; a shard
accepts, in the mean, as many as it has room for (its quota, less what it holds, plus what
leaves it). Small groups are accepted whole, groups above one per cent of a shard row by row,
so a group larger than a shard fills one and goes on in the next. Rounds end when nobody moves or after
``rounds``. At the end what a shard holds above its quota joins the unlinked documents, and this
pool fills the quotas exactly: row counts differ by one at most.

State is one narrow row per linked document; each round is one aggregate over (group, shard),
which collapses a group to at most ``shards`` rows per task, and one join, whose hot keys AQE splits.

Defined results: null and empty texts have size 1 and are groups of their own; repeated rows are
rows of their own; shards that get no row appear nowhere; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.common import number_rows
from millrace.session import cut_lineage, write_through

SHARE = 1 << 20


def _share(*what) -> Column:
    """A number below SHARE drawn from a hash, the same at every retry."""
    return F.pmod(F.xxhash64(*what), F.lit(SHARE))


def quotas(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def _by_shard(values: list[int | float], column: str = "shard") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(column) + 1)


def propagate(linked: DataFrame, capacity: list[int], shards: int, rounds: int) -> DataFrame:
    """(rid, grp, shard) of the linked documents after label propagation."""
    large = max(1, min(capacity) // 100)
    for turn in range(rounds):
        votes = cut_lineage(linked.groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n")))
        now = {r["shard"]: r["n"] for r in votes.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
        free = [s for s in range(shards) if now.get(s, 0) < capacity[s]]
        vote = F.struct("n", F.xxhash64("grp", "shard", F.lit(turn)).alias("tie"), "shard")
        # Cut here, so that the join has a shuffle on either side and its hot groups can be split.
        per = cut_lineage(votes.groupBy("grp").agg(F.collect_list(vote).alias("votes"), F.sum("n").alias("members")))
        own = F.get(F.filter("votes", lambda v: v["shard"] == F.col("shard")), F.lit(0))
        best = F.array_max(F.filter("votes", lambda v: v["shard"].isin(free) if free else F.lit(False)))
        wishes = linked.join(per, "grp").select("rid", "grp", "shard", "members", F.when(best > own, best["shard"]).otherwise(F.col("shard")).alias("target"))
        held = {(r["shard"], r["target"]): r["n"] for r in wishes.groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect()}
        occupied, leaving, coming = [0] * shards, [0] * shards, [0] * shards
        for (a, b), n in held.items():
            occupied[a] += n
            if a != b:
                leaving[a] += n
                coming[b] += n
        if not any(coming):
            break
        accept = [
            int(SHARE * min(1.0, max(0, capacity[s] - occupied[s] + leaving[s]) / coming[s])) if coming[s] else 0
            for s in range(shards)
        ]
        ticket = F.when(F.col("members") > large, _share("rid", F.lit(turn))).otherwise(_share("grp", F.lit(turn)))
        moved = F.when(ticket < _by_shard(accept, "target"), F.col("target")).otherwise(F.col("shard"))
        linked = cut_lineage(wishes.select("rid", "grp", moved.alias("shard")))
    return linked


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): law ``rows``, groups of equal texts kept together."""
    text = F.coalesce("text", F.lit(""))
    base = number_rows(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.coalesce(F.md5("text"), F.lit("null")).alias("grp"),
        ),
        [], ["doc_id", "grp"], "rid", "shard-rows",
    )
    base = write_through(base, "shard-base")
    n = base.count()
    quota = quotas(n, shards)
    sizes = cut_lineage(base.groupBy("grp").agg(F.count(F.lit(1)).alias("members")).where("members > 1"))
    start = base.select("rid", "grp", F.pmod(F.xxhash64("rid"), F.lit(shards)).cast("int").alias("shard"))
    linked = propagate(cut_lineage(start.join(sizes.select("grp"), "grp")), quota, shards, rounds)
    # What a shard holds above its quota comes out of its largest groups.
    ranked = number_rows(
        linked.join(sizes, "grp").select("rid", "grp", "shard", F.col("members").alias("order")),
        ["shard"], ["order", "grp", "rid"], "place", "shard-linked",
    )
    stays = F.col("place") < _by_shard(quota)
    settled = write_through(ranked.select("rid", "grp", F.when(stays, F.col("shard")).alias("shard")), "shard-settled")
    kept = {r["shard"]: r["n"] for r in settled.where("shard is not null").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    pool = number_rows(
        start.select("rid", "grp").join(settled.where("shard is not null").select("rid"), "rid", "left_anti"),
        [], ["grp", "rid"], "place", "shard-pool",
    )
    bounds, free = [], 0
    for s in range(shards):
        free += quota[s] - kept.get(s, 0)
        bounds.append(free)
    filled = F.coalesce(*[F.when(F.col("place") < b, F.lit(s)) for s, b in enumerate(bounds)])
    placed = settled.where("shard is not null").select("rid", "shard").union(pool.select("rid", filled.alias("shard")))
    return number_rows(
        base.join(placed, "rid").select("rid", "doc_id", "size", "text_crc32", "shard"), ["shard"], ["rid"], "slot", "shard-slots"
    ).drop("rid")
