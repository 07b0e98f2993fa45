"""Point-in-time joins: for each spine row the newest row of each feature log not after it.

The logs of all views of an entity and the spine are stacked into one timeline, which is
shuffled once on the entity; a slot per view carries the last seen row forward in time order.
That is linear in the rows, where a range join would be quadratic per entity.

One entity may hold a large share of all rows. Such entities are found by a partially
aggregated count, inside the same plan, and go another way that never puts one of them in one
task: repeats of a timestamp collapse first, then the entity's timeline is cut into slices of
about ``hot_rows`` rows, each slice is carried forward on its own, and the last row of every
slice is handed to the slices after it. Both ways give the same rows. Nothing runs while a
join is built: where no entity is hot, the second way gets no rows and Spark drops it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

HOT_ROWS = 20_000_000
#: Slices of an entity at most: the square of this.
SLICE_GRID = 32


@dataclass(frozen=True)
class Log:
    """The feature rows of one view: what ``as_of_joins`` adds to the spine from them.

    Equal timestamps are decided by ``created_ts``, newest wins. With ``ttl`` a row older than
    that gives NULLs, both ends inclusive. ``columns`` maps new names to columns of ``rows``;
    ``matched_ts`` names an extra column for the time of the row found.
    """

    rows: DataFrame
    ts: str
    columns: dict[str, str]
    created_ts: str | None = None
    ttl: timedelta | None = None
    matched_ts: str | None = None

    @property
    def added(self) -> list[str]:
        return [*self.columns, *([self.matched_ts] if self.matched_ts else [])]


def as_of_join(
    spine: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    spine_ts: str,
    feature_ts: str,
    columns: Sequence[str],
    created_ts: str | None = None,
    ttl: timedelta | None = None,
    matched_ts: str | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Spine rows plus ``columns`` of the newest feature row with feature_ts <= spine_ts; see ``as_of_joins``."""
    log = Log(features, feature_ts, {c: c for c in columns}, created_ts, ttl, matched_ts)
    return as_of_joins(spine, [log], keys, spine_ts, hot_rows)


def as_of_joins(spine: DataFrame, logs: Sequence[Log], keys: Sequence[str], spine_ts: str, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Spine rows plus the columns of the newest row of each log not after the row's time.

    A feature's own NULLs stay NULL: the whole row is taken, never an older value. A missing
    key or time matches nothing. ``hot_rows`` is the row count from which an entity is sliced;
    None leaves that way out.
    """
    keys = list(keys)
    added = [c for log in logs for c in log.added]
    clash = set(added) & set(spine.columns) | {c for c in added if added.count(c) > 1}
    if clash:
        raise ValueError(f"already there: {sorted(clash)}")
    names = [f"k{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(n) for k, n in zip(keys, names)]
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])

    def side(log: Log, i: int) -> DataFrame:
        created = F.col(log.created_ts) if log.created_ts else F.lit(None).cast("timestamp_ntz")
        values = [F.col(c).alias(f"v{j}") for j, c in enumerate(log.columns.values())]
        row = F.struct(created.alias("created"), F.col(log.ts).alias("ts"), *values)
        return log.rows.where(F.col(log.ts).isNotNull()).select(*renamed, F.col(log.ts).alias("t"), row.alias(f"f{i}")).where(known)

    sides = [side(log, i) for i, log in enumerate(logs)]
    slots = [f"f{i}" for i in range(len(logs))]
    spine_side = spine.select(*renamed, F.col(spine_ts).alias("t"), F.struct(*spine.columns).alias("s"))
    if hot_rows:
        hot = _hot_entities(spine_side, sides, names, hot_rows)
        only, but = ([lambda df, how=how: df.join(F.broadcast(hot.select(*names)), names, how) for how in ("left_semi", "left_anti")])
        matched = _carry_forward(but(spine_side), [but(f) for f in sides], names, slots)
        matched = matched.unionByName(_carry_in_slices(only(spine_side), [only(f) for f in sides], names, slots, hot, hot_rows))
    else:
        matched = _carry_forward(spine_side, sides, names, slots)
    out = []
    for slot, log in zip(slots, logs):
        fresh = F.col(slot).isNotNull()
        if log.ttl is not None:
            fresh = fresh & (F.col(f"{slot}.ts") >= F.col("t") - F.lit(log.ttl))
        out += [F.when(fresh, F.col(f"{slot}.v{j}")).alias(c) for j, c in enumerate(log.columns)]
        if log.matched_ts:
            out.append(F.when(fresh, F.col(f"{slot}.ts")).alias(log.matched_ts))
    return matched.select("s.*", *out)


def _hot_entities(spine: DataFrame, sides: Sequence[DataFrame], names: Sequence[str], hot_rows: int) -> DataFrame:
    """(names, n) of the entities above ``hot_rows`` rows: at most all rows / ``hot_rows``, so few enough to broadcast."""
    keyed = reduce(DataFrame.unionByName, [df.select(*names) for df in (spine, *sides)])
    for n in names:
        keyed = keyed.where(F.col(n).isNotNull())
    return keyed.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)


def _tagged(sides: Sequence[DataFrame], spine: DataFrame) -> DataFrame:
    """Stack the sides; at equal times features (side 0) come before spine rows (side 1)."""
    stacked = spine.withColumn("side", F.lit(1))
    for f in sides:
        stacked = stacked.unionByName(f.withColumn("side", F.lit(0)), allowMissingColumns=True)
    return stacked


def _carry_forward(spine: DataFrame, sides: Sequence[DataFrame], names: Sequence[str], slots: Sequence[str]) -> DataFrame:
    """Spine rows without a key match nothing and may be many: they are spread by their content."""
    keyless = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names])
    spine = spine.withColumn("spread", F.when(keyless, F.xxhash64("s")).otherwise(F.lit(0)))
    sides = [f.withColumn("spread", F.lit(0).cast("bigint")) for f in sides]
    order = Window.partitionBy(*names, "spread").orderBy("t", "side", *slots).rowsBetween(Window.unboundedPreceding, 0)
    carried = {slot: F.last(slot, ignorenulls=True).over(order) for slot in slots}
    return _tagged(sides, spine).withColumns(carried).where("side = 1").select("s", "t", *slots)


def _slice_number(t: Column, bounds: Column, tops: Column) -> Column:
    """How many of the sorted bounds are at or before t: first by every 32nd, then within that run."""
    row = F.size(F.filter(tops, lambda b: b <= t))
    within = F.size(F.filter(F.slice(bounds, row * SLICE_GRID + 1, SLICE_GRID - 1), lambda b: b <= t))
    return row * SLICE_GRID + within


def _carry_in_slices(
    spine: DataFrame, sides: Sequence[DataFrame], names: Sequence[str], slots: Sequence[str], hot: DataFrame, hot_rows: int
) -> DataFrame:
    newest = [f.groupBy(*names, "t").agg(F.max(slot).alias(slot)) for f, slot in zip(sides, slots)]
    moments = spine.where(F.col("t").isNotNull()).select(*names, "t").distinct()
    line = _tagged(newest, moments)

    # Bounds on a fine grid of quantiles; an entity keeps as many as its rows make slices.
    grid = SLICE_GRID * SLICE_GRID
    cuts = [i / grid for i in range(1, grid)]
    step = F.greatest(F.lit(1), F.floor(F.lit(grid) / F.ceil(F.col("n") / F.lit(hot_rows))).cast("int"))
    every = F.when(F.size("bounds") >= SLICE_GRID, F.sequence(F.lit(SLICE_GRID), F.size("bounds"), F.lit(SLICE_GRID)))
    bounds = (
        line.groupBy(*names)
        .agg(F.percentile_approx("t", cuts, 4 * grid).alias("bounds"))
        .join(F.broadcast(hot), names)
        .withColumn("bounds", F.filter("bounds", lambda b, i: (i + 1) % step == 0))
        .withColumn("tops", F.coalesce(F.transform(every, lambda i: F.element_at("bounds", i)), F.slice("bounds", 1, 0)))
        .select(*names, "bounds", "tops")
    )
    piece = _slice_number(F.col("t"), F.col("bounds"), F.col("tops"))
    # All bounds together are at most twice all rows / ``hot_rows``.
    line = line.join(F.broadcast(bounds), names).withColumn("piece", piece).drop("bounds", "tops")

    before = Window.partitionBy(*names).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    last = {slot: F.max(F.when(F.col(slot).isNotNull(), F.struct("t", slot))).alias(f"last_{slot}") for slot in slots}
    handed = line.groupBy(*names, "piece").agg(*last.values())
    handed = handed.select(*names, "piece", *[F.last(f"last_{slot}", ignorenulls=True).over(before)[slot].alias(f"handed_{slot}") for slot in slots])
    order = Window.partitionBy(*names, "piece").orderBy("t", "side").rowsBetween(Window.unboundedPreceding, 0)
    answers = (
        line.withColumns({f"own_{slot}": F.last(slot, ignorenulls=True).over(order) for slot in slots})
        .where("side = 1")
        .join(handed, [*names, "piece"], "left")
        .select(*names, "t", *[F.coalesce(f"own_{slot}", f"handed_{slot}").alias(slot) for slot in slots])
    )
    return spine.join(answers, [*names, "t"], "left").select("s", "t", *slots)


def latest_per_entity(
    df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str], created_ts: str | None = None
) -> DataFrame:
    """The newest row of each entity by (ts, created), as a partially aggregated maximum.

    The feature columns end the comparison, so full ties still give one fixed row.
    """
    carried = list(dict.fromkeys([ts, *([created_ts] if created_ts else []), *columns]))
    newest = F.max(F.struct(*carried)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"newest.{c}").alias(c) for c in carried])
