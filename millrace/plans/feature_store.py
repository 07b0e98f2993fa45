"""Feature definitions as Python objects; every retrieval is a lazy DataFrame plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from millrace.functions.scalars import ensure_text, moment
from millrace.operators.asof import HOT_ROWS, Log, as_of_joins, latest_per_entity
from millrace.operators.schema import require
from millrace.sources.versions import LevelledTable


@dataclass(frozen=True)
class Entity:
    name: str
    join_keys: tuple[str, ...]
    dtype: T.DataType = T.StringType()
    description: str = ""


@dataclass(frozen=True)
class Feature:
    name: str
    dtype: T.DataType
    description: str = ""


@dataclass(frozen=True)
class FeatureSource:
    """A table with an event time: a DataFrame, a catalog table or a SQL text."""

    name: str
    timestamp: str
    df: DataFrame | None = None
    table: str | None = None
    query: str | None = None
    created: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        if self.df is not None:
            return self.df
        return spark.sql(self.query) if self.query else spark.table(self.table)


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: Entity
    features: tuple[Feature, ...]
    source: FeatureSource
    ttl: timedelta | None = None
    tags: Mapping[str, str] = field(default_factory=dict)
    online: bool = True
    version: str = "v1"

    def __getitem__(self, names: Sequence[str]) -> "FeatureView":
        """Sub-selection: ``view[["a", "b"]]``."""
        known = {f.name: f for f in self.features}
        unknown = [n for n in names if n not in known]
        if unknown:
            raise KeyError(f"{self.name} has no {unknown}")
        return replace(self, features=tuple(known[n] for n in names))

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    def over(self, source: FeatureSource, name: str | None = None) -> "FeatureView":
        """The same fields over another source, e.g. a push log instead of the batch table."""
        return replace(self, source=source, name=name or self.name)

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dtype) for f in self.features])

    def typed(self, names: Sequence[str]) -> list[Column]:
        """These features as their declared types; a value that does not fit is an error."""
        declared = {f.name: f.dtype for f in self.features}
        return [F.col(n).cast(declared[n]).alias(n) if n in declared else F.col(n) for n in names]


@dataclass(frozen=True)
class RequestSource:
    """Columns that arrive with the query."""

    name: str
    schema: T.StructType


@dataclass(frozen=True)
class PushSource:
    """A name for rows that are pushed at run time, and the batch table behind them."""

    name: str
    batch: FeatureSource


@dataclass(frozen=True)
class OnDemandView:
    """Features computed per row from stored and request columns, as Column expressions.

    ``batches`` may instead give a function over Arrow batches for code that cannot be
    written as expressions; it sees one batch at a time and must keep the row count.
    """

    name: str
    sources: tuple[FeatureView | RequestSource, ...]
    features: tuple[Feature, ...]
    expressions: Mapping[str, Column] | None = None
    batches: Callable | None = None

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.features]

    def apply(self, df: DataFrame) -> DataFrame:
        for s in self.sources:
            if isinstance(s, RequestSource):
                require(df, s.schema.names)
        if self.batches is None:
            return df.withColumns({f.name: self.expressions[f.name].cast(f.dtype) for f in self.features})
        out = T.StructType([*df.schema.fields, *[T.StructField(f.name, f.dtype) for f in self.features]])
        # Only these go to the executors, not the view, which holds DataFrames.
        compute, added_names, all_names = self.batches, self.names, out.names

        def run(frames):
            for pdf in frames:
                added = compute(pdf)
                yield pdf.assign(**{n: added[n] for n in added_names})[all_names]

        return df.mapInPandas(run, out)


@dataclass(frozen=True)
class FeatureService:
    name: str
    views: tuple[FeatureView | OnDemandView, ...]
    description: str = ""


def feature_list(
    views: Sequence[FeatureView | OnDemandView], references: Sequence[str]
) -> tuple[FeatureView | OnDemandView, ...]:
    """Turn ``view:feature`` references into narrowed views, in the order first named."""
    by_name = {v.name: v for v in views}
    wanted: dict[str, list[str]] = {}
    for ref in references:
        view, _, name = ref.partition(":")
        if view not in by_name or name not in by_name[view].names:
            raise KeyError(f"unknown feature {ref}")
        wanted.setdefault(view, []).append(name)
    out = []
    for view, names in wanted.items():
        v = by_name[view]
        if isinstance(v, FeatureView):
            out.append(v[names])
        else:
            out.append(replace(v, features=tuple(f for f in v.features if f.name in names)))
    return tuple(out)


def _stored_inputs(views) -> list[tuple[FeatureView, list[str]]]:
    """Per stored view the columns to fetch: its own and what on-demand views need of it."""
    order: list[FeatureView] = []
    needed: dict[str, list[str]] = {}

    def add(view: FeatureView) -> None:
        if view.name not in needed:
            order.append(view)
            needed[view.name] = []
        needed[view.name] += [n for n in view.names if n not in needed[view.name]]

    for v in views:
        if isinstance(v, FeatureView):
            add(v)
        else:
            for s in v.sources:
                if isinstance(s, FeatureView):
                    add(s)
    return [(v, needed[v.name]) for v in order]


def _finish(df: DataFrame, base: Sequence[str], views) -> DataFrame:
    for v in views:
        if isinstance(v, OnDemandView):
            df = v.apply(df)
    wanted = [n for v in views for n in v.names]
    return df.select(*base, *dict.fromkeys(wanted))


def historical_features(
    spine: DataFrame,
    views: Sequence[FeatureView | OnDemandView] | FeatureService,
    ts: str = "event_timestamp",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Training set: spine rows with the feature values known at each row's time, in their declared types.

    All views of one entity are joined by one shuffle of spine and logs. Building it runs nothing.
    """
    chosen = views.views if isinstance(views, FeatureService) else tuple(views)
    by_entity: dict[tuple[str, ...], list[Log]] = {}
    for view, columns in _stored_inputs(chosen):
        source = view.source
        keys = view.entity.join_keys
        carried = dict.fromkeys([*keys, source.timestamp, *([source.created] if source.created else [])])
        rows = source.read(spine.sparkSession).select(*carried, *view.typed([c for c in columns if c not in carried]))
        by_entity.setdefault(keys, []).append(Log(rows, source.timestamp, {c: c for c in columns}, source.created, view.ttl))
    out = spine
    for keys, logs in by_entity.items():
        out = as_of_joins(out, logs, keys, ts, hot_rows)
    return _finish(out, spine.columns, chosen)


def batch_scoring(
    entities: DataFrame,
    views: Sequence[FeatureView | OnDemandView] | FeatureService,
    at: datetime | None = None,
    ts: str = "event_timestamp",
) -> DataFrame:
    """The same retrieval with one time for all rows: ``at``, or now.

    With one time for all there is nothing to carry forward: each entity needs its newest
    row not after that time, which is a partially aggregated maximum and a join.
    """
    chosen = views.views if isinstance(views, FeatureService) else tuple(views)
    now = moment(at) if at is not None else F.current_timestamp().cast("timestamp_ntz")
    spine = entities.withColumn(ts, now)
    out = spine
    for view, columns in _stored_inputs(chosen):
        source, keys = view.source, list(view.entity.join_keys)
        known = source.read(entities.sparkSession).where(F.col(source.timestamp) <= now)
        if view.ttl is not None:
            known = known.where(F.col(source.timestamp) >= now - F.lit(view.ttl))
        newest = latest_per_entity(known, keys, source.timestamp, columns, source.created)
        out = out.join(newest.select(*keys, *view.typed(columns)), keys, "left")
    return _finish(out, spine.columns, chosen)


def materialize_increment(
    view: FeatureView,
    log: DataFrame,
    start: datetime | None,
    end: datetime,
    online: DataFrame | None = None,
) -> DataFrame:
    """The online table after taking in the rows of (start, end].

    Old table and new rows go through one aggregate, newest per entity wins, so an older
    event can never replace a newer one and materializing in steps equals doing it at once.
    """
    source, keys = view.source, list(view.entity.join_keys)
    carried = [source.timestamp, *([source.created] if source.created else []), *view.names]
    window = F.col(source.timestamp) <= moment(end)
    if start is not None:
        window = window & (F.col(source.timestamp) > moment(start))
    fresh = log.where(window).select(*keys, *carried)
    if online is not None:
        fresh = online.select(*keys, *carried).unionByName(fresh)
    return latest_per_entity(fresh, keys, source.timestamp, view.names, source.created)


def online_table(spark: SparkSession, view: FeatureView, root: str, fan: int = 4) -> LevelledTable:
    """The stored online table of a view: newest row per entity, in versions."""
    source, keys = view.source, list(view.entity.join_keys)
    return LevelledTable(spark, root, lambda rows: latest_per_entity(rows, keys, source.timestamp, view.names, source.created), fan)


def materialize(view: FeatureView, log: DataFrame, root: str, end: datetime, start: datetime | None = None) -> DataFrame:
    """Bring the stored online table up to ``end`` and return it.

    It goes on from the end that the newest version remembers; ``start`` only counts the first
    time. Rows and the new end are published as one version, so a run that dies has done
    nothing, and a repeated or earlier end changes nothing. Only the rows of the interval are
    read and written; see ``LevelledTable`` for how they are merged.
    """
    table = online_table(log.sparkSession, view, root)
    newest = table.log.newest()
    begin = datetime.fromisoformat(newest["end"]) if newest else start
    if begin is None or begin < end:
        fresh = materialize_increment(view, log, begin, end)
        newest = table.publish_after(newest, fresh, start=begin.isoformat() if begin else None, end=end.isoformat())
    elif newest is None:
        raise ValueError(f"nothing to take in between {begin} and {end}")
    return table.read(newest)


def online_lookup(
    requests: DataFrame,
    online: DataFrame,
    views: Sequence[FeatureView | OnDemandView] | FeatureService,
) -> DataFrame:
    """Online values for request rows; unknown entities keep their row, with NULLs.

    A semi join first leaves the online rows of the requested entities, so a short list
    (Spark measures it) is broadcast to where the table is read.
    """
    chosen = views.views if isinstance(views, FeatureService) else tuple(views)
    out = requests
    for view, columns in _stored_inputs(chosen):
        keys = list(view.entity.join_keys)
        asked = requests.select(*keys).distinct()
        stored = online.select(*keys, *view.typed(columns)).join(asked, keys, "left_semi")
        out = out.join(stored, keys, "left")
    return _finish(out, requests.columns, chosen)


def feature_metadata(spark: SparkSession, views: Sequence[FeatureView]) -> DataFrame:
    """One row per feature: definition and a profile of the stored values from one pass per view."""
    parts = []
    for v in views:
        log = v.source.read(spark)
        rows = F.col("rows")
        aggregates = [F.count(F.lit(1)).alias("rows"), F.max(v.source.timestamp).alias("newest")]
        for f in v.features:
            aggregates += [
                F.count(f.name).alias(f"n_{f.name}"),
                F.min(f.name).cast("string").alias(f"lo_{f.name}"),
                F.max(f.name).cast("string").alias(f"hi_{f.name}"),
            ]
        cells = [
            F.struct(
                F.lit(v.name).alias("view"),
                F.lit(f.name).alias("feature"),
                F.lit(f.dtype.simpleString()).alias("data_type"),
                ensure_text(F.lit(f.description)).alias("description"),
                F.lit(v.source.name).alias("source"),
                F.lit(v.version).alias("version"),
                rows.alias("n_rows"),
                F.try_divide(rows - F.col(f"n_{f.name}"), rows).alias("null_share"),
                F.col(f"lo_{f.name}").alias("min_value"),
                F.col(f"hi_{f.name}").alias("max_value"),
                F.col("newest").alias("newest_event"),
            )
            for f in v.features
        ]
        parts.append(log.agg(*aggregates).select(F.inline(F.array(*cells))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def metadata_document(metadata: DataFrame) -> DataFrame:
    """The listing as JSON text, one document per view. Features per view are few by definition."""
    entry = F.struct(F.col("feature").alias("name"), "data_type", "description", "source", "version", "n_rows")
    return metadata.groupBy("view").agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("features"))
