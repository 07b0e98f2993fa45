"""Random forest whose deep trees are grown where their rows are.

Values become bins once. Nodes with many rows are split one level a job, from counts that tasks
make of their own rows and Spark sums up. A node with at most ``FINISHED`` rows goes to a task with
its rows and is grown there to its leaves, all open nodes of a level at a time. So neither a node's
counts nor a tree travel more than once, the driver holds the few large nodes only, and the rest
of the model is a table. A row's draws for a tree, and a node's choice of features, follow from seed,
row number, tree and path alone: where a node is finished changes nothing in the model.

Split by weighted Gini gain; a node without gain, with one class or at the greatest depth is a leaf.
A tree votes with the weighted class shares of a row's leaf; votes are summed as whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F

from millrace.operators.metrics import class_weights
from millrace.session import write_through

BINS, MAX_CLASSES = 32, 100
#: Rows (draws) of a node that one task finishes and large nodes split by one job, both with two classes; rows that one task scores by one node.
FINISHED, TOGETHER, SCORED = 8_192, 2_048, 500_000
#: Rows handled at a time.
STEP = 4_096
ONE_VOTE = 2.0**40
_DRAWN = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])

Tree = tuple[np.ndarray, np.ndarray, np.ndarray]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _key(seed: int, tree: int) -> np.ndarray:
    return _mix(np.array([seed * 1_000_003 + tree + 1], np.uint64))


def _draws(ids: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson with mean 1."""
    return np.searchsorted(_DRAWN, (_mix(ids.view(np.uint64) + key) >> np.uint64(11)) * 2.0**-53, side="right").astype(np.uint8)


def _chosen(keys: np.ndarray, features: int, slots: int) -> np.ndarray:
    return np.argsort(_mix(keys[:, None] + _mix(np.arange(1, features + 1, dtype=np.uint64))), axis=1)[:, :slots]


def _children(keys: np.ndarray) -> np.ndarray:
    return _mix(np.repeat(keys, 2) * np.uint64(2) + np.tile(np.array([0, 1], np.uint64), len(keys)))


def _counts(bins: np.ndarray, label: np.ndarray, times: np.ndarray, at: np.ndarray, chosen: np.ndarray, classes: int) -> np.ndarray:
    """Draws per (node, slot, bin, class) of rows that lie in the nodes ``at``."""
    nodes, slots = chosen.shape
    rows, cells = np.arange(len(at)), nodes * BINS * classes
    out = [np.bincount((at * BINS + bins[rows, chosen[at, s]]) * classes + label, times, cells) for s in range(slots)]
    return np.stack(out).reshape(slots, nodes, BINS, classes).swapaxes(0, 1)


def _impure(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted Gini impurity times weight."""
    mass = counts * weights
    size = mass.sum(-1)
    return size - np.divide((mass * mass).sum(-1), size, out=np.zeros_like(size), where=size > 0)


def _splits(counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(slot, cut, whether it gains, draws per class on the left) of the best split of each node."""
    left = counts.cumsum(axis=2)
    total = left[:, :, -1:]
    right = total - left
    gain = _impure(total, weights) - _impure(left, weights) - _impure(right, weights)
    share = gain / np.maximum((total * weights).sum(-1), 1e-300)
    share = np.where((left.sum(-1) > 0) & (right.sum(-1) > 0), share, -np.inf).reshape(len(counts), -1)
    best, every = share.argmax(axis=1), np.arange(len(counts))
    slot, cut = np.divmod(best, BINS)
    return slot, cut, share[every, best] > 1e-12, left[every, slot, cut]


def _route(tree: Tree, bins: np.ndarray) -> np.ndarray:
    feature, cut, left = tree
    node = np.zeros(len(bins), np.int32)
    live = np.arange(len(bins))
    while len(live := live[feature[node[live]] >= 0]):
        at = node[live]
        node[live] = left[at] + (bins[live, feature[at]] > cut[at])
    return node


def grow(bins: np.ndarray, label: np.ndarray, times: np.ndarray, key: np.ndarray, depth: int, slots: int, weights: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The tree below a node from its rows, ``depth`` levels at most, and the class shares of every node."""
    classes = len(weights)
    total = np.bincount(label, times, classes)[None]
    feature, cut, left, seen = ([a] for a in (np.full(1, -1, np.int32), np.zeros(1, np.int32), np.zeros(1, np.int32), total))
    rows, at, keys, size = np.arange(len(bins)), np.zeros(len(bins), np.int64), key, 1
    nodes = np.zeros(1, np.int64)  # of the last level
    while depth > 0:
        # Nodes of the last level that have several classes.
        mixed = (total > 0).sum(1) > 1
        if not mixed.any():
            break
        place = np.where(mixed, mixed.cumsum() - 1, -1)
        inside = place[at] >= 0
        rows, at = rows[inside], place[at[inside]]
        keys, total, nodes = keys[mixed], total[mixed], nodes[mixed]
        chosen = _chosen(keys, bins.shape[1], slots)
        slot, where, gains, low = _splits(_counts(bins[rows], label[rows], times[rows], at, chosen, classes), weights)
        by = chosen[np.arange(len(slot)), slot]
        parts = gains.sum()
        if not parts:
            break
        rank = np.where(gains, gains.cumsum() - 1, -1)
        feature[-1][nodes[gains]], cut[-1][nodes[gains]] = by[gains], where[gains]
        left[-1][nodes[gains]] = size + 2 * np.arange(parts)
        inside = gains[at]
        rows, at = rows[inside], at[inside]
        at = 2 * rank[at] + (bins[rows, by[at]] > where[at])
        total = np.stack([low[gains], total[gains] - low[gains]], axis=1).reshape(-1, classes)
        keys, nodes = _children(keys[gains]), np.arange(2 * parts)
        for parts_of, start in ((feature, -1), (cut, 0), (left, 0)):
            parts_of.append(np.full(2 * parts, start, np.int32))
        seen.append(total)
        size, depth = size + 2 * int(parts), depth - 1
    mass = np.concatenate(seen) * weights
    return (np.concatenate(feature), np.concatenate(cut), np.concatenate(left)), mass / mass.sum(1, keepdims=True)


def fit_cuts(train: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Ascending cuts of each feature, below ``BINS``: between all values where they are few, else at quantiles."""
    numbers = train.select(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    names = numbers.columns
    about = numbers.agg(*[F.approx_count_distinct(c).alias(c) for c in names]).first()
    shares = [i / BINS for i in range(BINS + 1)]
    few = {c for c in names if about[c] <= 2 * BINS}
    found = numbers.agg(*[F.collect_set(c).alias(c) if c in few else F.percentile_approx(c, shares, 10_000).alias(c) for c in names]).first()
    out = []
    for c in names:
        values = np.unique(np.array(found[c] or [], float))
        if c in few and len(values) <= BINS:
            cuts = (values[:-1] + values[1:]) / 2
        else:
            cuts = (np.quantile(values, shares[1:], method="lower") if c in few else values)[:-1]
            cuts = np.unique(cuts)[-(BINS - 1) :]
        out.append(cuts.tolist())
    return out


def _binned(df: DataFrame, features: Sequence[str], cuts: list[list[float]], others: Sequence[str]) -> DataFrame:
    """(others, bins): a byte for each feature. A missing feature is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = [np.array(c) for c in cuts]
        for batch in batches:
            out = np.empty((len(batch), len(edges)), np.uint8)
            for i, edge in enumerate(edges):
                x = batch.column(f"x{i}").to_numpy(zero_copy_only=False)
                if np.isnan(x).any():
                    raise ValueError(f"feature {features[i]} holds a missing value")
                out[:, i] = np.searchsorted(edge, x)
            rows = pa.array([r.tobytes() for r in out], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), rows], [*others, "bins"])

    numbers = df.select(*others, *[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    return numbers.mapInArrow(run, ", ".join(f"{c} long" for c in others) + ", bins binary")


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of at most ``STEP`` rows with their bins as a matrix."""
    for whole in batches:
        for at in range(0, len(whole), STEP):
            batch = whole.slice(at, STEP)
            yield batch, np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(len(batch), -1)


def _by_node(node: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(node, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(node[order])) + 1):
        if len(rows):
            yield int(node[rows[0]]), rows


class _Tops:
    """The large nodes of all trees, and their ends, which tasks go on from."""

    def __init__(self, trees: int, seed: int) -> None:
        self.parts = [[np.array([-1], np.int32), np.zeros(1, np.int32), np.zeros(1, np.int32)] for _ in range(trees)]
        self.keys = [_key(seed, t) for t in range(trees)]
        self.depth = [np.zeros(1, np.int32) for _ in range(trees)]

    def split(self, tree: int, nodes: np.ndarray, features: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Split nodes; returns the first child of each."""
        feature, cut, left = self.parts[tree]
        first = len(feature) + 2 * np.arange(len(nodes))
        feature[nodes], cut[nodes], left[nodes] = features, cuts, first
        more = 2 * len(nodes)
        self.parts[tree] = [np.r_[a, np.full(more, v, np.int32)] for a, v in zip(self.parts[tree], (-1, 0, 0))]
        self.keys[tree] = np.r_[self.keys[tree], _children(self.keys[tree][nodes])]
        self.depth[tree] = np.r_[self.depth[tree], np.repeat(self.depth[tree][nodes] + 1, 2)]
        return first


def _level(rows: DataFrame, tops: _Tops, open_nodes: list[tuple[int, int]], seed: int, slots: int, classes: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """(chosen features, draws per node, slot, bin and class) of large nodes, given by (tree, node) in order."""
    keys = np.array([tops.keys[t][n] for t, n in open_nodes], np.uint64)
    chosen = _chosen(keys, features, slots)
    shape = (len(open_nodes), slots, BINS, classes)
    parts, sizes = tops.parts, [len(p[0]) for p in tops.parts]
    of: dict[int, list[int]] = {}
    for i, (t, _) in enumerate(open_nodes):
        of.setdefault(t, []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)
        for batch, bins in _steps(batches):
            ids, label = (batch.column(c).to_numpy() for c in ("id", "label"))
            for t, places in of.items():
                index = np.full(sizes[t], -1)
                index[[open_nodes[i][1] for i in places]] = np.arange(len(places))
                times, at = _draws(ids, _key(seed, t)), index[_route(tuple(parts[t]), bins)]
                mine = np.flatnonzero((at >= 0) & (times > 0))
                a, b = places[0], places[-1] + 1
                total[a:b] += _counts(bins[mine], label[mine], times[mine], at[mine], chosen[a:b], classes).astype(np.int64)
        cells = np.flatnonzero(total)
        yield pa.record_batch({"cell": cells.astype(np.int64), "n": total.ravel()[cells]})

    found = rows.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(shape, np.int64)
    out.ravel()[found["cell"].to_numpy()] = found["n"].to_numpy()
    return chosen, out


def _grow_tops(rows: DataFrame, n: int, trees: int, seed: int, depth: int, slots: int, features: int, weights: np.ndarray) -> _Tops:
    tops = _Tops(trees, seed)
    # More classes make larger counts of a node.
    finished, together = (2 * most // max(2, len(weights)) for most in (FINISHED, TOGETHER))
    todo = [(t, 0) for t in range(trees)] if n > finished and depth > 0 else []
    while todo:
        after = []
        for at in range(0, len(todo), together):
            block = todo[at : at + together]
            chosen, counts = _level(rows, tops, block, seed, slots, len(weights), features)
            slot, cut, gains, low = _splits(counts.astype(float), weights)
            total = counts[:, 0].sum(axis=1)
            by = chosen[np.arange(len(slot)), slot]
            of = np.array([t for t, _ in block])
            for t in dict.fromkeys(of.tolist()):
                mine = np.flatnonzero((of == t) & gains)
                nodes = np.array([block[i][1] for i in mine], np.int64)
                for i, first in zip(mine, tops.split(t, nodes, by[mine], cut[mine]).tolist()):
                    for child, seen in ((first, low[i]), (first + 1, total[i] - low[i])):
                        if seen.sum() > finished and (seen > 0).sum() > 1 and tops.depth[t][child] < depth:
                            after.append((t, child))
        todo = after
    return tops


def fit(train: DataFrame, label: str, features: Sequence[str], trees: int, depth: int, seed: int) -> ForestModel:
    """A forest with balanced class weights, square root of the features per split."""
    features, known = list(features), train.where(F.col(label).isNotNull())
    # Read once more for each level, so written; rows are spread evenly, whatever the cores.
    sizes = {int(r["label"]): (r["n"], r["weight"]) for r in class_weights(known, label).limit(MAX_CLASSES + 1).collect()}
    n, classes = sum(c for c, _ in sizes.values()), max(sizes, default=-1) + 1
    if not n or len(sizes) > MAX_CLASSES or classes > MAX_CLASSES or min(sizes) < 0:
        raise ValueError(f"a forest needs rows, and labels from 0 to {MAX_CLASSES - 1}")
    weights = np.array([sizes.get(c, (0, 0.0))[1] for c in range(classes)])
    cuts = fit_cuts(known, features)
    spread = known.select(*[F.col(f"`{f}`") for f in features], F.col(label).cast("long").alias("label"))
    spread = spread.repartition(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))).withColumn("id", F.monotonically_increasing_id())
    rows = write_through(_binned(spread, features, cuts, ["id", "label"]), "forest-rows")
    slots, width = math.ceil(math.sqrt(len(features))), len(features)
    tops = _grow_tops(rows, n, trees, seed, depth, slots, width, weights)
    parts, keys, depths = tops.parts, tops.keys, tops.depth

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bins in _steps(batches):
            ids, labels = (batch.column(c).to_numpy() for c in ("id", "label"))
            for t in range(trees):
                times = _draws(ids, _key(seed, t))
                mine = np.flatnonzero(times)
                cells = np.column_stack([bins[mine], labels[mine].astype(np.uint8), times[mine]])
                found = [(node, cells[at].tobytes()) for node, at in _by_node(_route(tuple(parts[t]), bins[mine]))]
                yield pa.record_batch({
                    "tree": np.full(len(found), t, np.int32), "node": np.array([f[0] for f in found], np.int32), "cells": pa.array([f[1] for f in found], pa.binary()),
                })

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        t, node = (k.as_py() for k in key)
        cells = np.frombuffer(b"".join(table["cells"].to_pylist()), np.uint8).reshape(-1, width + 2)
        below = (cells[:, :width], cells[:, width].astype(np.int64), cells[:, width + 1])
        (feature, cut, left), shares = grow(*below, keys[t][node : node + 1], depth - int(depths[t][node]), slots, weights)
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([node], pa.int32()), "feature": [feature], "cut": [cut], "left": [left], "shares": [shares.ravel()]})

    dealt = rows.mapInArrow(deal, "tree int, node int, cells binary")
    schema = "tree int, node int, feature array<int>, cut array<int>, left array<int>, shares array<double>"
    ends = write_through(dealt.groupBy("tree", "node").applyInArrow(finish, schema), "forest-ends")
    return ForestModel(features, cuts, classes, [tuple(p) for p in parts], ends)


class ForestModel(Model, MLWritable, MLReadable):
    """Adds ``probability`` (by class) and ``prediction``."""

    def __init__(self, features: Sequence[str], cuts: list[list[float]], classes: int, tops: list[Tree], ends: DataFrame) -> None:
        super().__init__()
        self.features, self.cuts, self.classes, self.tops, self.ends = list(features), cuts, classes, tops, ends

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = write_through(dataset.withColumn("_row", F.monotonically_increasing_id()), "forest-scored")
        tops, classes, parts = self.tops, self.classes, max(1, math.ceil(rows.count() / SCORED))

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for i, (batch, bins) in enumerate(_steps(batches), TaskContext.get().partitionId()):
                ids = batch.column("_row").to_numpy()
                for t, top in enumerate(tops):
                    found = [(node, ids[at].tobytes(), bins[at].tobytes()) for node, at in _by_node(_route(top, bins))]
                    yield pa.record_batch({
                        "tree": np.full(len(found), t, np.int32), "node": np.array([f[0] for f in found], np.int32), "part": np.full(len(found), i % parts, np.int32),
                        "rows": pa.array([f[1] for f in found], pa.binary()), "bins": pa.array([f[2] for f in found], pa.binary()),
                    })

        names = [f"vote{c}" for c in range(classes)]

        def vote(cells: pa.Table, ends: pa.Table) -> pa.Table:
            ids = np.frombuffer(b"".join(cells["rows"].to_pylist()), np.int64)
            if not len(ids) or not len(ends):
                return pa.table({c: pa.array([], pa.int64()) for c in ("_row", *names)})
            bins = np.frombuffer(b"".join(cells["bins"].to_pylist()), np.uint8).reshape(len(ids), -1)
            feature, cut, left, shares = (ends[c][0].values.to_numpy() for c in ("feature", "cut", "left", "shares"))
            votes = np.rint(shares.reshape(-1, classes)[_route((feature, cut, left), bins)] * ONE_VOTE).astype(np.int64)
            return pa.table({"_row": ids} | {c: votes[:, i] for i, c in enumerate(names)})

        dealt = _binned(rows, self.features, self.cuts, ["_row"]).mapInArrow(deal, "tree int, node int, part int, rows binary, bins binary")
        ends = self.ends.join(self.ends.sparkSession.range(parts).select(F.col("id").cast("int").alias("part")))
        by = ["tree", "node", "part"]
        votes = dealt.groupBy(*by).cogroup(ends.groupBy(*by)).applyInArrow(vote, "_row long, " + ", ".join(f"{c} long" for c in names))
        total = votes.groupBy(F.col("_row").alias("_voted")).agg(*[F.sum(c).alias(c) for c in names])
        seen = F.array(*[F.coalesce(c, F.lit(0)) for c in names])
        whole = F.greatest(F.lit(1), sum((F.coalesce(c, F.lit(0)) for c in names), F.lit(0)))
        share = F.transform(seen, lambda v: v / whole)
        return rows.join(total, F.col("_row") == F.col("_voted"), "left").select(
            *[F.col(f"`{c}`") for c in dataset.columns],
            array_to_vector(share).alias("probability"),
            (F.array_position(seen, F.array_max(seen)) - 1).cast("double").alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.model.ends.sparkSession
        more = {"features": model.features, "cuts": model.cuts, "classes": model.classes}
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata=more)
        tops = [(t, *(a.tolist() for a in tree)) for t, tree in enumerate(model.tops)]
        spark.createDataFrame(tops, "tree int, feature array<int>, cut array<int>, left array<int>").write.parquet(f"{path}/tops")
        model.ends.write.parquet(f"{path}/ends")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = self.sparkSession
        facts = DefaultParamsReader.loadMetadata(path, spark)
        tops = [tuple(np.array(a, np.int32) for a in r[1:]) for r in spark.read.parquet(f"{path}/tops").orderBy("tree").collect()]
        model = ForestModel(facts["features"], facts["cuts"], facts["classes"], tops, spark.read.parquet(f"{path}/ends"))
        model._resetUid(facts["uid"])
        return model
