"""Repeated passages by collinear chaining of shared word seeds.

Seeds are the runs of ``K`` words with the smallest hash of any ``WINDOW`` consecutive runs, so
every exact stretch of K + WINDOW - 1 words has one. A document is matched at each seed with the
first place of the first document that has it and with the last place of the document before it
that has it, so a passage in n documents makes at most 2 n matches. Matches of a document with
one owner are chained: in order in both, with a cost per word of gap, by a Fenwick tree over owner
positions that holds the best chain end so far; a match alone is a chain too. Chains are aligned
word by word: between seeds, and outwards from both ends while it pays, with more text each time
the end of what was read is reached. One match thus suffices for a passage of any length whose
words stay in step, whoever owns its other seeds. Stretches whose words
agree to ``ALIKE`` are pieces; pieces that touch in a document form a passage, also when their
owners differ, and passages of at least ``min_words`` words count.

Words are runs of non-space bytes with A-Z lower-cased; positions count words.

Defined results: null, empty and short texts hold no passage; repeats inside one document are not
looked for; rows with one doc_id (equal copies) are one document, and a null doc_id takes no part;
other columns are ignored when searching and kept when cutting.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.minhash import _mix
from millrace.session import release, short_lived_shuffles, small_batches, write_through

K, WINDOW = 5, 4
GAP = 0.1
MAX_GAP, MARGIN = 30, 64
MIN_WORDS, MIN_PIECE, ALIKE = 50, 20, 0.8
#: Parts of the owners that are aligned one after another.
PARTS = 3
#: Words handled at a time; bytes of text whose seeds make a bucket; seeds of a bucket that a task holds.
STEP, BUCKET, HELD = 1 << 17, 1 << 20, 1 << 22
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_hashes(text: str | None) -> np.ndarray:
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, found)), ">u8").astype(np.uint64)


def seeds_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the seeds of a word sequence."""
    n = len(h) - K + 1
    runs = np.zeros(n, np.uint64)
    for i in range(K):
        runs = _mix(runs * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    seen = np.lib.stride_tricks.sliding_window_view(runs, min(WINDOW, n))
    at = np.unique(seen.argmin(axis=1) + np.arange(len(seen)))
    return runs[at].view(np.int64), at.astype(np.int32)


def _seeds_of_all(hashes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, index of the sequence) of the seeds of several word sequences, as ``seeds_of`` finds them one by one."""
    if min(map(len, hashes)) < K + WINDOW - 1:
        each = [seeds_of(h) for h in hashes]
        return *(np.concatenate(c) for c in zip(*each)), np.repeat(np.arange(len(each)), [len(c[0]) for c in each])
    h = np.concatenate(hashes)
    sizes = np.array([len(x) for x in hashes])
    starts = np.cumsum(sizes) - sizes
    runs = np.zeros(len(h) - K + 1, np.uint64)
    for i in range(K):
        runs = _mix(runs * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(runs)])
    n = len(runs) - WINDOW + 1
    best, at = runs[:n].copy(), np.arange(n)
    for j in range(1, WINDOW):
        better = runs[j : j + n] < best
        best[better] = runs[j : j + n][better]
        at[better] = np.flatnonzero(better) + j
    of = np.repeat(np.arange(len(sizes)), sizes)[:n]
    inside = np.arange(n) - starts[of] <= sizes[of] - K - WINDOW + 1
    at, of = at[inside], of[inside]
    new = np.r_[True, np.diff(at) != 0]  # the smallest run never moves back
    at, of = at[new], of[new]
    return runs[at].view(np.int64), (at - starts[of]).astype(np.int32), of


def _lists(values: list[np.ndarray], sizes: np.ndarray) -> list[pa.Array]:
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in values]


def _dealt(key: np.ndarray, columns: list[np.ndarray], buckets: int) -> tuple[np.ndarray, list[pa.Array]]:
    """The buckets of ``key`` that have rows, and for each column the lists of its values there."""
    bucket = (_mix(key.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = np.flatnonzero(np.r_[True, np.diff(bucket) != 0]) if len(bucket) else np.empty(0, np.int64)
    return bucket[at], _lists([c[order] for c in columns], np.diff(np.r_[at, len(bucket)]))


def _buckets(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], limit: int | None = None) -> Iterator[tuple[bool, list[np.ndarray]]]:
    """(whole, columns) of each bucket of rows that come bucket by bucket; from ``limit`` values on, before the bucket's end too."""
    held, of, size = [], None, 0
    for batch in batches:
        bucket = batch.column("bucket").to_numpy()
        cut = np.flatnonzero(np.r_[True, np.diff(bucket) != 0]) if len(bucket) else []
        for a, b in zip(cut, [*cut[1:], len(bucket)]):
            if held and bucket[a] != of:
                yield True, [np.concatenate(c) for c in zip(*held)]
                held, size = [], 0
            of = bucket[a]
            held.append([batch.column(c).slice(a, b - a).flatten().to_numpy() for c in names])
            size += len(held[-1][0])
            if limit and size >= limit:
                rest = yield False, [np.concatenate(c) for c in zip(*held)]
                held = [rest]
                size = len(rest[0])
                yield False, []
    if held:
        yield True, [np.concatenate(c) for c in zip(*held)]


def seeds(docs: DataFrame, min_words: int, buckets: int) -> DataFrame:
    """(bucket, seed, doc, pos): the seeds of every document long enough to hold a passage, in lists by buckets of the seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: list[int], hashes: list[np.ndarray]) -> pa.RecordBatch:
            seed, pos, of = _seeds_of_all(hashes)
            bucket, lists = _dealt(seed, [seed, np.array(ids, np.int64)[of], pos], buckets)
            return pa.RecordBatch.from_arrays([pa.array(bucket), *lists], ["bucket", "seed", "doc", "pos"])

        ids, hashes, size = [], [], 0
        for batch in batches:
            texts = batch.column("text")
            for i, doc in enumerate(batch.column("doc").to_pylist()):
                h = word_hashes(texts[i].as_py())
                if len(h) >= max(min_words, K):
                    ids.append(doc), hashes.append(h)
                    size += len(h)
                if size >= STEP:
                    yield made(ids, hashes)
                    ids, hashes, size = [], [], 0
        if ids:
            yield made(ids, hashes)

    return _texts(docs).mapInArrow(run, "bucket int, seed array<long>, doc array<long>, pos array<int>")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc"), "text")


def words_of(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc, words) of every document long enough to hold a passage: 32 bits for each word, one row a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, out = batch.column("text"), []
            for i, doc in enumerate(batch.column("doc").to_pylist()):
                h = word_hashes(texts[i].as_py())
                if len(h) >= min_words:
                    out.append((doc, (h >> np.uint64(32)).astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.binary())], ["doc", "words"])

    return _texts(docs).mapInArrow(run, "doc long, words binary").dropDuplicates(["doc"])


def matched(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
    """doc, owner, pos, owner_pos of all matches among these seeds, if every place of each is there."""
    order = np.argsort(seed)
    same = np.diff(seed[order]) == 0
    order = order[np.r_[False, same] | np.r_[same, False]] if len(seed) else order  # only seeds that come again
    seed, doc, pos = seed[order], doc[order], pos[order]
    order = np.lexsort((pos, doc, seed))
    seed, doc, pos = seed[order], doc[order], pos[order]
    if not len(seed):
        return [doc, doc, pos, pos]
    new = np.r_[True, np.diff(seed) != 0]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    starts = np.flatnonzero(new | np.r_[True, np.diff(doc) != 0])
    of = np.cumsum(new | np.r_[True, np.diff(doc) != 0]) - 1
    before = starts[of] - 1  # the last place in the document before
    later = doc > doc[first]
    other = later & ((doc[before] != doc[first]) | (pos[before] != pos[first]))
    at, owner = np.r_[np.flatnonzero(later), np.flatnonzero(other)], np.r_[first[later], before[other]]
    return [doc[at], doc[owner], pos[at], pos[owner]]


def matches(docs: DataFrame, min_words: int = MIN_WORDS, read: list[DataFrame] | None = None, held: int = HELD) -> DataFrame:
    """(bucket, doc, owner, pos, owner_pos), in lists by buckets of the documents: seeds of a document that an earlier one has, at its first and its latest place before.

    A bucket holds the seeds of about ``BUCKET`` bytes of text. Where one seed alone has very many places, its bucket passes
    ``held`` of them: then the seeds that make the most of it leave the bucket, and are sorted by range across tasks.
    ``read`` gets the written tables that the result reads.
    """
    read = [] if read is None else read
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(max(16, size // BUCKET), 2**20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(hot: bool, key: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
            bucket, lists = _dealt(key, columns, buckets)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(bucket), hot)), pa.array(bucket), *lists], ["hot", "bucket", "doc", "owner", "pos", "owner_pos"])

        gone = np.empty(0, np.int64)
        found = _buckets(batches, ("seed", "doc", "pos"), held)
        for whole, (seed, doc, pos) in found:
            out = np.isin(seed, gone)
            if not whole:
                kinds, count = np.unique(seed[~out], return_counts=True)
                most = np.argsort(-count)
                left = (~out).sum() - np.cumsum(count[most])
                gone = np.r_[gone, kinds[most[: 1 + (left > held // 2).sum()]]]
                out = np.isin(seed, gone)
            if out.any():
                yield made(True, seed[out], [doc[out], seed[out], pos[out], pos[out]])
            seed, doc, pos = seed[~out], doc[~out], pos[~out]
            if whole:
                columns = matched(seed, doc, pos)
                yield made(False, columns[0], columns)
                gone = np.empty(0, np.int64)
            else:
                found.send([seed, doc, pos])

    found = write_through(seeds(docs, min_words, buckets), "chain-seeds")
    lists = "bucket int, doc array<long>, owner array<long>, pos array<int>, owner_pos array<int>"
    shared = write_through(found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, f"hot boolean, {lists}"), "chain-shared")
    release(found)
    read.append(shared)
    cold, hot = shared.where("not hot").drop("hot"), shared.where("hot")
    if hot.isEmpty():
        return cold

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("doc", "owner", "pos", "owner_pos")]
            bucket, of = _dealt(columns[0], columns, buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), *of], ["bucket", "doc", "owner", "pos", "owner_pos"])

    rows = write_through(hot.select(F.inline(F.arrays_zip(F.col("owner").alias("seed"), "doc", "pos"))), "chain-hot")
    read.append(rows)
    owned = rows.groupBy("seed").agg(F.min(F.struct("doc", "pos")).alias("o")).select("seed", F.col("o.doc").alias("owner"), F.col("o.pos").alias("owner_pos"))
    first = rows.join(owned, "seed").where("doc > owner").select("doc", "owner", "pos", "owner_pos")
    return cold.unionByName(first.unionByName(previous(rows, read)).mapInArrow(deal, lists))


def previous(rows: DataFrame, read: list[DataFrame] | None = None) -> DataFrame:
    """(doc, owner, pos, owner_pos): each seed with its last place in the nearest earlier document that has it.

    Rows are sorted by range, so a seed of very many documents spans tasks. A task also gives the
    last two documents of its last seed; the rows of its first document look there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, held = None, [np.empty(0, np.int64)] * 3

        def made(kind: int, seed, doc, owner, pos, owner_pos) -> pa.RecordBatch:
            cells = [np.full(len(seed), kind, np.int32), seed, doc, owner, pos.astype(np.int32), owner_pos.astype(np.int32)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], ["kind", "seed", "doc", "owner", "pos", "owner_pos"])

        for batch in batches:
            if not len(batch):
                continue
            old = len(held[0])
            seed, doc, pos = (np.concatenate([h, batch.column(c).to_numpy().astype(np.int64)]) for h, c in zip(held, ("seed", "doc", "pos")))
            head = head or (seed[0], doc[0])
            starts = np.flatnonzero(np.r_[True, (np.diff(seed) != 0) | (np.diff(doc) != 0)])
            ends = np.r_[starts[1:], len(seed)] - 1
            group = np.repeat(np.arange(len(starts)), ends - starts + 1)
            before = ends[np.maximum(group - 1, 0)]
            new = np.arange(len(seed)) >= old
            known = np.flatnonzero(new & (group > 0) & (seed[before] == seed))
            at = before[known]
            yield made(0, seed[known], doc[known], doc[at], pos[known], pos[at])
            first = np.flatnonzero(new & (seed == head[0]) & (doc == head[1]))
            yield made(1, seed[first], doc[first], doc[first], pos[first], pos[first])
            last = ends[-2:]
            last = last[seed[last] == seed[-1]]
            held = [c[last] for c in (seed, doc, pos)]
        yield made(2, held[0], held[1], held[1], held[2], held[2])

    placed = rows.repartitionByRange("seed", "doc", "pos").sortWithinPartitions("seed", "doc", "pos")
    found = write_through(placed.mapInArrow(run, "kind int, seed long, doc long, owner long, pos int, owner_pos int"), "chain-previous")
    if read is not None:
        read.append(found)
    heads = found.where("kind = 1").select("seed", "doc", "pos")
    tails = found.where("kind = 2").select("seed", "owner", "owner_pos")
    over = (
        heads.join(tails, "seed").where("owner < doc").groupBy("seed", "doc", "pos").agg(F.max(F.struct("owner", "owner_pos")).alias("o"))
        .select("doc", "o.owner", "pos", "o.owner_pos")
    )
    return found.where("kind = 0").select("doc", "owner", "pos", "owner_pos").unionByName(over)


def _in_step(dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    return (dx > 0) & (GAP * 2 * dx < K - 0.1) & (dx <= MAX_GAP) & (dx == dy)


def chain(x: np.ndarray, y: np.ndarray) -> list[list[int]]:
    """Chains of matches (x ascending, then y descending): indices, each match in one chain, best chains first."""
    n = len(x)
    if _in_step(np.diff(x), np.diff(y)).all():
        return [list(range(n))]  # in step and close: each match gains most from the one before it
    place = (np.unique(y, return_inverse=True)[1] + 1).tolist()
    top = max(place)
    tree: list[tuple[float, int]] = [(-np.inf, -1)] * (top + 1)
    score, before = [0.0] * n, [-1] * n
    xs, ys = x.tolist(), y.tolist()
    for i in range(n):
        best, j, p = -np.inf, -1, place[i] - 1
        while p > 0:
            if tree[p][0] > best:
                best, j = tree[p]
            p &= p - 1
        reach = best - GAP * (xs[i] + ys[i])
        score[i] = K + max(0.0, reach)
        before[i] = j if reach > 0 else -1
        entry, p = (score[i] + GAP * (xs[i] + ys[i]), i), place[i]
        while p <= top:
            if entry[0] > tree[p][0]:
                tree[p] = entry
            p += p & -p
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: -score[i]):
        links = []
        while i >= 0 and not used[i]:
            used[i] = True
            if links and (xs[links[-1]] - xs[i] > MAX_GAP or ys[links[-1]] - ys[i] > MAX_GAP):
                out.append(links[::-1])
                links = []
            links.append(i)
            i = before[i]
        if links:
            out.append(links[::-1])
    return out


def returning(x: np.ndarray, y: np.ndarray) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """(first, last, owner position) of seeds that come again and again, as in a line said many times; and which matches these are."""
    out, inside = [], np.zeros(len(x), bool)
    if len(x) < 3:
        return out, inside
    order = np.lexsort((x, y))
    xs, ys = x[order], y[order]
    cut = np.flatnonzero((np.diff(ys) != 0) | (np.diff(xs) > MAX_GAP)) + 1
    for a, b in zip([0, *cut], [*cut, len(xs)]):
        if b - a > 2 and xs[b - 1] - xs[a] >= MIN_PIECE:
            out.append((int(xs[a]), int(xs[b - 1]), int(ys[a])))
            inside[order[a:b]] = True
    return out, inside


def chains(found: DataFrame) -> DataFrame:
    """(doc, owner, xs, ys, reach): chained seed positions, and how far a returning seed goes on. Rows of a document are bounded by its own seeds."""
    kinds = pa.schema([("doc", pa.int64()), ("owner", pa.int64()), ("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32())), ("reach", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (doc, owner, x, y) in _buckets(batches, ("doc", "owner", "pos", "owner_pos")):
            if not len(doc):
                continue
            order = np.lexsort((-y, x, owner, doc))
            doc, owner, x, y = (c[order] for c in (doc, owner, x, y))
            pair = np.r_[True, (np.diff(doc) != 0) | (np.diff(owner) != 0)]
            new = pair | np.r_[True, (np.diff(x) != 0) | (np.diff(y) != 0)]
            doc, owner, x, y, pair = doc[new], owner[new], x[new], y[new], pair[new]
            starts = np.flatnonzero(pair)
            sizes = np.diff(np.r_[starts, len(doc)])
            step = np.r_[0, np.diff(x)]
            straight = np.logical_and.reduceat(pair | _in_step(step, np.r_[0, np.diff(y)]), starts)  # one chain, none returning
            kept = np.repeat(straight, sizes)
            xs, ys = _lists([x[kept], y[kept]], sizes[straight])
            yield pa.RecordBatch.from_arrays([pa.array(doc[starts[straight]]), pa.array(owner[starts[straight]]), xs, ys, pa.array(np.zeros(straight.sum(), np.int32))], schema=kinds)
            out: dict = {c: [] for c in kinds.names}
            for a, n in zip(starts[~straight], sizes[~straight]):
                b = a + n
                often, inside = returning(x[a:b], y[a:b])
                for c in chain(x[a:b], y[a:b]):
                    if len(c) > 1 or not inside[c[0]]:
                        out["doc"].append(doc[a]), out["owner"].append(owner[a])
                        out["xs"].append(x[a:b][c]), out["ys"].append(y[a:b][c]), out["reach"].append(0)
                for x0, x1, y0 in often:
                    out["doc"].append(doc[a]), out["owner"].append(owner[a])
                    out["xs"].append([x0]), out["ys"].append([y0]), out["reach"].append(x1 - x0)
            yield pa.RecordBatch.from_pydict(out, kinds)

    return found.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "doc long, owner long, xs array<int>, ys array<int>, reach int")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short arrays."""
    row = np.zeros(len(b) + 1, np.int32)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return int(row[-1])


def _outwards(equal: np.ndarray) -> tuple[int, int]:
    """(words, of which equal) that it pays to go on: one for a word, minus two for a differing one."""
    if not len(equal):
        return 0, 0
    total = np.cumsum(np.where(equal, 1, -2))
    best = int(total.argmax())
    return (best + 1, int(equal[: best + 1].sum())) if total[best] > 0 else (0, 0)


def align(a: np.ndarray, b: np.ndarray, xs: np.ndarray, ys: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """Aligned stretches (x0, x1, y0, y1, equal words, columns) of a chain, positions in ``a`` and ``b``."""
    out, first, equal, columns = [], 0, 0, 0

    def close(i: int) -> None:
        x0, y0, x1, y1 = int(xs[first]), int(ys[first]), int(xs[i]) + K, int(ys[i]) + K
        n = min(x0, y0)
        left = _outwards((a[x0 - n : x0] == b[y0 - n : y0])[::-1])
        n = min(len(a) - x1, len(b) - y1)
        right = _outwards(a[x1 : x1 + n] == b[y1 : y1 + n])
        out.append((x0 - left[0], x1 + right[0], y0 - left[0], y1 + right[0], equal + K + left[1] + right[1], columns + K + left[0] + right[0]))

    at = xs - xs[0]
    if (at == ys - ys[0]).all():  # words stay in step: all counts at once
        total = np.concatenate([[0], (a[xs[0] : xs[-1]] == b[ys[0] : ys[-1]]).cumsum()])
        wide = np.diff(at)
        if not ((wide > 2 * K) & (2 * np.diff(total[at]) < wide)).any():
            equal, columns = int(total[-1]), int(at[-1])
            close(len(xs) - 1)
            return out
    for i in range(1, len(xs)):
        x0, x1, y0, y1 = int(xs[i - 1]), int(xs[i]), int(ys[i - 1]), int(ys[i])
        same = int((a[x0:x1] == b[y0:y1]).sum()) if x1 - x0 == y1 - y0 else _common(a[x0:x1], b[y0:y1])
        wide = max(x1 - x0, y1 - y0)
        if wide > 2 * K and 2 * same < wide:
            close(i - 1)
            first, equal, columns = i, 0, 0
        else:
            equal, columns = equal + same, columns + wide
    close(len(xs) - 1)
    return out


def align_straight(a: np.ndarray, b: np.ndarray, a0: np.ndarray, b0: np.ndarray, left: np.ndarray, inner: np.ndarray, right: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """What ``align`` finds for many chains in step at once: (straight, words outwards to the left and to the right, equal words, columns).

    Chain i reaches over the words a0[i] of ``a`` and b0[i] of ``b`` and the ``inner`` after them, with ``left`` words before and ``right``
    after to look at. ``at``: its seeds, counted from its start, in ``sizes`` numbers a chain. Not straight: more than one stretch, to be aligned alone.
    """
    size = left + inner + right
    ends = np.cumsum(size)
    base = ends - size
    word = np.arange(ends[-1])
    equal = a[np.repeat(a0 - left - base, size) + word] == b[np.repeat(b0 - left - base, size) + word]
    total = np.r_[0, np.cumsum(equal)]
    x0, x1 = base + left, base + left + inner
    # One for a word, minus two for a differing one; the nearest of the best ends.
    key = np.r_[(3 * total - 2 * np.arange(len(total))) * (1 << 32) - np.arange(len(total)), 0]
    spans = np.stack([base, x0 + 1, x1, ends + 1], 1).ravel()
    p = (-np.minimum.reduceat(key, spans)[::4]) & 0xFFFFFFFF
    q = (-np.maximum.reduceat(key, spans)[2::4]) & 0xFFFFFFFF
    seed = np.repeat(x0, sizes) + at
    wide = np.diff(at, append=0)
    wide[np.cumsum(sizes) - 1] = 0
    same = np.where(wide > 0, total[seed + wide] - total[seed], 0)
    straight = ~np.logical_or.reduceat((wide > 2 * K) & (2 * same < wide), np.cumsum(sizes) - sizes)
    return [straight, x0 - p, q - x1, total[x1 - K] - total[x0] + K + total[x0] - total[p] + total[q] - total[x1], inner + x0 - p + q - x1]


def _aligned(linked: DataFrame, texts: DataFrame, margins: list[int], parts: int) -> list[DataFrame]:
    """Aligned stretches of chains, or, where one ends with the text read, the chain itself (``xs`` not null), to be read further.

    The words around a chain are cut out where it meets its document, and go with it to its owner. Written part by part
    of the owners, as every chain shuffles the words it is aligned with. The margins are tried one after another.
    """
    far = margins[-1]
    kinds = [(c, pa.int64()) for c in ("doc", "start", "end", "owner", "owner_start", "owner_end", "equal", "columns")]
    schema = pa.schema([*kinds, ("xs", pa.list_(pa.int32())), ("ys", pa.list_(pa.int32())), ("reach", pa.int32())])

    def cut(at: str) -> Column:
        start = F.greatest(F.element_at(at, 1) - far, F.lit(0))
        return F.substring("words", start * 4 + 1, (F.element_at(at, -1) + K + far + F.col("reach") - start) * 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield from aligned(batch)

    def aligned(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc, owner, reach = (batch.column(c).to_numpy().astype(np.int64) for c in ("doc", "owner", "reach"))
        xs, ys = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("xs", "ys"))
        sizes = batch.column("xs").value_lengths().to_numpy().astype(np.int64)
        last = np.cumsum(sizes) - 1
        first = last + 1 - sizes
        x0, y0, x1, y1 = xs[first], ys[first], xs[last] + K, ys[last] + K
        xf, yf = np.maximum(x0 - far, 0), np.maximum(y0 - far, 0)  # where the words read begin
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32) for c in ("left", "right"))
        na, nb = (pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) // 4 for c in ("left", "right"))
        a0, b0 = np.cumsum(na) - na, np.cumsum(nb) - nb
        there = (x1 - xf <= na) & (y1 - yf <= nb)  # else the document has another text
        straight = np.logical_and.reduceat(xs - np.repeat(x0, sizes) == ys - np.repeat(y0, sizes), first) & there
        found, further = [], []
        todo, alone = np.flatnonzero(straight), list(np.flatnonzero(there & ~straight))
        for margin in margins:
            if not len(todo):
                break
            xa, ya = np.maximum(x0 - margin, 0)[todo], np.maximum(y0 - margin, 0)[todo]
            xb, yb = (x1 + margin + reach)[todo], (y1 + margin + reach)[todo]
            xe, ye = np.minimum(xb, (xf + na)[todo]), np.minimum(yb, (yf + nb)[todo])
            before, after = np.minimum(x0[todo] - xa, y0[todo] - ya), np.minimum(xe - x1[todo], ye - y1[todo])
            mine = np.repeat(np.isin(np.arange(len(doc)), todo), sizes)
            at = (xs - np.repeat(x0, sizes))[mine]
            one, left, right, equal, wide = align_straight(a, b, (a0 + x0 - xf)[todo], (b0 + y0 - yf)[todo], before, (x1 - x0)[todo], after, at, sizes[todo])
            start, end, owner_start, owner_end = x0[todo] - left, x1[todo] + right, y0[todo] - left, y1[todo] + right
            # Only text that goes on beyond the words read on both sides can be read further.
            more = (xa > 0) & (ya > 0) & ((start == xa) | (owner_start == ya)) | (xe == xb) & (ye == yb) & ((end == xe) | (owner_end == ye))
            good = one & ~more & (equal >= ALIKE * wide) & (end - start >= MIN_PIECE)
            found.append(np.stack([doc[todo], start, end, owner[todo], owner_start, owner_end, equal, wide], 1)[good])
            alone += list(todo[~one])
            todo = todo[one & more]
        further += list(todo)
        single = []
        for i in alone:
            x, y = xs[first[i] : last[i] + 1], ys[first[i] : last[i] + 1]
            for margin in margins:
                xa, ya, xb, yb = max(x0[i] - margin, 0), max(y0[i] - margin, 0), x1[i] + margin + reach[i], y1[i] + margin + reach[i]
                aw, bw = a[a0[i] + xa - xf[i] : a0[i] + min(xb - xf[i], na[i])], b[b0[i] + ya - yf[i] : b0[i] + min(yb - yf[i], nb[i])]
                stretches = align(aw, bw, x - xa, y - ya)
                left, right = xa > 0 and ya > 0, len(aw) == xb - xa and len(bw) == yb - ya
                if not any(left and min(s[0], s[2]) == 0 or right and (s[1] == len(aw) or s[3] == len(bw)) for s in stretches):
                    single += [(doc[i], s[0] + xa, s[1] + xa, owner[i], s[2] + ya, s[3] + ya, s[4], s[5]) for s in stretches if s[4] >= ALIKE * s[5] and s[1] - s[0] >= MIN_PIECE]
                    break
            else:
                further.append(i)
        rows = np.concatenate([np.array(single, np.int64).reshape(-1, 8), *found])
        yield pa.RecordBatch.from_arrays([*(pa.array(rows[:, j]) for j in range(8)), *(pa.nulls(len(rows), t) for t in schema.types[8:])], schema=schema)
        left = batch.take(pa.array(further, pa.int64()))
        yield pa.RecordBatch.from_arrays([left.column(c).cast(t) if c in left.schema.names else pa.nulls(len(left), t) for c, t in zip(schema.names, schema.types)], schema=schema)

    out = []
    for part in range(parts):
        mine = F.pmod(F.xxhash64("owner"), F.lit(parts)) == part
        rows = linked.where(mine).join(texts, "doc").select(*linked.columns, cut("xs").alias("left"))
        rows = rows.join(texts.withColumnRenamed("doc", "owner").where(mine), "owner")
        found = rows.select(*linked.columns, "left", cut("ys").alias("right")).mapInArrow(
            run, ", ".join(f"{c} long" for c, _ in kinds) + ", xs array<int>, ys array<int>, reach int"
        )
        out.append(write_through(found, "chain-aligned"))
    return out


def pieces(docs: DataFrame, min_words: int = MIN_WORDS, read: list[DataFrame] | None = None) -> DataFrame:
    """(doc, start, end, owner, owner_start, owner_end, equal, columns): aligned stretches that agree enough.

    Written tables are deleted as soon as nothing reads them any more; ``read`` gets those that the result reads.
    """
    used: list[DataFrame] = []
    linked = write_through(chains(matches(docs, min_words, used)), "chain-chains")
    release(*used)
    used = [linked]
    texts = write_through(words_of(docs, min_words), "chain-slices")
    made, margins, parts = None, [MARGIN], PARTS
    while True:
        aligned = _aligned(linked, texts, margins, parts)
        release(*used)
        if read is not None:
            read += aligned
        found = reduce(DataFrame.union, aligned)
        done = found.where("xs is null").drop("xs", "ys", "reach")
        made = done if made is None else made.unionByName(done)
        # A table of their own, as they are few: then Spark knows their size.
        linked = write_through(found.where("xs is not null").select("doc", "owner", "xs", "ys", "reach"), "chain-further")
        used = [linked]
        if linked.isEmpty():
            release(linked, texts)
            return made.distinct()
        margins, parts = [margins[-1] * 4**i for i in (1, 2, 3)], 1


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start, end, owner_id, owner_start, owner_end, likeness, passage_start, passage_end).

    Words start to end of doc_id repeat words of the earlier owner_id; passages are the
    stretches of touching pieces with at least ``min_words`` words.
    """
    read: list[DataFrame] = []
    spark = docs.sparkSession
    with short_lived_shuffles(spark), small_batches(spark):
        found = write_through(pieces(docs, min_words, read), "chain-pieces")
    release(*read)
    order = Window.partitionBy("doc").orderBy("start", "end", "owner", "owner_start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((reach.isNull() | (F.col("start") > reach + 2)).cast("int")).over(order)
    whole = Window.partitionBy("doc", "island")
    return (
        found.withColumn("island", island)
        .select("*", F.min("start").over(whole).alias("passage_start"), F.max("end").over(whole).alias("passage_end"))
        .where(F.col("passage_end") - F.col("passage_start") >= min_words)
        .select(
            F.col("doc").alias("doc_id"), "start", "end", F.col("owner").alias("owner_id"), "owner_start", "owner_end",
            (F.col("equal") / F.col("columns")).alias("likeness"), "passage_start", "passage_end",
        )
    )


def cut_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """``docs`` without the repeated passages; a document of nothing else goes."""
    spans = passages.select("doc_id", F.struct("passage_start", "passage_end").alias("s")).groupBy("doc_id").agg(F.array_sort(F.collect_set("s")).alias("_spans"))
    spans = spans.withColumnRenamed("doc_id", "_doc")

    @F.pandas_udf("string")
    def without(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, cut in zip(texts, spans):
            at = [m.span() for m in _WORD.finditer(text)]
            kept, last = [], 0
            for s in cut:
                a, b = min(s["passage_start"], len(at)), min(s["passage_end"], len(at))
                if a < b:
                    kept.append(text[last : at[a][0]])
                    last = at[b - 1][1]
            kept.append(text[last:])
            out.append("".join(kept))
        return pd.Series(out)

    joined = docs.join(spans, docs["doc_id"] == spans["_doc"], "left")
    touched = joined.where("_spans is not null and text is not null").withColumn("text", without("text", "_spans")).where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "")
    return joined.where("_spans is null or text is null").unionByName(touched).drop("_doc", "_spans")
