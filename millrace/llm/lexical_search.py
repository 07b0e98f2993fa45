"""Ranked lexical search: short lists summed into accumulators, long lists read with skipping.

Queries come in blocks of bounded size; for each block one pass over the documents keeps, of
every document, its length and how often it holds each term of the block. That table is the
index: every stretch of rows that a task reads at once becomes posting lists by term. For a
query, lists that few of these documents stand in are added up term by term. The sums then act
as one more list, with bounds, beside the long lists. Those are walked window by window of
documents, the most promising first; windows, and documents inside them, whose bound stays
below the k-th best score so far are skipped, and long lists are only probed for the rest.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import write_through

#: A-Z to lower case; other ASCII signs than letters and digits to spaces.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_SPACE = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
SLICE = 1 << 20
#: Bytes of query text in a block: bounds what is sent to every task.
BLOCK_BYTES = 8 << 20
#: A list of a 16th of the documents or less is short. Documents in a window.
SHORT, WINDOW = 16, 512


def words_of(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, in slices, so that a very long one is never held as single terms."""
    at, end = 0, len(text or b"")
    while at < end:
        cut = _SPACE.search(text, at + SLICE) if at + SLICE < end else None
        stop = cut.start() if cut else end
        yield text[at:stop].translate(_FOLD).split()
        at = stop


def _vectors(batches: Iterable[pa.RecordBatch], numbers: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n, terms, tf): length, and counts of the numbered terms, of each document with terms."""
    for batch in batches:
        kept, sizes, terms, counts, ends = [], [], [], [], [0]
        for row, text in enumerate(batch.column("text").cast(pa.binary())):
            n, found = 0, []
            for words in words_of(text.as_py()):
                n += len(words)
                found.append(np.array([x for x in map(numbers.get, words) if x is not None], np.int32))
            if n:
                held, tf = np.unique(np.concatenate(found), return_counts=True)
                kept.append(row)
                sizes.append(n)
                terms.append(held)
                counts.append(tf)
                ends.append(ends[-1] + len(held))
        flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        offsets = pa.array(np.array(ends, np.int32))
        yield pa.record_batch({
            "doc_id": batch.column("doc_id").cast(pa.int64()).take(pa.array(kept, pa.int64())), "n": pa.array(sizes, pa.int64()),
            "terms": pa.ListArray.from_arrays(offsets, pa.array(flat(terms, np.int32))),
            "tf": pa.ListArray.from_arrays(offsets, pa.array(flat(counts, np.int64))),
        })


class Best:
    """The k best documents of a query: highest score first, ties to the smaller doc_id, null ones last."""

    def __init__(self, k: int):
        self.k, self.limit = k, 1
        self.scores, self.ids, self.none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores, ids, none) -> None:
        scores, ids, none = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids]), np.concatenate([self.none, none])
        order = np.lexsort((ids, none, -scores))[: self.k]
        self.scores, self.ids, self.none = scores[order], ids[order], none[order]
        if len(order) == self.k:
            self.limit = max(self.limit, int(self.scores[-1]))


class Postings:
    """Posting lists of some documents: by term, which of them hold it and what one occurrence weight is worth there."""

    def __init__(self, batch: pa.RecordBatch, n_terms: int):
        self.rows = batch.num_rows
        ids = batch.column("doc_id")
        self.none = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = ids.fill_null(0).to_numpy()
        lists, counts = batch.column("terms"), batch.column("tf")
        terms, tf = lists.flatten().to_numpy(), counts.flatten().to_numpy()
        docs = np.repeat(np.arange(self.rows), np.diff(lists.offsets.to_numpy()))
        m = batch.column("m").to_numpy()[docs]
        order = np.argsort(terms, kind="stable")
        self.docs = docs[order]
        self.worth = ((1_000_000_000 * tf) // (1000 * tf + 12 * m))[order]
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.bounds = np.arange(0, self.rows + WINDOW, WINDOW)
        self._windows: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def size(self, term: int) -> int:
        return int(self.starts[term + 1] - self.starts[term])

    def part(self, term: int) -> slice:
        return slice(self.starts[term], self.starts[term + 1])

    def windows(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the list enters each window, and the most it is worth in each."""
        if term not in self._windows:
            docs, worth = self.docs[self.part(term)], self.worth[self.part(term)]
            self._windows[term] = _by_window(docs, worth, self.bounds)
        return self._windows[term]

    def search(self, query: list[tuple[int, int]], best: Best) -> None:
        """Put the best of these documents for (term, weight) pairs into ``best``."""
        lists = [(t, w) for t, w in query if w > 0 and self.size(t)]
        short = [x for x in lists if SHORT * self.size(x[0]) <= self.rows]
        long = [x for x in lists if SHORT * self.size(x[0]) > self.rows]
        docs, sums = self._accumulate(short)
        if len(docs) >= best.k:
            best.limit = max(best.limit, int(np.partition(sums, -best.k)[-best.k]))
        at, most = _by_window(docs, sums, self.bounds)
        tops = [w * self.windows(t)[1] for t, w in long]
        reach = most + sum(tops) if tops else most
        for k in np.argsort(-reach, kind="stable"):
            if reach[k] < best.limit:
                break
            scores = np.zeros(WINDOW, np.int64)
            base = self.bounds[k]
            scores[docs[at[k] : at[k + 1]] - base] = sums[at[k] : at[k + 1]]
            self._walk(k, base, scores, [(int(top[k]), t, w) for top, (t, w) in zip(tops, long)], best)

    def _accumulate(self, lists: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        if not lists:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs = np.concatenate([self.docs[self.part(t)] for t, _ in lists])
        worth = np.concatenate([w * self.worth[self.part(t)] for t, w in lists])
        order = np.argsort(docs, kind="stable")
        docs, worth = docs[order], worth[order]
        first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
        return docs[first], np.add.reduceat(worth, first)

    def _walk(self, k: int, base: int, scores: np.ndarray, lists: list[tuple[int, int, int]], best: Best) -> None:
        """Score the documents of one window: lists by falling bound, the last ones only where they can still matter."""
        lists.sort(reverse=True)
        rest = sum(top for top, _, _ in lists)
        alive = None
        for top, term, weight in lists:
            at = self.windows(term)[0]
            part = slice(self.starts[term] + at[k], self.starts[term] + at[k + 1])
            docs, worth = self.docs[part] - base, self.worth[part]
            if alive is None and rest < best.limit:
                alive = np.flatnonzero(scores + rest >= best.limit)
            if alive is None:
                scores[docs] += weight * worth
            elif len(docs):
                place = np.minimum(np.searchsorted(docs, alive), len(docs) - 1)
                hit = docs[place] == alive
                scores[alive[hit]] += weight * worth[place[hit]]
                alive = alive[scores[alive] + rest - top >= best.limit]
            rest -= top
        alive = np.flatnonzero(scores >= best.limit) if alive is None else alive[scores[alive] >= best.limit]
        if len(alive):
            best.add(scores[alive], self.ids[base + alive], self.none[base + alive])


def _by_window(docs: np.ndarray, worth: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(docs, bounds)
    most = np.zeros(len(bounds) - 1, np.int64)
    some = np.flatnonzero(at[1:] > at[:-1])
    if len(some):
        most[some] = np.maximum.reduceat(worth, at[some])
    return at, most


def _search(batches: Iterable[pa.RecordBatch], queries: list[list[tuple[int, int]]], n_terms: int, k: int) -> Iterator[pa.RecordBatch]:
    """(item, doc_id, score): the k best documents of this task for each query."""
    found = [Best(k) for _ in queries]
    for batch in batches:
        if batch.num_rows:
            postings = Postings(batch, n_terms)
            for query, best in zip(queries, found):
                postings.search(query, best)
    for item, best in enumerate(found):
        if len(best.scores):
            ids = pa.array(best.ids, mask=best.none)
            yield pa.record_batch({"item": pa.array(np.full(len(ids), item, np.int32)), "doc_id": ids, "score": pa.array(best.scores)})


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = BLOCK_BYTES, salts: int = 32) -> DataFrame:
    """The ``k`` best documents with a score above 0 for each item: (item_id, rank, doc_id, score).

    ``items`` (item_id, text) are the queries; ``docs`` (doc_id, text) are all searched. Terms are
    runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased. A term
    of df documents weighs w = floor(1000 ln((2N + 2) / (2 df + 1))), where N documents have terms,
    L in all; a document with n terms has m = 75 + (25 n N) div L, and gets
    w * ((10^9 tf) div (1000 tf + 12 m)) for each occurrence of a term in the item.

    Each row is a document, repeated or not, and each row of ``items`` a query. Null and empty
    texts have no terms: such items get no rows, such documents count nowhere. Equal scores
    go by ascending doc_id, null ones last. Other columns are not read.
    """
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    made = [_rank_block(docs, items.where(block == b).select("item_id", "text").collect(), items, k, salts) for b in range(blocks)]
    every = made[0]
    for one in made[1:]:
        every = every.unionByName(one)
    return every


def _rank_block(docs: DataFrame, items: list, like: DataFrame, k: int, salts: int) -> DataFrame:
    spark = docs.sparkSession
    asked = [Counter(w for words in words_of((r["text"] or "").encode()) for w in words) for r in items]
    numbers = {w: i for i, w in enumerate(sorted(set().union(*asked)))}
    shared = spark.sparkContext.broadcast(numbers)
    vectors = docs.select("doc_id", "text").mapInArrow(lambda b: _vectors(b, shared.value), "doc_id long, n long, terms array<int>, tf array<long>")
    vectors = write_through(vectors, "lexical-index")
    totals = vectors.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weight = [math.floor(1000 * math.log((2 * totals["docs"] + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(numbers))]
    queries = [[(numbers[w], times * weight[numbers[w]]) for w, times in terms.items()] for terms in asked]
    # 25 n N may pass 64 bits on large tables.
    share = F.expr(f"CAST(25 * n AS DECIMAL(19, 0)) * CAST({totals['docs']} AS DECIMAL(15, 0)) div CAST({max(totals['terms'], 1)} AS DECIMAL(19, 0))")
    sent, n_terms = spark.sparkContext.broadcast(queries), len(numbers)
    held = vectors.where(F.size("terms") > 0).withColumn("m", 75 + share)
    found = held.mapInArrow(lambda b: _search(b, sent.value, n_terms, k), "item int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", salt).orderBy(*order))).where(F.col("rank") <= k)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], f"item int, item_id {like.schema['item_id'].dataType.simpleString()}")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
