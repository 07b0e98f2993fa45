"""Nearest neighbours by randomly rotated one-bit codes.

Every vector is scaled to length one and rotated at random; its code is the sign of each
component, packed to bits, and its correction scalar the inner product of the code with the
rotated vector. The inner product with a query is estimated from the packed bits and the
scalar. The error of an estimate is at most ``EPSILON`` standard deviations of the rotation's
noise (missed about once in a thousand), so only vectors whose estimate plus bound reaches the
k-th best exact cosine found so far are compared exactly, in double precision.

Blocks of queries meet blocks of vectors by an equi-join on block numbers. A meeting returns its
own k best, which hold the overall k best of that block; so equal vectors, however many, send on
k rows. Every valid row is indexed and searched; nothing is fitted but the seed of the rotation.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take
no part; vectors are compared with those of equal length only; repeated rows are candidates of
their own, except those with the query's own id; ties go to the smaller vec_id.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

EPSILON = 3.0
VECTORS, QUERIES = 8192, 1024


def rotation(d: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed bits, correction scalar) of the rows of ``v``."""
    d = v.shape[1]
    turned = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ rotation(d).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(d)


def cosines(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact cosines, summed from the first component to the last."""
    total = lambda x: np.add.accumulate(x, axis=-1)[..., -1]
    return total(v * q) / (np.sqrt(total(v * v)) * np.sqrt(total(q * q)))


def valid_vectors(df: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that take part, as doubles."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        df.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
        .where((F.size("v") > 0) & F.forall("v", sound) & F.exists("v", lambda x: x != 0) & F.col("vec_id").isNotNull())
    )


def index(vectors: DataFrame) -> DataFrame:
    """(vec_id, v, code, factor) of (vec_id, v)."""

    def run(batches):
        for batch in batches:
            out = []
            for _, part in batch.groupby(batch["v"].map(len)):
                code, factor = encode(np.stack(part["v"].to_numpy()))
                out.append(part.assign(code=[c.tobytes() for c in code], factor=factor))
            if out:
                yield pd.concat(out)[["vec_id", "v", "code", "factor"]]

    return vectors.mapInPandas(run, "vec_id long, v array<double>, code binary, factor double")


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(ids, v, bits, factor, query_ids, queries, k: int, epsilon: float = EPSILON):
    """Per query the k best of one block: (query_id, vec_id, score)."""
    d = v.shape[1]
    signs = bits.astype(np.float32) * 2 - 1
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    near = (signs @ (unit @ rotation(d).T).T.astype(np.float32)) / (np.sqrt(d) * factor)[:, None]
    bound = epsilon * np.sqrt(np.maximum(0, 1 - factor**2)) / factor / np.sqrt(max(1, d - 1)) + 1e-5
    for j, own in enumerate(query_ids):
        est = np.where(ids == own, -np.inf, near[:, j])
        first = np.argpartition(-est, min(k, len(est) - 1))[:k]
        first = first[est[first] > -np.inf]
        if not len(first):
            continue
        found = cosines(v[first], queries[j])
        least = found.min() if len(found) == k else -np.inf
        rest = np.flatnonzero((est + bound >= least) & (est > -np.inf))
        found = cosines(v[rest], queries[j])
        # Vectors of the first choice count even if the bound would leave one out.
        rest = np.concatenate([rest, extra := np.setdiff1d(first, rest)])
        found = np.concatenate([found, cosines(v[extra], queries[j])])
        top = _best(ids[rest], found, k)
        yield from zip([own] * len(top), ids[rest][top], found[top])


def nearest(indexed: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``indexed`` nearest to each of ``queries`` (vec_id, v)."""
    n, m = indexed.count(), queries.count()
    blocks, groups = max(1, -(-n // VECTORS)), max(1, -(-m // QUERIES))
    part = lambda count: F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    left = indexed.select(part(blocks).alias("b"), every(groups).alias("g"), F.size("v").alias("d"), "*")
    right = queries.select(every(blocks).alias("b"), part(groups).alias("g"), F.size("v").alias("d"), "*")

    def meet(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(vectors) and len(asked):
            v = np.stack(vectors["v"].to_numpy())
            bits = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in vectors["code"]]), axis=1, count=v.shape[1])
            rows = list(search_block(
                vectors["vec_id"].to_numpy(), v, bits, vectors["factor"].to_numpy(), asked["vec_id"].to_numpy(), np.stack(asked["v"].to_numpy()), k
            ))
        return pd.DataFrame(rows, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["b", "g", "d"]
    found = left.groupBy(keys).cogroup(right.groupBy(keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
