"""Lexical search against scoring every document: skipping, ties, nulls, repeats, several blocks of queries."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import lexical_search as ls

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, k):
    held = [(d, Counter(terms_of(t))) for d, t in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in held:
            m = 75 + 25 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 12 * m)) for w in terms_of(text) if w in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(item, i, None if none else d, -s) for i, (s, none, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def made(spark, docs, items, **how):
    clash = {c: F.lit("x") for c in ("n", "m", "item", "score", "rank", "terms", "tf")}
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumns(clash)
    b = spark.createDataFrame(items, "item_id long, text string").withColumns(clash)
    return sorted((tuple(r) for r in ls.rank_documents(a, b, **how).collect()), key=str)


def test_against_all_documents(spark):
    draw = random.Random(31)
    words = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(words[min(299, int(draw.expovariate(0.03)))].upper() + draw.choice(["", ".", "-", "é"]) for _ in range(n))
    docs = [(i, prose(draw.randrange(60))) for i in range(700)] + [(None, "w1 w2 w290"), (3, None), (3, ""), (5, "..."), (9, "w1 w2 w3"), (9, "w1 w2 w3"), (8, "w1 w2 w3"), (1000, prose(50000))]
    items = [(i, prose(12)) for i in range(25)] + [(50, None), (51, ""), (52, "unknownword"), (53, "w1 w1 w1 w2"), (53, "W290"), (None, "w4 w7")]
    want = plain(docs, items, 5)
    assert made(spark, docs, items, k=5) == want
    assert made(spark, docs, items, k=5, block_bytes=400) == want
    assert made(spark, docs, []) == [] and made(spark, [], items) == [] and made(spark, [(1, None)], items) == []


def test_skipping_keeps_the_best():
    """Blocks of documents with short and long lists, in windows; the same best as adding everything up."""
    draw = random.Random(32)
    for _ in range(20):
        rows = draw.randrange(1, 3000)
        share = [draw.choice([0.001, 0.01, 0.05, 0.3, 0.9]) for _ in range(12)]
        held = [[t for t in range(12) if draw.random() < share[t]] for _ in range(rows)]
        batch = pa.record_batch({
            "doc_id": pa.array([draw.randrange(400) for _ in range(rows)], pa.int64()), "n": pa.array([9] * rows, pa.int64()),
            "terms": pa.array(held, pa.list_(pa.int32())), "tf": pa.array([[draw.choice([1, 1, 2, 50]) for _ in h] for h in held], pa.list_(pa.int64())),
            "m": pa.array([draw.randrange(75, 1000) for _ in range(rows)], pa.int64()),
        })
        query = [(t, draw.randrange(0, 8000)) for t in range(12) if draw.random() < 0.7]
        best = ls.Best(20)
        ls.Postings(batch, 12).search(query, best)
        weight, want = dict(query), []
        for r in batch.to_pylist():
            s = sum(weight.get(t, 0) * (10**9 * f // (1000 * f + 12 * r["m"])) for t, f in zip(r["terms"], r["tf"]))
            if s > 0:
                want.append((-s, r["doc_id"]))
        assert list(zip(-best.scores, best.ids)) == sorted(want)[:20]


def test_slices(monkeypatch):
    text = "Aé b-c 12 ÀB\x7f" + "long" * 30 + " end" * 9
    for size in (1, 3, 50, 10**6):
        monkeypatch.setattr(ls, "SLICE", size)
        assert [w.decode() for ws in ls.words_of(text.encode()) for w in ws] == terms_of(text)
    assert np.concatenate([[], []]).size == 0 and list(ls.words_of(None)) == []
