"""Collocations against counting by dictionaries: slices, flushes, parts of streams, nulls, ties, repeats."""

import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import collocations as co

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def phrases_of(text, m=3):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        words = re.findall("[^ \t]+", piece)
        for k in range(1, m + 1):
            yield from (tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def plain(rows, top, m, least, percent):
    out = []
    for lang in {"und" if x is None else x for x, _ in rows}:
        f = Counter(p for x, t in rows if ("und" if x is None else x) == lang for p in phrases_of(t, m))
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside.get(p[i : i + k], 0), a)
        kept = []
        for p, a in candidates.items():
            if 100 * inside.get(p, 0) >= percent * a:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def made(spark, rows, **how):
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("x") for c in ("n", "phrase", "k", "h", "words", "part", "score")})
    return sorted(map(tuple, co.collocations(df, **how).collect()))


def _rows(draw, n):
    words = ["the", "of", "New", "york", "Straße", "a-b", "x", "ÉTÉ", "qu'il", "\x1f", "été"]
    rows = []
    for _ in range(n):
        text = "".join(draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "\x0c"]) for _ in range(draw.randrange(40)))
        rows.append((draw.choice(["en", "en", "de", None, ""]), text))
    return rows


def test_against_dictionaries(spark, monkeypatch):
    draw = random.Random(21)
    rows = _rows(draw, 400) + [("en", None), (None, ""), ("en", "New York " * 9000), ("zz", "few words")] + [("de", "same row again, same row again")] * 30
    want = plain(rows, 2000, 3, 10, 50)
    assert len(want) > 100 and {len(w[2].split(" ")) for w in want} == {2, 3}
    assert made(spark, rows) == want
    monkeypatch.setattr(co, "PART_ROWS", 40)
    assert made(spark, rows, top=7, max_words=4, min_count=3, percent=70) == plain(rows, 7, 4, 3, 70)
    assert made(spark, []) == [] and made(spark, [(None, None)]) == []


def test_slices_and_flushes(monkeypatch):
    """The same counts whatever the slices and flushes, in the middle of a text too."""
    draw = random.Random(22)
    rows = [(str(lang), text.encode()) for lang, text in _rows(draw, 60)] + [("en", b"one two three " * 50 + b"x" * 300)]
    want = Counter((lang, p) for lang, text in rows for p in phrases_of(text.decode(), 3))
    for slice_, at_once in ((1, 3), (7, 5), (64, 1), (20, 100)):
        monkeypatch.setattr(co, "SLICE", slice_)
        monkeypatch.setattr(co, "WORDS_AT_ONCE", at_once)
        counter, got = co._Counter(3), Counter()
        def take(flushed):
            for lang, ids, skip in flushed:
                for k in (1, 2, 3):
                    for end in range(max(skip, k - 1), len(ids)):
                        if all(run := [int(x) for x in ids[end - k + 1 : end + 1]]):
                            got[lang, tuple(counter.words[x].decode() for x in run)] += 1
        for lang, text in rows:
            take(counter.add(lang, text))
        take(counter.flush())
        assert got == want


def test_exact_scores_beyond_64_bits(spark, monkeypatch):
    """Counts of 10^12: 10^6 a a passes 64 bits."""
    big = 10**12 + 7
    rows = [("en", 0, "", 9 * big), ("en", 1, "a", 3 * big), ("en", 1, "b", 2 * big + 1), ("en", 2, "a b", big)]
    monkeypatch.setattr(co, "phrase_counts", lambda *_: spark.createDataFrame(rows, "lang string, k int, phrase string, n long"))
    got = [tuple(r) for r in co.collocations(spark.createDataFrame([("en", "")], "lang string, text string")).collect()]
    assert got == [("en", 1, "a b", big, 3 * big, 2 * big + 1, 9 * big, 10**6 * big * big // (3 * big * (2 * big + 1)))]


def test_pair_filter_never_loses_a_pair():
    hashes = np.array([1, 2, 3], np.uint64)
    keys = np.array([1 << 32 | 2, 2 << 32 | 1], np.int64)
    one, two = co._pair_hash("en", hashes, keys)
    assert one != two and (co._pair_hash("en", hashes, keys) == [one, two]).all()
