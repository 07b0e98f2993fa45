"""Toxicity: a learned lexicon, Levenshtein automata over its trie, and context windows.

Learning counts in how many toxic and other documents each word and each word beginning (stem)
occurs and keeps all terms that mark toxic ones surely enough. Those of 5 letters (stems: 6) and
more form a trie, without words that begin with a stem in it. Every distinct word is run against
it as a Levenshtein automaton: its states are two bit sets (word positions reachable with no or
one edit), stepped along the branches of the trie and cut where both are empty, so misspelled terms are found without trying every term. A hit inside quotation
marks or after a word of reporting counts as quoted; a misspelled hit counts more when a certain
hit stands within its window. The sums of these hits feed a logistic model.

The lexicon and the model are fitted on at most ``train_rows`` labelled rows (a documented bound,
drawn by hash of doc_id); scoring covers every whole text. Texts are the only input of a score.

Defined results: null and empty texts have no hits and get the score of a text without any; with
no labelled row of one class the lexicon is empty and every score is 0.5; repeated rows get equal
scores; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from millrace.session import write_through

TRAIN_ROWS = 40_000
STEM_LENGTHS = (4, 5, 6)
#: Shortest words and stems that are matched with one edit.
FUZZY_WORD, FUZZY_STEM = 5, 6
WINDOW = 8
REMEMBERED = 500_000
WORD = re.compile(r"[^\W_](?:[\w@$*]*[^\W_])?")
QUOTES = {"“": "”", "«": "»", "„": "“", '"': '"'}
# Words of reporting in the four languages.
REPORTING = frozenset("said says wrote writes called quoted word term dit écrit mot terme appelé sagte schrieb wort nannte dijo escribió palabra término llamó".split())


@dataclass
class Lexicon:
    """Weighted words and stems, and the trie of those that are also matched with one edit."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    trie: dict = field(default_factory=dict)
    starts: dict[int, set[str]] = field(default_factory=dict)
    rests: dict[tuple[int, int], set[str]] = field(default_factory=dict)
    met: dict[str, tuple[float, str, int] | None] = field(default_factory=dict, repr=False)

    @staticmethod
    def of(words: dict[str, float], stems: dict[str, float]) -> Lexicon:
        strong = sorted([(-w, t, False) for t, w in words.items()] + [(-w, t, True) for t, w in stems.items()])
        made = Lexicon(words, stems)
        for weight, term, stem in [x for x in strong if len(x[1]) >= (FUZZY_STEM if x[2] else FUZZY_WORD)]:
            if not stem and any(term[:k] in stems for k in STEM_LENGTHS if k >= FUZZY_STEM):
                continue  # within one edit of the word is within one of its stem
            node = made.trie
            for c in term:
                node = node.setdefault(c, {})
            node[""] = (-weight, term, stem)
            half = len(term) // 2
            made.starts.setdefault(half, set()).add(term[:half])
            for at in (half - 1, half, half + 1):
                made.rests.setdefault((at, at + len(term) - half), set()).add(term[half:])
        return made

    def may_be_near(self, word: str) -> bool:
        """One edit leaves one half of a term as it is, and moves the second by one place at most."""
        for k, found in self.starts.items():
            if word[:k] in found:
                return True
        for (a, b), found in self.rests.items():
            if word[a:b] in found:
                return True
        return False

    def near(self, word: str) -> tuple[float, str, int] | None:
        """The strongest term within one edit of the word, or for a stem of one of its beginnings."""
        n = len(word)
        full = (1 << (n + 1)) - 1
        at: dict[str, int] = {}
        for i, c in enumerate(word):
            at[c] = at.get(c, 0) | (1 << i)
        best = None
        todo = [(self.trie, 1, 3)]
        while todo:
            node, none, one = todo.pop()
            for c, child in node.items():
                if c == "":
                    weight, term, stem = child
                    if (one if stem else one >> n) and (best is None or weight > best[0]):
                        best = (weight, term, 1)
                    continue
                m = at.get(c, 0)
                none2 = (none & m) << 1
                one2 = (((one & m) << 1) | (none << 1) | none | (none2 << 1)) & full
                if one2:
                    todo.append((child, none2, one2))
        return best

    def find(self, word: str) -> tuple[float, str, int] | None:
        """(weight, term, edits) of a lower-case word, if it is in the lexicon."""
        if word in self.met:
            return self.met[word]
        found = (self.words[word], word, 0) if word in self.words else None
        for k in STEM_LENGTHS:
            if len(word) >= k and (w := self.stems.get(word[:k])) and (found is None or w > found[0]):
                found = (w, word[:k], 0)
        if found is None and len(word) >= FUZZY_WORD - 1 and self.may_be_near(word):
            found = self.near(word)
        if len(self.met) >= REMEMBERED:
            self.met.clear()
        self.met[word] = found
        return found


def _quoted_spans(text: str) -> list[tuple[int, int]]:
    spans, closing, start = [], "", 0
    for m in re.finditer(r'[“”«»„"]', text):
        c = m.group()
        if closing and c == closing:
            spans.append((start, m.start()))
            closing = ""
        elif c in QUOTES and not closing:
            closing, start = QUOTES[c], m.start()
    return spans


def hits(text: str | None, lexicon: Lexicon) -> list[tuple[int, int, str, float, int, bool]]:
    """(start, end, term, weight, edits, quoted) of every hit in a whole text."""
    if not text:
        return []
    lower = text.lower()
    met, find = lexicon.met, lexicon.find
    if not any([met[w] if w in met else find(w) for w in set(WORD.findall(lower))]):
        return []
    if len(lower) != len(text):  # offsets are those of the lower-cased text, else of the text
        text = lower
    spans = _quoted_spans(text)
    found, recent, k = [], [], 0
    for m in WORD.finditer(lower):
        w = m.group()
        hit = find(w)
        if hit:
            while k < len(spans) and spans[k][1] < m.start():
                k += 1
            quoted = k < len(spans) and spans[k][0] < m.start() or any(r in REPORTING for r in recent)
            found.append((m.start(), m.end(), hit[1], hit[0], hit[2], quoted))
        recent = [*recent[-2:], w]
    return found


def features(text: str | None, lexicon: Lexicon, found=None) -> list[float]:
    found = hits(text, lexicon) if found is None else found
    sure = [h for h in found if h[4] == 0]
    abuse = sum(h[3] for h in sure if not h[5])
    quoted = sum(h[3] for h in sure if h[5])
    near = loose = i = 0
    for h in found:
        if h[4]:
            while i < len(sure) and sure[i][1] < h[0] - WINDOW * 8:
                i += 1
            close = i < len(sure) and sure[i][0] < h[1] + WINDOW * 8
            near, loose = near + close, loose + (not close)
    length = math.log1p(len(text or "") / 6)
    return [math.log1p(abuse), math.log1p(quoted), math.log1p(near), math.log1p(loose), max((h[3] for h in sure), default=0.0), math.log1p(len({h[2] for h in sure})), abuse / (1 + length), length]


@dataclass
class Model:
    lexicon: Lexicon
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + ((x - self.mean) / self.scale) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _term_counts(train: DataFrame) -> DataFrame:
    """(fold, term, n0, n1): documents of each label with each word ("w...") and stem ("s...")."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts: Counter = Counter()
            for fold, toxic, text in zip(batch["fold"], batch["toxic"], batch["text"]):
                words = set(WORD.findall((text or "").lower()))
                terms = {"w" + w for w in words if len(w) >= 3} | {"s" + w[:k] for w in words for k in STEM_LENGTHS if len(w) > k}
                counts.update((fold, toxic, t) for t in terms)
            if counts:
                yield pd.DataFrame([(f, t, n * (y == 0), n * (y == 1)) for (f, y, t), n in counts.items()], columns=["fold", "term", "n0", "n1"])

    return (
        train.select("fold", "toxic", "text")
        .mapInPandas(run, "fold int, term string, n0 long, n1 long")
        .groupBy("fold", "term")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    )


def _lexicon(counts: list, n0: int, n1: int) -> Lexicon:
    """Terms by how surely they mark toxic documents; stems go before words they cover."""
    terms: dict[str, list[int]] = {}
    for r in counts:
        a = terms.setdefault(r["term"], [0, 0])
        a[0] += r["n0"]
        a[1] += r["n1"]
    least = max(2, n1 // 300)
    rated = []
    for t, (a, b) in terms.items():
        odds = math.log((b + 0.5) / (n1 + 1)) - math.log((a + 0.5) / (n0 + 1))
        if b >= least and odds > 2.5 and b > 4 * a:
            rated.append((odds * math.sqrt(b), t, odds))
    rated.sort(reverse=True)
    stems: dict[str, float] = {}
    for _, t, odds in rated:
        if t[0] == "s" and not any(t[1 : 1 + k] in stems for k in STEM_LENGTHS):
            stems[t[1:]] = odds
    words = [(t[1:], odds) for _, t, odds in rated if t[0] == "w"]
    return Lexicon.of(dict(words), stems)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    penalty = ridge * np.eye(len(w))
    penalty[0, 0] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def _features_of(train: DataFrame, lexicons: dict[int, Lexicon]) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"toxic": batch["toxic"], "x": [features(t, lexicons[f]) for f, t in zip(batch["fold"], batch["text"])]})

    return train.select("fold", "toxic", "text").mapInPandas(run, "toxic int, x array<double>")


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on labelled documents: ``labels`` has (doc_id, toxic); rows with null in either are left out."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    share = min(1.0, train_rows / max(1, n))
    drawn = known.where(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else known
    fold = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)).cast("int")
    train = write_through(
        docs.select(F.col("doc_id"), "text").join(F.broadcast(drawn), "doc_id").select("toxic", "text", fold.alias("fold")).dropDuplicates(["text"]), "toxicity-train"
    )
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in train.groupBy("fold", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = lambda y, *folds: sum(sizes.get((f, y), 0) for f in folds)
    if not size(1, 0, 1) or not size(0, 0, 1):
        return Model(Lexicon(), np.zeros(8), np.ones(8), np.zeros(9))
    # Terms that can pass the limits of _lexicon in a fold or in both; their number is bounded by the training rows.
    useful = F.col("n1") > 4 * F.col("n0")
    counts = _term_counts(train).where(useful & (F.col("n1") >= max(1, min(size(1, 0), size(1, 1)) // 600))).collect()
    per = {f: [r for r in counts if r["fold"] == f] for f in (0, 1)}
    # Each half is described by the lexicon of the other, so the model sees honest hits.
    crossed = {0: _lexicon(per[1], size(0, 1), size(1, 1)), 1: _lexicon(per[0], size(0, 0), size(1, 0))}
    rows = _features_of(train, crossed).collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float)
    return Model(_lexicon(counts, size(0, 0, 1), size(1, 0, 1)), *_fit(x, y))


def score_documents(docs: DataFrame, model: Model, limit: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted, hits) of every whole text; hits are (start, end, term, edits, quoted)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [hits(t, model.lexicon) for t in batch["text"]]
            x = np.array([features(t, model.lexicon, h) for t, h in zip(batch["text"], found)]).reshape(len(batch), 8)
            yield pd.DataFrame({
                "doc_id": batch["doc_id"],
                "score": model.score(x),
                "hits": [[{"start": h[0], "end": h[1], "term": h[2], "edits": h[4], "quoted": h[5]} for h in one] for one in found],
            })

    span = "array<struct<start:int,end:int,term:string,edits:int,quoted:boolean>>"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(run, f"doc_id long, score double, hits {span}").withColumn("predicted", (F.col("score") >= limit).cast("int"))
