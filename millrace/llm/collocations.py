"""Collocations from count streams that are kept sorted and read in lockstep.

Phrases of one word and more are counted exactly. The counts are then laid out twice, as a
stream in prefix order (words from the left) and one in suffix order (words from the right).
In prefix order a phrase stands directly before everything that begins with it, so one pass with
a stack of open phrases meets, for each phrase, the counts of all its first parts, and for each
open phrase its best right extension. The suffix order gives last parts and left extensions.
Both streams come out once per phrase and are merge-joined; no count is looked up by hash.

A stream is cut into parts of bounded size by range. What is open where a part begins are
prefixes of its first phrase, so the counts of those few are sent along with the part.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from millrace.session import write_through

#: A-Z to lower case; what ends a piece becomes a full stop.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + b"." * 9)
_END = re.compile(rb"[ \t.]")
#: Texts are cut into words in slices of so many bytes; so many words are counted at once, and so many remembered.
SLICE, WORDS_AT_ONCE, VOCABULARY = 1 << 20, 1 << 19, 1 << 18
#: Bits of the fixed filter of word pairs; pairs that share a bit only cost work.
FILTER_BITS = 26
#: Rows of a stream that one task reads.
PART_ROWS = 200_000
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class _Counter:
    """Word numbers of a task, and the phrases of the texts seen since the last flush, per language."""

    def __init__(self, max_words: int):
        self.max_words = max_words
        self.forget()

    def forget(self) -> None:
        self.words, self.numbers, self.runs, self.skips, self.held = [b"."], {b".": 0}, {}, {}, 0
        self._hashes, self._array = np.zeros(0, np.uint64), pa.array([], pa.binary())

    def _number(self, word: bytes) -> int:
        found = self.numbers.get(word)
        if found is None:
            found = self.numbers[word] = len(self.words)
            self.words.append(word)
        return found

    def add(self, lang: str, text: bytes | None) -> Iterator[tuple[str, np.ndarray, int]]:
        """Take a text in; yields (lang, word numbers, carried words) whenever enough words are held."""
        data = (text or b"").translate(_FOLD)
        at = 0
        while at < len(data):
            stop = _END.search(data, at + SLICE) if at + SLICE < len(data) else None
            end = stop.start() if stop else len(data)
            words = data[at:end].replace(b".", b" . ").split()
            self.runs.setdefault(lang, []).append(np.fromiter(map(self._number, words), np.int64, len(words)))
            self.held += len(words)
            at = end
            if self.held >= WORDS_AT_ONCE:
                yield from self.flush(open_lang=lang)
        self.runs.setdefault(lang, []).append(np.zeros(1, np.int64))

    def flush(self, open_lang: str | None = None) -> Iterator[tuple[str, np.ndarray, int]]:
        """All word numbers held. Of the language whose text goes on, the last words stay, to be carried."""
        runs, skips, self.runs, self.skips, self.held = self.runs, self.skips, {}, {}, 0
        for lang, parts in runs.items():
            ids = np.concatenate(parts)
            yield lang, ids, skips.get(lang, 0)
            if lang == open_lang:
                self.runs[lang] = [ids[len(ids) - min(len(ids), self.max_words - 1) :]]
                self.skips[lang] = len(self.runs[lang][0])

    def hashes(self) -> np.ndarray:
        """Hashes of all words; only those of new words are computed."""
        new = self.words[len(self._hashes) :]
        if new:
            self._hashes = np.concatenate([self._hashes, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))])
        return self._hashes

    def array(self) -> pa.Array:
        if len(self._array) < len(self.words):
            self._array = pa.array(self.words, pa.binary())
        return self._array


def _pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all word pairs, and one key for each."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    return at, ids[at] << 32 | ids[at + 1]


def _pair_hash(lang: str, hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (hashes[keys >> 32] * _MIX[0]) ^ (hashes[keys & 0xFFFFFFFF] + np.uint64(xxhash.xxh3_64_intdigest(lang)))
        h = (h ^ (h >> np.uint64(29))) * _MIX[1]
        return h ^ (h >> np.uint64(32))


def _runs_of(batches: Iterable[pa.RecordBatch], counter: _Counter) -> Iterator[tuple[str, np.ndarray, int]]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            yield from counter.add(lang, text.as_py())
            if len(counter.words) > VOCABULARY:
                yield from counter.flush()
                counter.forget()
    yield from counter.flush()


def _count_pairs(batches: Iterable[pa.RecordBatch], max_words: int) -> Iterator[pa.RecordBatch]:
    """(h, n): hashed word pairs, summed per flush."""
    counter = _Counter(max_words)
    for lang, ids, skip in _runs_of(batches, counter):
        at, keys = _pairs(ids)
        keys, n = np.unique(keys[at + 1 >= skip], return_counts=True)
        if len(keys):
            h = _pair_hash(lang, counter.hashes(), keys)
            yield pa.record_batch({"h": h.view(np.int64), "n": n.astype(np.int64)})


def _count_phrases(batches: Iterable[pa.RecordBatch], max_words: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, k, phrase, n): words, phrases whose word pairs all pass the filter, and the number of words as k = 0."""
    counter = _Counter(max_words)
    for lang, ids, skip in _runs_of(batches, counter):
        words = counter.array()
        new = ids[skip:]
        seen, n = np.unique(new[new > 0], return_counts=True)
        if not len(seen):
            continue
        yield _rows(lang, 0, pa.array([b""], pa.binary()), n.sum(keepdims=True))
        yield _rows(lang, 1, words.take(pa.array(seen)), n)
        at, keys = _pairs(ids)
        keys, code = np.unique(keys, return_inverse=True)
        slots = _pair_hash(lang, counter.hashes(), keys) >> np.uint64(64 - FILTER_BITS)
        passes = (bits[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) > 0
        at, code = at[passes[code]], code[passes[code]]
        parts = [words.take(pa.array(keys >> 32)), words.take(pa.array(keys & 0xFFFFFFFF))]
        phrases = pc.binary_join_element_wise(*parts, b" ")
        pair_at = np.zeros(len(ids), bool)
        pair_at[at] = True
        for k in range(2, max_words + 1):
            # at: where phrases of k words begin; code: which one, as an index of phrases.
            n = np.bincount(code[at + k - 1 >= skip], minlength=len(phrases))
            some = np.flatnonzero(n)
            if len(some):
                yield _rows(lang, k, phrases.take(pa.array(some)), n[some])
            if k < max_words:
                more = np.flatnonzero(pair_at[at + k - 1])
                keys, new_code = np.unique(code[more] << 32 | ids[at[more] + k], return_inverse=True)
                phrases = pc.binary_join_element_wise(phrases.take(pa.array(keys >> 32)), words.take(pa.array(keys & 0xFFFFFFFF)), b" ")
                at, code = at[more], new_code


def _rows(lang: str, k: int, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({
        "lang": pa.array([lang] * len(phrases), pa.string()), "k": pa.array(np.full(len(phrases), k, np.int32)),
        "phrase": phrases.cast(pa.string()), "n": pa.array(n.astype(np.int64)),
    })


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10) -> DataFrame:
    """(lang, k, phrase, n): all phrases of 1 to ``max_words`` words found ``min_count`` times, and all words of a language (k = 0).

    A phrase of three words and more can only be that frequent if its word pairs are. Pairs are
    counted as hashes first; those that reach the limit set a bit in a filter of fixed size
    (8 MB). Whole phrases are then counted as text, and only where the filter lets all their
    pairs pass: it spares work, and decides nothing.
    """
    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    pairs = read.mapInArrow(lambda batches: _count_pairs(batches, max_words), "h long, n long")
    slot = F.shiftrightunsigned("h", 64 - FILTER_BITS)
    filled = (
        pairs.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
        .groupBy(F.shiftright(slot, 6).alias("at"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))).alias("bits"))
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    found = filled.toArrow()
    bits[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    phrases = read.mapInArrow(lambda batches: _count_phrases(batches, max_words, shared.value), "lang string, k int, phrase string, n long")
    return phrases.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n")).where((F.col("n") >= min_count) | (F.col("k") == 0))


def _read_stream(backwards: bool):
    """A part of a stream, sorted by words from the left (or right), with what is open where it begins."""

    def read(part: pd.DataFrame, opened: pd.DataFrame) -> pd.DataFrame:
        known = {(r.open_lang, tuple(r.open_words)): r.open_n for r in opened.itertuples()}
        rows = sorted((r.lang, tuple(r.words), r.n) for r in part.itertuples())
        out, stack = [], []

        def close(lang, words, n, parts, best):
            phrase = " ".join(reversed(words) if backwards else words)
            out.append((lang, phrase, n, parts, best))

        for lang, words, n in rows:
            while stack and not (stack[-1][0] == lang and stack[-1][1] == words[: len(stack[-1][1])]):
                close(*stack.pop())
            while len(stack) < len(words) - 1:
                first = words[: len(stack) + 1]
                stack.append([lang, first, known[lang, first], None, 0])
            if stack:
                stack[-1][4] = max(stack[-1][4], n)
            stack.append([lang, words, n, [s[2] for s in stack], 0])
        while stack:
            close(*stack.pop())
        return pd.DataFrame(out, columns=["lang", "phrase", "n", "parts", "best"])

    return read


def _stream(counts: DataFrame, backwards: bool) -> DataFrame:
    """(lang, phrase, n, parts, best): counts of the 1, 2, ... outer words of each phrase, and of its best extension by a word.

    Forwards, parts are first words and extensions are to the right; backwards, the reverse.
    """
    words = F.split("phrase", " ")
    laid = counts.select("lang", (F.reverse(words) if backwards else words).alias("words"), "n")
    tasks = max(1, -(-counts.count() // PART_ROWS))
    placed = laid.repartitionByRange(tasks, "lang", "words").withColumn("part", F.spark_partition_id())
    placed = write_through(placed, "suffix-stream" if backwards else "prefix-stream")
    firsts = placed.groupBy("part").agg(F.min(F.struct("lang", "words")).alias("first")).select("part", "first.*")
    cut = F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.slice("words", 1, k))
    opening = firsts.where(F.size("words") > 1).select("part", "lang", F.explode(cut).alias("words"))
    opening = opening.toDF("open_part", "open_lang", "open_words")
    same = (F.col("lang") == F.col("open_lang")) & (F.col("words") == F.col("open_words"))
    opened = placed.join(opening, same).select("open_part", "open_lang", "open_words", F.col("n").alias("open_n"))
    read = placed.groupBy("part").cogroup(opened.groupBy("open_part")).applyInPandas(
        _read_stream(backwards), "lang string, phrase string, n long, parts array<long>, best long"
    )
    # A phrase that is open in several parts comes out of each; only one has its parts.
    return read.groupBy("lang", "phrase").agg(F.max("n").alias("n"), F.max("parts").alias("parts"), F.max("best").alias("best"))


def collocations(docs: DataFrame, top: int = 2000, max_words: int = 3, min_count: int = 10, percent: int = 50, salts: int = 64) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``max_words`` words: (lang, rank, phrase, a, l, r, n, score).

    Texts have A-Z lower-cased and are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at spaces
    and tabs into words. A phrase with a >= ``min_count`` occurrences is cut after each of its
    words; with l and r occurrences of the two parts the score is floor(10^6 a a / (l r)). The cut
    with the lowest score counts, ties the first one. Phrases that lie in a longer one with at
    least ``percent`` % of their occurrences are dropped. A phrase in a longer one lies in one that
    is a single word longer and at least as frequent, so extensions by a word decide.

    Null texts are empty, a null language is ``und``, each row counts, repeated or not. Rank
    is by score, then a (descending), then phrase in byte order. ``n`` is the number of words of
    the language. Other columns are not read. A language without such phrases has no rows.
    """
    counts = write_through(phrase_counts(docs, max_words, min_count), "phrase-counts")
    phrases = counts.where("k > 0").select("lang", "phrase", "n")
    left = _stream(phrases, backwards=False).select("lang", "phrase", F.col("n").alias("a"), F.col("parts").alias("firsts"), F.col("best").alias("right"))
    right = _stream(phrases, backwards=True).select("lang", "phrase", F.col("parts").alias("lasts"), F.col("best").alias("left"))
    both = left.join(right.hint("merge"), ["lang", "phrase"]).where(F.size("firsts") > 0)
    alone = both.where(100 * F.greatest("left", "right") < percent * F.col("a"))
    # Counts below 10^15 keep the products within 38 digits.
    exact = lambda c: c.cast("decimal(16,0)")
    a = exact(F.col("a"))

    def cut(k):
        l, r = F.get("firsts", k - 1), F.get("lasts", F.size("firsts") - k)
        share = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)"), exact(l) * exact(r))
        return F.struct(share.cast("long").alias("score"), k.alias("k"), l.alias("l"), r.alias("r"))

    scored = alone.select("lang", "phrase", "a", F.array_min(F.transform(F.sequence(F.lit(1), F.size("firsts")), cut)).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
    best = scored.withColumn("place", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("place") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    totals = counts.where("k = 0").select("lang", F.col("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
