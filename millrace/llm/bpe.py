"""BPE encoding with forced boundaries, and decoding.

A merge joins neighbouring symbols only into a token of the vocabulary. So where two symbols
stand side by side in a word but in no token of the vocabulary, no merge can ever join them:
that place is a certain cut. A word is cut there, its fragments are encoded independently, and
the ids are concatenated; a task remembers the ids of words. Long fragments are merged with a heap
over a linked list, so a text without spaces costs n log n.

Defined results: null and empty texts have no ids and decode to the empty text; texts of any
length are encoded whole; repeated rows and other columns pass through.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

#: Words remembered by one task (at most twice as many), and the longest word worth remembering.
REMEMBERED = 150_000
LONGEST = 64
#: Fragments up to this many symbols are merged by plain search.
SHORT = 32
#: Rows handled at a time.
STEP = 512


# What the tokenizers library, whose classes follow Unicode 16, takes for neither letter
# nor number although ``regex`` already does; and lower case that it knows and Python 15.1 does not.
NEWER = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF4), (0x16FF5, 0x16FF6),
    (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128),
    (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
)
LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B}
LOWER |= {c: c + 0x20 for c in range(0x10D50, 0x10D66)} | {c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}
_NEWER = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NEWER) + "]")
_ODD = re.compile(_NEWER.pattern[:-1] + "".join(map(chr, LOWER)) + "]")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones are themselves, others follow from 256."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(printable)))
    return [letters[b] for b in range(256)]


class _Ids(dict):
    """Ids of words met lately, as int32 bytes. When full, the words stay at hand until it is full again; those met by then go on."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, word: str) -> bytes:
        found = self.before.get(word)
        if found is None:
            found = self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.before = dict(self)
                self.clear()
            self[word] = found
        return found


class WordBpe:
    """Encoder and decoder for one tokenizer file (BPE with word ends, lower case)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.letters = _byte_letters()
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\t-\r \x85\p{Z}"))
        self.marks = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.inside: set[tuple[str, str]] = set()
        for token in self.ids:
            symbols = self._symbols(token.removesuffix(self.end), token.endswith(self.end))
            self.inside.update(zip(symbols, symbols[1:], strict=False))
        self.words = _Ids(self.word)

    def _symbols(self, letters: str, closed: bool) -> list[str]:
        symbols = list(letters)
        if closed and symbols:
            symbols[-1] += self.end
        return symbols

    def _merge_short(self, items: list[str]) -> bytes:
        """As ``_merge``, by looking at all pairs after each step: quicker for few symbols."""
        ranks, worst = self.ranks, len(self.ranks)
        found = [ranks.get(p, worst) for p in zip(items, items[1:])]
        while found and (best := min(found)) < worst:
            i = found.index(best)
            items[i] += items.pop(i + 1)
            del found[i]
            if i:
                found[i - 1] = ranks.get((items[i - 1], items[i]), worst)
            if i < len(found):
                found[i] = ranks.get((items[i], items[i + 1]), worst)
        return array("i", [self.ids[x] for x in items]).tobytes()

    def _merge(self, symbols: list[str]) -> bytes:
        """Ids of one fragment: the best-ranked pair is joined first, the leftmost of equal ones."""
        if len(symbols) <= SHORT:
            return self._merge_short(symbols)
        items, n = list(symbols), len(symbols)
        after = [*range(1, n), -1]
        before = list(range(-1, n - 1))
        alive = [True] * n
        ranks = self.ranks
        heap = [(r, i, items[i], items[i + 1]) for i in range(n - 1) if (r := ranks.get((items[i], items[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or items[i] != a or items[j] != b:
                continue
            items[i] = a + b
            alive[j] = False
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := ranks.get((items[i], items[k]))) is not None:
                    heapq.heappush(heap, (r, i, items[i], items[k]))
            h = before[i]
            if h >= 0 and (r := ranks.get((items[h], items[i]))) is not None:
                heapq.heappush(heap, (r, h, items[h], items[i]))
        ids = self.ids
        return array("i", [ids[items[i]] for i in range(n) if alive[i]]).tobytes()

    def word(self, word: str) -> bytes:
        """Ids of one word as int32 bytes."""
        symbols = self._symbols("".join([self.letters[b] for b in word.encode()]), True)
        inside, out, start = self.inside, [], 0
        for i in range(1, len(symbols) + 1):
            if i == len(symbols) or (symbols[i - 1], symbols[i]) not in inside:
                out.append(self._merge(symbols[start:i]))
                start = i
        return b"".join(out)

    def _plain(self, text: str, out: list[bytes]) -> None:
        odd = False
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            odd = _ODD.search(text) is not None
        out.extend(map(self.words.__getitem__, self._odd_pieces(text) if odd else self.pieces.findall(text.lower())))

    def _odd_pieces(self, text: str) -> list[str]:
        """Pieces of a text with characters of ``_ODD``: newer ones stand as a sign that is neither letter nor number."""
        text = text.translate(LOWER).lower()
        return [text[m.start() : m.end()] for m in self.pieces.finditer(_NEWER.sub("\x01", text))]

    def encode(self, text: str | None) -> np.ndarray:
        out: list[bytes] = []
        if text:
            at = 0
            for mark in self.marks.finditer(text) if self.marks else ():
                self._plain(text[at : mark.start()], out)
                out.append(array("i", [self.special[mark.group()]]).tobytes())
                at = mark.end()
            self._plain(text[at:] if at else text, out)
        return np.frombuffer(b"".join(out), dtype=np.int32)


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


@lru_cache(maxsize=2)
def _token_column(path: str) -> pa.Array:
    return pa.array(load_tokens(path), pa.large_string())


@lru_cache(maxsize=2)
def load_tokens(path: str) -> list[str]:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    known = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    tokens = [""] * (max(known.values()) + 1)
    for token, i in known.items():
        tokens[i] = token
    return tokens


def decode(ids, tokens: list[str]) -> str:
    """Tokens joined by a space: the file states no decoder of its own."""
    return " ".join([tokens[i] for i in ids])


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every whole text; ``path`` is a tokenizer file that every executor can read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in (whole.slice(at, STEP) for whole in batches for at in range(0, len(whole), STEP)):
            found = [bpe.encode(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *found])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decoder(path: str):
    """A column function: ids to the decoded text."""

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        tokens, out = _token_column(path), [pa.array([], pa.string())]
        for at in range(0, len(ids), STEP):  # as ``decode``, for the rows of a step at once
            part = ids.slice(at, STEP)
            ends = pc.subtract(part.offsets, part.offsets[0])
            out.append(pc.binary_join(pa.ListArray.from_arrays(ends, pc.take(tokens, part.flatten())), pa.scalar(" ", pa.large_string())).cast(pa.string()))
        return pa.concat_arrays(out)

    return decoded


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by one space."""
    return F.array_join(ids.cast("array<string>"), " ")
