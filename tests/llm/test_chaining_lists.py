"""Steps of the passage search that handle many rows at once, against the same step one by one."""

import numpy as np
import pytest

from millrace.llm import chaining


def test_seeds_of_many_equal_seeds_of_each():
    rnd = np.random.default_rng(1)
    for sizes in ([8, 9, 50, 12], [300], [5, 7, 40], [50, 8, 6]):
        hashes = [rnd.integers(0, 2**63, n, np.uint64) if n != 40 else np.full(n, 7, np.uint64) for n in sizes]
        seed, pos, of = chaining._seeds_of_all(hashes)
        want = [(int(s), int(p), i) for i, h in enumerate(hashes) for s, p in zip(*chaining.seeds_of(h))]
        assert list(zip(seed.tolist(), pos.tolist(), of.tolist())) == want


def test_straight_chains_equal_align():
    rnd = np.random.default_rng(2)
    a, b, spans, want, n_alone = [], [], [], [], 0
    for _ in range(400):
        left, right = (int(n) for n in rnd.integers(0, 40, 2))
        at = np.cumsum(np.r_[0, rnd.integers(1, 25, rnd.integers(0, 6))])
        words = rnd.integers(0, 4, left + int(at[-1]) + chaining.K + right)
        other = np.where(rnd.random(len(words)) < rnd.choice([0.1, 0.4]), 9, words)
        for x in at:
            other[left + x : left + x + chaining.K] = words[left + x : left + x + chaining.K]
        want.append(chaining.align(words, other, at + left, at + left))
        a.append(words), b.append(other), spans.append((left, int(at[-1]) + chaining.K, right, at))
    starts = np.cumsum([0, *map(len, a[:-1])]) + np.array([s[0] for s in spans])
    left, inner, right = (np.array([s[i] for s in spans]) for i in range(3))
    sizes = np.array([len(s[3]) for s in spans])
    found = chaining.align_straight(np.concatenate(a), np.concatenate(b), starts, starts, left, inner, right, np.concatenate([s[3] for s in spans]), sizes)
    for i, (one, out_left, out_right, equal, wide) in enumerate(zip(*(f.tolist() for f in found))):
        assert one == (len(want[i]) == 1)
        if one:
            x0, x1 = left[i] - out_left, left[i] + inner[i] + out_right
            assert want[i] == [(x0, x1, x0, x1, equal, wide)]
        n_alone += not one
    assert 0 < n_alone < 400


@pytest.mark.parametrize("held", [1 << 22, 40])
def test_matches_by_bucket(spark, held):
    """Each seed with its first place and its latest place before, also where one seed has more places than a task holds."""
    rnd = np.random.default_rng(3)
    line = " ".join(f"l{i}" for i in range(20))
    texts = {d: f"{' '.join(f'w{w}' for w in rnd.integers(0, 10**6, 40))} {line} x{d} " + (f"{line} " * (d % 3)) for d in range(100)}
    texts |= {200: texts[7], 201: texts[8]}
    docs = spark.createDataFrame([*texts.items(), (200, texts[200]), (300, None), (None, texts[7])], "doc_id long, text string").repartition(4)
    places: dict = {}
    for d, text in sorted(texts.items()):
        for s, p in zip(*chaining.seeds_of(chaining.word_hashes(text))):
            places.setdefault(int(s), {}).setdefault(d, []).append(int(p))
    want = set()
    for by_doc in places.values():
        held_by = sorted(by_doc)
        for before, d in zip(held_by, held_by[1:]):
            want |= {(d, held_by[0], p, by_doc[held_by[0]][0]) for p in by_doc[d]} | {(d, before, p, by_doc[before][-1]) for p in by_doc[d]}
    read = []
    rows = chaining.matches(docs, 50, read, held).select("doc", "owner", "pos", "owner_pos").collect()
    assert {m for r in rows for m in zip(*r)} == want
    assert len(read) == (1 if held > 40 else 3)
    chaining.release(*read)


def test_search_shuffles_texts_a_bounded_number_of_times(spark, monkeypatch):
    """However far a passage goes on beyond its seeds, few rounds read it; each round joined every text again in each of its parts."""
    rnd = np.random.default_rng(4)
    seen, write = [], chaining.write_through
    monkeypatch.setattr(chaining, "write_through", lambda df, label: seen.append(label) or write(df, label))
    long = [f"w{w}" for w in rnd.integers(0, 10**6, 3000)]
    # Parts of the text stand in earlier documents, so most seeds lead elsewhere; 500 holds all of it, 600 repeats it.
    parts = [(k, " ".join(["x"] * 5 + long[20 * k : 20 * k + 26] + [f"y{k}_{i}" for i in range(40)])) for k in range(149)]
    again = [(501 + k, t) for k, t in parts if k != 75 and k != 76]
    docs = spark.createDataFrame([*parts, (500, "a b " + " ".join(long) + " c d"), *again[:99], (700, "e " + " ".join(long))], "doc_id long, text string")
    found = chaining.repeated_passages(docs).where("doc_id = 700").collect()
    covered = {w for r in found for w in range(r.passage_start, r.passage_end)}
    assert covered >= set(range(1, 3001))
    assert seen.count("chain-aligned") <= chaining.PARTS + 2
