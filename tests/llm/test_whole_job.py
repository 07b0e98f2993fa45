"""Cases that earlier forms of the corpus operators left out."""

import random

from pyspark.sql import functions as F

from millrace.llm import chaining, syncmers, toxicity


def _covered(found, doc):
    return {w for r in found if r["doc_id"] == doc for w in range(r["passage_start"], r["passage_end"])}


def _best_stretch(equal):
    """(start, end) of the shortest best sum with one for an equal word and minus two for another."""
    sums = {(a, b): sum(1 if e else -2 for e in equal[a:b]) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1)}
    return max(sums, key=lambda k: (sums[k], k[0] - k[1]))


def test_fuzzy_passages(spark):
    """Passages with 5 to 20 % changed words: all whose best stretch, by brute force, is long and alike enough."""
    draw = random.Random(11)
    prose = lambda n: [f"t{draw.randrange(100000)}" for _ in range(n)]
    rows, want = [], {}
    for n in (60, 100):
        for percent in (5, 10, 15, 20):
            for _ in range(15):
                shared = prose(n)
                changed = list(shared)
                for i in draw.sample(range(n), n * percent // 100):
                    changed[i] = f"new{draw.randrange(100000)}"
                a, b = _best_stretch([x == y for x, y in zip(shared, changed)])
                same = sum(x == y for x, y in zip(shared[a:b], changed[a:b]))
                rows.append((len(rows), " ".join(prose(40) + shared + prose(40))))
                if b - a >= chaining.MIN_WORDS and same >= chaining.ALIKE * (b - a):
                    want[len(rows)] = (n, percent, a, b)
                rows.append((len(rows), " ".join(prose(30) + changed + prose(50))))
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(n, p) for n, p, _, _ in want.values()} == {(n, p) for n in (60, 100) for p in (5, 10, 15, 20)}
    missing = {doc: (w, sorted(set(range(30 + w[2], 30 + w[3])) - _covered(found, doc))) for doc, w in want.items()}
    assert not {doc: m for doc, m in missing.items() if m[1]}


def test_passage_with_split_owners(spark):
    """Short parts of a passage stand in many earlier documents; document 50 holds it whole, 99 repeats it."""
    draw = random.Random(12)
    prose = lambda n: [f"t{draw.randrange(100000)}" for _ in range(n)]
    shared = prose(400)
    parts = [(k, " ".join(prose(30) + shared[12 * k : 12 * k + 16] + prose(30))) for k in range(34)]
    rows = [*parts, (50, " ".join(prose(20) + shared + prose(20))), (99, " ".join(prose(10) + shared + prose(10)))]
    # The rest of the passage is taken later too, so only a few seeds lead from 99 to 50.
    rows += [(60 + k, t) for k, t in parts[:32]]
    found = chaining.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert _covered(found, 99) >= set(range(10, 410))


def test_previous_places_across_tasks(spark):
    """A seed of all documents spans tasks; still every document finds the one before."""
    rows = [(7, d, p) for d in range(500) for p in range(d % 3 + 1)] + [(8, 3, 1), (8, 9, 4)]
    df = spark.createDataFrame(rows, "seed long, doc long, pos int").repartition(8)
    got = sorted(map(tuple, chaining.previous(df).select("doc", "owner", "pos", "owner_pos").collect()))
    assert got == sorted([(d, d - 1, p, (d - 1) % 3) for s, d, p in rows if s == 7 and d] + [(9, 3, 4, 1)])


def test_misspelled_terms_beyond_the_strongest():
    draw = random.Random(13)
    terms = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(1500)]
    lexicon = toxicity.Lexicon.of({t: 9 - i / 1000 for i, t in enumerate(terms[:1000])} | {terms[1000][:6] + "rest": 9.0}, {t[:6]: 3 - i / 1000 for i, t in enumerate(terms[1000:])})
    for i, t in enumerate(terms):
        for word in (t[:3] + t[4:], t[:2] + "é" + t[3:], t[:5] + "é" + t[5:]):
            assert (found := lexicon.find(word)) and found[1] == (t if i < 1000 else t[:6]), (i, t, word)
    assert lexicon.find(terms[1000][:6] + "rxst")[1] == terms[1000][:6]


def test_syncmers_keep_all_anchors_and_positions(spark):
    """One word changed in the middle of 5,000: only the runs around it change, and the rest keep their places."""
    words = [f"w{(i * 7919) % 4999}x{i % 13}" for i in range(5000)]
    edited = [*words[:2500], "other", *words[2501:]]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, "one two"), (4, "")]
    made = syncmers.fingerprint(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in made.withColumn("f", syncmers.placed_text(F.col("anchors_at"))).collect()}
    one, two = ([tuple(z) for z in got[i]["anchors_at"]] for i in (1, 2))
    assert len(one) > 2000 and [z[0] for z in one] == sorted({z[0] for z in one})
    off = set(one) ^ set(two)
    assert off and all(2496 <= at <= 2500 for at, _ in off)
    at, read = 0, []
    for part in got[1]["f"].split(" "):
        at += int(part[8:], 16)
        read.append((at, int(part[:8], 16)))
    assert read == [(at, h & 0xFFFFFFFF) for at, h in one]
    assert len(got[3]["anchors_at"]) == 1 and got[4]["anchors_at"] == [] and got[4]["f"] == ""
    both = spark.createDataFrame([([h for _, h in one], [h for _, h in two])], "a array<int>, b array<int>")
    a, b = {h for _, h in one}, {h for _, h in two}
    near = both.select(syncmers.likeness(F.array_distinct("a"), F.array_distinct("b"))).first()[0]
    assert near == len(a & b) / len(a | b) < 1
