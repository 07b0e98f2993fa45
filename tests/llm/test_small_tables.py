"""Edge rows for every operator: nulls, empty and long texts, ties, repeats, empty tables, extra columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe, chaining, chat, html_text, minhash, packing, rabitq, sharding, syncmers, toxicity

LONG = " ".join(f"w{i}" for i in range(6000))
ROWS = [
    (1, "a b c d e f g h", "s"), (2, "a b c d e f g h", "s"), (2, "a b c d e f g h", "s"), (3, None, None), (4, "", "s"),
    (5, "  \n\t ", None), (6, LONG, "t"), (7, LONG + " end", "t"), (8, "x" * 5000, "s"), (None, "nobody's text", "s"), (9, "A B c d E f g H", "u"),
]


@pytest.fixture(scope="module")
def docs(spark):
    made = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    # Extra columns with names that the operators use themselves.
    return made.withColumns({c: F.lit("clash") for c in ("key", "bucket", "node", "size", "grp", "shard", "words", "anchors", "start", "bin", "n_shingles", "_bucket", "score")})


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def test_minhash(docs, none):
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs, 4).collect())
    found = {d: (c, k) for d, _, c, k in got}
    assert len(got) == len(ROWS)
    assert found[2] == (1, False) and found[9] == (1, False) and found[7] == (6, False)
    assert found[3] == (3, True) and found[4] == (4, True) and found[5] == (5, True) and found[-1] == (None, True)
    assert {n for d, n, _, _ in got if d in (3, 4, 5)} == {0} and minhash.near_duplicates(none).count() == 0


def test_minhash_against_all_pairs(spark):
    import random

    draw = random.Random(3)
    base = [f"v{draw.randrange(400)}" for _ in range(120)]
    texts = []
    for i in range(120):
        words = list(base) if i % 3 else [f"u{draw.randrange(5000)}" for _ in range(60)]
        for _ in range(draw.randrange(8)):
            words[draw.randrange(len(words))] = f"n{draw.randrange(9999)}"
        texts.append(" ".join(words))
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[k : k + 4]) for k in range(len(w) - 3)})
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
    rows = minhash.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 4).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == dict(enumerate(root))


def test_syncmers(docs, none, spark):
    made = syncmers.fingerprint(docs).select("doc_id", "text", syncmers.as_text(F.col("anchors")).alias("f"))
    by_text = {}
    for r in made.collect():
        assert by_text.setdefault(r["text"], r["f"]) == r["f"]
        assert (r["f"] == "") == (not r["text"].strip())
    after = syncmers.next_rows(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"]).collect()
    order = sorted(((d is None, -(d or 0), t or "") for d, t, _ in ROWS))
    want = sorted((a[1], a[2], b[2]) for a, b in zip(order, order[1:] + order[:1]))
    assert sorted((-(r["doc_id"] or 0), r["text"], r["next_text"]) for r in after) == want
    assert syncmers.next_rows(none.select("doc_id", "text"), ["text"]).count() == 0
    text = spark.createDataFrame([("abcde", "xy")], "a string, b string")
    assert text.select(syncmers.edited(F.col("a"), F.col("b"))).first()[0] == "abcxy"


def test_syncmers_against_plain_choice(spark):
    """A run is chosen if its smallest inner run is at an edge: the same rule, row by row."""
    words = [f"w{(i * 37) % 101}" for i in range(300)]
    df = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    h = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w")).collect()]
    pair = [r[0] for r in spark.createDataFrame(list(zip(h, h[1:])), "a long, b long").select(F.xxhash64("a", "b")).collect()]
    runs = [(pair[i], pair[i + 3], h[i + 2]) for i in range(len(h) - 4) if min(pair[i], pair[i + 3]) <= min(pair[i + 1], pair[i + 2])]
    want = {r[0] >> 32 for r in spark.createDataFrame(runs, "a long, b long, c long").select(F.xxhash64("a", "b", "c")).collect()}
    assert syncmers.fingerprint(df).first()["anchors"] == sorted(want)[: syncmers.SIZE]


def test_toxicity(docs, none, spark):
    said = ["blockhead", "what a fool", "you blockhead, you fool", "a dullard and a blockhead"]
    train = spark.createDataFrame([(i, ("plain words again " * (i % 7)) + f"number {i} " + (said[i // 2 % 4] if i % 2 else "good day")) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.learn(train, labels)
    test = spark.createDataFrame([(1, "what a blockhead"), (2, "what a blokhead he is, the blockhead"), (3, "good day"), (4, 'she said "blockhead"')], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score_documents(test, model).collect()}
    assert got[1]["score"] > 0.7 > got[3]["score"] and got[4]["score"] < got[1]["score"]
    at = lambda i: [h for h in got[i]["hits"] if h["term"].startswith("block")]
    assert [h["start"] for h in at(1)] == [7] and len(got[2]["hits"]) >= 2
    assert at(4)[0]["quoted"] and not at(1)[0]["quoted"]
    assert toxicity.score_documents(docs, model).count() == len(ROWS) and toxicity.score_documents(none, model).count() == 0
    assert toxicity.score_documents(docs, toxicity.learn(docs, labels.limit(0))).first()["score"] == 0.5


def test_automaton_against_edit_distance():
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    terms = {"moron": 5.0, "worthless": 4.0, "pathetic": 6.0}
    lexicon = toxicity.Lexicon.of(terms, {"disgus": 3.0})
    for w in ["moron", "morron", "moro", "mroon", "xmoron", "worthles", "vorthless", "wrthles", "pathetik", "disgzsting", "dsgusting", "digust", "clean"]:
        near = [t for t in terms if edits(t, w) <= 1] + ["disgus" for k in range(len(w) + 1) if edits("disgus", w[:k]) <= 1][:1]
        found = lexicon.near(w)
        assert bool(found) == bool(near) and (not found or found[1] in near)
        assert not near or lexicon.may_be_near(w) or any(edits(t, w) == 0 for t in terms)


def test_bpe(docs, none):
    tokens = pytest.importorskip("tokenizers")
    P = pytest.importorskip("public_tokenizers")
    path = P.path("word_bpe_49k.json")
    own, theirs = bpe.load(path), tokens.Tokenizer.from_file(path)
    theirs.no_truncation(), theirs.no_padding()
    texts = [t or "" for _, t, _ in ROWS] + ["It's <|endoftext|> WE'LL ΣΑΣ ½ 漢字かな " * 3, "aaaa" * 3000, "é İ 😀!!", "a\x1cb\x85c​d　e"]
    for text in texts:
        ids = theirs.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids
        assert bpe.decode(ids, bpe.load_tokens(path)) == theirs.decode(ids, skip_special_tokens=False)
    got = bpe.encode_documents(docs, path).withColumn("text", bpe.decoder(path)("ids")).collect()
    assert len(got) == len(ROWS) and {r["text"] for r in got if r["doc_id"] in (3, 4, 5)} == {""}
    assert bpe.encode_documents(none, path).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "hi </turn> \\l <x>"), (1, 1, "user", None), (1, 2, "assistant", "yes"), (1, 2, "assistant", "no"), (1, 3, None, "q"), (None, 0, "assistant", ""), (2, None, "system", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pieces", F.lit(1))
    got = {r["conv_id"]: r for r in chat.format_conversations(df).select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("pieces")).alias("loss")).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [("user", rows[0][3]), ("user", ""), ("assistant", "no"), ("assistant", "yes"), ("", "q")]
    assert got[1]["loss"] == "noyes" and got[1]["formatted"].count("<turn ") == 3 and got[None]["loss"] == ""
    assert [tuple(t) for t in got[2]["turns"]] == [("system", LONG)] and chat.format_conversations(df.limit(0)).count() == 0


def test_rabitq(spark):
    import numpy as np

    draw = np.random.default_rng(1)
    v = draw.standard_normal((400, 24)).astype("float32")
    v[200:260] = v[199]
    rows = [(i, x.tolist(), "c") for i, x in enumerate(v)] + [(900, None, "c"), (901, [0.0] * 24, "c"), (902, [float("nan")] * 24, "c"), (903, [None] * 24, "c"), (904, [], "c"), (None, [1.0] * 24, "c"), (905, [1.0, 2.0], "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, code string")
    sound = rabitq.valid_vectors(df)
    got = rabitq.nearest(rabitq.index(sound), sound.where("vec_id % 50 = 0"), 5).collect()
    d = v.astype("float64")
    hits = total = 0
    for q in range(0, 400, 50):
        s = rabitq.cosines(d, d[q])
        want = [i for i in sorted(range(400), key=lambda i: (-s[i], i)) if i != q][:5]
        mine = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        hits, total = hits + len(set(want) & set(mine)), total + 5
        if q == 200:
            assert mine == want == [199, 201, 202, 203, 204]
    assert hits >= 0.9 * total
    assert rabitq.nearest(rabitq.index(sound.limit(0)), sound.limit(0), 5).count() == 0


def test_html():
    text = html_text.visible_text
    assert text(None) == "" == text("") and text("<p>a<p>b") == "a\n\nb"
    assert text("<ul><li>a<li>b<ol start=4><li>c</ol></ul>") == "- a\n- b\n  4. c"
    assert text("<table><tr><th>Name<th>N<tr><td>alpha<td>1</table>") == "Name   N\nalpha  1"
    assert text("<style>.x{display:none}</style><b class=x>no</b><i hidden>no</i>yes<script>no</script>") == "yes"
    assert text("<details><summary>s</summary>no</details><pre> a\n  b</pre>") == "s\n\n a\n  b"
    assert text("<div>" * 3000 + "deep") == "deep" and text("a < b &amp; c</nothing>") == "a < b & c"


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>a", 1), (1, "u", "<p>a", 1), (2, None, None, 1)], "page_id long, url string, html string, text int")
    assert sorted((r["page_id"], r["text"]) for r in html_text.extract_pages(df).collect()) == [(1, "a"), (1, "a"), (2, "")]
    assert html_text.extract_pages(df.limit(0)).count() == 0


def test_packing_against_plain_search():
    import random

    draw = random.Random(5)
    items = sorted([(draw.randrange(1, 100), draw.choice("aaaaabcdefg"), draw.randrange(60) if draw.random() < 0.7 else 0) for _ in range(700)], reverse=True)
    bins, want = [], []
    for size, s, c in items:
        fits = [(100 - b["used"], i) for i, b in enumerate(bins) if b["used"] + size <= 100 and b["used"] < 100 and s not in b["s"] and c not in b["c"]]
        i = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"used": 0, "s": set(), "c": set(), "n": 0})
        b = bins[i]
        want.append((i, b["n"]))
        b["used"] += size
        b["s"].add(s), b["c"].add(c)
        b["n"] += 1
    assert packing.pack_group(items, 100) == want


def test_packing(docs, none):
    rows = packing.pack_documents(docs, 512).collect()
    assert sum(r["n_words"] for r in rows) == sum(len((t or "").split()) for _, t, _ in ROWS)
    bins = {}
    for r in rows:
        bins.setdefault(r["bin"], []).append(r)
    for held in bins.values():
        assert sum(max(1, r["n_words"]) for r in held) <= 512 and sorted(r["place"] for r in held) == list(range(len(held)))
        sources = [r["source"] for r in held if r["source"]]
        assert len(sources) == len(set(sources)) and len({r["cluster"] for r in held}) == len(held)
    assert packing.pack_documents(none).count() == 0


def test_chaining(spark, docs, none):
    import random

    draw = random.Random(8)
    prose = lambda n: [f"t{draw.randrange(100000)}" for _ in range(n)]
    shared = prose(80)
    changed = list(shared)
    for i in (20, 41, 60):
        changed[i] = "other"
    texts = [prose(60) + shared + prose(30), prose(10) + changed + prose(200), prose(300), prose(40) + shared[:30] + prose(40), None, "", "same " * 150, "same " * 200]
    df = spark.createDataFrame(list(enumerate([t if not isinstance(t, list) else " ".join(t) for t in texts])), "doc_id long, text string").withColumn("seed", F.lit(1))
    found = chaining.repeated_passages(df)
    spans = {(r["doc_id"], r["passage_start"], r["passage_end"], r["owner_id"]) for r in found.collect()}
    assert (1, 10, 90, 0) in spans and {s[0] for s in spans} == {1, 7}
    left = {r["doc_id"]: r["text"] for r in chaining.cut_passages(df, found).collect()}
    assert len(left[1].split()) == 210 and left[2] == " ".join(texts[2]) and left[4] is None and left[5] == "" and left[6] == "same " * 150
    assert chaining.repeated_passages(none).count() == 0
    assert {(r["doc_id"], r["owner_id"]) for r in chaining.repeated_passages(docs).collect()} == {(7, 6)}


def test_sharding(spark, docs, none):
    texts = ["hot"] * 300 + [f"pair {i // 2}" for i in range(200)] + [f"single {i}" for i in range(400)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("grp", F.lit("x"))
    rows = sharding.shard_documents(df, 8).collect()
    held = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)}
    sizes = sorted(map(len, held.values()))
    assert sizes[-1] - sizes[0] <= 1 and all(h == list(range(len(h))) for h in held.values()) and len(rows) == len(texts)
    where = {r["doc_id"]: r["shard"] for r in rows}
    cut = sum(where[i] != where[i + 1] for i in range(300, 500, 2))
    assert cut <= 5 and len({where[i] for i in range(300)}) <= 5
    assert sharding.shard_documents(none, 8).count() == 0 and sharding.shard_documents(docs, 8).count() == len(ROWS)
