"""Chaining by short cuts and step by step; what operators leave in the shared folder; large batches in steps."""

from pathlib import Path

import numpy as np
import pyarrow as pa

from millrace.llm import bpe, chaining, minhash


def slow_chain(x, y, monkeypatch):
    monkeypatch.setattr(chaining, "K", chaining.K)  # the search itself, without the short cut
    return chaining.chain(np.r_[x, x[-1] + 10_000], np.r_[y, 0])


def test_matches_in_step_make_one_chain(monkeypatch):
    rnd = np.random.default_rng(3)
    for _ in range(200):
        x = np.cumsum(rnd.integers(1, 25, rnd.integers(2, 40))) + 50
        y = x + int(rnd.integers(-20, 20))
        whole = [list(range(len(x)))]
        assert chaining.chain(x, y) == whole
        # A far match that fits no chain keeps the short cut out.
        assert sorted(slow_chain(x, y, monkeypatch), key=len) == [[len(x)], *whole]


def test_alignment_in_step_equals_word_by_word():
    rnd = np.random.default_rng(5)
    for _ in range(200):
        a = rnd.integers(0, 4, 120)
        b = np.where(rnd.random(120) < 0.4, 9, a)
        at = np.unique(rnd.integers(20, 90, rnd.integers(1, 8)))
        out, first, equal, columns = [], 0, 0, 0
        for i in range(1, len(at) + 1):
            same, wide = (int((a[at[i - 1] : at[i]] == b[at[i - 1] : at[i]]).sum()), int(at[i] - at[i - 1])) if i < len(at) else (0, 0)
            if i == len(at) or wide > 2 * chaining.K and 2 * same < wide:
                x0, x1 = int(at[first]), int(at[i - 1]) + chaining.K
                left, right = chaining._outwards((a[:x0] == b[:x0])[::-1]), chaining._outwards(a[x1:] == b[x1:])
                out.append((x0 - left[0], x1 + right[0], x0 - left[0], x1 + right[0], equal + chaining.K + left[1] + right[1], columns + chaining.K + left[0] + right[0]))
                first, equal, columns = i, 0, 0
            else:
                equal, columns = equal + same, columns + wide
        assert chaining.align(a, b, at, at) == out


def test_passages_leave_only_what_they_read(spark):
    root = Path(spark.conf.get("spark.checkpoint.dir"), "millrace")
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(["x", *words[50:300], "y"])), (3, "short")], "doc_id long, text string")
    before = {p.name for p in root.glob("chain-*")}
    found = chaining.repeated_passages(docs)
    assert [(r.doc_id, r.start, r.end, r.owner_id) for r in found.collect()] == [(2, 1, 251, 1)]
    left = {p.name.split("-")[1] for p in root.glob("chain-*") if p.name not in before}
    assert left == {"pieces"}


def test_batches_are_taken_in_steps(spark):
    batch = pa.record_batch({"node": pa.array(range(1300), pa.int64())})
    parts = list(minhash._steps(iter([batch])))
    assert [len(p) for p in parts] == [512, 512, 276] and pa.Table.from_batches(parts).column("node").to_pylist() == list(range(1300))
    docs = spark.range(1500).selectExpr("id as doc_id", "concat_ws(' ', 'a', 'b', 'c', 'd', cast(id % 1400 as string)) as text")
    assert minhash.signatures(docs, 4).where("n_shingles = 2").count() == 1500


def test_words_met_lately_are_remembered(monkeypatch):
    """A full memory keeps its words until it is full again; long words are not kept."""
    made = []
    ids = bpe._Ids(lambda w: made.append(w) or w.encode())
    monkeypatch.setattr(bpe, "REMEMBERED", 2)
    long = "x" * (bpe.LONGEST + 1)
    words = ["a", "a", "b", long, "c", "a", "d", "a", "e", "b"]
    assert [ids[w] for w in words] == [w.encode() for w in words]
    assert made == ["a", "b", long, "c", "d", "e", "b"] and len(ids) <= 2 and len(ids.before) <= 2


def test_rows_decoded_together_are_decoded_alone(spark, monkeypatch):
    """Special tokens, odd characters, empty and null texts, more rows than a step."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    own, tokens = bpe.WordBpe(path), bpe.load_tokens(path)
    mark = next(iter(own.special))
    texts = ["Hello, hello World!", None, "", f"{mark}a{mark} b c {mark}", "\u03a3\u03a3 \u6f22\u5b57 12", "x" * 300, f"no{mark.upper()}", "   "] * 150
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    made = bpe.encode_documents(rows, path).withColumn("decoded", bpe.decoder(path)("ids")).collect()
    assert {r.doc_id: (r.ids, r.decoded) for r in made} == {i: (own.encode(t).tolist(), bpe.decode(own.encode(t), tokens)) for i, t in enumerate(texts)}


def test_near_duplicates_thin_rows_without_python(spark):
    """Wanted nodes pass the filter, null ones don't, and no row goes through Python for it."""
    from millrace.llm import minhash

    nodes = spark.createDataFrame([(n,) for n in (-5, 0, 7, 2**62)], "node long")
    rows = spark.createDataFrame([(n, "x") for n in (-5, 0, 7, 2**62, None, *range(1000, 2000))], "node long, text string")
    found = minhash.only_nodes(rows, nodes)
    assert "InArrow" not in found._jdf.queryExecution().toString()
    got = [r.node for r in found.collect()]
    assert found.columns == ["node", "text"] and {-5, 0, 7, 2**62} <= set(got) and None not in got and len(got) < 10
    assert minhash.only_nodes(rows, nodes.where("false")).count() == 0


def test_near_duplicates_hand_few_rows_at_a_time_to_python(spark, monkeypatch):
    from millrace.llm import minhash

    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, write = spark.conf.get(name), minhash.write_through
    monkeypatch.setattr(minhash, "write_through", lambda df, label: seen.append(int(spark.conf.get(name))) or write(df, label))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert max(seen) <= 512 and spark.conf.get(name) == before


def test_shuffles_end_with_their_jobs(spark, monkeypatch):
    """No shuffle of an earlier job is on disk while the passages are searched, and what goes in or out stays as set."""
    import time

    from millrace.llm import chaining

    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before, write, seen = [spark.conf.get(n) for n in names], chaining.write_through, []
    tracked = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    held = set(tracked.keys().mkString(",").split(","))

    def watched(df, label):
        out, more = write(df, label), {""}
        for _ in range(50):  # Spark may take a moment
            more = set(tracked.keys().mkString(",").split(",")) - held - {""}
            if not more:
                break
            time.sleep(0.1)
        seen.append((label, [spark.conf.get(n) for n in names], more))
        return out

    monkeypatch.setattr(chaining, "write_through", watched)
    passage = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(n, f"{passage} end{n}") for n in (1, 2, 3)], "doc_id long, text string")
    assert {(r.doc_id, r.owner_id) for r in chaining.repeated_passages(docs).collect()} >= {(2, 1), (3, 1)}
    assert {label for label, _, _ in seen} >= {"chain-seeds", "chain-shared", "chain-slices", "chain-pieces"}
    assert not [s for s in seen if s[1] != ["true", "512"] or s[2]]
    assert [spark.conf.get(n) for n in names] == before


def test_near_duplicates_shuffles_end_with_their_jobs(spark, monkeypatch):
    """Neither copies nor checkpoints find shuffles of an earlier job on disk."""
    import time

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(name), []
    tracked = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    held = set(tracked.keys().mkString(",").split(","))

    def watched(make):
        def run(*args):
            out, more = make(*args), {""}
            for _ in range(50):  # Spark may take a moment
                more = set(tracked.keys().mkString(",").split(",")) - held - {""}
                if not more:
                    break
                time.sleep(0.1)
            seen.append((spark.conf.get(name), more))
            return out

        return run

    for helper in ("write_through", "cut_lineage", "components"):
        monkeypatch.setattr(minhash, helper, watched(getattr(minhash, helper)))
    docs = spark.createDataFrame([(n, f"a b c d e f g h i j k l m n o p q r s t u v w x y z {n % 3}") for n in range(9)], "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(docs).collect()} == {0}
    assert len(seen) > 5 and not [s for s in seen if s != ("true", set())] and spark.conf.get(name) == before
