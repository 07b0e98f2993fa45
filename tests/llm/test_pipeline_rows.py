"""The stages on odd rows: null ids, repeats, two texts under one id, null and empty texts, clashing names, empty tables."""

import corpus_pipeline
from pyspark.sql import functions as F

from tests.conftest import SF_DIR

A = "the quick brown fox jumps over the lazy dog near the old river bank today"
B = "another text altogether that speaks of boats and sails and of the wind at sea"
CLASH = ("_doc", "_spans", "row", "gone", "node", "root", "place", "bucket", "size", "kept", "rid", "fold", "score")


def _docs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    return df.withColumns({c: F.lit(c) for c in (*CLASH, "source")}).withColumn("n_chars", F.length("text").cast("long"))


def test_near_duplicates_decide_on_rows(spark):
    rows = [(1, A), (None, A), (3, A), (7, B), (7, B), (5, A + " indeed"), (5, "words of its own stand here and nowhere else at all"), (None, None), (9, None), (None, ""), (None, B)]
    docs = _docs(spark, rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns and {r["_spans"] for r in kept.collect()} == {"_spans"}
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(1, A), (7, B), (5, rows[6][1]), (None, None), (9, None), (None, "")], key=str)


def test_toxic_rows_go_and_clean_ones_with_their_id_stay(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = corpus_pipeline.drop_toxic(spark, docs, SF_DIR).select("doc_id")
    bad = [r["text"] for r in docs.join(left, "doc_id", "left_anti").orderBy("doc_id").collect()]
    assert len(bad) >= 3
    odd = [(None, bad[0]), (10**9, bad[1]), (10**9, A), (None, A), (10**9 + 1, bad[2]), (10**9 + 1, bad[2])]
    more = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumns({c: F.lit(c) for c in CLASH})
    kept = corpus_pipeline.drop_toxic(spark, more, SF_DIR)
    got = [(r["doc_id"], r["text"]) for r in kept.where("doc_id is null or doc_id >= 1000000000").collect()]
    assert sorted(got, key=str) == sorted([(10**9, A), (None, A)], key=str)


def test_repeats_are_cut_in_rows_without_an_id(spark):
    passage = " ".join(f"word{i}" for i in range(80))
    docs = _docs(spark, [(None, f"first start {passage}"), (None, f"second start here {passage} and an end"), (4, None), (4, "")])
    kept = corpus_pipeline.cut_repeats(spark, docs, SF_DIR)
    got = {r["text"]: r for r in kept.collect()}
    cut = [t for t in got if t and t.startswith("second")]
    assert kept.columns == docs.columns and kept.count() == 4
    assert len(cut) == 1 and "word40" not in cut[0] and cut[0].endswith("and an end") and got[cut[0]]["n_chars"] == len(cut[0])


def test_empty_table(spark):
    docs = _docs(spark, []).limit(0)
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, SF_DIR).count() == 0, name


def test_stages_leave_few_copies(spark):
    """Toxicity writes no copy of the rows, near duplicates leave only what their result reads."""
    from pathlib import Path

    root = Path(spark.conf.get("spark.checkpoint.dir"), "millrace")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for stage, left in ((corpus_pipeline.drop_toxic, {"pipeline-rejected", "toxicity-train"}), (corpus_pipeline.drop_near_duplicates, {"pipeline-rows", "minhash-signatures", "minhash-named"})):
        before = set(root.glob("*"))
        n = stage(spark, docs, SF_DIR).count()
        assert {p.name.rpartition("-")[0] for p in set(root.glob("*")) - before} == left and 0 < n <= docs.count()


def test_rows_in_files_are_numbered_without_a_copy(spark, tmp_path):
    """Near duplicates and repeats write no text of rows that lie in files: file by file, in order, each row once."""
    from pathlib import Path

    passage = " ".join(f"word{i}" for i in range(80))
    rows = [(1, A), (1, A), (None, A), (3, f"first start {passage}"), (4, f"second start here {passage} and an end"), (4, None), (5, ""), (6, B), (6, B)]
    _docs(spark, rows).repartition(3, "text").write.parquet(str(tmp_path / "a b%20c"))
    docs = spark.read.parquet(str(tmp_path / "a b%20c"))
    numbered = corpus_pipeline._numbered(docs)
    assert numbered.columns == ["doc_id", "text", "row"]
    got = sorted((r.doc_id, r.row.doc_id, r.text) for r in numbered.collect())
    assert [r[0] for r in got] == list(range(len(rows))) and sorted([r[1:] for r in got], key=str) == sorted(rows, key=str)
    assert [r[1:] for r in got] == [(r.doc_id, r.text) for r in docs.collect()]
    root = Path(spark.conf.get("spark.checkpoint.dir"), "millrace")
    for stage, n in ((corpus_pipeline.drop_near_duplicates, 5), (corpus_pipeline.cut_repeats, len(rows))):
        before = set(root.glob("*"))
        assert stage(spark, docs, SF_DIR).count() == n, stage
        made = set(root.glob("*")) - before
        assert not [p for p in made if "text" in spark.read.parquet(str(p)).columns], stage


def test_a_file_read_twice_and_rows_from_elsewhere(spark, tmp_path):
    _docs(spark, [(1, A), (2, B)]).write.parquet(str(tmp_path / "docs"))
    once = spark.read.parquet(str(tmp_path / "docs"))
    twice = spark.read.parquet(str(tmp_path / "docs"), str(tmp_path / "docs"))
    for docs, n in ((twice, twice.count()), (once.unionByName(once), 4), (once.where("doc_id = 2"), 1), (once.join(spark.range(3)), 6)):
        found = [r.doc_id for r in corpus_pipeline._numbered(docs).collect()]
        assert len(found) == len(set(found)) == n
        assert corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).count() == min(n, 2)
