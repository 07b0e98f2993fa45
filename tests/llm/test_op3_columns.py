"""op3's edited text, and both likenesses, against the same by hand."""

import hashlib

from millrace.llm import queries, syncmers


def test_edited_and_likeness(spark, tmp_path):
    texts = {1: "one two three four five six seven eight nine ten " * 3, 2: "été à la mer", 3: None, 4: "", 5: "one two three four five six seven eight nine ten " * 3, 7: "x", 9: "word " * 400}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op3_syncmers"](spark, str(tmp_path)).collect()}
    order = sorted(texts, reverse=True)
    edited, after = {}, {}
    for doc, other in zip(order, order[1:] + order[:1]):
        own, next_text, after[doc] = texts[doc] or "", texts[other] or "", other
        half = len(own) // 2
        edited[doc] = own[: len(own) - half] + next_text[:half]
    rows = [(d, 0, t or "") for d, t in texts.items()] + [(d, 1, t) for d, t in edited.items()]
    made = syncmers.with_anchors(spark.createDataFrame(rows, "doc_id long, kind int, text string"), "text", "a")
    sets = {(r["doc_id"], r["kind"]): {h for _, h in r["a_at"]} for r in made.collect()}
    near = lambda a, b: 1.0 if a == b else len(a & b) / len(a | b)
    for doc in texts:
        assert got[doc]["n_chars"] == len(texts[doc] or "")
        assert got[doc]["edited_sha256"] == hashlib.sha256(edited[doc].encode()).hexdigest()
        assert got[doc]["near_edited"] == near(sets[doc, 0], sets[doc, 1])
        assert got[doc]["near_next"] == near(sets[doc, 0], sets[after[doc], 0])
    plan = queries.QUERIES["op3_syncmers"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_bucket") == 2  # the rows, and the few heads
