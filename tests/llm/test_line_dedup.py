"""Repeated lines against a row-wise version: nulls, ties, repeats, long texts, clashing columns."""

import random

from pyspark.sql import functions as F

from millrace.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"


def plain(rows, min_docs=3, min_chars=20):
    """The same by dictionaries: each (doc_id, text) is a document."""
    lower = str.maketrans(line_dedup.UPPER, line_dedup.LOWER)
    key = lambda line: line.strip(BLANK).translate(lower)
    holders = {}
    for doc, text in set(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            holders.setdefault(k, []).append(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        gone = lambda x: len(key(x)) >= min_chars and len(h := holders[key(x)]) >= min_docs and max(h) != (-1 if doc is None else doc)
        out.append((-1 if doc is None else doc, len(lines), sum(map(gone, lines)), "\n".join(x for x in lines if not gone(x))))
    return sorted(out)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("lost", "h1", "top", "batch", "n", "kept", "line", "place")})
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in line_dedup.dedup_lines(df, **how).collect())


def test_edges(spark):
    common = "A line that Many hold, ÉÀ"
    rows = [
        (1, f"{common}\nown line of document one\n\n{common.lower()}"), (2, f"  {common.upper().replace('ÉÀ', 'éà')}\t"), (3, f"\x0b{common}\r\nshort"),
        (4, None), (5, ""), (6, "\n\n"), (7, f"{common}"), (7, f"{common}\nother text of seven"), (None, f"{common}\nnobody"), (None, None),
        (3, f"\x0b{common}\r\nshort"), (8, "nineteen characters\n" * 4), (9, "nineteen characters"), (10, "nineteen characters"),
        (11, "exactly twenty chars\n" * 3), (12, "exactly twenty chars"), (13, " exactly twenty char"), (14, "only two hold this one line"), (15, "only two hold this one line"),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, rows, batches=1) == plain(rows) and found(spark, rows, min_docs=2, batches=7) == plain(rows, 2)
    assert found(spark, []) == []


def test_many_lines(spark):
    """A third of all rows hold one line, some texts are long, lines repeat inside a text."""
    draw = random.Random(5)
    pool = [f"line number {i} of the common pool" for i in range(60)]
    rows = []
    for i in range(300):
        lines = [draw.choice(pool) if draw.random() < 0.3 else f"line {draw.randrange(10**6)} of document {i} alone" for _ in range(draw.randrange(1, 15))]
        rows.append((draw.randrange(1000), "\n".join(lines + ["the hot line of every third"] * (i % 3 == 0) * draw.randrange(1, 4))))
    rows.append((500, "\n".join(f"{pool[i % 60]}\nrow {i} of the long text here" for i in range(20000))))
    assert found(spark, rows) == plain(rows)


def test_runs_are_compacted(spark):
    """Nine batches leave runs of levels 0 and 3; settled keys are not added again."""
    runs = line_dedup.LineRuns(spark, 3)
    for k in range(9):
        runs.add(spark.createDataFrame([(100 - 10 * k - i, 7, 7) for i in range(4)] + [(k, 1000 + k, 1)], "doc_id long, h1 long, h2 long"))
    assert [level is not None for level in runs.levels] == [True, False, False, True]
    assert [tuple(r) for r in runs.repeated().collect()] == [(7, 7, 100)]
    held = {r["h1"]: (r["n"], r["top"]) for r in spark.table(runs.levels[0]).collect()}
    assert held[7] == (4, 100) and all(held[1000 + k] == (1, k) for k in range(9))
    runs.drop()


def test_only_expressions(spark):
    plan = line_dedup.dedup_lines(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
