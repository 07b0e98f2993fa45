"""One query per operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import bpe, chaining, chat, collocations, html_text, lexical_search, line_dedup, minhash, packing, rabitq, sharding, syncmers, toxicity
from millrace.llm.common import table
from millrace.catalog.registry import Query

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def _sha(text) -> F.Column:
    return F.sha2(text.cast("binary"), 256)


# A conversation whose texts hold an escape sign and control strings, as the contract states it.
PROBE_TEXT = "\\### Assistant: </turn> ok"

OP6_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    length(text) + length(regexp_replace(text, '[^\\<>]', '', 'g')) AS text_chars,
    length(role) + length(regexp_replace(role, '[^\\<>]', '', 'g')) AS role_chars FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(text_chars + CASE WHEN before = role THEN 7 ELSE 16 + role_chars END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@query("op6_chat_formatting", OP6_SQL)
def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    made = chat.format_conversations(rows).select(
        "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("pieces")).alias("loss")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        _sha(said).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        _sha(F.col("loss")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op1_packing")
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), 2048)


@query("op2_minhash")
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query("op3_syncmers")
def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    anchored = lambda df: syncmers.with_anchors(df, "text", "anchors").withColumn("hashes", syncmers.hashes(F.col("anchors_at")))
    made = syncmers.next_rows(docs, ["text"], anchored, ["hashes"])
    changed = syncmers.edited(F.col("text"), F.col("next_text")).alias("changed")
    other = made.select("doc_id", F.length("text").alias("n_chars"), changed, "anchors_at", "hashes", "next_hashes")
    both = syncmers.with_anchors(other, "changed", "changed_anchors")
    return both.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        _sha(F.col("changed")).alias("edited_sha256"),
        syncmers.placed_text(F.col("anchors_at")).alias("fingerprint"),
        syncmers.placed_text(F.col("changed_anchors_at")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("hashes"), syncmers.hashes(F.col("changed_anchors_at"))).alias("near_edited"),
        syncmers.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score_documents(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op5_html")
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


@query("op8_chaining")
def op8_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _sha(bpe.ids_text(F.col("ids"))).alias("ids_sha256"),
        _sha(bpe.decoder(path)("ids")).alias("decoded_sha256"),
    )


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE len(embedding) > 0 AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT *, sqrt(list_reduce(list_transform(e, lambda x: x * x), lambda a, b: a + b)) AS size FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_reduce(list_transform(list_zip(c.e, q.e), lambda z: z[1] * z[2]), lambda a, b: a + b) / (c.size * q.size) AS score
  FROM n q JOIN n c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""


@query("op7_rabitq", OP7_SQL)
def op7_rabitq(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = rabitq.valid_vectors(table(spark, sf_dir, "embeddings"))
    return rabitq.nearest(rabitq.index(vectors), vectors.where("vec_id % 50 = 0"), 5)


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


OP13_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.line, k.place, coalesce(k.doc_id <> r.top, false) AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op13_line_dedup", OP13_SQL)
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_lines", "n_dropped", _sha(F.col("kept")).alias("kept_sha256"))


OP11_SQL = """
WITH w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
g AS (
  SELECT lang, 1 AS k, unnest(ws) AS phrase FROM w UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) FROM w UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) FROM w),
f AS (SELECT lang, k, phrase, count(*) AS n, string_split(phrase, ' ') AS ws FROM g GROUP BY lang, k, phrase),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND n >= 10),
cuts AS (SELECT lang, phrase, n AS a, unnest(range(1, k)) AS c, ws, k FROM cand),
s AS (
  SELECT u.lang, u.phrase, u.a, u.c, x.n AS l, y.n AS r,
    ((1000000::HUGEINT * u.a * u.a) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.ws[1:u.c], ' ')
  JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.ws[u.c + 1:u.k], ' ')),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_two AS (
  SELECT lang, ws[1] || ' ' || ws[2] AS phrase, n FROM cand WHERE k = 3 UNION ALL
  SELECT lang, ws[2] || ' ' || ws[3], n FROM cand WHERE k = 3),
longest AS (SELECT lang, phrase, max(n) AS n FROM inner_two GROUP BY lang, phrase),
ranked AS (
  SELECT low.lang, row_number() OVER (PARTITION BY low.lang ORDER BY score DESC, a DESC, encode(low.phrase)) AS rank, low.phrase, a, l, r, score
  FROM low LEFT JOIN longest x ON x.lang = low.lang AND x.phrase = low.phrase WHERE NOT coalesce(100 * x.n >= 50 * a, false))
SELECT lang, rank, phrase, a, l, r, t.n AS n, score FROM ranked JOIN t USING (lang) WHERE rank <= 2000
"""


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH words AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+' AS term),
d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, upper, lower), (SELECT term FROM words))) AS term FROM documents, words),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, upper, lower), (SELECT term FROM words))) AS term FROM benchmark, words),
asked AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY item_id, term),
size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * n_docs) // n_terms) AS m FROM size, total),
s AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""


@query("op12_lexical_search", OP12_SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
