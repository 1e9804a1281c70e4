"""The registered queries of this subpackage and the SQL that checks them where SQL can."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    bpe,
    chat,
    fp_tree,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    secret_scan,
    substring,
    token_store,
    trie_join,
    turn_repair,
    vector_dedup,
)
from tidewatch.llm.common import table
from tidewatch.llm.word_ids import default_vocabulary
from tidewatch.session import scratch_path


def op1_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"), default_vocabulary())


def op2_token_store(spark: SparkSession, root: str) -> DataFrame:
    base = scratch_path(spark, f"token-store-{uuid.uuid4().hex[:12]}")
    token_store.write_store(table(spark, root, "documents"), base, default_vocabulary())
    return token_store.read_store(spark, base)


def op3_chat_format(spark: SparkSession, root: str) -> DataFrame:
    turns = table(spark, root, "conversations").select("conv_id", "turn", "role", "text").union(chat.probe(spark))
    formatted = chat.format_chats(turns.select("conv_id", "turn", "role", chat.text_part(turns["text"]).alias("content")))
    out = scratch_path(spark, f"chat-{uuid.uuid4().hex[:12]}")
    formatted.write.parquet(out)
    return chat.digests(spark.read.schema(formatted.schema).parquet(out))


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS role_out,
         replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') AS text_out FROM t
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|>') + length(role_out) + length('<|text|>') + length(text_out) + length('<|end|>'))::BIGINT
         AS formatted_chars
FROM s GROUP BY conv_id
"""


def op4_trie_join(spark: SparkSession, root: str) -> DataFrame:
    return trie_join.groups(table(spark, root, "documents"), words=4, percent=85)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, unnest(CASE
    WHEN len(ws) >= 4 THEN list_distinct(list_transform(range(1, len(ws) - 2),
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3]))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
pairs AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN low ON low.a = d.doc_id
"""


def op5_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, root, "documents"), path, public_tokenizers.PATTERN)


def op6_vector_dedup(spark: SparkSession, root: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, root, "embeddings"))


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
         embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings
), pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  WHERE a.ok AND b.ok AND list_cosine_similarity(a.e, b.e) >= 0.95
), links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0) AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""


def op7_repeated_passages(spark: SparkSession, root: str) -> DataFrame:
    """One row per passage that an earlier document has too, with that document."""
    found = substring.passages(table(spark, root, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "start", "end", "n_words", F.col("first_id").alias("first_doc_id"), "first_start_word", "agreement"
    )


def op8_quality_rules(spark: SparkSession, root: str) -> DataFrame:
    trusted = table(spark, root, "labels").where("quality = 1")
    return quality_rules.apply_rules(table(spark, root, "documents"), trusted)


def op9_quality_classifier(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text")
    model = quality_classifier.train(docs, table(spark, root, "labels"))
    scored = quality_classifier.score(docs, model)
    return scored.select(
        "doc_id",
        quality_classifier.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality_classifier.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_personal_data(spark: SparkSession, root: str) -> DataFrame:
    return pii.digests(pii.find(table(spark, root, "documents")))


def op11_lexical_search(spark: SparkSession, root: str) -> DataFrame:
    return fp_tree.rank_documents(table(spark, root, "documents"), table(spark, root, "benchmark"))


OP11_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
  FROM documents WHERE text IS NOT NULL
), d AS (SELECT r, doc_id, len(ws)::BIGINT AS n, ws FROM words WHERE len(ws) > 0),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM d),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), t AS (SELECT r, unnest(ws) AS term FROM d),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM t WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total
), m AS (SELECT r, doc_id, (10 + ((90 * n * docs) // terms))::BIGINT AS m FROM d, total),
s AS (
  SELECT a.item_id, m.r, any_value(m.doc_id) AS doc_id, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m)))::BIGINT AS score
  FROM asked a JOIN tf ON tf.term = a.term JOIN w ON w.term = a.term JOIN m ON m.r = tf.r GROUP BY a.item_id, m.r
), k AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""


def op12_turn_repair(spark: SparkSession, root: str) -> DataFrame:
    return turn_repair.repair_digests(table(spark, root, "conversations"))


def op13_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, root, "documents")))


def _secrets_sql() -> str:
    """The same rules over each text: matches, the pieces between them, and running lengths of both."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    per_rule = " UNION ALL ".join(
        f"SELECT r, doc_id, '{rule.kind}' AS kind, {i} AS nth, {rule.least} AS least, regexp_extract_all(t, {quote(rule.pattern)}) AS a, "
        f"regexp_extract_all(t, {quote(rule.pattern)}, {rule.group}) AS g, regexp_split_to_array(t, {quote(rule.pattern)}) AS s "
        f"FROM d WHERE regexp_matches(t, {quote(rule.pattern)})"
        for i, rule in enumerate(secret_scan.RULES)
    )
    base = ", ".join(f"'{rule.kind}'" for rule in secret_scan.BASE)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{rule.kind}') AS n_{rule.kind}" for rule in secret_scan.BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({per_rule}),
e AS (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM m),
f AS (
  SELECT r, kind, nth, length(a[i]) AS n, (list_sum(list_transform(s[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(a[1:i-1], lambda x: length(x))), 0))::BIGINT AS start
  FROM e WHERE length(g[i]) >= least
), o AS (SELECT *, kind || ':' || start || ':' || (start + n) AS line FROM f)
SELECT any_value(d.doc_id) AS doc_id, {counts},
       sha256(coalesce(string_agg(line, ',' ORDER BY start, nth) FILTER (WHERE kind IN ({base})), '')) AS base_sha256,
       coalesce(string_agg(line, ',' ORDER BY start, nth), '') AS spans
FROM d LEFT JOIN o ON o.r = d.r GROUP BY d.r
"""


QUERIES = {
    "op1_packing": op1_packing,
    "op2_token_store": op2_token_store,
    "op3_chat_format": op3_chat_format,
    "op4_trie_join": op4_trie_join,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_vector_dedup": op6_vector_dedup,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_personal_data": op10_personal_data,
    "op11_lexical_search": op11_lexical_search,
    "op12_turn_repair": op12_turn_repair,
    "op13_secret_scan": op13_secret_scan,
}

ORACLES = {"op3_chat_format": OP3_SQL, "op4_trie_join": OP4_SQL, "op6_vector_dedup": OP6_SQL, "op11_lexical_search": OP11_SQL}
ORACLES["op13_secret_scan"] = _secrets_sql()
