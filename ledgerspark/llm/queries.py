"""The registered queries of this package: (function, DuckDB SQL or None) by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat_format, common, decontaminate, filter_audit, lm_scoring, ngram_join, packing,
               pii, prefix_trie, quality, secret_scan, sharding, topk_search, warc)


def word_bpe() -> str:
    """Content of the public tokenizer that the packing contract names."""
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(common.table(spark, sf_dir, "documents"), word_bpe())


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = (common.table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontaminate.contamination(docs, bench).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP7_SQL = r"""
WITH t AS (
  SELECT kind, id, [x FOR x IN string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
  FROM (SELECT 'd' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'b', item_id, text FROM benchmark) u),
windows AS (
  SELECT DISTINCT id AS item_id, size, array_to_string(w[k:k + size - 1], ' ') AS g
  FROM (SELECT id, w, least(len(w), 10) AS size,
               unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k
        FROM t WHERE kind = 'b' AND len(w) > 0) x),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT id AS doc_id, size, k, array_to_string(w[k:k + size - 1], ' ') AS g
  FROM (SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS k
        FROM t, sizes WHERE kind = 'd' AND len(w) >= size) x),
found AS (SELECT grams.doc_id, grams.size, k, item_id FROM grams JOIN windows
          ON windows.size = grams.size AND windows.g = grams.g),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) x GROUP BY doc_id)
SELECT t.id AS doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN hits ON hits.doc_id = t.id LEFT JOIN items ON items.doc_id = t.id
WHERE kind = 'd'
"""


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (common.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return quality.classify(docs, labels).select(
        "doc_id", (common.hash_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.w, c.w)]) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


def byte_bpe() -> lm_scoring.Tokenizer:
    """The public byte-level vocabulary; it has ids up to 50255, 50256 is free for the end."""
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return lm_scoring.Tokenizer(f.read(), public_tokenizers.PATTERN, 50256, 50257)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    held = common.hash_mod("doc_id", 7) == 2
    return lm_scoring.score_texts(docs, held, byte_bpe()).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(common.table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS size
  FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS kept FROM p)
SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM g
"""


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id")


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k
        FROM d WHERE len(w) > 0) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = d.doc_id
"""


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(common.table(spark, sf_dir, "documents"))

    def n(kind):
        return F.size(F.filter("plain", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(secret_scan.joined(F.col("plain")), 256).alias("base_sha256"),
        secret_scan.joined(F.concat("plain", "linked")).alias("spans"))


#: The key of the pseudonyms would come from a secret store; the registered query has a fixed one.
PII_KEY = "registered-query"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymise(docs, PII_KEY, found="found")

    def n(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    return out.select("doc_id", "text", *[n(k).alias(f"n_{k}") for k in pii.KINDS])


#: Both turns of the conversation that the formatting contract adds as number -7.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


def op11_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = common.table(spark, sf_dir, "conversations") \
        .select("conv_id", "turn", "role", "text")
    added = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_conversations(conversations.unionByName(added))
    read = formatted.select(
        "conv_id", common.let(chat_format.turns_of(F.col("formatted")), lambda t: F.struct(
            F.size(t).cast("long").alias("n_turns"),
            F.sha2(F.array_join(F.transform(t, lambda x: F.concat(
                x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256")))
        .alias("turns"),
        common.let(F.array_join(chat_format.loss_texts(
            F.col("formatted"), F.col("loss_spans")), ""), lambda t: F.struct(
                F.length(t).cast("long").alias("loss_chars"),
                F.sha2(t, 256).alias("loss_sha256"))).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"))
    return read.select("conv_id", "turns.*", "loss.*", "formatted_chars")


OP11_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
o AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before,
         length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) AS role_chars,
         length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS text_chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
         AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(text_chars + CASE WHEN before = role THEN length('<|more|>')
                ELSE role_chars + length('<|turn|><|text|><|end|>') + 1 END) AS BIGINT)
         AS formatted_chars
FROM o GROUP BY conv_id
"""


def rebuilt_conversations(sequences: DataFrame, block: int = 100, longest: int = 6) -> DataFrame:
    """The conversations of the trie contract: each takes its first h turns from the first
    conversation of its block of ids and goes on with its own, h below ``longest`` by its id."""
    turns, seq = prefix_trie.turns, F.col("seq")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    first = sequences.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("block"), turns(seq, 0, longest - 1).alias("shared"))
    both = sequences.withColumn("block", F.col("conv_id") - F.col("conv_id") % block) \
        .join(first, "block", "left")
    return both.select("conv_id", F.concat(
        turns(F.coalesce("shared", F.expr("X''")), 0, h), turns(seq, h)).alias("seq"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = common.table(spark, sf_dir, "conversations")
    return prefix_trie.trie(rebuilt_conversations(prefix_trie.sequences(conversations)))


# The CRC-32 of the ids is folded over their digits with the usual table, built by the first CTE.
OP12_SQL = r"""
WITH RECURSIVE crc_steps(i, k, v) AS (
  SELECT CAST(i AS BIGINT), 0, CAST(i AS BIGINT) FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END
  FROM crc_steps WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS crc FROM crc_steps WHERE k = 8),
own AS (
  SELECT conv_id, list(t ORDER BY turn NULLS FIRST) AS w
  FROM (SELECT conv_id, turn, {'role': coalesce(role, ''), 'text': coalesce(text, '')} AS t
        FROM conversations WHERE conv_id IS NOT NULL) x GROUP BY conv_id),
cut AS (
  SELECT conv_id, w, xor(list_reduce(
           list_concat([CAST(4294967295 AS BIGINT)],
                       [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
           lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM own, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.w, [])[1:c.h], c.w[c.h + 1:]) AS w
  FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, len(w) AS size, d AS depth, w[1:d] AS p,
         CASE WHEN d > 0 THEN length(w[d].text) ELSE 0 END AS chars
  FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM rebuilt) x),
nodes AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                         FILTER (WHERE size = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, p),
member AS (SELECT x.conv_id, x.depth, n.conv_id AS node
           FROM prefixes x JOIN nodes n ON n.depth = x.depth AND n.p = x.p),
children AS (SELECT m.node, m.depth, count(*) AS n_children
             FROM nodes n JOIN member m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
             GROUP BY m.node, m.depth),
below AS (
  SELECT m.node, m.depth, sum((n.n_convs - 1) * n.chars) AS saved_tokens,
         count(*) FILTER (WHERE c.node IS NULL) AS n_leaves
  FROM nodes n JOIN member m ON m.conv_id = n.conv_id AND m.depth <= n.depth
  LEFT JOIN children c ON c.node = n.conv_id AND c.depth = n.depth GROUP BY m.node, m.depth)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.node AS parent_conv_id, n.n_convs,
       coalesce(c.n_children, 0) AS n_children, b.n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.node = n.conv_id AND b.depth = n.depth
LEFT JOIN children c ON c.node = n.conv_id AND c.depth = n.depth
LEFT JOIN member m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (common.table(spark, sf_dir, t) for t in ("documents", "labels"))
    return filter_audit.audit_documents(docs, labels)


OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words
  FROM documents),
marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
          FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         {'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
          'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'),
          'E': coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM w LEFT JOIN marks ON marks.doc_id = w.doc_id),
bits AS (
  SELECT part, good, toxic,
         list_concat([x FOR x IN ['A'] IF f.A], [x FOR x IN ['B'] IF f.B],
                     [x FOR x IN ['C'] IF f.C], [x FOR x IN ['D'] IF f.D],
                     [x FOR x IN ['E'] IF f.E]) AS failing
  FROM d),
counts AS (SELECT part, good, toxic, failing, count(*) AS n FROM bits GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS letter
          FROM orders, (SELECT unnest(range(1, 6)) AS step) s),
gone AS (
  SELECT c.*, filter_order,
         coalesce(list_min([strpos(filter_order, x) FOR x IN failing]), 6) AS removed_at
  FROM counts c, orders),
rows AS (
  SELECT part, g.filter_order, step, letter,
         sum(n) FILTER (WHERE removed_at > step) AS kept, sum(n) FILTER (WHERE removed_at = step) AS removed,
         sum(n) FILTER (WHERE removed_at < step AND list_contains(failing, letter)) AS redundant,
         sum(n) FILTER (WHERE failing = [letter]) AS unique_fails,
         sum(n) FILTER (WHERE removed_at = step AND good) AS good_lost,
         sum(n) FILTER (WHERE removed_at = step AND toxic) AS toxic_lost
  FROM gone g JOIN steps s ON s.filter_order = g.filter_order
  GROUP BY part, g.filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, letter), 0) AS BIGINT) AS shapley
FROM rows
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline                       # it imports this package's operators
    return corpus_pipeline.run(spark, sf_dir)


REGISTRY = {
    "pipeline": (pipeline, None),
    "op1_topk_search": (op1_topk_search, OP1_SQL),
    "op2_lm_scoring": (op2_lm_scoring, None),
    "op3_warc": (op3_warc, OP3_SQL),
    "op4_ngram_jaccard_join": (op4_ngram_jaccard_join, OP4_SQL),
    "op5_sharding": (op5_sharding, None),
    "op6_best_fit_packing": (op6_best_fit_packing, None),
    "op7_decontamination": (op7_decontamination, OP7_SQL),
    "op8_quality_classifier": (op8_quality_classifier, None),
    "op9_secret_scans": (op9_secret_scans, None),
    "op10_pii": (op10_pii, None),
    "op11_chat_formatting": (op11_chat_formatting, OP11_SQL),
    "op12_prefix_trie": (op12_prefix_trie, OP12_SQL),
    "op13_filter_audit": (op13_filter_audit, OP13_SQL),
}
