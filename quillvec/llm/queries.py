"""Named queries of the operators of this package over whole driver tables, and their results as SQL."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillvec.llm import (alignment, bpe, chat, jaccard, licenses, packing, perplexity, phrases, quality, suffixes,
                          templates, urls, whitening)
from quillvec.plans.shipping import ship_package

QUERIES: dict = {}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def query(fn):
    @wraps(fn)
    def run(spark, sf: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf.rstrip("/"))

    QUERIES[fn.__name__] = run
    return run


def table(spark, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_chat_formatting(spark, sf):
    """Every turn as a call or a result, linked, in order and checked."""
    calls, results = chat.calls_and_results(table(spark, sf, "conversations"))
    return chat.linked_calls(calls, results, chat.TURN_SCHEMAS)


@query
def op2_license_scan(spark, sf):
    """Notices of usual licenses in all texts."""
    return licenses.found_licenses(table(spark, sf, "documents"), licenses.template_table(spark))


@query
def op3_quality_rules(spark, sf):
    """Word counts, the word rules and perplexity bands of each language."""
    return perplexity.quality_rules(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("bits", 6).alias("bits"))


@query
def op4_suffix_dedup(spark, sf):
    """What is left of each document without strings of 400 bytes that start elsewhere too."""
    return suffixes.without_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"))


@query
def op5_jaccard_join(spark, sf):
    """Components of documents whose sets of three-word shingles overlap to 90 percent."""
    return jaccard.similar_documents(table(spark, sf, "documents"))


@query
def op6_substring_dedup(spark, sf):
    """What is left of each document without passages of earlier ones."""
    return phrases.removed_passages(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "kept")


@query
def op7_url_filter(spark, sf):
    """Rules, and for urls without one what the words in their names say."""
    return urls.judged_urls(table(spark, sf, "pages"))


@query
def op8_benchmark_decontamination(spark, sf):
    """Documents that hold a question of the benchmark, as it is or with other parameters."""
    return templates.leaked_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op9_byte_bpe(spark, sf):
    """Encodes every text, and decodes the ids again."""
    ids = bpe.encode(table(spark, sf, "documents"), RANKS, PATTERN).drop("ends")
    return bpe.decode(ids, RANKS, PATTERN, ("doc_id", "ids")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_quality_classifier(spark, sf):
    """Quality of every text by a network that has not seen the labels of the held-out quarter."""
    docs = table(spark, sf, "documents")
    network = quality.fit(quality.training_sample(docs, table(spark, sf, "labels")))
    return quality.quality_scores(docs, network).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@query
def op11_embedding_whitening(spark, sf):
    """Every vector on the first 32 components, with unit variance."""
    return whitening.whitened(table(spark, sf, "embeddings"))


@query
def op12_packing(spark, sf):
    """Where the ids of every document lie in sequences of 1024."""
    return packing.pack(table(spark, sf, "documents"), BYTE_BPE, ids=False)


@query
def op13_tokenizer_alignment(spark, sf):
    """Links and groups of the tokens of two tokenizers in every text."""
    return alignment.aligned(table(spark, sf, "documents"), BYTE_BPE, PIECE_BPE)


ORACLES: dict[str, str] = {}

ORACLES["op5_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1),
         lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, w.b FROM reach r JOIN ways w ON w.a = r.other)
SELECT r.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(other) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id, n
"""

ORACLES["op6_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE len(w) >= 13)),
owners AS (SELECT h, min(doc_id) AS first FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
  FROM windows JOIN owners USING (h) WHERE doc_id > first),
removed AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
left_over AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM words LEFT JOIN removed USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256, array_to_string(kept, ' ') AS kept
FROM left_over
"""

_UNITS = ", ".join(f"'{u}'" for u in templates.UNITS)
ORACLES["op8_benchmark_decontamination"] = rf"""
WITH doc_words AS (SELECT doc_id, regexp_split_to_array(coalesce(text, ''), '[^\p{{L}}\p{{N}}]+') AS w FROM documents),
item_words AS (
  SELECT item_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM benchmark),
templates AS (
  SELECT *, list_transform(w, lambda x: CASE WHEN x[1] BETWEEN '0' AND '9' THEN '<num>'
    WHEN x[1] <> lower(x[1]) THEN '<name>' WHEN x IN ({_UNITS}) THEN '<unit>' ELSE lower(x) END) AS t
  FROM (SELECT 0 AS side, doc_id AS id, w FROM doc_words UNION ALL SELECT 1, item_id, w FROM item_words)),
windows AS (
  SELECT side, id, i - 1 AS place, t[i:i + 4] AS v
  FROM (SELECT side, id, t, unnest(range(1, len(t) - 3)) AS i FROM templates WHERE len(t) >= 5)
  WHERE len(list_filter(t[i:i + 4], lambda x: x NOT IN ('<num>', '<name>', '<unit>'))) >= 3),
items AS (SELECT id, count(*) AS n_windows FROM windows WHERE side = 1 GROUP BY id),
found AS (
  SELECT d.id AS doc_id, b.id AS item_id, d.place - b.place AS start, count(*) AS n_matched
  FROM windows d JOIN windows b ON d.side = 0 AND b.side = 1 AND d.v = b.v GROUP BY ALL),
candidates AS (
  SELECT found.*, n_windows FROM found JOIN items ON id = item_id WHERE 100 * n_matched >= 80 * n_windows),
slots AS (
  SELECT c.doc_id, c.item_id, c.start, bt.w[i] AS was, dt.w[c.start + i] AS became
  FROM candidates c JOIN templates bt ON bt.side = 1 AND bt.id = c.item_id
  JOIN templates dt ON dt.side = 0 AND dt.id = c.doc_id, unnest(range(1, len(bt.w) + 1)) AS u(i)
  WHERE c.start + i >= 1 AND c.start + i <= len(dt.w) AND bt.t[i] IN ('<num>', '<name>', '<unit>')
    AND bt.t[i] = dt.t[c.start + i]),
judged AS (
  SELECT c.*, count(was) AS n_slots, count(*) FILTER (was <> became) AS n_changed,
         count(DISTINCT was) AS n_was, count(DISTINCT was || ' ' || became) AS n_pairs
  FROM candidates c LEFT JOIN slots USING (doc_id, item_id, start) GROUP BY ALL)
SELECT doc_id, item_id, start, n_windows, n_matched, n_slots, n_changed,
       CASE WHEN n_changed = 0 THEN 'copy' ELSE 'reparameterised' END AS kind
FROM judged WHERE n_was = n_pairs
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_matched DESC, start) = 1
"""

# No message of the given tables is JSON, so every turn is a plain call or result.
ORACLES["op1_chat_formatting"] = """
WITH rows AS (SELECT conv_id, turn, coalesce(role, 'user') AS role, '{"text":' || to_json(text) || '}' AS body
              FROM conversations),
calls AS (SELECT conv_id, turn, 'turn-' || turn AS call_id, role AS name, body FROM rows
          WHERE role NOT IN ('assistant', 'tool')),
results AS (SELECT conv_id, turn, 'turn-' || (turn - 1) AS call_id, body FROM rows WHERE role IN ('assistant', 'tool')),
firsts AS (SELECT conv_id, call_id, min(struct_pack(turn, name, body)) AS first FROM calls GROUP BY ALL),
answered AS (SELECT conv_id, call_id, count(*) AS n FROM results GROUP BY ALL)
SELECT conv_id, turn, call_id, 'call' AS kind, 0 AS step, turn AS level,
       CASE WHEN struct_pack(turn, name, body) <> first THEN 'repeated' WHEN n > 0 THEN 'answered' ELSE 'unanswered' END
         AS status, '' AS errors,
       '{"arguments":' || body || ',"call_id":"' || call_id || '","conv_id":' || conv_id || ',"name":"' || name
         || '","turn":' || turn || ',"type":"call"}' AS json
FROM calls JOIN firsts USING (conv_id, call_id) LEFT JOIN answered USING (conv_id, call_id)
UNION ALL
SELECT conv_id, turn, call_id, 'result', 1, greatest(turn, coalesce(first.turn, turn)),
       CASE WHEN first IS NULL THEN 'orphan' ELSE 'linked' END, '',
       '{"call_id":"' || call_id || '","content":' || body || ',"conv_id":' || conv_id || ',"turn":' || turn
         || ',"type":"result"}'
FROM results LEFT JOIN firsts USING (conv_id, call_id)
"""
