"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversations, decontaminate, langid, near_dedup, neighbours, packing, sharding, substring_dedup, suffix_dedup, token_counts, toxicity, warc, whitening
from .common import Staged, read, scratch

SHARDS = [f"shard-{i:03d}" for i in range(64)]
SLOTS = 8_209


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(read(spark, sf_dir, "documents").select("doc_id", "source"), ["doc_id"], SHARDS, slots=SLOTS)
    return placed.select("doc_id", "source", "slot", "shard", "shard_name")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(read(spark, sf_dir, "documents")).select("doc_id", "begin", "end", "n_words")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), percent=85)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(read(spark, sf_dir, "documents"), toxicity.learned())
    return found.select("doc_id", (~toxicity.learned()).alias("held_out"), "lang_pred", "score")


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), toxicity.learned())
    return scored.select("doc_id", (~toxicity.learned()).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches over all documents, one of them sent twice: estimates from n_chars at intake, word counts that revise
    them, counts by a second tokenizer version, and the removal of all but the first of documents with equal texts."""
    staged = Staged(spark, "token-counts")
    docs = read(spark, sf_dir, "documents")
    counts = staged.write("counts", token_counts.counted(docs, public_tokenizers.path("word_bpe_49k.json")))
    first = staged.write("first", counts.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")).filter("copies > 1").select("digest", "first_id"))
    estimate = docs.select("doc_id", "source", "lang", F.lit("words-1").alias("tokenizer"), F.expr("n_chars div 6").alias("n_tokens"))
    words = counts.select("doc_id", "source", "lang", F.lit("words-1").alias("tokenizer"), F.col("n_words").alias("n_tokens"))
    pieces = counts.select("doc_id", "source", "lang", F.lit("word_bpe_49k-1").alias("tokenizer"), F.col("n_pieces").alias("n_tokens"))
    copies = counts.join(first, "digest").filter("doc_id > first_id").select("doc_id")
    gone = words.unionByName(pieces).join(staged.write("copies", copies), "doc_id", "left_semi").withColumn("sign", F.lit(-1))
    rollup = token_counts.TokenRollup(spark, scratch(spark, "token-rollup"))
    for batch_id, rows in (
        ("0001-intake", token_counts.changes(estimate)),
        ("0002-revised", token_counts.changes(words, estimate)),
        ("0003-pieces", token_counts.changes(pieces)),
        ("0004-copies", gone),
        ("0002-revised", token_counts.changes(words, estimate)),
    ):
        rollup.commit(batch_id, rows)
        if batch_id == "0003-pieces":
            rollup.compact()  # the fourth batch is added to totals that hold the first three
    staged.drop("counts", "first", "copies")
    return rollup.totals()


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.without_repeats(read(spark, sf_dir, "documents"), words=13)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations")
    return conversations.audited(turns, conversations.damaged(turns))


QUERIES = {"op1_sharding": op1_sharding, "op2_packing": op2_packing, "op3_suffix_dedup": op3_suffix_dedup, "op4_near_dedup": op4_near_dedup, "op5_language": op5_language, "op6_neighbours": op6_neighbours, "op7_toxicity": op7_toxicity, "op8_warc": op8_warc, "op9_token_counts": op9_token_counts, "op10_decontamination": op10_decontamination, "op11_substring_dedup": op11_substring_dedup, "op12_whitening": op12_whitening, "op13_conversations": op13_conversations}

#: A text with A-Z in lower case and nothing else changed.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    # The recursion probes one slot a step: whose turn it is, each shard's place in its own order, and the slots claimed so far.
    "op1_sharding": f"""
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(i::VARCHAR, 3, '0') AS name FROM range({len(SHARDS)}) t(i)
), orders AS (
  SELECT list(('0x' || substr(md5(name || ':offset'), 1, 15))::BIGINT % {SLOTS} ORDER BY i) AS place,
         list(('0x' || substr(md5(name || ':skip'), 1, 15))::BIGINT % {SLOTS - 1} + 1 ORDER BY i) AS skip
  FROM shards
), filling(turn, place, claimed, slot, shard) AS (
  SELECT 0, place, repeat('0', {SLOTS})::BIT, NULL::BIGINT, NULL::BIGINT FROM orders
  UNION ALL
  SELECT CASE WHEN free THEN (turn + 1) % {len(SHARDS)} ELSE turn END,
         list_transform(f.place, lambda x, k: CASE WHEN k = turn + 1 THEN (x + skip[k]) % {SLOTS} ELSE x END),
         CASE WHEN free THEN set_bit(claimed, probe::INT, 1) ELSE claimed END,
         CASE WHEN free THEN probe END, CASE WHEN free THEN turn END
  FROM (SELECT *, place[turn + 1] AS probe, get_bit(claimed, place[turn + 1]::INT) = 0 AS free FROM filling) f, orders o
  WHERE bit_count(claimed) < {SLOTS}
), slots AS (SELECT slot, shard FROM filling WHERE slot IS NOT NULL)
SELECT doc_id, source, slot, shard::INT AS shard, 'shard-' || lpad(shard::VARCHAR, 3, '0') AS shard_name
FROM (SELECT doc_id, source, ('0x' || substr(md5('=' || doc_id::VARCHAR), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
JOIN slots USING (slot)""",
    # Base32 by arithmetic: 40 hexadecimal digits are 8 groups of 20 bits, each 4 digits of base 32.
    "op8_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id, sha1(payload) AS h FROM p),
d AS (
  SELECT *, list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, (k // 4 * 5 + 1)::INT, 5))::BIGINT // (32 ** (3 - k % 4))::BIGINT) % 32)::INT, 1)) AS digits FROM g
)
SELECT page_id, strlen(payload) AS payload_bytes, list_aggregate(digits, 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM d""",
    # Every window of 50 words with a place before its own; runs of places whose windows touch or overlap are one passage.
    "op3_suffix_dedup": rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, k, md5(array_to_string(w[k + 1:k + 50], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS k FROM w WHERE len(w) >= 50)),
r AS (SELECT doc_id, k FROM g QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id, k) > 1),
s AS (SELECT doc_id, k, coalesce(k > lag(k) OVER o + 50, true)::INT AS opens FROM r WINDOW o AS (PARTITION BY doc_id ORDER BY k)),
p AS (SELECT doc_id, k, sum(opens) OVER (PARTITION BY doc_id ORDER BY k) AS part FROM s)
SELECT doc_id, min(k)::BIGINT AS "begin", (max(k) + 50)::BIGINT AS "end", (max(k) + 50 - min(k))::BIGINT AS n_words FROM p GROUP BY doc_id, part""",
    "op4_near_dedup": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 85 * (na.n + nb.n - c)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT doc_id, b FROM reached JOIN edges ON other = a),
labels AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM labels LEFT JOIN n USING (doc_id)""",
    "op10_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k:k + 9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM b WHERE len(w) > 0)),
q AS (SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM p) WHERE len(w) >= n)),
found AS (SELECT doc_id, k, q.n, item_id FROM q JOIN p ON q.g = p.g AND q.n = p.n),
hits AS (SELECT doc_id, count(DISTINCT at_word) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS at_word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    # A word is covered by a window that begins up to 12 words before it.
    "op11_substring_dedup": r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, doc_id, k, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM w WHERE len(w) >= 13)),
hit AS (SELECT r, k FROM g JOIN (SELECT g, min(doc_id) AS first FROM g GROUP BY g) USING (g) WHERE doc_id > first),
gone AS (SELECT DISTINCT r, unnest(range(k, k + 13)) AS k FROM hit),
lost AS (SELECT r, list(k) AS gone FROM gone GROUP BY r),
kept AS (SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END AS kept FROM w LEFT JOIN lost USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM kept""",
    # The recursion takes one turn a step. A state is a way's (cost, edits, lines); the least of a list of ways survives. States: 1 nothing yet, 2 after the
    # system turn, 3 after a user's, 4 after an assistant's. Inserts come after each turn: a user's from 1, 2 or 4, then an assistant's from 3.
    "op13_conversations": r"""
WITH RECURSIVE bits AS (SELECT i, i AS c, 0 AS k FROM range(256) t(i) UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crcs AS (SELECT list(c ORDER BY i) AS crcs FROM bits WHERE k = 8),
o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
h AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_transform(range(1, len(name) + 1), lambda i: ascii(name[i])::BIGINT), lambda c, b: xor(c >> 8, crcs[xor(c & 255, b) + 1]), 4294967295), 4294967295) % 20 AS code FROM o, crcs),
d AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE code <> 0
), n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last FROM d),
f AS (
  SELECT *, role[1:1] AS r, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM n
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id
), way(conv_id, i, w) AS (
  SELECT conv_id, 0::BIGINT, [{'c': 0, 'e': '', 't': ''}, NULL, {'c': 2, 'e': 'I', 't': E'user:\n'}, {'c': 4, 'e': 'II', 't': E'user:\nassistant:\n'}] FROM stats
  UNION ALL
  SELECT conv_id, i, [w1, w2, w3, list_min([w4, {'c': w3.c + 2, 'e': w3.e || 'I', 't': w3.t || E'assistant:\n'}])] FROM (
    SELECT conv_id, i, w1, w2, w4, list_min(list_filter([w3, {'c': w1.c + 2, 'e': w1.e || 'I', 't': w1.t || E'user:\n'}, {'c': w2.c + 2, 'e': w2.e || 'I', 't': w2.t || E'user:\n'}, {'c': w4.c + 2, 'e': w4.e || 'I', 't': w4.t || E'user:\n'}], lambda x: x.c IS NOT NULL)) AS w3 FROM (
      SELECT conv_id, i, del[1] AS w1, list_min(list_filter([del[2], CASE WHEN stay AND r = 's' THEN keep[1] END], lambda x: x.c IS NOT NULL)) AS w2,
        list_min(list_filter([del[3], CASE WHEN stay AND r = 'u' THEN keep[1] END, CASE WHEN stay AND r = 'u' THEN keep[2] END, CASE WHEN stay AND r = 'u' THEN keep[4] END, CASE WHEN stay THEN user[1] END, CASE WHEN stay THEN user[2] END, CASE WHEN stay THEN user[4] END], lambda x: x.c IS NOT NULL)) AS w3,
        list_min(list_filter([del[4], CASE WHEN stay AND r = 'a' THEN keep[3] END, CASE WHEN stay THEN assistant[3] END], lambda x: x.c IS NOT NULL)) AS w4
      FROM (
        SELECT f.conv_id, f.i, f.r, fault NOT IN ('b', 'd') AS stay,
          list_transform(w, lambda x: CASE WHEN x.c IS NOT NULL THEN {'c': x.c + 3, 'e': x.e || 'D', 't': x.t} END) AS del,
          list_transform(w, lambda x: CASE WHEN x.c IS NOT NULL THEN {'c': x.c + (fault = 't')::INT, 'e': x.e || 'K', 't': x.t || role || ':' || text || E'\n'} END) AS keep,
          list_transform(w, lambda x: CASE WHEN x.c IS NOT NULL THEN {'c': x.c + 2 + (fault = 't')::INT, 'e': x.e || 'R', 't': x.t || 'user:' || text || E'\n'} END) AS user,
          list_transform(w, lambda x: CASE WHEN x.c IS NOT NULL THEN {'c': x.c + 2 + (fault = 't')::INT, 'e': x.e || 'R', 't': x.t || 'assistant:' || text || E'\n'} END) AS assistant
        FROM way JOIN f ON f.conv_id IS NOT DISTINCT FROM way.conv_id AND f.i = way.i + 1
      )
    )
  )
), best AS (SELECT conv_id, list_min([w[1], w[4]]) AS x FROM way JOIN stats s USING (conv_id) WHERE i = s.n)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(x.c, 0)::BIGINT AS cost, coalesce(x.e, '') AS audit, sha256(coalesce(x.t[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN stats USING (conv_id) LEFT JOIN best USING (conv_id)""",
}
