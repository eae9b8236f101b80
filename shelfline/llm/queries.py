"""The registered text queries: (spark, sf_dir) -> DataFrame, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.llm import (
    byte_bpe, conversation_repair, decontamination, fill_in_middle, language_model, line_dedup, near_dedup, packing, personal_data,
    quality, substring_dedup, token_counts, toxicity,
)
from shelfline.llm.common import documents, fold

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, d), public_tokenizers.path("byte_bpe_50k.json"))


def op2_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = substring_dedup.substring_dedup(documents(spark, d))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_language_model(spark: SparkSession, d: str) -> DataFrame:
    return language_model.language_model_scores(documents(spark, d))


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    found = decontamination.decontaminate(
        documents(spark, d).select("doc_id", "text"), spark.read.parquet(f"{d}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = documents(spark, d)
    model = toxicity.learn(docs, spark.read.parquet(f"{d}/labels.parquet"))
    return toxicity.toxicity(docs, model).withColumn("held_out", fold("doc_id") == 0)


def op6_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    coded = byte_bpe.encode(documents(spark, d), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                            public_tokenizers.PATTERN, keep=["doc_id"])
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    kept = line_dedup.line_dedup(documents(spark, d).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_personal_data(spark: SparkSession, d: str) -> DataFrame:
    found = personal_data.personal_data(documents(spark, d).select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(personal_data.BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in personal_data.BASE_KINDS],
                        F.sha2(personal_data.listed(base), 256).alias("base_sha256"),
                        personal_data.listed(F.col("spans")).alias("spans"))


def op9_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, d), shingle=3, percent=85)


def op10_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(documents(spark, d))


def op11_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    rows = conversation_repair.damage(spark.read.parquet(f"{d}/conversations.parquet"))
    return conversation_repair.summaries(*conversation_repair.repair_apart(rows))


def op12_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    made = fill_in_middle.fill_in_middle(documents(spark, d))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(documents(spark, d), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (op1_token_counts, op2_substring_dedup, op3_language_model, op4_decontamination, op5_toxicity, op6_byte_bpe, op7_line_dedup,
                            op8_personal_data, op9_near_dedup, op10_quality, op11_conversation_repair, op12_fill_in_middle, op13_packing)
}
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# crc32 of a text of single bytes: the remainder of the polynomial 0xEDB88320, bit by bit.
CRC = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, len({0}) + 1), lambda j: ascii({0}[j])::BIGINT),
  lambda acc, b: list_reduce([xor(acc, b)] || range(8)::BIGINT[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))))"""
BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op2_substring_dedup": f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op4_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (
  SELECT item_id, regexp_extract_all({LOWERED.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
  SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
spots AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM items) WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM spots JOIN items USING (n, k)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op7_line_dedup": f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
each AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
keyed AS (SELECT *, {LOWERED.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM each),
common AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.k IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (k) GROUP BY doc_id""",
    "op9_near_dedup": f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(LOWERED.format("text"))} AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS s FROM (
  SELECT doc_id, w, least(len(w), 3) AS n, unnest(range(1, len(w) - least(len(w), 3) + 2)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT links.b, reach.c FROM reach JOIN links USING (a)),
least_id AS (SELECT a AS doc_id, min(c) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_id LEFT JOIN sizes USING (doc_id)""",
    "op11_conversation_repair": rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC.format("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS c FROM conversations),
made AS (SELECT conv_id, turn, CASE c WHEN 4 THEN 'user' ELSE role END AS role,
    CASE c WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE c WHEN 0 THEN []::INT[] WHEN 3 THEN [1, 2] ELSE [1] END) FROM given),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM made),
faulty AS (SELECT *, CASE WHEN trim(text, {BLANK_SQL}) = '' THEN 1
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
    WHEN right(rtrim(text, {BLANK_SQL}), 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
  lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal FROM placed),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM faulty GROUP BY conv_id),
into_(q, to_, gives) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
keeps(q, first, to_) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
inserts AS (SELECT q, q AS to_, 0 AS cost, '' AS letters, []::VARCHAR[] AS lines FROM into_
  UNION ALL SELECT q, to_, 5, 'I', [gives || ':'] FROM into_
  UNION ALL SELECT a.q, b.to_, 10, 'II', [a.gives || ':', b.gives || ':'] FROM into_ a JOIN into_ b ON a.to_ = b.q),
arcs AS (SELECT conv_id, i, q, q AS to_, 2 AS cost, 'D' AS letter, []::VARCHAR[] AS lines FROM faulty, into_
  UNION ALL SELECT conv_id, i, q, to_, CASE fault WHEN 3 THEN 5 ELSE 0 END, 'K', [role || ':' || text]
    FROM faulty JOIN keeps ON role[1] = first WHERE fault IN (0, 3)
  UNION ALL SELECT conv_id, i, q, to_, CASE fault WHEN 3 THEN 6 ELSE 1 END, 'R', [gives || ':' || text] FROM faulty, into_ WHERE fault IN (0, 3)),
ways AS (SELECT conv_id, 0 AS i, 0 AS q, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS way FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL SELECT w.conv_id, w.i + 1, a.to_, min({{'cost': way.cost + n.cost + a.cost, 'audit': way.audit || n.letters || a.letter,
      'lines': way.lines || n.lines || a.lines}})
    FROM ways w JOIN inserts n USING (q) JOIN arcs a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1 AND a.q = n.to_
    GROUP BY w.conv_id, w.i, a.to_),
best AS (SELECT w.conv_id, min({{'cost': way.cost + n.cost, 'audit': way.audit || n.letters, 'lines': way.lines || n.lines}}) AS way
  FROM ways w JOIN inserts n USING (q)
  JOIN (SELECT conv_id, max(i) AS i FROM ways GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND l.i = w.i
  WHERE n.to_ IN (0, 3) GROUP BY w.conv_id)
SELECT b.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, way.cost::BIGINT AS cost, way.audit AS audit,
       sha256(array_to_string(way.lines, chr(10))) AS repaired_sha256
FROM best b LEFT JOIN counts c ON b.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
drawn AS (SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS h1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS h2,
    ('0x' || h[17:24])::BIGINT % 100 AS h3, ('0x' || h[25:32])::BIGINT % 100 AS h4 FROM d),
cut AS (SELECT *, array_to_string(u[1:least(h1, h2)], '') AS p, array_to_string(u[least(h1, h2) + 1:greatest(h1, h2)], '') AS m,
    array_to_string(u[greatest(h1, h2) + 1:], '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 50 THEN 'plain'
         WHEN h4 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256
FROM cut""",
}
