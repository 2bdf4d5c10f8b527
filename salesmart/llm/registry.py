"""Queries of the operators, one per operator, over whole tables, and their DuckDB SQL.

The operators have general interfaces; a query applies one with production
parameters and derives the columns of its contract.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, dedup, html, jaccard, mixing, negatives, repair, repeats, simhash, tokenfile, tools, toxicity, warc
from .common import stage

VOCABULARY, END_ID = 50_257, 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                END_ID, VOCABULARY)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stage(docs.select("doc_id", "source", mixing.word_count(docs["text"]).alias("words")))
    return mixing.mix(sized, F.col("words")).select(
        "doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path, pattern).select("doc_id", "ids")
    return bpe.digests(bpe.decode(coded, path, pattern))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.annotate(table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html.extract(table(spark, sf_dir, "pages"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns, and for ids divisible by 100 the documents within the radius.

    n_near counts them; near lists their distinct fingerprints with the distance
    (the documents are the rows with that fingerprint).
    """
    marked = simhash.edited_pairs(table(spark, sf_dir, "documents"))
    marked = stage(marked.select("doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
                                 "fingerprint", "edited_fingerprint", "next_fingerprint"))
    asked = marked.filter(F.col("doc_id") % 100 == 0)
    near = stage(simhash.matches(asked, marked).groupBy("fingerprint").agg(
        F.sum("n_rows").alias("n_near"), F.array_sort(F.collect_list(F.struct("distance", "near"))).alias("near")))
    counted = asked.join(near, "fingerprint").groupBy("doc_id").agg(F.max(F.struct("n_near", "near")).alias("found"))
    mark = F.col("fingerprint")
    return marked.join(counted, "doc_id", "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        simhash.likeness(mark, F.col("edited_fingerprint")).alias("near_edited"),
        simhash.likeness(mark, F.col("next_fingerprint")).alias("near_next"), "found.n_near", "found.near")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.write(table(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_tool_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    linked = tools.link(*tools.conversation_calls(turns), tools.REPLY)
    return linked.select("conv_id", "call_id", "kind", "depth", "valid", F.concat_ws("; ", "errors").alias("errors"),
                         "result_id", "canonical")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), width=4, percent=85).select(
        "doc_id", "n_shingles", "component_id")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.conversations(repair.pieces(repair.damage(turns)), turns)


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"[^\x20\x09-\x0D]+"

SQL = {
    "op2_curriculum_mix": rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS BIGINT) AS size,
         md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE class WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight,
         2.0::DOUBLE * source_size AS cap FROM sources),
-- the water level: fill the sources one after the other, the first that is not full gives it
levels AS (
  SELECT *, cap / weight AS level,
         (1.5::DOUBLE * CAST(sum(source_size) OVER () AS BIGINT) - coalesce(sum(cap) OVER fuller, 0.0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER fuller, 0.0)) AS shared
  FROM weighed
  WINDOW fuller AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (
  SELECT shared FROM levels WHERE level >= shared ORDER BY level, source NULLS LAST LIMIT 1),
plan AS (
  SELECT source, source_size, class, least(cap, coalesce(weight * (SELECT shared FROM water), cap)) AS target FROM levels),
queue AS (
  SELECT d.doc_id, d.size, p.source_size, p.class, p.target,
         coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS begun
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source),
taken AS (
  SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - begun)) AS first,
         greatest(0, least(size, CAST(floor(target) AS BIGINT) - begun - source_size)) AS second,
         begun / target AS share
  FROM queue)
SELECT doc_id, size, source_size, target, CAST(first + second AS BIGINT) AS taken,
       round(CASE WHEN first = 0 THEN NULL
            WHEN class = 0 THEN (sqrt(2.25 - 2 * share) - 1.5) / -1
            WHEN class = 1 THEN share
            WHEN share < 0.3125 THEN (sqrt(0.25 + share) - 0.5) / 0.5
            ELSE 0.5 + (sqrt(0.5625 + 5 * (share - 0.3125)) - 0.75) / 2.5 END, 9) AS position
FROM taken""",
    "op4_exact_dedup": f"""
WITH digests AS (SELECT doc_id, sha256({LOWERED}) AS text_sha256 FROM documents),
ranked AS (SELECT doc_id, text_sha256, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                  row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS place
           FROM digests WINDOW same AS (PARTITION BY text_sha256))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
    "op7_warc": """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM payloads),
coded AS (
  SELECT page_id, payload_bytes, hex, max(page_id) OVER (PARTITION BY hex) AS newest,
         array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((CAST('0x' || substr(hex, 1 + 5 * (j // 4), 5) AS INTEGER) >> CAST(15 - 5 * (j % 4) AS INTEGER)) & 31), 1)), '')
           AS payload_digest
  FROM digests)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to
FROM coded""",
    "op9_tool_links": """
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, conv_id || ':' || turn AS call_id, conv_id || ':' || (turn - 1) AS needs, role, text
  FROM conversations WHERE role <> 'assistant'),
results AS (
  SELECT conv_id, conv_id || ':' || turn AS result_id, conv_id || ':' || (turn - 1) AS call_id, text
  FROM conversations WHERE role = 'assistant'),
answered AS (SELECT r.* FROM results r JOIN calls c USING (call_id)),
parents AS (
  SELECT c.call_id, coalesce(p.call_id, a.call_id) AS parent
  FROM calls c LEFT JOIN calls p ON p.call_id = c.needs LEFT JOIN answered a ON a.result_id = c.needs),
depths AS (
  SELECT call_id, CAST(0 AS BIGINT) AS depth FROM parents WHERE parent IS NULL
  UNION ALL SELECT p.call_id, d.depth + 1 FROM parents p JOIN depths d ON p.parent = d.call_id)
SELECT c.conv_id, c.call_id, 'call' AS kind, d.depth, true AS valid, '' AS errors, a.result_id,
       '{"arguments":{"prompt":' || to_json(c.text) || ',"role":' || to_json(c.role) || ',"turn":' || c.turn
         || '},"id":' || to_json(c.call_id) || ',"name":"reply"'
         || coalesce(',"result":' || to_json(a.text), '') || '}' AS canonical
FROM calls c JOIN depths d USING (call_id) LEFT JOIN answered a USING (call_id)
UNION ALL
SELECT conv_id, call_id, 'orphan', NULL, false, 'no call', result_id, NULL
FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.call_id = r.call_id)""",
    "op11_hard_negatives": """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q,
         row_number() OVER () AS r
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.r AS ar, b.vec_id, b.r, a.label = b.label AS alike,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.r <> b.r),
positives AS (
  SELECT ar, anchor_id, vec_id AS positive_id, r AS pr, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.ar, p.pr ORDER BY s.score DESC, s.vec_id) AS place
  FROM positives p JOIN scored s ON s.ar = p.ar AND NOT s.alike
       AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10""",
    "op13_structure_repair": r"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
-- CRC-32: eight shifts a byte
faulty AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
           list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda p: CAST(unicode(substr(name, p, 1)) AS BIGINT))),
           lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                    lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 20 AS fault
  FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM faulty WHERE fault <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, substr(role, 1, 1) AS c
  FROM damaged),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
         c || lead(c) OVER (PARTITION BY conv_id ORDER BY i) AS pair
  FROM ordered),
turns AS (
  SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS duplicate,
         body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated
  FROM seen),
sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY conv_id),
-- cheapest cost and least audit (k, a) of what is left, from the last turn on, for each state: start, system, user, assistant
walk AS (
  SELECT conv_id, n + 1 AS i, {'k': 0::BIGINT, 'a': ''} AS q0, {'k': 6::BIGINT, 'a': 'II'} AS qs,
         {'k': 3::BIGINT, 'a': 'I'} AS qu, {'k': 0::BIGINT, 'a': ''} AS qa FROM sums
  UNION ALL
  SELECT conv_id, i,
         least(b0, {'k': bu.k + 3, 'a': 'I' || bu.a}, {'k': ba.k + 6, 'a': 'II' || ba.a}),
         least(bs, {'k': bu.k + 3, 'a': 'I' || bu.a}, {'k': ba.k + 6, 'a': 'II' || ba.a}),
         least(bu, {'k': ba.k + 3, 'a': 'I' || ba.a}), least(ba, {'k': bu.k + 3, 'a': 'I' || bu.a})
  FROM (
    SELECT conv_id, i,
           least({'k': q0.k + 4, 'a': 'D' || q0.a}, CASE WHEN stays AND c = 's' THEN {'k': qs.k + t, 'a': 'K' || qs.a}
                 WHEN stays AND c = 'u' THEN {'k': qu.k + t, 'a': 'K' || qu.a} END, CASE WHEN stays THEN {'k': qu.k + 3 + t, 'a': 'R' || qu.a} END) AS b0,
           least({'k': qs.k + 4, 'a': 'D' || qs.a}, CASE WHEN stays AND c = 'u' THEN {'k': qu.k + t, 'a': 'K' || qu.a} END,
                 CASE WHEN stays THEN {'k': qu.k + 3 + t, 'a': 'R' || qu.a} END) AS bs,
           least({'k': qu.k + 4, 'a': 'D' || qu.a}, CASE WHEN stays AND c = 'a' THEN {'k': qa.k + t, 'a': 'K' || qa.a} END,
                 CASE WHEN stays THEN {'k': qa.k + 3 + t, 'a': 'R' || qa.a} END) AS bu,
           least({'k': qa.k + 4, 'a': 'D' || qa.a}, CASE WHEN stays AND c = 'u' THEN {'k': qu.k + t, 'a': 'K' || qu.a} END,
                 CASE WHEN stays THEN {'k': qu.k + 3 + t, 'a': 'R' || qu.a} END) AS ba
    FROM (SELECT w.conv_id, m.i, w.q0, w.qs, w.qu, w.qa, m.c, NOT m.blank AND NOT m.duplicate AS stays,
                 CASE WHEN m.truncated THEN 3 ELSE 0 END AS t
          FROM walk w JOIN turns m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i - 1))),
answers AS (SELECT conv_id, q0.k AS cost, q0.a AS audit FROM walk WHERE i = 1),
letters AS (SELECT conv_id, p, substr(audit, p, 1) AS l FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM answers)),
placed AS (
  SELECT *, count(*) FILTER (l <> 'I') OVER run AS i, count(*) FILTER (l <> 'D') OVER run AS o
  FROM letters WINDOW run AS (PARTITION BY conv_id ORDER BY p)),
kept AS (
  SELECT x.conv_id, x.p, x.l, x.o, m.role, coalesce(m.text, '') AS text,
         max(CASE WHEN x.o = 1 AND x.l = 'K' AND m.c = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.conv_id) AS head
  FROM placed x LEFT JOIN turns m ON m.conv_id IS NOT DISTINCT FROM x.conv_id AND m.i = x.i AND x.l <> 'I'
  WHERE x.l <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN l = 'K' THEN role WHEN (o - head) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || text, chr(10) ORDER BY p) AS lines
  FROM kept GROUP BY conv_id)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
       coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, coalesce(a.cost, 0) AS cost,
       coalesce(a.audit, '') AS audit, sha256(coalesce(r.lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN answers a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op10_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(list_transform(range(greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END)),
                               lambda i: array_to_string(w[i + 1:i + 4], ' '))) AS s
  FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
       AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) r ON r.x = s.doc_id""",
}

OPERATORS = (op1_token_file, op2_curriculum_mix, op3_byte_bpe, op4_exact_dedup, op5_html_text, op6_simhash,
             op7_warc, op8_toxicity, op9_tool_links, op10_jaccard_join, op11_hard_negatives,
             op12_suffix_dedup, op13_structure_repair)


def queries():
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
