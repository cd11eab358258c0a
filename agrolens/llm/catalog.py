"""The registered queries of this package, one per operator over its whole table, and their DuckDB oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolens.llm import (bpe, chat, decontam, jaccard, langid, licence, negatives, quality, repair, sharding, simhash, substring,
                          warc)
from agrolens.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD_TEXT = "</s>[INST] ok [/INST]"   # fixed value: the text of conversation -1
DAMAGE_EVERY = 97  # the second replica is damaged in pages whose id modulo 97 is one of these
DAMAGE = {"altered": 5, "longer": 11, "shorter": 17, "dropped": 23, "inserted": 31}


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_id(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TEXT).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return chat.digest(chat.examples(rows))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage some pages in a second replica (DAMAGE) and let the audit locate them."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    kind = F.col("page_id") % DAMAGE_EVERY
    hurt = pages.withColumn("html", F.when(kind == DAMAGE["altered"], F.concat(F.lit("x"), F.expr("substring(html, 2)")))
                            .when(kind == DAMAGE["longer"], F.concat("html", F.lit("x")))
                            .when(kind == DAMAGE["shorter"], F.expr("left(html, length(html) - 1)")).otherwise(F.col("html")))
    inserted = pages.where(kind == DAMAGE["inserted"]).withColumn("html", F.concat(F.lit("new "), "html"))
    two = hurt.where(F.coalesce(kind != DAMAGE["dropped"], F.lit(True))).unionByName(inserted)
    return warc.audit(warc.tree(warc.records(pages)), warc.tree(warc.records(two)))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence.licence_scan(table(spark, sf_dir, "documents"), embedded=True)


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage the conversations, repair them, and report every original conversation."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    audits = repair.repair(repair.damage(rows)).withColumnRenamed("conv_id", "__conv")
    every = rows.select("conv_id").distinct()
    return every.join(audits, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in repair.AUDIT_COLUMNS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_language_id, op3_simhash, op4_byte_bpe, op5_chat_format, op6_sharding,
    op7_decontamination, op8_substring_dedup, op9_warc_fixity, op10_licence_scan, op11_jaccard_join,
    op12_conversation_repair, op13_hard_negatives)}

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
_PLAIN = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _licence_sql() -> str:
    rows = ", ".join(
        f"({k}, '{name}', [{', '.join(repr(x) for x in licence.template_bigrams(text))}])"
        for k, (name, text) in enumerate(licence.TEMPLATES))
    return rf"""
WITH templates(k, name, grams) AS (VALUES {rows}),
units AS (
  SELECT doc_id, u AS line, unnest(string_split(coalesce(text, ''), chr(10))) AS unit
  FROM documents, (SELECT true AS u)
  UNION ALL
  SELECT doc_id, false, text FROM documents WHERE contains(text, chr(10))),
split AS (
  SELECT doc_id, line, string_split(trim(regexp_replace(lower(unit), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units),
grams AS (
  SELECT doc_id, line, list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS g
  FROM split WHERE len(w) > 1 AND len(list_distinct(w)) < 100),
scored AS (
  SELECT doc_id, line, g, k, name, 2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM grams AS x(doc_id, line, g), templates),
best AS (
  SELECT doc_id, line, max(dice) AS dice, arg_max(name, dice * 1000 - k) AS name, min(k) AS k
  FROM (SELECT *, row_number() OVER () AS r FROM scored WHERE dice >= {licence.MIN_DICE}) GROUP BY doc_id, line, g, r),
per AS (
  SELECT doc_id, max(dice) AS score, arg_min(name, k - dice * 1000) AS licence FROM best GROUP BY doc_id),
hits AS (
  SELECT doc_id, count(*) AS n FROM split WHERE line AND len(w) > 1 AND EXISTS (
    SELECT 1 FROM templates
    WHERE 2.0::DOUBLE * len(list_intersect(list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]), grams))
      >= {licence.MIN_DICE} * (len(list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))])) + len(grams)))
  GROUP BY doc_id)
SELECT d.doc_id, licence, coalesce(score, 0.0)::DOUBLE AS score, coalesce(n, 0)::BIGINT AS n_matches
FROM documents d LEFT JOIN per USING (doc_id) LEFT JOIN hits USING (doc_id)"""


def _repair_sql() -> str:
    """The damage by a CRC-32 table, and the cheapest (cost, audit, rows) from each state, from the last row back."""
    space = r"[\x20\x09-\x0D]"
    needs, after = {0: "user", 1: "user", 2: "assistant", 3: "user"}, {"user": 2, "assistant": 3}

    def put(cost, letter, row, tail):
        return f"{{'c': {cost} + {tail}.c, 'a': '{letter}' || {tail}.a, 'r': {row} || {tail}.r}}"

    def ways(s):
        to = after[needs[s]]
        initial = needs[s][0]
        stays = "fault NOT IN ('blank', 'duplicate')"
        out = [put(4, "D", "''", f"s{s}"),
               f"CASE WHEN {stays} THEN {put('3 + cut', 'R', f"chr(10) || '{needs[s]}:' || text", f's{to}')} END",
               f"CASE WHEN {stays} AND role[1] = '{initial}' THEN {put('cut', 'K', "chr(10) || role || ':' || text", f's{to}')} END"]
        if s == 0:
            out.append(f"CASE WHEN {stays} AND role[1] = 's' THEN {put('cut', 'K', "chr(10) || role || ':' || text", 's1')} END")
        return "list_sort(list_filter([" + ", ".join(out) + "], lambda x: x IS NOT NULL))[1]"

    def or_insert(s, tail, own="w"):
        return f"list_sort([{own}{s}, {put(3, 'I', f"chr(10) || '{needs[s]}:'", tail)}])[1]"

    ends = {0: (0, "", ""), 1: (6, "II", "chr(10) || 'user:' || chr(10) || 'assistant:'"), 2: (3, "I", "chr(10) || 'assistant:'"), 3: (0, "", "")}
    last = ", ".join(f"{{'c': {c}::BIGINT, 'a': '{a}', 'r': {r or repr('')}}} AS s{s}" for s, (c, a, r) in ends.items())
    return rf"""
WITH RECURSIVE
crc AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
keyed AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
kind AS (
  SELECT keyed.*, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(k, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 20 AS kind FROM keyed, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
  FROM kind, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
told AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS again,
    regexp_extract(text, '([^ 	-
]){space}*\z', 1) AS final FROM hurt),
r AS (
  SELECT *, row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total, lag(role[1]) OVER w || role[1] AS pair,
    CASE WHEN final = '' THEN 'blank' WHEN again > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM told WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again)),
step AS (
  SELECT DISTINCT conv_id, total AS n, {last} FROM r
  UNION ALL
  SELECT conv_id, n - 1, {or_insert(0, "n2")}, {or_insert(1, "n2")}, n2, n3
  FROM (SELECT *, {or_insert(2, "w3")} AS n2, {or_insert(3, "w2")} AS n3
    FROM (SELECT conv_id, n, {ways(0)} AS w0, {ways(1)} AS w1, {ways(2)} AS w2, {ways(3)} AS w3
      FROM (SELECT step.*, role, text, fault, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cut
        FROM step JOIN r ON step.conv_id IS NOT DISTINCT FROM r.conv_id AND step.n = r.n)))),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(s0.c, 0)::BIGINT AS cost,
  coalesce(s0.a, '') AS audit, sha256(coalesce(s0.r[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts ON o.conv_id IS NOT DISTINCT FROM facts.conv_id
LEFT JOIN (SELECT * FROM step WHERE n = 0) z ON o.conv_id IS NOT DISTINCT FROM z.conv_id"""


ORACLE = {
    "op5_chat_format": rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{ODD_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{ODD_TEXT}'),
f AS (
  SELECT *, length('{chat.START}{chat.END}')
       + length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g'))
       + length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g')) + 2 AS size,
    row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS total
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
p AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM f)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (role = 'assistant' OR n = total))::BIGINT AS formatted_chars
FROM p GROUP BY conv_id""",
    "op7_decontamination": rf"""
WITH b AS (SELECT item_id, {_PLAIN} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT item_id, w, least({decontam.WINDOW}, len(w)) AS n, unnest(range(1, len(w) - least({decontam.WINDOW}, len(w)) + 2)) AS i
        FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
hit AS (SELECT doc_id, dwin.n AS n, i, item_id FROM dwin JOIN win ON dwin.n = win.n AND dwin.k = win.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS t FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op8_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + {substring.WINDOW - 1}], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {substring.WINDOW} + 2)) AS i FROM d WHERE len(w) >= {substring.WINDOW})),
rep AS (SELECT doc_id, i FROM win WHERE k IN (SELECT k FROM win GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {substring.WINDOW})) AS p FROM rep),
word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS t
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op9_warc_fixity": rf"""
WITH one AS (SELECT page_id, url, html FROM pages),
two AS (
  SELECT page_id, url, CASE page_id % {DAMAGE_EVERY} WHEN {DAMAGE["altered"]} THEN 'x' || substring(html, 2)
    WHEN {DAMAGE["longer"]} THEN html || 'x' WHEN {DAMAGE["shorter"]} THEN left(html, length(html) - 1) ELSE html END AS html
  FROM pages WHERE page_id % {DAMAGE_EVERY} <> {DAMAGE["dropped"]}
  UNION ALL SELECT page_id, url, 'new ' || html FROM pages WHERE page_id % {DAMAGE_EVERY} = {DAMAGE["inserted"]}),
told AS (
  SELECT side, page_id, concat_ws(chr(13) || chr(10), 'WARC/1.0', 'WARC-Type: response', 'WARC-Target-URI: ' || coalesce(url, ''),
    'Content-Type: text/html', 'Content-Length: ' || strlen(coalesce(html, '')), '', coalesce(html, ''), '', '') AS record
  FROM (SELECT 1 AS side, * FROM one UNION ALL SELECT 2, * FROM two)),
r AS (
  SELECT side, page_id, page_id // {warc.PAGES_PER_ARCHIVE} AS archive, page_id % {warc.PAGES_PER_ARCHIVE} AS node,
    strlen(record) AS size, sha256(record) AS digest FROM told),
p AS (SELECT *, sum(size) OVER (PARTITION BY side, archive ORDER BY page_id, digest) AS e FROM r),
odd AS (
  SELECT *, row_number() OVER (PARTITION BY side, page_id ORDER BY e) AS n FROM p
  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.side <> p.side AND r.page_id = p.page_id AND r.digest = p.digest)),
paired AS (
  SELECT *, EXISTS (SELECT 1 FROM odd y WHERE y.side <> x.side AND y.page_id = x.page_id AND y.n = x.n) AS twin FROM odd x)
SELECT archive::BIGINT AS archive, node::BIGINT AS node, page_id, (e - size)::BIGINT AS first, e::BIGINT AS "end",
  CASE WHEN twin THEN 'altered' WHEN side = 1 THEN 'missing' ELSE 'extra' END AS state
FROM paired WHERE side = 1 OR NOT twin""",
    "op10_licence_scan": _licence_sql(),
    "op12_conversation_repair": _repair_sql(),
    "op13_hard_negatives": f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({negatives.SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= {negatives.POSITIVES})
SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND {negatives.LOW} * positive_score <= 100 * score AND 100 * score <= {negatives.HIGH} * positive_score
QUALIFY rank <= {negatives.NEGATIVES}""",
}
