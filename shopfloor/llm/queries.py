"""The registered queries: each a thin call of its operator over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, chat, docstats, html_main, mixing, nn_descent, pu_quality, quality_rules, resharding, simhash_vp, toxicity, turn_repair, warc
from .common import fresh_path, stage, table

VOCABULARY, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED = [5, 2, 1], 3, 17
SHINGLE, BITS = 3, 2
OLD_SHARDS, SHARDS = 20, 24


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, vocabulary_path()).drop("text")
    back = bpe.decode(coded, vocabulary_path())
    return back.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stage(table(spark, sf_dir, "documents")
                 .select("doc_id", "source", mixing.word_count("text").alias("size")), "op3")
    fitted = mixing.fit(docs, MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED)
    return mixing.apply(docs, fitted, MIX_SEED).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':17'), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 3 * source_size AS cap FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST) AS k FROM w),
l AS (SELECT *, CAST((SELECT sum(source_size) FROM o) AS BIGINT)
             - CAST(coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT)
               AS remaining,
             CAST(sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights
      FROM o),
f AS (SELECT remaining, weights, k FROM l WHERE weight * remaining <= cap * weights ORDER BY k LIMIT 1),
t AS (SELECT l.source, l.source_size,
             CASE WHEN f.k IS NULL OR l.k < f.k THEN CAST(l.cap AS DOUBLE)
                  ELSE l.weight * CAST(f.remaining AS DOUBLE) / f.weights END AS target
      FROM l LEFT JOIN f ON true),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
g AS (SELECT d.source, d.doc_id, d.h, sum(size) AS size FROM d GROUP BY ALL),
p AS (SELECT g.*, coalesce(sum(g.size) OVER (PARTITION BY g.source ORDER BY g.h, g.doc_id NULLS FIRST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM g)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(d.size * (floor(r.rate) + CASE WHEN rate - floor(rate) > 0
            AND p.ahead + p.size / 2 <= (rate - floor(rate)) * r.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
       JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.doc_id IS NOT DISTINCT FROM p.doc_id
"""


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return pu_quality.score(docs, labels).select("doc_id", docstats.held_out().alias("held_out"), "score", "predicted")


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resharding.reshard(table(spark, sf_dir, "documents"), OLD_SHARDS, SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "old_shard")


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.rate(docs, labels).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "quality_score")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    captures = stage(warc.assemble(warc.read(spark, path, blocks=False)), "op8").select(
        "capture_id", F.col("metadata")[0]["fields"]["page-id"].cast("long").alias("page_id"),
        F.col("metadata")[0]["fields"]["payload-length"].cast("long").alias("length"), "response.*")
    # a revisit names a record: the page is that of the record that was read back
    named = captures.where("type = 'response'").select(F.col("record_id").alias("named"), F.col("page_id").alias("origin"))
    sound = F.assert_true((F.col("type") == "revisit") & (F.col("refers_to").isNull() == F.lit(False)) & F.col("named").isNotNull()
                          | (F.col("type") == "response") & F.col("intact"), F.lit("a record is damaged or refers to none"))
    return captures.join(named, F.col("refers_to") == F.col("named"), "left").where(F.coalesce(sound.cast("boolean"), F.lit(True))).select(
        "page_id", F.coalesce("payload_bytes", "length").alias("payload_bytes"), "payload_digest",
        F.col("type").alias("record_type"), F.col("origin").alias("refers_to"))


OP8_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < first THEN first END AS refers_to
FROM m
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score(docs, labels).select("doc_id", docstats.held_out().alias("held_out"), "score", "predicted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_vp.near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE, bits=BITS)
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = align.align(docs, vocabulary_path(), vocabulary_path(PIECES))
    aligned = stage(aligned.withColumn("mark", F.monotonically_increasing_id()), "op11")
    rows = aligned.withColumn("n_links", F.size("links").cast("long")).drop("links")
    return rows.join(align.rate_links(aligned, "mark"), "mark", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256")


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_main.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    messages, audits = turn_repair.repair(turn_repair.damage(rows))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return turn_repair.merged([audits, turn_repair.digests(messages), rows.select("conv_id").distinct()]).select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _op13_sql() -> str:
    """The recursion carries, by state, cost (9 digits) and audit as one text, so that
    `least` takes the cheapest and of those the ASCII-least.  It has no inserts: one
    costs 5, while dropping its partner instead (2), and where that strands a system
    message this as well (2), costs at most 4."""
    def add(state: str, cost: str, letter: str) -> str:
        return (f"lpad(CAST(CAST(left({state}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0')"
                f" || substr({state}, 10) || '{letter}'")

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN stays AND initial = '{initial}' THEN {add(state, 'extra', 'K')} END"

    def rerole(state: str) -> str:
        return f"CASE WHEN stays THEN {add(state, '1 + extra', 'R')} END"

    user = ", ".join(f"{keep(s, 'u')}, {rerole(s)}" for s in ("nil", "sys", "asst"))
    blank = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k:
         CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
hit AS (
  SELECT k.*, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(key) + 1),
         lambda i: CAST(ord(substr(key, i, 1)) AS BIGINT))), lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) % 20 AS h
  FROM keyed k, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE h <> 0),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, left(role, 1) AS initial,
         rtrim(text, {blank}) AS seen,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS n
  FROM hurt),
marked AS (
  SELECT *, CASE WHEN seen = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY c ORDER BY n) AS before
  FROM placed),
step AS (
  SELECT c, n, initial, fault IN ('', 'truncated') AS stays, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra
  FROM marked),
dp AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS n, '000000000' AS nil, CAST(NULL AS VARCHAR) AS sys,
         CAST(NULL AS VARCHAR) AS usr, CAST(NULL AS VARCHAR) AS asst FROM step
  UNION ALL
  SELECT d.c, s.n, {add('nil', '2', 'D')}, least({add('sys', '2', 'D')}, {keep('nil', 's')}),
         least({add('usr', '2', 'D')}, {user}), least({add('asst', '2', 'D')}, {keep('usr', 'a')}, {rerole('usr')})
  FROM dp d JOIN step s ON s.c = d.c AND s.n = d.n + 1),
best AS (
  SELECT c, CAST(left(least(nil, asst), 9) AS BIGINT) AS cost, substr(least(nil, asst), 10) AS audit
  FROM dp JOIN (SELECT c, max(n) AS n FROM step GROUP BY c) USING (c, n)),
stay AS (
  SELECT m.*, substr(b.audit, CAST(m.n AS BIGINT), 1) AS edit,
         row_number() OVER (PARTITION BY c ORDER BY m.n) AS place,
         first_value(initial = 's' AND substr(b.audit, CAST(m.n AS BIGINT), 1) = 'K') OVER (PARTITION BY c ORDER BY m.n) AS sys
  FROM marked m JOIN best b USING (c) WHERE substr(b.audit, CAST(m.n AS BIGINT), 1) <> 'D'),
said AS (
  SELECT c, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - CASE WHEN sys THEN 1 ELSE 0 END) % 2 = 1
                            THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY n) AS repaired
  FROM stay GROUP BY c),
told AS (
  SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY c)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN told ON i.conv_id IS NOT DISTINCT FROM told.conv_id
LEFT JOIN best ON told.c = best.c LEFT JOIN said ON told.c = said.c
"""


OP13_SQL = _op13_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_bpe": op1_bpe, "op2_chat": op2_chat, "op3_mixing": op3_mixing, "op4_quality": op4_quality,
            "op5_nn_descent": op5_nn_descent,
            "op6_resharding": op6_resharding, "op7_rules": op7_rules, "op8_warc": op8_warc, "op9_toxicity": op9_toxicity,
            "op10_simhash": op10_simhash, "op11_alignment": op11_alignment,
            "op12_main_text": op12_main_text,
            "op13_turn_repair": op13_turn_repair}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3_SQL, "op8_warc": OP8_SQL, "op13_turn_repair": OP13_SQL}
