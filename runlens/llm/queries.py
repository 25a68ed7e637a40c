"""Registered queries of the operators (production parameters, whole tables) and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from runlens.llm import minhash, toxicity, weak_quality
from runlens.llm.common import read
from runlens.llm.decontaminate import find_matches
from runlens.llm.filter_audit import audit, combinations, failures, letters
from runlens.llm.html_extract import extract
from runlens.llm.mixing import mix
from runlens.llm.quality_rules import BASE, MIN_WORDS, RATIOS, RULES, STOP_WORDS, SYMBOLS, apply_rules
from runlens.llm.resample import resample
from runlens.llm.sharding import NULL_KEY, U_DIGITS, assign_shards
from runlens.llm.simhash import hex_fingerprint, near_duplicates
from runlens.llm.substring_dedup import remove_repeats
from runlens.llm.token_files import read_documents, token_folder, write_tokens

SHARDS = {i: 1.0 for i in range(16)}
GROWN = {i: 1.0 for i in range(17)}


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents")
    t = F.coalesce("text", F.lit(""))
    slim = d.select("doc_id", (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"))
    return assign_shards(slim, "doc_id", SHARDS, GROWN).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_folder(spark)
    files = write_tokens(read(spark, sf_dir, "documents"), "doc_id", "text", folder,
                         public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return read_documents(files, folder).withColumnRenamed("key", "doc_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(read(spark, sf_dir, "documents"), "doc_id", "text")
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(read(spark, sf_dir, "documents").select("doc_id", "text"), "text").select(
        "doc_id", *BASE, *[F.round(r, 9).alias(r) for r in RATIOS], *[f"ok_{r.name}" for r in RULES], "base_failed", "kept")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def learned_from(doc_id):
        return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0

    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.classify(d, "doc_id", "text", read(spark, sf_dir, "labels"), "toxic", learned_from)
    return found.select("doc_id", (~learned_from(F.col("doc_id"))).alias("held_out"), "score", "predicted")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    return find_matches(d, "text", read(spark, sf_dir, "benchmark")).select("doc_id", "contaminated", "matches")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    d = d.select("doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    return mix(d, "doc_id", "text", "source", size="words").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies", "rate")


def op9_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select("doc_id", "text")
    return weak_quality.classify(d, "doc_id", "text").select("doc_id", "votes", "posterior", "score", "kept")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extract(read(spark, sf_dir, "pages"), "url", "html")
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(read(spark, sf_dir, "documents"), "doc_id", "text", read(spark, sf_dir, "benchmark"), "text")
    return found.select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")


def audited_filters() -> dict[str, Column]:
    return {
        "A": F.size("words") < 100,
        "B": 100 * F.size(F.array_distinct("words")) < 80 * F.size("words"),
        "C": 100 * F.regexp_count("text", F.lit("[A-Z]")) > 10 * F.char_length("text"),
        "D": F.col("text").rlike(r"[#$%&*|]"),
    }


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    filters = audited_filters()
    failed = failures(read(spark, sf_dir, "documents"), "doc_id", "text", "lang", filters, "E")
    combos = combinations(failed, read(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    return audit(combos, letters(filters, "E"))


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_token_files": op2_token_files,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_simhash": op7_simhash,
    "op8_mixing": op8_mixing,
    "op9_weak_quality": op9_weak_quality,
    "op10_html_extraction": op10_html_extraction,
    "op11_resample": op11_resample,
    "op12_minhash": op12_minhash,
    "op13_filter_audit": op13_filter_audit,
}


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _rules_sql() -> str:
    out = []
    for r in RULES:
        bounds = [f"{r.ratio} >= {r.low}"] * (r.low is not None) + [f"{r.ratio} <= {r.high}"] * (r.high is not None)
        out.append(f"({' AND '.join(bounds) or 'true'}) AS ok_{r.name}")
    return ", ".join(out)


# CRC-32 of a text's UTF-8 bytes from the byte table ``crc_table.b``.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode({0})) + 1),
  lambda i: ('0x' || hex(encode({0}))[2 * i - 1:2 * i])::BIGINT)), lambda c, y: xor(c >> 8, b[1 + (xor(c, y) & 255)])))"""
_CRC_TABLE = """SELECT list_transform(range(0, 256), lambda v: list_reduce([v, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, y: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS b"""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op3_substring_dedup": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(doc_id, 9223372036854775807) AS place, doc_id, {_WORDS} AS w FROM documents
), s AS (
  SELECT r, place, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20
), x AS (
  SELECT r, place, i, array_to_string(w[i:i + 19], ' ') AS win FROM s
), f AS (
  SELECT r, i, place > min(place) OVER (PARTITION BY win) OR i > min(i) OVER (PARTITION BY win, r) AS again FROM x
), p AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), m AS (
  SELECT r, i, max(CASE WHEN again THEN i END) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone, word
  FROM p LEFT JOIN f USING (r, i)
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(count(*) FILTER (gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN m USING (r) GROUP BY r, doc_id, w""",
    "op4_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents
), p AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), g AS (
  SELECT r, i, word,
         word || ' ' || lead(word, 1) OVER q || ' ' || lead(word, 2) OVER q AS gram
  FROM p WINDOW q AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, gram) > 1 AS again FROM g WHERE gram IS NOT NULL
), covered AS (
  SELECT g.r, g.i, coalesce(bool_or(t.again), false) AS hit
  FROM g LEFT JOIN twice t ON t.r = g.r AND t.i BETWEEN g.i - 2 AND g.i GROUP BY 1, 2
), rep AS (
  SELECT r, count(*) FILTER (hit) AS n_repeat_words FROM covered GROUP BY r
), l AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) AS split_lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), b AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines,
         coalesce(rep.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(l.n_lines, 0) AS n_lines,
         len(regexp_extract_all(text, '\p{{Lu}}')) AS uppers, len(regexp_extract_all(text, '\p{{L}}')) AS letters,
         len(list_filter(w, lambda x: lower(x) IN ({_quoted(STOP_WORDS)}))) AS stops
  FROM d LEFT JOIN l ON l.r = d.r LEFT JOIN rep ON rep.r = d.r
), m AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_length,
         CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 THEN stops / n_words ELSE 0 END AS stop_word_ratio,
         CASE WHEN letters > 0 THEN uppers / letters ELSE 0 END AS capital_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM b
), k AS (SELECT *, {_rules_sql()} FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       {", ".join(f"round({r}, 9) AS {r}" for r in RATIOS)},
       {", ".join(f"ok_{r.name}" for r in RULES)}, base_failed,
       NOT base_failed AND {" AND ".join(f"ok_{r.name}" for r in RULES)} AS kept
FROM k""",
    "op11_resample": rf"""
WITH crc_table AS ({_CRC_TABLE}), t AS (
  SELECT true AS doc, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark
), w AS (
  SELECT doc, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t
), f AS (
  SELECT doc, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM w
), per AS (
  SELECT doc, r, f, count(*) AS n FROM f GROUP BY ALL
), bucket AS (
  SELECT f, {_CRC.format("f")} % 10000 AS bucket FROM (SELECT DISTINCT f FROM per), crc_table
), sides AS (
  SELECT bucket, sum(n) FILTER (doc) AS s, sum(n) FILTER (NOT doc) AS t FROM per JOIN bucket USING (f) GROUP BY bucket
), sums AS (
  SELECT coalesce(sum(s), 0)::DOUBLE AS big_s, coalesce(sum(t), 0)::DOUBLE AS big_t FROM sides
), gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (big_s + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (big_t + 10000))))::BIGINT AS gain
  FROM sides, sums
), weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM per JOIN bucket USING (f) JOIN gain USING (bucket) WHERE doc GROUP BY r
), scored AS (
  SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weights USING (r) WHERE doc
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC) AS place,
         5 * (count(*) FILTER (n_words >= 20) OVER ()) // 100 AS drawn
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank FROM ranked""",
    "op12_minhash": rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT r, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d
), n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r
), common AS (
  SELECT a.r AS a, b.r AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.r < b.r GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * i >= 85 * (na.n + nb.n - i)
), either AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(r, x) AS (
  SELECT r, r FROM d UNION SELECT reach.r, either.b FROM reach JOIN either ON reach.x = either.a
), c AS (
  SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.x GROUP BY reach.r
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN c USING (r) LEFT JOIN n USING (r)""",
    "op13_filter_audit": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
), e AS (
  SELECT r, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM d
), l AS (
  SELECT doc_id, max(quality) FILTER (quality = 1) AS q, max(toxic) FILTER (toxic = 1) AS x FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(q = 1, false) AS good, coalesce(x = 1, false) AS toxic,
         [CASE WHEN len(w) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' END,
          CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' END,
          CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN e THEN 'E' END] AS fails
  FROM d JOIN e USING (r) LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, good, toxic, list_filter(fails, lambda x: x IS NOT NULL) AS fails, count(*) AS n FROM f GROUP BY ALL
), one AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM one a, one b, one c, one d, one e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS earlier
  FROM orders, (SELECT unnest(range(1, 6))::INT AS step) AS five
), x AS (
  SELECT part, filter_order, step, own, n, good, toxic, list_contains(fails, own) AS hit, len(fails) AS n_fails,
         len(list_filter(fails, lambda y: contains(earlier, y))) > 0 AS gone
  FROM c, steps
), counted AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (hit AND n_fails = 1), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM x GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM counted""",
}
