"""The registered queries of this package, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.alignment import align
from clientele.llm.containment import contaminated
from clientele.llm.gray_index import near_duplicates
from clientele.llm.license_scan import scan
from clientele.llm.line_dedup import line_report
from clientele.llm.line_frequency import drop_boilerplate, quality_report
from clientele.llm.merkle import manifest
from clientele.llm.packing import pack_documents
from clientele.llm.pii import find_personal_data
from clientele.llm.rans import encode_documents, read_documents
from clientele.llm.role_repair import repair
from clientele.llm.scratch import scratch_path
from clientele.llm.site_tree import extract
from clientele.llm.suffix_dedup import repeat_report


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_site_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir))


def op3_range_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "corpus")
    encode_documents(_documents(spark, sf_dir), path)
    return read_documents(spark, path)


def op4_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(_documents(spark, sf_dir)).drop("host", "text_key")


def line_frequency_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_boilerplate(_documents(spark, sf_dir)).drop("lang", "n_chars")


def op5_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(_documents(spark, sf_dir))


def op7_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet")).drop("part", "pos")


def op8_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_documents(spark, sf_dir))


def op9_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contaminated(_documents(spark, sf_dir), benchmark).drop("text_key")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_documents(spark, sf_dir))


def op11_two_stage_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(_documents(spark, sf_dir))


def op12_fragment_monoid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_documents(spark, sf_dir))


def op13_bitmap_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return manifest(_documents(spark, sf_dir), seen={"n_chars": n_chars})


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_site_tree": op1_site_tree,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_range_coding": op3_range_coding,
    "op4_line_frequency": op4_line_frequency,
    "line_frequency_texts": line_frequency_texts,
    "op5_gray_index": op5_gray_index,
    "op6_line_dedup": op6_line_dedup,
    "op7_role_repair": op7_role_repair,
    "op8_bilstm_crf": op8_bilstm_crf,
    "op9_containment": op9_containment,
    "op10_license_scan": op10_license_scan,
    "op11_two_stage_suffixes": op11_two_stage_suffixes,
    "op12_fragment_monoid": op12_fragment_monoid,
    "op13_bitmap_rank": op13_bitmap_rank,
}

# The lower case of A-Z alone, and the white space that lines are stripped of.
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP6 = f"""
WITH docs AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, lines[i] AS line, i, translate(trim(lines[i], {_WHITE}), {_AZ}) AS key
    FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), firsts AS (
    SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT doc_id, line, i, first_doc IS NULL OR first_doc = doc_id AS kept
    FROM lines LEFT JOIN firsts USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT kept) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (kept), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP4 = f"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)),
            lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
    FROM documents
), grams AS (
    SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs WHERE len(words) > 2)
), covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams), range(3) AS r(j)
    WHERE n > 1 GROUP BY doc_id
), base AS (
    SELECT doc_id, source, text, lines, len(words) AS n_words,
        length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM docs LEFT JOIN covered USING (doc_id)
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base
), lines AS (
    SELECT doc_id, source, text,
        translate(trim(line, {_WHITE}), {_AZ}) AS key,
        length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
    FROM (SELECT doc_id, source, text, unnest(lines) AS line FROM base)
), frequent AS (
    SELECT source, key, count(DISTINCT text) AS n FROM lines GROUP BY source, key
), hosts AS (
    SELECT source, count(DISTINCT text) AS host_documents FROM base GROUP BY source
), lost AS (
    SELECT doc_id, sum(chars)::BIGINT AS lost_chars
    FROM lines JOIN frequent USING (source, key) JOIN hosts USING (source)
    WHERE n > 20 AND n > 0.1 * host_documents GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    coalesce(lost_chars, 0) AS lost_chars,
    NOT base_failed AND word_chars - coalesce(lost_chars, 0) >= 0.3 * word_chars AS kept
FROM failed LEFT JOIN lost USING (doc_id)
"""

LINE_TEXTS = f"""
WITH docs AS (
    SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
    SELECT doc_id, source, text, line, i, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS worded,
        translate(trim(line, {_WHITE}), {_AZ}) AS key,
        length(regexp_replace(line, '[\\x20\\x09-\\x0D]+', '', 'g')) AS chars
    FROM (SELECT *, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS i FROM docs)
), frequent AS (
    SELECT source, key, count(DISTINCT text) AS n FROM lines WHERE worded GROUP BY source, key
), hosts AS (
    SELECT source, count(DISTINCT text) AS host_documents FROM docs GROUP BY source
), above AS (
    SELECT source, key FROM frequent JOIN hosts USING (source)
    WHERE n > 20 AND n > 0.1 * host_documents OR n > 1000 OR n >= 5 AND n > 0.5 * host_documents
), marked AS (
    SELECT lines.*, worded AND a.key IS NOT NULL AS gone
    FROM lines LEFT JOIN above a ON lines.source = a.source AND lines.key = a.key
)
SELECT doc_id, source, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
    count(*) FILTER (NOT gone) AS kept_lines, count(*) FILTER (gone) AS lost_lines
FROM marked GROUP BY doc_id, source
HAVING coalesce(sum(chars) FILTER (NOT gone), 0) >= 0.3 * sum(chars)
"""

OP9 = f"""
WITH texts AS (
    SELECT 'doc' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'item', item_id, text FROM benchmark
), words AS (
    SELECT kind, id, list_filter(string_split_regex(
        translate(coalesce(text, ''), {_AZ}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM texts
), shingles AS (
    SELECT DISTINCT kind, id, array_to_string(w[i:i + 4], ' ') AS shingle
    FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT id AS item_id, count(*) AS n_shingles FROM shingles WHERE kind = 'item' GROUP BY id
)
SELECT doc_id, item_id, n_shared, n_shingles
FROM (
    SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared
    FROM shingles i JOIN shingles d USING (shingle)
    WHERE i.kind = 'item' AND d.kind = 'doc' GROUP BY ALL
) JOIN sizes USING (item_id)
WHERE n_shared >= 0.8 * n_shingles
"""


def _fields(n_chars: str) -> str:
    coded = [f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')" for x in ("doc_id", "source", "lang", n_chars, "text")]
    return f"sha256({' || '.join(coded)})"


# Checksums of decimal ids, bit by bit; trees level by level; a path is a list of steps, each
# a side and a sibling, or a blank without one.
OP13 = f"""
WITH RECURSIVE rows AS (
    SELECT *, xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 7 = 0 AS changed
    FROM documents
), leaves AS (
    SELECT doc_id, coalesce('=' || lang, '') AS g, {_fields("n_chars")} AS leaf,
        CASE WHEN changed THEN {_fields("(n_chars + 1)")} ELSE {_fields("n_chars")} END AS seen
    FROM rows
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), tree AS (
    SELECT g, 0 AS level, pos, leaf AS hash, n FROM placed
    UNION ALL
    SELECT g, level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM tree WHERE n > 1 GROUP BY g, level, pos // 2
), subroots AS (
    SELECT g, level AS top, hash AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n
    FROM tree WHERE n = 1
), forest AS (
    SELECT 0 AS level, pos, subroot AS hash, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (any_value(n) + 1) // 2
    FROM forest WHERE n > 1 GROUP BY level, pos // 2
), lower_steps AS (
    SELECT p.g, p.pos, list(coalesce(CASE WHEN (p.pos >> t.level) & 1 = 1 THEN 'L' ELSE 'R' END || o.hash, '') ORDER BY t.level) AS steps
    FROM placed p JOIN tree t ON t.g = p.g AND t.pos = p.pos >> t.level AND t.n > 1
    LEFT JOIN tree o ON o.g = t.g AND o.level = t.level AND o.pos = xor(t.pos, 1)
    GROUP BY p.g, p.pos
), upper_steps AS (
    SELECT s.g, list(coalesce(CASE WHEN (s.pos >> t.level) & 1 = 1 THEN 'L' ELSE 'R' END || o.hash, '') ORDER BY t.level) AS steps
    FROM subroots s JOIN forest t ON t.pos = s.pos >> t.level AND t.n > 1
    LEFT JOIN forest o ON o.level = t.level AND o.pos = xor(t.pos, 1)
    GROUP BY s.g
), paths AS (
    SELECT doc_id, leaf, seen, subroot, f.hash AS root, coalesce(l.steps, []) || coalesce(u.steps, []) AS steps
    FROM placed p JOIN subroots s USING (g) JOIN forest f ON f.n = 1
    LEFT JOIN lower_steps l ON l.g = p.g AND l.pos = p.pos LEFT JOIN upper_steps u ON u.g = p.g
), ends AS (
    SELECT *, sha256(array_to_string(list_transform(steps, lambda s: substring(s, 2)), '')) AS proof_sha256,
        list_reduce([seen] || steps, lambda h, s: sha256(
            CASE WHEN s[1] = 'L' THEN substring(s, 2) || h ELSE h || substring(s, 2) END)) AS folded_root
    FROM paths
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM ends
"""

ORACLES: dict[str, str] = {
    "op9_containment": OP9,
    "op4_line_frequency": OP4,
    "line_frequency_texts": LINE_TEXTS,
    "op6_line_dedup": OP6,
    "op13_bitmap_rank": OP13,
}
