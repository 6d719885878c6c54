"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight.llm import (
    credentials,
    jaccard,
    langid,
    lines,
    main_text,
    merkle,
    mixing,
    neighbours,
    packing,
    rules,
    spelling,
    token_counts,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines", "n_exact", "n_near", "text")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_groups(_table(spark, sf_dir, "documents"))


#: Sources are evened out, languages get fixed shares, text forms are nearly kept.
MARGINS = {
    "source": 0.7,
    "lang": {"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1},
    "topic": 0.9,
}


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), MARGINS)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, F.col("vec_id") % 50 == 0)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents are verified with a text that lost its line breaks."""
    lost = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    seen = {"text": F.when(lost, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    rows = merkle.manifest(_table(spark, sf_dir, "documents"), seen=seen)
    return rows.drop("siblings")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_token_counts,
        op3_packing,
        op4_quality_rules,
        op5_language_id,
        op6_jaccard_join,
        op7_mixing,
        op8_nearest_neighbours,
        op9_warc,
        op10_main_text,
        op11_secret_scan,
        op12_spelling_variants,
        op13_merkle_manifest,
    )
}

_WHITE = r"[\x20\x09-\x0D]"

SQL: dict[str, str] = {
    "op4_quality_rules": rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_WHITE}'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
         coalesce(text, '') AS text
  FROM documents
), win AS (
  SELECT r, unnest(range(1, len(w) - 6)) AS i, w FROM docs WHERE len(w) >= 8
), keyed AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k FROM win
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM keyed) WHERE n > 1
), cover AS (
  SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r
), measured AS (
  SELECT d.r, doc_id, source, len(w) AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(list_distinct(l)) AS n_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM docs d LEFT JOIN cover c USING (r)
), ruled AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * n_symbols > 30 * n_words
         OR 100 * n_dup_lines > 50 * (n_dup_lines + n_lines)
         OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed
  FROM measured
), hosts AS (
  SELECT source, count(*) AS documents, sum(failed::INT) AS failures FROM ruled GROUP BY source
), prior AS (
  SELECT m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 1e6 END AS weight
  FROM (SELECT avg(failures / documents) AS m, var_pop(failures / documents) AS v FROM hosts)
), good AS (
  SELECT source, (failures + m * weight) / (documents + weight) <= 0.5 AS good FROM hosts, prior
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
       n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT failed AND good AS kept
FROM ruled r JOIN good g ON r.source IS NOT DISTINCT FROM g.source
""",
    "op9_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest FROM pages
), f AS (SELECT digest, min(page_id) AS first_id FROM p GROUP BY digest)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN strlen(html) >= 100 AND page_id <> first_id
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM p JOIN f USING (digest)
""",
}

#: crc32 of the bytes of ``word``, as DuckDB has none: its table from the rule, then a fold.
_CRC = """
bits AS (
  SELECT list(list_reduce(list_prepend(v, range(8)),
              lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY v) AS t
  FROM (SELECT unnest(range(256)) AS v)
)"""


def _crc(text: str) -> str:
    """SQL for the unsigned crc32 of a text; needs ``bits`` in scope."""
    raw = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), (2 * i + 1)::INT, 2))::BIGINT)"
    step = "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {raw}), {step}), 4294967295)"


SQL["op12_spelling_variants"] = f"""
WITH RECURSIVE {_CRC}, runs AS (
  SELECT doc_id, w, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS w FROM documents)
  GROUP BY doc_id, w
), hashed AS (
  SELECT w, n, {_crc("concat(doc_id, ':', w)")} AS h FROM runs, bits WHERE length(w) >= 5
), changed AS (
  SELECT n, CASE WHEN h % 97 = 0 THEN w[1:(h % length(w))::INT] || w[(h % length(w) + 2)::INT:] ELSE w END AS word
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS p FROM words
), shorter AS (
  SELECT DISTINCT word, word[1:p - 1] || word[p + 1:] AS less FROM places
), masked AS (
  SELECT word, p, word[1:p - 1] || '*' || word[p + 1:] AS mask FROM places
), near AS (
  SELECT s.word AS a, less AS b FROM shorter s JOIN words w ON less = w.word
  UNION SELECT less, s.word FROM shorter s JOIN words w ON less = w.word
  UNION SELECT x.word, y.word FROM masked x JOIN masked y ON x.mask = y.mask AND x.word <> y.word
), best AS (
  SELECT a, count(*) AS n_near, max(n) AS top, min(b) FILTER (n = m) AS b
  FROM (SELECT a, b, n, max(n) OVER (PARTITION BY a) AS m FROM near JOIN words ON b = word) GROUP BY a
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * n THEN b END AS form,
         CASE WHEN top >= 2 * n THEN top END AS form_n
  FROM words LEFT JOIN best ON word = a
), chain AS (
  SELECT word, word AS last FROM words
  UNION ALL SELECT chain.word, form FROM chain JOIN formed f ON last = f.word WHERE form IS NOT NULL
), ends AS (
  SELECT chain.word, last AS root FROM chain JOIN formed f ON last = f.word WHERE form IS NULL
)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN ends USING (word)
"""


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    parts = [f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}) || ':' || {f} END" for f in fields]
    return f"sha256({' || '.join(parts)})"


SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE {_CRC}, docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_crc("doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")}
         ELSE {_leaf("text")} END AS seen
  FROM documents, bits
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM docs
), lv AS (
  SELECT 0 AS level, source, i, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM placed
  UNION ALL
  SELECT level + 1, source, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3
  FROM lv WHERE n > 1 GROUP BY level, source, i // 3, n
), subs AS (
  SELECT source, h AS subroot, level AS top,
         row_number() OVER (ORDER BY source IS NOT NULL, source) - 1 AS i FROM lv WHERE n = 1
), up AS (
  SELECT 0 AS level, i, subroot AS h, count(*) OVER () AS n FROM subs
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), (n + 2) // 3 FROM up WHERE n > 1 GROUP BY level, i // 3, n
), runs AS (
  SELECT p.r, l.level AS step, l.i, l.h, l.i = p.i // (3 ** l.level)::BIGINT AS own
  FROM placed p JOIN lv l ON l.source IS NOT DISTINCT FROM p.source AND l.n > 1
   AND l.i // 3 = p.i // (3 ** (l.level + 1))::BIGINT
  UNION ALL
  SELECT p.r, s.top + u.level, u.i, u.h, u.i = s.i // (3 ** u.level)::BIGINT
  FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source
  JOIN up u ON u.n > 1 AND u.i // 3 = s.i // (3 ** (u.level + 1))::BIGINT
), steps AS (
  SELECT r, step, coalesce(string_agg(h, '' ORDER BY i) FILTER (NOT own), '') AS others,
         count(*) FILTER (NOT own AND i < mine) AS before
  FROM (SELECT *, max(i) FILTER (own) OVER (PARTITION BY r, step) AS mine FROM runs) GROUP BY r, step
), proofs AS (
  SELECT r, sha256(string_agg(others, '' ORDER BY step)) AS proof, max(step) AS last FROM steps GROUP BY r
), folds AS (
  SELECT r, 0 AS step, seen AS h FROM docs
  UNION ALL
  SELECT f.r, f.step + 1, sha256(others[1:64 * before] || h || others[64 * before + 1:])
  FROM folds f JOIN steps s ON s.r = f.r AND s.step = f.step
)
SELECT p.doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root,
       f.h = root AS verified
FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source
CROSS JOIN (SELECT h AS root FROM up WHERE n = 1) LEFT JOIN proofs USING (r)
JOIN folds f ON f.r = p.r AND f.step = coalesce(last + 1, 0)
"""
