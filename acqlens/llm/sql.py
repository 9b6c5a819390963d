"""DuckDB statements for the queries that SQL can express (on the tables of a scale-factor folder)."""
from __future__ import annotations

# crc32 of the UTF-8 bytes of a word, from the table of its reflected polynomial
_CRC = """
crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i) x),
word_crc AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(len(hex(w)) // 2),
      lambda i: CAST('0x' || substr(hex(w), 2 * i + 1, 2) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS crc
  FROM (SELECT DISTINCT w FROM all_words) d, crc_table)"""

_WORDS = r"""unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w"""

OP12 = f"""
WITH doc_words AS (SELECT doc_id, {_WORDS} FROM documents),
goal_words AS (SELECT {_WORDS} FROM benchmark),
all_words AS (SELECT w FROM doc_words UNION ALL SELECT w FROM goal_words),
{_CRC},
buckets AS (SELECT unnest(range(10000)) AS bucket),
source AS (SELECT crc % 10000 AS bucket, count(*) AS s FROM doc_words JOIN word_crc USING (w) GROUP BY 1),
goal AS (SELECT crc % 10000 AS bucket, count(*) AS t FROM goal_words JOIN word_crc USING (w) GROUP BY 1),
sums AS (SELECT (SELECT count(*) FROM doc_words) AS all_s, (SELECT count(*) FROM goal_words) AS all_t),
gains AS (
  SELECT bucket, floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (all_s + 10000) AS DOUBLE)
                                 / CAST((coalesce(s, 0) + 1) * (all_t + 10000) AS DOUBLE))) AS gain
  FROM buckets LEFT JOIN source USING (bucket) LEFT JOIN goal USING (bucket), sums),
weights AS (
  SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*)) AS weight
  FROM doc_words JOIN word_crc USING (w) JOIN gains ON bucket = crc % 10000 GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')),
      1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM documents d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)"""

ORACLES: dict[str, str] = {"op12_importance_resampling": OP12}
