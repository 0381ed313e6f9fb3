"""DuckDB SQL for the operators that SQL can express, written from their definitions."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

IMPORTANCE_RESAMPLING = rf"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)),
      lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
    FROM range(256) AS r(i))
),
texts AS (
  SELECT 'doc' AS side, doc_id, text FROM documents
  UNION ALL SELECT 'target', NULL, text FROM benchmark
),
worded AS (
  SELECT side, doc_id, row_number() OVER () AS rn, regexp_extract_all(
    COALESCE({_LOWER}, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts
),
grams AS (
  SELECT side, rn, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS gram
  FROM worded
),
spelled AS (
  SELECT gram, list_transform(range(octet_length(encode(gram))),
    lambda i: ('0x' || substr(hex(encode(gram)), 2 * i + 1, 2))::BIGINT) AS bytes
  FROM (SELECT DISTINCT gram FROM grams)
),
bucketed AS (
  SELECT gram, xor(list_reduce(list_concat([4294967295], bytes),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM spelled, crc_table
),
counted AS (
  SELECT bucket, count(*) FILTER (side = 'doc') AS s, count(*) FILTER (side = 'target') AS t
  FROM grams JOIN bucketed USING (gram) GROUP BY bucket
),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)))) AS BIGINT) AS gain
  FROM counted
),
weighed AS (
  SELECT rn, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM grams JOIN bucketed USING (gram) JOIN gains USING (bucket) WHERE side = 'doc' GROUP BY rn
),
scored AS (
  SELECT doc_id, rn, len(w) AS n_words, COALESCE(n_features, 0) AS n_features, COALESCE(weight, 0) AS weight,
    COALESCE(weight, 0) + CAST(floor(-1000 * ln(-ln(
      (('0x' || substr(sha256('42:' || COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE)
      / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM worded LEFT JOIN weighed USING (rn) WHERE side = 'doc'
),
placed AS (
  SELECT rn, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (rn)
"""

PHRASE_COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
runs AS (SELECT lang, w, i, unnest(range(1, 5)) AS m FROM starts),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM runs WHERE i + m - 1 <= len(w) GROUP BY ALL
),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE m >= 2 AND f >= 30
),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts AS c
  JOIN grams AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN grams AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.m], ' ')
),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inner_starts AS (SELECT lang, m, w, a, unnest(range(1, m)) AS i FROM candidates WHERE m >= 3),
inner_runs AS (SELECT lang, m, w, a, i, unnest(range(2, m)) AS size FROM inner_starts),
around AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS most
  FROM inner_runs WHERE i + size - 1 <= m GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best LEFT JOIN around USING (lang, phrase) JOIN totals USING (lang)
WHERE most IS NULL OR 100 * most < 80 * a
QUALIFY rank <= 2000
"""
