"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[.,;:!?\n\x0B\f\r]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), spans AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE len(w) > 0
), grams AS (
    SELECT lang, array_slice(w, i, i + k - 1) AS g
    FROM spans, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)
), f AS (
    SELECT lang, g, count(*) AS a FROM grams GROUP BY lang, g HAVING count(*) >= 30
), cuts AS (
    SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM f WHERE len(g) > 1
), costs AS (
    SELECT c.lang, c.g, c.a, c.k, x.a AS l, y.a AS r,
           (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
    FROM cuts c
    JOIN f x ON x.lang = c.lang AND x.g = array_slice(c.g, 1, c.k)
    JOIN f y ON y.lang = c.lang AND y.g = array_slice(c.g, c.k + 1, len(c.g))
), least AS (
    SELECT * FROM costs QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), parts AS (
    SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS i
    FROM f, (SELECT unnest([2, 3]) AS m) WHERE m < len(g)
), covered AS (
    SELECT lang, array_slice(g, i, i + m - 1) AS g, max(a) AS longer FROM parts GROUP BY 1, 2
), kept AS (
    SELECT least.* FROM least LEFT JOIN covered USING (lang, g)
    WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
), named AS (
    SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM kept
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM named JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
