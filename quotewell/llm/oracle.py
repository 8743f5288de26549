"""SQL of those queries of this subpackage that SQL can state."""

ORACLE_SQL = {
    "op12_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
runs AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM places, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2 AND n >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.k, c.a, c.cut, x.n AS l, y.n AS r, (2000000::HUGEINT * c.a) // (x.n + y.n) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (
  SELECT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS phrase, max(c.a) AS longer
  FROM candidates c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)
  WHERE m < c.k AND i + m - 1 <= c.k GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase)::BIGINT AS rank, s.phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n AS n, score::BIGINT AS score
FROM weakest s JOIN totals t ON t.lang = s.lang LEFT JOIN parts p ON p.lang = s.lang AND p.phrase = s.phrase
WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a
QUALIFY rank <= 2000
""",
}
