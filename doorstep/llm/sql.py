"""Comparison SQL of the operators that SQL can express, for the engine results are compared with."""

#: crc32 of a decimal number, byte by byte and bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({of}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                               lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))))"""


def _field(column):
    text = f"cast({column} AS varchar)"
    return f"coalesce(concat(strlen({text}), ':', {text}), '-')"


def _leaf(text):
    return f"sha256(concat({', '.join(_field(c) for c in ['doc_id', 'source', 'lang', 'n_chars', text])}))"


OP12_MANIFEST = f"""
WITH RECURSIVE leaves AS (
SELECT row_number() OVER () AS row_id, doc_id, source, {_leaf('text')} AS leaf,
       CASE WHEN {_CRC32.format(of='cast(doc_id AS varchar)')} % 2 = 0
            THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS changed
FROM documents),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
                  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
nodes AS (
SELECT tree, 0 AS level, place, leaf AS digest FROM placed
UNION ALL
SELECT tree, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place))
FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1 GROUP BY tree, level, place // 3),
counted AS (SELECT *, count(*) OVER (PARTITION BY tree, level) AS n FROM nodes),
subroots AS (SELECT tree AS place, digest FROM counted WHERE n = 1),
tops AS (
SELECT 0 AS level, place, digest FROM subroots
UNION ALL
SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place))
FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, place // 3),
top_counted AS (SELECT *, count(*) OVER (PARTITION BY level) AS n FROM tops),
runs AS (
SELECT tree, level, place // 3 AS run, list(digest ORDER BY place) AS digests FROM counted WHERE n > 1 GROUP BY ALL
UNION ALL
SELECT -1, level, place // 3, list(digest ORDER BY place) FROM top_counted WHERE n > 1 GROUP BY level, place // 3),
powers AS (SELECT k AS level, (3 ** k)::BIGINT AS power FROM range(40) t(k)),
met AS (
SELECT row_id, level AS step, (place // power) % 3 AS spot, digests
FROM placed JOIN powers ON true JOIN runs USING (tree, level) WHERE runs.run = place // (power * 3)
UNION ALL
SELECT row_id, 100 + level, (placed.tree // power) % 3, digests
FROM placed JOIN powers ON true JOIN runs USING (level) WHERE runs.tree = -1 AND runs.run = placed.tree // (power * 3)),
steps AS (
SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY step) AS step,
       coalesce(array_to_string(digests[1:spot], ''), '') AS earlier, coalesce(array_to_string(digests[spot + 2:], ''), '') AS later
FROM met),
proofs AS (SELECT row_id, sha256(string_agg(earlier || later, '' ORDER BY step)) AS proof FROM steps GROUP BY row_id),
folds AS (
SELECT row_id, 0::BIGINT AS step, changed AS digest FROM placed
UNION ALL
SELECT f.row_id, s.step, sha256(s.earlier || f.digest || s.later)
FROM folds f JOIN steps s ON s.row_id = f.row_id AND s.step = f.step + 1),
ends AS (SELECT row_id, arg_max(digest, step) AS digest FROM folds GROUP BY row_id),
root AS (SELECT digest FROM top_counted WHERE n = 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, coalesce(q.proof, sha256('')) AS proof_sha256,
       e.digest AS folded_root, e.digest = r.digest AS verified
FROM placed p JOIN subroots s ON s.place = p.tree JOIN ends e USING (row_id) LEFT JOIN proofs q USING (row_id) CROSS JOIN root r
"""

_SEPARATORS = "[.,;:!?\\n\\x0B\\f\\r]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP13_PHRASES = f"""
WITH pieces AS (
SELECT coalesce(lang, 'und') AS lang,
       unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_SEPARATORS}')) AS piece
FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS words FROM pieces),
totals AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM split GROUP BY lang),
grams AS (
SELECT lang, size, array_to_string(words[spot:spot + size - 1], ' ') AS phrase
FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS spot
      FROM split, (SELECT unnest(range(1, 6)) AS size) WHERE len(words) >= size)),
known AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
parts AS (SELECT *, string_split(phrase, ' ') AS words FROM known WHERE size > 1),
cuts AS (
SELECT p.lang, p.phrase, p.a, k, l.a AS l, r.a AS r, n,
       (1000::HUGEINT * p.a * n) // (l.a::HUGEINT * r.a) AS score
FROM (SELECT *, unnest(range(1, size)) AS k FROM parts) p
JOIN known l ON l.lang = p.lang AND l.phrase = array_to_string(words[:k], ' ')
JOIN known r ON r.lang = p.lang AND r.phrase = array_to_string(words[k + 1:], ' ')
JOIN totals t ON t.lang = p.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
SELECT lang, array_to_string(words[spot:spot + m - 1], ' ') AS phrase, max(a) AS most
FROM (SELECT *, unnest(range(1, size - m + 2)) AS spot FROM (SELECT *, unnest(range(2, size)) AS m FROM parts)) GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE coalesce(most < a, true)
QUALIFY rank <= 2000
"""

OP7_PIVOTS = """
WITH vectors AS (
SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(64 * cast(x AS double))) AS v
FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
SELECT q.row_id, q.vec_id AS query_id, c.vec_id, cast(list_inner_product(q.v, c.v) AS bigint) AS score
FROM vectors q JOIN vectors c ON c.row_id <> q.row_id WHERE q.vec_id % 20 = 0)
SELECT query_id, cast(row_number() OVER (PARTITION BY row_id ORDER BY score DESC, vec_id) AS int) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""
