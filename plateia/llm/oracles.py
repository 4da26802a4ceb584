"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

from plateia.llm.licenses import NOTICES, PHRASES, prepare, words_of

ORACLES: dict[str, str] = {}

ORACLES["op1_top_inner_products"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""

ORACLES["op6_warc_archives"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> kept THEN kept END AS refers_to
FROM k
"""

ORACLES["op10_token_rollup"] = r"""
WITH l AS (
  SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY doc_id
), d AS (
  SELECT source, lang, coalesce(text, '') AS text, l.toxic
  FROM documents LEFT JOIN l USING (doc_id) WHERE l.toxic IS NULL OR l.toxic <> 1
), c AS (
  SELECT source, lang, 'words-1' AS tokenizer,
         len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) AS n FROM d WHERE toxic IS NULL
  UNION ALL
  SELECT source, lang, 'words-2', len(regexp_extract_all(text, '\p{L}+')) FROM d WHERE toxic IS NOT NULL
  UNION ALL
  SELECT source, lang, 'pieces-1',
         len(regexp_extract_all(text, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9 \t\n\x0B\f\r]')) FROM d
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens
FROM c GROUP BY source, lang, tokenizer
"""

# Words are runs without ASCII blanks, with A-Z in lower case.
ORACLES["op7_ngram_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' ')) END
  ) AS shingle, least(len(words), 4) AS width FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.width = b.width AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), e AS (
  SELECT a, b FROM l JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)
"""


def _listed(words: object) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


_NOTICES = ",\n    ".join(
    f"({number}, '{n.label}', {n.stride}, {n.needed}, {_listed(n.words)})"
    for number, n in enumerate(prepare(NOTICES, 80))
)
_PHRASES = ",\n    ".join(f"('{label}', {_listed(words_of(phrase))})" for phrase, label in PHRASES)

# A block is 2 * stride words at every stride; a notice needs 80 percent of its distinct words.
ORACLES["op11_license_scan"] = rf"""
WITH notices(notice, label, stride, needed, words) AS (VALUES
    {_NOTICES}
), phrases(label, words) AS (VALUES
    {_PHRASES}
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), w AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM d
), p AS (
  SELECT r, label, place FROM phrases JOIN w ON w.word = phrases.words[1] JOIN d USING (r)
  WHERE d.words[place + 1 : place + len(phrases.words)] = phrases.words
), b AS (
  SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS named
  FROM p GROUP BY r
), t AS (
  SELECT notice, label, stride, needed, len(words) AS m, unnest(words) AS word FROM notices
), k AS (
  SELECT r, notice, label, needed, m, count(DISTINCT word) AS c FROM (
    SELECT r, t.*, unnest([place // stride, place // stride - 1]) AS block FROM w JOIN t USING (word)
  ) GROUP BY r, notice, label, needed, m, block HAVING c >= needed
), f AS (
  SELECT r, list(DISTINCT label) AS labels, max(c / m) AS best FROM k GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(list_sort(named), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(named, []), coalesce(labels, [])))), ',') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN f USING (r)
"""

# CRC-32 bit by bit: the outer list holds the start value, then the characters of the id.
_CRC32 = """xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)),
                               lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLES["op13_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(sha256(len(role) || ':' || role || text) ORDER BY place) AS turns,
         list(CAST(length(text) AS BIGINT) ORDER BY place) AS chars, {_CRC32.format(id="conv_id")} % 6 AS h
  FROM t GROUP BY conv_id
), r AS (
  SELECT c.conv_id, list_concat(coalesce(f.turns, [])[1 : c.h], c.turns[c.h + 1 :]) AS turns,
         list_concat(coalesce(f.chars, [])[1 : c.h], c.chars[c.h + 1 :]) AS chars
  FROM c LEFT JOIN c f ON f.conv_id = c.conv_id - c.conv_id % 100
), p AS (
  SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns, chars FROM r
), k AS (
  SELECT conv_id, n, depth, sha256(array_to_string(turns[1 : depth], ',')) AS node,
         CASE WHEN depth > 0 THEN sha256(array_to_string(turns[1 : depth - 1], ',')) END AS up,
         CASE WHEN depth > 0 THEN chars[depth] ELSE 0 END AS own FROM p
), nodes AS (
  SELECT depth, node, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * any_value(own) AS saved,
         sha256(coalesce(string_agg(CASE WHEN n = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM k GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), all_nodes AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (depth, node)
), inside AS (
  SELECT t.depth, t.node, sum(u.saved) AS saved_tokens, count(*) FILTER (u.n_children = 0) AS n_leaves
  FROM all_nodes u JOIN k ON k.conv_id = u.conv_id AND k.depth <= u.depth
  JOIN all_nodes t ON t.depth = k.depth AND t.node = k.node
  GROUP BY t.depth, t.node
)
SELECT a.conv_id, a.depth, u.conv_id AS parent_conv_id, a.n_convs, a.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, a.ends_sha256
FROM all_nodes a JOIN inside USING (depth, node)
LEFT JOIN all_nodes u ON u.depth = a.depth - 1 AND u.node = a.up
"""
