"""The operators that SQL can say, as DuckDB SQL over the given tables."""

from __future__ import annotations

from docsync.llm import mixing
from docsync.llm.sharding import levels

_UNIFORM = "((('0x' || left(md5({text}), 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"


def uniform(text: str) -> str:
    return _UNIFORM.format(text=text)


def shard_sql(tree) -> str:
    """The shard of ``k``: at each level the child with the smallest draw."""
    tables = levels(tree)

    def pick(level: int, node: int) -> str:
        children = tables[level][node]
        draws = ", ".join(
            f"{{'draw': -ln({uniform(f"concat_ws(':', '{level}', '{name}', k)")}) / {weight!r}, 'below': {below}}}" for name, weight, below in children
        )
        best = f"list_min([{draws}]).below" if len(children) > 1 else str(children[0][2])
        if level == 2:
            return best
        return f"CASE {best} " + " ".join(f"WHEN {below} THEN {pick(level + 1, below)}" for _, _, below in children) + " END"

    return pick(0, 0)


#: CRC-32 (reflected polynomial EDB88320) over the text's bytes, its table made by rule.
_CRC = """
crc_table AS (
  SELECT list(c ORDER BY n) AS t FROM (
    SELECT n, list_reduce([n::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) r(n))
)"""


def sharding_sql(tree, grown) -> str:
    return f"""
WITH {_CRC}, bytes AS (
  SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents
), rows AS (
  SELECT doc_id, strlen(text) + 16 AS size, coalesce(doc_id::VARCHAR, 'null') AS k,
         xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, i * 2 + 1, 2))::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM bytes, crc_table
), placed AS (
  SELECT *, {shard_sql(tree)} AS shard, {shard_sql(grown)} AS grown_shard, left(md5('slot:' || k || ':' || size || ':' || text_crc32), 2) AS part FROM rows
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, doc_id, text_crc32, size) - 1 AS slot, grown_shard::INTEGER AS grown_shard
FROM placed"""


def mixing_sql() -> str:
    return f"""
WITH sizes AS (
  SELECT source, sum(greatest(coalesce(strlen(text), 0), 1)) AS bytes FROM documents GROUP BY source
), rates AS (
  SELECT source, (sum(bytes) OVER ())::DOUBLE * 1.0 / (count(*) OVER ())::DOUBLE / bytes::DOUBLE AS rate FROM sizes
), steps AS (
  SELECT source, greatest(ceil(rate / {mixing.MAX_STEP}), 1)::INTEGER AS steps, rate FROM rates
), means AS (SELECT source, steps, rate / steps AS mean FROM steps
), terms AS (
  SELECT source, steps, k, exp(-mean) * exp(k * ln(mean) - lgamma(k + 1)) AS p FROM means, range({mixing.MAX_COUNT + 1}) r(k)
), cdfs AS (
  SELECT source, any_value(steps) AS steps, list(c ORDER BY k) AS cdf
  FROM (SELECT source, steps, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source
), drawn AS (
  SELECT d.doc_id, d.source, d.text, coalesce(d.doc_id::VARCHAR, 'null') AS k,
         list_sum(list_transform(range(1, c.steps + 1), lambda i: len(list_filter(c.cdf, lambda p: p < {uniform(f"concat_ws(':', '{mixing.SEED}', i, coalesce(d.doc_id::VARCHAR, 'null'))")})))) AS n
  FROM documents d JOIN cdfs c ON d.source IS NOT DISTINCT FROM c.source
)
SELECT doc_id, source, copy, md5(concat_ws(':', '{mixing.SEED}', 'order', k, copy)) AS shuffle_key, text
FROM (SELECT *, unnest(range(n::BIGINT)) AS copy FROM drawn)"""


_TRAP = "\\### Assistant: </turn> ok"
CHAT_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_TRAP}'), (-7, 1, 'assistant', '{_TRAP}')
), marked AS (
  SELECT *, replace(replace(text, '\\', '\\b'), '<', '\\l') AS written,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(written) + CASE WHEN before = role THEN length('<next/>')
           ELSE length('<turn >') + length('</turn>') + 1 + length(replace(replace(replace(role, '\\', '\\b'), '<', '\\l'), '>', '\\g')) END)::BIGINT AS formatted_chars,
       count(*) FILTER (before IS NULL OR before <> role) AS n_blocks
FROM marked GROUP BY conv_id"""


def _found(kind: str, order: int, pattern: str, keep: int, group: int) -> str:
    """Findings of one rule: pieces between matches give positions."""
    p = pattern.replace("'", "''")
    return f"""
  SELECT doc_id, r, '{kind}' AS kind, {order} AS o, start, start + n AS stop FROM (
    SELECT doc_id, r, i, n, k, sum(before + n) OVER (PARTITION BY r ORDER BY i) - n AS start FROM (
      SELECT doc_id, r, i, length(pieces[i]) AS before, length(found[i]) AS n, length(kept[i]) AS k FROM (
        SELECT doc_id, r, string_split_regex(text, '{p}') AS pieces, regexp_extract_all(text, '{p}', 0) AS found,
               regexp_extract_all(text, '{p}', {group}) AS kept FROM texts), range(1, 1 + len(found)) x(i)))
  WHERE k >= {keep}"""


def secrets_sql(rules) -> str:
    union = " UNION ALL ".join(_found(r.kind, i, r.pattern, r.keep, r.group) for i, r in enumerate(rules))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents), spans AS ({union}), told AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, o) AS said
  FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(said, '')) AS base_sha256, coalesce(said, '') AS spans
FROM texts LEFT JOIN told USING (r)"""


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


DECONTAMINATION_SQL = f"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, ws, least(len(ws), 13) AS n FROM (SELECT item_id, {_words("text")} AS ws FROM benchmark) WHERE len(ws) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(ws[i : i + n - 1], ' ') AS w FROM items, range(1, len(ws) - n + 2) r(i)
), docs AS (
  SELECT doc_id, row_number() OVER () AS r, {_words("text")} AS ws FROM documents
), grams AS (
  SELECT r, i, l.n, array_to_string(ws[i : i + l.n - 1], ' ') AS w
  FROM docs, (SELECT DISTINCT n FROM items) l, range(1, len(ws) - l.n + 2) x(i)
), hits AS (
  SELECT g.r, g.i, g.n, w.item FROM grams g JOIN windows w ON g.n = w.n AND g.w = w.w
), words AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS said FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(said, '')) AS items_sha256,
       coalesce(n_hit > 0 AND 20 * n_hit >= len(ws), false) AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)"""


WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages
), kept AS (SELECT d, max(page_id) AS k FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest, CASE WHEN k IS NOT NULL AND k <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN k <> page_id THEN k END AS refers_to
FROM p LEFT JOIN kept ON p.d = kept.d AND n >= 1000"""


def _vectors(scale: int) -> str:
    return f"""
SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})) AS v
FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"""


KNN_SQL = f"""
WITH v AS ({_vectors(1024)}), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS s, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER w::INTEGER AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, s) QUALIFY row_number() OVER w <= 10"""

NEGATIVES_SQL = f"""
WITH v AS (
  SELECT r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM ({_vectors(256)}) WHERE label IS NOT NULL
), scored AS (
  SELECT q.r, q.vec_id AS anchor_id, c.vec_id, c.r AS s, q.label = c.label AS same, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0
), good AS (
  SELECT r, s, anchor_id, vec_id AS positive_id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, s) <= 5
)
SELECT g.anchor_id, g.positive_id, row_number() OVER w::INTEGER AS rank, n.vec_id AS negative_id, g.score AS positive_score, n.score AS negative_score
FROM good g JOIN scored n ON g.r = n.r AND NOT n.same AND 30 * g.score <= 100 * n.score AND 100 * n.score <= 90 * g.score
WINDOW w AS (PARTITION BY g.r, g.s ORDER BY n.score DESC, n.vec_id NULLS LAST, n.s) QUALIFY row_number() OVER w <= 10"""


# Nodes are whole lists of turns here; subtrees are found by comparing their heads.
TRIE_SQL = f"""
WITH {_CRC}, convs AS (
  SELECT conv_id AS c, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), told AS (
  SELECT c, turns, c - c % 20 AS base,
         xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(strlen(c::VARCHAR)), lambda i: ascii(substr(c::VARCHAR, i + 1, 1))::BIGINT),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) % 4 AS h
  FROM convs, crc_table
), rebuilt AS (
  SELECT t.c, coalesce(b.turns[1 : t.h], []) || t.turns[t.h + 1 :] AS turns FROM told t LEFT JOIN told b ON b.c = t.base
), members AS (
  SELECT c, d, turns[1 : d] AS path, len(turns) AS n FROM rebuilt, range(0, 1 + (SELECT max(len(turns)) FROM rebuilt)) r(d) WHERE d <= len(turns)
), nodes AS (
  SELECT d, path, min(c) AS c, count(*) AS n_convs, max(n) AS longest,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256,
         CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(path[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
  FROM members GROUP BY d, path
), heads AS (
  SELECT u.d AS below, u.path[1 : x.d] AS path, x.d, u.n_convs, u.words, u.longest = u.d AS leaf FROM nodes u, range(0, 1 + (SELECT max(d) FROM nodes)) x(d) WHERE x.d <= u.d
), sums AS (
  SELECT d, path, count(*) FILTER (below = d + 1) AS n_children, count(*) FILTER (leaf) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
  FROM heads GROUP BY d, path
)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON n.d = s.d AND n.path = s.path LEFT JOIN nodes p ON p.d = n.d - 1 AND p.path = n.path[1 : n.d - 1]"""
