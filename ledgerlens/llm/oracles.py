"""DuckDB texts for the queries that SQL can express."""

from __future__ import annotations

MIX_SOURCES = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(concat_ws(':', '17', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(text, ''))), 1, 13))
              AS BIGINT) / 4503599627370496.0::DOUBLE AS draw
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source
), r AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) * 150 AS budget,
         row_number() OVER (ORDER BY source_size * 1.0 / weight, source NULLS LAST) AS place
  FROM s
), filled AS (
  SELECT *,
         budget - coalesce(CAST(sum(source_size * 200) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS rest,
         CAST(sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_weight
  FROM r
), level AS (
  SELECT rest, open_weight, place FROM filled WHERE weight * rest < source_size * 200 * open_weight ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size,
         CASE WHEN r.place < coalesce(level.place, 9223372036854775807) THEN source_size * 2.0::DOUBLE
              ELSE CAST(weight * level.rest AS DOUBLE) / (level.open_weight * 100) END AS target
  FROM r LEFT JOIN level ON true
), rated AS (
  SELECT d.*, source_size, target, target / nullif(source_size, 0) AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(coalesce(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END), 0) AS BIGINT) AS taken
FROM rated
"""

def _places(n: int) -> str:
    """Every run of n words of a document, if some item's window has n words."""
    return f"""
  SELECT doc_id, {n} AS n, pos,
         string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS words
  FROM words WHERE {n} IN (SELECT n FROM windows) QUALIFY pos + {n} - 1 <= size"""


DECONTAMINATE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), i AS (
  SELECT item_id, row_number() OVER () AS item,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), sized AS (SELECT *, least(13, len(w)) AS n FROM i WHERE len(w) > 0
), starts AS (SELECT *, unnest(range(1, len(w) - n + 2)) AS pos FROM sized
), windows AS (SELECT DISTINCT item_id, n, array_to_string(w[pos:pos + n - 1], ' ') AS words FROM starts
), words AS (SELECT doc_id, len(w) AS size, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d
), places AS (""" + " UNION ALL ".join(_places(n) for n in range(1, 14)) + r"""
), found AS (
  SELECT doc_id, pos, p.n, item_id FROM places p JOIN windows x ON p.n = x.n AND p.words = x.words
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS word FROM found) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""


def _windows(n: int) -> str:
    """The words of windows of n words that occur twice or more in their text."""
    return f"""
windows{n} AS (
  SELECT doc_id, pos, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS words
  FROM words
), counted{n} AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, md5(words)) AS times FROM windows{n} WHERE pos + {n} - 1 <= n
), repeated{n} AS (
  SELECT doc_id, count(DISTINCT word) AS n
  FROM (SELECT doc_id, unnest(range(pos, pos + {n})) AS word FROM counted{n} WHERE times > 1) GROUP BY doc_id
)"""


REPETITION = r"""
WITH d AS (
  SELECT doc_id, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
), words AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d
), dup AS (
  SELECT doc_id, CAST(count(*) - count(DISTINCT line) AS BIGINT) AS n FROM l
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),""" + ",".join(_windows(n) for n in (5, 10, 101)) + r""",
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(w, '')), 0) AS BIGINT) AS word_chars,
         CAST(coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0) AS BIGINT) AS n_symbols,
         coalesce(dup.n, 0) AS n_dup_lines, coalesce(r5.n, 0) AS n_repeat_words, coalesce(r10.n, 0) AS n_covered,
         r101.n IS NOT NULL AS too_long
  FROM d LEFT JOIN dup ON d.doc_id = dup.doc_id LEFT JOIN repeated5 r5 ON d.doc_id = r5.doc_id
  LEFT JOIN repeated10 r10 ON d.doc_id = r10.doc_id LEFT JOIN repeated101 r101 ON d.doc_id = r101.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * n_covered <= 15 * n_words AND NOT too_long AS kept
FROM m
"""

NEAR_DEDUP = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), words AS (
  SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d
), shingled AS (
  SELECT doc_id, n, pos, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS shingle
  FROM words
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(shingle) AS shingle FROM shingled WHERE pos <= greatest(n - 2, 1)
), sizes AS MATERIALIZED (
  SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), links AS MATERIALIZED (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n >= 85 * (x.size + y.size - n)
), sides AS MATERIALIZED (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT a AS doc_id, b AS other FROM sides
  UNION
  SELECT r.doc_id, sides.b FROM reach r JOIN sides ON sides.a = r.other
), least_reached AS (
  SELECT doc_id, min(other) AS least_id FROM reach GROUP BY doc_id
)
SELECT d.doc_id, coalesce(size, 0) AS n_shingles, least(d.doc_id, coalesce(least_id, d.doc_id)) AS component_id,
       d.doc_id <= coalesce(least_id, d.doc_id) AS kept
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least_reached l ON l.doc_id = d.doc_id
"""

CHAT_PERSPECTIVES = r"""
WITH t AS (
  SELECT conv_id, turn, translate(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(13) || chr(10), '  ') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS place FROM t
), people AS (
  SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'
), pieces AS (
  SELECT p.conv_id, perspective, place // 64 AS block, place, speaker = perspective AS own,
         '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
                                ELSE 'user name=' || speaker END || chr(10) AS head,
         text || '<|im_end|>' AS body
  FROM placed p JOIN people q ON p.conv_id IS NOT DISTINCT FROM q.conv_id
), spans AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective, block ORDER BY place)
            - length(body) - 1 AS start
  FROM pieces
)
SELECT conv_id, perspective, CAST(block AS BIGINT) AS block, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(start AS BIGINT) || ':' || CAST(start + length(body) AS BIGINT) END, ',' ORDER BY place), '') AS masks,
       CAST(coalesce(sum(CASE WHEN own THEN length(body) END), 0) AS INTEGER) AS n_masked
FROM spans GROUP BY conv_id, perspective, block
"""

def _vector_codes(rounds: int = 4, entries: int = 256, parts: int = 4) -> str:
    """One step of SQL for each round: distances from exact products of whole numbers, then means."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS uid, vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS place, v
  FROM (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024.0::DOUBLE * x)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  )
), part AS MATERIALIZED (
  SELECT uid, place, p, list_slice(v, p * w + 1, p * w + w) AS x
  FROM (SELECT *, len(v) // {parts} AS w FROM kept), range({parts}) t(p)
), book0 AS MATERIALIZED (
  SELECT p, place - 1 AS k, x AS e FROM part WHERE place <= {entries}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT uid, p, min({{'d': d, 'k': k}}) AS best
  FROM (
    SELECT uid, p, k, list_dot_product(x, x) - 2 * list_dot_product(x, e) + list_dot_product(e, e) AS d
    FROM part JOIN book{i} USING (p)
  ) GROUP BY uid, p
)""")
        if i < rounds:
            steps.append(f"""mean{i} AS MATERIALIZED (
  SELECT p, k, list(m ORDER BY j) AS e FROM (
    SELECT p, best.k AS k, j, floor(sum(x[j]) / count(*)) AS m
    FROM near{i} JOIN part USING (uid, p), (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM part))) AS j)
    GROUP BY p, best.k, j
  ) GROUP BY p, k
), book{i + 1} AS MATERIALIZED (
  SELECT b.p, b.k, coalesce(m.e, b.e) AS e FROM book{i} b LEFT JOIN mean{i} m ON b.p = m.p AND b.k = m.k
)""")
    return "WITH " + ", ".join(steps) + f""", coded AS (
  SELECT uid, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY uid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda c: CAST(CAST(c AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, k))
        FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (uid)
"""


VECTOR_CODES = _vector_codes()

HARD_NEGATIVES = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256.0::DOUBLE * x)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.uid AS a, a.vec_id AS anchor_id, r.uid AS r, r.vec_id AS id, a.label = r.label AS same,
         CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM kept a JOIN kept r ON a.uid <> r.uid
  WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST, r) AS place FROM scored WHERE same
), ranked AS (
  SELECT p.anchor_id, p.id AS positive_id, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.a, p.place ORDER BY n.score DESC, n.id NULLS LAST, n.r) AS INTEGER) AS rank
  FROM positive p JOIN scored n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""


ORACLES = {
    "op1_chat_perspectives": CHAT_PERSPECTIVES,
    "op5_near_dedup": NEAR_DEDUP,
    "op6_repetition_rules": REPETITION,
    "op3_decontaminate": DECONTAMINATE,
    "op4_mix_sources": MIX_SOURCES,
    "op12_vector_codes": VECTOR_CODES,
    "op13_hard_negatives": HARD_NEGATIVES,
}
