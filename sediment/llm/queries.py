"""The training-data queries, their oracle SQL, and how they read their tables."""

from __future__ import annotations

from sediment.llm import (chunk_bpe, decontam, line_dedup, merkle, near_dedup, packing, quality,
                          quotes, sharding, token_files, topk, toxicity, whitening)
from sediment.llm.common import table

QUERIES = {
    "op1_near_dedup": lambda s, d: near_dedup.contract(table(s, d, "documents")),
    "op2_quality": lambda s, d: quality.contract(table(s, d, "documents"), table(s, d, "labels")),
    "op3_token_orc": lambda s, d: token_files.contract(table(s, d, "documents")),
    "op4_quote_threads": lambda s, d: quotes.contract(table(s, d, "conversations")),
    "op5_decontamination": lambda s, d: decontam.contract(table(s, d, "documents"),
                                                          table(s, d, "benchmark")),
    "op6_kd_topk": lambda s, d: topk.contract(table(s, d, "embeddings")),
    "op7_toxicity": lambda s, d: toxicity.contract(table(s, d, "documents"), table(s, d, "labels")),
    "op8_line_dedup": lambda s, d: line_dedup.contract(table(s, d, "documents")),
    "op9_slack_packing": lambda s, d: packing.contract(table(s, d, "documents")),
    "op10_shard_interleave": lambda s, d: sharding.contract(table(s, d, "documents")),
    "op11_merkle_manifest": lambda s, d: merkle.contract(table(s, d, "documents")),
    "op12_chunk_bpe": lambda s, d: chunk_bpe.contract(table(s, d, "documents")),
    "op13_whitening": lambda s, d: whitening.contract(table(s, d, "embeddings")),
}

#: A key of op8, and the numbered lines of every document.
LINES = r"""
lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
         generate_subscripts(string_split(t, chr(10)), 1) AS pos
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
),
keyed AS (
  SELECT doc_id, line, pos,
         translate(regexp_replace(line, '^[ \t\n\x0B\f\r]+|[ \t\n\x0B\f\r]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
)"""

#: Words and distinct 4-word shingles of op1.
SETS = r"""
words AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, list_distinct(CASE
      WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM words
)"""

#: CRC-32 by table; the table follows from the polynomial.
CRC_TABLE = """
steps AS (
  SELECT n, list_reduce(list_prepend(n, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
  FROM (SELECT unnest(range(256)) AS n)
),
crc_table AS (SELECT list(v ORDER BY n) AS tab FROM steps)"""
#: The checksum of the bytes whose hexadecimal digits stand in ``digits``.
CRC_OF_DIGITS = """xor(list_reduce(list_prepend(4294967295, list_transform(
      range(1, len(digits) // 2 + 1),
      lambda i: ('0x' || substr(digits, 2 * i - 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""
CRC = f"""{CRC_TABLE},
sums AS (
  SELECT doc_id, text, {CRC_OF_DIGITS} AS crc
  FROM (SELECT doc_id, text, hex(encode(coalesce(text, ''))) AS digits FROM documents), crc_table
)"""

def _field(name: str) -> str:
    """A field as op11 hashes it."""
    value = f"{name}::VARCHAR"
    return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"


ORACLE: dict[str, str] = {
    "op1_near_dedup": f"""
WITH RECURSIVE {SETS},
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)
),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
),
smallest AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN smallest USING (doc_id)""",
    "op4_quote_threads": r"""
WITH RECURSIVE messages AS (SELECT *, row_number() OVER () AS msg FROM conversations),
lines AS (
  SELECT msg, conv_id, turn, pos, line, length(regexp_replace(prefix, '[^>]', '', 'g')) AS level,
         regexp_replace(substr(line, length(prefix) + 1), '^[ \t]', '') AS inner_text
  FROM (
    SELECT *, regexp_extract(line, '^((?:[ \t]*>)*)', 1) AS prefix FROM (
      SELECT msg, conv_id, turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM messages))
),
marked AS (
  SELECT *, CASE WHEN level > 0 THEN inner_text ELSE line END AS content,
         coalesce(lag(level) OVER w <> level, true) AS starts,
         level = 0 AND regexp_matches(line, '(?i)\bwrote:[ \t]*$') AND coalesce(lead(level) OVER w, 0) > 0 AS gone
  FROM lines WINDOW w AS (PARTITION BY msg ORDER BY pos)
),
normed AS (
  SELECT *, trim(regexp_replace(lower(content), '[^\p{L}\p{N}]+', ' ', 'g')) AS u,
         sum(starts::INTEGER) OVER (PARTITION BY msg ORDER BY pos) AS run
  FROM marked
),
passages AS (
  SELECT msg, conv_id, turn, level, list(u ORDER BY pos) AS us,
         dense_rank() OVER (PARTITION BY msg ORDER BY run) AS p
  FROM normed WHERE level > 0 AND turn IS NOT NULL GROUP BY msg, conv_id, turn, level, run
),
split AS (
  SELECT conv_id, turn, p, level, us, trim(regexp_replace(array_to_string(us, ' '), ' +', ' ', 'g')) AS all_text,
         string_split(all_text, ' ') AS w
  FROM passages
),
asked AS (
  SELECT conv_id, turn, p, level, u, bool_or(u = all_text) AS whole FROM (
    SELECT *, unnest(list_concat([all_text], us, list_transform(
        range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))) AS u
    FROM split)
  GROUP BY ALL
),
bodies AS (
  SELECT msg, conv_id, turn, list(u ORDER BY pos) AS us,
         trim(regexp_replace(array_to_string(us, ' '), ' +', ' ', 'g')) AS all_text,
         string_split(all_text, ' ') AS w
  FROM normed WHERE level = 0 AND NOT gone AND turn IS NOT NULL GROUP BY msg, conv_id, turn
),
own AS (
  SELECT DISTINCT conv_id, turn AS orig, unnest(list_concat([all_text], us, list_transform(
      range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')))) AS u
  FROM bodies
),
voted AS (
  SELECT a.conv_id, a.turn, a.p, a.level, a.u, a.whole, max(o.orig) AS orig
  FROM asked a JOIN own o ON o.conv_id IS NOT DISTINCT FROM a.conv_id AND o.u = a.u AND o.orig < a.turn
  WHERE a.u <> '' GROUP BY ALL
),
scored AS (
  SELECT conv_id, turn, p, level, orig, bool_or(whole) AS whole, count(*) AS n FROM voted GROUP BY ALL
),
linked AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn, p, level ORDER BY whole DESC, n DESC, orig DESC) = 1
),
replies AS (
  SELECT conv_id, turn, orig AS reply_to FROM linked
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, orig DESC) = 1
),
climb AS (
  SELECT conv_id, turn, reply_to AS up, 1 AS depth FROM replies
  UNION ALL
  SELECT c.conv_id, c.turn, r.reply_to, c.depth + 1 FROM climb c
  JOIN replies r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.turn = c.up
),
threads AS (SELECT conv_id, turn, max(depth) AS depth, min(up) AS root FROM climb GROUP BY ALL),
shown AS (
  SELECT msg, count(*) FILTER (level > 0) AS n_quoted,
         trim(coalesce(string_agg(content, chr(10) ORDER BY pos) FILTER (level = 0 AND NOT gone), ''),
              ' ' || chr(9) || chr(10)) AS body
  FROM normed GROUP BY msg
)
SELECT m.conv_id, m.turn, m.role, row_number() OVER (PARTITION BY m.conv_id ORDER BY
         coalesce(t.root, m.turn) NULLS FIRST, coalesce(t.depth, 0), m.turn NULLS FIRST,
         m.role NULLS FIRST, n_quoted, body) - 1 AS position,
       r.reply_to, coalesce(t.depth, 0)::INTEGER AS depth, coalesce(t.root, m.turn) AS thread,
       n_quoted::INTEGER AS n_quoted, body
FROM messages m JOIN shown USING (msg)
LEFT JOIN replies r ON r.conv_id IS NOT DISTINCT FROM m.conv_id AND r.turn = m.turn
LEFT JOIN threads t ON t.conv_id IS NOT DISTINCT FROM m.conv_id AND t.turn = m.turn""",
    "op5_decontamination": r"""
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents
),
item_words AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark
),
lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM item_words WHERE len(w) > 0),
held AS (
  SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2),
      lambda i: array_to_string(w[i:i + k - 1], ' '))) AS shingle
  FROM doc_words, lengths WHERE len(w) >= k
),
items AS (
  SELECT DISTINCT item_id, least(len(w), 5) AS k,
      unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2),
          lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' '))) AS shingle
  FROM item_words WHERE len(w) > 0
),
sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_item) AS n_item, count(*) AS n_shared,
       count(*) / any_value(n_item) AS containment
FROM held JOIN items USING (k, shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n_item) * 80""",
    "op6_kd_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op10_shard_interleave": f"""
WITH {CRC},
ordered AS (
  SELECT doc_id, octet_length(encode(coalesce(d.text, ''))) + 16 AS size, crc AS text_crc32,
         source AS stratum, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS o
  FROM sums JOIN documents d USING (doc_id)
),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY stratum ORDER BY o, doc_id) - 1)::DOUBLE
            / (2 * count(*) OVER (PARTITION BY stratum)) AS f
  FROM ordered
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY f, o, doc_id) - 1 AS p, count(*) OVER () AS n FROM ranked
),
cut AS (SELECT *, (p * 40) // n AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
       p - (shard * n + 39) // 40 AS slot, NULL::INTEGER AS grown_shard, stratum
FROM cut""",
    "op11_merkle_manifest": f"""
WITH RECURSIVE {CRC_TABLE},
given AS (
  SELECT *, CASE WHEN {CRC_OF_DIGITS} % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS other
  FROM (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, ''))) AS digits FROM documents), crc_table
),
leaves AS (
  SELECT doc_id, lang, sha256(head || {_field("n_chars")} || tail) AS leaf,
         sha256(head || {_field("other")} || tail) AS tampered
  FROM (SELECT *, {_field("doc_id")} || {_field("source")} || {_field("lang")} AS head,
               {_field("text")} AS tail FROM given)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves
),
low AS (
  SELECT lang, 0 AS level, pos, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM low WHERE n > 1 GROUP BY lang, level, pos // 2
),
subroots AS (
  SELECT lang, d AS subroot, level AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos
  FROM low WHERE n = 1
),
high AS (
  SELECT 0 AS level, pos, subroot AS d, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM high WHERE n > 1 GROUP BY level, pos // 2
),
climbs AS (
  SELECT p.lang, p.pos, l.level AS height, (p.pos >> l.level) & 1 AS side, b.d AS sibling
  FROM placed p JOIN (SELECT DISTINCT lang, level FROM low WHERE n > 1) l ON l.lang IS NOT DISTINCT FROM p.lang
  LEFT JOIN low b ON b.lang IS NOT DISTINCT FROM p.lang AND b.level = l.level AND b.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.lang, p.pos, s.height + l.level, (s.pos >> l.level) & 1, b.d
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang
  CROSS JOIN (SELECT DISTINCT level FROM high WHERE n > 1) l
  LEFT JOIN high b ON b.level = l.level AND b.pos = xor(s.pos >> l.level, 1)
),
proofs AS (
  SELECT lang, pos, list(CASE WHEN sibling IS NULL THEN '' ELSE side || sibling END ORDER BY height) AS proof
  FROM climbs GROUP BY lang, pos
),
folded AS (
  SELECT p.*, s.subroot, r.d AS root, coalesce(q.proof, []) AS proof,
         list_reduce(list_prepend(p.tampered, coalesce(q.proof, [])), lambda got, step: sha256(
             CASE WHEN step = '' THEN got WHEN step[1] = '1' THEN step[2:] || got ELSE got || step[2:] END)) AS folded_root
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang CROSS JOIN (SELECT d FROM high WHERE n = 1) r
  LEFT JOIN proofs q ON q.lang IS NOT DISTINCT FROM p.lang AND q.pos = p.pos
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(proof, lambda x: x[2:]), '')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM folded""",
    "op8_line_dedup": f"""
WITH {LINES},
frequent AS (
  SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
  SELECT k.*, coalesce(f.holder <> k.doc_id, false) AS gone
  FROM keyed k LEFT JOIN frequent f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
