"""The results that SQL can express, over the driver's tables, in DuckDB's SQL."""

from __future__ import annotations

_EXACT = r"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
WINDOW g AS (PARTITION BY t)
"""

_ESCAPED = r"replace(replace(replace({0}, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"

_CHAT = rf"""
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(4 + length(replace({_ESCAPED.format('role')}, ':', '\:')) + 2 + length({_ESCAPED.format('text')}) + 8) AS BIGINT)
         AS formatted_chars
FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                                      (-7, 1, 'assistant', '\### Assistant: </turn> ok')))
GROUP BY conv_id
"""

# CRC-32 byte by byte, from the table of its polynomial.
_SHARDS = r"""
WITH crc_table AS (
  SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY c) AS t
  FROM range(256) AS r(c)),
sized AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(strlen(text), 0) + 16 AS size FROM documents),
placed AS (SELECT *, CAST(sum(size) OVER (ORDER BY doc_id) - size AS BIGINT) AS start, CAST(sum(size) OVER () AS BIGINT) AS total
           FROM sized),
cut AS (SELECT *, CAST((2 * start + size) * 40 // (2 * total) AS INTEGER) AS shard FROM placed)
SELECT doc_id, size, 'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard,
  xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(text)),
                                                          lambda i: CAST('0x' || substr(hex(text), 2 * i + 1, 2) AS BIGINT))),
                  lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
FROM cut, crc_table
"""

_CRC_TABLE = r"""crc_table AS (
  SELECT list(list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY c) AS t
  FROM range(256) AS r(c))"""

# A digest's input: the bytes, a colon and the value; a hyphen for null.
_FIELD = "coalesce(strlen({0}) || ':' || {0}, '-')"

_CHILDREN = """max(node) FILTER (place % 3 = 0) OVER run AS a, max(node) FILTER (place % 3 = 1) OVER run AS b,
               max(node) FILTER (place % 3 = 2) OVER run AS c"""

_PARENT = """place // 3, (n + 2) // 3,
         sha256(a || coalesce(b, '') || coalesce(c, '')),
         sha256(CASE place % 3 WHEN 0 THEN folded ELSE a END || coalesce(CASE place % 3 WHEN 1 THEN folded ELSE b END, '')
                || coalesce(CASE place % 3 WHEN 2 THEN folded ELSE c END, '')),
         proof || CASE place % 3 WHEN 0 THEN '' ELSE a END || coalesce(CASE place % 3 WHEN 1 THEN '' ELSE b END, '')
               || coalesce(CASE place % 3 WHEN 2 THEN '' ELSE c END, '')"""

# Levels of the trees of the sources, then of the tree over them; every row goes along with its node.
_MERKLE = r"""
WITH RECURSIVE {crc_table},
told AS (SELECT *, list_reduce(list_prepend(4294967295, list_transform(range(strlen(CAST(doc_id AS VARCHAR))),
                      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i + 1 AS BIGINT), 1)) AS BIGINT))),
                      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])) AS rest
         FROM documents, crc_table),
leaves AS (
  SELECT doc_id, source, sha256(head || {text}) AS leaf,
         sha256(head || {tampered}) AS shown
  FROM (SELECT *, {doc_id} || {source} || {lang} || {n_chars} AS head FROM told)),
lower_tree AS (
  SELECT doc_id, source, leaf, row_number() OVER s - 1 AS place, count(*) OVER (PARTITION BY source) AS n,
         leaf AS node, shown AS folded, '' AS proof
  FROM leaves WINDOW s AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)
  UNION ALL
  SELECT doc_id, source, leaf, {parent}
  FROM (SELECT *, {children}
        FROM lower_tree WHERE n > 1 WINDOW run AS (PARTITION BY source, place // 3))),
upper_tree AS (
  SELECT doc_id, leaf, node AS subroot, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
         (SELECT count(DISTINCT coalesce('=' || source, '')) FROM documents) AS n, node, folded, proof
  FROM lower_tree WHERE n = 1
  UNION ALL
  SELECT doc_id, leaf, subroot, {parent}
  FROM (SELECT *, {children}
        FROM upper_tree WHERE n > 1 WINDOW run AS (PARTITION BY place // 3)))
SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
FROM upper_tree WHERE n = 1
""".format(
    crc_table=_CRC_TABLE, parent=_PARENT, children=_CHILDREN, source=_FIELD.format("source"), lang=_FIELD.format("lang"),
    text=_FIELD.format("text"), doc_id=_FIELD.format("CAST(doc_id AS VARCHAR)"), n_chars=_FIELD.format("CAST(n_chars AS VARCHAR)"),
    tampered=_FIELD.format("CASE WHEN rest & 1 = 1 THEN replace(text, chr(10), '') ELSE text END"))

ORACLE = {"op1_byte_shards": _SHARDS, "op4_chat_tree": _CHAT, "op9_exact_dedup": _EXACT, "op11_merkle_manifest": _MERKLE}
