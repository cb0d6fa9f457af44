"""Queries of this subpackage as plain SQL for another engine, written from their definitions."""

from __future__ import annotations

BLANK = "[\\x20\\x09-\\x0D]+"


def words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{BLANK}'), lambda w: w <> '')"


def runs(words: str, size: int) -> str:
    """Distinct runs of ``size`` words; the whole sequence if it is shorter."""
    every = f"list_transform(range(1, len({words}) - {size - 2}), lambda i: array_to_string({words}[i:i + {size - 1}], ' '))"
    return f"CASE WHEN len({words}) >= {size} THEN list_distinct({every}) WHEN len({words}) > 0 THEN [array_to_string({words}, ' ')] ELSE [] END"


ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DIGEST = "md5(coalesce(doc_id::VARCHAR, ''))"
BLOCK = "md5(concat_ws('/', doc_id::VARCHAR, size::VARCHAR, text_crc32::VARCHAR))"
MULTIPLIER = "2862933555777941757"
STATE = "{'k': k, 'b': -1::BIGINT, 'j': 0::BIGINT}"
MOVED = f"((s.k * {MULTIPLIER}::UHUGEINT + 1) % 18446744073709551616::UHUGEINT)"


def jump(shards: int) -> str:
    step = f"{{'k': {MOVED}, 'b': s.j, 'j': floor((s.j + 1) * (2147483648::DOUBLE / (({MOVED} // 8589934592::UHUGEINT)::DOUBLE + 1)))::BIGINT}}"
    states = f"list_transform(range({shards} + 1), lambda i: {STATE})"
    return f"list_reduce({states}, lambda s, x: CASE WHEN s.j >= {shards} THEN s ELSE {step} END).b::INT"


# CRC-32 byte by byte, from the table that its polynomial gives.
CRC_TABLE = (
    "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"
)

OP2 = f"""
WITH crc AS (SELECT {CRC_TABLE} AS t),
bytes AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_transform(string_split_regex(regexp_replace(hex(encode(coalesce(text, ''))), '(..)', '\\1 ', 'g'), ' '),
                        lambda h: CASE WHEN h = '' THEN NULL ELSE ('0x' || h)::BIGINT END) AS b
  FROM documents
),
sized AS (
  SELECT doc_id, strlen(text) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_filter(b, lambda x: x IS NOT NULL)),
                         lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) AS text_crc32,
         (('0x' || substr({DIGEST}, 1, 8))::UHUGEINT * 4294967296 + ('0x' || substr({DIGEST}, 9, 8))::UHUGEINT) AS k
  FROM bytes, crc
),
placed AS (SELECT *, {jump(8)} AS shard, {jump(9)} AS grown_shard FROM sized)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (
         PARTITION BY shard ORDER BY ('0x' || substr({BLOCK}, 17, 3))::INT, doc_id NULLS FIRST, size, text_crc32
       ) - 1 AS slot
FROM placed
"""

OP7 = f"""
WITH RECURSIVE split AS (SELECT doc_id, {words(ASCII_LOWER)} AS w FROM documents),
sets AS (SELECT doc_id, {runs('w', 4)} AS s FROM split),
rows AS (SELECT doc_id, unnest(s) AS x FROM sets),
hits AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM rows a JOIN rows b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM hits JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)
),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least USING (doc_id)
"""

LOWER = "lower(coalesce(text, ''))"

OP9 = f"""
WITH d AS (SELECT doc_id, {words(LOWER)} AS w FROM documents),
i AS (SELECT item_id, {words(LOWER)} AS w FROM benchmark),
item AS (SELECT item_id, {runs('w', 5)} AS s FROM i),
held AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN {runs('w', 5)} ELSE [] END) AS x FROM d),
wanted AS (SELECT item_id, len(s) AS n_shingles, unnest(s) AS x FROM item),
shared AS (SELECT doc_id, item_id, n_shingles::BIGINT AS n_shingles, count(*) AS matched FROM held JOIN wanted USING (x) GROUP BY ALL)
SELECT doc_id, item_id, matched, n_shingles, matched / n_shingles AS containment FROM shared WHERE 10 * matched >= 8 * n_shingles
"""

OP10 = """
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html FROM pages
),
d AS (SELECT *, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, url,
       (sum(payload_bytes + 512) OVER (ORDER BY page_id) - payload_bytes - 512)::BIGINT // 67108864 AS shard
FROM f
"""

OP11 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN firsts USING (s) WHERE least < doc_id
),
each AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS place, unnest(w) AS word FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')".format(ASCII_LOWER)

OP13 = f"""
WITH d AS (SELECT doc_id, {TERMS} AS terms FROM documents),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms)) AS n_terms FROM d),
q AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
p AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, totals GROUP BY term, n_docs
),
scores AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM p JOIN weights USING (term) JOIN q USING (term), totals GROUP BY item_id, doc_id
)
SELECT item_id, rank, doc_id, score
FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0
)
WHERE rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_jump_hash": OP2,
        "op7_minhash": OP7,
        "op9_containment": OP9,
        "op10_warc": OP10,
        "op11_suffix_automata": OP11,
        "op13_nra": OP13,
    }
