"""SQL for the mixing, resampling and prefix-trie queries."""

from __future__ import annotations

from casewright.llm import mixing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: ``crc_table(t)``: one row, the 256 entries of the crc32 table, worked out bit by bit.
CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS i)
  )
)"""


def crc32(text: str) -> str:
    """The unsigned crc32 of a non-null text; ``crc_table`` must be joined."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(1, length({digits}) + 1, 2), lambda i: CAST('0x' || substr({digits}, i, 2) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), 4294967295)"


def _closing_steps(rounds: int, near: float) -> str:
    """One step after another: the gap of each source and the document that closes it best."""
    steps = [f"""in0 AS (SELECT *, upto <= missing AS taken_in FROM ranked),
    gap0 AS (SELECT source, any_value(missing) - coalesce(sum(size) FILTER (taken_in), 0) AS gap, greatest(any_value(target) * {near}, 0.5) AS fine FROM in0 GROUP BY source)"""]
    for i in range(rounds):
        steps.append(f"""best{i} AS (
      SELECT i.source, first(doc_id ORDER BY size > gap, abs(gap - size), q, doc_id) AS doc_id, first(size ORDER BY size > gap, abs(gap - size), q, doc_id) AS size
      FROM in{i} i JOIN gap{i} g ON i.source IS NOT DISTINCT FROM g.source WHERE gap > fine AND NOT taken_in AND size < 2 * gap GROUP BY i.source
    ), in{i + 1} AS (SELECT i.* REPLACE (taken_in OR i.doc_id IN (SELECT doc_id FROM best{i}) AS taken_in) FROM in{i} i),
    gap{i + 1} AS (SELECT g.source, gap - b.size AS gap, fine FROM gap{i} g JOIN best{i} b ON b.source IS NOT DISTINCT FROM g.source)""")
    return ",\n    ".join(steps)


MIXING_SQL = f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 2 * CAST(sum(size) AS BIGINT) AS cap,
         CAST({list(mixing.WEIGHTS)}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS BIGINT) AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, cap / w AS level, CAST(sum(cap) OVER o AS DOUBLE) AS caps, CAST(sum(w) OVER o AS DOUBLE) AS ws, CAST(sum(w) OVER () AS DOUBLE) AS all_w,
         CAST(150 * sum(source_size) OVER () AS DOUBLE) / CAST(100 AS DOUBLE) AS goal
  FROM s WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), m AS (SELECT *, caps + level * (all_w - ws) <= goal OR cap = 0 AS is_full FROM f),
l AS (SELECT (max(goal) - coalesce(sum(cap) FILTER (is_full), 0)) / nullif(max(all_w) - coalesce(sum(w) FILTER (is_full), 0), 0) AS c FROM m),
t AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), c * w) END AS target FROM m, l),
r AS (
  SELECT doc_id, d.source, size, source_size, target, coalesce(target / nullif(CAST(source_size AS DOUBLE), 0), 0) AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (SELECT *, least(2, CAST(floor(rate) AS BIGINT)) AS sure, rate - least(2, floor(rate)) AS chance, target - least(2, floor(rate)) * source_size AS missing FROM r),
u AS (SELECT *, (CAST('0x' || substr(sha256('11:' || doc_id || ':' || size), 1, 12) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(281474976710656 AS DOUBLE) AS u FROM e),
ranked AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM (SELECT *, u / (1 - u) * ((1 - chance) / chance) AS q FROM u WHERE chance > 0 AND chance < 1 AND size > 0)
), {_closing_steps(mixing.CLOSING, mixing.NEAR)}
SELECT doc_id, source, size, source_size, target, sure + CAST(doc_id IN (SELECT doc_id FROM in{mixing.CLOSING} WHERE taken_in) AS BIGINT) AS copies,
       CAST((sure + CAST(doc_id IN (SELECT doc_id FROM in{mixing.CLOSING} WHERE taken_in) AS BIGINT)) * size AS BIGINT) AS taken
FROM e
"""

RESAMPLING_SQL = f"""
WITH {CRC_TABLE}, w AS (
  SELECT 0 AS side, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM documents
  UNION ALL SELECT 1, NULL, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) FROM benchmark
), known AS (SELECT word, {crc32('word')} % 10000 AS bucket FROM (SELECT DISTINCT word FROM w), crc_table),
counts AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM w JOIN known USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST((SELECT sum(s) FROM counts) + 10000 AS DOUBLE)
         / (CAST(s + 1 AS DOUBLE) * CAST((SELECT sum(t) FROM counts) + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counts
), sums AS (SELECT doc_id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight FROM w JOIN known USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
  FROM documents d LEFT JOIN sums ON sums.doc_id = d.doc_id
), placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""

TRIE_SQL = f"""
WITH {CRC_TABLE}, raw AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (SELECT conv_id, conv_id - conv_id % 100 AS leader, {crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM raw), crc_table),
built AS (
  SELECT c.conv_id, p, 0 AS part, role, text FROM c JOIN raw ON raw.conv_id = leader AND p <= h
  UNION ALL SELECT c.conv_id, p, 1, role, text FROM c JOIN raw ON raw.conv_id = c.conv_id AND p > h
), steps AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, p) AS depth, role, text FROM built),
paths AS (
  SELECT conv_id, depth, length(text) AS chars, string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM steps
  UNION ALL SELECT conv_id, 0, 0, '' FROM c
), nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM paths GROUP BY path, depth),
children AS (SELECT substr(path, 1, length(path) - 128) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
own AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * chars AS saved FROM nodes n LEFT JOIN children USING (path)),
up AS (SELECT substr(path, 1, 128 * k) AS path, n_children, saved FROM own, LATERAL (SELECT unnest(range(0, depth + 1)) AS k)),
sums AS (SELECT path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM up GROUP BY path),
ends AS (
  SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends_sha256
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path
)
SELECT o.conv_id, o.depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children, n_leaves, saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM own o JOIN sums USING (path) LEFT JOIN ends USING (path) LEFT JOIN nodes p ON o.depth > 0 AND p.path = substr(o.path, 1, length(o.path) - 128)
"""
