"""DuckDB SQL for the queries that SQL can express over whole tables.

The others rest on fitted models, components, 64-bit hashes or seeded
permutations; tests/llm holds them against plain Python.
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _split(text: str, breaks: str) -> str:
    return rf"list_filter(string_split_regex(coalesce({text}, ''), '{breaks}'), lambda x: x <> '')"


_SPACES = r"[\x20\x09-\x0D]+"
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

ORACLE: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH w AS (SELECT doc_id, {_split("text", _SPACES)} AS ws FROM documents),
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h FROM starts),
again AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE h IN (SELECT h FROM again)),
words AS (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS text, count(*) AS n FROM words
  WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = words.doc_id AND gone.p = words.p) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op6_decontamination": f"""
WITH d AS (SELECT doc_id, {_split(f"translate(text, '{_UPPER}', '{_LOWER}')", _BREAKS)} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_split(f"translate(text, '{_UPPER}', '{_LOWER}')", _BREAKS)} AS ws FROM benchmark),
b2 AS (SELECT item, ws, least(13, len(ws)) AS size, unnest(range(1, greatest(len(ws) - 11, 2))) AS i FROM b WHERE len(ws) > 0),
phrases AS (SELECT DISTINCT item, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM b2),
sizes AS (SELECT DISTINCT size FROM phrases),
d2 AS (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM d JOIN sizes ON len(ws) >= size),
met AS (
  SELECT doc_id, i, d2.size, item FROM (SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS phrase FROM d2) d2
  JOIN phrases ON phrases.size = d2.size AND phrases.phrase = d2.phrase
),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id""",
    "op11_importance_resampling": f"""
WITH polynomial AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
),
d AS (SELECT doc_id, {_split(f"translate(text, '{_UPPER}', '{_LOWER}')", _BREAKS)} AS ws FROM documents),
b AS (SELECT {_split(f"translate(text, '{_UPPER}', '{_LOWER}')", _BREAKS)} AS ws FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS x FROM d),
bw AS (SELECT unnest(ws) AS x FROM b),
names AS (SELECT DISTINCT x FROM (SELECT x FROM dw UNION ALL SELECT x FROM bw)),
spelt AS (SELECT x, hex(encode(x)) AS hx FROM names),
octets AS (SELECT x, list_transform(range(len(hx) // 2), lambda i: CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT)) AS bs FROM spelt),
bucket AS (
  SELECT x, xor(list_reduce(list_concat([4294967295], bs), lambda c, o: xor(c >> 8, t[(xor(c, o) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM octets, polynomial
),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN bucket USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN bucket USING (x) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s) + 10000 AS ns, (SELECT coalesce(sum(n), 0) FROM t) + 10000 AS nt),
gains AS (
  SELECT s.bucket, floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ns / (CAST(s.n + 1 AS DOUBLE) * nt))) AS gain
  FROM s LEFT JOIN t ON s.bucket = t.bucket, sums
),
weighed AS (SELECT doc_id, floor(sum(gain) / count(*)) AS weight FROM dw JOIN bucket USING (x) JOIN gains USING (bucket) GROUP BY doc_id),
noise AS (
  SELECT doc_id, len(ws) AS n_features, floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS g FROM d
),
scored AS (SELECT doc_id, n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + g AS score FROM noise LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
    count(*) FILTER (n_features >= 20) OVER () AS able FROM scored
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM ranked""",
}
