"""DuckDB SQL of the operators that SQL can express, over the driver's tables."""
from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

MIXING = f"""
WITH RECURSIVE base AS (
  SELECT doc_id AS id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS s FROM base GROUP BY source),
weighed AS (
  SELECT source, s, 3 * s AS cap, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM src),
running AS (
  SELECT *, sum(s) OVER () AS total,
    sum(s) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_before,
    sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_after
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / w::DOUBLE, source NULLS LAST)),
capped AS (SELECT *, cap::DOUBLE * weight_after::DOUBLE <= w::DOUBLE * rest_before::DOUBLE AS is_capped FROM running),
targets AS (
  SELECT source, s, CASE WHEN is_capped THEN cap::DOUBLE ELSE w::DOUBLE
      * (total - coalesce(sum(cap) FILTER (WHERE is_capped) OVER (), 0))::DOUBLE / (sum(w) FILTER (WHERE NOT is_capped) OVER ())::DOUBLE END AS target
  FROM capped),
rates AS (
  SELECT *, floor(target - whole * s + 1e-6::DOUBLE)::BIGINT AS room
  FROM (SELECT *, floor(CASE WHEN s > 0 THEN target / s ELSE 0::DOUBLE END + 1e-12::DOUBLE)::BIGINT AS whole FROM targets)),
classes AS (
  SELECT base.source, length(bin(size)) AS k, room, sum(size)::HUGEINT AS n, length(bin(size)) + 1 AS g
  FROM base JOIN rates ON base.source IS NOT DISTINCT FROM rates.source WHERE size > 0 AND room > 0 GROUP BY ALL),
certain AS (
  SELECT *, g::DOUBLE * (room - coalesce(sum(n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    >= (sum(n * g) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS sure
  FROM classes WINDOW o AS (PARTITION BY source ORDER BY k DESC)),
odds AS (
  SELECT source, k, CASE WHEN sure THEN 1::DOUBLE ELSE g::DOUBLE * (room - coalesce(sum(n) FILTER (WHERE sure) OVER w, 0))::DOUBLE
    / (sum(n * g) FILTER (WHERE NOT sure) OVER w)::DOUBLE END AS p
  FROM certain WINDOW w AS (PARTITION BY source)),
ranked AS (
  SELECT row_number() OVER () AS r, x.id, x.source, x.size, room,
    CASE WHEN p >= 1 THEN u - 1::DOUBLE WHEN p > 0 THEN u / (1::DOUBLE - u) * ((1::DOUBLE - p) / p) END AS q, s, target, whole
  FROM (SELECT *, (('0x' || substr(md5('mix|' || coalesce(id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u FROM base) x
  JOIN rates ON x.source IS NOT DISTINCT FROM rates.source
  LEFT JOIN odds ON x.source IS NOT DISTINCT FROM odds.source AND length(bin(x.size)) = odds.k),
rounds AS (
  SELECT 0 AS step, r, id, source, size, q, room, room AS cap, false AS sampled FROM ranked WHERE q IS NOT NULL
  UNION ALL
  SELECT step + 1, r, id, source, size, q, room - took, least(room - took, CASE WHEN step % 2 = 1 AND took = 0 THEN cap // 2 ELSE cap END),
    sampled OR now
  FROM (
    SELECT *, coalesce(max(upto) FILTER (WHERE now) OVER (PARTITION BY source), 0)::BIGINT AS took
    FROM (
      SELECT *, able AND upto <= room AS now
      FROM (
        SELECT *, sum(CASE WHEN able THEN size ELSE 0 END) OVER (
            PARTITION BY source ORDER BY q, id NULLS FIRST, size RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
        FROM (
          SELECT *, NOT sampled AND size <= CASE WHEN step % 2 = 0 THEN least(cap, room // 2) ELSE cap END AS able,
            step % 2 = 1 OR bool_or(NOT sampled AND size <= cap) OVER (PARTITION BY source) AS going
          FROM rounds))))
  WHERE going),
drawn AS (SELECT r, bool_or(sampled) AS sampled FROM rounds GROUP BY r),
copies AS (SELECT ranked.*, whole + coalesce(sampled, false)::BIGINT AS copies FROM ranked LEFT JOIN drawn USING (r))
SELECT id AS doc_id, size, s AS source_size, target, copies * size AS taken FROM copies
"""

QUALITY = rf"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
    regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS joined FROM t),
windows AS (SELECT r, unnest(range(1, len(ws) - 6)) AS i, ws FROM w WHERE len(ws) > 8),
again AS (
  SELECT r, i FROM (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS win FROM windows) QUALIFY count(*) OVER (PARTITION BY r, win) > 1),
covered AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS k FROM again) GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(joined)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    length(joined) - length(regexp_replace(joined, '\p{{L}}+', '', 'g')) AS n_letters,
    length(joined) - length(regexp_replace(joined, '\p{{Lu}}+', '', 'g')) AS n_upper,
    len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS n_ellipsis,
    len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[-*•●]'))) AS n_bullets
  FROM w LEFT JOIN covered USING (r)),
f AS (
  SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_symbols > 3 * n_words THEN 16 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_letters < 60 * word_chars THEN 64 ELSE 0 END + CASE WHEN 100 * n_upper > 60 * word_chars THEN 128 ELSE 0 END
    + CASE WHEN 100 * n_ellipsis > 50 * n_lines THEN 256 ELSE 0 END + CASE WHEN 100 * n_bullets > 95 * n_lines THEN 512 ELSE 0 END)::BIGINT AS fails FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fails & 3) <> 0 AS base_failed, (fails & 255) = 0 AS kept, fails FROM f
"""

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, text, coalesce(source, chr(0)) AS site, row_number() OVER () AS r FROM documents),
carrier AS (SELECT text, arg_min(site, md5(md5(coalesce(text, '')) || '|' || site)) AS site FROM d GROUP BY text),
l AS (
  SELECT r, k, x, trim(regexp_replace(x, '[\\x09-\\x0D]', ' ', 'g'), ' ') AS line, len(regexp_extract_all(x, '{WORD}')) >= 1 AS judged
  FROM (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS k FROM d)),
bad AS (
  SELECT line FROM l JOIN d USING (r) JOIN carrier c ON c.text IS NOT DISTINCT FROM d.text WHERE judged
  GROUP BY line HAVING count(DISTINCT c.site) >= 10),
marked AS (SELECT l.*, judged AND bad.line IS NOT NULL AS gone FROM l LEFT JOIN bad ON l.line = bad.line),
per AS (
  SELECT r, count(*)::BIGINT AS n, count(*) FILTER (WHERE gone)::BIGINT AS n_gone,
    coalesce(string_agg(x, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS kept FROM marked GROUP BY r)
SELECT doc_id, CASE WHEN text IS NULL THEN 0 ELSE n END AS n_lines, n_gone AS n_removed, CASE WHEN n_gone = 0 THEN text ELSE kept END AS text
FROM d JOIN per USING (r)
"""


def centroids(rounds: int = 3) -> str:
    """Vectors as (r, i, x), centroids as (c, i, x); every round assigns and takes floors of means."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS MATERIALIZED (SELECT e.r, k.c, sum((e.x - k.x) * (e.x - k.x))::BIGINT AS d FROM e JOIN k{k} k USING (i) GROUP BY e.r, k.c),
a{k} AS MATERIALIZED (SELECT r, c, d FROM d{k} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if k < rounds:
            steps.append(f"""s{k} AS MATERIALIZED (SELECT c, i, sum(x)::BIGINT AS s, count(*) AS n FROM a{k} JOIN e USING (r) GROUP BY c, i),
k{k + 1} AS MATERIALIZED (SELECT k.c, k.i, CASE WHEN n IS NULL THEN k.x ELSE (s - ((s % n) + n) % n) // n END AS x FROM k{k} k LEFT JOIN s{k} USING (c, i))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
e AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS i, unnest(v) AS x FROM v),
seed AS (SELECT v, row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM v QUALIFY c < 16),
k0 AS MATERIALIZED (SELECT c, unnest(range(1, 65)) AS i, unnest(v) AS x FROM seed),
{", ".join(steps)},
sha AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM k{rounds} GROUP BY c)
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN sha USING (c)
"""


ORACLES: dict[str, str] = {"op3_mixing": MIXING, "op5_quality": QUALITY, "op7_line_dedup": LINE_DEDUP, "op12_centroids": centroids()}
