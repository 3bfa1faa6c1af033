"""DuckDB SQL for those operators that SQL can express."""

from __future__ import annotations

from docpipe.llm import centroid_clusters, mixing, quality_rules

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _bits() -> str:
    return " + ".join(f"(CASE WHEN {fails.replace('m.', '')} THEN {1 << bit} ELSE 0 END)" for bit, _, fails in quality_rules.RULES)


def _names() -> str:
    return " ".join(f"WHEN {1 << bit} THEN '{name}'" for bit, name, _ in quality_rules.RULES)


def _kept() -> str:
    return ", ".join(
        f"(fail_bits & {p.mask | quality_rules.BASE}) = 0 AS kept_{p.version.replace('-', '_')}" for p in quality_rules.POLICIES.values()
    )


OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows),
repeated AS (
  SELECT r, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS place FROM counted WHERE n > 1) GROUP BY r
),
lines AS (SELECT r, line FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
line_counts AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters,
    length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN line_counts USING (r)
),
b AS (SELECT *, ({_bits()})::BIGINT AS fail_bits FROM m),
s AS (SELECT *, CASE fail_bits & {quality_rules.CURRENT.mask | quality_rules.BASE} {_names()} END AS sole_rule FROM b)
-- kept_without_rule: how many documents would come back without the rule that alone rejects this one
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (fail_bits & {quality_rules.BASE}) <> 0 AS base_failed, (fail_bits & {quality_rules.CURRENT.mask | quality_rules.BASE}) = 0 AS kept, fail_bits,
  {_kept()}, sole_rule, CASE WHEN sole_rule IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY sole_rule) END AS kept_without_rule
FROM s
"""

_A = "[" + ", ".join(str(s[0]) for s in mixing.SCHEDULES) + "]"
_B = "[" + ", ".join(str(s[1]) for s in mixing.SCHEDULES) + "]"

OP9 = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS h, len({WORDS})::BIGINT AS size FROM documents
),
s AS (
  SELECT source, source_size, place, {list(mixing.WEIGHTS)}[place % {len(mixing.WEIGHTS)} + 1] AS w
  FROM (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source
  )
),
-- each round: what is left for the sources that are not at their cap, and how many are
fill AS (
  SELECT 0 AS turn, (SELECT sum(source_size)::HUGEINT FROM s) AS rest, (SELECT sum(w)::HUGEINT FROM s) AS weight,
    -1::BIGINT AS before, 0::BIGINT AS n
  UNION ALL
  SELECT f.turn + 1, any_value(f.total) - coalesce(sum(3 * s.source_size) FILTER (WHERE f.rest * s.w > 3 * s.source_size::HUGEINT * f.weight), 0),
    sum(s.w) FILTER (WHERE f.rest * s.w <= 3 * s.source_size::HUGEINT * f.weight), any_value(f.n),
    count(*) FILTER (WHERE f.rest * s.w > 3 * s.source_size::HUGEINT * f.weight)
  FROM (SELECT *, (SELECT sum(source_size)::HUGEINT FROM s) AS total FROM fill WHERE before <> n) f, s
  GROUP BY f.turn
),
final AS (SELECT rest, weight FROM fill ORDER BY turn DESC LIMIT 1),
t AS (
  SELECT s.*, CASE WHEN rest * w > 3 * source_size::HUGEINT * weight THEN (3 * source_size)::DOUBLE
    ELSE (rest * w)::DOUBLE / weight::DOUBLE END AS target
  FROM s, final
),
line AS (
  SELECT d.*, t.source_size, t.target, t.place,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
),
c AS (
  SELECT *, {_A}[place % 3 + 1]::DOUBLE AS a, {_B}[place % 3 + 1]::DOUBLE AS b, (start::DOUBLE + size::DOUBLE / 2) / target AS q,
    CASE WHEN size = 0 THEN 0 ELSE len(list_filter([0, 1, 2], lambda e: (start + e * source_size)::DOUBLE + size::DOUBLE / 2 <= target)) END AS copies
  FROM line
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
  CASE WHEN copies = 0 THEN NULL WHEN a = b THEN q ELSE (sqrt(a * a + (b - a) * (a + b) * q) - a) / (b - a) END AS first_due
FROM c
"""

OP4 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

# base32 by hand: each five hex digits are four letters of five bits
_B32 = "list_aggregate(list_transform(range(0, 8), lambda i: list_aggregate(list_transform([32768, 1024, 32, 1], lambda p: " \
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1(coalesce(html, '')), i * 5 + 1, 5))::BIGINT // p) % 32 + 1)::BIGINT, 1)), " \
    "'string_agg', '')), 'string_agg', '')"

OP6 = f"""
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, {_B32} AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
"""



def _clusters(s: centroid_clusters.Settings) -> str:
    """One step per round, written out: assignment to the last centroids, then their floored means."""

    def assigned(k: int) -> str:
        square = "list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
        return f"""a{k} AS MATERIALIZED (
  SELECT r, vec_id, x, cluster, d FROM (
    SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, cluster) AS place
    FROM (SELECT v.*, c.cluster, {square} AS d FROM v, c{k} c)
  ) WHERE place = 1
)"""

    def moved(k: int) -> str:
        return f"""c{k + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (
    SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x
    FROM (
      SELECT cluster, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k}, range(1, {s.dims + 1}) t(i) GROUP BY cluster, i
    ) GROUP BY cluster
  ) m USING (cluster)
)"""

    steps = ",\n".join(f"{assigned(k)},\n{moved(k)}" for k in range(s.rounds))
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({s.scale} * x::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = {s.dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS cluster, x
  FROM (SELECT sha256('{s.seed}:' || vec_id::VARCHAR) AS h, x FROM v WHERE vec_id IS NOT NULL ORDER BY h, x LIMIT {s.centroids})
),
{steps},
{assigned(s.rounds)}
SELECT vec_id, a.cluster::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
  (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{s.rounds} a JOIN c{s.rounds} c USING (cluster)
"""


OP11 = _clusters(centroid_clusters.Settings())

# CRC-32 by hand: the table of its 256 steps from the polynomial, then one step per byte of each distinct word
OP13 = r"""
WITH RECURSIVE steps AS (
  SELECT b, b AS c, 0 AS turn FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, turn + 1 FROM steps WHERE turn < 8
),
crc_table AS MATERIALIZED (SELECT list(c ORDER BY b) AS c FROM steps WHERE turn = 8),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, true AS of_docs, text FROM documents
  UNION ALL SELECT 0, NULL, false, text FROM benchmark
),
words AS MATERIALIZED (
  SELECT r, doc_id, of_docs, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
),
hexed AS (SELECT word, lower(hex(encode(word))) AS h FROM (SELECT DISTINCT word FROM words)),
codes AS MATERIALIZED (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda i: ('0x' || substr(h, i::INTEGER, 2))::BIGINT)),
    lambda s, b: xor(s // 256, c[xor(s % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM hexed, crc_table
),
used AS MATERIALIZED (SELECT r, of_docs, bucket FROM words JOIN codes USING (word)),
sums AS (
  SELECT (SELECT count(*) FROM used WHERE of_docs)::DOUBLE AS all_docs, (SELECT count(*) FROM used WHERE NOT of_docs)::DOUBLE AS all_target
),
gains AS (
  SELECT bucket, floor(1000 * ln((count(*) FILTER (NOT of_docs) + 1)::DOUBLE * (any_value(all_docs) + 10000)
    / ((count(*) FILTER (of_docs) + 1)::DOUBLE * (any_value(all_target) + 10000))))::BIGINT AS gain
  FROM used, sums GROUP BY bucket
),
weights AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM used JOIN gains USING (bucket) WHERE of_docs GROUP BY r),
scored AS (
  SELECT r, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (r) WHERE of_docs
),
places AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20 AND score IS NOT NULL
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN places USING (r)
"""

# all pairs that share a shingle, counted; then the smallest id that links lead to
OP12 = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS x FROM d
),
sizes AS MATERIALIZED (SELECT r, len(x) AS n FROM sets),
items AS MATERIALIZED (SELECT r, unnest(x) AS item FROM sets),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM items a JOIN items b ON a.item = b.item AND a.r <> b.r
  JOIN sizes sa ON sa.r = a.r JOIN sizes sb ON sb.r = b.r
  WHERE least(sa.n, sb.n) * 100 >= greatest(sa.n, sb.n) * 90
  GROUP BY a.r, b.r, sa.n, sb.n HAVING 100 * count(*) >= 90 * (sa.n + sb.n - count(*))
),
reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT s.doc_id, len(s.x)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN (SELECT reach.a AS r, min(t.doc_id) AS component_id FROM reach JOIN sets t ON t.r = reach.b GROUP BY reach.a) c USING (r)
"""

ORACLE = {
    "op3_quality_rules": OP3, "op4_pivot_search": OP4, "op6_warc": OP6, "op9_mixing": OP9, "op11_centroid_clusters": OP11,
    "op12_jaccard_join": OP12,
    "op13_importance_resampling": OP13,
}
