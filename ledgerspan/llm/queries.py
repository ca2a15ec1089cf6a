"""One query per operator over whole tables, and the SQL that must return the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerspan.llm import (
    centroids, contamination, hmm, mixing, paragraphs, periods, quality_model, rules, secrets, sharding, simhash, tokens, warc,
)
from ledgerspan.llm.common import table
from ledgerspan.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return run

    return register


# The weights follow the sources by code point; targets fill up to the level at which none of the rest is above its cap.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM {docs}
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w
  FROM d GROUP BY source
), o AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap, row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, w, source NULLS LAST) AS k FROM s
), c AS (
  SELECT *, coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free,
    1.5::DOUBLE * sum(source_size) OVER () AS budget
  FROM o
), l AS (
  SELECT min_by((budget - capped) / free, k) AS level FROM c WHERE (budget - capped) / free * w <= cap
), r AS (
  SELECT source, source_size, least(cap, level * w) AS target,
    CASE WHEN source_size > 0 THEN least(cap, level * w) / source_size ELSE 0 END AS rate
  FROM o, l
), n AS (
  SELECT d.*, r.source_size, r.target,
    CAST(floor(rate) AS BIGINT) + CASE WHEN CAST('0x' || md5('17:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:13] AS BIGINT) / 4503599627370496.0::DOUBLE
      < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
)"""


@query("op1_mixture", MIX_SQL.format(docs="documents") + " SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM n")
def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weights takes of every document."""
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query("op7_simhash_groups")
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    grouped = simhash.groups(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", simhash.hex_digits(grouped["fp"]).alias("fingerprint"), "component_id")


def _shares(counts: str, total: str) -> str:
    return f"list_transform({counts}, lambda x: CASE WHEN {total} > 0 THEN x / CAST({total} AS DOUBLE) ELSE 0 END)"


def _distance(p: str, q: str) -> str:
    side = "list_sum(list_transform(list_zip({0}, {1}), lambda z: CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END))"
    return f"sqrt(greatest(0, ({side.format(p, q)} + {side.format(q, p)}) / 2))"


def rules_sql(docs: str) -> str:
    """Common table expressions up to `verdict`, with one row per row of `docs`."""
    commons = ", ".join(f"'{w}'" for w in rules.COMMON_WORDS)
    classes = ", ".join(f"length(text) - length(regexp_replace(text, '[{c.replace(chr(39), chr(39) * 2)}]+', '', 'g'))" for c in (rules.LOWER, *rules.CLASSES))
    means = lambda part, n: "[" + ", ".join(f"avg({part}[{i + 1}])" for i in range(n)) + f"] AS {part}"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, n_chars, text AS raw, coalesce(text, '') AS text FROM {docs}),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
t AS (
  SELECT r, i, [ws[i], ws[i + 1], ws[i + 2]] AS three FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), g AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS n FROM t) WHERE n > 1),
m AS (SELECT r, count(DISTINCT j) AS n_repeat_words FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM g) GROUP BY r),
u AS (SELECT r, lower(unnest(ws)) AS x FROM w),
h AS (SELECT r, x, count(*) AS n FROM u WHERE x IN ({commons}) GROUP BY r, x),
c AS (SELECT r, map(list(x), list(n)) AS found, sum(n) AS listed FROM h GROUP BY r),
f AS (
  SELECT w.r, doc_id, lang, source, n_chars, raw, len(ws) AS n_words, length(regexp_replace(text, '[{rules.SPACE}]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[{rules.SYMBOLS}]+', '', 'g')) AS n_symbols,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, length(text) AS total, [{classes}] AS listed_classes,
    list_transform([{commons}], lambda x: coalesce(found[x], 0)) AS listed_words, coalesce(listed, 0) AS listed
  FROM w LEFT JOIN m USING (r) LEFT JOIN c USING (r)
), p AS (
  SELECT *, {_shares("list_append(listed_classes, total - list_sum(listed_classes))", "total")} AS classes,
    {_shares("list_append(listed_words, n_words - listed)", "n_words")} AS words,
    n_words < {rules.MIN_WORDS} OR 100 * n_repeat_words > {rules.MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM f
), refs AS (
  SELECT lang, count(*) AS n_docs, {means("classes", rules.N_CLASSES)}, {means("words", len(rules.COMMON_WORDS) + 1)}
  FROM p WHERE NOT base_failed GROUP BY lang
), x AS (
  SELECT p.*, CASE WHEN n_words >= {rules.GUARD_WORDS} AND refs.n_docs IS NOT NULL THEN {_distance("p.classes", "refs.classes")} END AS class_distance,
    CASE WHEN n_words >= {rules.GUARD_WORDS} AND refs.n_docs IS NOT NULL THEN {_distance("p.words", "refs.words")} END AS word_distance
  FROM p LEFT JOIN (SELECT * FROM refs WHERE n_docs >= {rules.GUARD_DOCS}) refs ON p.lang IS NOT DISTINCT FROM refs.lang
), verdict AS (
  SELECT *, NOT base_failed AND NOT coalesce(class_distance > {rules.MAX_CLASS_DISTANCE} OR word_distance > {rules.MAX_WORD_DISTANCE}, false) AS kept FROM x
)"""


@query(
    "op8_quality_rules",
    rules_sql("documents")
    + """
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, kept,
  CASE WHEN class_distance IS NULL THEN -1 ELSE round(class_distance, 6) END AS class_distance, CASE WHEN word_distance IS NULL THEN -1 ELSE round(word_distance, 6) END AS word_distance
FROM verdict""",
)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base rules and the verdict of every document; distances are rounded, -1 where a guard applies."""
    judged = rules.report(table(spark, sf_dir, "documents"))
    return judged.withColumns({c: F.coalesce(F.round(c, 6), F.lit(-1.0)) for c in ("class_distance", "word_distance")})


def _words_sql(text: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op4_contamination",
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql("text")} AS ws FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, {_words_sql("text")} AS ws FROM benchmark),
k AS (SELECT q, item_id, ws, least({contamination.WINDOW}, len(ws)) AS n FROM i WHERE len(ws) > 0),
w AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, n, array_to_string(ws[s:s + n - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS s FROM k)),
l AS (SELECT DISTINCT n FROM w),
x AS (SELECT r, n, s, array_to_string(ws[s:s + n - 1], ' ') AS phrase FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, l WHERE len(ws) >= n)),
f AS (SELECT x.r, x.n, x.s, w.item FROM x JOIN w ON x.n = w.n AND x.phrase = w.phrase),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM f) GROUP BY r),
g AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM f GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND {contamination.CONTAMINATED} * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN g USING (r)""",
)
def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return contamination.report(table(spark, sf_dir, "documents"), contamination.benchmark(spark, sf_dir))


@query(
    "op9_shards",
    f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0) AS n_bytes,
    CAST('0x' || md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')))[1:15] AS BIGINT) AS bits
  FROM documents
), p AS (
  SELECT *, sum(n_bytes) OVER (PARTITION BY depth, prefix) AS shard_bytes
  FROM (SELECT d.*, depth, bits >> ({sharding.BITS} - depth) AS prefix FROM d, (SELECT unnest(range(0, 41)) AS depth) WHERE n_bytes <= {sharding.LIMIT})
), m AS (SELECT r, min(depth) AS depth FROM p WHERE shard_bytes <= {sharding.LIMIT} GROUP BY r)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INT), '0') END AS shard,
  CAST(depth AS INT) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes
FROM p JOIN m USING (r, depth)""",
)
def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document."""
    return sharding.report(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the public byte-level BPE."""
    return tokens.token_counts(table(spark, sf_dir, "documents"))


@query("op10_hidden_markov")
def op10_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every document under the add-one unigram and the hidden Markov model."""
    return hmm.report(table(spark, sf_dir, "documents"))


@query("op3_repeated_paragraphs")
def op3_repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places of all paragraphs that repeat, with the document that keeps each."""
    return paragraphs.repeats(table(tune(spark), sf_dir, "documents")).drop("mark")


@query("op2_quality_model")
def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_model.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_secret_findings")
def op5_secret_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place and verdict of every candidate for a secret; the candidates themselves stay out of the result."""
    return secrets.scan(table(spark, sf_dir, "documents")).drop("candidate")


@query(
    "op11_warc_records",
    f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
n AS (SELECT *, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS keeper, row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS k FROM p),
t AS (SELECT *, strlen(payload) >= {warc.LEAST_BYTES} AND k > 1 AS revisit FROM n)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda c: substr('{warc.BASE32}', 1 + ((CAST('0x' || substr(h, CAST(5 * (c // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (c % 4) AS BIGINT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN revisit THEN keeper END AS refers_to
FROM t""",
)
def op11_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back, with the response that a repeated payload refers to."""
    return warc.report(table(spark, sf_dir, "pages"))


# crc32 by its table; pairs of equal words of a document are islands of one distance.
@query(
    "op12_periodic_runs",
    r"""WITH t AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda acc, x: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END) ORDER BY i) AS crcs FROM range(256) AS x(i)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    xor(4294967295, list_reduce([4294967295] || list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda k: CAST(ascii(CAST(doc_id AS VARCHAR)[k]) AS BIGINT)),
      lambda acc, x: xor(acc >> 8, crcs[(xor(acc, x) & 255) + 1]))) AS h
  FROM documents, t
), a AS (SELECT *, len(ws) AS n, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM d),
w AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
    list_transform(ws, lambda x, i: CASE WHEN i <= a THEN x ELSE ws[a + (i - 1 - a) % (1 + (n - a) // (3 + g % 8)) + 1] END) ELSE ws END AS ws
  FROM a
), e AS (SELECT r, unnest(ws) AS word, unnest(range(n)) AS i FROM w),
q AS (SELECT x.r, y.i - x.i AS p, x.i FROM e x JOIN e y ON x.r = y.r AND x.word = y.word AND x.i < y.i),
s AS (SELECT r, p, min(i) AS start, count(*) AS same FROM (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM q) GROUP BY r, p, island HAVING count(*) >= greatest(p, 12 - p)),
u AS (SELECT r, start, same + p AS length, min(p) AS period FROM s GROUP BY r, start, same + p),
m AS (
  SELECT r, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    list({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period)[1] AS best
  FROM u GROUP BY r
), g AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM u),
c AS (SELECT e.r, string_agg(word, ' ' ORDER BY e.i) AS left_over FROM e LEFT JOIN g ON e.r = g.r AND e.i = g.i WHERE g.i IS NULL GROUP BY e.r)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(best.start AS BIGINT) AS start, CAST(best.length AS BIGINT) AS length,
  CAST(best.period AS BIGINT) AS period, CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(left_over, '')) AS collapsed_sha256
FROM w LEFT JOIN m USING (r) LEFT JOIN c USING (r)""",
)
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, of which a tenth is made to repeat, and its text without repetitions."""
    docs = table(spark, sf_dir, "documents")
    return periods.report(docs.withColumn("text", periods.planted(F.col("doc_id"), F.col("text"))))


def centroids_sql() -> str:
    """The rounds one by one; a distance is a sum over components."""
    near = """
n{i} AS (
  SELECT r, cluster, distance FROM (
    SELECT r, cluster, distance, row_number() OVER (PARTITION BY r ORDER BY distance, cluster) AS k FROM (
      SELECT v.r, c.cluster, CAST(list_sum(list_transform(list_zip(v.whole, c.whole), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS distance FROM v, c{i} c
    )
  ) WHERE k = 1
)"""
    move = """
s{i} AS (SELECT cluster, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT n.cluster, unnest(v.whole) AS x, unnest(range(1, {dimensions} + 1)) AS d FROM n{before} n JOIN v USING (r)) GROUP BY cluster, d),
m{i} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY d) AS whole FROM s{i} GROUP BY cluster),
c{i} AS (SELECT c.cluster, coalesce(m.whole, c.whole) AS whole FROM c{before} c LEFT JOIN m{i} m USING (cluster))"""
    steps = [near.format(i=0)]
    for i in range(1, centroids.ROUNDS + 1):
        steps += [move.format(i=i, before=i - 1, dimensions=centroids.DIMENSIONS), near.format(i=i)]
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS whole
  FROM embeddings WHERE len(embedding) = {centroids.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMENSIONS}
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('{centroids.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), whole) - 1 AS INT) AS cluster, whole FROM v
  QUALIFY cluster < {centroids.CLUSTERS}
), {",".join(steps)}, last AS (SELECT * FROM n{centroids.ROUNDS}), per AS (SELECT cluster, CAST(sum(distance) AS BIGINT) AS cluster_inertia FROM last GROUP BY cluster)
SELECT vec_id, cluster, distance, cluster_inertia, CAST((SELECT sum(distance) FROM last) AS BIGINT) AS inertia, sha256(array_to_string(c.whole, ',')) AS centroid_sha256
FROM last JOIN v USING (r) JOIN per USING (cluster) JOIN c{centroids.ROUNDS} c USING (cluster)"""


@query("op13_centroid_clusters", centroids_sql())
def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after ten rounds."""
    return centroids.report(table(spark, sf_dir, "embeddings"))
