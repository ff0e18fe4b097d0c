"""The registered queries of the training-data operators."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pansift.llm._common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.line_dedup import dedup_lines
    return dedup_lines(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.token_counts import count_tokens
    return count_tokens(table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.sentencepiece_codec import code_digests
    return code_digests(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm import warc
    folder = warc.archive_folder(spark)
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(manifest, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.toxicity import fit, score
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.mixing import mix
    # rounded, since the sum of the sources' sizes may be taken in any order
    return mix(table(spark, sf_dir, "documents")).drop("copies").withColumn("target", F.round("target", 6))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.exact_dedup import dedup
    return dedup(table(spark, sf_dir, "documents")).drop("known")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.sharding import shard
    return shard(table(spark, sf_dir, "documents"), 24)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.ann import search
    return search(table(spark, sf_dir, "embeddings"))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.centroids import cluster
    return cluster_digest(cluster(table(spark, sf_dir, "embeddings")))


def cluster_digest(found) -> DataFrame:
    """Per vector the totals of its cluster and the digest of its centroid."""
    def of_cluster(values, kind):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster") + 1) if values else F.lit(None).cast(kind)
    total = sum(found.inertia) if None not in found.inertia else None
    total = total if total is not None and total < 1 << 63 else None
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    return found.assigned.select("vec_id", "cluster", "distance", of_cluster(found.inertia, "long").alias("cluster_inertia"),
                                 F.lit(total).cast("long").alias("inertia"), of_cluster(hashes, "string").alias("centroid_sha256"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.decontamination import contamination
    return item_digest(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def item_digest(found: DataFrame) -> DataFrame:
    """Per document the number and digest of its items."""
    names = F.concat_ws(",", F.sort_array(F.transform("items", lambda i: i.cast("string"))))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(names, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pansift.llm.alignment import link_counts
    return link_counts(table(spark, sf_dir, "documents"))


SQL: dict[str, str] = {}

SQL["op7_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t
WINDOW w AS (PARTITION BY text_sha256 ORDER BY length(text) DESC, doc_id NULLS LAST)
"""

SQL["op3_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (
  SELECT page_id, strlen(html) AS payload_bytes, html, sha1(html) AS hex,
         min(page_id) OVER (PARTITION BY html) AS first_id
  FROM p),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    lpad(bin(instr('0123456789abcdef', hex[i]) - 1), 4, '0')), '') AS bits
  FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda j:
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + 16 * CAST(bits[5*j+1] AS INT) + 8 * CAST(bits[5*j+2] AS INT)
           + 4 * CAST(bits[5*j+3] AS INT) + 2 * CAST(bits[5*j+4] AS INT) + CAST(bits[5*j+5] AS INT)]), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM b
"""

SQL["op1_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l0 AS (
  SELECT doc_id, CAST(i AS INT) AS line_no,
         trim(parts[i + 1], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, parts, unnest(range(0, len(parts))) AS i FROM split)),
l AS MATERIALIZED (SELECT *, row_number() OVER () AS r FROM l0),
c AS (
  SELECT line, length(line) AS n, min({'d': doc_id, 'l': line_no, 'r': r}) AS first
  FROM l WHERE line <> '' GROUP BY line),
h AS (
  SELECT line, n, first, m, side, CASE WHEN side = 0 THEN left(line, m // 2) ELSE right(line, m - m // 2) END AS half
  FROM (SELECT line, n, first, unnest([n, n - 1]) AS m FROM c WHERE n >= 16), (VALUES (0), (1)) s(side)),
pairs AS (
  SELECT DISTINCT a.line AS line, b.line AS other, a.n AS n, b.n AS o, b.first AS first
  FROM h a JOIN h b USING (m, side, half)
  WHERE b.first < a.first AND (a.n = a.m OR b.n = a.m)),
met AS (
  SELECT *, coalesce(list_position(list_transform(range(1, least(n, o) + 1), lambda i: line[i] <> other[i]), true),
                     least(n, o) + 1) - 1 AS p
  FROM pairs),
near AS (
  SELECT line, min(first) AS keep FROM met
  WHERE (n = o AND substr(line, p + 2) = substr(other, p + 2)) OR (n = o + 1 AND substr(line, p + 2) = substr(other, p + 1))
     OR (o = n + 1 AND substr(other, p + 2) = substr(line, p + 1))
  GROUP BY line),
t AS (SELECT c.line, coalesce(near.keep, c.first) AS keep FROM c LEFT JOIN near USING (line))
SELECT l.doc_id, l.line_no,
       coalesce(t.keep.r = l.r, true) AS kept,
       CASE WHEN t.keep IS NULL THEN l.doc_id ELSE t.keep.d END AS keep_doc_id, coalesce(t.keep.l, l.line_no) AS keep_line_no
FROM l LEFT JOIN t ON l.line = t.line
"""

# Targets: with the sources in the order in which they reach their limit, the
# unit of weight follows from how many of them stop there.
SQL["op5_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS u
  FROM documents),
s AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, 3.0::DOUBLE * source_size AS cap,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight
  FROM (SELECT source, sum(size) AS source_size FROM d GROUP BY source)),
k AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER below, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER below, 0)) AS unit
  FROM s WINDOW below AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, least(cap, weight * (SELECT unit FROM k WHERE unit * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1)) AS target FROM s),
b AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST(floor(target / source_size) AS BIGINT) END AS passes FROM t),
g AS (SELECT source, u, sum(size) AS words FROM d GROUP BY source, u),
c AS (
  SELECT g.source, g.u, g.words, b.target - b.passes * b.source_size AS need,
         coalesce(sum(g.words) OVER (PARTITION BY g.source ORDER BY g.u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM g JOIN b ON g.source IS NOT DISTINCT FROM b.source)
SELECT d.doc_id, d.size, b.source_size, round(b.target, 6) AS target, d.source,
       CAST(d.size * (b.passes + CASE WHEN c.before + c.words <= c.need OR (c.before <= c.need AND 2 * (c.need - c.before) > c.words)
                                      THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
JOIN c ON d.source IS NOT DISTINCT FROM c.source AND d.u = c.u
"""

SQL["op12_decontamination"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
g AS (
  SELECT r, i, n, w[i:i + n - 1] AS g
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
m AS MATERIALIZED (SELECT r, i, n, item_id FROM g JOIN win USING (n, g)),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM m WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""


def _centroid_sql(rounds: int = 10) -> str:
    """Each round is two steps of SQL: the nearest centroids, then their floored means."""
    parts = [r"""
e AS (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT r, vec_id, unnest(range(0, 64)) AS i, CAST(floor(1024.0::DOUBLE * unnest(embedding)::DOUBLE) AS BIGINT) AS x FROM e),
seed AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR))) - 1 AS c FROM e WHERE vec_id IS NOT NULL),
c0 AS MATERIALIZED (SELECT CAST(c AS INT) AS c, i, x AS m FROM seed JOIN v USING (r) WHERE c < 8)"""]
    for k in range(rounds + 1):
        parts.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT r, c, CAST(sum((x - m) * (x - m)) AS BIGINT) AS d FROM v JOIN c{k} USING (i) GROUP BY r, c) GROUP BY r)""")
        if k < rounds:
            parts.append(f"""
c{k + 1} AS MATERIALIZED (
  SELECT c, i, CAST(coalesce((s - ((s % n) + n) % n) // n, m) AS BIGINT) AS m
  FROM c{k} LEFT JOIN (SELECT c, i, sum(x) AS s, count(*) AS n FROM a{k} JOIN v USING (r) GROUP BY c, i) USING (c, i))""")
    return "WITH " + ",".join(parts) + f""",
h AS (SELECT c, sha256(string_agg(CAST(m AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN h USING (c) JOIN e USING (r)
"""


SQL["op11_centroids"] = _centroid_sql()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2:].split("_")[0].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
