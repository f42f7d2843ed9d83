"""The opN_ queries: each applies its operator to the whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, embed_dedup, lexical, license_scan, mixing, neighbours, packing, quality, secret_scan, sharding,
               simhash, warc, whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_warc(spark, sf_dir):
    manifest = warc.write(_table(spark, sf_dir, "pages"))
    return warc.read(spark, manifest).drop("archive")


OP1_SQL = """
WITH p AS (SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY d, n ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
             max(page_id) OVER (PARTITION BY d, n) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND place > 1 THEN last END AS refers_to FROM r"""


def op2_mixing(spark, sf_dir):
    return (mixing.plan(_table(spark, sf_dir, "documents"), ["doc_id"])
            .orderBy(F.col("position").asc_nulls_last(), "_order")
            .select("row.doc_id", "size", "source_size", "target", "taken", F.size("copies").cast("bigint").alias("copies"),
                    (F.rint(F.col("position") * 1e9) / 1e9).alias("position")))


OP2_SQL = r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key,
             CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS cycle, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
v AS (SELECT *, CASE cycle WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM w),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE
                 - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
      FROM v WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
t AS (SELECT source, source_size, cycle, CASE WHEN lev < cap / w THEN least(cap, max(CASE WHEN lev < cap / w THEN lev END) OVER () * w)
             ELSE cap END AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.cycle,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin_at,
             CAST(floor(t.target) AS BIGINT) // greatest(t.source_size, 1) AS passes
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, CASE WHEN size > 0 THEN passes ELSE 0 END AS whole,
             least(greatest(CAST(floor(target) AS BIGINT) - passes * source_size - begin_at, 0), size) AS part,
             least(CAST(begin_at AS DOUBLE) / greatest(target, 1.0::DOUBLE), 1.0::DOUBLE) AS used FROM r),
-- the share of the target used, looked up in the inverse of the integral of each rate: 1; 0.5 + t; 1.5 - t
c AS (SELECT *, whole + CASE WHEN part > 0 THEN 1 ELSE 0 END AS copies, CASE cycle WHEN 0 THEN used
        WHEN 1 THEN sqrt(0.25::DOUBLE + 2 * used) - 0.5::DOUBLE ELSE 1.5::DOUBLE - sqrt(2.25::DOUBLE - 2 * used) END AS time FROM p)
SELECT doc_id, size, source_size, target, CAST(whole * size + part AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies,
       CASE WHEN copies > 0 THEN round_even(time * 1e9, 0) / 1e9 END AS position
FROM c"""


def op3_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark, sf_dir):
    return secret_scan.report(_table(spark, sf_dir, "documents"))


def op5_embed_dedup(spark, sf_dir):
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND NOT list_has_any(list_transform(e, lambda x: coalesce(isfinite(x), false)), [false])
       AND list_has_any(list_transform(e, lambda x: x <> 0), [true])),
link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
         AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
comp AS (SELECT x, min(y) AS c FROM reach GROUP BY x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, comp.c AS component_id, v.vec_id = comp.c AS kept
FROM v JOIN comp ON comp.x = v.vec_id LEFT JOIN n ON n.x = v.vec_id"""


def op6_sharding(spark, sf_dir):
    return sharding.shard(_table(spark, sf_dir, "documents"))


def op7_neighbours(spark, sf_dir):
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank")


def op8_license_scan(spark, sf_dir):
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = quality.train(docs, _table(spark, sf_dir, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.col("_expected").alias("expected_grade"), F.col("_tail").alias("tail_probability"),
        F.col("_keep").alias("selected"))


def op10_simhash(spark, sf_dir):
    return simhash.simhash_groups(_table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_whitening(spark, sf_dir):
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_lexical(spark, sf_dir):
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT r, doc_id, term, count(*) AS tf FROM d GROUP BY r, doc_id, term),
n AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
m AS (SELECT r, 75 + (25 * n * docs) // words AS m FROM n, c),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM tf, c GROUP BY term, docs),
qt AS (SELECT i, item_id, term, count(*) AS times FROM q GROUP BY i, item_id, term),
s AS (SELECT i, item_id, tf.r, tf.doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM qt JOIN w USING (term) JOIN tf USING (term) JOIN m ON m.r = tf.r GROUP BY i, item_id, tf.r, tf.doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20"""


def op13_bpe(spark, sf_dir):
    return bpe.digest(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_mixing, op3_packing, op4_secret_scan, op5_embed_dedup, op6_sharding,
                                   op7_neighbours, op8_license_scan, op9_quality, op10_simhash,
                                   op11_whitening, op12_lexical, op13_bpe)}
ORACLES = {"op1_warc": OP1_SQL, "op2_mixing": OP2_SQL, "op5_embed_dedup": OP5_SQL, "op12_lexical": OP12_SQL}
