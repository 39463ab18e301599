"""Queries of the operators and the pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstat.llm import bytebpe, codes, credentials, ctph, fptree, langid, mixing, packing, sharding, simhash, templates, topk, urls
from clipstat.llm.common import table


def op1_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op2_ctph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.compare_with_edits(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", simhash.hex64(F.col("fp")).alias("fingerprint"), "component_id")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.find_secrets(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op6_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), keep_ids=False)


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.extract(table(spark, sf_dir, "pages"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.codes_with_errors(table(spark, sf_dir, "embeddings"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.digests(table(spark, sf_dir, "documents"))


def op13_fptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fptree.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_url_ratio, op2_ctph, op3_simhash, op4_secrets, op5_topk, op6_hilbert_shards,
                                   op7_packing, op8_html, op9_langid, op10_mixing, op11_codes, op12_bpe, op13_fptree, pipeline)}

_TOPK = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5
"""

_MIXING = r"""
WITH d AS (
    SELECT row_number() OVER () AS row_no, doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
e AS (SELECT *, floor(sqrt(size::DOUBLE) * 1024)::BIGINT AS root FROM d),
s AS (SELECT source, sum(size)::HUGEINT AS z, sum(size::HUGEINT * root)::DOUBLE AS m FROM e GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 3 END AS w FROM s),
t AS (SELECT sum(z) AS total, sum(w)::HUGEINT AS weight FROM w),
c AS (SELECT w.*, row_number() OVER o AS k, 3.0::DOUBLE * z::DOUBLE / w AS at,
             sum(3 * z) OVER o AS capped, sum(w::HUGEINT) OVER o AS gone FROM w WINDOW o AS (ORDER BY 3.0::DOUBLE * z::DOUBLE / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
l AS (SELECT 0 AS k, total::DOUBLE / weight::DOUBLE AS level FROM t UNION ALL
      SELECT k, (total - capped)::DOUBLE / (weight - gone)::DOUBLE FROM c, t WHERE gone < weight),
b AS (SELECT level FROM l WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.k = l.k + 1 AND c.at < l.level) ORDER BY k LIMIT 1),
g AS (SELECT source, z, m, CASE WHEN 3 * z < w * level THEN (3 * z)::DOUBLE ELSE w * level END AS target FROM w, b),
h AS (SELECT e.*, z, target, m, CASE WHEN z > 0 THEN floor(target / z) ELSE 0 END AS whole FROM e JOIN g ON e.source IS NOT DISTINCT FROM g.source),
i AS (SELECT *, CASE WHEN z > 0 THEN target - whole * z ELSE 0 END AS rest,
             (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || ':' || size), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM h),
j AS (SELECT *, greatest(1e-6, least(1 - 1e-6, CASE WHEN m > 0 THEN rest * root / m ELSE 0 END)) AS p FROM i),
k AS (SELECT *, (u / (1 - u)) / (p / (1 - p)) AS q FROM j),
n AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, doc_id NULLS LAST, size, row_no ROWS UNBOUNDED PRECEDING) - size AS run FROM k)
SELECT doc_id, size, z::BIGINT AS source_size, target::DOUBLE AS target,
       (size * (whole + CASE WHEN whole < 3 AND size > 0 AND run + size / 2.0 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM n
"""



def _codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Each round assigns every part by the least (distance, entry) and floors the means."""
    assign = """a{r} AS MATERIALIZED (
    SELECT rid, p, min(struct_pack(d := d, k := k)) AS best FROM (
        SELECT x.rid, x.p, c.k, list_sum(list_transform(list_zip(x.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM x JOIN c{r} c ON c.p = x.p) GROUP BY rid, p)"""
    update = """s{r} AS (SELECT p, k, i, ((s - ((s % n + n) % n)) // n)::BIGINT AS v FROM (
        SELECT x.p, a.best.k AS k, u.i, sum(x.x[u.i]) AS s, count(*)::HUGEINT AS n
        FROM x JOIN a{r} a ON a.rid = x.rid AND a.p = x.p, (SELECT unnest(range(1, (SELECT max(len(x)) + 1 FROM x))) AS i) u
        GROUP BY x.p, a.best.k, u.i)),
c{n} AS MATERIALIZED (SELECT c.p, c.k, coalesce(g.x, c.x) AS x FROM c{r} c
    LEFT JOIN (SELECT p, k, list(v ORDER BY i) AS x FROM s{r} GROUP BY p, k) g ON g.p = c.p AND g.k = c.k)"""
    steps = [f"""v AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""x AS MATERIALIZED (SELECT rid, p, e[p * (len(e) // {parts}) + 1:(p + 1) * (len(e) // {parts})] AS x
    FROM v, (SELECT unnest(range({parts})) AS p))""",
             f"""f AS (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, e) - 1 AS k FROM v),
c0 AS MATERIALIZED (SELECT x.p, f.k, x.x FROM x JOIN f ON f.rid = x.rid WHERE f.k < {entries})"""]
    for r in range(rounds):
        steps += [assign.format(r=r), update.format(r=r, n=r + 1)]
    steps.append(assign.format(r=rounds))
    steps.append(f"""h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, k)) AS h FROM c{rounds}),
o AS (SELECT rid, string_agg(printf('%02x', best.k::INTEGER), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY rid)""")
    return "WITH " + ",\n".join(steps) + """
SELECT v.vec_id, o.code, o.error, (sum(o.error) OVER (PARTITION BY v.label))::BIGINT AS label_error, h.h AS codebooks_sha256
FROM v JOIN o ON o.rid = v.rid, h"""


_RANKED = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
q AS (
    SELECT DISTINCT rid, item_id, unnest(t) AS term FROM (
        SELECT row_number() OVER () AS rid, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM benchmark)),
s AS (SELECT count(*)::HUGEINT AS n_docs, sum(len(t))::HUGEINT AS n_terms FROM d WHERE len(t) > 0),
tf AS MATERIALIZED (
    SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, len(t) AS n, unnest(t) AS term FROM d)
    WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY term, n_docs),
g AS (
    SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n::HUGEINT * n_docs) // n_terms)::BIGINT))) AS gain
    FROM tf JOIN w USING (term), s),
r AS (
    SELECT q.rid AS item, q.item_id, g.doc_id, g.rid, sum(gain)::BIGINT AS score FROM q JOIN g USING (term) GROUP BY ALL HAVING sum(gain) > 0),
o AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS n FROM r)
SELECT item_id, n::INTEGER AS rank, doc_id, score FROM o WHERE n <= 50
"""

ORACLE = {"op5_topk": _TOPK, "op10_mixing": _MIXING, "op11_codes": _codes_sql(), "op13_fptree": _RANKED}
