"""The opN_<name> queries over the driver tables, and their SQL."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plotwise.llm import decontam, fill_middle, licenses, mixing, ngram_join, ranked_search, secret_scan, sketch_dedup, suffix_dedup, token_shards, topk, toxicity, url_filter
from plotwise.llm.tables import read, ship

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    """Registers a query under its name, with its SQL where SQL can express it."""
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLE[fn.__name__] = sql
        return run
    return add


@query("""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""")
def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), k=5).select("query_id", "rank", "vec_id", "score")


@query()
def op2_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.materialise(read(spark, sf_dir, "documents"))


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(read(spark, sf_dir, "documents"), length=100)


@query()
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(read(spark, sf_dir, "documents"), n_words=4, percent=85)


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query(r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS w FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size AS top, 2.0::DOUBLE * source_size / w AS ratio,
        row_number() OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST) AS k FROM w),
l AS (SELECT a.*, (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - coalesce((SELECT sum(top) FROM r b WHERE b.k < a.k), 0))
        / (SELECT sum(w) FROM r b WHERE b.k >= a.k) AS level FROM r a),
f AS (SELECT min(k) AS k FROM l WHERE level <= ratio),
t AS (SELECT source, source_size, CASE WHEN k < coalesce((SELECT k FROM f), 1000000000) THEN top
        ELSE (SELECT level FROM l x WHERE x.k = (SELECT k FROM f)) * w END AS target FROM l),
c AS (SELECT d.doc_id, d.size, t.source_size, t.target,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        CAST('0x' || substr(md5(concat_ws(':', 'mix-1', CAST(d.doc_id AS VARCHAR), d.source, CAST(d.size AS VARCHAR))), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
""")
def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(read(spark, sf_dir, "documents"), weights=(3, 1, 2), budget=1.5, cap=2.0).select("doc_id", "size", "source_size", "target", "taken")


def _files(docs: DataFrame) -> DataFrame:
    """Documents as files of a tree: source/lang/groups of 4096 and of 64 ids. A document that opens with a
    license line is a license file, of its group of 4096 (even ids) or of the whole language (odd ids)."""
    opens = F.lower(F.substring_index(F.coalesce("text", F.lit("")), "\n", 1)).contains("licen")
    group = lambda n: F.floor(F.col("doc_id") / n).cast("string")
    name = F.concat(F.lit("LICENSE-"), F.col("doc_id").cast("string"))
    path = (F.when(opens & (F.col("doc_id") % 2 == 1), F.concat_ws("/", "source", "lang", name))
            .when(opens, F.concat_ws("/", "source", "lang", group(4096), name))
            .otherwise(F.concat_ws("/", "source", "lang", group(4096), group(64), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))))
    return docs.select("doc_id", "text", path.alias("path"))


@query()
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.inherit(licenses.own_licenses(_files(read(spark, sf_dir, "documents"))))


@query()
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query()
def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def _code(text: Column) -> Column:
    """A number from a text, the same in both engines."""
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int")


def _captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date derived from the id: somewhere in 730 days."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 7919 % 730).cast("int")).alias("fetched_on"))


def _list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries derived from the hosts, domains and first path segments of the pages."""
    seen = pages.select(url_filter.host_of(F.col("url")).alias("host"), F.get(url_filter.path_segments(F.col("url")), 0).alias("seg")).filter("host <> ''")
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    entry = lambda verdict, action, on: (F.lit(verdict).alias("verdict"), F.lit(action).alias("action"), on.alias("listed_on"))
    c = F.col("c")
    hosts = seen.select(F.col("host").alias("key")).distinct().withColumn("c", _code(F.col("key")))
    domains = hosts.select(F.regexp_extract("key", r"([^.]+\.[^.]+)$", 1).alias("key")).filter("key <> ''").distinct().withColumn("c", _code(F.col("key")))
    paths = seen.filter("seg is not null").select(F.concat_ws("/", "host", "seg").alias("key")).distinct().withColumn("c", _code(F.col("key")))
    first, removed = F.floor(c / 4) % 600, F.floor(c / 4) % 600 + 30 + F.floor(c / 8) % 120
    return (hosts.filter(c % 4 == 0).select("key", *entry("block", "add", day(first)))
            .unionByName(hosts.filter(c % 8 == 0).select("key", *entry("block", "remove", day(removed))))
            .unionByName(hosts.filter(c % 16 == 0).select("key", *entry("block", "add", day(removed + 60))))
            .unionByName(domains.select("key", *entry("block", "add", day(c % 700))))
            .unionByName(domains.select("key", *entry("block", "remove", day(c % 700 + 45))))
            .unionByName(paths.filter(c % 6 == 0).select("key", *entry("allow", "add", day(c % 500))))
            .unionByName(paths.filter(c % 12 == 0).select("key", *entry("allow", "remove", day(c % 500 + 100)))))


@query(r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 7919 % 730 AS INTEGER) AS fetched_on,
    lower(coalesce(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), '')) AS host,
    list_filter(string_split(coalesce(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), ''), '/'), lambda s: s <> '') AS segs
  FROM pages),
kc AS (SELECT key, CAST('0x' || substr(md5(key), 1, 6) AS INTEGER) AS c, kind FROM (
  SELECT DISTINCT host AS key, 'h' AS kind FROM p WHERE host <> ''
  UNION SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+)$', 1), 'd' FROM p WHERE regexp_extract(host, '([^.]+\.[^.]+)$', 1) <> ''
  UNION SELECT DISTINCT host || '/' || segs[1], 'p' FROM p WHERE host <> '' AND len(segs) > 0)),
e AS (
  SELECT key, 'block' AS verdict, 1 AS adds, DATE '2024-01-01' + c // 4 % 600 AS d FROM kc WHERE kind = 'h' AND c % 4 = 0
  UNION SELECT key, 'block', 0, DATE '2024-01-01' + (c // 4 % 600 + 30 + c // 8 % 120) FROM kc WHERE kind = 'h' AND c % 8 = 0
  UNION SELECT key, 'block', 1, DATE '2024-01-01' + (c // 4 % 600 + 90 + c // 8 % 120) FROM kc WHERE kind = 'h' AND c % 16 = 0
  UNION SELECT key, 'block', 1, DATE '2024-01-01' + c % 700 FROM kc WHERE kind = 'd'
  UNION SELECT key, 'block', 0, DATE '2024-01-01' + (c % 700 + 45) FROM kc WHERE kind = 'd'
  UNION SELECT key, 'allow', 1, DATE '2024-01-01' + c % 500 FROM kc WHERE kind = 'p' AND c % 6 = 0
  UNION SELECT key, 'allow', 0, DATE '2024-01-01' + (c % 500 + 100) FROM kc WHERE kind = 'p' AND c % 12 = 0),
g AS (SELECT key, verdict, d, max(adds) AS adds FROM e GROUP BY ALL),
-- the latest change on or before the fetch date tells whether the key is listed; the day it was added is the first of the run of adds
k AS (
  SELECT page_id, url, fetched_on, unnest(list_concat(
    list_transform(range(1, greatest(len(string_split(host, '.')) - 1, 1) + 1), lambda i: {'key': array_to_string(string_split(host, '.')[i:], '.'), 'spec': len(string_split(host, '.')) - i + 1}),
    list_transform(range(1, len(segs) + 1), lambda i: {'key': host || '/' || array_to_string(segs[:i], '/'), 'spec': 1000 + i}))) AS k
  FROM p WHERE host <> ''),
a AS (
  SELECT k.page_id, k.url, k.fetched_on, k.k.key AS key, k.k.spec AS spec, s.verdict,
    (SELECT max(g.d) FROM g WHERE g.key = k.k.key AND g.verdict = s.verdict AND g.d <= k.fetched_on) AS latest
  FROM k JOIN (SELECT DISTINCT key, verdict FROM g) s ON s.key = k.k.key),
b AS (
  SELECT a.*, (SELECT min(g.d) FROM g WHERE g.key = a.key AND g.verdict = a.verdict AND g.d <= a.fetched_on AND g.adds = 1
      AND g.d > coalesce((SELECT max(z.d) FROM g z WHERE z.key = a.key AND z.verdict = a.verdict AND z.d <= a.fetched_on AND z.adds = 0), DATE '1900-01-01')) AS since
  FROM a JOIN g ON g.key = a.key AND g.verdict = a.verdict AND g.d = a.latest AND g.adds = 1),
r AS (SELECT *, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (PARTITION BY page_id ORDER BY spec DESC, since DESC, verdict DESC) AS rn FROM b)
SELECT p.page_id, p.url, strftime(p.fetched_on, '%Y-%m-%d') AS fetched_on, CAST(coalesce(r.verdict = 'block', false) AS INTEGER) AS blocked, coalesce(r.n, 0) AS n_active,
  r.key AS matched_key, r.verdict, strftime(r.since, '%Y-%m-%d') AS listed_on
FROM p LEFT JOIN r ON r.page_id = p.page_id AND r.rn = 1
""")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(_captures(pages), _list_entries(pages))
    return judged.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "listed_on")})


@query(r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
h AS (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS k FROM s),
rep AS (SELECT r, i FROM h WHERE k IN (SELECT k FROM h GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + unnest(range(35)) AS p FROM rep),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
kept AS (SELECT words.r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone ON words.r = gone.r AND words.p = gone.p GROUP BY words.r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r
""")
def op11_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_dedup.dedup(read(spark, sf_dir, "documents"), window=35).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query(r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, CAST(len(u) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2, CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
""")
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query(r"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r FROM documents),
low AS (SELECT doc_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d),
it AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
tf AS (SELECT r, doc_id, t, count(*) AS tf FROM low GROUP BY r, doc_id, t),
dl AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY r),
c AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM dl),
w AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY t, nd),
s AS (SELECT item_id, tf.r, tf.doc_id, CAST(sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (10 + (90 * dl.n * nd) // l)))) AS BIGINT) AS score
  FROM it JOIN tf ON tf.t = it.t JOIN w ON w.t = it.t JOIN dl ON dl.r = tf.r, c GROUP BY item_id, tf.r, tf.doc_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
""")
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10).select("item_id", "rank", "doc_id", "score")
