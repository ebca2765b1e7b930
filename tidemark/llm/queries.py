"""The registered queries of this subpackage: each reads its whole table and returns the operator's full result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import anchor_dedup, common, fm_phrases, hnsw_search, langid, lloyd_codes, mincut_html, minmax_dedup, mixing, pca_dedup, pii_disclosure, piece_transducer, secrets_battery, toxicity_crf


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut_html.extract(_table(spark, sf_dir, "pages"))


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_transducer.encode(docs).select("doc_id", "n_tokens", "round_trip", "ids")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_crf.train(docs.where(_remainder(4) != 2), _table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    out = toxicity_crf.score(docs, model)
    return out.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_disclosure.find(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hnsw_search.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pca_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), least=0.95)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets_battery.scan(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(_remainder(5) != 0))
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of 2 to 3 words that occur 10 times or more."""
    return fm_phrases.collocations(_table(spark, sf_dir, "documents"), max_words=3, least=10, share=50, top=2000)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 35 words or more that start elsewhere too."""
    out = anchor_dedup.remove_repeats(_table(spark, sf_dir, "documents"), least=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of 16 parts of 64 entries after two rounds, with their errors and the digest of the codebooks."""
    codes = lloyd_codes.encode(_table(spark, sf_dir, "embeddings"))
    out = lloyd_codes.label_errors(codes)
    return out.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(codes.sha256()).alias("codebooks_sha256"))


QUERIES = {"op11_collocations": op11_collocations, "op12_substring_dedup": op12_substring_dedup, "op13_vector_codes": op13_vector_codes, "op1_html_extraction": op1_html_extraction, "op7_nearest": op7_nearest, "op8_embedding_dedup": op8_embedding_dedup, "op2_minhash_dedup": op2_minhash_dedup, "op3_sentencepiece": op3_sentencepiece, "op4_toxicity": op4_toxicity, "op5_pii": op5_pii, "op6_source_mixing": op6_source_mixing, "op9_secret_scan": op9_secret_scan, "op10_language_id": op10_language_id}

SHINGLES_SQL = r"""
words AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words)"""


def _lloyd_round(i: int) -> str:
    """Assignment with the codebooks of round i, and the codebooks after it."""
    return f"""
a{i} AS MATERIALIZED (SELECT rid, x.p, min(list_sum(list_transform(range(1, len(x.y) + 1), lambda i: (x.y[i] - b.y[i]) * (x.y[i] - b.y[i]))) * 64 + b.e) AS best FROM x JOIN b{i} b ON x.p = b.p GROUP BY rid, x.p),
m{i} AS MATERIALIZED (SELECT p, e, i, CAST(floor(sum(c) / count(*)) AS BIGINT) AS c FROM (SELECT x.p, CAST(best % 64 AS BIGINT) AS e, unnest(x.y) AS c, unnest(range(1, len(x.y) + 1)) AS i FROM a{i} a JOIN x ON a.rid = x.rid AND a.p = x.p) GROUP BY p, e, i),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(n.y, b.y) AS y FROM b{i} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS y FROM m{i} GROUP BY p, e) n ON n.p = b.p AND n.e = b.e)"""


SQL = {
    "op11_collocations": r"""
WITH pieces AS (SELECT row_number() OVER () AS p, lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
w AS MATERIALIZED (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3]) AS k)) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (SELECT c.lang, c.phrase, c.a, i, array_to_string(w[1:i], ' ') AS h, array_to_string(w[i + 1:], ' ') AS t FROM c, (SELECT unnest([1, 2]) AS i) WHERE i < k),
s AS (SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, i, CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = h JOIN f y ON y.lang = cut.lang AND y.phrase = t),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
outer_ AS (SELECT lang, array_to_string(w[j:j + 1], ' ') AS phrase, max(a) AS o FROM c, (SELECT unnest([1, 2]) AS j) WHERE k = 3 GROUP BY ALL),
left_ AS (SELECT best.* FROM best LEFT JOIN outer_ USING (lang, phrase) WHERE o IS NULL OR 100 * o < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_) JOIN n USING (lang) WHERE rank <= 2000""",
    "op12_substring_dedup": r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS MATERIALIZED (SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
again AS (SELECT r, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
gone AS MATERIALIZED (SELECT r, list(DISTINCT i + j) AS g FROM again, (SELECT unnest(range(35)) AS j) GROUP BY r),
word AS MATERIALIZED (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
drop_ AS (SELECT r, unnest(g) AS i FROM gone),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN drop_ USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)""",
    "op13_vector_codes": f"""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS rid, vec_id, label, list_transform(x, lambda c: CAST(floor(c * 256) AS BIGINT)) AS q FROM v
      WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0),
x AS MATERIALIZED (SELECT rid, p, q[p * (len(q) // 16) + 1:(p + 1) * (len(q) // 16)] AS y FROM k, (SELECT unnest(range(16)) AS p)),
b0 AS MATERIALIZED (SELECT p, rid AS e, y FROM x WHERE rid < 64),{_lloyd_round(0)},{_lloyd_round(1)},{_lloyd_round(2)},
r AS MATERIALIZED (SELECT rid, string_agg(format('{{:02x}}', CAST(best % 64 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM a2 GROUP BY rid),
books AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM k JOIN r USING (rid), books""",
    "op2_minhash_dedup": f"""
WITH RECURSIVE {SHINGLES_SQL},
flat AS (SELECT doc_id, unnest(s) AS h FROM sets),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM flat a JOIN flat b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS component_id,
       s.doc_id = least(s.doc_id, coalesce(min(r.b), s.doc_id)) AS kept
FROM sets s LEFT JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id, s.s""",
    "op6_source_mixing": r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s0),
s2 AS (SELECT *, [5, 2, 1][(rn - 1) % 3 + 1] AS w, ss * 3 / [5, 2, 1][(rn - 1) % 3 + 1] AS ratio FROM s1),
s3 AS (SELECT *, ((SELECT sum(ss) FROM s0) - coalesce(sum(ss) OVER (ORDER BY ratio, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 3) / sum(w) OVER (ORDER BY ratio, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM s2),
s4 AS (SELECT *, CASE WHEN ratio <= lvl THEN CAST(ss * 3 AS DOUBLE) ELSE w * (SELECT max(lvl) FROM s3 WHERE ratio > lvl) END AS target FROM s3),
seats AS (SELECT CAST(floor(sum(ss) / 16 + 0.5) AS BIGINT) AS m FROM s0),
nom AS (SELECT rn, target / (2 * k + 1) AS q, k FROM (SELECT rn, target, unnest(range(0, CAST(floor(target / 16) AS BIGINT) + 40)) AS k FROM s4 WHERE target > 0)),
quota AS (SELECT rn, count(*) AS a FROM (SELECT rn FROM nom ORDER BY q DESC, rn, k LIMIT (SELECT m FROM seats)) GROUP BY rn),
p AS (SELECT d.*, s4.rn, s4.ss, s4.target, coalesce(a, 0) AS a, CAST('0x' || substr(o, 1, 8) AS BIGINT) % greatest(1, CAST(ceil(s4.ss / 65536) AS BIGINT)) AS shard FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source LEFT JOIN quota ON quota.rn = s4.rn),
h0 AS (SELECT rn, shard, a, CAST(sum(size) AS BIGINT) AS hs FROM p GROUP BY ALL),
hn AS (SELECT rn, shard, a, hs / (2 * k + 1) AS q, k FROM (SELECT *, unnest(range(0, CAST(floor(hs / 16) AS BIGINT) * 3 + 40)) AS k FROM h0 WHERE hs > 0)),
hq AS (SELECT rn, shard, count(*) AS q FROM (SELECT *, row_number() OVER (PARTITION BY rn ORDER BY q DESC, shard, k) AS place FROM hn) WHERE place <= a GROUP BY rn, shard),
h AS (SELECT h0.rn, h0.shard, CAST(ceil(hs / 16) AS BIGINT) AS n, least(coalesce(q, 0), 3 * CAST(ceil(hs / 16) AS BIGINT)) AS q FROM h0 LEFT JOIN hq ON h0.rn = hq.rn AND h0.shard = hq.shard WHERE hs > 0),
g AS (SELECT rn, shard, n, q // n AS full_, q % n AS rest, CAST('0x' || substr(md5('mix-1:block:' || rn || ':' || shard), 1, 8) AS BIGINT) % n AS f FROM h),
x AS (SELECT p.*, sum(size) OVER (PARTITION BY rn, shard ORDER BY o, size ROWS UNBOUNDED PRECEDING) AS z FROM p)
SELECT doc_id, size, ss AS source_size, target,
  CAST(coalesce(full_ * size + greatest(0, least(z, least(f + rest, n) * 16) - greatest(z - size, f * 16)) + greatest(0, least(z, (f + rest - n) * 16) - (z - size)), 0) AS BIGINT) AS taken
FROM x LEFT JOIN g ON x.rn = g.rn AND x.shard = g.shard""",
    "op8_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
g AS (SELECT vec_id, x FROM v WHERE x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR isnan(c) OR isinf(c))) = 0 AND list_sum(list_transform(x, lambda c: abs(c))) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a), m AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN m ON m.a = vec_id""",
}
