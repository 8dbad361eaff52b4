"""The thin queries over the operators of this package, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoquilt.llm import bpe, exact_dedup, filter_audit, hnsw, html_text, minhash, mixing, pii, quality, sharding, spelling, token_counts, toxicity
from geoquilt.llm.common import new_path, uniform_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_classifier_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the labels have two categories: unwanted text (quality 0) and toxic text
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("unwanted"), "toxic")
    found = toxicity.classify(table(spark, sf_dir, "documents"), labels, ["unwanted", "toxic"], keep=["doc_id"])
    return found.select("doc_id", "p_unwanted", "p_toxic", F.col("is_toxic").alias("toxic"))


def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.judge(docs, keep=["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("host_rate", 9).alias("host_rate"))


def op3_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents"), keep=["doc_id"])
    of = lambda kind: lambda k: k == kind
    as_text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    counts = [F.size(F.filter(F.col("spans.kind"), of(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))


def op6_block_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op7_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    found = bpe.encode(table(spark, sf_dir, "documents"), "text", path, ["doc_id"], decoded="decoded")
    ids = F.sha2(bpe.joined(F.col("ids")), 256).alias("ids_sha256")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids, F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_cached_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of this run's own, so every distinct text of the table is encoded
    docs, cache = table(spark, sf_dir, "documents"), new_path(spark, "token-cache")
    found = token_counts.count_tokens(docs, "text", public_tokenizers.path("byte_bpe_50k.json"), cache, ["doc_id"])
    return found.withColumn("over_limit", F.col("n_tokens") > 1024)


def op9_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    rows = sharding.assign(rows, "doc_id", [1.0] * 8)
    rows = sharding.assign(rows, "doc_id", [1.0] * 9, out="grown_shard")
    placed = sharding.number(rows, "shard", ["doc_id", "size", "text_crc32", "grown_shard"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_fast_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.cluster(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op11_term_matrix_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.groups(table(spark, sf_dir, "documents"), keep="largest")
    return found.withColumnRenamed("id", "doc_id")


def op13_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spelling.with_slips(spelling.letter_runs(table(spark, sf_dir, "documents"), "doc_id", "text", 7))
    return spelling.variants(spelling.count_words(rows))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # stands beside the package; the operators do without it

    return corpus_pipeline.run(spark, sf_dir)


OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x : x <> '') AS ws FROM d),
v AS (SELECT rid, unnest(ws) AS v, unnest(range(1, len(ws) + 1)) AS i FROM w),
p AS (SELECT rid, i, v || ' ' || lead(v) OVER o || ' ' || lead(v, 2) OVER o || ' ' || lead(v, 3) OVER o || ' ' || lead(v, 4) OVER o AS win FROM v WINDOW o AS (PARTITION BY rid ORDER BY i)),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM p WHERE win IS NOT NULL),
c AS (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS before FROM g WHERE n > 1),
r AS (SELECT rid, sum(least(5, coalesce(i - before, 5))) AS n_repeat_words FROM c GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x : regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT d.rid, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN r USING (rid)),
f AS (SELECT *, n_words < 10 AS f1, 100 * n_repeat_words > 20 * n_words AS f2, 10 * n_symbols > n_words AS f3, 10 * n_dup_lines > 3 * n_lines AS f4 FROM m),
u AS (SELECT source, rule, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (bad) AS DOUBLE) AS k
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS bad FROM f) GROUP BY source, rule),
s AS (SELECT rule, sum(k) / sum(n) AS mean, sum(k * k / n) / sum(n) - pow(sum(k) / sum(n), 2) - sum(k) / sum(n) * (1 - sum(k) / sum(n)) * count(*) / sum(n) AS spread FROM u GROUP BY rule),
b AS (SELECT rule, mean, CASE WHEN spread > 0 THEN least(1e6, greatest(1.0, mean * (1 - mean) / spread - 1)) ELSE 1e6 END AS strength FROM s),
e AS (SELECT source, mean, n + strength AS m, (k + mean * strength) / (n + strength) AS rate FROM u JOIN b USING (rule)),
h AS (SELECT source, max(rate) AS host_rate, bool_or(rate - 1.645 * sqrt(rate * (1 - rate) / (m + 1)) > least(0.5, greatest(0.2, 3 * mean))) AS host_failed FROM e GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2) AND NOT host_failed AS kept, round(host_rate, 9) AS host_rate
FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source
"""

OP4_SQL = f"""
WITH s AS (SELECT source, CAST(sum(coalesce(length(text), 0) + 1) AS DOUBLE) AS mass FROM documents GROUP BY source),
r AS (SELECT source, pow(mass, 0.7) / (SELECT sum(pow(mass, 0.7)) FROM s) * (SELECT sum(mass) FROM s) / mass AS rate FROM s),
q AS (SELECT source, CAST(greatest(1, ceil(rate / 32.0)) AS INT) AS parts, rate / greatest(1, ceil(rate / 32.0)) AS mean FROM r),
c AS (SELECT source, parts, list(cum ORDER BY k) AS cums FROM (
  SELECT source, parts, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cum FROM q, range(0, 120) AS x(k)) GROUP BY source, parts),
n AS (SELECT d.*, CAST(list_sum(list_transform(range(1, parts + 1), lambda p : len(list_filter(cums, lambda x : x <= {uniform_sql("doc_id", "p", "17")})))) AS INT) AS n_copies
  FROM documents d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy, md5(concat_ws(':', '17', coalesce(CAST(doc_id AS VARCHAR), 'null'), copy, coalesce(md5(text), 'null'))) AS shuffle_key
FROM (SELECT *, CAST(unnest(range(1, n_copies + 1)) AS INT) AS copy FROM n)
"""


OP9_SQL = f"""
WITH k AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(0, 8)), lambda c, k : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(0, 256) r(i))),
d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
h AS (SELECT doc_id, CAST(strlen(x) + 1 AS BIGINT) AS size, list_transform(string_split(regexp_replace(hex(encode(x)), '(..)', '\\1 ', 'g'), ' ')[:strlen(x)], lambda b : CAST('0x' || b AS BIGINT)) AS bytes,
  list_max(list_transform(range(0, 8), lambda j : {{'score': -1.0 / ln({uniform_sql("doc_id", "j", "0")}), 'least': -j}})).least AS a, list_max(list_transform(range(0, 9), lambda j : {{'score': -1.0 / ln({uniform_sql("doc_id", "j", "0")}), 'least': -j}})).least AS b FROM d),
c AS (SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32, CAST(-a AS INT) AS shard, CAST(-b AS INT) AS grown_shard FROM h, k),
m AS (SELECT *, md5('{{' || coalesce('"doc_id":' || doc_id || ',', '') || '"size":' || size || ',"text_crc32":' || text_crc32 || ',"grown_shard":' || grown_shard || '}}') AS digest FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY digest, doc_id, size, text_crc32) - 1 AS slot, grown_shard FROM m
"""

OP10_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x : x <> '') AS ws FROM documents),
v AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS v, unnest(range(1, len(ws) + 1)) AS i FROM d),
w AS (SELECT doc_id, n, i, v || ' ' || lead(v) OVER o || ' ' || lead(v, 2) OVER o AS s FROM v WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS MATERIALIZED (SELECT DISTINCT doc_id, s FROM w WHERE s IS NOT NULL UNION SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 2),
z AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p JOIN z x ON a = x.doc_id JOIN z y ON b = y.doc_id WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(z.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id, d.doc_id <= coalesce(m.b, d.doc_id) AS kept
FROM d LEFT JOIN z USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON d.doc_id = m.a
"""

OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
f AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x : x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
s AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
  || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
  || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > least THEN 'E' ELSE '' END AS fails FROM f LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM s GROUP BY 1, 2),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
p AS (SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before FROM o, range(1, 6) r(step)),
q AS (SELECT c.*, p.*, contains(fails, f) AS bad, translate(fails, before, '') <> fails AS gone FROM c, p),
r AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT bad AND NOT gone THEN n ELSE 0 END) AS kept, sum(CASE WHEN bad AND NOT gone THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN bad AND gone THEN n ELSE 0 END) AS redundant, sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN bad AND NOT gone THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN bad AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM q GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r
"""

OP12_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256 FROM d WINDOW w AS (PARTITION BY t)
"""

# words one edit apart share what a letter left out makes of them: at one place, or of the longer one alone
OP13_SQL = r"""
WITH RECURSIVE k AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(0, 8)), lambda c, k : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(0, 256) r(i))),
g AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
u AS (SELECT doc_id, w, count(*) AS m, coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || w AS b FROM g WHERE length(w) >= 7 GROUP BY 1, 2),
y AS (SELECT w, m, list_transform(string_split(regexp_replace(hex(encode(b)), '(..)', '\1 ', 'g'), ' ')[:strlen(b)], lambda x : CAST('0x' || x AS BIGINT)) AS bytes FROM u),
h AS (SELECT w, m, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b : xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM y, k),
c AS MATERIALIZED (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, CAST(sum(m) AS BIGINT) AS n FROM h GROUP BY 1 HAVING sum(m) >= 2),
v AS MATERIALIZED (SELECT word, n FROM c WHERE length(word) >= 7),
z AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT a.word AS a, b.word AS b FROM z a JOIN z b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word UNION SELECT z.word, v.word FROM z JOIN v ON z.cut = v.word UNION SELECT v.word, z.word FROM z JOIN v ON z.cut = v.word),
j AS (SELECT a, b, v.n, row_number() OVER (PARTITION BY a ORDER BY v.n DESC, b) AS r, count(*) OVER (PARTITION BY a) AS n_near FROM e JOIN v ON v.word = b),
f AS MATERIALIZED (SELECT word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN j.n >= 10 * v.n THEN b END AS form, CASE WHEN j.n >= 10 * v.n THEN j.n END AS form_n FROM v LEFT JOIN j ON a = word AND r = 1),
s(word, last, form) AS (SELECT word, word, form FROM f UNION ALL SELECT s.word, f.word, f.form FROM s JOIN f ON f.word = s.form)
SELECT f.word, f.form, s.last AS root, f.n, f.n_near, f.form_n FROM f JOIN s ON s.word = f.word AND s.form IS NULL
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_classifier_chain": op1_classifier_chain,
        "op2_host_quality": op2_host_quality,
        "op3_hnsw": op3_hnsw,
        "op4_poisson_mix": op4_poisson_mix,
        "op5_disclosure": op5_disclosure,
        "op6_block_tree": op6_block_tree,
        "op7_pair_index_bpe": op7_pair_index_bpe,
        "op8_cached_counts": op8_cached_counts,
        "op9_rendezvous": op9_rendezvous,
        "op10_fast_sketch_dedup": op10_fast_sketch_dedup,
        "op11_term_matrix_audit": op11_term_matrix_audit,
        "op12_content_sort": op12_content_sort,
        "op13_gram_variants": op13_gram_variants,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_host_quality": OP2_SQL,
        "op4_poisson_mix": OP4_SQL,
        "op9_rendezvous": OP9_SQL,
        "op10_fast_sketch_dedup": OP10_SQL,
        "op11_term_matrix_audit": OP11_SQL,
        "op12_content_sort": OP12_SQL,
        "op13_gram_variants": OP13_SQL,
    }
