"""The registered queries of this subpackage: each operator over its whole table, with the columns that its contract names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, common, exact_dedup, ngram_join, packing, phrases, pii, quality, secrets, sharding, spelling, token_counts, topk, toxicity


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, _ = ngram_join.near_duplicates(common.table(common.prepare(spark), sf_dir, "documents"))
    return members.select("doc_id", "n_shingles", "component_id")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(common.table(common.prepare(spark), sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(common.table(common.prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_layers", "n_closed")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.prepare(spark), sf_dir, "documents")
    model = quality.fit(documents, common.table(spark, sf_dir, "labels"))
    return quality.score(documents, model).withColumn("held_out", quality.held_out(F.col("doc_id"))).select("doc_id", "held_out", "score", "predicted")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.table(common.prepare(spark), sf_dir, "documents")
    model = toxicity.fit(documents, common.table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).select("doc_id", "held_out", "score", "predicted")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(common.table(common.prepare(spark), sf_dir, "documents"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_and_decode(common.table(common.prepare(spark), sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(common.table(common.prepare(spark), sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.table(common.prepare(spark), sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(common.table(common.prepare(spark), sf_dir, "documents")).drop("begin")


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(common.table(common.prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans", "n_found")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(common.table(common.prepare(spark), sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(common.table(common.prepare(spark), sf_dir, "documents")).drop("k", "cut")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT p.a, p.b FROM p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.shared >= 80 * (na.n + nb.n - p.shared)),
r AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.a)
SELECT r.a AS doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
""",
    "op2_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_LOWER} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM d WINDOW same AS (PARTITION BY body)
""",
    "op8_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, (row_number() OVER by_score)::INTEGER AS rank, vec_id, score FROM s
WINDOW by_score AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER by_score <= 10
""",
    # CRC-32 by its table, made from the polynomial; two words are near if they are equal without one code point each at the same place, or the longer one without one
    "op12_spelling_variants": """
WITH RECURSIVE t AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
l AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM r WHERE length(run) >= 6 GROUP BY ALL),
x AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM l),
b AS (SELECT *, list_transform(range(len(x) // 2), lambda i: 16 * (instr('0123456789ABCDEF', x[2 * i + 1]) - 1) + instr('0123456789ABCDEF', x[2 * i + 2]) - 1) AS b FROM x),
h AS (SELECT run, n, xor(list_reduce(b, lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1]), 4294967295), 4294967295) AS h FROM b, t),
w AS (SELECT CASE WHEN h % 199 = 0 THEN run[:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n FROM h GROUP BY 1),
d AS MATERIALIZED (SELECT word, n FROM w WHERE length(word) >= 6 AND n >= 5),
c AS (SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM d)),
e AS (SELECT a.word, b.word AS near, b.n FROM c a JOIN c b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
 UNION SELECT c.word, d.word, d.n FROM c JOIN d ON c.rest = d.word UNION SELECT d.word, c.word, c.n FROM c JOIN d ON c.rest = d.word),
g AS (SELECT word, count(*) AS n_near, max(n) AS m FROM e GROUP BY word),
f AS MATERIALIZED (SELECT d.word, d.n, coalesce(g.n_near, 0) AS n_near, CASE WHEN g.m >= 5 * d.n THEN (SELECT min(near) FROM e WHERE e.word = d.word AND e.n = g.m) END AS form, CASE WHEN g.m >= 5 * d.n THEN g.m END AS form_n FROM d LEFT JOIN g ON g.word = d.word),
s AS (SELECT word, word AS root, form FROM f UNION ALL SELECT s.word, f.word, f.form FROM s JOIN f ON f.word = s.form)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n FROM f JOIN s ON s.word = f.word AND s.form IS NULL
""",
    "op13_phrase_collocations": f"""
WITH p AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS body FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, range(1, 5) t(k)),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, phrase, k, a, cut, array_to_string(w[:cut], ' ') AS x, array_to_string(w[cut + 1:], ' ') AS y FROM f, range(1, 4) t(cut) WHERE cut < k),
s AS (SELECT c.lang, c.phrase, c.k, c.a, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a // (x.a::HUGEINT + y.a))::BIGINT AS score FROM c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y
 QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 2000000::HUGEINT * c.a // (x.a::HUGEINT + y.a), cut) = 1),
i AS (SELECT f.lang, array_to_string(w[o:o + size - 1], ' ') AS phrase, max(a) AS a FROM f, range(1, 4) t(o), range(2, 4) u(size) WHERE size < k AND o + size - 1 <= k GROUP BY ALL)
SELECT s.lang, row_number() OVER best AS rank, s.phrase, s.a, l, r, n, score FROM s JOIN n ON n.lang = s.lang LEFT JOIN i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE i.a IS NULL OR 100 * i.a < 80 * s.a WINDOW best AS (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase) QUALIFY row_number() OVER best <= 2000
""",
}


def queries() -> dict:
    return {f.__name__: f for f in (op1_ngram_jaccard_join, op2_exact_dedup, op3_secret_scans, op4_quality_classifier, op5_toxicity, op6_token_counts, op7_bpe_codec, op8_exact_top_k, op9_best_fit_packing, op10_sharding, op11_personal_data, op12_spelling_variants, op13_phrase_collocations)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
