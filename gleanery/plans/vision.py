"""Queries of difference hashes, neighbours at any distance, and detection metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, detection, visual
from ..session import kept
from .common import BOXES, boxes, table


def _rasters(spark, sf_dir):
    """A raster of 64 values for each vector, of one of four shapes and eight orientations."""
    v, k = table(spark, sf_dir, "embeddings"), F.col("vec_id")
    width = F.element_at(F.array(*map(F.lit, (8, 16, 4, 32))), (k % 4 + 1).cast("int"))
    value = F.transform("embedding", lambda x: (F.floor(F.abs(x.cast("double")) * 1000) % 256).cast("int"))
    return v.select("vec_id", "label", width.alias("width"), (F.lit(64) / width).cast("int").alias("height"), (k % 8 + 1).cast("int").alias("orientation"), value.alias("pixels"))


def _hashed(spark, sf_dir):
    return visual.difference_hash(_rasters(spark, sf_dir), orientation="orientation")


def difference_hash(spark, sf_dir):
    return _hashed(spark, sf_dir).select("vec_id", "visual_hash")


def difference_hash_neighbours(spark, sf_dir):
    return dedup.near_duplicates(_hashed(spark, sf_dir), "words", 512, "label", "vec_id", most=150)


_RASTER = """px AS (SELECT vec_id AS id, label, w, 64 // w AS h, p % w AS x, p // w AS y, vec_id % 8 + 1 AS o, v FROM (SELECT vec_id, label, [8, 16, 4, 32][vec_id % 4 + 1] AS w, unnest(range(64)) AS p, unnest(list_transform(embedding, lambda e: floor(abs(e::DOUBLE) * 1000)::BIGINT % 256)) AS v FROM embeddings)),
up AS (SELECT id, v, CASE WHEN o >= 5 THEN h ELSE w END AS w, CASE WHEN o >= 5 THEN w ELSE h END AS h, CASE o WHEN 1 THEN x WHEN 2 THEN w - 1 - x WHEN 3 THEN w - 1 - x WHEN 4 THEN x WHEN 5 THEN y WHEN 6 THEN h - 1 - y WHEN 7 THEN h - 1 - y ELSE y END AS x,
 CASE o WHEN 1 THEN y WHEN 2 THEN y WHEN 3 THEN h - 1 - y WHEN 4 THEN h - 1 - y WHEN 5 THEN x WHEN 6 THEN x WHEN 7 THEN w - 1 - x ELSE w - 1 - x END AS y FROM px),
c AS (SELECT s, n, i, greatest(s / n::DOUBLE, 1e0) AS fs, (i + 0.5e0) * (s / n::DOUBLE) AS c FROM (SELECT DISTINCT w AS s FROM up UNION SELECT DISTINCT h FROM up), (VALUES (16), (17)) t(n), range(17) r(i) WHERE i < n),
j AS (SELECT *, unnest(range(greatest(trunc(c - 3 * fs + 0.5e0)::BIGINT, 0), least(trunc(c + 3 * fs + 0.5e0)::BIGINT, s))) AS j FROM c),
a AS (SELECT s, n, i, j, (j - c + 0.5e0) / fs AS d FROM j),
q AS (SELECT s, n, i, j, CASE WHEN d >= -3 AND d < 3 THEN CASE WHEN d = 0 THEN 1e0 ELSE sin(d * pi()) / (d * pi()) * (sin(d / 3 * pi()) / (d / 3 * pi())) END ELSE 0e0 END AS w FROM a),
k AS (SELECT s, n, i, j, CASE WHEN w < 0 THEN ceil(u - 0.5e0) ELSE floor(u + 0.5e0) END::BIGINT AS k FROM (SELECT *, w / sum(w) OVER (PARTITION BY s, n, i) * 4194304 AS u FROM q)),
t AS (SELECT id, h, n, i AS x, y, least(greatest((2097152 + sum(v * k)::BIGINT) >> 22, 0), 255) AS v FROM up JOIN k ON s = up.w AND j = x GROUP BY id, h, n, i, y),
g AS (SELECT id, t.n, x, i AS y, least(greatest((2097152 + sum(v * k)::BIGINT) >> 22, 0), 255) AS v FROM t JOIN k ON s = t.h AND j = y AND k.n = 33 - t.n GROUP BY id, t.n, x, i),
b AS (SELECT id, y * 16 + x AS p, v > lead(v) OVER (PARTITION BY id, y ORDER BY x) AS b FROM g WHERE n = 17 UNION ALL SELECT id, 256 + y * 16 + x, v > lead(v) OVER (PARTITION BY id, x ORDER BY y) FROM g WHERE n = 16),
z AS (SELECT id, p // 32 AS k, sum(CASE WHEN b THEN 1::BIGINT << (31 - p % 32) ELSE 0 END)::BIGINT AS w FROM b WHERE b IS NOT NULL GROUP BY 1, 2),
d AS MATERIALIZED (SELECT id, string_agg(format('{:08x}', w), '' ORDER BY k) AS hash, list(w ORDER BY k) AS w FROM z GROUP BY id)"""


def _hashes(spark, sf_dir, spread):
    """512 bits a document, of which the lowest doc_id % spread are turned round: copies differ by the difference of these."""
    digest = F.concat(F.sha2(F.col("text").cast("binary"), 256), F.sha2(F.concat("text", F.lit("#")).cast("binary"), 256))
    n = (F.col("doc_id") % spread).cast("int")
    flip = lambda i: F.pow(F.lit(2), F.least(F.greatest(n - i * 32, F.lit(0)), F.lit(32))).cast("long") - 1
    word = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substring(F.col("digest"), 8 * i + 1, 8), 16, 10).cast("long").bitwiseXOR(flip(i)))
    return table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "source", F.inline(F.array(F.struct(digest.alias("digest"))))).select("doc_id", "source", word.alias("words"))  # out of a generator, else the lambda would digest the text for each word


_NEAR = """SELECT abs(a.doc_id % {0} - b.doc_id % {0})::INTEGER AS hamming, a.source AS source_a, a.doc_id AS id_a, b.source AS source_b, b.doc_id AS id_b
 FROM documents a JOIN documents b ON a.text = b.text AND a.source < b.source WHERE abs(a.doc_id % {0} - b.doc_id % {0}) <= {1} QUALIFY row_number() OVER (PARTITION BY b.source, b.doc_id ORDER BY hamming, a.source, a.doc_id) <= 3"""


def neardup_40_bits(spark, sf_dir):
    return dedup.near_duplicates(_hashes(spark, sf_dir, 100), "words", 512, "source", "doc_id", most=40)


def neardup_90_bits(spark, sf_dir):
    return dedup.near_duplicates(_hashes(spark, sf_dir, 300), "words", 512, "source", "doc_id", most=90)


def neardup_sign_bits(spark, sf_dir):
    """Vectors by the signs of their components, within 20 of 64."""
    bit = lambda k: F.aggregate(F.slice("embedding", k * 32 + 1, 32), F.lit(0).cast("long"), lambda t, x: t * 2 + (x > 0).cast("long"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.array(bit(0), bit(1)).alias("words"))
    return dedup.near_duplicates(rows, "words", 64, "label", "vec_id", most=20)


def _detections(spark, sf_dir):
    """True boxes of line items; predictions that are moved or made smaller by what the line tells, some without a true box, scored by the part."""
    b = boxes(spark, sf_dir).withColumn("name", F.concat_ws("-", "line", "l_partkey", "l_suppkey")).withColumn("class", (F.col("l_suppkey") % 3).cast("int"))
    b = b.groupBy("image", "class", "name", "l_partkey").agg(*(F.min(c).alias(c) for c in ("cx", "cy", "w", "h")))  # a name stands once in an image
    b = kept(b, "boxes")  # both tables come from it
    k = F.col("l_partkey")
    box = lambda x, y, w, h: F.struct(x.alias("x1"), y.alias("y1"), (x + w).alias("x2"), (y + h).alias("y2"))
    cx, cy, w, h = (F.col(c) for c in ("cx", "cy", "w", "h"))
    truth = b.where(k % 11 != 0).select("image", "class", F.col("name").alias("truth"), box(cx, cy, w, h).alias("box"))
    found = b.where(k % 7 != 0).select("image", "class", F.col("name").alias("pred"), F.when(k % 97 != 0, (k * 7919 % 1000) / 1000.0).alias("score"), box(cx + w * ((k % 6) / 16.0), cy, w, h * ((k % 5 + 4) / 8.0)).alias("box"))
    return truth, found


def detection_matches(spark, sf_dir):
    m = detection.matches(*_detections(spark, sf_dir))
    return m.select("class", "image", "pred", "score", F.array_join("hits", "").alias("hits"))


def detection_precision(spark, sf_dir):
    return detection.average_precision(*_detections(spark, sf_dir)).withColumn("ap", F.round("ap", 6))


def detection_summary(spark, sf_dir):
    return detection.mean_average_precision(detection.average_precision(*_detections(spark, sf_dir)))


_MATCHES = f"""b AS (SELECT image, l_suppkey % 3 AS c, line || '-' || l_partkey || '-' || l_suppkey AS name, l_partkey AS k, min(cx) AS cx, min(cy) AS cy, min(w) AS w, min(h) AS h FROM ({BOXES}) GROUP BY ALL),
truth AS (SELECT image, c::INTEGER AS class, name, cx AS x1, cy AS y1, cx + w AS x2, cy + h AS y2 FROM b WHERE k % 11 <> 0),
found AS (SELECT image, c::INTEGER AS class, name AS pred, CASE WHEN k % 97 <> 0 THEN (k * 7919 % 1000) / 1000e0 END AS score, cx + w * (k % 6 / 16e0) AS x1, cy AS y1, cx + w * (k % 6 / 16e0) + w AS x2, cy + h * ((k % 5 + 4) / 8e0) AS y2 FROM b WHERE k % 7 <> 0),
o AS (SELECT f.image, f.class, f.pred, t.name, greatest(least(f.x2, t.x2) - greatest(f.x1, t.x1), 0e0) * greatest(least(f.y2, t.y2) - greatest(f.y1, t.y1), 0e0) AS i,
 greatest(f.x2 - f.x1, 0e0) * greatest(f.y2 - f.y1, 0e0) + greatest(t.x2 - t.x1, 0e0) * greatest(t.y2 - t.y1, 0e0) AS a FROM found f JOIN truth t ON t.image = f.image AND t.class = f.class WHERE f.score IS NOT NULL),
p AS (SELECT image, class, pred, list({{'i': i / (a - i), 't': name}} ORDER BY i / (a - i) DESC, name) AS offers FROM o WHERE a - i > 0 AND i / (a - i) * 100 >= 50 GROUP BY ALL),
n AS MATERIALIZED (SELECT p.*, row_number() OVER (PARTITION BY p.image, p.class ORDER BY score DESC, p.pred) AS no FROM p JOIN found f ON f.image = p.image AND f.class = p.class AND f.pred = p.pred),
m AS (SELECT image, class, T, 0::BIGINT AS no, ''::VARCHAR AS pred, false AS hit, []::VARCHAR[] AS used FROM (SELECT DISTINCT image, class FROM n), range(50, 100, 5) r(T)
 UNION ALL SELECT image, class, T, no, pred, free IS NOT NULL, CASE WHEN free IS NULL THEN used ELSE list_append(used, free) END FROM (SELECT m.image, m.class, m.T, n.no, n.pred, m.used, list_filter(n.offers, lambda o: o.i * 100 >= m.T AND NOT list_contains(m.used, o.t))[1].t AS free FROM m JOIN n ON n.image = m.image AND n.class = m.class AND n.no = m.no + 1)),
h AS MATERIALIZED (SELECT f.class, f.image, f.pred, f.score, r.T, coalesce(m.hit, false)::INTEGER AS hit FROM found f CROSS JOIN range(50, 100, 5) r(T) LEFT JOIN m ON m.image = f.image AND m.class = f.class AND m.pred = f.pred AND m.T = r.T WHERE f.score IS NOT NULL)"""
_PRECISION = f"""{_MATCHES},
s AS (SELECT class, T, sum(hit) OVER w AS tp, row_number() OVER w AS rank FROM h WINDOW w AS (PARTITION BY class, T ORDER BY score DESC, image, pred ROWS UNBOUNDED PRECEDING)),
nt AS (SELECT class, count(*) AS truths FROM truth GROUP BY 1), nf AS (SELECT class, count(*) AS predictions FROM found GROUP BY 1),
e AS (SELECT s.class, T, k, max(tp / rank) FILTER (WHERE floor(tp * 100 / truths) >= k) AS best, max(tp) AS tp FROM s JOIN nt ON nt.class = s.class, range(101) r(k) GROUP BY 1, 2, 3),
ap AS (SELECT class, T, sum(coalesce(best, 0)) / 101 AS ap, max(tp)::BIGINT AS matched FROM e GROUP BY 1, 2)"""

QUERIES = {
    difference_hash: f"WITH {_RASTER} SELECT id AS vec_id, hash AS visual_hash FROM d",
    difference_hash_neighbours: f"""WITH {_RASTER}, l AS (SELECT vec_id AS id, label, w FROM embeddings JOIN d ON id = vec_id)
SELECT hamming::INTEGER AS hamming, source_a, id_a, source_b, id_b FROM (SELECT list_sum(list_transform(list_zip(a.w, b.w), lambda z: bit_count(xor(z[1], z[2])))) AS hamming, a.label AS source_a, a.id AS id_a, b.label AS source_b, b.id AS id_b FROM l a JOIN l b ON a.label < b.label)
WHERE hamming <= 150 QUALIFY row_number() OVER (PARTITION BY id_b ORDER BY hamming, source_a, id_a) <= 3""",
    neardup_40_bits: _NEAR.format(100, 40),
    neardup_90_bits: _NEAR.format(300, 90),
    neardup_sign_bits: """WITH s AS (SELECT vec_id, label, list_reduce(list_transform(embedding, lambda x: (x > 0)::HUGEINT), lambda t, x: t * 2 + x) AS b FROM embeddings)
SELECT bit_count(xor(x.b, y.b))::INTEGER AS hamming, x.label AS source_a, x.vec_id AS id_a, y.label AS source_b, y.vec_id AS id_b FROM s x JOIN s y ON x.label < y.label
WHERE bit_count(xor(x.b, y.b)) <= 20 QUALIFY row_number() OVER (PARTITION BY y.vec_id ORDER BY hamming, x.label, x.vec_id) <= 3""",
    detection_matches: f"WITH RECURSIVE {_MATCHES} SELECT class, image, pred, score, string_agg(hit::VARCHAR, '' ORDER BY T) AS hits FROM h GROUP BY ALL",
    detection_precision: f"""WITH RECURSIVE {_PRECISION} SELECT nt.class, ap.T::INTEGER AS overlap, truths, predictions, coalesce(matched, 0) AS matched, round(ap, 6) AS ap FROM nt JOIN nf ON nf.class = nt.class JOIN ap ON ap.class = nt.class""",
    detection_summary: f"WITH RECURSIVE {_PRECISION} SELECT round(avg(ap) FILTER (WHERE T = 50), 4) AS map50, round(avg(ap), 4) AS map50_95 FROM ap",
}
