"""Queries of box geometry, filters and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.rounding import _SPLIT, _halves
from ..operators import package, quality
from .common import BOX_IDS, BOXES, boxes, table

_ARGS = ("cx", "cy", "w", "h", "width", "height")
_IDS = ", ".join(BOX_IDS)
_PIXELS = f"SELECT *, (cx - w / 2) * width AS px, (cy - h / 2) * height AS py, w * width AS pw, h * height AS ph FROM ({BOXES})"
_CLAMPED = "SELECT *, least(greatest({0}, 0e0), {2}) AS l, least(greatest({0} + {1}, 0e0), {2}) AS r, least(greatest({3}, 0e0), {5}) AS t, least(greatest({3} + {4}, 0e0), {5}) AS b FROM ({6})"


def _c(*names):
    return [F.col(n) for n in names]


def _pixels(spark, sf_dir):
    b = boxes(spark, sf_dir)
    return b.select("*", ((F.col("cx") - F.col("w") / 2) * F.col("width")).alias("px"), ((F.col("cy") - F.col("h") / 2) * F.col("height")).alias("py"), (F.col("w") * F.col("width")).alias("pw"), (F.col("h") * F.col("height")).alias("ph"))


def clip_boxes_norm(spark, sf_dir):
    return boxes(spark, sf_dir).withColumn("o", G.clip_normalised(*_c(*_ARGS))).where("o is not null").select(*BOX_IDS, "o.*")


def clip_boxes_pixel(spark, sf_dir):
    return _pixels(spark, sf_dir).withColumn("o", G.clip_pixels(*_c("px", "py", "pw", "ph", "width", "height"))).where("o is not null").select(*BOX_IDS, "o.*")


def clip_boxes_percent(spark, sf_dir):
    scaled = boxes(spark, sf_dir).select(*BOX_IDS, *((F.col(c) * 100).alias(c) for c in ("cx", "cy", "w", "h")))
    return scaled.withColumn("o", G.clip_percent(F.col("cx") - 50, F.col("cy") - 50, F.col("w"), F.col("h"))).where("o is not null").select(*BOX_IDS, "o.*")


def clip_boxes_strict(spark, sf_dir):
    return _pixels(spark, sf_dir).withColumn("o", G.clip_strict(*_c("px", "py", "pw", "ph", "width", "height"))).select(*BOX_IDS, "o.*")


def box_topleft_to_yolo(spark, sf_dir):
    unit = F.when(F.col("l_returnflag") == "A", "px").when(F.col("l_returnflag") == "N", "pct")
    return boxes(spark, sf_dir).withColumn("o", G.top_left_to_centre(F.col("cx"), F.col("cy"), F.col("w"), F.col("h"), unit, F.col("width"), F.col("height"))).where("o is not null").select(*BOX_IDS, "o.*")


def corners_to_yolo(spark, sf_dir):
    p = _pixels(spark, sf_dir)
    return p.withColumn("o", G.corners_to_centre(F.col("px"), F.col("py"), F.col("px") + F.col("pw"), F.col("py") + F.col("ph"), F.col("width"), F.col("height"))).select(*BOX_IDS, "o.*")


def yolo_to_corners(spark, sf_dir):
    return boxes(spark, sf_dir).withColumn("o", G.centre_to_corners(*_c(*_ARGS))).select(*BOX_IDS, "o.*")


def coco_boxes(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumn("split", F.when(F.col("image") % 10 == 0, "test").when(F.col("image") % 10 == 1, "val").otherwise("train"))
    ids = package.coco_ids(b, "split", "image", ["line", "l_partkey", "l_suppkey", "cx", "cy", "w"])
    return ids.withColumn("o", G.centre_to_coco(*_c(*_ARGS))).select("split", "image_id", "annotation_id", "image", "line", "o.*")


def filter_undersized(spark, sf_dir):
    by = boxes(spark, sf_dir).groupBy("image").agg(F.collect_list(F.struct("w", "h")).alias("b"), F.first("width").alias("width"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image")).join(by, "image", "left")
    b = F.coalesce("b", F.array().cast("array<struct<w:double,h:double>>"))
    v = quality.box_verdict(b, F.coalesce("width", F.lit(640.0)), F.lit(480.0), 16.0)
    return rows.select("image", F.size(b).cast("long").alias("n_boxes"), v.alias("v")).select("image", "n_boxes", "v.verdict", F.col("v.small").cast("long").alias("small"))


_VERDICT = f"""WITH b AS (SELECT image, count(*) AS n, count(*) FILTER (WHERE w * width < 16 OR h * height < 16) AS s FROM ({BOXES}) GROUP BY image)
SELECT o_orderkey AS image, coalesce(n, 0) AS n_boxes, CASE WHEN n IS NULL THEN 'no_boxes' WHEN s > 0 THEN 'undersized' ELSE 'kept' END AS verdict, coalesce(s, 0) AS small
FROM orders LEFT JOIN b ON image = o_orderkey"""


def candidate_audit(spark, sf_dir):
    rows = filter_undersized(spark, sf_dir).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image"), F.col("o_orderpriority").alias("source")), "image")
    key = F.concat("source", F.lit(":"), "verdict")
    return quality.audit(
        rows, ("candidates", F.col("source"), F.lit(1)), ("accepted", F.when(F.col("verdict") == "kept", F.col("source")), F.lit(1)),
        ("skipped", F.when(F.col("verdict") != "kept", key), F.lit(1)), ("removed_objects", F.when(F.col("verdict") == "undersized", key), F.col("small")),
    )


def validate_boxes(spark, sf_dir):
    b = boxes(spark, sf_dir)
    w = F.when((F.col("line") == 4) & (F.col("image") % 97 == 0), F.lit(float("nan"))).otherwise(F.col("w"))
    errors = quality.box_errors((F.col("line") / 2).cast("double"), F.col("cx"), F.col("cy"), w, F.col("h"), [0, 1, 2, 3])
    return b.select(*BOX_IDS, F.explode(errors).alias("rule"))


_VALID = f"""WITH b AS (SELECT image, line, l_partkey, l_suppkey, line / CAST(2 AS DOUBLE) AS c, cx, cy, h, CASE WHEN line = 4 AND image % 97 = 0 THEN 'nan'::DOUBLE ELSE w END AS w FROM ({BOXES})),
f AS (SELECT *, NOT isnan(w) AS fin FROM b),
r AS (SELECT {_IDS}, unnest([CASE WHEN c <> floor(c) OR c NOT IN (0, 1, 2, 3) THEN 'class' END, CASE WHEN NOT fin THEN 'not_finite' END,
 CASE WHEN fin AND (cx < 0 OR cx > 1 OR cy < 0 OR cy > 1) THEN 'centre_outside' END, CASE WHEN fin AND (w <= 0 OR w > 1 OR h <= 0 OR h > 1) THEN 'size_outside' END,
 CASE WHEN fin AND (cx - w / 2 < -1e-6 OR cy - h / 2 < -1e-6 OR cx + w / 2 > 1 + 1e-6 OR cy + h / 2 > 1 + 1e-6) THEN 'crosses_boundary' END]) AS rule FROM f)
SELECT * FROM r WHERE rule IS NOT NULL"""


def parse_labels(spark, sf_dir):
    text = F.concat_ws("\n", F.concat_ws(" ", (F.col("l_linenumber") % 3).cast("string"), *(F.concat(F.lit("0."), F.lpad((F.col("l_partkey") % m).cast("string"), 3, "0")) for m in (997, 991, 983)), F.when(F.col("l_suppkey") % 7 == 0, "x1").when(F.col("l_suppkey") % 11 == 0, F.lit(None)).otherwise("0.5")), F.when(F.col("l_linenumber") == 1, F.lit("  ")), F.lit("2 .5 0.5 1e-1 +0.25"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image"), "l_partkey", "l_suppkey", text.alias("text"))
    out = quality.parse_label_lines(rows, "text", [0, 1])
    return out.select("image", "l_partkey", "l_suppkey", F.col("line").cast("long").alias("line"), F.col("fields").cast("long").alias("fields"), "class_id", "cx", "cy", "w", "h", "status")


_NUM = lambda i: f"CASE WHEN regexp_full_match(f[{i}], '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN try_cast(f[{i}] AS DOUBLE) END"
_PARSED = f"""WITH t AS (SELECT l_orderkey AS image, l_partkey, l_suppkey, l_linenumber % 3 || concat(' 0.', lpad((l_partkey % 997)::VARCHAR, 3, '0'), ' 0.', lpad((l_partkey % 991)::VARCHAR, 3, '0'), ' 0.', lpad((l_partkey % 983)::VARCHAR, 3, '0'),
  CASE WHEN l_suppkey % 7 = 0 THEN ' x1' WHEN l_suppkey % 11 = 0 THEN '' ELSE ' 0.5' END) || CASE WHEN l_linenumber = 1 THEN chr(10) || '  ' ELSE '' END || chr(10) || '2 .5 0.5 1e-1 +0.25' AS text FROM lineitem),
l AS (SELECT image, l_partkey, l_suppkey, unnest(string_split(text, chr(10))) AS raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line FROM t),
f AS (SELECT image, l_partkey, l_suppkey, line, string_split(trim(regexp_replace(raw, '\\s+', ' ', 'g')), ' ') AS f FROM l WHERE trim(raw) <> ''),
v AS (SELECT image, l_partkey, l_suppkey, line, len(f) AS fields, {_NUM(1)} AS c, {_NUM(2)} AS cx, {_NUM(3)} AS cy, {_NUM(4)} AS w, {_NUM(5)} AS h FROM f),
s AS (SELECT *, fields = 5 AND c IS NOT NULL AND cx IS NOT NULL AND cy IS NOT NULL AND w IS NOT NULL AND h IS NOT NULL AS sound FROM v)
SELECT image, l_partkey, l_suppkey, line, fields, CASE WHEN sound THEN trunc(c)::INTEGER END AS class_id, cx, cy, w, h, CASE WHEN NOT sound THEN 'malformed' WHEN trunc(c) NOT IN (0, 1) THEN 'other_class' ELSE 'box' END AS status FROM s"""


def validate_pairs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("doc_id % 9 != 0").select("doc_id")
    images = docs.union(docs.where("doc_id % 50 = 1"))
    return quality.validate_pairs(images, table(spark, sf_dir, "labels"), "doc_id")


_PAIRS = """WITH d AS (SELECT doc_id FROM documents WHERE doc_id % 9 <> 0), i AS (SELECT doc_id, count(*) AS n FROM (SELECT * FROM d UNION ALL SELECT * FROM d WHERE doc_id % 50 = 1) GROUP BY 1),
l AS (SELECT DISTINCT doc_id FROM labels)
SELECT l.doc_id, 'orphan_label' AS rule FROM l ANTI JOIN i USING (doc_id) UNION ALL SELECT i.doc_id, 'missing_label' FROM i ANTI JOIN l USING (doc_id) UNION ALL SELECT doc_id, 'duplicate_image' FROM i WHERE n > 1"""


def csv_reconcile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.when(F.col("n_chars") > 1000, 1).when(F.col("n_chars") > 500, 0).alias("flag"))
    return quality.disagreements(docs, table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("flag")), "doc_id", "flag", F.col("lang"))


def _round(x: str, digits: int) -> str:
    """SQL of rounded(): the product and its error by halves of doubles."""
    scale = 10.0**digits
    high, low = _halves(scale)
    d = lambda v: f"{v!r}::DOUBLE"
    split = f"{{'v': zv, 'h': zv * {d(_SPLIT)} - (zv * {d(_SPLIT)} - zv), 'p': zv * {d(scale)}}}"
    error = f"{{'n': round_even(zs.p, 0), 'e': ((zs.h * {d(high)} - zs.p) + zs.h * {d(low)} + (zs.v - zs.h) * {d(high)}) + (zs.v - zs.h) * {d(low)}}}"
    whole = f"CASE WHEN zs.p - zt.n = 0.5 AND zt.e > 0 THEN zt.n + 1 WHEN zs.p - zt.n = -0.5 AND zt.e < 0 THEN zt.n - 1 ELSE zt.n END / {d(scale)}"
    return f"list_transform([{x}], lambda zv: list_transform([{split}], lambda zs: list_transform([{error}], lambda zt: {whole})[1])[1])[1]"


QUERIES = {
    clip_boxes_norm: f"""WITH c AS (SELECT *, cx - w / 2 AS l0, cx + w / 2 AS r0, cy - h / 2 AS t0, cy + h / 2 AS b0 FROM ({BOXES})),
d AS (SELECT *, least(greatest(l0, 0e0), 1e0) AS l, least(greatest(r0, 0e0), 1e0) AS r, least(greatest(t0, 0e0), 1e0) AS t, least(greatest(b0, 0e0), 1e0) AS b FROM c)
SELECT {_IDS}, (l + r) / 2 AS cx, (t + b) / 2 AS cy, r - l AS w, b - t AS h, abs(l - l0) > 1e-9 OR abs(r - r0) > 1e-9 OR abs(t - t0) > 1e-9 OR abs(b - b0) > 1e-9 AS repaired
FROM d WHERE (r - l) * width >= 1 AND (b - t) * height >= 1""",
    clip_boxes_pixel: f"SELECT {_IDS}, {_round('(l + r) / 2 / width', 6)} AS cx, {_round('(t + b) / 2 / height', 6)} AS cy, {_round('(r - l) / width', 6)} AS w, {_round('(b - t) / height', 6)} AS h FROM ({_CLAMPED.format('px', 'pw', 'width', 'py', 'ph', 'height', _PIXELS)}) WHERE r - l > 1 AND b - t > 1",
    clip_boxes_percent: f"SELECT {_IDS}, l AS x, t AS y, r - l AS w, b - t AS h FROM (SELECT {_IDS}, least(greatest(cx * 100 - 50, 0e0), 100e0) AS l, least(greatest(cx * 100 - 50 + w * 100, 0e0), 100e0) AS r, least(greatest(cy * 100 - 50, 0e0), 100e0) AS t, least(greatest(cy * 100 - 50 + h * 100, 0e0), 100e0) AS b FROM ({BOXES})) WHERE r > l AND b > t",
    clip_boxes_strict: f"SELECT {_IDS}, l AS x, t AS y, r - l AS w, b - t AS h, l <> px OR t <> py OR r - l <> pw OR b - t <> ph AS changed, CASE WHEN r <= l OR b <= t THEN 'empty' END AS error FROM ({_CLAMPED.format('px', 'pw', 'width', 'py', 'ph', 'height', _PIXELS)})",
    box_topleft_to_yolo: f"SELECT {_IDS}, (cx + w / 2) / sx AS cx, (cy + h / 2) / sy AS cy, w / sx AS w, h / sy AS h FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN width ELSE 100e0 END AS sx, CASE l_returnflag WHEN 'A' THEN height ELSE 100e0 END AS sy FROM ({BOXES}) WHERE l_returnflag IN ('A', 'N'))",
    corners_to_yolo: f"SELECT {_IDS}, (px + (px + pw)) / 2 / width AS cx, (py + (py + ph)) / 2 / height AS cy, (px + pw - px) / width AS w, (py + ph - py) / height AS h FROM ({_PIXELS})",
    yolo_to_corners: f"SELECT {_IDS}, (cx - w / 2) * width AS x1, (cy - h / 2) * height AS y1, (cx + w / 2) * width AS x2, (cy + h / 2) * height AS y2 FROM ({BOXES})",
    coco_boxes: f"""WITH s AS (SELECT *, CASE image % 10 WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END AS split FROM ({BOXES}))
SELECT split, dense_rank() OVER (PARTITION BY split ORDER BY image)::INTEGER AS image_id, row_number() OVER (PARTITION BY split ORDER BY image, line, l_partkey, l_suppkey, cx, cy, w) AS annotation_id, image, line,
 {_round('(cx - w / 2) * width', 3)} AS x, {_round('(cy - h / 2) * height', 3)} AS y, {_round('w * width', 3)} AS w, {_round('h * height', 3)} AS h, {_round('w * width * (h * height)', 3)} AS area FROM s""",
    filter_undersized: _VERDICT,
    candidate_audit: f"""WITH v AS (SELECT v.*, o_orderpriority AS source FROM ({_VERDICT}) v JOIN orders ON o_orderkey = image)
SELECT 'candidates' AS metric, source AS key, count(*) AS n FROM v GROUP BY 2 UNION ALL SELECT 'accepted', source, count(*) FROM v WHERE verdict = 'kept' GROUP BY 2
UNION ALL SELECT 'skipped', source || ':' || verdict, count(*) FROM v WHERE verdict <> 'kept' GROUP BY 2 UNION ALL SELECT 'removed_objects', source || ':' || verdict, sum(small)::BIGINT FROM v WHERE verdict = 'undersized' GROUP BY 2""",
    validate_boxes: _VALID,
    parse_labels: _PARSED,
    validate_pairs: _PAIRS,
    csv_reconcile: "SELECT lang AS grp, count(*) AS n_rows, count(*) FILTER (WHERE CASE WHEN n_chars > 1000 THEN 1 WHEN n_chars > 500 THEN 0 END IS DISTINCT FROM quality) AS changed FROM documents JOIN labels USING (doc_id) GROUP BY lang",
}
