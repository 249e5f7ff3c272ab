"""Queries of data set scans, annotation formats, reports and names, over files that the tables stand in for."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import dedup, ledger, quality, report
from ..session import scratch_root
from ..sources import annotations, files, images, scans, sinks, tar
from .common import table

_S = lambda c: F.col(c).cast("string")
_PARTS = ["path", "group", "source_split", "label_path", "status"]


def _pick(n, *values):
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _labels(rows, path, keep):
    return rows.where(keep).select(path.alias("path"), F.lit("0 0.5 0.5 0.1 0.1").alias("text"))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("o"))


def scan_flat_yolo(spark, sf_dir):
    o = _orders(spark, sf_dir)
    stem = F.concat(F.lit("k3/"), F.when(F.col("o") % 3 == 0, F.concat(F.lit("Video"), (F.col("o") % 50).cast("string"), F.lit("_"))).otherwise(""), F.lit("im.g"), _S("o"))
    images = o.select(F.concat(stem, _pick(F.col("o"), ".JPG", ".png", ".doc", ".webp")).alias("path"))
    return scans.flat_yolo(images, _labels(o, F.concat(stem, F.lit(".txt")), F.col("o") % 5 != 0), "k", by_video=True).select(*_PARTS)


def scan_strided_yolo(spark, sf_dir):
    o = _orders(spark, sf_dir)
    stem = F.concat(F.lit("/images/"), _pick(F.col("o"), "train", "val", "test"), F.lit("/seq"), (F.col("o") % 40).cast("string"), F.when(F.col("o") % 7 == 0, "").otherwise(F.concat(F.lit("_visible_"), F.lpad(_S("o"), 8, "0"))))
    images = o.select(F.concat(F.lit("a"), stem, F.lit(".jpg")).alias("path")).distinct()
    labels = _labels(o, F.concat(F.lit("a"), F.regexp_replace(stem, "images", "labels"), F.lit(".txt")), F.col("o") % 5 != 0).distinct()
    return scans.strided_yolo(images, labels, "a").select(*_PARTS)


def scan_split_yolo(spark, sf_dir):
    o = _orders(spark, sf_dir)
    place = lambda kind, end: F.concat(F.lit("d/images/"), _pick(F.col("o"), "train", "valid", "test"), F.lit(f"/{kind}/s"), (F.col("o") % 90).cast("string"), F.lit("_jpg.rf."), _S("o"), F.lit(end))
    images = o.select(place("images", ".jpg").alias("path"))
    return scans.split_yolo(images, _labels(o, place("labels", ".txt"), F.col("o") % 5 != 0), "e", exported=True).select(*_PARTS)


def scan_prepared_yolo(spark, sf_dir):
    o = _orders(spark, sf_dir)
    place = lambda kind, end: F.concat(F.lit(f"{kind}/"), F.when(F.col("o") % 4 == 0, "").otherwise(F.concat(F.lit("day"), (F.col("o") % 9).cast("string"), F.lit("/images/"))), _S("o"), F.lit(end))
    images = o.select(place("images", ".png").alias("path"))
    return scans.prepared_yolo(images, _labels(o, place("labels", ".txt"), F.col("o") % 5 != 0), "g").select(*_PARTS)


def scan_track_frames(spark, sf_dir):
    """Frames are a customer's orders, present where the key's last digit says so; tracks come from their line items, one frame later, as sources count from 1."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("seq"), F.col("o_orderkey").alias("o"))
    frames = o.select("seq", F.concat(F.when(F.col("o") % 11 == 0, "still_").otherwise("frame_"), _S("o"), F.lit("_x.jpg")).alias("path"), F.lit(640.0).alias("width"), F.lit(480.0).alias("height"))
    presence = o.where("seq % 6 != 0").select("seq", F.col("o").alias("frame"), (F.col("o") % 4 != 0).cast("int").alias("exist"), F.col("o").alias("ordinal"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), "l_linenumber", (F.col("l_quantity") * 2 - 10.0).alias("x"), F.col("l_quantity").cast("double").alias("w"))
    tracks = lines.join(o, "o").select("seq", (F.col("o") + 1).alias("frame"), "x", F.lit(10.0).alias("y"), "w", F.lit(0.25 * 4).alias("h"))
    out = scans.track_frames(frames, tracks, presence, "seq")
    return out.select("seq", "path", "frame", F.size("boxes").cast("long").alias("boxes"), F.round(F.aggregate("boxes", F.lit(0.0), lambda t, b: t + b["w"]), 6).alias("widths"), "status", "negative_kind")


def _dataset(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    split = lambda c: _pick(F.col(c), "train", "val", "test")
    roots = table(spark, sf_dir, "region").select(_pick(F.col("r_regionkey"), "val", "test", "val", "test", "val").alias("split"), F.concat(F.lit("images/"), _S("r_regionkey")).alias("root"), (F.col("r_regionkey") != 3).alias("present"))
    images = table(spark, sf_dir, "orders").where("o_orderkey % 3 != 2").select(split("o_orderkey").alias("split"), F.lit("images/0").alias("root"), F.concat(F.lit("images/"), _S("o_orderkey"), F.lit(".jpg")).alias("path"), (F.col("o_orderkey") % 41 != 0).alias("readable"))
    images = images.union(images.where("path like '%7.jpg'").withColumn("split", F.lit("test")))
    line = F.concat_ws(" ", F.when(F.col("l_suppkey") % 7 == 0, "1").otherwise("0"), F.when(F.col("l_suppkey") % 5 == 0, "nan").when(F.col("l_suppkey") % 11 == 0, "x").otherwise((F.col("l_discount") * 10).cast("double").cast("string")), F.lit("0.5"), (F.col("l_quantity") / 50).cast("double").cast("string"), F.when(F.col("l_suppkey") % 13 != 0, "0.1"))
    labels = l.groupBy("l_orderkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("t")))), lambda x: x["t"]), "\n").alias("text"))
    return roots, images, labels.where("l_orderkey % 17 != 0").select(F.concat(F.lit("labels/"), _S("l_orderkey"), F.lit(".txt")).alias("path"), "text")


def dataset_errors(spark, sf_dir):
    errors, _ = report.dataset_report(*_dataset(spark, sf_dir), classes=[0])
    return errors.groupBy("rule", F.coalesce("split", F.lit("-")).alias("split")).agg(F.count("*").alias("n"), F.min("path").alias("least"), F.coalesce(F.sum("line"), F.lit(0)).cast("long").alias("lines"))


def dataset_counts(spark, sf_dir):
    return report.dataset_report(*_dataset(spark, sf_dir), classes=[0])[1]


_DATASET = """WITH i0 AS (SELECT o_orderkey AS o, ['train', 'val', 'test'][o_orderkey % 3 + 1] AS split FROM orders WHERE o_orderkey % 3 <> 2),
again AS (SELECT o, 'test' AS split FROM i0 WHERE o % 10 = 7),
l0 AS (SELECT l_orderkey AS o, l_linenumber, l_partkey, l_suppkey AS s, l_discount * 10 AS cx, l_quantity / 50 AS w FROM lineitem WHERE l_orderkey % 17 <> 0),
lab AS (SELECT DISTINCT o FROM l0),
ln AS (SELECT l0.*, i0.split, row_number() OVER (PARTITION BY l0.o ORDER BY l_linenumber, l_partkey, s) AS line FROM l0 JOIN i0 ON i0.o = l0.o),
r AS (SELECT split, 'labels/' || o || '.txt' AS path, line, CASE WHEN s % 13 = 0 THEN ['field_count'] WHEN s % 5 <> 0 AND s % 11 = 0 OR s % 5 = 0 AND {nan} THEN ['not_numeric']
 ELSE list_filter([CASE WHEN s % 7 = 0 THEN 'class' END, CASE WHEN s % 5 = 0 THEN 'not_finite' END, CASE WHEN s % 5 <> 0 AND (cx < 0 OR cx > 1) THEN 'centre_outside' END, CASE WHEN s % 5 <> 0 AND (w <= 0 OR w > 1) THEN 'size_outside' END,
  CASE WHEN s % 5 <> 0 AND (cx::DOUBLE - w::DOUBLE / 2 < -1e-6 OR cx::DOUBLE + w::DOUBLE / 2 > 1 + 1e-6) THEN 'crosses_boundary' END], lambda x: x IS NOT NULL) END AS rules FROM ln)""".replace("{nan}", "true")


def sources_retained(spark, sf_dir):
    d = table(spark, sf_dir, "documents").groupBy(F.concat("source", F.lit(":"), "lang", F.lit(":x")).alias("key")).agg(F.count("*").alias("n"))
    return report.by_source(d)


def conversion_totals(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_suppkey").alias("frames"), F.col("l_linenumber").alias("boxes"))  # noqa: E741
    return report.conversion_totals(l, "l_returnflag", ["frames", "boxes"])


def boxes_by_image(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")  # noqa: E741
    images = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return report.boxes_by_image(images, l.where("l_suppkey % 3 != 0"), l.where("l_suppkey % 2 = 0"), "l_orderkey")


def ingest_totals(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", "lang", "n_chars", "doc_id")
    return report.ingest_totals(d, ["source", "lang"], (F.col("n_chars") % 4).cast("long"), F.col("n_chars") % 5 == 0, F.col("doc_id") % 6 == 0)


def _hashes(spark, sf_dir):
    """512 bits a document, of which those of its number modulo 14 are turned round: copies differ by no more than 13."""
    digest = F.concat(F.sha2(F.col("text").cast("binary"), 256), F.sha2(F.concat("text", F.lit("#")).cast("binary"), 256))
    words = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substring(F.col("digest"), 8 * i + 1, 8), 16, 10).cast("long"))
    flip = F.pow(F.lit(2), F.col("doc_id") % 14).cast("long") - 1
    rows = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", "source", F.sha2(F.col("text").cast("binary"), 256).alias("sha"), F.inline(F.array(F.struct(digest.alias("digest")))))  # out of a generator, else the lambda would digest the text for each word
    rows = rows.withColumn("words", words).withColumn("words", F.transform("words", lambda x, i: F.when(i == 0, x.bitwiseXOR(flip)).otherwise(x)))
    return rows.drop("digest")


def neardup_hamming_top3(spark, sf_dir):
    return dedup.near_duplicates(_hashes(spark, sf_dir), "words", 512, "source", "doc_id")


def near_duplicate_report(spark, sf_dir):
    return report.near_duplicate_report(neardup_hamming_top3(spark, sf_dir), _hashes(spark, sf_dir).select("doc_id", "sha"), "doc_id", "sha")


_NEAR = """SELECT abs(a.doc_id % 14 - b.doc_id % 14)::INTEGER AS hamming, a.source AS source_a, a.doc_id AS id_a, b.source AS source_b, b.doc_id AS id_b, sha256(a.text) AS sha
 FROM documents a JOIN documents b ON a.text = b.text AND a.source < b.source WHERE abs(a.doc_id % 14 - b.doc_id % 14) <= 10 QUALIFY row_number() OVER (PARTITION BY b.source, b.doc_id ORDER BY hamming, a.source, a.doc_id) <= 3"""


def frame_table(spark, sf_dir):
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: (x % 3).cast("int")).alias("e"))
    return report.frame_table(s, "o_custkey", F.col("e"), F.col("o_custkey") % 30 + 1)


def reconciled_csv(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 3).cast("string").alias("drone_exist"))
    truth = table(spark, sf_dir, "orders").where("o_orderkey % 4 != 0").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 3).alias("drone_exist"))
    return report.reconciled(o, truth, ["k"])


def completed_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type in ('purchase', 'error')").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", "done").otherwise("unmarked").alias("mark"))
    return ledger.completed(e, "user_id", "event_id", "mark")


def pending_records(spark, sf_dir):
    from .timeline import ledger_current

    return ledger.pending(ledger_current(spark, sf_dir), ("downloaded", "extracting"), "download_failed", retry_failed=True).select("user_id", "status")


def edit_replay(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "error", "undo").when(F.col("event_type") == "signup", "redo").otherwise("edit")
    return ledger.edited(e.select("user_id", (F.col("event_id") % 5).alias("cell"), "event_id", op.alias("op"), "value"), "user_id", "cell", "event_id", "op", "value")


def frame_positions(spark, sf_dir):
    f = table(spark, sf_dir, "orders").select("o_custkey", F.concat(_pick(F.col("o_orderkey"), "f-g", "f", "f/a"), F.lit("/frame_"), _S("o_orderkey"), F.lit(".jpg")).alias("path"))
    return ledger.frame_positions(f, "o_custkey", "path")


def seeded_sample(spark, sf_dir):
    return ledger.seeded_sample(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_partkey", 25, 7)


def name_ops(spark, sf_dir):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("  ride"), F.when(k % 2 == 0, "  &! ").otherwise("-_"), _S("o_orderkey"), F.lit(" ?"))
    started = F.col("o_orderdate").cast("timestamp")
    path = F.concat(F.when(k % 3 == 0, "verif/").when(k % 3 == 1, "a/verif/").otherwise("a/"), F.when(k % 5 == 0, "verif").otherwise("b.jpg"))
    image = F.concat(F.when(k % 2 == 0, "set/images/").otherwise("other/images/"), F.lit("x/images/"), _S("o_orderkey"), F.when(k % 4 < 2, ".a.jpg").otherwise(""))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", K.timestamped_name(name, started).alias("stamped"), K.in_excluded_folder(path).alias("excluded"), K.label_path(image, F.lit("set")).alias("label"),
        K.source_priority(_pick(k, "gem", "kaggle2", "who")).cast("int").alias("priority"), K.shard_number(F.concat(F.when(k % 2 == 0, "x/").otherwise(""), F.lit("shards/train-"), F.lpad(_S("o_orderkey"), 5, "0"), F.when(k % 9 == 1, "99999999999").otherwise(""), F.lit(".tar")), "train").alias("shard"),
        K.content_key(F.when(k % 3 == 0, F.lit("m")), k, F.lit("T")).alias("key"),
    )


def trainer_lines(spark, sf_dir):
    k = F.col("event_id")
    line = F.when(k % 4 == 0, F.concat(F.lit("Epoch: [3/120]  [ "), _S("event_id"), F.lit("/900000]  eta"))).when(k % 4 == 1, F.concat(F.lit("Epoch: ["), (k % 9).cast("string"), F.lit("] ["), _S("event_id"), F.lit("/5]"))).when(k % 4 == 2, F.concat(F.lit("Test:  [ "), _S("event_id"), F.when(k % 3 == 0, "/99999999999]").otherwise("/511]"))).otherwise(F.lit("Epoch: [3/120][1/2]"))
    return files.trainer_lines(table(spark, sf_dir, "events").select("event_id", line.alias("line")), "line").drop("line")


def voc_boxes(spark, sf_dir):
    k = F.col("l_suppkey")
    corner = F.concat(F.lit("<xmin>"), _S("l_suppkey"), F.lit("</xmin><ymin>1.5</ymin>"), F.when(k % 5 != 0, F.concat(F.lit("<xmax>"), (k + 20).cast("string"), F.lit("</xmax>"))).otherwise(""), F.lit("<ymax>"), F.when(k % 7 == 0, "wide").when(k % 11 == 0, "inf").when(k % 13 == 0, "31d").when(k % 17 == 0, "1e999").otherwise("31.5"), F.lit("</ymax>"))
    text = F.concat(F.lit("<annotation><filename>a.jpg</filename><object><name>"), F.when(k % 3 == 0, "bird").otherwise("drone"), F.lit("</name><bndbox>"), corner, F.lit("</bndbox></object></annotation>"))
    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), text.alias("text"))
    return annotations.voc_boxes(rows, "text", "id", F.lit(640.0), F.lit(480.0))


def pixel_rows(spark, sf_dir):
    k = F.col("l_suppkey")
    line = F.concat_ws(",", F.lit("n"), F.when(k % 6 == 0, "0").otherwise(_S("l_suppkey")), F.when(k % 6 == 0, "0").otherwise("2.5"), F.when(k % 6 == 0, "0").when(k % 7 == 0, "x").when(k % 11 == 0, "nan").when(k % 13 == 0, "3d").when(k % 17 == 0, "1e999").otherwise("3"), F.when(k % 6 == 0, "0.0").when(k % 5 != 0, "4"), F.lit("junk"))
    return annotations.pixel_rows(table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), line.alias("line")), "line", "id")


def editor_frames(spark, sf_dir):
    n = (F.col("o_orderkey") % 4).cast("int")
    each = lambda f: F.array_join(F.transform(F.sequence(F.lit(0), n), f), ",")
    exist = each(lambda i: ((i + F.col("o_custkey")) % 2).cast("string"))
    rect = each(lambda i: F.when((i + F.col("o_orderkey")) % 3 == 0, "[]").otherwise(F.concat(F.lit("["), i.cast("string"), F.lit(",2,3.5,4]"))))
    text = F.concat(F.lit('{"exist":['), exist, F.lit('],"gt_rect":['), F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(rect), F.lit("]}"))
    return annotations.editor_frames(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")), "text", "o_orderkey")


def label_studio_keyframes(spark, sf_dir):
    k = F.col("o_orderkey")
    ann = lambda i, gone, x: F.concat(F.lit('{"id":'), i, F.lit(',"was_cancelled":'), gone, F.lit(',"result":[{"type":"choices","value":{}},{"type":"videorectangle","value":{"labels":["Drone"],"framesCount":90,"sequence":[{"frame":'), _S("o_orderkey"), F.lit(',"time":0.5,"enabled":true,"rotation":0,"x":'), x, F.lit(',"y":2,"width":3,"height":4}]}}]}'))
    text = F.concat(F.lit('[{"annotations":['), ann(F.lit("5"), F.lit("false"), F.lit("1.5")), F.lit(","), ann(F.lit("9"), F.when(k % 2 == 0, "true").otherwise("false"), F.lit("7.5")), F.lit("]}]"))
    rows = annotations.label_studio_keyframes(table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")), "text", "o_orderkey")
    return rows.select("o_orderkey", "track_id", "point_no", "frame", "time", "enabled", "x", "height", "frames_count")


def nested_boxes(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.struct(F.array(F.array(F.col("o_custkey").cast("double"), F.lit(1.0), F.lit(2.0), F.lit(3.0)), F.array(F.lit(5.0), F.lit(6.0))).alias("bbox")).alias("objects"))
    return annotations.nested_boxes(rows, "o_orderkey")


def box_aliases(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), _S("o_orderkey").alias(" Index "), (F.col("o_custkey") % 2).cast("string").alias("Present"), F.lit("1.5").alias("Left"), F.when(F.col("o_orderkey") % 3 != 0, "9").otherwise("wide").alias("x2"), F.lit("2").alias("top"), F.lit(" 7").alias("h"))
    return annotations.resolve_aliases(rows, ["id"]).select("id", "frame", "exist", "x", "y", "width", "height")


def usable_images(spark, sf_dir):
    k = F.col("l_suppkey")
    boxes = F.when(k % 3 == 0, F.array()).otherwise(F.array(F.lit(1)))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", quality.usable_image(k % 4, k % 5, _pick(k, "PNG", "GIF", "TIFF")).alias("usable"), quality.negative_kind(boxes, k % 2).alias("kind"))


def _folder(spark, label):
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def manifest_round_trip(spark, sf_dir):
    """A manifest written in its order, added to, and read back; texts with commas, quotes and line ends among it."""
    d = table(spark, sf_dir, "documents")
    original = F.concat(F.lit('a "b", c'), F.when(F.col("doc_id") % 2 == 0, "\n").otherwise(""), _S("doc_id"))
    none = F.lit(None).cast("string")
    rows = d.select(_S("doc_id").alias("output_image"), F.lit("train").alias("split"), "source", original.alias("original"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), none.alias("visual_hash"), F.col("lang").alias("group"), none.alias("source_split"), F.lit(640).alias("width"), F.lit(480).alias("height"), (F.col("doc_id") % 5).cast("int").alias("boxes"), none.alias("negative_kind"), none.alias("removed_classes"))
    path = _folder(spark, "manifest")
    sinks.write_manifest(rows.where("source < 'src3'"), path)
    sinks.append_manifest(rows.where("source >= 'src3'"), path)
    return files.read_manifest(spark, path).select("output_image", "source", "original", "group", "width", "boxes", "visual_hash")


def tar_round_trip(spark, sf_dir):
    """Documents packed into a TAR by source, written as files in two phases, and listed again."""
    d = table(spark, sf_dir, "documents")
    path = _folder(spark, "shards")
    tar.write_tar(d.select(F.col("source").alias("split"), F.lit(4).alias("shard"), F.concat(F.when(F.col("doc_id") % 7 == 0, "../").otherwise("d/"), _S("doc_id"), F.lit(".txt")).alias("name"), F.col("text").cast("binary").alias("content")), path)
    listed = tar.read_tar(spark, path, content=False)
    return listed.select(F.regexp_extract("archive", "shards/[^/]*$", 0).alias("archive"), "member", "size", "safe")


def tar_contents(spark, sf_dir):
    """Pages packed by thirds of their number, in parts of 1,000 bytes, and read back by ranges of 20,000 bytes."""
    p, path = table(spark, sf_dir, "pages"), _folder(spark, "pages")
    html = F.col("html").cast("binary")
    parts = p.withColumn("part", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("html") / 1000).cast("int") - 1, F.lit(0)))))
    tar.write_tar(parts.select(F.lit("train").alias("split"), (F.col("page_id") % 3).cast("int").alias("shard"), F.concat(_S("page_id"), F.lit(".html")).alias("name"), F.octet_length("html").alias("size"), "part", F.substring(html, F.col("part") * 1000 + 1, F.lit(1000)).alias("content")), path)
    got = tar.read_tar(spark, path, split_bytes=20_000, part_bytes=3000).groupBy("member").agg(F.sum(F.octet_length("content")).alias("bytes"), F.sum(F.crc32("content")).alias("crc"), F.count("*").alias("parts"))
    return got.select(F.regexp_extract("member", r"^(\d+)", 1).cast("long").alias("page_id"), "bytes", "parts")


def label_texts(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    box = F.struct((F.col("l_discount") * 8).cast("double").alias("cx"), F.lit(0.25).alias("cy"), (F.col("l_suppkey") / 1024).alias("w"), F.lit(0.5).alias("h"))
    return l.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sinks.label_text(F.array(box.withField("cx", F.col("l_linenumber") / 8.0), box.withField("cx", F.lit(0.125)))).alias("text"))


def metric_log(spark, sf_dir):
    path = _folder(spark, "log")
    e = table(spark, sf_dir, "events")
    lines = e.select(F.to_json(F.struct(F.col("event_id").alias("epoch"), F.when(F.col("event_id") % 3 != 0, F.array(F.col("event_id") / 8.0, F.col("event_id") / 4.0)).alias("test_coco_eval_bbox"), F.lit(1).alias("other"))).alias("value"))
    lines.write.text(path)
    return files.read_metric_log(spark, path)


def results_csv(spark, sf_dir):
    path = _folder(spark, "results")
    table(spark, sf_dir, "part").select(F.concat(F.lit("   "), _S("p_partkey")).alias("   epoch"), F.concat(F.lit(" "), (F.col("p_size") / 4.0).cast("string"), F.lit("  ")).alias(" metrics/mAP50(B)")).write.option("header", True).csv(path)
    got = files.read_results_csv(spark, path)
    return got.select("epoch", F.col("`metrics/mAP50(B)`").alias("map50"))


def listing_read(spark, sf_dir):
    path = _folder(spark, "listing")
    d = table(spark, sf_dir, "documents")
    d.select(F.concat("source", F.lit("/"), _S("doc_id")).alias("Path"), _S("doc_id").alias("ID"), F.col("n_chars").cast("long").alias("Size"), F.lit("2024-01-01T00:00:00Z").alias("ModTime"), F.lit("application/zip").alias("MimeType"), F.when(F.col("doc_id") % 4 != 0, F.struct(F.md5(F.col("text").cast("binary")).alias("md5"))).alias("Hashes")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct("*"))), ","), F.lit("]")).alias("value")).write.text(path)
    return files.read_listing(spark, path).select("drive_id", "path", "size", K.content_key(F.col("md5"), F.col("size"), F.col("modified")).alias("key"))


def image_headers(spark, sf_dir):
    """PNG, GIF and BMP headers of sizes that line items tell, some cut short."""
    k, w = F.col("l_suppkey"), F.col("l_quantity").cast("int")
    four = lambda n: F.lpad(F.hex(n.cast("long")), 8, "0")
    two = lambda n: F.concat(F.lpad(F.hex(n.cast("long") % 256), 2, "0"), F.lpad(F.hex(F.floor(n / 256).cast("long")), 2, "0"))
    png = F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), four(w), four(k + 1))
    gif = F.concat(F.lit("474946383961"), two(w), two(k + 1))
    data = F.when(k % 4 == 0, F.substring(png, 1, 44)).when(k % 4 == 1, png).when(k % 4 == 2, gif).otherwise("00")
    rows = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("path"), F.unhex(data).alias("content"))
    return images.inspected(rows)


def static_pairs(spark, sf_dir):
    pairs = scans.static_pairs(spark, {"en": "english", "de": "german", "xx": "nowhere"}, "lang", "name")
    return table(spark, sf_dir, "documents").join(F.broadcast(pairs), "lang").groupBy("name").agg(F.count("*").alias("n"))


_STEM = "'k3/' || CASE WHEN o % 3 = 0 THEN 'Video' || (o % 50) || '_' ELSE '' END || 'im.g' || o"
_MISSING = "CASE WHEN o % 5 <> 0 THEN 'labelled' ELSE 'missing_label' END AS status"
_O = "(SELECT o_orderkey AS o, o_custkey AS seq FROM orders)"

QUERIES = {
    scan_flat_yolo: f"SELECT {_STEM} || ['.JPG', '.png', '.doc', '.webp'][o % 4 + 1] AS path, 'k:' || CASE WHEN o % 3 = 0 THEN 'video' || (o % 50) ELSE 'im.g' || o END AS \"group\", NULL::VARCHAR AS source_split, {_STEM} || '.txt' AS label_path, {_MISSING} FROM {_O} WHERE o % 4 <> 2",
    scan_strided_yolo: f"""WITH p AS (SELECT o, ['train', 'val', 'test'][o % 3 + 1] AS s, 'seq' || (o % 40) || CASE WHEN o % 7 = 0 THEN '' ELSE '_visible_' || lpad(o::VARCHAR, 8, '0') END AS stem FROM {_O}),
i AS (SELECT DISTINCT s, stem FROM p WHERE o % 7 = 0 OR o % 3 = 0), l AS (SELECT DISTINCT s, stem FROM p WHERE o % 5 <> 0)
SELECT 'a/images/' || i.s || '/' || i.stem || '.jpg' AS path, 'a:' || regexp_replace(i.stem, '_visible_.*', '') AS "group", i.s AS source_split, 'a/labels/' || i.s || '/' || i.stem || '.txt' AS label_path, CASE WHEN l.stem IS NULL THEN 'missing_label' ELSE 'labelled' END AS status
FROM i LEFT JOIN l ON l.s = i.s AND l.stem = i.stem""",
    scan_split_yolo: f"SELECT 'd/images/' || ['train', 'valid', 'test'][o % 3 + 1] || '/images/s' || (o % 90) || '_jpg.rf.' || o || '.jpg' AS path, 'e:s' || (o % 90) || '_jpg' AS \"group\", ['train', 'val', 'test'][o % 3 + 1] AS source_split, 'd/images/' || ['train', 'valid', 'test'][o % 3 + 1] || '/labels/s' || (o % 90) || '_jpg.rf.' || o || '.txt' AS label_path, {_MISSING} FROM {_O}",
    scan_prepared_yolo: f"SELECT 'images/' || d || o || '.png' AS path, 'g:' || CASE WHEN d = '' THEN '.' ELSE d[:-2] END AS \"group\", NULL::VARCHAR AS source_split, 'labels/' || d || o || '.txt' AS label_path, {_MISSING} FROM (SELECT o, CASE WHEN o % 4 = 0 THEN '' ELSE 'day' || (o % 9) || '/images/' END AS d FROM {_O})",
    scan_track_frames: f"""WITH t AS (SELECT seq, o, list_transform([l_quantity * 2 - 10], lambda x: least(greatest(x, 0), 100))[1]::DOUBLE / 100 AS l, least(l_quantity * 3 - 10, 100)::DOUBLE / 100 AS r FROM {_O} JOIN lineitem ON l_orderkey = o),
k AS (SELECT DISTINCT seq FROM t WHERE seq % 6 <> 0), b AS (SELECT seq, o, count(*) AS n, sum(r - l) AS w FROM t WHERE (r - l) * 640 >= 1 GROUP BY 1, 2),
f AS (SELECT x.seq, x.o, x.o % 11 = 0 AS bad, x.o % 4 <> 0 AND x.o % 11 <> 0 AS present, coalesce(n, 0) AS n, coalesce(w, 0) AS w FROM {_O} x JOIN k ON k.seq = x.seq LEFT JOIN b ON b.seq = x.seq AND b.o = x.o)
SELECT seq, CASE WHEN bad THEN 'still_' ELSE 'frame_' END || o || '_x.jpg' AS path, CASE WHEN NOT bad THEN o::INTEGER END AS frame, CASE WHEN present THEN n ELSE 0 END AS boxes, round(CASE WHEN present THEN w ELSE 0e0 END, 6) AS widths,
CASE WHEN bad THEN 'invalid_frame_name' WHEN present AND n = 0 THEN 'positive_without_box' ELSE 'kept' END AS status, CASE WHEN NOT bad AND NOT present THEN 'native_empty' ELSE '' END AS negative_kind FROM f""",
    dataset_errors: f"""{_DATASET}, e AS (SELECT 'train_undefined' AS rule, 'train' AS split, NULL::VARCHAR AS path, NULL::BIGINT AS line
UNION ALL SELECT 'root_missing', 'test', 'images/3', NULL UNION ALL SELECT 'no_images', split, 'images/' || k, NULL FROM (VALUES (0, 'val'), (1, 'test'), (2, 'val'), (4, 'val')) v(k, split) WHERE k <> 0 OR NOT EXISTS (SELECT 1 FROM i0 WHERE i0.split = 'val')
UNION ALL SELECT 'duplicate_image', split, 'images/' || o || '.jpg', NULL FROM again UNION ALL SELECT 'unreadable_image', split, 'images/' || o || '.jpg', NULL FROM i0 WHERE o % 41 = 0
UNION ALL SELECT 'missing_label', split, 'images/' || o || '.jpg', NULL FROM i0 WHERE o NOT IN (SELECT o FROM lab) UNION ALL SELECT unnest(rules), split, path, line FROM r
UNION ALL SELECT 'orphan_label', NULL, 'labels/' || o || '.txt', NULL FROM lab WHERE o NOT IN (SELECT o FROM i0))
SELECT rule, coalesce(split, '-') AS split, count(*) AS n, min(path) AS least, coalesce(sum(line), 0)::BIGINT AS lines FROM e GROUP BY 1, 2""",
    dataset_counts: f"""{_DATASET} SELECT split || '_images' AS name, count(*) AS n FROM i0 GROUP BY split UNION ALL SELECT split || '_labels', count(*) FROM i0 WHERE o IN (SELECT o FROM lab) GROUP BY split
UNION ALL SELECT split || '_missing_labels', count(*) FROM i0 WHERE o NOT IN (SELECT o FROM lab) GROUP BY split UNION ALL SELECT split || '_boxes', count(*) FROM r WHERE NOT list_has_any(rules, ['field_count', 'not_numeric', 'not_finite']) GROUP BY split
UNION ALL SELECT 'orphan_labels', count(*) FROM lab WHERE o NOT IN (SELECT o FROM i0) HAVING count(*) > 0""",
    sources_retained: "SELECT source, count(*) AS n FROM documents GROUP BY source",
    conversion_totals: "SELECT l_returnflag, sum(l_suppkey)::BIGINT AS frames, sum(l_linenumber)::BIGINT AS boxes FROM lineitem GROUP BY 1",
    boxes_by_image: "SELECT o_orderkey AS l_orderkey, count(*) FILTER (WHERE l_suppkey % 3 <> 0) AS ground_truth_boxes, count(*) FILTER (WHERE l_suppkey % 2 = 0) AS prediction_boxes FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
    ingest_totals: """WITH d AS (SELECT source, lang, n_chars % 4 AS b, n_chars % 5 = 0 AS u, doc_id % 6 = 0 AS k FROM documents)
SELECT source, lang, count(*) AS frames, count(*) FILTER (WHERE b = 0) AS frames_without_box, count(*) FILTER (WHERE b > 0 AND u) AS undersized_box_frames, count(*) FILTER (WHERE b > 0 AND NOT u AND k) AS duplicates_skipped,
 count(*) FILTER (WHERE b > 0 AND NOT u AND NOT k) AS added, coalesce(sum(b) FILTER (WHERE NOT u AND NOT k), 0)::BIGINT AS boxes FROM d GROUP BY 1, 2""",
    neardup_hamming_top3: f"SELECT hamming, source_a, id_a, source_b, id_b FROM ({_NEAR})",
    near_duplicate_report: f"SELECT hamming AS hamming_distance, source_a, id_a AS image_a, sha AS sha256_a, source_b, id_b AS image_b, sha AS sha256_b FROM ({_NEAR})",
    frame_table: "SELECT o_custkey, frame::INTEGER AS frame, format('{:.3f}', frame / (o_custkey % 30 + 1)::DOUBLE) AS timestamp, (o_orderkey % 3 <> 0)::INTEGER AS drone_exist, 0 AS audio_exist FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS frame FROM orders)",
    reconciled_csv: "SELECT k, CASE WHEN new IS NULL THEN old ELSE new END AS drone_exist, new IS NOT NULL AND new <> old AS corrected FROM (SELECT o_orderkey AS k, (o_custkey % 3)::VARCHAR AS old, CASE WHEN o_orderkey % 4 <> 0 THEN (o_orderkey % 3 <> 0)::INTEGER::VARCHAR END AS new FROM orders)",
    completed_runs: "SELECT user_id, max(event_id) AS seq FROM events WHERE event_type IN ('purchase', 'error') GROUP BY user_id HAVING arg_max(event_type, event_id) = 'purchase'",
    pending_records: "SELECT user_id, status FROM (SELECT user_id, CASE arg_max(event_type, event_id) WHEN 'click' THEN 'downloaded' WHEN 'signup' THEN 'extracting' WHEN 'error' THEN 'download_failed' END AS status FROM events GROUP BY user_id) WHERE status IS NOT NULL",
    edit_replay: None,
    frame_positions: "SELECT o_custkey, path, (row_number() OVER (PARTITION BY o_custkey ORDER BY string_split(path, '/')) - 1)::INTEGER AS position FROM (SELECT o_custkey, ['f-g', 'f', 'f/a'][o_orderkey % 3 + 1] || '/frame_' || o_orderkey || '.jpg' AS path FROM orders)",
    seeded_sample: "SELECT p_partkey, p_size FROM part ORDER BY sha256('7:' || p_partkey), p_partkey LIMIT 25",
    name_ops: """SELECT o_orderkey, strftime(o_orderdate::TIMESTAMP, '%Y_%m_%d_%H_%M_%S') || CASE WHEN o_orderkey % 2 = 0 THEN '_ride_' ELSE '_ride-_' END || o_orderkey AS stamped, o_orderkey % 3 <> 2 AS excluded,
 CASE WHEN o_orderkey % 2 = 0 THEN 'set/labels/x/images/' ELSE 'other/images/x/labels/' END || o_orderkey || CASE WHEN o_orderkey % 4 < 2 THEN '.a' ELSE '' END || '.txt' AS label, [110, 80, 0][o_orderkey % 3 + 1] AS priority,
 CASE WHEN o_orderkey % 2 <> 0 AND o_orderkey % 9 <> 1 THEN left(lpad(o_orderkey::VARCHAR, 5, '0'), 5)::INTEGER END AS shard, CASE WHEN o_orderkey % 3 = 0 THEN 'm' ELSE 'size' || o_orderkey || '-T' END AS key FROM orders""",
    trainer_lines: "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'train' WHEN 2 THEN 'test' END AS phase, CASE event_id % 4 WHEN 0 THEN 3 WHEN 1 THEN event_id % 9 END::INTEGER AS epoch, CASE WHEN event_id % 4 <> 3 THEN event_id END::INTEGER AS batch, CASE event_id % 4 WHEN 0 THEN 900000 WHEN 1 THEN 5 WHEN 2 THEN CASE WHEN event_id % 3 <> 0 THEN 511 END END::INTEGER AS batches FROM events",
    voc_boxes: """SELECT l_orderkey || '-' || l_linenumber AS id, CASE WHEN ok THEN (l_suppkey + 10) / 640e0 END AS cx, CASE WHEN ok THEN 16.5e0 / 480e0 END AS cy, CASE WHEN ok THEN 20 / 640e0 END AS w, CASE WHEN ok THEN 30 / 480e0 END AS h, CASE WHEN NOT ok THEN 'bad_corner' END AS error
FROM (SELECT *, l_suppkey % 5 <> 0 AND l_suppkey % 7 <> 0 AND l_suppkey % 11 <> 0 AND l_suppkey % 13 <> 0 AND l_suppkey % 17 <> 0 AS ok FROM lineitem WHERE l_suppkey % 3 <> 0)""",
    pixel_rows: """SELECT l_orderkey || '-' || l_linenumber AS id, CASE WHEN s % 6 = 0 THEN 0 ELSE s END::DOUBLE AS x, CASE WHEN s % 6 = 0 THEN 0 ELSE 2.5 END::DOUBLE AS y, CASE WHEN s % 6 = 0 THEN 0 WHEN s % 7 <> 0 AND s % 11 <> 0 AND s % 13 <> 0 AND s % 17 <> 0 THEN 3 END::DOUBLE AS w, CASE WHEN s % 6 = 0 THEN 0 WHEN s % 5 <> 0 THEN 4 END::DOUBLE AS h,
 CASE WHEN s % 6 = 0 THEN 'negative' WHEN s % 7 = 0 OR s % 5 = 0 OR s % 11 = 0 OR s % 13 = 0 OR s % 17 = 0 THEN 'malformed' ELSE 'box' END AS status FROM (SELECT *, l_suppkey AS s FROM lineitem)""",
    editor_frames: """WITH g AS (SELECT o_orderkey, o_custkey, unnest(range(0, o_orderkey % 4 + 1)) AS i FROM orders WHERE o_orderkey % 5 <> 0), h AS (SELECT *, (i + o_custkey) % 2 AS e, (i + o_orderkey) % 3 <> 0 AS r FROM g)
SELECT o_orderkey, i::INTEGER AS frame, e::INTEGER AS exist, CASE WHEN r THEN i::DOUBLE END AS x, CASE WHEN r THEN 2e0 END AS y, CASE WHEN r THEN 3.5e0 END AS w, CASE WHEN r THEN 4e0 END AS h, CASE WHEN e <> 0 AND NOT r THEN 'positive_without_box' END AS error FROM h
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL, 'length_mismatch' FROM orders WHERE o_orderkey % 5 = 0""",
    label_studio_keyframes: "SELECT o_orderkey, 0 AS track_id, 0 AS point_no, o_orderkey::INTEGER AS frame, 0.5e0 AS time, true AS enabled, CASE WHEN o_orderkey % 2 = 0 THEN 1.5e0 ELSE 7.5e0 END AS x, 4e0 AS height, 90 AS frames_count FROM orders",
    nested_boxes: "SELECT o_orderkey, 0 AS box_no, o_custkey::DOUBLE AS x, 1e0 AS y, 2e0 AS w, 3e0 AS h FROM orders UNION ALL SELECT o_orderkey, 1, 5, 6, NULL, NULL FROM orders",
    box_aliases: "SELECT o_orderkey AS id, o_orderkey::DOUBLE AS frame, (o_custkey % 2)::DOUBLE AS exist, 1.5e0 AS x, 2e0 AS y, CASE WHEN o_orderkey % 3 <> 0 THEN 7.5e0 END AS width, 7e0 AS height FROM orders",
    manifest_round_trip: "SELECT doc_id::VARCHAR AS output_image, source, 'a \"b\", c' || CASE WHEN doc_id % 2 = 0 THEN chr(10) ELSE '' END || doc_id AS original, lang AS \"group\", 640 AS width, (doc_id % 5)::INTEGER AS boxes, NULL::VARCHAR AS visual_hash FROM documents",
    tar_round_trip: "SELECT 'shards/' || source || '-00004.tar' AS archive, CASE WHEN doc_id % 7 = 0 THEN '../' ELSE 'd/' END || doc_id || '.txt' AS member, coalesce(strlen(text), 0) AS size, doc_id % 7 <> 0 AS safe FROM documents",
    tar_contents: "SELECT page_id, strlen(html) AS bytes, ceil(strlen(html) / 3000)::BIGINT AS parts FROM pages",
    label_texts: "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, format('0 {:.8f} 0.25000000 {:.8f} 0.50000000', l_linenumber / 8, l_suppkey / 1024) || chr(10) || format('0 0.12500000 0.25000000 {:.8f} 0.50000000', l_suppkey / 1024) AS text FROM lineitem",
    metric_log: "SELECT (event_id + 1)::INTEGER AS epoch, CASE WHEN event_id % 3 <> 0 THEN event_id / 8 END AS map50_95, CASE WHEN event_id % 3 <> 0 THEN event_id / 4 END AS map50 FROM events",
    results_csv: "SELECT p_partkey::DOUBLE AS epoch, p_size / 4 AS map50 FROM part",
    listing_read: "SELECT doc_id::VARCHAR AS drive_id, source || '/' || doc_id AS path, n_chars::BIGINT AS size, CASE WHEN doc_id % 4 <> 0 THEN md5(text) ELSE 'size' || n_chars || '-2024-01-01T00:00:00Z' END AS key FROM documents",
    image_headers: """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS path, CASE l_suppkey % 4 WHEN 1 THEN 'PNG' WHEN 2 THEN 'GIF' END AS kind, CASE WHEN l_suppkey % 4 IN (1, 2) THEN floor(l_quantity)::INTEGER END AS width, CASE WHEN l_suppkey % 4 IN (1, 2) THEN (l_suppkey + 1)::INTEGER END AS height,
 l_suppkey % 4 IN (1, 2) AND floor(l_quantity) > 0 AS readable FROM lineitem""",
    static_pairs: "SELECT CASE lang WHEN 'en' THEN 'english' ELSE 'german' END AS name, count(*) AS n FROM documents WHERE lang IN ('en', 'de') GROUP BY 1",
    usable_images: "SELECT l_orderkey, l_linenumber, l_suppkey % 4 >= 2 AND l_suppkey % 5 >= 2 AND l_suppkey % 3 <> 2 AS usable, CASE WHEN l_suppkey % 3 <> 0 THEN '' WHEN l_suppkey % 2 > 0 THEN 'non_target' ELSE 'native_empty' END AS kind FROM lineitem",
}
