"""Hand-made cases with results worked out from the rules."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gleanery.functions import geometry as G
from gleanery.functions import keys as K
from gleanery.operators import dedup, hamming, ledger, package, quality, splits, tracks
from gleanery.sources import annotations, files, sinks


def clip(spark, box, size):
    df = spark.createDataFrame([(*box, *size)], "cx double, cy double, w double, h double, width double, height double")
    return df.select(G.clip_normalised(*(F.col(c) for c in df.columns)).alias("o")).first().o


def test_clip_normalised(spark):
    inside = clip(spark, (0.5, 0.5, 0.2, 0.2), (100.0, 100.0))
    assert [round(x, 9) for x in inside[:4]] == [0.5, 0.5, 0.2, 0.2] and not inside.repaired
    edge = clip(spark, (0.0, 0.5, 0.2, 0.2), (100.0, 100.0))
    assert [round(x, 9) for x in edge[:4]] == [0.05, 0.5, 0.1, 0.2] and edge.repaired
    assert clip(spark, (0.5, 0.5, 0.0078125, 0.5), (64.0, 64.0)) is None
    assert clip(spark, (0.5, 0.5, 0.015625, 0.5), (64.0, 64.0)) is not None
    assert clip(spark, (math.nan, 0.5, 0.2, 0.2), (64.0, 64.0)) is None
    assert clip(spark, (None, 0.5, 0.2, 0.2), (64.0, 64.0)) is None


def test_pixel_rule_drops_exactly_one_pixel(spark):
    df = spark.createDataFrame([(31.5, 16.0, 1.0, 32.0, 64.0, 64.0), (31.0, 16.0, 1.5, 32.0, 64.0, 64.0)], "x double, y double, w double, h double, width double, height double")
    assert [r.o is None for r in df.select(G.clip_pixels(*(F.col(c) for c in df.columns)).alias("o")).collect()] == [True, False]


def test_undersized_drops_the_whole_image(spark):
    df = spark.sql("SELECT array(named_struct('w', 0.1D, 'h', 0.1D), named_struct('w', 0.07D, 'h', 0.1D)) AS b, array() AS none")
    v = df.select(quality.box_verdict(F.col("b"), F.lit(100.0), F.lit(100.0)).alias("v")).first().v
    assert (v.verdict, v.small) == ("undersized", 1)


def test_dedup_tie_keeps_first(spark):
    df = spark.createDataFrame([(9, "h", 1, 2, "b"), (4, "h", 1, 2, "a"), (1, "h", 0, 9, "c")], "ordinal long, hash string, p int, n int, source string")
    kept = dedup.exact_dedup(df, "hash", F.col("p"), F.col("n"), "ordinal").collect()
    assert [(r.ordinal, r.rank_ordinal) for r in kept] == [(4, 1)]
    again = dedup.exact_dedup(dedup.exact_dedup(df, "hash", F.col("p"), F.col("n"), "ordinal").drop("rank_ordinal"), "hash", F.col("p"), F.col("n"), "ordinal")
    assert again.count() == 1
    assert {r.key: r.n for r in dedup.dedup_audit(df, "hash", F.col("p"), F.col("n"), "ordinal", "source").collect()} == {"b->kept:a": 1, "c->kept:a": 1}


def test_known_rows_and_repeats_are_dropped(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, "c")], "o long, h string")
    known = spark.createDataFrame([("a",), ("a",)], "h string")
    assert sorted(r.o for r in dedup.drop_known(rows, known, "h", "o").collect()) == [2, 4]


def test_group_goes_where_its_first_row_goes(spark):
    df = spark.createDataFrame([("g", 1, "train"), ("g", 2, "test"), ("t", 3, "test"), ("t", 4, None)], "g string, o long, s string")
    got = {r.o: r.split for r in splits.split_by_group(df, "g", "o", F.col("s")).collect()}
    assert got == {1: "train", 2: "train", 3: "test", 4: "test"}
    shuffled = {r.o: r.split for r in splits.split_by_group(df.orderBy(F.desc("o")), "g", "o", F.col("s")).collect()}
    assert shuffled == got


def test_greedy_split(spark):
    groups = spark.createDataFrame([("a", 80), ("b", 10), ("c", 10)], "name string, size long")
    assert {r.name: r.split for r in splits.greedy_splits(groups).collect()} == {"a": "train", "b": "val", "c": "test"}


@pytest.mark.parametrize("sizes, shards", [([60, 50, 40, 70], [0, 1, 1, 2]), ([30, 150, 30], [0, 1, 2]), ([], []), ([100, 1], [0, 1])])
def test_next_fit(sizes, shards):
    assert package.next_fit(sizes, 100) == shards


@pytest.mark.parametrize("target, parts", [(100, 1), (100, 7), (5, 13), (10_000, 9)])
def test_next_fit_over_ranges(spark, monkeypatch, target, parts):
    import random

    rng = random.Random(target)
    rows = [(s, i, rng.choice([0, 0, 1, 7, 30, 60, 99, 100, 101, 250, None])) for s in ("a", "b", None) for i in range(150)] + [("one", 0, 5), ("zero", 0, 0), ("zero", 1, 101)]
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        starts = spark.createDataFrame([("b", 7)], "s string, start int")
        df = spark.createDataFrame(rows, "s string, i int, n long").repartition(4)
        got = {(r.s, r.i): r.shard for r in package.pack_next_fit(df, "s", ["i"], "n", target, starts).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {}
    for s in {s for s, _, _ in rows}:
        mine = sorted((i, n or 0) for t, i, n in rows if t == s)
        want |= {(s, i): k for (i, _), k in zip(mine, package.next_fit([n for _, n in mine], target, 7 if s == "b" else 0))}
    assert got == want


def keys(spark, points):
    return spark.createDataFrame([("t", i, *p) for i, p in enumerate(points)], "t string, point_no int, frame int, time double, enabled boolean, rotation double, x double")


def test_tracks(spark):
    both = keys(spark, [(1, 0.0, True, 0.0, 0.0), (5, 4.0, True, 0.0, 8.0)])
    closed = lambda k: [(r.frame, r.x) for r in tracks.interpolate_closed(k, "t", ("x",)).orderBy("frame").collect()]
    half = lambda k: [(r.frame, r.x) for r in tracks.interpolate_half_open(k, "t", 100, ("x",)).orderBy("frame").collect()]
    assert closed(both) == [(1, 0.0), (2, 2.0), (3, 4.0), (4, 6.0), (5, 8.0)]
    off = keys(spark, [(1, 0.0, True, 0.0, 0.0), (5, 4.0, False, 0.0, 8.0)])
    assert closed(off) == [(1, 0.0), (2, 2.0), (3, 4.0), (4, 6.0)]
    assert half(off) == [(0, 0.0), (1, 2.0), (2, 4.0), (3, 6.0)]
    missing = keys(spark, [(3, 0.0, None, None, 7.0)])
    assert closed(missing) == [] and half(missing) == [(2, 7.0)]
    same = keys(spark, [(5, 0.0, True, 0.0, 1.0), (5, 0.0, True, 0.0, 2.0)])
    assert closed(same) == [(5, 2.0)]
    assert half(keys(spark, [(0, 0.0, True, 0.0, 1.0)])) == []
    rotated = keys(spark, [(1, 0.0, True, 5.0, 0.0), (3, 0.0, True, 0.0, 4.0)])
    assert half(rotated) == [(2, 4.0)]


def test_time_track_holds_the_last_box(spark):
    k = keys(spark, [(1, 1.0, True, 0.0, 3.0)])
    t = spark.createDataFrame([("t", 9.0), ("t", 1.0), ("t", 0.5)], "t string, t2 double").toDF("track", "t")
    got = tracks.interpolate_at(k.withColumnRenamed("t", "track"), t, "track", ("x",)).collect()
    assert sorted((r.t, r.x) for r in got) == [(1.0, 3.0), (9.0, 3.0)]


@pytest.mark.parametrize("name, day", [("2026_1_9_11", "2026-01-09"), ("09_01_2026_x", "2026-01-09"), ("cam_1", None), ("2026_13_99", "2026-13-99"), ("1999_1_2", None)])
def test_recording_day(spark, name, day):
    assert spark.createDataFrame([(name,)], "n string").select(K.recording_day(F.col("n")).alias("d")).first().d == day


def test_stable_fraction(spark):
    import hashlib

    names = ["", "a", "källa", "x" * 999]
    got = [r.f for r in spark.createDataFrame([(n,) for n in names], "n string").select(K.stable_fraction(F.col("n")).alias("f")).collect()]
    assert got == [int.from_bytes(hashlib.sha256(n.encode()).digest()[:8], "big") / 2**64 for n in names]


def test_validator(spark):
    df = spark.createDataFrame([(0.0, 1.2, 0.5, 0.1, 0.1), (0.5, 0.5, 0.5, 0.1, 0.1), (9.0, math.nan, 0.5, 0.1, 0.1), (0.0, 0.5, 0.5, 0.0, 0.1)], "c double, cx double, cy double, w double, h double")
    got = [r.e for r in df.select(quality.box_errors(*(F.col(c) for c in df.columns), [0, 1]).alias("e")).collect()]
    assert got == [["centre_outside", "crosses_boundary"], ["class"], ["class", "not_finite"], ["size_outside"]]


def test_label_lines(spark):
    df = spark.createDataFrame([(1, "0 .5 .5 .1 .1\n\n1d 1 1 1 1\n2 1 1 1 1 \n0 1 1 1\n inf 0 0 0 0\n1.9\t1 1 1 1")], "i int, t string")
    got = quality.parse_label_lines(df, "t", [0, 1]).orderBy("line").collect()
    assert [(r.line, r.status, r.class_id) for r in got] == [(1, "box", 0), (3, "malformed", None), (4, "other_class", 2), (5, "malformed", None), (6, "malformed", None), (7, "box", 1)]


def test_near_duplicates_by_bits(spark):
    rows = spark.createDataFrame([(s, i, [w, 0] * 8, r) for s, i, w, r in (("a", 1, 0, 1.0), ("b", 2, 31, 1.0), ("b", 3, 63, 1.0), ("a", 4, 0, 1.0), ("c", 5, 0, 2.0))], "s string, i long, w array<bigint>, r double")
    got = {(r.id_a, r.id_b, r.hamming) for r in dedup.near_duplicates(rows, "w", 512, "s", "i", "r", most=40).collect()}
    assert got == {(1, 2, 40), (4, 2, 40)}


def test_undo_replay(spark):
    log = [(1, "edit", 10), (2, "edit", 20), (3, "undo", None), (4, "undo", None), (5, "edit", 30), (6, "edit", 40), (7, "undo", None)]
    df = spark.createDataFrame([("c", *x) for x in log], "cell string, seq int, op string, v int")
    assert [r.v for r in ledger.replayed(df, ["cell"], "seq", "op", "v").collect()] == [30]
    assert ledger.replayed(df.where("seq <= 4"), ["cell"], "seq", "op", "v").count() == 0


def test_listing_diff(spark):
    state = spark.createDataFrame(
        [("1", "a.zip", "m1", "ingested"), ("2", "b.zip", "m2", "extracted"), ("3", "x.zip", "m3", "download_failed"), ("4", "y.zip", "m4", "ignored"), ("8", "h.zip", "m8", "duplicate")],
        "drive_id string, path string, md5 string, status string",
    ).withColumn("seq", F.col("drive_id").cast("int"))
    now = [("1", "a.zip", "m1", ""), ("2", "c.zip", "m2", ""), ("1", "a.zip", "m9", ""), ("5", "e.zip", "m1", ""), ("6", "f.zip", "m6", ""), ("7", "g.zip", "m6", ""), ("3", "x.zip", "m3", ""), ("4", "y.txt", "m4", None), ("9", "n.txt", "m6", None), ("8", "h.zip", "m8", "")]
    got = {(r.drive_id, r.md5): (r.action, r.renamed) for r in ledger.listing_diff(spark.createDataFrame(now, "drive_id string, path string, md5 string, suffix string"), state).collect()}
    assert got == {
        ("1", "m1"): ("skip", False), ("2", "m2"): ("skip", True), ("1", "m9"): ("new_version", False), ("5", "m1"): ("duplicate", False), ("6", "m6"): ("new", False),
        ("7", "m6"): ("duplicate", False), ("3", "m3"): ("again", False), ("4", "m4"): ("ignored", True), ("9", "m6"): ("ignored", False), ("8", "m8"): ("skip", False),
    }


def test_pair_rules(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int"), spark.createDataFrame([(2,), (3,), (4,)], "k int")
    assert {(r.k, r.rule) for r in quality.validate_pairs(a, b, "k").collect()} == {(1, "missing_label"), (2, "duplicate_image"), (4, "orphan_label")}


def test_editor_document(spark):
    df = spark.createDataFrame([("s", '{"exist":[1,0,1],"gt_rect":[[1,2,3,4],[],[]]}'), ("bad", '{"exist":[1],"gt_rect":[]}'), ("none", "nonsense")], "id string, t string")
    got = {(r.id, r.frame): (r.x, r.error) for r in annotations.editor_frames(df, "t", "id").collect()}
    assert got == {("s", 0): (1.0, None), ("s", 1): (None, None), ("s", 2): (None, "positive_without_box"), ("bad", None): (None, "length_mismatch"), ("none", None): (None, "length_mismatch")}


def test_label_studio(spark):
    text = '[{"data":{"video_url":"v"},"annotations":[{"id":1,"was_cancelled":false,"result":[]},{"id":3,"was_cancelled":true,"result":[]},{"id":2,"result":[{"type":"videorectangle","value":{"labels":["Drone"],"framesCount":9,"sequence":[{"frame":1,"time":0.1,"enabled":true,"x":1,"y":2,"width":3,"height":4}]}},{"type":"videorectangle","value":{"labels":["Bird"],"sequence":[{"frame":2}]}}]}]}]'
    got = annotations.label_studio_keyframes(spark.createDataFrame([("a", text)], "id string, t string"), "t", "id").collect()
    assert [(r.frame, r.x, r.height, r.frames_count) for r in got] == [(1, 1.0, 4.0, 9)]


def test_voc(spark):
    xml = "<annotation><filename>f.jpg</filename><object><name>drone</name><bndbox><xmin>10</xmin><ymin>20</ymin><xmax>30</xmax><ymax>60</ymax></bndbox></object><object><name>drone</name><bndbox><ymin>1</ymin><xmax>3</xmax><ymax>4</ymax></bndbox></object><object><name>bird</name><bndbox><xmin>1</xmin></bndbox></object></annotation>"
    df = spark.createDataFrame([("a", xml)], "id string, t string")
    got = annotations.voc_boxes(df, "t", "id", F.lit(100.0), F.lit(100.0)).collect()
    assert sorted(((r.cx, r.cy, r.w, r.h, r.error) for r in got), key=repr) == sorted([(0.2, 0.4, 0.2, 0.4, None), (None, None, None, None, "bad_corner")], key=repr)


USUAL_OBJECT = "<object>\r\n\t<name> drone </name><pose>x</pose><bndbox>\n<xmin>10</xmin><ymin> 20</ymin><xmax>30</xmax>\n<ymax>60</ymax></bndbox></object>\n"
USUAL = "<annotation>\n<filename>\u00e9 [$1]\\.jpg</filename><source><database>d</database></source><size><width>9</width></size>" + USUAL_OBJECT + "<object><name>drone</name><bndbox><ymax>4</ymax></bndbox></object><object><name>bird</name><bndbox></bndbox></object></annotation>\n"
ODD = ["<!-- c -->", "<!-- <object>", "<![CDATA[drone]]>", "&amp;", "&#49;", "&no;", "]]>", "]", ">", "<", "<x/>", "<x>", "x", "\x01", "\x01drone<1<2<3<4<", "\n", " a='1'", "<object/>", "</object>", "<name>bird</name>", "<xmin>7</xmin>", "<NAME>bird</NAME>", "<?p?>", "\u2003", "<bndbox><ymax>5</ymax></bndbox>", USUAL_OBJECT]


def test_usual_voc_documents_need_no_parser(spark, monkeypatch):
    monkeypatch.setattr(annotations.F, "from_xml", lambda text, kind: F.raise_error(F.lit("parsed")).cast(kind))
    docs = [("a", USUAL), ("b", "<annotation></annotation>"), ("c", f"<annotation>{USUAL_OBJECT * 20000}</annotation>")]
    got = [(r.id, r.cx, r.cy, r.w, r.h, r.error) for r in annotations.voc_boxes(spark.createDataFrame(docs, "id string, t string"), "t", "id", F.lit(100.0), F.lit(100.0)).collect()]
    box = (0.2, 0.4, 0.2, 0.4, None)
    assert sorted(got, key=repr) == sorted([("a", *box), ("a", None, None, None, None, "bad_corner"), *[("c", *box)] * 20000], key=repr)


def test_voc_patterns_agree_with_the_parser(spark, monkeypatch):
    places = sorted({i for i, c in enumerate(USUAL) if c in "<>" or USUAL[i - 1] == ">"} | {0, len(USUAL), USUAL.index("drone") + 2, USUAL.index("10") + 1})
    docs = [USUAL, None, "", *(USUAL[:i] + odd + USUAL[i:] for odd in ODD for i in places), *(USUAL[:i] + USUAL[i + 1 :] for i in range(len(USUAL)))]
    df = spark.createDataFrame(list(enumerate(docs)), "i int, t string").repartition(8)
    boxes = lambda: sorted((tuple(r) for r in annotations.voc_boxes(df, "t", "i", F.lit(100.0), F.lit(100.0)).collect()), key=repr)
    fast = boxes()
    monkeypatch.setattr(annotations, "_PLAIN", "(?!)")
    assert fast == boxes()


def test_pixel_rows_and_aliases(spark):
    df = spark.createDataFrame([(1, "f,1,2,3,4,x"), (2, "f,0,0,0,0"), (3, "f,1,2"), (4, "f,a,2,3,4")], "i int, l string")
    assert [r.status for r in annotations.pixel_rows(df, "l", "i").orderBy("i").collect()] == ["box", "negative", "malformed", "malformed"]
    csv = spark.createDataFrame([("3", "1", " 10", "5", "30", "9")], "Index string, present string, left string, top string, right string, bottom string")
    r = annotations.resolve_aliases(csv).first()
    assert (r.frame, r.exist, r.x, r.y, r.width, r.height) == (3.0, 1.0, 10.0, 5.0, 20.0, 4.0)
    with pytest.raises(ValueError):
        annotations.resolve_aliases(spark.createDataFrame([("1",)], "x string"))


def test_archives(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.bin", "w") as z:
        z.writestr("x/y.txt", "hello")
    (tmp_path / "b.rar").write_bytes(b"Rar!\x1a\x07\x00")
    found = files.scan_files(spark, str(tmp_path), ("bin", "rar"), content=True)
    kinds = {r.path.rsplit("/", 1)[1]: r.k for r in found.select("path", files.archive_type(F.col("content")).alias("k")).collect()}
    assert kinds == {"a.bin": "zip", "b.rar": "rar"}
    assert [(r.member, r.size) for r in files.zip_members(found.where("path like '%.bin'")).collect()] == [("x/y.txt", 5)]


def test_manifest_round_trip(spark, tmp_path):
    row = ("images/train/ab/s_ab.png", "train", "s", 'o,"x"', "ab", "0", "g", None, 3, 4, 1, "", "{}")
    sinks.write_manifest(spark.createDataFrame([row], files.MANIFEST), f"{tmp_path}/m")
    back = files.read_manifest(spark, f"{tmp_path}/m").first()
    assert back.original == 'o,"x"' and back.boxes == 1 and back.source_split is None


def test_small_helpers(spark):
    assert files.read_yaml("path: d\ntrain: a\nval:\n  - b\n  - c\nnames:\n  0: drone\n  1: bird\n")["val"] == ["b", "c"]
    assert files.class_names(files.read_yaml("names: [drone, 'bird']")) == {0: "drone", 1: "bird"}
    log = spark.createDataFrame([("Epoch: [3]  [ 10/200] loss",), ("Test:  [ 4/50] x",), ("other",)], "l string")
    assert [(r.phase, r.epoch, r.batch) for r in files.trainer_lines(log, "l").collect()] == [("train", 3, 10), ("test", None, 4), (None, None, None)]
    jpeg = spark.createDataFrame([(b"\xff\xd8x",), (b"\xff\xd8\xff\xd9",)], "c binary")
    assert [bytes(r.o) for r in jpeg.select(sinks.repaired_jpeg(F.col("c")).alias("o")).collect()] == [b"\xff\xd8x\xff\xd9", b"\xff\xd8\xff\xd9"]
    boxes = spark.sql("SELECT array(named_struct('cx', 0.5D, 'cy', 0.25D, 'w', 0.125D, 'h', 1D)) AS b")
    assert boxes.select(sinks.label_text(F.col("b")).alias("t")).first().t == "0 0.50000000 0.25000000 0.12500000 1.00000000"


def test_coco_document(spark):
    import json

    rows = spark.createDataFrame([("val", "i", 1, 0.5, 0.5, 0.5, 0.5, 100.0, 200.0)], "split string, image string, line int, cx double, cy double, w double, h double, width double, height double")
    doc = package.coco_document(package.coco_ids(rows, "split", "image", ["line"]), "split").first().document
    d = json.loads(doc)
    assert d["annotations"][0]["bbox"] == [25.0, 50.0, 50.0, 100.0] and d["images"][0]["file_name"] == "i"


def test_incremental_stream(spark, tmp_path):
    from gleanery.streaming import incremental

    schema = "o long, h string"
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], schema).write.parquet(f"{tmp_path}/in/1")
    stream = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
    incremental.ingest(stream(), f"{tmp_path}/known", "h", "o", f"{tmp_path}/state")
    spark.createDataFrame([(4, "b"), (5, "c")], schema).write.parquet(f"{tmp_path}/in/2")
    incremental.ingest(stream(), f"{tmp_path}/known", "h", "o", f"{tmp_path}/state")
    assert sorted(r.h for r in spark.read.parquet(f"{tmp_path}/known").collect()) == ["a", "b", "c"]


def test_edits_undos_and_redos(spark):
    import random

    from gleanery.operators import ledger

    rng = random.Random(6)
    rows = [(s, rng.randrange(3), i, rng.choice(["edit", "edit", "undo", "redo"]), float(i)) for s in range(6) for i in range(40)]
    want = {}
    for s in range(6):
        held, done, undone = [{}], [], []  # whole states, one after the other
        for _, c, _, op, v in (r for r in rows if r[0] == s):
            if op == "edit":
                held.append(held[-1] | {c: v})
                undone = []
            elif op == "undo" and len(held) > 1:
                undone.append(held.pop())
            elif op == "redo" and undone:
                held.append(undone.pop())
        want |= {(s, c): v for c, v in held[-1].items()}
    got = ledger.edited(spark.createDataFrame(rows, "s long, c long, i long, op string, v double").repartition(5), "s", "c", "i", "op", "v")
    assert {(r.s, r.c): r.v for r in got.collect()} == want


def brute_nearest(rows, most, top=3):
    out = []
    for s, i, w, r in rows:
        if w is None or s is None or r is None:
            continue
        near = []
        for t, j, v, q in rows:
            if v is not None and t is not None and q is not None and t < s and abs(q - r) <= 0.02 * max(q, r):
                d = sum((x ^ y).bit_count() for x, y in zip(v, w))
                if d <= most:
                    near.append((d, t, j))
        out += [(d, t, j, s, i) for d, t, j in sorted(near)[:top]]
    return sorted(out)


def hash_rows(rng, n, size=16):
    centres = [[rng.getrandbits(32) for _ in range(size)] for _ in range(8)]
    rows = []
    for i in range(n):
        w = list(rng.choice(centres))
        for _ in range(rng.choice([0, 0, 1, 5, 11, 20, 45, 80])):
            k = rng.randrange(32 * size)
            w[k // 32] ^= 1 << k % 32
        rows.append((rng.choice("abcd"), i, w, rng.choice([1.0, 1.0, 1.01, 1.5])))
    return rows + [("a", n, None, 1.0), (None, n + 1, centres[0], 1.0), ("d", n + 2, centres[0], None)]


@pytest.mark.parametrize("most, cell, hot", [(0, 1024, None), (10, 1024, 5), (10, 3, 2), (40, 1024, 10), (50, 7, None), (60, 1024, None), (90, 1024, None), (90, 16, None), (256, 50, None), (512, 1024, None)])
def test_nearest_at_any_distance(spark, most, cell, hot):
    import random

    from gleanery.operators import hamming

    rows = hash_rows(random.Random(most), 260)
    df = spark.createDataFrame(rows, "s string, i long, w array<bigint>, r double").repartition(5)
    got = hamming.nearest(df, "w", 512, "s", "i", "r", most, cell=cell, hot=hot)
    assert sorted(tuple(r) for r in got.collect()) == brute_nearest(rows, most)


@pytest.mark.parametrize("how", [("near", 21, 1), ("near", 14, 2), ("near", 41, 0), ("all", 1, 0), ("equal", 51, 0)])
def test_all_ways_find_the_same(spark, monkeypatch, how):
    import random

    from gleanery.operators import hamming

    rows = hash_rows(random.Random(5), 200)
    monkeypatch.setattr(hamming, "plan", lambda *_: how)
    got = hamming.nearest(spark.createDataFrame(rows, "s string, i long, w array<bigint>, r double"), "w", 512, "s", "i", "r", 40)
    assert sorted(tuple(r) for r in got.collect()) == brute_nearest(rows, 40)


def test_ways_by_distance_and_size():
    from gleanery.operators import hamming

    assert hamming.plan(512, 10, 1000)[0] == hamming.plan(512, 50, 10**9)[0] == "equal"
    assert hamming.plan(512, 60, 10**6)[0] == "near" and hamming.plan(512, 512, 10**6)[0] == "all" and hamming.plan(512, 90, 100)[0] == "all"
    for most in range(0, 513):
        how, blocks, radius = hamming.plan(512, most, 10**7)
        assert how == "all" or (blocks > most if how == "equal" else most // blocks <= radius)


def test_hot_blocks_make_no_pairs(spark):
    """A third of the rows share nearly all blocks, another third are copies: cells stay small and each gives three answers a class."""
    import random

    from gleanery.operators import hamming

    rng = random.Random(9)
    flat = [0] * 16
    rows = [("ab"[i % 2], i, flat[:-1] + [rng.getrandbits(32)], 1.0) for i in range(900)] + [("ab"[i % 2], i, flat, 1.0) for i in range(900, 1800)]
    rows += [("ab"[i % 2], i, [rng.getrandbits(32) for _ in range(16)], 1.0) for i in range(1800, 2700)]
    df = spark.createDataFrame(rows, "s string, i long, w array<bigint>, r double")
    got = sorted(tuple(r) for r in hamming.nearest(df, "w", 512, "s", "i", "r", 10, cell=64, hot=50).collect())
    assert got == brute_nearest(rows, 10)
    keyed = df.select(F.when(F.col("s") == "a", 0).otherwise(1).alias("side"), F.col("i").alias("id"), F.lit(1).cast("long").alias("key"))
    cells = hamming._cells(*(keyed.where(F.col("side") == k).select("key", "id") for k in (0, 1)), 64).groupBy("key", "i", "j").count()
    assert cells.agg(F.max("count")).first()[0] < 3 * 64


def test_distances_out_of_range_are_refused(spark):
    df = spark.createDataFrame([(1, "a", [1, 2])], "i long, s string, w array<bigint>")
    for most in (-1, 65):
        with pytest.raises(ValueError):
            dedup.near_duplicates(df, "w", 64, "s", "i", most=most)


def test_dataset_yaml_and_documents(spark):
    from gleanery.operators import report
    from gleanery.sources import files

    text = report.dataset_yaml({"train": "images/train", "val": "images/val"}, {0: "drone", 1: "a: b"})
    assert files.class_names(files.read_yaml(text))[0] == "drone" and 'images/train' in text
    doc = report.one_document(spark.createDataFrame([("b", 2), ("a", 1)], "name string, frames int"), "videos", F.sum("frames").alias("frame_count")).first()[0]
    import json

    assert json.loads(doc) == {"frame_count": 3, "videos": [{"name": "a", "frames": 1}, {"name": "b", "frames": 2}]}


def test_history_is_appended(spark, tmp_path):
    from gleanery.operators import report

    for k in range(2):
        report.append_history(spark.createDataFrame([(f"run{k}", k)], "command string, exit_code int"), f"{tmp_path}/history")
    assert {r.command for r in spark.read.json(f"{tmp_path}/history").collect()} == {"run0", "run1"}


def test_image_headers():
    import struct

    from gleanery.sources.images import header

    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"ab" + b"\xff\xff\xc2" + struct.pack(">HBHH", 11, 8, 480, 640) + b"\x01\x01\x11\x00"
    assert header(jpeg) == ("JPEG", 640, 480) and header(jpeg[:14]) == (None, None, None)
    lossy = b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 320, 200)
    extended = b"RIFF\0\0\0\0WEBPVP8X\0\0\0\0\0\0\0\0" + (99).to_bytes(3, "little") + (49).to_bytes(3, "little")
    assert header(lossy) == ("WEBP", 320, 200) and header(extended) == ("WEBP", 100, 50)
    tiff = b"II*\0" + struct.pack("<IH", 8, 2) + struct.pack("<HHIHH", 256, 3, 1, 70, 0) + struct.pack("<HHII", 257, 4, 1, 30)
    assert header(tiff) == ("TIFF", 70, 30)
    assert header(b"BM" + b"\0" * 12 + struct.pack("<Iii", 40, 12, -9)) == ("BMP", 12, 9)
    assert header(b"") == header(b"plain text") == (None, None, None)


def test_long_numbers_never_abort(spark):
    one = lambda c, *names: spark.createDataFrame([(n,) for n in names], "n string").select(c.alias("o")).collect()
    n = F.col("n")
    assert [r.o for r in one(K.frame_number(n), "frame_99999999999.jpg", "frame_7_x", "still")] == [None, 7, None]
    assert [tuple(r.o) for r in one(K.rar_volume(n), "a.part99999999999.rar", "a.part0001.rar", "a.part02.rar", "a.rar", "a.r00", "a.zip")] == [(None, True), (1, False), (2, True), (1, False), (2, True), (None, False)]
    assert [r.o for r in one(K.shard_number(n, "train"), "shards/train-99999999999.tar", "shards/train-00012.tar")] == [None, 12]
    log = spark.createDataFrame([("Epoch: [3]  [99999999999/5]",)], "l string")
    assert [(r.phase, r.epoch, r.batch, r.batches) for r in files.trainer_lines(log, "l").collect()] == [("train", 3, None, 5)]


@pytest.mark.parametrize("digits", ["123456789012345678901234", "123456789012345678901236", "9" * 60, "1" + "0" * 18, "5", "6", "000000000000000000000003"])
def test_stride_of_any_length(spark, digits):
    from gleanery.sources import scans

    got = spark.createDataFrame([(f"a_{digits}",), ("a",), ("a_5x",)], "s string").select(scans.on_stride(F.col("s")).alias("o")).collect()
    assert [r.o for r in got] == [int(digits) % 3 == 0, True, True]


def test_only_plain_finite_numbers_are_boxes(spark):
    lines = ["n,nan,1d,3,4", "n,inf,1,2,3", "n,1e999,1,2,3", "n,1_0,1,2,3", "n, 1e2 ,+1,.5,3."]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, l string")
    assert [(r.status, r.x) for r in annotations.pixel_rows(df, "l", "i").orderBy("i").collect()] == [("malformed", None)] * 4 + [("box", 100.0)]
    xml = "<annotation><object><name>drone</name><bndbox><xmin>{}</xmin><ymin>{}</ymin><xmax>30</xmax><ymax>60</ymax></bndbox></object></annotation>"
    docs = spark.createDataFrame([(i, xml.format(*c)) for i, c in enumerate([("inf", "1"), ("1", "2d"), ("1e999", "1"), ("NaN", "1"), ("10", "20")])], "i int, t string")
    assert [r.error for r in annotations.voc_boxes(docs, "t", "i", F.lit(100.0), F.lit(100.0)).orderBy("i").collect()] == ["bad_corner"] * 4 + [None]


def test_voc_image_by_name_or_stem(spark):
    doc = "<annotation><filename>{}</filename></annotation>"
    docs = spark.createDataFrame([("a/1.xml", doc.format("x.jpg")), ("a/2.xml", doc.format("gone.jpg")), ("a/3.xml", "<annotation/>"), ("a/4.xml", doc.format("gone.jpg")), ("2.xml", "no xml")], "path string, t string")
    images = spark.createDataFrame([("a/x.jpg",), ("a/1.png",), ("a/2.PNG",), ("a/2.jpg",), ("a/3.txt",), ("b/4.jpg",), ("2.jpg",)], "path string")
    assert {r.path: r.image for r in annotations.voc_images(docs, images, "t", "path").collect()} == {"a/1.xml": "a/x.jpg", "a/2.xml": "a/2.PNG", "a/3.xml": None, "a/4.xml": None, "2.xml": "2.jpg"}


def test_positions_follow_path_parts(spark):
    from pathlib import PurePosixPath

    paths = ["a-b/x", "a/x", "a/b/c", "a.b/x", "a", "b"]
    got = ledger.frame_positions(spark.createDataFrame([("s", p) for p in paths], "s string, p string"), "s", "p").orderBy("position").collect()
    assert [r.p for r in got] == [str(p) for p in sorted(map(PurePosixPath, paths))]


def test_last_record_is_the_original(spark):
    state = spark.createDataFrame([("1", "z.zip", "m", "ingested", 1), ("2", "a.zip", "m", "ingested", 2)], "drive_id string, path string, md5 string, status string, seq int")
    now = spark.createDataFrame([("3", "n.zip", "m", "")], "drive_id string, path string, md5 string, suffix string")
    again = spark.createDataFrame([("2", "b.zip", "m", ""), ("1", "z.zip", "m", "")], "drive_id string, path string, md5 string, suffix string")
    assert [r.action for r in ledger.listing_diff(now, state).collect()] == ["duplicate"]
    failed = state.replace("ingested", "new", "status")
    assert {r.drive_id: r.action for r in ledger.listing_diff(again, failed).collect()} == {"2": "again", "1": "duplicate"}


@pytest.mark.parametrize("digits", [0, 3, 6, 8])
def test_rounding_is_that_of_the_exact_value(spark, digits):
    import random

    from gleanery.functions.rounding import rounded

    rng = random.Random(digits)
    values = [rng.uniform(-1000, 1000) for _ in range(6000)] + [(2 * rng.randrange(-(10**6), 10**6) + 1) / 2 / 10**digits for _ in range(8000)]
    values += [rng.randrange(-(10**4), 10**4) / 2**k for k in range(1, 12) for _ in range(500)] + [math.nextafter(v, d) for v in (0.5, 1.5, 2.5, 0.0005, 0.0015, 1.0000005, 2.675, 1.005) for d in (-math.inf, math.inf)]
    values += [0.0, -0.0, 2.675, 1.005, 1e15 + 0.3, 2.0**52 + 0.5, 2.0**53 + 2, 1e22, -1e300, 5e-324, 2.0**52 / 10**digits + 0.5 / 10**digits]
    got = [r.o for r in spark.createDataFrame([(v,) for v in values], "v double").select(rounded(F.col("v"), digits).alias("o")).collect()]
    assert got == [round(v, digits) for v in values]
    odd = spark.createDataFrame([(math.nan,), (math.inf,), (None,)], "v double").select(rounded(F.col("v"), digits).alias("o")).collect()
    assert math.isnan(odd[0].o) and odd[1].o == math.inf and odd[2].o is None


def test_hot_keys_are_carried_over_ranges(spark):
    """One key has half of all rows: no range gets much more than its share, and all are as one window would have them."""
    import random

    from pyspark.sql import Window

    from gleanery.operators import ordered

    rng = random.Random(2)
    rows = [("hot" if rng.random() < 0.5 else rng.choice(["a", "b", None]), rng.randrange(500), i, rng.choice([None, None, i])) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, t int, i int, v int").repartition(6)
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranged = ordered.in_ranges(df, "k", F.col("t"), F.col("i"))
        sizes = [r["count"] for r in ranged.groupBy("_part").count().collect()]
        assert len(sizes) > 8 and max(sizes) < 2.5 * 4000 / len(sizes)
        w = Window.partitionBy("k").orderBy("t", "i")
        plain = df.select("*", F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("a"), F.first("v", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("b"), F.lead(F.struct("t", "v")).over(w).alias("n"))
        want = sorted(plain.collect(), key=repr)
        assert sorted(ordered.last_so_far(ranged, "k", "v", "a").select("k", "t", "i", "v", "a").collect(), key=repr) == sorted((r[:5] for r in want), key=repr)
        ahead = ordered.first_from_here(ranged, "k", "v", "b").select("i", "b").collect()
        assert sorted(tuple(r) for r in ahead if r.b is not None) == sorted((r.i, r.b) for r in want if r.b is not None) and len(ahead) == 4000
        following = ordered.next_row(ranged, "k", F.struct("t", "v"), "n").select("i", "n").collect()
        assert {r.i: r.n for r in following} == {r.i: r.n for r in want}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("most", [20, 200, 256])
def test_large_runs_are_compared_densely(spark, most):
    """Runs of many rows of either side, in tiles, give the same neighbours as small ones pair by pair; and what tells the hashes is computed once."""
    rng, calls = random.Random(7), spark.sparkContext.accumulator(0)
    base = [rng.getrandbits(512) for _ in range(4)]
    some = [rng.choice(base) ^ sum(1 << rng.randrange(512) for _ in range(rng.randrange(60))) for _ in range(600)]
    rows = [(f"s{rng.randrange(5)}", i, [h >> 32 * (15 - k) & 0xFFFFFFFF for k in range(16)]) for i, h in enumerate(some)]
    df = spark.createDataFrame(rows, "s string, i long, t array<bigint>")

    def words(t):
        calls.add(1)
        return t

    df = df.withColumn("w", F.udf(words, "array<bigint>").asNondeterministic()("t"))
    got = hamming.nearest(df, "w", 512, "s", "i", most=most)
    want = []
    for (s, i, _), h in zip(rows, some):
        near = sorted(((h ^ g).bit_count(), a, j) for (a, j, _), g in zip(rows, some) if a < s and (h ^ g).bit_count() <= most)[:3]
        want += [(d, a, j, s, i) for d, a, j in near]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert calls.value == len(rows)


def test_label_lines_are_parsed_once(spark):
    """A condition on what a line says must not parse it anew for each mention of a number."""
    rows = spark.createDataFrame([("0 0.5 0.5 0.1 0.1\n0 2 0.5 0.1 0.1\n0 x 0.5 0.1 0.1",)], "text string")
    lines = quality.parse_label_lines(rows, "text")
    bad = quality.box_errors(*map(F.col, ("class_value", "cx", "cy", "w", "h")), [0])
    some = lines.where(F.size(bad) > 0).where("status != 'malformed'")
    assert [r.line for r in some.collect()] == [2]
    assert some._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def some_words(rng, centres, n, most):
    words = [list(rng.choice(centres)) for _ in range(n)]
    for w in words:
        for _ in range(rng.randrange(most)):
            k = rng.randrange(32 * len(w))
            w[k // 32] ^= 1 << k % 32
    return words


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_words_that_differ_little_agree_in_a_half(threshold):
    import itertools

    import numpy as np

    one = np.uint32(1) << np.arange(32, dtype=np.uint32)
    missed = [{i for i, x in enumerate(hamming._halves(one, u)[c]) if x} for u, c in hamming._halvings(threshold)]
    assert all(len(m) == 16 for m in missed)
    assert all(any(not m & set(bits) for m in missed) for bits in itertools.combinations(range(32), threshold))


@pytest.mark.parametrize("bits, most", [(512, 90), (96, 10), (64, 11), (32, 5)])
def test_halves_of_words_meet_all_that_are_near(monkeypatch, bits, most):
    import numpy as np

    rng, n = random.Random(bits + most), 150
    centres = [[rng.getrandbits(32) for _ in range(bits // 32)] for _ in range(4)]
    a, b = (np.array(some_words(rng, centres, n, most * 2 // 3), np.uint32).T for _ in range(2))
    before = np.sort([rng.randrange(n) for _ in range(n)])
    apart = np.bitwise_count(a[:, :, None] ^ b[:, None, :]).sum(axis=0)
    want = set(zip(*(k.tolist() for k in np.nonzero((apart <= most) & (np.arange(n)[:, None] < before)))))
    for few in (1, 50, 1000):  # side by side, partly, one bucket after the other
        monkeypatch.setattr(hamming, "_FEW", few)
        met = {p for x, y in hamming._meeting(a, b, before, hamming._thresholds(bits, most), 40) for p in zip(x.tolist(), y.tolist())}
        assert want <= met and len(want) > 100
        assert all(x < before[y] for x, y in met)


def test_nearest_by_halves_of_words(spark, monkeypatch):
    """Cells whose rows meet by halves of words give what all pairs give; so many rows are not compared all with all."""
    assert hamming.plan(512, 90, 3 * 10**6)[0] == "cover" and hamming.plan(512, 96, 3 * 10**6)[0] == "all"
    monkeypatch.setattr(hamming, "plan", lambda *_: ("cover", 16, 5))
    monkeypatch.setattr(hamming, "SORTED", -1e9)  # never dearer
    rng = random.Random(90)
    centres = [[rng.getrandbits(32) for _ in range(16)] for _ in range(300)]
    rows = [(rng.choice("abcd"), i, w, rng.choice([1.0, 1.0, 1.01, 1.5])) for i, w in enumerate(some_words(rng, centres, 900, 60))]
    got = hamming.nearest(spark.createDataFrame(rows, "s string, i long, w array<bigint>, r double").repartition(5), "w", 512, "s", "i", "r", 90)
    assert sorted(tuple(r) for r in got.collect()) == brute_nearest(rows, 90)
