"""Difference hashes against plain integer arithmetic and rasters worked out by hand; detection metrics against plain loops."""

import math
import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import detection, visual


def window(x):
    sinc = lambda v: 1.0 if v == 0 else math.sin(v * math.pi) / (v * math.pi)
    return sinc(x) * sinc(x / 3) if -3 <= x < 3 else 0.0


def plain_weights(size, out):
    rows = []
    for i in range(out):
        scale = size / out
        wide, centre = max(scale, 1.0), (i + 0.5) * scale
        first, last = max(int(centre - wide * 3 + 0.5), 0), min(int(centre + wide * 3 + 0.5), size)
        w = [window((j - centre + 0.5) / wide) for j in range(first, last)]
        rows.append((first, [int(v / sum(w) * (1 << 22) + (0.5 if v >= 0 else -0.5)) for v in w]))
    return rows


def plain_line(line, by):
    return [min(max((1 << 21) + sum(p * k for p, k in zip(line[a:], ks)) >> 22, 0), 255) for a, ks in by]


def plain_grid(lines, across, down):
    thin = [plain_line(x, plain_weights(len(lines[0]), across)) for x in lines]
    return list(zip(*(plain_line(list(c), plain_weights(len(lines), down)) for c in zip(*thin))))


def plain_hash(lines):
    a, b = plain_grid(lines, 17, 16), plain_grid(lines, 16, 17)
    bits = [a[y][x] > a[y][x + 1] for y in range(16) for x in range(16)] + [b[y][x] > b[y + 1][x] for y in range(16) for x in range(16)]
    return f"{int(''.join('01'[b] for b in bits), 2):0128x}"


TURNED = {
    1: lambda m: m, 2: lambda m: [r[::-1] for r in m], 3: lambda m: [r[::-1] for r in m[::-1]], 4: lambda m: m[::-1], 5: lambda m: [list(c) for c in zip(*m)],
    6: lambda m: [list(c) for c in zip(*m[::-1])], 7: lambda m: [list(c)[::-1] for c in zip(*m)][::-1], 8: lambda m: [list(c) for c in zip(*m)][::-1],
}


def hashed(spark, rows):
    df = spark.createDataFrame(rows, "i int, pixels array<int>, width int, height int, o int")
    return {r.i: r for r in visual.difference_hash(df, orientation="o").collect()}


def test_hashes_of_any_size_and_orientation(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i, (w, h) in enumerate([(1, 1), (2, 3), (16, 16), (17, 16), (16, 17), (40, 23), (23, 70), (4, 4)] * 2):
        m = [[rng.randrange(256) for _ in range(w)] for _ in range(h)]
        o = rng.choice([None, 0, *range(1, 9)]) if i < 8 else i % 8 + 1
        rows.append((i, [p for r in m for p in r], w, h, o))
        want[i] = plain_hash(TURNED.get(o, TURNED[1])(m))
    got = hashed(spark, rows)
    assert {i: r.visual_hash for i, r in got.items()} == want
    assert all("".join(f"{w:08x}" for w in r.words) == r.visual_hash for r in got.values())


def test_hashes_by_hand(spark):
    flat, falling, rising = [7] * 16, [200, 150, 100, 50] * 4, [0, 80, 160, 240] * 4
    down = [p for p in (240, 160, 80, 0) for _ in range(4)]
    got = hashed(spark, [(0, flat, 4, 4, 1), (1, falling, 4, 4, 1), (2, rising, 4, 4, 1), (3, down, 4, 4, 1), (4, rising, 4, 4, 3), (5, down, 4, 4, 6)])
    zero, ones = "0" * 64, "f" * 64
    bits = lambda i, half: f"{int(got[i].visual_hash[64 * half : 64 * half + 64], 16):0256b}"
    assert got[0].visual_hash == zero + zero
    # samples at the edges overshoot to one value and ring, so a few bits are off; every line is the same
    for i, half in ((1, 0), (3, 1)):
        assert bits(i, half).count("1") > 200 and got[i].visual_hash[64 * (1 - half) : 64 * (1 - half) + 64] == zero
    assert bits(2, 0).count("1") < 40 and got[2].visual_hash[64:] == zero
    assert got[4].visual_hash == got[1].visual_hash or bits(4, 0).count("1") > 200
    assert ones != zero and bits(5, 0).count("1") < 40  # what fell downwards rises to the right when turned clockwise


def test_rasters_that_do_not_fit(spark):
    got = hashed(spark, [(0, [1, 2, 3], 2, 2, 1), (1, None, 2, 2, 1), (2, [1, 2, 3, None], 2, 2, 1), (3, [1, 2, 3, 256], 2, 2, 1), (4, [1, 2, 3, 4], None, 2, 1), (5, [], 0, 0, 1), (6, [-1] * 4, 2, 2, 1)])
    assert all(r.visual_hash is None and r.words is None for r in got.values())


def test_luminance(spark):
    rows = [(255, 255, 255), (0, 0, 0), (255, 0, 0), (0, 255, 0), (0, 0, 255), (12, 34, 56)]
    got = spark.createDataFrame(rows, "r int, g int, b int").select(visual.luminance(F.col("r"), F.col("g"), F.col("b")).alias("l")).collect()
    assert [r.l for r in got] == [(r * 19595 + g * 38470 + b * 7471 + 32768) >> 16 for r, g, b in rows]


def iou(a, b):
    w, h = max(min(a[2], b[2]) - max(a[0], b[0]), 0.0), max(min(a[3], b[3]) - max(a[1], b[1]), 0.0)
    area = lambda r: max(r[2] - r[0], 0.0) * max(r[3] - r[1], 0.0)
    u = area(a) + area(b) - w * h
    return w * h / u if u > 0 else 0.0


def plain_average_precision(truth, found, least):
    out = {}
    for c in {x[1] for x in truth} | {x[1] for x in found}:
        hits, taken = [], set()
        for image, _, pred, score, box in sorted((x for x in found if x[1] == c and x[3] is not None), key=lambda x: (-x[3], x[0], x[2])):
            offers = sorted((-iou(box, t[3]), t[2]) for t in truth if t[0] == image and t[1] == c and (image, t[2]) not in taken)
            ok = bool(offers) and -offers[0][0] * 100 >= least
            if ok:
                taken.add((image, offers[0][1]))
            hits.append(ok)
        n = sum(x[1] == c for x in truth)
        points = [(sum(hits[: k + 1]), sum(hits[: k + 1]) / (k + 1)) for k in range(len(hits))]
        best = [max((p for tp, p in points if tp * 100 >= k * n), default=0.0) for k in range(101)]
        out[c] = (n, sum(x[1] == c for x in found), sum(hits), sum(best) / 101 if n else None)
    return out


def test_average_precision(spark):
    rng = random.Random(8)
    box = lambda: (lambda x, y, w, h: (x, y, x + w, y + h))(rng.random(), rng.random(), rng.random() / 2, rng.random() / 2)
    truth, found = [], []
    for image in range(60):
        for k in range(rng.randrange(6)):
            b = box()
            truth.append((image, rng.randrange(2), k, b))
            for m in range(rng.randrange(3)):
                d = rng.choice([0.0, 0.01, 0.05])
                found.append((image, truth[-1][1], 100 * k + m, rng.choice([None, 0.5, 0.9, rng.random()]), (b[0] + d, b[1], b[2] + d, b[3])))
        found.append((image, rng.randrange(4), 9999, rng.random(), box()))
    truth.append((1000, 7, 0, box()))  # a class that nothing was found of
    kind = "box struct<x1:double,y1:double,x2:double,y2:double>"
    got = detection.average_precision(spark.createDataFrame(truth, f"image int, class int, truth int, {kind}").repartition(3), spark.createDataFrame(found, f"image int, class int, pred int, score double, {kind}").repartition(5))
    rows = got.collect()
    assert {r.overlap for r in rows} == set(detection.OVERLAPS)
    for least in detection.OVERLAPS:
        want = plain_average_precision(truth, found, least)
        mine = {r["class"]: (r.truths, r.predictions, r.matched, r.ap) for r in rows if r.overlap == least}
        assert mine.keys() == want.keys()
        for c in want:
            assert mine[c][:3] == want[c][:3] and (mine[c][3] == want[c][3] or math.isclose(mine[c][3], want[c][3], rel_tol=1e-12)), (least, c)
    m = detection.mean_average_precision(got).first()
    assert 0 < m.map50_95 < m.map50 < 1


@pytest.mark.parametrize("empty", ["truth", "found"])
def test_metrics_of_nothing(spark, empty):
    kind = "box struct<x1:double,y1:double,x2:double,y2:double>"
    truth = spark.createDataFrame([] if empty == "truth" else [(1, 0, 0, (0.0, 0.0, 1.0, 1.0))], f"image int, class int, truth int, {kind}")
    found = spark.createDataFrame([] if empty == "found" else [(1, 0, 0, 0.5, (0.0, 0.0, 1.0, 1.0))], f"image int, class int, pred int, score double, {kind}")
    assert {(r.matched, r.ap) for r in detection.average_precision(truth, found).collect()} == {(0, None if empty == "truth" else 0.0)}


def test_matches_within_tasks_of_any_batches(spark):
    """Groups cut by batches, rivals for one true box, rows without image, score or box: the same as choosing one after the other."""
    rng = random.Random(3)
    place = lambda: (x := rng.randrange(4), y := rng.randrange(4), x + rng.randrange(1, 6), y + rng.randrange(1, 6))
    truth = [(i // 7 if i % 50 else None, i % 2, i, tuple(map(float, place()))) for i in range(300)]
    found = [(i // 9 if i % 40 else None, i % 2, i, [0.1, 0.5, 0.9, None, float("nan")][rng.randrange(5)], tuple(map(float, place())) if i % 31 else None) for i in range(400)]
    box = "struct<x1: double, y1: double, x2: double, y2: double>"
    frames = spark.createDataFrame(truth, f"image int, class int, truth int, box {box}"), spark.createDataFrame(found, f"image int, class int, pred int, score double, box {box}")

    def iou(a, b):
        side = lambda k: max(min(a[k + 2], b[k + 2]) - max(a[k], b[k]), 0.0)
        area = lambda r: (r[2] - r[0]) * (r[3] - r[1])
        return side(0) * side(1) / (area(a) + area(b) - side(0) * side(1))

    want = {}
    for least in detection.OVERLAPS:
        taken = set()
        for image, kind, pred, score, b in sorted((f for f in found if f[3] is not None and f[3] == f[3]), key=lambda f: (-f[3], f[2])):
            offers = sorted((-iou(b, t[3]), t[2]) for t in truth if b and image is not None and t[:2] == (image, kind) and iou(b, t[3]) * 100 >= least and t[2] not in taken)
            taken |= {offers[0][1]} if offers else set()
            want.setdefault(pred, []).append(int(bool(offers)))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), detection.PAIRS
    try:
        for size, detection.PAIRS in ((1, 1), (7, 5), (10000, 1 << 20)):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert {r.pred: r.hits for r in detection.matches(*frames).collect()} == want
    finally:
        detection.PAIRS = before[1]
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before[0])
    assert 0 < sum(map(sum, want.values()))


def test_detection_plan_matches_once(spark):
    """Matching is one shuffle of boxes, without a join of true boxes and predictions, and runs no lambda for an overlap."""
    box = "struct<x1: double, y1: double, x2: double, y2: double>"
    frames = spark.createDataFrame([], f"image int, class int, truth int, box {box}"), spark.createDataFrame([], f"image int, class int, pred int, score double, box {box}")
    plan = detection.matches(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "lambda" not in plan
