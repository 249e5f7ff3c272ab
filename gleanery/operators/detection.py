"""Detection metrics: matches of predicted and true boxes within an image, and average precision over all images."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import kept, ship

#: The overlaps at which a prediction counts, in hundredths, and the steps of recall at which precision is read.
OVERLAPS = tuple(range(50, 100, 5))
STEPS = 100
#: Pairs of boxes that a task compares at once, and classes of which it holds the best precisions.
PAIRS = 1 << 21
MOST_CLASSES = 1000


def overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of boxes, rows x1, y1, x2, y2; 0 where one has no area or lacks a side."""
    side = lambda k: np.maximum(np.minimum(a[:, k + 2], b[:, k + 2]) - np.maximum(a[:, k], b[:, k]), 0.0)
    area = lambda r: np.maximum(r[:, 2] - r[:, 0], 0.0) * np.maximum(r[:, 3] - r[:, 1], 0.0)
    both = side(0) * side(1)
    union = area(a) + area(b) - both
    return np.divide(both, union, out=np.zeros(len(a)), where=union > 0)


def _changes(columns: list) -> np.ndarray:
    """Whether each row but the first differs from the one before in one of the columns; nulls differ from all."""
    out = np.zeros(max(len(columns[0]) - 1, 0), bool)
    for c in columns:
        out |= np.asarray(pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)), True).to_numpy(zero_copy_only=False), bool)
    return out


def _hits(start: np.ndarray, true: np.ndarray, box: np.ndarray) -> np.ndarray:
    """For each row, of which those without a box match nothing, a bit for each of OVERLAPS: that of a prediction tells that it has a true box. Groups begin at `start`; in each the true boxes come first, then the predictions as they choose."""
    out = np.zeros(len(true), np.int32)
    size = np.diff(np.append(start, len(true)))
    truths = np.add.reduceat(true.astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    first, many = np.repeat(start, size), np.where(true, 0, np.repeat(truths, size))
    rows = np.flatnonzero(many)
    ends = np.cumsum(many[rows])
    found: list[tuple] = []
    at = 0
    while at < len(rows):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        n = many[rows[at:stop]]
        p = np.repeat(rows[at:stop], n)
        t = np.repeat(first[rows[at:stop]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        iou = overlap(box[p], box[t])
        good = iou * 100 >= OVERLAPS[0]
        found.append((p[good], t[good], iou[good]))
        at = stop
    if not found:
        return out
    p, t, iou = (np.concatenate(x) for x in zip(*found))
    best = np.zeros(len(true))
    np.maximum.at(best, p, iou)
    for i, k in enumerate(OVERLAPS):
        out |= (best * 100 >= k).astype(np.int32) << i
    # where two predictions would have the same true box, they choose one after the other
    rivals = np.zeros(len(true), bool)
    rivals[p[(np.bincount(t, minlength=len(true)) > 1)[t]]] = True
    p, t, iou = p[rivals[p]], t[rivals[p]], iou[rivals[p]]
    out[p] = 0
    order = np.lexsort((t, -iou, p))
    p, t, iou = p[order].tolist(), t[order].tolist(), iou[order].tolist()
    for i, k in enumerate(OVERLAPS):
        taken, last = set(), -1
        for q, u, x in zip(p, t, iou):
            if q != last and x * 100 >= k and u not in taken:
                taken.add(u)
                last = q
                out[q] |= 1 << i
    return out


def _match(names: list[str]):
    """Rows of whole groups, in order, to predictions with their bits; a group that a batch cuts waits for the next one."""

    def told(table: pa.Table):
        start = np.append(0, np.flatnonzero(_changes([table.column("image"), table.column("class")])) + 1)
        true = np.asarray(table.column("_true").to_numpy(), bool)
        box = np.column_stack([table.column(c).to_numpy() for c in ("_x1", "_y1", "_x2", "_y2")])
        yield from table.select(names).append_column("_bits", pa.array(_hits(start, true, box), pa.int32())).combine_chunks().to_batches()

    def run(batches):
        waiting: list = []
        for batch in batches:
            if not len(batch):
                continue
            keys = [batch.column("image"), batch.column("class")]
            begun = np.flatnonzero(_changes(keys))
            new = not waiting or any(not pc.equal(pa.array(w), pa.array(k)).to_pylist()[0] for w, k in zip(([waiting[-1].column(c)[-1]] for c in ("image", "class")), ([k[0]] for k in keys)))
            if waiting and (new or len(begun)):
                cut = 0 if new and not len(begun) else int(begun[-1]) + 1
                yield from told(pa.Table.from_batches([*waiting, batch.slice(0, cut)]).combine_chunks())
                waiting = [batch.slice(cut)]
            else:
                waiting.append(batch)
        if waiting:
            yield from told(pa.Table.from_batches(waiting).combine_chunks())

    return run


def _scored():
    return F.col("score").isNotNull() & ~F.isnan("score")


def _matched(truth: DataFrame, found: DataFrame) -> DataFrame:
    """_true, class, image, pred, score, _bits of each true box (no bits) and of each prediction (none without a score). Boxes of one image and class stand side by side in one order of rows; what a single picture shows bounds them."""
    ship(found.sparkSession)
    keys, sides = ["image", "class"], ["_x1", "_y1", "_x2", "_y2"]
    corner = [F.col(f"box.{c[1:]}").cast("double") for c in sides]
    empty = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    guessed = found.select(*keys, F.lit(False).alias("_true"), "score", "pred", empty(truth, "truth"), *(F.when(_scored(), c).alias(n) for c, n in zip(corner, sides)))
    there = truth.select(*keys, F.lit(True).alias("_true"), empty(found, "score"), empty(found, "pred"), "truth", *(c.alias(n) for c, n in zip(corner, sides)))
    rows = there.unionByName(guessed).repartition(*keys).sortWithinPartitions(*keys, F.desc("_true"), F.desc("score"), "pred", "truth")
    names = ["_true", "class", "image", "pred", "score"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.drop("truth").mapInArrow(_match(names), ", ".join(f"{n} {kinds[n]}" for n in names) + ", _bits int")


def matches(truth: DataFrame, found: DataFrame) -> DataFrame:
    """class, image, pred, score, hits of each prediction: hits (array of 0 and 1) tells for each of OVERLAPS whether it has a true box.

    truth has image, class, truth (a name within the image) and box, found has image, class, pred (likewise), score and box, a box being a struct x1, y1, x2, y2. Of the predictions of one image and class the one of highest score
    chooses first (ties: the smaller pred), and takes of the true boxes that overlap enough and are not taken the one that overlaps most (ties: the smaller name). Predictions without a score never take part.
    """
    bit = [F.shiftright("_bits", i).bitwiseAND(1) for i in range(len(OVERLAPS))]
    return _matched(truth, found).where(~F.col("_true") & _scored()).select("class", "image", "pred", "score", F.array(*bit).alias("hits"))


_COUNTS = [f"h{k}" for k in OVERLAPS]


def _counted(batches):
    """Rows in order of class and rank to their class, rank and hits so far within the task; those without a hit are left out but for the last of a batch."""
    last, n, so_far = None, 0, np.zeros(len(OVERLAPS), np.int64)
    for batch in batches:
        if not len(batch):
            continue
        kind = batch.column("class")
        bits = batch.column("_bits").to_numpy()
        hit = (bits[:, None] >> np.arange(len(OVERLAPS))) & 1
        starts = np.append(0, np.flatnonzero(_changes([kind])) + 1)
        rank, total, keep = np.zeros(len(bits), np.int64), np.zeros(hit.shape, np.int64), bits != 0
        for a, b in zip(starts, [*starts[1:], len(bits)]):
            if last is None or kind[int(a)].as_py() != last:
                last, n, so_far = kind[int(a)].as_py(), 0, np.zeros(len(OVERLAPS), np.int64)
            rank[a:b], total[a:b] = n + np.arange(1, b - a + 1), so_far + np.cumsum(hit[a:b], axis=0)
            n, so_far = n + int(b - a), total[b - 1]
            keep[b - 1] = True
        yield pa.RecordBatch.from_arrays([kind.filter(pa.array(keep)), pa.array(bits[keep], pa.int32()), pa.array(rank[keep]), *(pa.array(total[keep, i]) for i in range(len(OVERLAPS)))], ["class", "_bits", "_n", *_COUNTS])


def _steps(kind: pa.DataType):
    """The best precision of each class, overlap and hundredth of recall, and the most matched, of a task's rows in any order."""

    def run(batches):
        held: dict = {}

        def out():
            rows = [(c, k, step, b[i, step], int(m[i])) for c, (b, m) in held.items() for i, k in enumerate(OVERLAPS) for step in np.flatnonzero(b[i]).tolist()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((kind, pa.int32(), pa.int32(), pa.float64(), pa.int64()))], ["class", "overlap", "step", "best", "matched"])

        for batch in batches:
            coded = batch.column("class").dictionary_encode()
            code, bits, rank, truths = coded.indices.to_numpy(), *(batch.column(c).to_numpy() for c in ("_bits", "rank", "truths"))
            best, most = np.zeros((len(coded.dictionary), len(OVERLAPS), STEPS + 1)), np.zeros((len(coded.dictionary), len(OVERLAPS)), np.int64)
            for i, n in enumerate(_COUNTS):
                hit = (bits >> i) & 1 == 1  # the first rank of a number of matches has its best precision, and is a hit
                matched = batch.column(n).to_numpy()[hit]
                np.maximum.at(best, (code[hit], i, np.floor(matched * STEPS / truths[hit]).astype(np.int64)), matched / rank[hit])
                np.maximum.at(most, (code[hit], i), matched)
            for c, b, m in zip(coded.dictionary.to_pylist(), best, most):
                old = held.get(c)
                held[c] = (b, m) if old is None else (np.maximum(old[0], b), np.maximum(old[1], m))
            if len(held) > MOST_CLASSES:
                yield out()
        yield out()

    return run


def average_precision(truth: DataFrame, found: DataFrame) -> DataFrame:
    """class, overlap (in hundredths), truths, predictions, matched, ap: the mean, over recalls of 0 to 1 by hundredths, of the best precision at that recall or more.

    The order of all predictions by score is dealt out in ranges; each is summed up by itself, the ranges' totals are summed up over the ranges before, and precision
    is read where a prediction is a hit. A class without true boxes has a null ap. No task gets more than a range.
    """
    order = [F.desc("score"), "image", "pred"]
    # written once: a sample tells the ranges, and what is matched should not be done twice
    rows = kept(_matched(truth, found), "matches")
    kind = rows.schema["class"].dataType
    ranged = rows.where(~F.col("_true") & _scored()).repartitionByRange("class", *order).sortWithinPartitions("class", *order).select("class", "_bits").mapInArrow(_counted, f"class {kind.simpleString()}, _bits int, _n long, " + ", ".join(f"{n} long" for n in _COUNTS))
    ranged = kept(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_part", "class").agg(*(F.max(c).alias(c) for c in ("_n", *_COUNTS)))
    before = Window.partitionBy("class").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range and class
    offsets = totals.select("_part", "class", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_n", *_COUNTS)))
    boxes = kept(rows.groupBy("class").agg(F.count_if("_true").alias("truths"), F.count_if(~F.col("_true")).alias("predictions")), "classes")  # a row for each class
    truths = boxes.where("truths > 0").select("class", "truths")
    points = ranged.where("_bits != 0").join(F.broadcast(offsets), ["_part", "class"]).join(F.broadcast(truths), "class")
    points = points.select("class", "_bits", (F.col("_n") + F.col("_n_before")).alias("rank"), "truths", *((F.col(n) + F.col(f"{n}_before")).alias(n) for n in _COUNTS))
    # the best precision of each hundredth of recall, then of all from there on
    steps = points.mapInArrow(_steps(to_arrow_type(kind)), f"class {kind.simpleString()}, overlap int, step int, best double, matched long")
    steps = steps.groupBy("class", "overlap", "step").agg(F.max("best").alias("best"), F.max("matched").alias("matched"))
    by = steps.groupBy("class", "overlap").agg(F.collect_list(F.struct("step", "best")).alias("steps"), F.max("matched").alias("matched"))
    best = lambda k: F.coalesce(F.array_max(F.transform(F.filter("steps", lambda s: s["step"] >= k), lambda s: s["best"])), F.lit(0.0))
    ap = F.aggregate(F.transform(F.sequence(F.lit(0), F.lit(STEPS)), best), F.lit(0.0), lambda t, x: t + x) / (STEPS + 1)
    every = boxes.withColumn("overlap", F.explode(F.array(*map(F.lit, OVERLAPS))))
    out = every.join(by.select("class", "overlap", "matched", ap.alias("ap")), ["class", "overlap"], "left")
    return out.select("class", "overlap", "truths", "predictions", F.coalesce("matched", F.lit(0)).alias("matched"), F.when(F.col("truths") > 0, F.coalesce("ap", F.lit(0.0))).alias("ap"))


def mean_average_precision(by_class: DataFrame) -> DataFrame:
    """map50 and map50_95, over the classes that have true boxes, rounded to four digits."""
    return by_class.agg(F.round(F.avg(F.when(F.col("overlap") == 50, F.col("ap"))), 4).alias("map50"), F.round(F.avg("ap"), 4).alias("map50_95"))
