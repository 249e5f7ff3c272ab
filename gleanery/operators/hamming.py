"""The nearest rows by Hamming distance, for any distance, with a bounded number of answers for each row and no pairs in between."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..schema import ASPECT_TOLERANCE, NEAR_DUPLICATE_BITS
from ..session import kept

#: Rows of either side that meet in a task at once; larger groups are dealt out in cells of so many by so many.
CELL = 8192
#: Parts of either side, at most, where all meet all: so many copies of a row are sent.
PARTS = 16
#: Rows with one value of a block from which that is common.
HOT = 1024
#: Where halves of words tell which rows meet: parts of either side, and rows of a part at most.
COVER_PARTS = 6
COVER_CELL = 400_000
#: What it costs there to sort a row once, to try a pair by chance in a bucket, and one that is alike: in comparisons of two rows, all with all.
SORTED, TRIED, ALIKE = 3, 1, 15
_LEVELS = 16
#: With how many rows of its bucket, at most, a row of side 1 is compared one after the other, side by side with all rows that have so many, as long as these are so many.
_MANY, _FEW = 255, 1024
#: Bits that a block needs for equal ones to be rare.
BLOCK_BITS = 10
#: How much cheaper it is to compare two hashes in a cell than to send a probe.
COMPARED = 100
_PAIRS = 1 << 17
#: Rows of side 1 and of side 0 that are compared at once, all with all, and how many pairs a run needs for that.
_TILE = (64, 2048)
_DENSE = 1 << 16


def _block(bits: Column, first: int, last: int) -> Column:
    return F.conv(F.substring(bits, first + 1, last - first), 2, 10).cast("long")


def _cuts(bits: int, blocks: int) -> list[tuple[int, int]]:
    edges = [bits * i // blocks for i in range(blocks + 1)]
    return list(zip(edges, edges[1:]))


def _masks(size: int, radius: int) -> list[int]:
    """The numbers of `size` bits of which `radius` are set at most."""
    one = [1 << i for i in range(size)]
    return [0, *one, *([one[i] | one[j] for i in range(size) for j in range(i)] if radius == 2 else [])]


def plan(bits: int, most: int, rows: int) -> tuple[str, int, int]:
    """How pairs within `most` bits are found: ('equal', blocks, 0), ('near', blocks, radius), ('cover', words, radius) or ('all', 1, 0), by the cheapest for so many rows.

    equal: of so many blocks all but `most` are equal. near: of fewer, longer blocks one differs in `radius` bits at most. all: every cell of rows with every other.
    cover: as all, but in a cell only those meet that agree in half of a word, for as many halves as are needed to meet all that are near (see _meeting).
    """
    if (most + 1) * BLOCK_BITS <= bits:
        return "equal", bits // max(BLOCK_BITS, min(30, bits // (2 * (most + 1)))), 0
    best = (rows / COMPARED, "all", 1, 0)
    for radius in (1, 2):
        blocks = max(most // (radius + 1) + 1, -(-bits // 60))
        size = bits // blocks
        probes = 1 + size + (size * (size - 1) // 2 if radius == 2 else 0)
        if size >= 8:
            best = min(best, (blocks * probes * (1 + rows / 2**size), "near", blocks, radius))
    if best[1] == "all" and bits % 32 == 0 and most // (bits // 32) <= 5:
        halves = sum(len(_halvings(r)) for r in _thresholds(bits, most))
        # a row of either side is sorted once for each half and part, and meets half of the rows; as all does, whose half stands for rows / COMPARED
        best = min(best, ((2 * COVER_PARTS * SORTED * halves + TRIED * halves * rows / 2**17) * 2 / COMPARED, "cover", bits // 32, most // (bits // 32)))
    return best[1:]


def _thresholds(bits: int, most: int) -> list[int]:
    """A number for each word of 32 bits: hashes within `most` bits differ in a word by no more than its number, as the numbers and one for each word add up to most + 1."""
    words = bits // 32
    return [(most + 1) // words + (k < (most + 1) % words) - 1 for k in range(words)]


def _halvings(threshold: int) -> list[tuple[int, int]]:
    """(u, c): halves of a word's 32 bits, of which those of two words that differ in `threshold` bits at most agree in one.

    Half (u, c) has the bits i for which the parity of u & i is not c, u is any of 2^threshold - 1 numbers. With the bit for c in front, a differing bit i asks for
    an odd product (1, i) . (c, u): these are `threshold` equations at most for one unknown more, so some (c, u) other than 0 solves them all evenly; u = 0 would need c = 1, which fails for any i.
    """
    if threshold <= 0:
        return [(16, 0)] if threshold == 0 else []
    return [(t << (5 - threshold), c) for t in range(1, 1 << threshold) for c in (0, 1)]


def _halves(word: np.ndarray, u: int) -> tuple[np.ndarray, np.ndarray]:
    """The 16 bits i of each word for which u & i has odd parity, and the others, pushed together."""
    top = 1 << (u.bit_length() - 1)
    odd = sum(1 << i for i in range(32) if (u & i).bit_count() % 2)
    blocks = lambda size: np.uint32(sum(1 << i for i in range(32) if not i & size))
    out = []
    for mask in (odd, odd ^ 0xFFFFFFFF):
        x = word & np.uint32(mask)
        x = (x | (x >> np.uint32(top))) & blocks(top)  # of bits i and i ^ top one is in the half
        shift = top
        while shift < 16:
            x = (x | (x >> np.uint32(shift))) & blocks(2 * shift)
            shift *= 2
        out.append(x.astype(np.uint16))
    return out[0], out[1]


def _covers(a: np.ndarray, b: np.ndarray, thresholds: list[int], total: int, sorting: float) -> bool:
    """Whether it is cheaper to meet by halves than to compare `total` pairs, going by how many agree in two halves of each word."""
    meets, halves = 0.0, 0
    for k, r in enumerate(thresholds):
        several = len(_halvings(r))
        if several:
            halves += several
            for x, y in zip(_halves(a[k], 16), _halves(b[k], 16)):
                meets += several / 2 * float(np.bincount(x, minlength=1 << 16).astype(float) @ np.bincount(y, minlength=1 << 16))
    meets *= total / max(1, a.shape[1] * b.shape[1])
    chance = halves * total / (1 << 16)
    return sorting * (halves * (a.shape[1] + b.shape[1]) + (TRIED * chance + ALIKE * max(0.0, meets - chance)) / SORTED) < total


def _meeting(a: np.ndarray, b: np.ndarray, before: np.ndarray, thresholds: list[int], pairs: int = 1 << 15):
    """Words by rows of either side -> (x, y) in parts: all pairs within sum(thresholds + 1) - 1 bits with x < before[y], some several times, and some pairs farther apart.

    Some word of such a pair differs by no more than its threshold, so in one half of it they agree (see _halvings). Among these words there is one from which on, in a ring, the
    first word, the first two and so forth all differ by less than their thresholds and one for each: the one after the place where the sum of what is too much is largest.
    """
    # b's rows stand by how many of a's they may have; up to each edge these are counted by bucket
    edges = np.unique(np.quantile(before, np.arange(1, _LEVELS + 1) / _LEVELS, method="higher"))
    a = a[:, : edges[-1]]
    steps = list(zip([0, *edges], edges, np.searchsorted(before, [-1, *edges], "right"), np.searchsorted(before, edges, "right")))
    for k, r in enumerate(thresholds):
        after = (k + 1) % len(thresholds)
        both = r + thresholds[after] + 1
        for u, c in _halvings(r):
            if not c:
                halves = _halves(a[k], u), _halves(b[k], u)
            (key_a, rest_a), (key_b, rest_b) = (h[:: -1 if c else 1] for h in halves)
            order_a = np.argsort(key_a, kind="stable")
            rest_a = rest_a[order_a]
            n, sofar = np.empty(len(key_b), np.int64), np.zeros(1 << 16, np.int64)
            for x, x_end, y, y_end in steps:
                sofar += np.bincount(key_a[x:x_end], minlength=1 << 16)
                n[y:y_end] = sofar[key_b[y:y_end]]
            order_b = np.argsort(_MANY - np.minimum(n, _MANY).astype(np.uint8), kind="stable")  # rows that have many stand first
            n = n[order_b]
            order_b, n = order_b[: np.count_nonzero(n)], n[: np.count_nonzero(n)]
            low = (np.cumsum(sofar) - sofar)[key_b[order_b]]
            rest_b = rest_b[order_b]

            def near(x, y, d):
                few = np.flatnonzero(d <= r)
                x, y = order_a[x[few]], order_b[few + y.start if isinstance(y, slice) else y[few]]
                few = np.flatnonzero(d[few] + np.bitwise_count(a[after][x] ^ b[after][y]) <= both)
                x, y = x[few], y[few]
                right = x < before[y]
                return x[right], y[right]

            # all rows of b with the first of their bucket, then those that have one with the second and so forth
            met = 0
            left = np.searchsorted(-np.minimum(n, _MANY), -np.arange(_MANY), "left")  # how many rows have more than so many
            while met < _MANY and left[met] >= _FEW:
                for start in range(0, left[met], pairs):
                    y = slice(start, min(start + pairs, left[met]))
                    x = low[y] + met
                    x, y = near(x, y, np.bitwise_count(rest_a[x] ^ rest_b[y]))
                    if len(x):
                        yield x, y
                met += 1
            some = np.flatnonzero(n > met)
            low, n, order_b, rest_b = low[some] + met, n[some] - met, order_b[some], rest_b[some]
            ends, done = np.cumsum(n), 0
            while done < len(n):
                sofar = int(ends[done - 1]) if done else 0
                stop = int(np.searchsorted(ends, sofar + pairs, "right"))
                if stop > done:
                    m = n[done:stop]
                    y = np.repeat(np.arange(done, stop), m)
                    x = np.arange(len(y)) + np.repeat(low[done:stop] - (np.cumsum(m) - m), m)
                else:  # one row has more than so many
                    stop = done + 1
                    x = np.arange(low[done], low[done] + n[done])
                    y = np.full(len(x), done)
                x, y = near(x, y, np.bitwise_count(rest_a[x] ^ rest_b[y]))
                if len(x):
                    yield x, y
                done = stop


def _key(block: Column, value: Column) -> Column:
    return F.xxhash64(block, value)  # two keys that meet by chance cost comparisons, no more


def _rarest(hashes: DataFrame, most: int, hot: int) -> DataFrame:
    """side, id, key: most + 1 of each hash's blocks, by one order for all of them: common values last.

    Two hashes within `most` bits differ in `most` blocks at most, so whichever order all take theirs in, they have one of their first most + 1 in common.
    A value is common if it occurs over `hot` times; there are at most blocks x rows / hot of these.
    """
    tokens = hashes.select("side", "id", F.posexplode("blocks").alias("block", "value"))
    common = kept(tokens.groupBy("block", "value").agg(F.count("*").alias("n")).where(F.col("n") > hot), "common")
    if common.isEmpty():
        return hashes.select("side", "id", F.posexplode(F.slice("blocks", 1, most + 1)).alias("block", "value")).select("side", "id", _key(F.col("block"), F.col("value")).alias("key"))
    ordered = tokens.join(F.broadcast(common), ["block", "value"], "left").groupBy("side", "id").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "block", "value"))).alias("t"))
    return ordered.select("side", "id", F.inline(F.slice("t", 1, most + 1))).select("side", "id", _key(F.col("block"), F.col("value")).alias("key"))


def _cells(left: DataFrame, right: DataFrame, cell: int) -> DataFrame:
    """Rows of both sides (key, id) that share a key, dealt out: key, i, j, side, id. A key with many rows becomes cells of about `cell` by `cell` rows."""
    count = lambda df, name: df.groupBy("key").agg(F.count("*").alias(name))
    sizes = count(left, "na").join(count(right, "nb"), "key").select("key", *(F.ceil(F.col(f"n{k}") / cell).cast("int").alias(f"p{k}") for k in "ab"))
    sizes = kept(sizes, "sizes")
    place = lambda parts: F.pmod(F.xxhash64("id"), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    a = left.join(sizes, "key").withColumn("i", place("pa")).withColumn("j", each("pb")).select("key", "i", "j", F.lit(0).alias("side"), "id")
    b = right.join(sizes, "key").withColumn("j", place("pb")).withColumn("i", each("pa")).select("key", "i", "j", F.lit(1).alias("side"), "id")
    return a.unionByName(b)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int32)


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    a = pa.concat_arrays(column.chunks).cast(pa.binary())
    at = np.frombuffer(a.buffers()[1], np.int32, len(a) + 1, a.offset * 4)
    return np.frombuffer(a.buffers()[2], np.uint8)[at[0] : at[-1]]


def _nearest(most: int, top: int, schema: pa.Schema, thresholds: list[int] | None = None, sorting: float = SORTED):
    """Batches sorted by key, i, j, side, source, ident -> (b, hamming, source, ident): of each row of side 1 its `top` nearest of side 0 in its cell, ties by their order."""

    def compare(t: pa.Table):
        side, run = t.column("side").to_numpy(), t.column("run").to_numpy()
        hashes = _bytes(t.column("hash")).view(np.uint64).reshape(t.num_rows, -1)
        source, ratio = pa.concat_arrays(t.column("source").chunks).dictionary_encode(), t.column("ratio").to_numpy()
        names = source.dictionary.to_pylist()
        ranks = {x: k for k, x in enumerate(sorted(names))}
        rank = np.array([ranks[x] for x in names])[source.indices.to_numpy()]
        first = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        end = np.concatenate((first[1:], [len(run)]))
        split = first + np.array([int((side[x:y] == 0).sum()) for x, y in zip(first, end)])
        # of each row of side 1 the rows of side 0 of its run
        large = (split - first) * (end - split) >= _DENSE
        for x, m, y in zip(first[large], split[large], end[large]):
            before = np.searchsorted(rank[x:m], rank[m:y])
            words = np.ascontiguousarray(hashes[x:y].view(np.uint32)[:, : len(thresholds)].T) if thresholds and before.any() else None
            if words is not None and _covers(words[:, : m - x], words[:, m - x :], thresholds, int(before.sum()), sorting):
                yield from covered(t, hashes, ratio, x, m, words[:, : m - x], words[:, m - x :], before)
            else:
                yield from dense(t, hashes, rank, ratio, x, m, y)
        b = np.flatnonzero((side == 1) & ~np.repeat(large, end - first))
        at = np.searchsorted(first, b, "right") - 1
        low, size = first[at], (split - first)[at]
        done = 0
        while done < len(b):
            stop = done + max(1, int(np.searchsorted(np.cumsum(size[done:]), _PAIRS, "right")))
            n = size[done:stop]
            y = np.repeat(b[done:stop], n)
            x = np.arange(len(y)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low[done:stop], n)
            done = stop
            fit = (rank[x] < rank[y]) & (np.abs(ratio[x] - ratio[y]) <= ASPECT_TOLERANCE * np.maximum(ratio[x], ratio[y]))
            x, y = x[fit], y[fit]
            d = _distances(hashes[x], hashes[y])
            x, y, d = x[d <= most], y[d <= most], d[d <= most]
            if not len(x):
                continue
            yield from best(t, x, y, d)

    def dense(t: pa.Table, hashes, rank, ratio, first: int, split: int, end: int):
        """A run's rows of side 1 with all of side 0 of smaller source, which come first in order: word by word of their hashes, until few pairs are left that may be near enough."""
        words = np.ascontiguousarray(hashes[first:end].T)
        for b in range(split, end, _TILE[0]):
            stop = min(b + _TILE[0], end)
            found = []
            for a in range(first, first + int(np.searchsorted(rank[first:split], rank[stop - 1])), _TILE[1]):
                last = min(a + _TILE[1], split)
                d = np.zeros((stop - b, last - a), np.uint16)
                for k, w in enumerate(words, 1):
                    d += np.bitwise_count(w[b - first : stop - first, None] ^ w[None, a - first : last - first])
                    if k % 2 == 0 and np.count_nonzero(d <= most) * 16 < d.size:
                        break
                y, x = np.nonzero(d <= most)
                x, y = x + a, y + b
                fit = (rank[x] < rank[y]) & (np.abs(ratio[x] - ratio[y]) <= ASPECT_TOLERANCE * np.maximum(ratio[x], ratio[y]))
                x, y = x[fit], y[fit]
                d = _distances(hashes[x], hashes[y])
                found.append((x[d <= most], y[d <= most], d[d <= most]))
                if sum(len(f[0]) for f in found) > _PAIRS:
                    found = [first_ones(*map(np.concatenate, zip(*found)))]
            if found:
                yield from best(t, *map(np.concatenate, zip(*found)))

    def covered(t: pa.Table, hashes, ratio, first: int, split: int, a, b, before):
        """The same of a run as dense, for pairs that meet by halves of words."""
        limit = np.full(b.shape[1], most)  # beyond which a row of side 1 has found better ones
        found, many, few = [], 0, 0
        for x, y in _meeting(a, b, before, thresholds):
            x, y = x + first, y + split
            fit = np.abs(ratio[x] - ratio[y]) <= ASPECT_TOLERANCE * np.maximum(ratio[x], ratio[y])
            x, y = x[fit], y[fit]
            d = _distances(hashes[x], hashes[y])
            near = d <= limit[y - split]
            found.append((x[near], y[near], d[near]))
            many += len(found[-1][0])
            if many > _PAIRS + 2 * few:
                found = [first_ones(*map(np.concatenate, zip(*found)))]
                many = few = len(found[0][0])
                x, y, d = found[0]
                full = np.flatnonzero(y[top - 1 :] == y[: len(y) - top + 1]) + top - 1
                limit[y[full] - split] = d[full]
        if found:
            yield from best(t, *map(np.concatenate, zip(*found)))

    def first_ones(x, y, d):
        """Of pairs those of the `top` least d, then x, of each y; each pair once."""
        order = np.lexsort((x, d, y))
        x, y, d = x[order], y[order], d[order]
        new = np.concatenate((np.ones(min(len(y), 1), bool), (y[1:] != y[:-1]) | (x[1:] != x[:-1])))
        x, y, d = x[new], y[new], d[new]
        begin = np.concatenate((np.ones(min(len(y), 1), bool), y[1:] != y[:-1]))
        place = np.arange(len(y)) - np.repeat(np.flatnonzero(begin), np.diff(np.concatenate((np.flatnonzero(begin), [len(y)]))))
        return x[place < top], y[place < top], d[place < top]

    def best(t: pa.Table, x, y, d):
        x, y, d = first_ones(x, y, d)
        if len(x):
            columns = [t.column("id").take(pa.array(y)), pa.array(d, pa.int32()), t.column("source").take(pa.array(x)), t.column("ident").take(pa.array(x))]
            yield from pa.table(columns, schema=schema).to_batches()

    def run(batches):
        held, many, number, last, begun = [], 0, 0, None, 1
        for batch in batches:
            if not batch.num_rows:
                continue
            # the number of the run that each row stands in
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "i", "j")])
            new = np.concatenate(([last is None or bool((keys[:, 0] != last).any())], (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            numbers, last = number + np.cumsum(new), keys[:, -1]
            number = int(numbers[-1])
            held.append(pa.table({c: batch.column(c) for c in ("side", "id", "hash", "source", "ident", "ratio")} | {"run": pa.array(numbers, pa.int64())}))
            many += batch.num_rows
            if many >= CELL and number > begun:
                t = pa.concat_tables(held).combine_chunks()
                cut = int(np.searchsorted(t.column("run").to_numpy(), number))
                yield from compare(t.slice(0, cut).combine_chunks())
                held, many, begun = [t.slice(cut)], t.num_rows - cut, number
        if many:
            yield from compare(pa.concat_tables(held).combine_chunks())

    return run


def nearest(rows: DataFrame, words: str, bits: int, source: str, ident: str, aspect: str | None = None, most: int = NEAR_DUPLICATE_BITS, top: int = 3, cell: int | None = None, hot: int | None = None) -> DataFrame:
    """For each row its `top` nearest rows of smaller source within `most` bits and the aspect tolerance: hamming, source_a, id_a, source_b, id_b.

    words is an array<bigint> of 32-bit parts of a hash of `bits` bits; most may be any distance from 0 to bits. Ties go to the smaller source, then id.

    Rows of one hash and aspect are one class: as neighbours the first `top` of them stand for all, and those of one source have the
    same neighbours. Classes meet by blocks of their hashes (see plan), a block that many have in cells of bounded size, and what leaves a cell is the best
    `top` of each class in it. Rows with a null hash, source or aspect have no neighbours.
    """
    if not 0 <= most <= bits:
        raise ValueError(f"a distance of {most} of {bits} bits")
    spark = rows.sparkSession
    plain = rows.select(F.col(source).alias("source"), F.col(ident).alias("ident"), F.col(words).alias("w"), (F.col(aspect).cast("double") if aspect else F.lit(1.0)).alias("ratio"))
    plain = plain.where("w is not null and source is not null and ratio is not null and not exists(w, x -> x is null)").withColumn("h", F.array_join(F.transform("w", lambda x: F.lpad(F.hex(x), 8, "0")), "")).drop("w")
    plain = kept(plain, "plain")  # what tells the hashes, perhaps whole texts, is computed once
    w = Window.partitionBy("h", "ratio").orderBy("source", "ident")
    mine = plain.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= top).drop("_n")
    sides = mine.withColumn("side", F.lit(0)).unionByName(plain.select("source", "h", "ratio").distinct().withColumns({"side": F.lit(1), "ident": F.lit(None).cast(plain.schema["ident"].dataType)}))
    # written once: a row's number must be the same wherever it is used
    sides = kept(sides.withColumn("id", F.monotonically_increasing_id()), "sides")
    count = sides.where("side = 0").count()
    how, blocks, radius = plan(bits, most, count)
    cell = cell or max(CELL, {"all": -(-count // PARTS), "cover": min(COVER_CELL, -(-count // COVER_PARTS))}.get(how, 0))
    if how in ("all", "cover"):
        keyed = sides.select("side", "id", F.lit(0).cast("long").alias("key"))
    else:
        as_bits = F.array_join(F.transform(F.sequence(F.lit(1), F.length("h"), F.lit(8)), lambda i: F.lpad(F.conv(F.substr("h", i, F.lit(8)), 16, 2), 32, "0")), "")
        cuts = _cuts(bits, blocks)
        cut = sides.select("side", "id", as_bits.alias("b")).select("side", "id", F.array(*(_block(F.col("b"), *c) for c in cuts)).alias("blocks"))
        if how == "equal":
            keyed = _rarest(cut, most, hot or max(HOT, cut.count() // 10_000))
        else:  # one side by its blocks as they are, the other by all that is near them
            masks = F.array(*(F.lit(m).cast("long") for m in _masks(max(b - a for a, b in cuts), radius)))
            near = F.flatten(F.transform("blocks", lambda v, i: F.transform(masks, lambda m: _key(i, v.bitwiseXOR(m)))))
            keyed = cut.select("side", "id", F.explode(F.when(F.col("side") == 0, F.transform("blocks", lambda v, i: _key(i, v))).otherwise(near)).alias("key"))
    keyed = kept(keyed, "keyed") if how == "equal" else keyed
    cells = _cells(*(keyed.where(F.col("side") == k).select("key", "id") for k in (0, 1)), cell)
    packed = sides.select("id", F.unhex(F.rpad("h", -(-bits // 64) * 16, "0")).alias("hash"), "source", "ident", "ratio")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if how == "cover":  # a cell is long work: few tasks should have two
        tasks = max(tasks, 4 * (-(-count // cell)) ** 2)
    dealt = cells.join(packed, "id").repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j", "side", "source", "ident")
    kinds = {f.name: f.dataType for f in plain.schema}
    out = f"b long, hamming int, source_a {kinds['source'].simpleString()}, id_a {kinds['ident'].simpleString()}"
    schema = pa.schema([("b", pa.int64()), ("hamming", pa.int32()), ("source_a", to_arrow_type(kinds["source"])), ("id_a", to_arrow_type(kinds["ident"]))])
    found = dealt.mapInArrow(_nearest(most, top, schema, _thresholds(bits, most) if how == "cover" else None, SORTED), out).distinct()  # a pair may meet in several blocks
    best = found.withColumn("_n", F.row_number().over(Window.partitionBy("b").orderBy("hamming", "source_a", "id_a"))).where(F.col("_n") <= top).drop("_n")
    classes = best.join(sides.where("side = 1").select(F.col("id").alias("b"), "h", "ratio", "source"), "b")
    return classes.join(plain, ["h", "ratio", "source"]).select("hamming", "source_a", "id_a", F.col("source").alias("source_b"), F.col("ident").alias("id_b"))
