"""Phrase collocations: count-min sketches sieve the word sequences, survivors are counted exactly, then scored and subsumed."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .shingles import _BY_PLACE, _hashes, mix

LONGEST = 4
LEAST = 30
TOP = 2000
#: A candidate within a longer one goes if the longer one has this many hundredths of its occurrences.
SUBSUMED = 80
SCALE = 2_000_000
#: Cells of the sketch of each length, at most: more than a worker could hold, so they are dealt out in blocks of BLOCK cells, one of which is summed up at a time.
MOST_CELLS = 1 << 32
BLOCK = 1 << 24
#: Cells for each byte of text, as long as MOST_CELLS allows: some three for each word.
CELLS_A_BYTE = 0.5
#: Surviving cells go to all workers as bits, so many of them for each length at most, two of which stand for a cell.
MOST_BITS = 1 << 26
_SLICE = 4 << 20
_SPACE, _BREAK = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_SPACE)], _KIND[list(_BREAK)] = 1, 2
_BREAKS = re.compile(b"[.,;:!?\n\x0b\x0c\r]")


class Words:
    """The words of some lower-cased texts, which of them stand in one piece, and the hashes of their sequences."""

    def __init__(self, data: list[bytes], seeds: np.ndarray):
        self.flat = b"\n".join(data)
        flat = np.frombuffer(self.flat, np.uint8)
        begin = np.zeros(len(data), np.int64)
        np.cumsum([len(x) + 1 for x in data[:-1]], out=begin[1:])
        kind = _KIND[flat]
        edge = np.diff(np.concatenate(([0], (kind == 0).view(np.int8), [0])))
        self.first, self.last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        self.piece = np.cumsum(kind == 2)[self.first] if len(flat) else np.zeros(0, np.int64)
        self.text = np.searchsorted(begin, self.first, "right") - 1
        self.seed = seeds[self.text] if len(data) else np.zeros(0, np.uint64)
        self.hash = _hashes(flat, self.first, self.last) if len(self.first) else np.zeros(0, np.uint64)

    def sequences(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each sequence of k words within a piece, and its hash, which the seed of its text is part of."""
        n = len(self.first) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[:n] == self.piece[k - 1 :])
        h = self.seed[at] + np.uint64(k * int(_BY_PLACE[4]) & (1 << 64) - 1)
        for j in range(k):
            h += self.hash[at + j] * _BY_PLACE[j]
        return at, mix(h)

    def phrase(self, at: int, k: int) -> bytes:
        return b" ".join(self.flat[self.first[i] : self.last[i]] for i in range(at, at + k))


def _parts(text: bytes, most: int = _SLICE):
    """A long text in parts of about `most` bytes, cut at breaks only, which no sequence spans."""
    at = 0
    while len(text) - at > most and (found := _BREAKS.search(text, at + most)):
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def _seed(lang: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode())


def _words(batches):
    """(Words, the language of each of its texts) of batches of (lang, text), some megabytes at a time."""
    for batch in batches:
        parts = [(x, y) for x, t in zip(batch.column(0).to_pylist(), common.text_bytes(batch.column(1))) for y in _parts(t.lower())]
        for a, b in common.by_bytes(parts, lambda x: len(x[1]) + 1, _SLICE):
            langs = [x for x, _ in parts[a:b]]
            seeds = {x: _seed(x) for x in set(langs)}
            yield Words([y for _, y in parts[a:b]], np.array([seeds[x] for x in langs], np.uint64)), langs


def _cells(h: np.ndarray, cells: int) -> np.ndarray:
    return h & np.uint64(cells - 1)


def _places(cells: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits, of `size`, that stand for each cell."""
    h = mix(cells)
    return tuple(((h >> np.uint64(r)) & np.uint64(size - 1)).astype(np.int64) for r in (0, 32))


def _kind(least: int) -> np.dtype:
    """What counts up to `least` and a little more, where it stops."""
    return np.dtype(np.uint8 if least < 255 else np.uint32)


def _sketching(cells: int, least: int):
    """(lang, text) batches -> (block, n, data): of some megabytes of text the cells that are met in each block of the sketch, ascending, and how often, packed."""
    schema = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])

    def run(batches):
        kind, codec, width = _kind(least), pa.Codec("zstd", 1), min(BLOCK, cells)
        for words, _ in _words(batches):
            for k in range(1, LONGEST + 1):
                c, n = np.unique(_cells(words.sequences(k)[1], cells), return_counts=True)
                n = np.minimum(n, np.iinfo(kind).max).astype(kind)
                edge = np.searchsorted(c, np.arange(cells // width + 1, dtype=np.uint64) * np.uint64(width)).tolist()
                full = [(b, x, y) for b, (x, y) in enumerate(zip(edge, edge[1:])) if y > x]
                # steps from one cell to the next pack better than cells
                data = [codec.compress(np.diff(c[x:y], prepend=np.uint64(b * width)).astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes() + n[x:y].tobytes(), asbytes=True) for b, x, y in full]
                blocks = [(k - 1) * (cells // width) + b for b, _, _ in full]
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([y - x for _, x, y in full], pa.int32()), pa.array(data, pa.binary())], schema=schema)

    return common.freeing(run)


def _merging(cells: int, least: int):
    """(block, n, data) sorted by block -> (k, cells): which cells of the sum have `least` or more, as 64-bit numbers. Holds one block at a time."""

    def run(batches):
        kind, width, codec = _kind(least), min(BLOCK, cells), pa.Codec("zstd")
        now, total, most = None, None, np.iinfo(kind).max

        def done():
            k, b = divmod(now, cells // width)
            found = np.flatnonzero(total >= least).astype(np.uint64) + np.uint64(b * width)
            parts = [found[i : i + (1 << 20)].tobytes() for i in range(0, len(found), 1 << 20)]
            return pa.RecordBatch.from_arrays([pa.array([k + 1] * len(parts), pa.int32()), pa.array(parts, pa.binary())], ["k", "cells"])

        for batch in batches:
            for block, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if now is not None:
                        yield done()
                    now, total = block, np.zeros(width, kind)
                raw = np.frombuffer(codec.decompress(data, n * (4 + kind.itemsize), asbytes=True), np.uint8)
                c = np.cumsum(np.ascontiguousarray(raw[: 4 * n].reshape(4, -1).T).view(np.uint32).ravel(), dtype=np.int64)
                more, old = raw[4 * n :].view(kind), total[c]
                total[c] = old + np.minimum(more, most - old)
        if now is not None:
            yield done()

    return common.freeing(run)


def _surviving(rows: DataFrame, least: int, cells: int) -> list[np.ndarray]:
    """For each length which cells of the sketch of (lang, text) reach `least`, as bits that stand for them (see _places)."""
    sketches = rows.mapInArrow(_sketching(cells, least), "block int, n int, data binary")
    merged = sketches.repartition(common.shuffle_partitions(rows.sparkSession), "block").sortWithinPartitions("block").mapInArrow(_merging(cells, least), "k int, cells binary")
    size = min(MOST_BITS, max(1 << 16, cells // 32))  # bytes in all: half of `size`, whatever the corpus has
    bits = [np.zeros(size // 8, np.uint8) for _ in range(LONGEST)]
    for x in common.keep(merged, "cells").toLocalIterator():
        for place in _places(np.frombuffer(x.cells, np.uint64), size):
            np.bitwise_or.at(bits[x.k - 1], place >> 3, (1 << (place & 7)).astype(np.uint8))
    return bits


def _counting(cells: int, bits, most: int = 160 << 20):
    """(lang, text) batches -> (lang, phrase, k, n): how often each surviving sequence stands in what a task has read, and with k = 0 all words of a language."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("k", pa.int32()), ("n", pa.int64())])

    def table(found: dict):
        for (lang, k), counts in found.items():
            keys, n = list(counts), list(counts.values())
            for a in range(0, len(keys), 50_000):
                phrases = [p.decode("utf-8", "replace") for p in keys[a : a + 50_000]]
                columns = [[lang] * len(phrases), phrases, [k] * len(phrases), n[a : a + 50_000]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches):
        found, held, known = defaultdict(dict), 0, bits.value
        for words, langs in _words(batches):
            for lang, n in zip(langs, np.bincount(words.text, minlength=len(langs)).tolist()):
                found[lang, 0][b""] = found[lang, 0].get(b"", 0) + n
            for k in range(1, LONGEST + 1):
                at, h = words.sequences(k)
                row = known[k - 1]
                for r in (0, 1):
                    c = _places(_cells(h, cells), 8 * len(row))[r]
                    left = np.flatnonzero((row[c >> 3] >> (c & 7).astype(np.uint8)) & 1)
                    at, h = at[left], h[left]
                _, place, n = np.unique(h, return_index=True, return_counts=True)
                at = at[place]
                for i, lang, m in zip(at.tolist(), words.text[at].tolist(), n.tolist()):
                    counts, phrase = found[langs[lang], k], words.phrase(i, k)
                    before = counts.get(phrase)
                    if before is None:
                        held += 150 + len(phrase)
                        counts[phrase] = m
                    else:
                        counts[phrase] = before + m
            if held > most:
                yield from table(found)
                found, held = defaultdict(dict), 0
        yield from table(found)

    return common.freeing(run)


def phrase_counts(documents: DataFrame, least: int = LEAST, cells: int | None = None) -> DataFrame:
    """lang, phrase, k, n: every sequence of 1 to 4 words that stands `least` times or more in a language, and with k = 0 and an empty phrase all its words. A kept table."""
    spark = documents.sparkSession
    rows = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = cells or min(MOST_CELLS, max(1 << 16, 1 << int(size * CELLS_A_BYTE).bit_length()))
    # few tasks, as each sends every frequent sequence that it meets: as many as the cluster runs at once twice over, more where they would read over 256 MB
    rows = rows.coalesce(max(2 * spark.sparkContext.defaultParallelism, size >> 28))
    bits = _surviving(rows, least, cells)
    counted = rows.mapInArrow(_counting(cells, spark.sparkContext.broadcast(bits)), "lang string, phrase string, k int, n long")
    return common.keep(counted.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n")).where((F.col("n") >= least) | (F.col("k") == 0)), "phrases")


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, subsumed: int = SUBSUMED, cells: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, k, cut: the `top` phrases of 2 to 4 words of each language.

    documents has lang (null: 'und') and text (null: empty). A-Z are lower-cased; texts are cut into pieces at . , ; : ! ? and line
    ends, pieces into words at spaces and tabs. A sketch, whose cells grow with the text and are summed up in blocks, overestimates how
    often each sequence stands there; a second pass counts exactly those whose cell reaches `least`. So no frequent one is lost,
    and how many others are counted in vain depends on the cells alone, not the result. a is a phrase's count, l and r those of its parts at the cut
    of the least score floor(2000000 a / (l + r)) (ties: the earliest), n all words of the language. Phrases within a longer
    candidate that has `subsumed` hundredths of their count or more are left out. Ties of a score go to the larger a, then the lesser phrase by bytes.

    Empty texts give nothing, an empty table gives an empty table, repeated rows count each, long texts are read in parts cut at
    breaks, other columns are not read. Sequences are told by 64 bits within four megabytes of text and by their characters beyond.
    """
    counted = phrase_counts(documents, least, cells)
    one = common.few(counted.where("k > 0").select("lang", "phrase", "n"))
    words = F.split("phrase", " ", -1)
    # lists of words: a phrase of up to four gives few rows
    found = counted.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), words.alias("w"))
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = found.select("lang", "phrase", "k", "a", "w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "k", "a", "cut", part(F.lit(1), F.col("cut")).alias("left"), part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    named = lambda p, n: one.select("lang", F.col("phrase").alias(p), F.col("n").alias(n))
    cuts = cuts.join(named("left", "l"), ["lang", "left"]).join(named("right", "r"), ["lang", "right"])
    # div is exact for decimals; 2000000 a may pass 64 bits
    cuts = cuts.withColumn("score", F.expr(f"CAST((CAST({SCALE} AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0))) DIV (CAST(l AS DECIMAL(38,0)) + CAST(r AS DECIMAL(38,0))) AS BIGINT)"))
    scored = cuts.groupBy("lang", "phrase", "k", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("least"))
    inner = F.filter(F.transform(F.sequence(F.lit(0), F.lit(LONGEST * LONGEST - 1)), lambda i: F.struct(F.floor(i / LONGEST).cast("int").alias("at"), (i % LONGEST + 1).alias("size"))), lambda x: (x["size"] >= 2) & (x["size"] < F.col("k")) & (x["at"] + x["size"] <= F.col("k")))
    within = found.where("k > 2").select("lang", "a", "w", F.explode(inner).alias("x")).select("lang", F.array_join(F.slice("w", F.col("x.at") + 1, F.col("x.size")), " ").alias("phrase"), "a")
    longer = within.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * _whole(F.col("longer")) < subsumed * _whole(F.col("a"))))
    w = Window.partitionBy("lang").orderBy(F.desc("least.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
    n = common.few(counted.where("k = 0").select("lang", "n"))
    return ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "least.l", "least.r", "n", "least.score", "k", "least.cut")
