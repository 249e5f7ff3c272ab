"""Exact top-k by integer inner product: MaxScore over vector shards.

A vector's components are the terms of a query; a term's score bounds in a shard are what its extreme components can give. A shard keeps a posting
list for each term, its vectors in the order of their component, so that a query meets the highest contributions first. Given the
k-th best score so far, a query's terms are split by their bounds: the non-essential ones cannot lift any vector to that score by themselves, so
a vector that may still reach it must stand, in the list of some essential term, within the part whose contributions are
a large enough share of that term's bound. Only those parts are traversed; the vectors met are probed in term after term while
bounds leave them competitive. Shards' answers are merged by score, then id.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SCALE = 1024
#: Bytes of a shard's components, which it holds by vector, by term and, with half as many for rows, as postings; and bytes of queries that one pass over the vectors may broadcast.
SHARD_BYTES = 8 << 20
QUERY_BYTES = 64 << 20
_STEP = 8
#: Larger components count as this, which no float32 reaches; scores that 64 bits cannot hold count as the largest or least that they can.
LARGEST = 2.0**200
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _usable(vectors: DataFrame) -> DataFrame:
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    return v.where("vec_id is not null and v is not null and size(v) > 0").where(~bad)


def _matrix(batch) -> np.ndarray:
    column = batch.column("v")
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * np.asarray(column.flatten(), np.float64)), -LARGEST, LARGEST).reshape(len(column), -1)


def _inner(m: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer products; float64 holds them exactly if no sum can pass 2^53, else Python integers do."""
    if exact:
        return np.einsum("ij,j->i", m, q)
    whole = [int(x) for x in q]
    return np.array([sum(int(x) * y for x, y in zip(row, whole)) for row in m], object)


class Shard:
    """Vectors with a posting list for each term: rows and their components, ascending."""

    def __init__(self, ids: np.ndarray, m: np.ndarray):
        self.ids, self.m, self.by_term = ids, m, np.ascontiguousarray(m.T)
        order = np.argsort(self.by_term, axis=1, kind="stable")
        self.rows, self.values = order.astype(np.int32), np.take_along_axis(self.by_term, order, axis=1)
        self.low, self.high = self.values[:, 0], self.values[:, -1]
        self.reach = np.maximum(np.abs(self.low), np.abs(self.high))

    def essential(self, q: np.ndarray, best: float) -> tuple[np.ndarray, int]:
        """Terms by falling span of what they give, and how many of them are essential for a score of `best`: the rest cannot give it beside the least of all others."""
        span = np.maximum(q * self.low, q * self.high) - np.minimum(q * self.low, q * self.high)
        terms = np.argsort(-span, kind="stable")
        need = best - np.minimum(q * self.low, q * self.high).sum()
        rest = np.concatenate([np.cumsum(span[terms][::-1])[::-1], [0]])  # of the terms from a place on
        return terms, int(np.argmax(rest < need)) if need > 0 else 0

    def met(self, q: np.ndarray, best: float) -> np.ndarray:
        """Rows that the traversed parts of essential postings hold; every row that may score `best` is among them."""
        if best == -np.inf:
            return np.arange(len(self.m))
        terms, n = self.essential(q, best)
        least = np.minimum(q * self.low, q * self.high)
        span = np.maximum(q * self.low, q * self.high) - least
        need = best - least.sum()
        if need <= 0:
            return np.arange(len(self.m))
        if need > span.sum():
            return np.zeros(0, np.int64)
        ends = np.cumsum(span[terms])
        found, size = None, 4 * len(self.m)  # beyond that many postings nearly all rows are met: no need to go through them
        # with all terms essential, each list is traversed less far; the fewer postings win
        for k in sorted({n, int((span > 0).sum())}):
            # a row that gives less than this share of each essential span cannot make up for what the others lack
            share = (need - (ends[-1] - ends[k - 1])) / ends[k - 1]
            parts, total = [], 0
            for t in terms[:k]:
                # components are whole numbers: one to spare outweighs what rounding may err
                if q[t] > 0:
                    parts.append(self.rows[t, np.searchsorted(self.values[t], (least[t] + share * span[t]) / q[t] - 1 + 1e-6) :])
                else:
                    parts.append(self.rows[t, : np.searchsorted(self.values[t], (least[t] + share * span[t]) / q[t] + 1 - 1e-6, "right")])
                total += len(parts[-1])
                if total >= size:
                    break
            else:
                found, size = parts, total
        if found is None:
            return np.arange(len(self.m))
        seen = np.zeros(len(self.m), bool)
        for rows in found:
            seen[rows] = True
        return np.flatnonzero(seen)


def maxscore(q: np.ndarray, shard: Shard, own: int | None, best: float, k: int, exact: bool = True, probes: list | None = None) -> np.ndarray:
    """Rows of the shard, but those of id `own`, that may score `best` or more, or be among its k best. probes gets the number of components looked at.

    Where sums may pass 2^53, bounds in doubles could err, and all rows are returned.
    """
    m = shard.m
    if not exact:
        return np.flatnonzero(shard.ids != own)
    if best == -np.inf and len(m) > 8 * k:  # the first of the longest list tell what is to be reached
        t = int(np.argmax(np.abs(q) * (shard.high - shard.low)))
        first = shard.rows[t, -4 * k :] if q[t] > 0 else shard.rows[t, : 4 * k]
        first = first[shard.ids[first] != own]
        if len(first) >= k:
            best = float(np.partition(np.einsum("ij,j->i", m[first], q), len(first) - k)[len(first) - k])
    rows = shard.met(q, best)
    rows = rows[shard.ids[rows] != own]
    lift, drop = np.maximum(q * shard.low, q * shard.high), np.minimum(q * shard.low, q * shard.high)
    terms = np.argsort(-(lift - drop), kind="stable")
    rest = np.concatenate([np.cumsum(lift[terms][::-1])[::-1], [0]])
    worst = np.concatenate([np.cumsum(drop[terms][::-1])[::-1], [0]])
    score = np.zeros(len(rows))
    for at in range(0, len(terms), _STEP):
        part = terms[at : at + _STEP]
        # one by one only where few are left: side by side, all are added up sooner
        few = 4 * len(rows) < len(m)
        # not by BLAS, whose threads would wait for each other over such small products
        given = np.einsum("i,ij->j", q[part], shard.by_term[np.ix_(part, rows)] if few else shard.by_term[part])
        score = score + (given if few else given[rows])
        if probes is not None:
            probes.append(len(rows) * len(part))
        after = min(at + _STEP, len(terms))
        if len(rows) > k:
            best = max(best, np.partition(score, len(score) - k)[len(score) - k] + worst[after])
        stay = score + rest[after] >= best
        if not stay.all():
            rows, score = rows[stay], score[stay]
        if not len(rows):
            break
    return rows


def _searcher(queries, k: int):
    def run(batches):
        table = queries.value  # {width: (ids, matrix)}
        top = {w: [(np.zeros(0, object), np.zeros(0, np.int64))] * len(ids) for w, (ids, _) in table.items()}

        def search(ids, m):
            part = Shard(ids, m)
            ids_q, mq = table[m.shape[1]]
            for i, q in enumerate(mq):
                exact = float(part.reach @ np.abs(q)) < 2.0**53
                had, names = top[m.shape[1]][i]
                found = maxscore(q, part, ids_q[i], float(had[-1]) if len(had) == k else -np.inf, k, exact)
                if len(found):
                    got = np.array([min(max(int(x), _LOW), _HIGH) for x in _inner(m[found], q, exact)], object)
                    score, name = np.concatenate([had, got]), np.concatenate([names, ids[found]])
                    order = sorted(range(len(score)), key=lambda j: (-score[j], name[j]))[:k]
                    top[m.shape[1]][i] = (score[order], name[order])

        held: dict[int, list] = {}
        for batch in batches:
            sizes = np.asarray(batch.column("v").value_lengths())
            for w in np.unique(sizes):
                if int(w) not in table:
                    continue
                part = batch.filter(pa.array(sizes == w))
                held.setdefault(int(w), []).append((np.asarray(part.column("vec_id")), _matrix(part)))
                if sum(len(x) for x, _ in held[int(w)]) * int(w) * 8 >= SHARD_BYTES:
                    search(*(np.concatenate(x) for x in zip(*held.pop(int(w)))))
        for parts in held.values():
            search(*(np.concatenate(x) for x in zip(*parts)))
        for w, (ids, _) in table.items():
            n = [len(s) for s, _ in top[w]]
            if sum(n):
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, n)), pa.array(np.concatenate([x for _, x in top[w]])), pa.array([int(x) for s, _ in top[w] for x in s], pa.int64())], ["query_id", "vec_id", "score"])

    return common.freeing(run)


def top_k(vectors: DataFrame, is_query, k: int = 10, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query's vector, of floor(1024 x) by component.

    vectors needs vec_id (long) and embedding; is_query is a condition on vec_id. Candidates are all rows of another vec_id, ties
    go to the smaller vec_id. Vectors that are null, empty or hold null or non-finite components take no part, as neither do
    rows without vec_id; a query meets only vectors of its own length. Repeated rows are candidates each; a repeated query counts once, by its least vector.
    Scores beyond 64 bits are the largest or least number of 64 bits, and tie as such; components beyond 2^200 count as 2^200. Other columns are not read.
    Queries are broadcast in blocks of `query_bytes` at most, one after the other, with one pass over the vectors each, whose answers are a table before
    the next one starts; each task returns k rows a query.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors)
    asked = common.keep(usable.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    count, width = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    empty = spark.createDataFrame([], "query_id long, vec_id long, score long")
    if not count:
        return empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
    blocks = -(-count * width * 8 // query_bytes)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow()
        table: dict[int, list] = {}
        for batch in mine.to_batches():
            sizes = np.asarray(batch.column("v").value_lengths())
            for w in np.unique(sizes):
                part = batch.filter(pa.array(sizes == w))
                table.setdefault(int(w), []).append((np.asarray(part.column("vec_id")), _matrix(part)))
        queries = spark.sparkContext.broadcast({w: tuple(np.concatenate(x) for x in zip(*parts)) for w, parts in table.items()})
        answers = usable.mapInArrow(_searcher(queries, k), "query_id long, vec_id long, score long")
        answers = answers.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        found.append(common.keep(answers, "answers"))
        queries.destroy()
    return functools.reduce(DataFrame.union, found) if found else empty.select("query_id", F.lit(1).alias("rank"), "vec_id", "score")
