import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import sharding, topk


def whole(x):
    return min(max(math.floor(1024 * x), -(2**200)), 2**200)


def brute(rows, k):
    ok = [(i, [whole(x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in rows:
        if i is not None and i % 100 == 0 and v and all(x is not None and math.isfinite(x) for x in v):
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        qv = [whole(x) for x in v]
        scored = sorted((-min(max(sum(a * b for a, b in zip(qv, w)), -(2**63)), 2**63 - 1), i) for i, w in ok if i != q and len(w) == len(qv))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("other"))


@pytest.mark.parametrize("query_bytes", [64 << 20, 600])
def test_top_k(spark, query_bytes):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 20) / 8).tolist()) for i in range(700)]
    rows += [(701, None), (702, []), (703, [1.0, None]), (704, [math.nan] * 20), (800, [math.inf] * 20), (None, [0.5] * 20), (5, rows[5][1]), (100, rows[100][1]), (900, [0.25] * 3), (901, [0.5] * 3), (1000, [1e300] * 20), (1100, [1e20, -1e20] * 10), (1101, [-1e18] * 20)]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") % 100 == 0, 10, query_bytes)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute(rows, 10)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**20 + 1 / 1024, 3.0]), (1, [2.0**21 + 1 / 1024, 1.0]), (2, [2.0**21 + 1 / 1024, 1.0 + 1 / 1024])]
    got = topk.top_k(vectors(spark, rows), F.col("vec_id") == 0, 2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, 2)


def test_no_vectors(spark):
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 100 == 0).collect() == []
    assert topk.top_k(vectors(spark, [(0, [1.0])]), F.col("vec_id") % 100 == 0).collect() == []


def test_pruning_keeps_all_competitors():
    rng = np.random.default_rng(1)
    for m in (rng.integers(-50, 50, (500, 40)), rng.poisson(0.1, (500, 40)) * 100, np.round(rng.normal(0, 300, (500, 40)))):
        shard = topk.Shard(np.arange(500), m.astype(float))
        for q in m[:20].astype(float):
            rows = topk.maxscore(q, shard, None, -np.inf, 10)
            best = np.sort(m @ q)[-10:]
            assert set(np.flatnonzero(m @ q >= best[0])) <= set(rows) and len(rows) <= 500


def test_essential_postings_spare_probes():
    rng = np.random.default_rng(2)
    m = rng.poisson(0.08, (4000, 40)) * rng.integers(1, 900, (4000, 40)) * 1.0
    shard = topk.Shard(np.arange(4000), m)
    for q in m[m.sum(axis=1) > 0][:20]:
        best = float(np.sort(m @ q)[-10])
        terms, n = shard.essential(q, best)
        span = np.abs(q) * (shard.high - shard.low)
        assert 0 < n < 40 and span[terms[n:]].sum() < best - np.minimum(q * shard.low, q * shard.high).sum() <= span[terms[n - 1 :]].sum()
        met, probes = shard.met(q, best), []
        rows = topk.maxscore(q, shard, None, best, 10, probes=probes)
        assert set(np.flatnonzero(m @ q >= best)) <= set(rows) <= set(met) and len(met) < 2000
        assert sum(probes) < 4000 * 40 / 4


def test_sharding(spark, on_disk):
    rows = [(i, "é" * (i * 37 % 400)) for i in range(900)] + [(5000 + i, "copy of one text") for i in range(500)] + [(1, "x"), (1, "x"), (None, "y"), (2, None), (3, "z" * 5000)]
    df = on_disk(rows)
    got = sharding.balanced_shards(df, shards=24).collect()
    size = lambda t: len((t or "").encode()) + 8
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(((d, size(t), zlib.crc32((t or "").encode())) for d, t in rows), key=repr)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    total, largest = sum(r.size for r in got), max(r.size for r in got)
    assert set(by) == set(range(24)) and all(abs(sum(r.size for r in s) - total / 24) <= largest for s in by.values())
    begin = 0
    for k in range(24):
        part = sorted(by[k], key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        for r in part:
            assert r.begin == begin and r.law == "bytes" and r.grown_shard is None
            begin += r.size
    assert begin == total
    assert sharding.balanced_shards(on_disk([], "empty")).collect() == []
    plan = sharding.balanced_shards(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
