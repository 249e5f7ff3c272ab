"""TAR shards, the ledger as a stream, and the set of known hashes: round trips, restarts, aborted tasks."""

import hashlib
import io
import json
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from gleanery.operators import package
from gleanery.sources import tar


def member_rows():
    rows = [("train", 0, f"d/{i:03d}.txt", bytes([i % 256]) * (i * 97 % 3000)) for i in range(60)] + [("train", 1, "x" * 180 + ".txt", b"long name"), ("val", 0, "../up", b"1"), ("val", 0, "ü.txt", b""), ("val", 0, "big", os.urandom(300_000))]
    return rows


def test_tar_round_trip_in_parts_and_ranges(spark, tmp_path):
    rows = member_rows()
    tar.write_tar(spark.createDataFrame(rows, "split string, shard int, name string, content binary").repartition(4), f"file://{tmp_path}/out")
    with open(f"{tmp_path}/out/manifest.json") as f:
        manifest = json.load(f)
    assert [s["path"] for s in manifest["shards"]] == ["shards/train-00000.tar", "shards/train-00001.tar", "shards/val-00000.tar"] and manifest["total_bytes"] == sum(s["size"] for s in manifest["shards"])
    assert sum(s["images"] for s in manifest["shards"]) == len(rows)
    for s in manifest["shards"]:
        with open(f"{tmp_path}/out/{s['path']}", "rb") as f:
            data = f.read()
        assert len(data) == s["size"] and hashlib.sha256(data).hexdigest() == s["sha256"]
        with tarfile.open(fileobj=io.BytesIO(data)) as t:  # another reader finds the same
            want = {n: c for sp, sh, n, c in rows if s["path"] == f"shards/{sp}-{sh:05d}.tar"}
            assert {m.name: t.extractfile(m).read() for m in t} == want
    assert sorted(os.listdir(f"{tmp_path}/out")) == ["manifest.json", "shards"]
    got = tar.read_tar(spark, f"file://{tmp_path}/out", split_bytes=5000, part_bytes=1000)
    assert got.rdd.getNumPartitions() > 60
    parts = sorted((r.archive.rsplit("/", 1)[1], r.member, r.part, bytes(r.content)) for r in got.collect())
    back = {}
    for archive, name, _, content in parts:
        back[archive, name] = back.get((archive, name), b"") + content
    assert back == {(f"{sp}-{sh:05d}.tar", n): c for sp, sh, n, c in rows} and max(len(p[3]) for p in parts) == 1000
    listing = tar.read_tar(spark, f"file://{tmp_path}/out", content=False).collect()
    assert {r.member: (r.size, r.safe) for r in listing} == {n: (len(c), n != "../up") for _, _, n, c in rows} and all(r.content is None for r in listing)


def test_members_arrive_in_parts_and_shards_are_added(spark, tmp_path):
    big = os.urandom(50_000)
    parts = [("train", 3, "big.bin", len(big), k, big[k * 7000 : k * 7000 + 7000]) for k in range(8)]
    tar.write_tar(spark.createDataFrame(parts, "split string, shard int, name string, size long, part int, content binary").repartition(5), f"file://{tmp_path}/o")
    tar.write_tar(spark.createDataFrame([("train", 4, "s", b"1", 2)], "split string, shard int, name string, content binary, boxes int"), f"file://{tmp_path}/o")
    with open(f"{tmp_path}/o/manifest.json") as f:
        shards = json.load(f)["shards"]
    assert [(s["path"], s["images"], s["boxes"]) for s in shards] == [("shards/train-00003.tar", 1, 0), ("shards/train-00004.tar", 1, 2)]
    with tarfile.open(f"{tmp_path}/o/shards/train-00003.tar") as t:
        assert t.extractfile("big.bin").read() == big


def test_aborted_writes_leave_nothing(spark, tmp_path):
    tar.write_tar(spark.createDataFrame([("train", 0, "a", b"1")], "split string, shard int, name string, content binary"), f"file://{tmp_path}/o")
    with open(f"{tmp_path}/o/manifest.json") as f:
        before = f.read()
    bad = spark.createDataFrame([("train", 1, "fine", 1, 0, b"1"), ("train", 2, "short", 10, 0, b"12345")], "split string, shard int, name string, size long, part int, content binary")
    with pytest.raises(Exception, match="bytes are missing"):
        tar.write_tar(bad, f"file://{tmp_path}/o", partitions=4)
    with open(f"{tmp_path}/o/manifest.json") as f:
        assert f.read() == before
    assert sorted(os.listdir(f"{tmp_path}/o")) == ["manifest.json", "shards"] and os.listdir(f"{tmp_path}/o/shards") == ["train-00000.tar"]


def test_broken_archives_are_rows(spark, tmp_path):
    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w", format=tarfile.GNU_FORMAT) as t:
        for name, kind in (("n" * 150, tarfile.REGTYPE), ("link", tarfile.SYMTYPE), ("dir", tarfile.DIRTYPE), ("last", tarfile.REGTYPE)):
            info = tarfile.TarInfo(name)
            info.type, info.size, info.linkname = kind, 600 if kind == tarfile.REGTYPE else 0, "x" if kind == tarfile.SYMTYPE else ""
            t.addfile(info, io.BytesIO(b"z" * 600))
    os.makedirs(f"{tmp_path}/in")
    good = buffer.getvalue()
    for name, data in (("good", good), ("cut", good[:1900]), ("text", b"no archive at all" * 100), ("empty", b"")):
        with open(f"{tmp_path}/in/{name}.tar", "wb") as f:
            f.write(data)
    got = {}
    for r in tar.read_tar(spark, f"file://{tmp_path}/in", split_bytes=700).collect():
        got.setdefault(r.archive.rsplit("/", 1)[1], []).append((r.member, r.size, r.safe))
    assert sorted(got["good.tar"]) == sorted([("n" * 150, 600, True), ("link", 0, False), ("last", 600, True)])
    assert None in [m for m, _, _ in got["cut.tar"]] and got["text.tar"] == [(None, None, None)] == got["empty.tar"]


def test_ranges_read_only_their_own_headers(tmp_path, monkeypatch):
    """Twice the archive means twice the headers that are read, not four times; and no more tasks than MOST_TASKS, with the same rows."""
    looked, members = [0], tar._members
    monkeypatch.setattr(tar, "_members", lambda *a: (looked.__setitem__(0, looked[0] + 1) or x for x in members(*a)))

    def read(n):
        with tarfile.open(f"{tmp_path}/{n}.tar", mode="w") as t:
            for i in range(n):
                info = tarfile.TarInfo(f"{i}.txt")
                info.size = 900
                t.addfile(info, io.BytesIO(b"y" * 900))
        reader, looked[0] = tar.TarReader({"path": f"file://{tmp_path}/{n}.tar", "splitBytes": "3000"}), 0
        ranges = reader.partitions()
        return ranges, [m for r in ranges for b in reader.read(r) for m in b.column("member").to_pylist()], looked[0]

    for n in (200, 400):
        ranges, found, count = read(n)
        assert len(ranges) > n // 3 and found == [f"{i}.txt" for i in range(n)] and count <= 3 * n
    monkeypatch.setattr(tar, "MOST_TASKS", 7)
    ranges, again, _ = read(400)
    assert len(ranges) == 7 and again == found


def parts_read(df):
    return len(df.inputFiles())


def test_known_keys_open_only_what_may_hold_them(spark, tmp_path):
    from gleanery.streaming.known import KnownKeys

    known = KnownKeys(spark, f"file://{tmp_path}/known", "h")
    assert known.parts(spark.createDataFrame([("a",)], "h string")) == [] and known.fresh(spark.createDataFrame([("a", 1)], "h string, o long"), "o").count() == 1
    old = [(hashlib.sha256(str(i).encode()).hexdigest(), i) for i in range(3000)]
    known.add(spark.createDataFrame(old, "h string, o long"), 0)
    every = parts_read(known._table("keys", "h string, part string, batch long"))
    assert every >= 250
    one = spark.createDataFrame([(old[7][0], 1), ("never seen", 2), ("never seen either", 3), (None, 4)], "h string, o long")
    parts = known.parts(one)
    digits = lambda h: hashlib.sha256(h.encode()).hexdigest()[:2]
    assert digits(old[7][0]) in parts and len(parts) <= 3
    assert parts_read(known.known(parts).where("h is not null")) == every or known.known(parts)._jdf.queryExecution().executedPlan().toString().count("PartitionFilters: [part") == 1
    files = {f.split("part=")[1][:2] for f in (r.f for r in known.known(parts).select(F.input_file_name().alias("f")).distinct().collect())}
    assert files == set(parts)
    assert sorted(r.o for r in known.fresh(one, "o").collect()) == [2, 3]
    assert known.parts(spark.createDataFrame(old, "h string, o long")) == sorted({digits(h) for h, _ in old})


def test_ingest_restarts_where_it_was(spark, tmp_path, monkeypatch):
    from gleanery.streaming import known

    schema, root = "o long, h string", f"file://{tmp_path}"
    put = lambda n, rows: spark.createDataFrame(rows, schema).write.parquet(f"{root}/in/{n}")
    run = lambda: known.ingest(spark.readStream.schema(schema).parquet(f"{root}/in/*"), f"{root}/known", "h", "o", f"{root}/state", f"{root}/out")
    put(1, [(1, "a"), (2, "a"), (3, "b"), (9, None)])
    run()
    put(2, [(4, "b"), (5, "c"), (6, "d"), (7, "d")])
    real = known.KnownKeys.add

    def cut_off(self, rows, batch):
        real(self, rows, batch)
        raise RuntimeError("lost between write and commit")

    monkeypatch.setattr(known.KnownKeys, "add", cut_off)
    with pytest.raises(Exception, match="lost between"):
        run()
    monkeypatch.setattr(known.KnownKeys, "add", real)
    run()  # the batch is marked: nothing is written again
    os.remove(f"{tmp_path}/known/log/batch=1/_SUCCESS")
    state = spark.read.parquet(f"{root}/known/keys").count()
    k = known.KnownKeys(spark, f"{root}/known", "h")
    again = k.fresh(spark.read.schema(schema).parquet(f"{root}/in/2"), "o", 1)  # what a batch that was cut off gives when it is run again
    assert sorted((r.o, r.h) for r in again.collect()) == [(5, "c"), (6, "d")]
    k.add(again, 1)
    assert spark.read.parquet(f"{root}/known/keys").count() == state == 4
    assert sorted((r.o, r.h) for r in spark.read.parquet(f"{root}/out").collect()) == [(1, "a"), (3, "b"), (5, "c"), (6, "d")]


def plain_ledger(events, patience, until):
    from gleanery.streaming.machine import FAILS_TO, FOLLOWS

    out, state = [], {}
    for k, at, seq, status in sorted(events, key=lambda e: (e[1], e[2])):
        s, t, q, n = state.get(k, ("", None, None, 0))
        if s in FAILS_TO and t + patience <= at:
            out.append((k, t + patience, None, FAILS_TO[s], s, n, True, "timeout"))
            s, t = FAILS_TO[s], t + patience
        if t is not None and (at, seq) <= (t, q):
            out.append((k, at, seq, status, s, n, False, "late"))
        elif status not in FOLLOWS.get(s, ()):
            out.append((k, at, seq, status, s or None, n, False, "not_allowed"))
        else:
            out.append((k, at, seq, status, s or None, n + (status == "downloading"), True, None))
            s, t, q, n = status, at, seq, n + (status == "downloading")
        state[k] = (s, t, q, n)
    for k, (s, t, _, n) in state.items():
        if s in FAILS_TO and t + patience <= until:
            out.append((k, t + patience, None, FAILS_TO[s], s, n, True, "timeout"))
    return sorted(out, key=repr)


def test_ledger_stream_with_restarts(spark, tmp_path):
    import random

    from gleanery.streaming import incremental, machine

    rng, base = random.Random(4), 1_704_067_200
    names = [s for s in machine.FOLLOWS if s] + ["ingested", "nonsense"]
    events, clock = [], {}
    for i in range(1200):
        k = rng.randrange(60)
        likely = rng.choice(machine.FOLLOWS.get(clock.get(k, ""), ("new",)))
        status = likely if rng.random() < 0.8 else rng.choice(names)
        clock[k] = status
        events.append((k, base + i * 20 + rng.randrange(15), i, status))
    schema = "user long, at long, seq long, status string"
    for n in range(3):
        spark.createDataFrame(events[n * 400 : n * 400 + 400], schema).selectExpr("user", "timestamp_seconds(at) AS ts", "seq", "status").repartition(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema("user long, ts timestamp, seq long, status string").parquet(f"file://{tmp_path}/in/*")
        told = machine.ledger(stream, "user", "ts", "seq", "status", 25 * 60, "1 minute")
        incremental.run_to_end(told, f"file://{tmp_path}/out", f"file://{tmp_path}/state")  # each run goes on from the state of the last
    got = spark.read.parquet(f"file://{tmp_path}/out").selectExpr("key", "unix_seconds(at) AS at", "seq", "status", "previous", "attempts", "accepted", "reason").collect()
    want = plain_ledger(events, 25 * 60, max(e[1] for e in events) - 60)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert {r.reason for r in got} >= {None, "timeout", "not_allowed"}


def whole(path):
    parts = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    text = []
    for p in parts:
        with open(f"{path}/{p}", encoding="utf-8") as f:
            text.append(f.read().replace("\n", ""))
    return len(parts), "".join(text)


def test_documents_larger_than_a_row(spark, tmp_path):
    from gleanery.operators import package
    from gleanery.sources import sinks

    rows = [("val" if i % 5 else "test", f"i{i % 70}" if i % 5 else f"t{i % 40}", i, 0.5, 0.25, i / 1000, 0.5, 100.0, 200.0) for i in range(700)]
    boxes = spark.createDataFrame(rows, "split string, image string, line int, cx double, cy double, w double, h double, width double, height double")
    ids = package.coco_ids(boxes, "split", "image", ["line"])
    want = {r.split: r.document for r in package.coco_document(ids, "split").collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for split, document in want.items():
            sinks.write_document(package.coco_lines(ids.where(F.col("split") == split), "split"), f"file://{tmp_path}/{split}", "section", "n")
            n, text = whole(f"{tmp_path}/{split}")
            assert n > 3 and text == document
        counts = spark.createDataFrame([(m, k, i) for i, (m, k) in enumerate((m, k) for m in ("b", 'a"q', "c") for k in ("x", "y:1", "ü", 'q"'))] + [("one", "only", 7)], "metric string, key string, n long")
        sinks.write_document(sinks.audit_lines(counts), f"file://{tmp_path}/audit", "metric", "key")
        want = {}
        for r in sorted(counts.collect()):
            want.setdefault(r.metric, {})[r.key] = r.n
        assert whole(f"{tmp_path}/audit")[1] == json.dumps(want, ensure_ascii=False, separators=(",", ":"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_coco_sections_read_written_ids(spark):
    """The ids are numbered once and written; no section of the document numbers them anew."""
    side = ", ".join(f"0.5D AS {c}" for c in ("cx", "cy", "w", "h", "width", "height"))
    boxes = spark.sql(f"SELECT 'train' AS split, id % 5 AS image, id AS line, {side} FROM range(20)")
    plan = package.coco_lines(package.coco_ids(boxes, "split", "image", ["line"]), "split")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" in plan


def test_ledger_writes_a_record_once_a_batch():
    from types import SimpleNamespace

    from gleanery.streaming import machine

    calls, held = [], {}

    class Record:
        exists = lambda self: calls.append("exists") or "state" in held
        get = lambda self: calls.append("get") or held.get("state")
        update = lambda self, new: calls.append("update") or held.update(state=new)

    timers = set()
    own = machine.Ledger(1_000_000)
    own.record, own.handle = Record(), SimpleNamespace(registerTimer=lambda t: calls.append("on") or timers.add(t), deleteTimer=lambda t: calls.append("off") or timers.discard(t))
    event = lambda at, seq, status: SimpleNamespace(at=at, seq=seq, status=status)
    told = list(own.handleInputRows((1,), [event(1000, 1, "new"), event(2000, 2, "downloading"), event(3000, 3, "downloaded"), event(4000, 4, "extracting")], None))
    assert [r.accepted for r in told] == [True] * 4 and held["state"][0] == "extracting" and timers == {1004}
    assert calls == ["get", "update", "on"] or sorted(calls) == ["get", "on", "update"]
    calls.clear()
    assert [r.reason for r in own.handleInputRows((1,), [event(500, 5, "extracted")], None)] == ["late"] and calls == ["get"]
    expired = list(own.handleExpiredTimer((1,), None, SimpleNamespace(getExpiryTimeInMs=lambda: 1004)))
    assert [r.reason for r in expired] == ["timeout"] and held["state"][0] == "extract_failed" and not timers
