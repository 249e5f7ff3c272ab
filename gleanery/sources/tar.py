"""TAR archives as a data source: read in byte ranges by the members' headers, written member by member, committed in two phases with a manifest.

Members are handed over in parts of bounded size, so neither an archive nor a member has to fit in a worker. Paths are URIs that pyarrow's file systems know.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import sys
import tarfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

FORMAT = "yolo-tar-shards-v1"
MANIFEST_NAME = "manifest.json"
#: Bytes of an archive that a task reads, and of a member that a row holds.
SPLIT_BYTES = 64 << 20
PART_BYTES = 8 << 20
#: Tasks of a scan, at most: beyond, each reads several splits.
MOST_TASKS = 1000
_BLOCK = tarfile.BLOCKSIZE

# planning and committing run in processes of Spark's own, which need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _padded(n: int) -> int:
    return -(-n // _BLOCK) * _BLOCK


def _records(data: bytes) -> dict[str, str]:
    """The records of an extended header: '<length> <key>=<value>' and a line end each."""
    out, at = {}, 0
    while at < len(data) and (space := data.find(b" ", at)) > 0:
        end = at + int(data[at:space])
        key, _, value = data[space + 1 : end - 1].partition(b"=")
        out[key.decode()] = value.decode("utf-8", "replace")
        at = end
    return out


def _members(file, size: int, at: int = 0):
    """(place of the first header, name, place of the content, size, whether a plain file) of each member from a header at `at` on that is no folder; a name of None where it can't be read further."""
    begin, long, more = None, None, {}
    while at + _BLOCK <= size:
        block = file.read_at(_BLOCK, at)
        if block == b"\0" * _BLOCK:
            return
        begin = at if begin is None else begin
        try:
            info = tarfile.TarInfo.frombuf(block, "utf-8", "surrogateescape")
            content = at + _BLOCK
            if info.type in (tarfile.GNUTYPE_LONGNAME, tarfile.XHDTYPE, tarfile.SOLARIS_XHDTYPE, tarfile.XGLTYPE):
                data = file.read_at(info.size, content)
                if info.type == tarfile.GNUTYPE_LONGNAME:
                    long = data.rstrip(b"\0").decode("utf-8", "replace")
                elif info.type != tarfile.XGLTYPE:
                    more = _records(data)
                at = content + _padded(info.size)
                continue
            length = int(more.get("size", info.size)) if info.isfile() else 0
        except (tarfile.HeaderError, ValueError):
            yield begin, None, 0, 0, False
            return
        if content + length > size:
            yield begin, None, 0, 0, False
            return
        if not info.isdir():
            yield begin, more.get("path") or long or info.name, content, length, info.isfile()
        at, begin, long, more = content + _padded(length), None, None, {}
    if begin is not None or size % _BLOCK or not size:
        yield at, None, 0, 0, False


@dataclass
class Range(InputPartition):
    path: str
    size: int
    start: int
    stop: int
    header: int  # where the first member from its start on begins, or the archive's end

    def __post_init__(self):
        super().__init__((self.path, self.start))


def _ranges(store, path: str, size: int, step: int):
    """Ranges of an archive. What has several is walked once by its headers, so that no range has to be read from the archive's beginning."""
    starts = list(range(0, max(size, 1), step))
    if len(starts) == 1:
        return [Range(path, size, 0, size, 0)]
    out = []
    with store.open_input_file(path) as file:
        for begin, *_ in _members(file, size):
            while len(out) < len(starts) and starts[len(out)] <= begin:
                a = starts[len(out)]
                out.append(Range(path, size, a, min(a + step, size), begin))
    return out + [Range(path, size, a, min(a + step, size), size) for a in starts[len(out) :]]  # no member begins there


class TarReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split, self.part = int(options.get("splitBytes", SPLIT_BYTES)), int(options.get("partBytes", PART_BYTES))
        self.content = options.get("content", "true") == "true"

    def partitions(self):
        store, path = fs.FileSystem.from_uri(self.path)
        info = store.get_file_info(path)
        found = [info] if info.type == fs.FileType.File else [x for x in store.get_file_info(fs.FileSelector(path, recursive=True)) if x.type == fs.FileType.File and x.path.endswith(".tar") and not any(p.startswith(("_", ".")) for p in posixpath.relpath(x.path, path).split("/"))]
        found.sort(key=lambda x: x.path)
        step = max(self.split, -(-sum(x.size for x in found) // MOST_TASKS))
        with ThreadPoolExecutor(8) as pool:
            return [r for ranges in pool.map(lambda x: _ranges(store, x.path, x.size, step), found) for r in ranges]

    def read(self, partition):
        """The members whose first header stands in the range."""
        schema = pa.schema([("archive", pa.string()), ("member", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("safe", pa.bool_()), ("part", pa.int32()), ("content", pa.binary())])
        store, _ = fs.FileSystem.from_uri(self.path)
        rows, held = [], 0
        if partition.header >= max(partition.stop, 1):
            return

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        with store.open_input_file(partition.path) as file:
            for begin, name, place, size, plain in _members(file, partition.size, partition.header):
                if begin >= max(partition.stop, 1):
                    break
                if begin < partition.start:
                    continue
                safe = None if name is None else plain and not name.startswith(("/", "\\")) and ".." not in name.replace("\\", "/").split("/")
                for k in range(-(-size // self.part) or 1 if self.content else 1):
                    data = file.read_at(min(self.part, size - k * self.part), place + k * self.part) if self.content and name is not None else None
                    rows.append((partition.path, name, None if name is None else place, None if name is None else size, safe, k, data))
                    held += len(data or b"") + 200
                    if held >= self.part:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


@dataclass
class Shards(WriterCommitMessage):
    shards: list = field(default_factory=list)


class TarWriter(DataSourceArrowWriter):
    """Writes rows (split, shard, name, size, part, content, boxes), sorted by split, shard, name and part, all of a shard in one task."""

    def __init__(self, options, overwrite: bool):
        self.path, self.staging, self.overwrite = options["path"].rstrip("/"), f"_staging-{uuid.uuid4().hex}", overwrite

    def _store(self):
        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator):
        store, root = self._store()
        done, now, out, name, left = [], None, None, None, 0
        folder = f"{root}/{self.staging}"
        store.create_dir(folder, recursive=True)

        def put(data):
            out.write(data)
            now["sum"].update(data)
            now["size"] += len(data)

        def close_member():
            if name is not None and left:
                raise ValueError(f"{name}: {left} bytes are missing")

        def close():
            if now is not None:
                close_member()
                put(b"\0" * (2 * _BLOCK))
                put(b"\0" * (-now["size"] % tarfile.RECORDSIZE))
                out.close()
                done.append({k: v for k, v in now.items() if k != "sum"} | {"sha256": now["sum"].hexdigest()})

        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if now is None or (now["split"], now["shard"]) != (row["split"], row["shard"]):
                        close()
                        now = {"split": row["split"], "shard": row["shard"], "file": f"{folder}/{uuid.uuid4().hex}.tar", "size": 0, "images": 0, "boxes": 0, "sum": hashlib.sha256()}
                        out, name, left = store.open_output_stream(now["file"]), None, 0
                    data = row["content"] or b""
                    if row["part"] == 0:
                        close_member()
                        name, left = row["name"], row["size"]
                        info = tarfile.TarInfo(name)
                        info.size = left
                        put(info.tobuf(tarfile.PAX_FORMAT))
                        now["images"] += 1
                        now["boxes"] += row["boxes"] or 0
                    elif row["name"] != name:
                        raise ValueError(f"{row['name']}: its first part is missing")
                    if len(data) > left:
                        raise ValueError(f"{name}: more bytes than its size")
                    put(data)
                    left -= len(data)
                    if not left:
                        put(b"\0" * (-row["size"] % _BLOCK))
            close()
        except BaseException:
            if out is not None:
                out.close()
            for x in [*done, *([now] if now else [])]:
                if store.get_file_info(x["file"]).type == fs.FileType.File:
                    store.delete_file(x["file"])
            raise
        return Shards(done)

    def commit(self, messages):
        """Moves the tasks' files to their places; what makes them count, the manifest, is written last."""
        store, root = self._store()
        shards = sorted((x for m in messages if m is not None for x in m.shards), key=lambda x: (x["split"], x["shard"]))
        names = [(x["split"], x["shard"]) for x in shards]
        twice = next((n for n in names if names.count(n) > 1), None) if len(set(names)) < len(names) else None
        if twice:
            self.abort(messages)
            raise ValueError(f"shard {twice} was written by several tasks")
        place = f"{root}/{MANIFEST_NAME}"
        before = []
        if not self.overwrite and store.get_file_info(place).type == fs.FileType.File:
            with store.open_input_stream(place) as f:
                before = json.loads(f.read())["shards"]
        store.create_dir(f"{root}/shards", recursive=True)
        listed = []
        for x in shards:
            path = f"shards/{x['split']}-{x['shard']:05d}.tar"
            store.move(x["file"], f"{root}/{path}")
            listed.append({"path": path, "size": x["size"], "sha256": x["sha256"], "split": x["split"], "images": x["images"], "boxes": x["boxes"]})
        kept = [x for x in before if x["path"] not in {y["path"] for y in listed}]
        every = sorted(kept + listed, key=lambda x: x["path"])
        body = {"format": FORMAT, "shards": every, "total_shards": len(every), "total_bytes": sum(x["size"] for x in every)}
        with store.open_output_stream(f"{place}.new") as f:
            f.write(json.dumps(body, indent=2).encode())
        store.move(f"{place}.new", place)
        store.delete_dir(f"{root}/{self.staging}")

    def abort(self, messages):
        store, root = self._store()
        if store.get_file_info(f"{root}/{self.staging}").type == fs.FileType.Directory:
            store.delete_dir(f"{root}/{self.staging}")


class TarSource(DataSource):
    """Format 'tar_shards'. Read options: path (an archive or a folder of them), content ('false' for a listing), splitBytes, partBytes."""

    @classmethod
    def name(cls):
        return "tar_shards"

    def schema(self):
        return "archive string, member string, offset long, size long, safe boolean, part int, content binary"

    def reader(self, schema):
        return TarReader(self.options)

    def writer(self, schema, overwrite):
        return TarWriter(self.options, overwrite)


def read_tar(spark: SparkSession, path: str, content: bool = True, split_bytes: int = SPLIT_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """archive, member, offset, size, safe, part, content of the archives at path: a row for each part of a member, whose contents in order of part are its own.

    Links and paths that leave the folder are not safe; folders are left out. Where an archive can't be read further, a row has member null.
    """
    spark.dataSource.register(TarSource)
    options = {"content": str(content).lower(), "splitBytes": split_bytes, "partBytes": part_bytes}
    return spark.read.format("tar_shards").options(**options).load(path)


def write_tar(rows: DataFrame, path: str, mode: str = "append", partitions: int | None = None) -> None:
    """Writes rows (split, shard, name, content; size, part and boxes if there are any) as shards/<split>-<shard>.tar below path, with the manifest of all that is there.

    A task writes a shard by itself, part by part. Nothing counts before all tasks are done; what an aborted one has written is deleted.
    """
    spark = rows.sparkSession
    spark.dataSource.register(TarSource)
    have = lambda c, other: F.col(c) if c in rows.columns else other
    flat = rows.select(F.col("split").cast("string").alias("split"), F.col("shard").cast("int").alias("shard"), F.col("name").cast("string").alias("name"), have("size", F.coalesce(F.octet_length("content"), F.lit(0))).cast("long").alias("size"), have("part", F.lit(0)).cast("int").alias("part"), F.col("content").cast("binary").alias("content"), have("boxes", F.lit(0)).cast("long").alias("boxes"))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    flat.repartition(n, "split", "shard").sortWithinPartitions("split", "shard", "name", "part").write.format("tar_shards").mode(mode).save(path)
