"""What the first bytes of image files tell: kind and size, without decoding pixels."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import DataFrame


def header(data: bytes) -> tuple[str | None, int | None, int | None]:
    """(kind, width, height) of BMP, GIF, JPEG, PNG, TIFF and WEBP bytes; nulls where they are none of these or end too early."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR":
            return "PNG", *struct.unpack(">II", data[16:24])
        if data[:6] in (b"GIF87a", b"GIF89a"):
            return "GIF", *struct.unpack("<HH", data[6:10])
        if data[:2] == b"BM":
            if struct.unpack("<I", data[14:18])[0] == 12:
                return "BMP", *struct.unpack("<HH", data[18:22])
            width, height = struct.unpack("<ii", data[18:26])
            return "BMP", width, abs(height)
        if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
            return _webp(data)
        if data[:2] == b"\xff\xd8":
            return _jpeg(data)
        if data[:4] in (b"II*\x00", b"MM\x00*"):
            return _tiff(data)
    except (struct.error, IndexError):
        pass
    return None, None, None


def _jpeg(data: bytes):
    at = 2
    while data[at] == 0xFF:
        kind = data[at + 1]
        if kind == 0xFF:  # a fill byte
            at += 1
        elif kind == 1 or 0xD0 <= kind <= 0xD8:  # markers without a length
            at += 2
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return "JPEG", width, height
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None, None, None


def _webp(data: bytes):
    chunk = data[12:16]
    if chunk == b"VP8 " and data[23:26] == b"\x9d\x01\x2a":
        width, height = struct.unpack("<HH", data[26:30])
        return "WEBP", width & 0x3FFF, height & 0x3FFF
    if chunk == b"VP8L" and data[20] == 0x2F:
        bits = struct.unpack("<I", data[21:25])[0]
        return "WEBP", (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if chunk == b"VP8X":
        return "WEBP", int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
    return None, None, None


def _tiff(data: bytes):
    order = "<" if data[:2] == b"II" else ">"
    at = struct.unpack(f"{order}I", data[4:8])[0]
    found = {}
    for i in range(struct.unpack(f"{order}H", data[at : at + 2])[0]):
        tag, kind = struct.unpack(f"{order}HH", data[at + 2 + 12 * i : at + 6 + 12 * i])
        found[tag] = struct.unpack(order + ("H" if kind == 3 else "I"), data[at + 10 + 12 * i : at + 10 + 12 * i + (2 if kind == 3 else 4)])[0]
    return ("TIFF", found[256], found[257]) if 256 in found and 257 in found else (None, None, None)


def inspected(files: DataFrame) -> DataFrame:
    """path, kind, width, height, readable of image files (path, content); readable is whether the header tells a size of one pixel or more."""

    def run(batches):
        for b in batches:
            rows = [header(x or b"") for x in b.column("content").to_pylist()]
            readable = [bool(k and w and h and w > 0 and h > 0) for k, w, h in rows]
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([b.column("path"), *columns, pa.array(readable, pa.bool_())], ["path", "kind", "width", "height", "readable"])

    return files.select("path", "content").mapInArrow(run, "path string, kind string, width int, height int, readable boolean")
