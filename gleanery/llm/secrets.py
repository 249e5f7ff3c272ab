"""Secret scans with a recursive decoding worklist.

A text is scanned as it is; then every part of it that could be an encoding (URL escapes, Unicode and HTML escapes, base64, UTF-16, and compressed
bytes under any of these) is decoded into a layer, each character of which knows the characters of the text it came from. Layers are
scanned and searched for encodings in turn until nothing new comes up; a layer seen before is not taken again, so cycles end.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
# the same matches as of AKIA[A-Z0-9]+ and [0-9a-f]+ that are long enough: both are maximal runs
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_URL = re.compile(r"%([0-9A-Fa-f]{2})")
_FORM = re.compile(r"%([0-9A-Fa-f]{2})|\+")
_NAMED = {"quot": '"', "apos": "'", "amp": "&", "lt": "<", "gt": ">", "nbsp": " ", "sol": "/", "bsol": "\\", "colon": ":", "equals": "=", "plus": "+", "lowbar": "_", "num": "#", "period": ".", "Tab": "\t", "NewLine": "\n"}
_SHORT = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}
_ESCAPES = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});|\\([nrtbf\"'/\\])|&(" + "|".join(_NAMED) + ");")
# lines that base64 was wrapped into are one run; its last line may be short
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{16,})*(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{1,15}(?![A-Za-z0-9+/_-]))?")
_LINE_END = re.compile(r"[\r\n\x20\t]+")
_UTF16 = re.compile(r"(?:[\t\n\r\x20-\x7e]\x00){16,}|(?:\x00[\t\n\r\x20-\x7e]){16,}")
# of zlib the two bytes that it begins with, for windows of every size: their number divides by 31, and no dictionary is asked for
_ZLIB = "|".join(f"\\x{a:02x}[" + "".join(f"\\x{b:02x}" for b in range(256) if (a << 8 | b) % 31 == 0 and not b & 32) + "]" for a in range(0x08, 0x80, 0x10))
_PACKED = re.compile(r"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd|" + _ZLIB)
_OPEN_RUN = re.compile(rb"(?:[A-Za-z0-9+/_=-]+|[\x20\t]*\n\r?)*")  # backwards
# all patterns and encodings need 16 such characters in a row, or are compressed
_WORTH = re.compile(r"[\t\n\r\x20-\x7e]{16}|" + _UTF16.pattern + "|" + _PACKED.pattern)
#: Bytes that one layer is decompressed to at a time; a larger one is scanned in parts, and counted. Parts overlap by OVERLAP, and by all of an encoded run that is not at its end.
LAYER_BYTES = 64 << 20
OVERLAP = 1 << 20
#: The largest window that a zstd frame may ask for; a frame that asks for more is not read, and counted.
WINDOW_BYTES = 128 << 20


def base_spans(text: str, data: bytes | None = None) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the plain matches, by start and kind."""
    out = []
    lowered = (text.encode("utf-8", "surrogatepass") if data is None else data).lower()
    if any(k in lowered for k in _KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _engine(raw: bytes):
    """What reads the compressed bytes that raw begins with, or None."""
    if raw[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(raw) > 2 and raw[0] & 15 == 8 and (raw[0] << 8 | raw[1]) % 31 == 0:
        return zlib.decompressobj()
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if raw[:4] == b"\x28\xb5\x2f\xfd":
        import zstandard

        return zstandard.ZstdDecompressor(max_window_size=WINDOW_BYTES).decompressobj()
    return None


def _pieces(raw: bytes, at: int):
    """What compressed bytes hold from a place on, of all members or frames one after the other, as far as they can be read; with the end of what was used."""
    while (engine := _engine(raw[at : at + 8])) is not None:
        for i in range(at, len(raw), 1 << 14):
            chunk = raw[i : i + (1 << 14)]
            try:
                out = engine.decompress(chunk)
            except Exception as error:  # not compressed after all, or broken from here on; each library has errors of its own
                if "memory" in str(error):
                    yield None, at
                return
            if out:
                yield out, min(len(raw), i + len(chunk))
            if getattr(engine, "eof", False):
                break
        else:
            return
        at = i + len(chunk) - len(engine.unused_data)
        yield b"", at
        while raw[at : at + 1] == b"\x00":  # padding
            at += 1


def _decompressed(raw: bytes, at: int, limit: int):
    """(part of the content, end of what was used so far, whether it has just passed the limit) of compressed bytes; parts overlap."""
    held, size, used, over, kept = [], 0, 0, False, 0
    for out, used in _pieces(raw, at):
        if out is None:
            yield b"", used, True
            continue
        held.append(out)
        size += len(out)
        if size > limit + kept:
            part = b"".join(held)
            yield part, used, not over
            run = _open_run(part)
            over, held = True, [part[-max(run, min(OVERLAP, limit // 2)) :]]
            size = kept = len(held[0])
    if used:
        yield b"".join(held), used, False


def _open_run(part: bytes) -> int:
    """Bytes at the end of part that may be the beginning of an encoded run, lines and all."""
    size = 1 << 16
    while True:
        run = _OPEN_RUN.match(part[-size:][::-1]).end()
        if run < size or size >= len(part):
            return run
        size *= 4


def _replaced(layer: str, escapes: re.Pattern, char):
    """layer with each escape as the one character that it stands for; starts and ends of all characters."""
    keep, ends = np.ones(len(layer), bool), np.arange(1, len(layer) + 1)
    for m in escapes.finditer(layer):
        keep[m.start() + 1 : m.end()] = False
        ends[m.start()] = m.end()
    return escapes.sub(char, layer), np.flatnonzero(keep), ends[keep]


def _escaped(m: re.Match) -> str:
    if m[7] is not None:
        return _SHORT.get(m[7], m[7])
    if m[8] is not None:
        return _NAMED[m[8]]
    n = next(int(g, 10 if k == 6 else 16) for k, g in enumerate(m.groups(), 1) if g is not None)
    return chr(n) if n <= 0x10FFFF and not 0xD800 <= n < 0xE000 else "\ufffd"


def _unbased(layer: str, a: int, b: int):
    """Bytes under base64, a character each, from each of the four places that the run may begin at, if they may hold anything."""
    run, at = layer[a:b].replace("-", "+").replace("_", "/"), np.arange(a, b)
    if "\n" in run:
        at = at[[c not in "\r\n\x20\t" for c in run]]
        run = _LINE_END.sub("", run)
    for k in range(4):
        n = len(run) - k
        n -= n % 4 == 1
        raw = base64.b64decode(run[k : k + n] + "=" * (-n % 4))
        inner = raw.decode("latin-1")
        if _WORTH.search(inner) or (_engine(raw) is not None):
            i = np.arange(len(raw))
            yield inner, at[k + i * 8 // 6], at[np.minimum(k + n, k - (-(i + 1) * 8 // 6)) - 1] + 1


def _layers(text: str, decoded: bool, limit: int):
    """Decodings of text: (new text, starts and ends in text of its characters, or of all, whether it is larger than the limit).

    Bytes stand as the characters of the same numbers: all patterns and encodings are ASCII, so one byte that is no text
    hides nothing beside it.
    """
    if decoded:
        raw, done = None, 0
        for at in sorted({0, *(m.start() for m in _PACKED.finditer(text))}):
            if at < done or _engine(text[at : at + 8].encode("latin-1", "replace")) is None:
                continue
            raw = text.encode("latin-1", "replace") if raw is None else raw
            for inner, done, large in _decompressed(raw, at, limit):
                yield inner.decode("latin-1"), at, done, large
    if "\x00" in text:
        for m in _UTF16.finditer(text):
            at = np.arange(m.start(), m.end(), 2)
            yield m[0].replace("\x00", ""), at, at + 2, False
    if "%" in text and _URL.search(text):
        yield *_replaced(text, _URL, lambda m: chr(int(m[1], 16))), False
        if "+" in text:  # of a form, where it is a space
            yield *_replaced(text, _FORM, lambda m: chr(int(m[1], 16)) if m[1] else " "), False
    if ("\\" in text or "&" in text) and _ESCAPES.search(text):
        yield *_replaced(text, _ESCAPES, _escaped), False
    for m in _BASE64.finditer(text):
        for inner, starts, ends in _unbased(text, m.start(), m.end()):
            yield inner, starts, ends, False


def scan(text: str, data: bytes | None = None, limit: int = LAYER_BYTES):
    """(base spans, all spans, layers opened, layers larger than the limit, read in parts); spans are (start, kind index, end) in the text."""
    base = base_spans(text, data)
    spans, seen, work, opened, closed = set(base), set(), [(text, None, None)], 0, 0
    while work:
        layer, first, last = work.pop()
        for inner, starts, ends, large in _layers(layer, first is not None, limit):
            closed += large
            if not inner or inner == layer:
                continue
            one = isinstance(starts, int)  # all characters stand for the same ones
            if first is not None:
                if isinstance(first, int):
                    starts, ends, one = first, last, True
                else:
                    starts, ends = (int(first[starts]), int(last[ends - 1])) if one else (first[starts], last[ends - 1])
            key = hashlib.blake2b(inner.encode("utf-8", "surrogatepass") + repr(starts if one else int(starts[0])).encode(), digest_size=16).digest()
            if key in seen:
                continue
            seen.add(key)
            opened += 1
            for a, kind, b in base_spans(inner):
                spans.add((starts, kind, ends) if one else (int(starts[a]), kind, int(ends[b - 1])))
            work.append((inner, starts, ends))
    return base, sorted(spans), opened, closed


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scanner(limit: int):
    def run(batches):
        for batch in batches:
            rows = []
            for text in common.texts(batch.column("text")):
                base, spans, opened, closed = scan(text, None, limit)
                count = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((*count, _joined(base), _joined(spans), opened, closed))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans", "n_layers", "n_closed"])

    return common.freeing(run)


def secret_spans(documents: DataFrame, limit: int = LAYER_BYTES) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex (plain matches), base_spans, spans (with those of decoded layers), n_layers, n_closed.

    Spans are kind:start:end in code points of the whole text, end exclusive, by start, then kind. A span found in a layer is
    mapped to the text's characters that it was decoded from. documents needs doc_id (long) and text; null counts as empty and has
    no spans. Rows are independent, so repeated rows give equal results; an empty table gives an empty table. A layer that
    decompresses to more than `limit` bytes is scanned in overlapping parts and counted in n_closed, as is a zstd frame whose window is too large to be read.
    Parts overlap by an encoded run that the first one does not end, however long; compressed bytes that lie across two parts are read as far as the overlap holds them.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scanner(limit), "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string, n_layers long, n_closed long")


def _redactor(mark: str, limit: int):
    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                spans = scan(text, None, limit)[1] if text else []
                parts, at = [], 0
                for a, _, b in spans:
                    if a >= at:
                        parts += [text[at:a], mark]
                    at = max(at, b)
                out.append("".join([*parts, text[at:]]) if spans else text)
            yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(out, pa.string()))

    return common.freeing(run)


def redact(documents: DataFrame, mark: str = "[SECRET]", limit: int = LAYER_BYTES) -> DataFrame:
    """documents with every span that holds a secret replaced by mark; overlapping spans become one. All other columns stay; null stays null."""
    return documents.mapInArrow(_redactor(mark, limit), documents.schema)
