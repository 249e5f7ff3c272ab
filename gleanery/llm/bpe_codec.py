"""BPE encoding and decoding by content-defined chunks.

A text is cut where a rolling hash over its last bytes says so, so passages that documents share are cut alike wherever they
stand; a chunk that a worker meets again is not encoded again. A cut may fall anywhere, so every join is repaired: from the last
place before it that what follows cannot change, the text is encoded anew, over more and more of what comes after, until that and the next
chunk's own encoding agree on where a word begins. From there on both are the same, as words are split from left to right.
"""

from __future__ import annotations

import array
import functools
import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .token_counts import byte_chars, model_path

MODEL = "byte_bpe_50k.json"
#: Words of the byte-level pre-tokenizer, a fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WINDOW = 16
#: One place in MASK + 1 is a cut, but none within LEAST bytes of another.
MASK = 255
LEAST = 64
#: Bytes of words and of chunks that a worker remembers; it then forgets the oldest, which costs time only.
WORD_BYTES = 16 << 20
CHUNK_BYTES = 64 << 20
#: Places of the table that tells whether a chunk has been met once.
MET = 1 << 20
#: Characters at either end of a chunk in which a space is looked for.
NEAR = 64
#: Characters after a place that may change whether a word ends there: the pattern looks no further.
AHEAD = 2
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_loaded: dict[str, "ChunkCodec"] = {}


def cuts(data: bytes, block: int = 1 << 16) -> list[int]:
    """Places of data, ascending, before which it is cut, each at the start of a character."""
    from .shingles import mix, power_table

    out: list[int] = []
    last, flat = 0, np.frombuffer(data, np.uint8)
    for at in range(0, len(flat), block):
        base = min(at, WINDOW)
        part = flat[at - base : at + block]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power_table(_BASE, len(part)), out=sums[1:])
        rolled = (sums[WINDOW:-1] - sums[: -WINDOW - 1]) * power_table(_INVERSE, len(part))[: max(len(part) - WINDOW, 0)]
        found = np.flatnonzero((mix(rolled) & np.uint64(MASK) == 0) & (part[WINDOW:] & 0xC0 != 0x80)) + WINDOW - base + at
        for p in found.tolist():
            if p - last >= LEAST:
                out.append(p)
                last = p
    return out


@functools.cache
def _unassigned() -> np.ndarray:
    """Which code points Python's Unicode tables do not know; of those alone, newer tables than the library's may think otherwise than it."""
    return np.fromiter((unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)), bool, 0x110000)


def _is_odd(text: str) -> bool:
    return not text.isascii() and bool(_unassigned()[np.frombuffer(text.encode("utf-32-le"), np.uint32)].any())


class Chunk:
    """A chunk's text, ids and words (if they were asked for); the first and last place near its ends, or -1, where a word begins whatever is beside the chunk, with
    the ids before them; the entry of the ids between."""

    __slots__ = ("text", "head", "tail", "n_head", "n_tail", "ids", "words", "inner")

    def __init__(self, text: str, head: int, tail: int):
        self.text, self.head, self.tail, self.n_head, self.n_tail, self.ids, self.words, self.inner = text, head, tail, 0, 0, [], None, None


def _plain_space(text: str, places) -> int:
    """The first of some places where a space stands between two characters that are none: words always begin there. -1 if there is none."""
    for i in places:
        if text[i] == " " and not text[i - 1].isspace() and not text[i + 1].isspace():
            return i
    return -1


class ChunkCodec:
    """encode(text) -> ids and decode(ids) -> text, equal to those of the tokenizers library for this vocabulary file."""

    def __init__(self, path: str):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_chars()
        self.char_of = {b: c for c, b in chars.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        own = {i: bytes(map(chars.__getitem__, t)) for t, i in spec["model"]["vocab"].items()}
        self.bytes_of = own | {i: c.encode("utf-8") for c, i in self.special.items()}
        self.digits_of = {i: str(i) for i in self.bytes_of}
        self.regex = regex.compile(PATTERN)
        # the engine merges by rank, as the library does by merge order; both orders are that of the ids
        self.engine = tiktoken.Encoding("chunks", pat_str=PATTERN, mergeable_ranks={b: i for i, b in own.items()}, special_tokens={}).encode_ordinary
        self.words = common.Memory(WORD_BYTES)
        self.chunks = common.Memory(CHUNK_BYTES)
        self.met = array.array("q", bytes(8 * MET))

    def _entry(self, ids) -> tuple:
        """(ids joined by commas, bytes that they decode to, their number, ids)."""
        return ",".join(map(self.digits_of.__getitem__, ids)), b"".join(map(self.bytes_of.__getitem__, ids)), len(ids), ids

    def _word(self, word: str) -> list[int]:
        """Ids of one word."""
        if len(word) > 64:
            return [t.id for t in self.library.model.tokenize("".join(map(self.char_of.__getitem__, word.encode("utf-8"))))]
        known = self.words.get(word, weight := 240 + 4 * len(word))
        return self.words.put(word, self.engine(word), weight) if known is None else known

    def _ids(self, words: list[str]) -> list[int]:
        return [i for w in words for i in self._word(w)]

    def _by_library(self, text: str) -> list[str]:
        return [text[i:j] for _, (i, j) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _chunk(self, data: bytes, words_of) -> "Chunk":
        known = self.chunks.get(data, weight := 1600 + 20 * len(data))
        if known is not None:
            return known
        known = self._new(data.decode("utf-8"), words_of)
        if len(data) <= 4096:
            h = hash(data) or 1
            if self.met[h % MET] == h:  # the second time, so it may come again
                if known.head >= 0 and known.n_tail > known.n_head:
                    known.inner = self._entry(known.ids[known.n_head : known.n_tail])
                self.chunks.put(data, known, weight)
            else:
                self.met[h % MET] = h
        return known

    def _new(self, text: str, words_of) -> "Chunk":
        c = Chunk(text, _plain_space(text, range(1, min(NEAR, len(text) - 1))), _plain_space(text, range(len(text) - 2, max(len(text) - NEAR, 0), -1)))
        if len(text) <= 4096 and words_of == self.regex.findall:
            c.ids = self.engine(text)
            c.n_head = len(self.engine(text[: c.head])) if c.head >= 0 else 0
            c.n_tail = len(c.ids) - len(self.engine(text[c.tail :])) if c.tail >= 0 else 0
        else:  # the engine would run out of stack on very long words, and may see words of odd characters otherwise
            c.head = c.tail = -1
            c.words = words_of(text)
            c.ids = self._ids(c.words)
        return c

    def _sure(self, c: "Chunk", words_of, least: int) -> tuple[int, int]:
        """A late place of a chunk where a word begins whatever follows it, and the number of ids before it, `least` or more."""
        if c.tail >= 0 and c.n_tail >= least:
            return c.tail, c.n_tail
        if c.words is None:
            c.words = words_of(c.text)
        n, size = len(c.words), len(c.text)
        while n and size > len(c.text) - AHEAD:
            n -= 1
            size -= len(c.words[n])
        return size, len(c.ids) - len(self._ids(c.words[n:]))

    def plain(self, text: str) -> list[tuple]:
        """Entries, in order, of a text without special tokens."""
        data = text.encode("utf-8")
        places = [0, *cuts(data), len(data)]
        words_of = self._by_library if _is_odd(text) else self.regex.findall
        chunks = [self._chunk(data[a:b], words_of) for a, b in zip(places, places[1:])]
        out: list[tuple] = []
        now, at, skip, k, glue = chunks[0], 0, 0, 1, 1  # the chunk at hand, where it starts, and how many of its ids are out already
        while k < len(chunks):
            end, following = at + len(now.text), chunks[k]
            place, last = self._sure(now, words_of, skip)
            if following.head >= 0 and end - at - place <= NEAR and words_of == self.regex.findall:  # both places are where a word begins, whatever is beside them
                agreed = self.engine(text[at + place : end + following.head]), following.n_head
            else:
                agreed = self._repair(text, at + place, end, following, words_of)
            self._put(out, now, skip, last)
            if agreed is not None:
                out.append(self._entry(agreed[0]))
                now, at, skip, k, glue = following, end, agreed[1], k + 1, 1
            else:  # no agreement within the next chunk: what is open is encoded anew with it, and with twice as many the next time
                more = chunks[k : k + glue]
                now = self._new(text[at + place : end + sum([len(c.text) for c in more])], words_of)
                at, skip, k, glue = at + place, 0, k + len(more), 2 * glue
        self._put(out, now, skip, len(now.ids))
        return out

    def _repair(self, text: str, sure: int, end: int, following: "Chunk", words_of):
        """(ids from `sure` on to a place where a word of the next chunk, which starts at `end`, begins; how many of its ids are before that), or None."""
        if following.words is None:
            following.words = words_of(following.text)
        words, size, reach = following.words, len(following.text), 24
        while True:
            stop = min(end + reach, end + size)
            anew, p, q, j = [], sure, end, 0
            for w in words_of(text[sure:stop]):
                anew.append(w)
                p += len(w)
                if p > stop - AHEAD and stop < len(text):
                    break
                while q < p and j < len(words):
                    q += len(words[j])
                    j += 1
                if p == q:
                    if q - end > size - AHEAD and end + size < len(text):
                        break  # what follows may still change that place of the next chunk
                    return self._ids(anew), len(self._ids(words[:j]))
            if stop == end + size:
                return None
            reach *= 8

    def _put(self, out: list, c: "Chunk", skip: int, last: int) -> None:
        """Entries of a chunk's ids from `skip` up to `last`; the inner ones as one if they are known so."""
        if c.inner is not None and skip <= c.n_head and last >= c.n_tail:
            if skip < c.n_head:
                out.append(self._entry(c.ids[skip : c.n_head]))
            out.append(c.inner)
            skip = c.n_tail
        if skip < last:
            out.append(self._entry(c.ids[skip:last]))

    def parts(self, text: str):
        """Entries of a text, special tokens among them."""
        at = 0
        while self.special:
            found = min(((i, -len(c), c) for c in self.special if (i := text.find(c, at)) >= 0), default=None)
            if found is None:
                break
            if found[0] > at:
                yield from self.plain(text[at : found[0]])
            i = self.special[found[2]]
            yield self._entry([i])
            at = found[0] + len(found[2])
        if at < len(text):
            yield from self.plain(text[at:] if at else text)

    def encode(self, text: str) -> list[int]:
        return [i for e in self.parts(text) for i in e[3]]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> ChunkCodec:
    if path not in _loaded:
        _loaded[path] = ChunkCodec(path)
    return _loaded[path]


def _coder(path, with_ids: bool):
    def run(batches):
        from gleanery.llm.bpe_codec import codec, model_path

        own = codec(model_path(path, MODEL))
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
        for batch in batches:
            rows = []
            for text in common.texts(batch.column("text")):
                parts = list(own.parts(text))
                decoded = b"".join([e[1] for e in parts]).decode("utf-8", "replace")
                joined = ",".join([e[0] for e in parts])
                rows.append((sum([e[2] for e in parts]), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest(), *(([i for e in parts for i in e[3]], decoded) if with_ids else ())))
            kinds = (pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.string())[: len(names) - 1]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds))], names)

    return common.freeing(run, "bpe_codec")


def encode_and_decode(documents: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256; with_ids adds ids and decoded.

    documents needs doc_id (long) and text; null counts as empty, which has no ids and decodes to an empty text. A special token's string in a
    text is that token, as is the library's default. Rows are independent: repeated rows give equal results, an empty table an
    empty one. path is the vocabulary's place on every executor; None is the one that public_tokenizers has.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_coder(path, with_ids), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if with_ids else ""))
