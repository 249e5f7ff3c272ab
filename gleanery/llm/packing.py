"""Best-fit packing by vectors: tokens, documents and attention cost.

Documents are tokenised, ended and cut to pieces; pieces go, longest first, into the sequence that they fit best. A sequence has three
residual capacities; of the sequences that hold a piece under all of them, the one is taken whose residual fits best, by
least weighted norm of what would be left or by greatest weighted dot product of piece and residual. Pieces are dealt out evenly
into groups of a bounded number, each packed by one task; only the last sequences of a group can be badly filled.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .token_counts import byte_chars, model_path

MODEL = "word_bpe_49k.json"
CAPACITY = 4096
END = 1
#: Of the shares of tokens, documents and squared lengths that a piece would leave free, in the choice of its sequence.
WEIGHTS = (1.0, 0.5, 0.5)
#: Pieces that one task packs.
GROUP = 20_000
#: Bytes of words, and of parts of words, that a worker remembers; it then forgets the oldest, which costs time only.
REMEMBERED = 72 << 20
REMEMBERED_PARTS = 72 << 20
_loaded: dict[str, "WordEncoder"] = {}


class WordEncoder:
    """Ids of a text as little-endian 32-bit integers, equal to the library's; words are encoded once per worker."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.chars = {b: c for c, b in byte_chars().items()}
        self.words = common.Memory(REMEMBERED)
        self.parts = common.Memory(REMEMBERED_PARTS)
        # the vocabulary's own split of words, a fixed value
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
        self.simple = regex.compile(r"[\x21-\x7e¡-ɏ]+")

    def encoded(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, word: bytes) -> bytes:
        """Ids of a word without ASCII white space, which the pattern never joins to others."""
        text = word.decode("utf-8", "surrogatepass")
        # below U+0250 nothing composes and lower case is by character; special tokens are left to the library
        if not self.simple.fullmatch(text) or "<|" in text:
            return self.encoded(text)
        out = []
        text = text.lower()
        for part in (text,) if text.isalpha() else self.split.findall(text):
            ids = self.parts.get(part, 130) if len(part) <= 64 else self.merged(part)
            out.append(self.parts.put(part, self.merged(part), 130) if ids is None else ids)
        return b"".join(out)

    def merged(self, part: str) -> bytes:
        """Ids of one part, by the library's merges alone: it is lower-cased and split already."""
        symbols = part if part.isascii() else "".join([self.chars[b] for b in part.encode("utf-8")])
        ids = [t.id for t in self.library.model.tokenize(symbols)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ids(self, text: str) -> bytes:
        words = text.encode("utf-8", "surrogatepass").split()
        found = list(map(self.words.young.get, words))
        if None in found:
            for i, w in enumerate(words):
                if found[i] is None:
                    known = self.words.get(w, 130)
                    found[i] = self.words.put(w, self.word(w), 130) if known is None and len(w) <= 64 else known or self.word(w)
        return b"".join(found)


def encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def _pieces(path, capacity: int, end: int):
    def run(batches):
        from gleanery.llm.packing import encoder, model_path

        ids_of = encoder(model_path(path, MODEL)).ids
        last, step = np.array([end], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), common.texts(batch.column("text"))):
                data = ids_of(text) + last
                for piece, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return common.freeing(run, "packing")


def best_fit(items: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """The bin of each item. items is (n, d), in the order in which they are placed, each within capacity; every capacity is a share of the whole times its weight."""
    scale = weights / np.maximum(capacity, 1)
    left = np.empty((max(1, len(items)), items.shape[1]), np.float64)
    out = np.empty(len(items), np.int64)
    names = np.empty(max(1, len(items)), np.int64)
    used = opened = 0
    least = np.minimum.accumulate(items[::-1], axis=0)[::-1] if len(items) else items
    for i, item in enumerate(items):
        open_ = left[:used]
        fits = (open_ >= item).all(axis=1)
        if fits.any():
            at = np.flatnonzero(fits)
            rest = open_[at]
            if rule == "dot":
                at = at[np.argmax(rest @ (item * scale * scale))]
            else:
                d = (rest - item) * scale
                at = at[np.argmin(np.einsum("ij,ij->i", d, d))]
            left[at] -= item
        else:
            at = used
            left[at], names[at] = capacity - item, opened
            used, opened = used + 1, opened + 1
        out[i] = names[at]
        # a bin that no later item fits is closed: the last open one takes its place
        if i + 1 < len(items) and (left[at] < least[i + 1]).any():
            used -= 1
            left[at], names[at] = left[used], names[used]
    return out


def _packer(capacity, weights, rule: str):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("uid", "ascending")])
        length = table.column("length").to_numpy().astype(np.float64)
        bins = best_fit(np.column_stack([length, np.ones(len(length)), length * length]), np.array(capacity, np.float64), np.array(weights, np.float64), rule)
        order = np.argsort(bins, kind="stable")
        sizes = length[order].astype(np.int64)
        before = np.cumsum(sizes) - sizes
        first = np.concatenate(([True], bins[order][1:] != bins[order][:-1])) if len(order) else np.zeros(0, bool)
        offset = before - np.maximum.accumulate(np.where(first, before, 0)) if len(order) else before
        table = table.take(pa.array(order))
        name = np.asarray(table.column("part")) * (1 << 40) + bins[order]
        return table.drop_columns(["uid", "part"]).append_column("sequence_id", pa.array(name, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack(documents: DataFrame, capacity: int = CAPACITY, most_documents: int = CAPACITY, most_cost: int = CAPACITY * CAPACITY, weights=WEIGHTS, rule: str = "norm", path: str | None = None, end: int = END, group: int = GROUP) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then `end`; only documents of more than `capacity` ids are cut, into pieces of that many, the last
    the rest. A sequence holds pieces of `capacity` ids, `most_documents` pieces and `most_cost` of squared lengths at
    most; the preset values of the last two never bind, yet all three residuals, by `weights`, choose among the sequences that a piece fits. documents needs doc_id (long) and text; null counts as empty, whose
    only id is `end`. Repeated rows and ids are packed as rows of their own; an empty table gives an empty table. A piece whose
    own cost passes `most_cost` has a sequence to itself. Pieces that fill a sequence need no search.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = docs.mapInArrow(_pieces(path, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = common.keep(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    alone = (F.col("length") >= capacity) | (F.col("length") * F.col("length") > most_cost)
    whole = pieces.where(alone).select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    some = pieces.where(~alone)
    parts = max(1, -(-some.count() // group))
    dealt = some.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)))
    limits = (capacity, most_documents, most_cost)
    packed = dealt.groupBy("part").applyInArrow(_packer(limits, weights, rule), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return whole.union(packed)
