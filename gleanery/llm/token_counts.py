"""Token counts of a byte-pair vocabulary by merging with a heap over a linked list; no ids are made.

The vocabulary is a sentencepiece BPE model with byte fallback. A text is its characters, with U+2581 for spaces and one in front. Of all adjacent
pairs that the vocabulary knows, the one of lowest rank is merged, leftmost first, until there is none. The count is symbols at
the start less merges, where a character that the vocabulary lacks counts its UTF-8 bytes. No merge can span two characters
that stand side by side in no piece, so texts are cut there and equal parts are merged once per worker.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MODEL = "piece_bpe_32k.model"
#: Bytes of words, and of parts of words, that a worker remembers; it then forgets the oldest, which costs time only.
REMEMBERED = 72 << 20
SPACE = "\u2581"
_loaded: dict[str, "PieceCounter"] = {}


def model_path(path: str | None, name: str) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = [model.get_score(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        place = {s: i for i, s in enumerate(sorted(set(scores), reverse=True))}
        self.rank = {p: place[s] for p, s in zip(pieces, scores)}
        self.beside = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        joined = {c for p in pieces if len(p) > 1 for c in p}
        # a line end that no longer piece holds always stands alone; words then begin after it or after a space
        self.lines = "\n" not in joined
        self.spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        self.words = common.Memory(REMEMBERED)
        self.parts = common.Memory(REMEMBERED)

    def merged(self, part: str) -> int:
        """Tokens of a part: its symbols less the merges that a heap of adjacent pairs brings about."""
        rank, n = self.rank, len(part)
        count = n if part.isascii() else sum([1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in part])
        if n < 2:
            return count
        get, push, pop = rank.get, heapq.heappush, heapq.heappop
        piece, left, right = list(part), list(range(-1, n - 1)), [*range(1, n), -1]
        # rank and place in one integer; an entry is stale if what stands there now has another rank
        heap = [r << 40 | i for i in range(n - 1) if (r := get(part[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            i = top & 0xFFFFFFFFFF
            j = right[i]
            if j < 0 or not piece[i]:
                continue
            pair = piece[i] + piece[j]
            if get(pair) != top >> 40:
                continue
            count -= 1
            piece[i], piece[j] = pair, ""
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (r := get(pair + piece[k])) is not None:
                    push(heap, r << 40 | i)
            if (h := left[i]) >= 0 and (r := get(piece[h] + pair)) is not None:
                push(heap, r << 40 | h)
        return count

    def word(self, word: str) -> int:
        total, at, beside, parts = 0, 0, self.beside, self.parts
        for i in range(1, len(word) + 1):
            if i == len(word) or word[i - 1 : i + 1] not in beside:
                part = word[at:i]
                n = parts.get(part, 120) if len(part) <= 64 else self.merged(part)
                total, at = total + (parts.put(part, self.merged(part), 120) if n is None else n), i
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not (self.spaces and self.lines):
            return self.word(SPACE + text.replace(" ", SPACE))
        words, total = self.words, 0
        lines = text.split("\n")
        for k, line in enumerate(lines):
            parts = (line if k else " " + line).split(" ")
            # the first part of a line has no space in front; runs of spaces and U+2581 itself go with what follows them
            if "" in parts[1:] or SPACE in line:
                total += self.word((line if k else " " + line).replace(" ", SPACE))
                continue
            if parts[0]:
                total += self._known(words, parts[0])
            for p in parts[1:]:
                n = words.young.get(" " + p)
                total += self._known(words, " " + p) if n is None else n
        return total + (len(lines) - 1) * (1 if "\n" in self.rank else len(b"\n"))

    def _known(self, words: common.Memory, key: str) -> int:
        n = words.get(key, 120)
        if n is None:
            n = self.word(SPACE + key[1:] if key[0] == " " else key)
            if len(key) <= 64:
                words.put(key, n, 120)
        return n


def counter(path: str) -> PieceCounter:
    if path not in _loaded:
        _loaded[path] = PieceCounter(path)
    return _loaded[path]


def _counts(path, limit: int):
    def run(batches):
        # by name, so that what a worker remembers outlasts a task
        from gleanery.llm.token_counts import counter, model_path

        count = counter(model_path(path, MODEL)).count
        for batch in batches:
            text = common.texts(batch.column("text"))
            n = [count(t) for t in text]
            size = [len(t.encode("utf-8", "surrogatepass")) for t in text]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return common.freeing(run, "token_counts")


def token_counts(documents: DataFrame, limit: int = 4096, path: str | None = None) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens); null counts as empty, which has no tokens.

    documents needs doc_id (long) and text. Rows are independent: repeated rows give equal results, an empty table an empty one.
    path is the sentencepiece model's place on every executor; None is the one that public_tokenizers has.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_counts(path, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
