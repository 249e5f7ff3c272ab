"""Spelling variants: words one edit apart, from blocks of a forward and a reversed sorted dictionary, and the common form each leads to."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LETTERS = 6
LEAST = 5
#: A form has so many times the occurrences of the word it replaces.
TIMES = 5
#: One run in so many loses a code point, by its document and letters.
NOISE = 199
#: Words of a block whose pairs are compared; larger ones are subdivided.
BLOCK = 128
#: Pairs compared at once.
_PAIRS = 1 << 17
_RESULT = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def word_counts(documents: DataFrame, noise: int = NOISE) -> DataFrame:
    """word, n: the runs of letters of all texts, A-Z lower-cased; where `noise` divides crc32('<doc_id>:<run>'), less the code point at its remainder by the run's length."""
    # a run under LETTERS can't become a word of LETTERS
    runs = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN), 0)).alias("run"))
    runs = runs.where(F.length("run") >= LETTERS)
    # lower() is the quicker of the two, but right for ASCII only
    runs = runs.withColumn("run", F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(common.ascii_lower(F.col("run"))))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    cut = (h % F.length("run")).cast("int")
    word = F.when(h % noise == 0, F.concat(F.left("run", cut), F.substr("run", cut + 2, F.length("run")))).otherwise(F.col("run"))
    return runs.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _keyed(rows: DataFrame, *, p: Column, s: Column, x: Column) -> DataFrame:
    """rows with the block (m, p, s, x) they stand in and its key: the first p code points, and the last s from the end backwards."""
    rows = rows.withColumns({"p": p, "s": s, "x": x})
    return rows.withColumn("key", F.concat_ws(":", "m", "p", "s", "x", F.left("word", F.col("p")), F.reverse(F.right("word", F.col("s")))))


def _first_blocks(words: DataFrame) -> DataFrame:
    """Each word by its first half and by its last half, once with words as long or longer (m its length) and once with shorter ones (m one less)."""
    rows = words.select("word", "n", F.length("word").alias("length")).withColumn("m", F.explode(F.array(F.col("length"), F.col("length") - 1)))
    half = F.floor(F.col("m") / 2).cast("int")
    zero = F.lit(0)
    return _keyed(rows, p=half, s=zero, x=F.col("m") + 2).unionByName(_keyed(rows, p=zero, s=half, x=half))


def _smaller_blocks(rows: DataFrame) -> DataFrame:
    """The words of blocks that are too large, by what follows the shared prefix and by what goes before the shared suffix: of what is between, a half is intact again."""
    half = F.floor((F.col("m") - F.col("p") - F.col("s")) / 2).cast("int")
    rows = rows.withColumn("half", half)
    forward = _keyed(rows, p=F.col("p") + F.col("half"), s=F.col("s"), x=F.col("x"))
    backward = _keyed(rows, p=F.col("p"), s=F.col("s") + F.col("half"), x=F.least(F.col("x"), F.col("p") + F.col("half")))
    return forward.unionByName(backward).drop("half")


def _near_in_blocks(codes: np.ndarray, m: np.ndarray, x: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) of rows are one edit apart and agree in fewer than x first code points; a is as long as m, b too or one longer."""
    same = codes[a] == codes[b]
    width = codes.shape[1]
    inside = np.arange(width) < m[a][:, None]
    differ = ~same & inside
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), m[a])
    equal = length[b] == m[a]
    near = np.where(equal, differ.sum(axis=1) == 1, False)
    # one inserted: from the first difference on, b goes on one later
    longer = np.flatnonzero(~equal)
    if len(longer):
        i, j = a[longer], b[longer]
        late = np.zeros((len(longer), width), codes.dtype)
        late[:, :-1] = codes[j][:, 1:]
        after = (np.arange(width) >= prefix[longer][:, None]) & inside[longer]
        near[longer] = ~((codes[i] != late) & after).any(axis=1)
    return near & (prefix < x[a])


def _compare(words: list[str], n: np.ndarray, m: np.ndarray, x: np.ndarray, block: np.ndarray):
    """Batches (word, n_near, best_n, best) of whole blocks, which stand one after the other, for the words that have near ones there."""
    length = np.array([len(w) for w in words])
    codes = np.array(words, dtype=f"U{max(length) + 1}").view(np.uint32).reshape(len(words), -1)
    order = np.empty(len(words), np.int64)
    order[np.argsort(np.array(words), kind="stable")] = np.arange(len(words))
    # in a block each word that is not longer is paired with the longer ones, and with those of its length that stand after it
    first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
    end = np.concatenate((first[1:], [len(block)]))
    low, high = np.repeat(first, end - first), np.repeat(end, end - first)
    short = np.flatnonzero(length == m)
    at = 0
    while at < len(short):
        sizes = np.cumsum((high - low)[short[at:]])
        stop = at + max(1, int(np.searchsorted(sizes, _PAIRS, "right")))
        part = short[at:stop]
        size = (high - low)[part]
        a = np.repeat(part, size)
        b = np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[part], size)
        use = (length[b] > m[a]) | (b > a)
        a, b = a[use], b[use]
        near = _near_in_blocks(codes, m, x, length, a, b)
        u, v = np.concatenate((a[near], b[near])), np.concatenate((b[near], a[near]))
        if len(u):
            by = np.lexsort((order[v], -n[v], u))
            u, v = u[by], v[by]
            start = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
            count = np.diff(np.concatenate((start, [len(u)])))
            columns = [[words[i] for i in u[start]], count, n[v[start]], [words[i] for i in v[start]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RESULT)], schema=_RESULT)
        at = stop


def _scan(batches, rows: int = 20_000):
    """(key, word, n, m, x) sorted by key: the blocks are scanned one after the other, some thousand rows at a time; the last, unfinished block waits."""
    held, many = [], 0

    def whole(table: pa.Table):
        word, n, m, x = (table.column(c) for c in ("word", "n", "m", "x"))
        block = table.column("key").combine_chunks().dictionary_encode()
        block = (block.combine_chunks() if isinstance(block, pa.ChunkedArray) else block).indices.to_numpy(zero_copy_only=False)
        yield from _compare(word.to_pylist(), n.to_numpy(), m.to_numpy(), x.to_numpy(), block)

    for batch in batches:
        held.append(batch)
        many += batch.num_rows
        if many >= rows:
            table = pa.Table.from_batches(held)
            keys = table.column("key").combine_chunks()
            keys = keys.chunk(0) if isinstance(keys, pa.ChunkedArray) else keys
            cut = table.num_rows - 1
            while cut > 0 and keys[cut - 1].as_py() == keys[table.num_rows - 1].as_py():
                cut -= 1
            if cut:
                yield from whole(table.slice(0, cut))
            held = table.slice(cut).to_batches()
            many = table.num_rows - cut
    if many:
        yield from whole(pa.Table.from_batches(held))


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, best_n, best of each distinct word (word, n) that has words one edit apart: how many, and the one of largest n (ties: the smallest).

    A single edit leaves the first or the last half of the shorter word intact. So words meet in blocks of a shared first half (the
    sorted dictionary) or last half (the reversed one); blocks of over `block` words are subdivided by half of what is between,
    until they are small or only one code point is between, when the alphabet bounds them. A pair stands in one block only: that of
    the prefix if it shares it. Pairs never leave a task; each gives its words' counts and best ones.
    """
    entries, done = _first_blocks(words), []
    while True:
        sizes = entries.groupBy("key").agg(F.count("*").alias("size"), F.count_if(F.col("length") == F.col("m")).alias("short"))
        sized = common.keep(entries.join(sizes.where("size > 1 and short > 0"), "key"), "blocks")
        large = (F.col("size") > block) & (F.col("m") - F.col("p") - F.col("s") > 1)
        done.append(sized.where(~large).select("key", "word", "n", "m", "x"))
        large = sized.where(large).drop("key", "size", "short")
        if large.isEmpty():
            break
        entries = _smaller_blocks(large)
    blocks = done[0]
    for x in done[1:]:
        blocks = blocks.unionByName(x)
    parts = common.shuffle_partitions(words.sparkSession)
    found = blocks.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(common.freeing(_scan), "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def _roots(forms: DataFrame, rounds: int = 12) -> DataFrame:
    """word, root of (word, form): where forms lead. Each round doubles the way; n grows fivefold by each step, so ways are short."""
    now = common.keep(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(rounds):
        next_ = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(next_, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = common.keep(moved, "roots")
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now
    raise RuntimeError(f"forms did not end in {rounds} doublings")


def spelling_variants(documents: DataFrame, least: int = LEAST, times: int = TIMES, noise: int = NOISE, block: int = BLOCK) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of 6 code points or more that stand `least` times or more in the texts, and what they vary.

    documents has doc_id and text. A word's form is its near word of largest n, if that is `times` its own n or more, else null; root is where forms lead at last, the
    word itself without any. Null and empty texts give no words, an empty table gives an empty table, repeated rows count each, a null id counts as an empty
    one, long texts are read whole, other columns are not read.
    """
    words = common.keep(word_counts(documents, noise).where((F.length("word") >= LETTERS) & (F.col("n") >= least)), "dictionary")
    near = near_words(words, block)
    form = F.when(F.col("best_n") >= times * F.col("n"), F.col("best"))
    told = common.keep(words.join(near, "word", "left").select("word", form.alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), "variants")
    roots = _roots(told.where("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
