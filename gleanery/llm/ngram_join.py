"""N-gram Jaccard join: which documents' sets of word shingles are at least 80 % alike, and the classes that such links make.

Prefix index with set-relation skipping:

* Every text becomes a set of 64-bit shingle hashes. Equal sets are one node from then on, told by 128 bits of their bytes.
* Shingles get one global order: those in few sets first, frequent ones last, by hash within. Two sets that are alike share a
  shingle within their prefixes, so only prefixes are indexed, dealt out by shingle.
* Index-level skipping: the list of a shingle is kept in blocks of one size and one position each. Whether sizes and positions leave room for a
  link is asked once for each pair of blocks; where they do not, both are skipped without a look at their members.
* Prefixes of sets that are alike share a number of shingles, which their sizes tell; pairs that share fewer are dropped.
* Answer-level skipping: each set's most similar neighbour is verified first. Candidates within a class that such links make are not
  looked at. Of the others, those between two sets' leaders (highly similar sets that many were compared with) are computed, and the answers of all sets
  that follow them are derived: an intersection can differ from that of the leaders by no more than the sets differ from
  their leaders. Only pairs that this leaves open are intersected themselves.
* Long lists are answered from one or two central sets first. Then, in lists that still hold several classes, the sets outside the largest one are
  compared with those of a size near theirs, block by block.

Counts are taken over all documents. Nothing is capped or sampled: an order by frequency only changes what is quick.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import connected_components
from .shingles import WORDS, shingle_sets

#: Links are sought at PERCENT / 100 or more.
PERCENT = 80
#: Lists longer than this are answered from central sets first.
LONG = 64
#: Size bound of the broadcast set of frequent shingles (8 bytes each); beyond it the most frequent ones are taken.
FREQUENT = 1 << 18
#: Times that frequent shingles are sought; the broadcast set has FREQUENT entries each time at most.
ROUNDS = 4
#: dense: the prefix reaches frequent shingles, so that other sets may share some of it in a long list.
_POSTING = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("dense", "i1")])
_PAIR = np.dtype([("a", "<i8"), ("b", "<i8"), ("na", "<i4"), ("nb", "<i4")])
#: Shingles of the sets on either side of a block pair of a long list.
_BLOCK = 1 << 19
#: Bytes of text, shingles or pairs that a task works on at a time; with some ten arrays of that many entries it bounds a worker.
_BATCH = 1 << 19


def prefix_length(n, percent: int = PERCENT):
    """So many first shingles of a set of n must hold one of any set that is alike; 0 for an empty set."""
    return np.where(n > 0, n + (-percent * n // 100) + 1, 0)


def needed(na, nb, percent: int = PERCENT):
    """The least intersection at which sets of sizes na and nb are alike."""
    return -(-percent * (na + nb) // (100 + percent))


class Names:
    """64-bit names of sets. Sets of one name are told apart by 64 bits more; names that turn out to be shared by different sets are replaced."""

    def __init__(self, bits: int = 64, shared=()):
        self.mask, self.shared = (1 << bits) - 1, frozenset(shared)

    def __call__(self, tokens: np.ndarray) -> tuple[int, int]:
        """(name, check)."""
        import xxhash

        check, name = divmod(xxhash.xxh3_128_intdigest(tokens.tobytes()), 1 << 64)
        name = _signed(name & self.mask)
        return (_signed(xxhash.xxh3_64_intdigest(check.to_bytes(8, "little"), name & 0xFFFF)) if name in self.shared else name), _signed(check)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _sets(batches, words: int):
    """(doc_id, set) of each row, texts taken in slices of a few MB."""
    for batch in batches:
        ids, data = batch.column(0).to_pylist(), common.text_bytes(batch.column(1))
        for i, j in common.by_bytes(data, len, _BATCH):
            yield ids[i:j], shingle_sets(data[i:j], words)


def _windows(words: int, percent: int, names: Names):
    """doc_id, n, node, its check, and for the first document of a node in this task its first shingles by hash: prefix and a tenth more."""

    def run(batches):
        seen: set[int] = set()
        for ids, sets in _sets(batches, words):
            named = [names(s) for s in sets]
            nodes = [x for x, _ in named]
            ns = np.array([len(s) for s in sets], np.int64)
            least = np.minimum(ns, prefix_length(ns, percent) + np.maximum(16, ns // 10))
            window = []
            for node, s, k in zip(nodes, sets, least):
                fresh = node not in seen and len(s) > 0
                seen.add(node)
                window.append(s[:k].tobytes() if fresh else None)
            if len(seen) > 1_000_000:  # forgetting only repeats a posting
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(nodes, pa.int64()), pa.array([x for _, x in named], pa.int64()), pa.array(window, pa.binary())], ["doc_id", "n", "node", "check", "window"])

    return common.freeing(run)


def _blobs(keys: np.ndarray, data: np.ndarray, buckets: int, column: str):
    """A row for each bucket with its part of data, which is dealt out by keys."""
    bucket = (keys % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    parts = np.split(data[order], first[1:])
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], ["bucket", column])


def _flat(batches):
    """Slices of the window table as flat arrays: node, n and window length by set, then all shingles."""
    for batch in batches:
        node, n, window = (batch.column(k) for k in ("node", "n", "window"))
        raw = [x for x in window.to_pylist()]
        rows = [i for i, x in enumerate(raw) if x]
        for i, j in common.by_bytes(rows, lambda r: len(raw[r]), _BATCH * 2):
            part = rows[i:j]
            yield np.asarray(node.take(pa.array(part)), np.int64), np.asarray(n.take(pa.array(part)), np.int64), np.array([len(raw[r]) // 8 for r in part]), np.frombuffer(b"".join(raw[r] for r in part), np.uint64)


def _token_counts(buckets: int):
    """For each bucket the distinct shingles of this task's windows with their counts."""

    def run(batches):
        held, size = [], 0

        def out():
            token, count = np.unique(np.concatenate(held), return_counts=True)
            pair = np.empty(len(token), [("token", "<u8"), ("count", "<u4")])
            pair["token"], pair["count"] = token, count
            once = pair["count"] == 1
            yield _blobs(token[once], token[once], buckets, "blob").append_column("many", pa.array([False] * len(np.unique(token[once] % np.uint64(buckets)))))
            if not once.all():
                more = _blobs(token[~once], pair[~once], buckets, "blob")
                yield more.append_column("many", pa.array([True] * more.num_rows))

        for _, _, _, tokens in _flat(batches):
            held.append(tokens)
            size += len(tokens)
            if size >= _BATCH:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    return common.freeing(run)


def _frequent_of_bucket(least: int):
    def run(table: pa.Table) -> pa.Table:
        once, many = [], []
        for blob, is_many in zip(table.column("blob").to_pylist(), table.column("many").to_pylist()):
            (many if is_many else once).append(np.frombuffer(blob, [("token", "<u8"), ("count", "<u4")] if is_many else np.uint64))
        token = np.concatenate([*once, *(x["token"] for x in many), np.zeros(0, np.uint64)])
        count = np.concatenate([*(np.ones(len(x), np.int64) for x in once), *(x["count"].astype(np.int64) for x in many), np.zeros(0, np.int64)])
        order = np.argsort(token)
        token, count = token[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
        total = np.add.reduceat(count, first) if len(first) else first
        heavy = total >= least
        return pa.table({"token": pa.array(token[first][heavy].view(np.int64)), "df": pa.array(total[heavy])})

    return common.freeing_group(run)


def _is_frequent(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    return frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens


def _prefixes(node, n, lens, tokens, frequent, percent):
    """Postings of the prefixes in the global order, and which sets' windows are too short to tell them."""
    rare = ~_is_frequent(tokens, frequent)
    owner = np.repeat(np.arange(len(n)), lens)
    p = prefix_length(n, percent)
    dense = np.bincount(owner[rare], minlength=len(n)) < p
    enough = ~dense | (lens == n)
    order = np.lexsort((~rare, owner))
    start = np.concatenate(([0], np.cumsum(lens)[:-1]))
    pos = np.arange(len(tokens)) - start[owner]  # owner is sorted already
    use = (pos < p[owner]) & enough[owner]
    out = np.empty(int(use.sum()), _POSTING)
    out["token"], out["node"], out["n"], out["pos"], out["dense"] = tokens[order][use], node[owner][use], n[owner][use], pos[use], dense[owner][use]
    return out, enough


def _postings(frequent, buckets: int, percent: int):
    def run(batches):
        for node, n, lens, tokens in _flat(batches):
            out, _ = _prefixes(node, n, lens, tokens, frequent.value, percent)
            if len(out):
                yield _blobs(out["token"], out, buckets, "blob")

    return common.freeing(run)


def _postings_of_texts(frequent, buckets: int, percent: int, words: int, names: Names):
    """As _postings, from whole sets: for the sets whose window was too short."""

    def run(batches):
        for _, sets in _sets(batches, words):
            sets = [s for s in sets if len(s)]
            if sets:
                lens = np.array([len(s) for s in sets])
                out, _ = _prefixes(np.array([names(s)[0] for s in sets], np.int64), lens, lens, np.concatenate(sets), frequent.value, percent)
                yield _blobs(out["token"], out, buckets, "blob")

    return common.freeing(run)


def _whole_windows(words: int, names: Names):
    def run(batches):
        for _, sets in _sets(batches, words):
            columns = [pa.array([names(s)[0] for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "window"])

    return common.freeing(run)


def _short_windows(frequent, percent: int):
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").to_pandas())
            rows = np.array([i for i, x in enumerate(batch.column("window").to_pylist()) if x])
            if len(rows):
                enough = np.concatenate([_prefixes(*x, frequent.value, percent)[1] for x in _flat([batch])])
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows[~enough]], pa.int64(), from_pandas=True)], ["doc_id"])

    return common.freeing(run)


def _may_link(x, y, percent: int):
    """Whether the sizes, and the places of this shingle as the first shared one, leave room for a link."""
    na, nb = x["n"].astype(np.int64), y["n"].astype(np.int64)
    room = 1 + np.minimum(na - x["pos"], nb - y["pos"]) - 1
    return _near(na, nb, percent) & (room >= needed(na, nb, percent)) & (x["node"] != y["node"])


def _pairs(x, y):
    """Pairs in the order of their names."""
    swap = x["node"] > y["node"]
    out = np.empty(len(x), _PAIR)
    out["a"], out["b"] = np.where(swap, y["node"], x["node"]), np.where(swap, x["node"], y["node"])
    out["na"], out["nb"] = np.where(swap, y["n"], x["n"]), np.where(swap, x["n"], y["n"])
    return out


def _near(na, nb, percent: int):
    return 100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)


def _short_lists(post, percent):
    """Of lists that are not long, in the order of token, n, pos: the pairs that blocks leave, with 1 for the shared shingle, whether positions allow a link, whether one is dense."""
    new = np.concatenate(([True], (post["token"][1:] != post["token"][:-1]) | (post["n"][1:] != post["n"][:-1]) | (post["pos"][1:] != post["pos"][:-1]))) if len(post) else np.zeros(0, bool)
    block = np.flatnonzero(new)
    size = np.diff(np.append(block, len(post)))
    token = post["token"][block]
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else block
    count = np.diff(np.append(first, len(block)))
    n, pos = post["n"][block].astype(np.int64), post["pos"][block].astype(np.int64)
    for blocks in np.unique(count):
        i, j = np.triu_indices(blocks)
        lists = first[count == blocks]
        step = max(1, _BATCH // (4 * len(i)))
        for k in range(0, len(lists), step):
            x, y = (lists[k : k + step, None] + i).ravel(), (lists[k : k + step, None] + j).ravel()
            # all that can be shared: before this shingle, itself, and after it
            room = np.minimum(pos[x], pos[y]) + 1 + np.minimum(n[x] - pos[x], n[y] - pos[y]) - 1
            stay = ((x != y) | (size[x] > 1)) & _near(n[x], n[y], percent) & (room >= needed(n[x], n[y], percent))
            x, y = x[stay], y[stay]
            many = size[x] * size[y]
            ends = np.cumsum(many)
            at = 0
            while at < len(x):
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _BATCH // 2)))
                own = np.repeat(np.arange(at, stop), many[at:stop])
                off = np.arange(len(own)) - np.repeat(ends[at:stop] - many[at:stop] - (ends[at - 1] if at else 0), many[at:stop])
                a, b = block[x[own]] + off // size[y[own]], block[y[own]] + off % size[y[own]]
                one = a < b
                p, q = post[a[one]], post[b[one]]
                yield _pairs(p, q), np.column_stack([np.ones(len(p), np.int64), _may_link(p, q, percent), p["dense"] | q["dense"]])
                at = stop


def _long_list(post, percent):
    """Pairs of central sets with the sets whose size lets them link: the list is by size, so other blocks are skipped."""
    post = post[np.lexsort((post["node"], post["n"]))]
    open_ = np.ones(len(post), bool)
    while open_.any():
        rows = np.flatnonzero(open_)
        centre = rows[np.lexsort((post["node"][rows], post["n"][rows], post["pos"][rows]))[:2]]
        for c in centre:
            n = int(post["n"][c])
            a, b = np.searchsorted(post["n"], [-(-percent * n // 100), 100 * n // percent + 1])
            block = post[a:b]
            x = np.repeat(post[c : c + 1], len(block))
            ok = _may_link(x, block, percent)
            yield _pairs(x[ok], block[ok]), np.ones((int(ok.sum()), 3), np.int64)
            open_[a:b] = False
        open_[centre] = False


def _candidates(percent: int, long: int):
    """Of one bucket of the index: candidate pairs with the number of shingles that brought them, and what long lists leave open."""

    def run(table: pa.Table) -> pa.Table:
        post = np.concatenate([np.frombuffer(x, _POSTING) for x in table.column("blob").to_pylist()])
        post = post[np.lexsort((post["node"], post["token"]))]
        post = post[np.concatenate(([True], (post["token"][1:] != post["token"][:-1]) | (post["node"][1:] != post["node"][:-1])))]
        first = np.flatnonzero(np.concatenate(([True], post["token"][1:] != post["token"][:-1])))
        count = np.diff(np.append(first, len(post)))
        found, size = [(np.zeros(0, _PAIR), np.zeros((0, 3), np.int64))], 0

        def fold():
            pairs, weight = np.concatenate([x for x, _ in found]), np.concatenate([w for _, w in found])
            order = np.lexsort((pairs["b"], pairs["a"]))
            pairs, weight = pairs[order], weight[order]
            new = np.flatnonzero(np.concatenate(([True], (pairs["a"][1:] != pairs["a"][:-1]) | (pairs["b"][1:] != pairs["b"][:-1])))) if len(pairs) else np.zeros(0, np.int64)
            return [(pairs[new], np.add.reduceat(weight, new, axis=0) if len(new) else weight)]

        def all_pairs():
            some = post[np.repeat((count > 1) & (count <= long), count)]
            yield from _short_lists(some[np.lexsort((some["pos"], some["n"], some["token"]))], percent)
            for f, c in zip(first[count > long], count[count > long]):
                yield from _long_list(post[f : f + c], percent)

        for x in all_pairs():
            found.append(x)
            size += len(x[0])
            if size > _BATCH // 2:
                found, size = fold(), 0
        pairs, weight = fold()[0]
        rest = np.concatenate([post[:0], *(post[f : f + c] for f, c in zip(first[count > long], count[count > long]))])
        both = lambda x, y: pa.array(np.concatenate([x, y]))
        none = np.zeros(len(rest), np.int64)
        return pa.table({"kind": both(np.zeros(len(pairs), np.int32), np.ones(len(rest), np.int32)), "a": both(pairs["a"], rest["token"].view(np.int64)), "b": both(pairs["b"], rest["node"]), "na": both(pairs["na"], rest["n"]), "nb": both(pairs["nb"], rest["pos"])} | {k: both(weight[:, i], none) for i, k in enumerate(("c", "ok", "dense"))})

    return common.freeing_group(run)


def _links_of_blocks(percent: int):
    """Of one block pair of a long list: links between sets of side 0 and sets of side 1 of other classes, one for each set and class at most."""

    def run(table: pa.Table) -> pa.Table:
        node, label, side = (table.column(k).to_numpy() for k in ("node", "label", "side"))
        sets = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
        n = np.array([len(x) for x in sets], np.int64)
        every, of, times = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
        place = np.where(times > 1, np.cumsum(times > 1) - 1, -1)  # what one set alone holds adds to no intersection
        ends, width = np.cumsum([0, *n]), int((times > 1).sum())
        held = [place[of[a:b]] for a, b in zip(ends[:-1], ends[1:])]
        _, class_of = np.unique(label, return_inverse=True)
        left, right = (np.flatnonzero(side == k) for k in (0, 1))
        left, right = left[np.argsort(n[left], kind="stable")], right[np.argsort(n[right], kind="stable")]
        found = []

        def dense(rows):
            m = np.zeros((len(rows), width), np.float32)
            for i, r in enumerate(rows):
                m[i, held[r][held[r] >= 0]] = 1
            return m

        step = max(16, min(512, (4 << 20) // max(1, width)))
        for i in range(0, len(left), step):
            ra = left[i : i + step]
            x = dense(ra)
            a, b = np.searchsorted(n[right], [-(-percent * n[ra[0]] // 100), 100 * n[ra[-1]] // percent + 1])
            for j in range(a, b, step):
                rb = right[j : min(j + step, b)]
                inter = (x @ dense(rb).T).astype(np.int64)
                ok = (100 * inter >= percent * (n[ra][:, None] + n[rb][None, :] - inter)) & (class_of[ra][:, None] != class_of[rb][None, :])
                for p in np.flatnonzero(ok.any(axis=1)):
                    q = np.flatnonzero(ok[p])
                    _, first = np.unique(class_of[rb[q]], return_index=True)
                    found.extend((node[ra[p]], node[rb[k]], int(inter[p, k])) for k in q[first])
        a, b, c = (np.array([f[k] for f in found], np.int64) for k in range(3))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "shared": c})

    return common.freeing_group(run)


def _verified(percent: int):
    """Of pairs of sets, by intersecting them whole: shared, na, nb, and whether they are alike."""

    def run(batches):
        for batch in batches:
            x, y = batch.column("xs").to_pylist(), batch.column("ys").to_pylist()
            out = np.zeros((len(x), 3), np.int64)
            for i, (s, t) in enumerate(zip(x, y)):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                both = np.sort(np.concatenate([s, t]), kind="stable")
                out[i] = int((both[1:] == both[:-1]).sum()), len(s), len(t)
            ok = 100 * out[:, 0] >= percent * (out[:, 1] + out[:, 2] - out[:, 0])
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *(pa.array(out[:, k]) for k in range(3)), pa.array(ok)], ["a", "b", "shared", "na", "nb", "alike"])

    return common.freeing(run)


def _set_blobs(words: int, names: Names):
    def run(batches):
        for _, sets in _sets(batches, words):
            yield pa.RecordBatch.from_arrays([pa.array([names(s)[0] for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "tokens"])

    return common.freeing(run)


def _by_id(docs: DataFrame, ids: DataFrame, words_map, schema: str) -> DataFrame:
    """What words_map makes of the documents whose doc_id is in ids: a bounded broadcast, else a shuffled join."""
    ids = common.few(ids.distinct())
    return docs.join(ids.withColumnRenamed("doc_id", "wanted"), F.col("doc_id").eqNullSafe(F.col("wanted")), "left_semi").mapInArrow(words_map, schema)


#: A class with more than one in so many rows is hot; there are no more of them than that.
_HOT = 1000


def near_duplicates(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, long: int = LONG, name_bits: int = 64, frequent_most: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """(members, links): a row per document with its class, and links between sets that span the classes.

    documents needs doc_id (long) and text; other columns are not looked at. members: doc_id, n_shingles, component_id (the
    smallest doc_id of all documents that links reach, itself included), set_id (equal for equal sets). links: a, b (set_id),
    shared (shingles; null where the link was derived from the leaders' answers). Empty or null texts have no shingles and stay alone, also among themselves. Repeated rows and
    ids give as many rows; a null doc_id stays null and never names a class unless all its documents' ids are null. An empty table gives
    empty tables. name_bits and frequent_most are for tests of shared names and of a full set of frequent shingles.
    """
    spark = documents.sparkSession
    lasting: list[str] = []
    with common.scratch(spark, lasting):
        return _near_duplicates(documents, words, percent, long, Names(name_bits), frequent_most, lasting)


def _near_duplicates(documents: DataFrame, words: int, percent: int, long: int, names: Names, frequent_most: int, lasting: list[str]) -> tuple[DataFrame, DataFrame]:
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = max(64, 4 * common.shuffle_partitions(spark))

    def last(df: DataFrame, label: str) -> DataFrame:
        lasting.append(common.scratch_path(spark, label))
        return common.keep(df, label, lasting[-1])

    def windows() -> DataFrame:
        return common.keep(docs.mapInArrow(_windows(words, percent, names), "doc_id long, n long, node long, check long, window binary"), "windows")

    base = windows()
    checks = base.groupBy("node").agg(F.min("check").alias("c0"), F.max("check").alias("c1")).where("c0 != c1")
    if shared := [r[0] for r in checks.select("node").collect()]:  # a matter of chance: some 300 names of 10^11 sets
        names = Names(names.mask.bit_length(), shared)
        base = windows()

    def frequent_in(windows: DataFrame) -> np.ndarray:
        counted = windows.mapInArrow(_token_counts(buckets), "bucket int, blob binary, many boolean")
        heavy = counted.groupBy("bucket").applyInArrow(_frequent_of_bucket(long), "token long, df long").orderBy(F.desc("df"), "token").limit(frequent_most)
        return np.array([r[0] for r in heavy.select("token").collect()], np.int64).view(np.uint64)

    def short_with(frequent) -> DataFrame:
        return common.keep(base.where("window is not null").mapInArrow(_short_windows(frequent, percent), "doc_id long"), "short")

    # shingles that are frequent in the windows, then, until no more sets come up, in the whole sets that hold little else
    counts = [np.sort(frequent_in(base.select("node", "n", "window")))]
    known, before, settled = counts[0], -1, False
    for _ in range(ROUNDS):
        frequent = spark.sparkContext.broadcast(known)
        short = short_with(frequent)
        now = short.count()
        settled = now == before
        if settled:
            break
        before = now
        counts.append(frequent_in(_by_id(docs, short, _whole_windows(words, names), "node long, n long, window binary")))
        known = np.union1d(known, counts[-1])
    if not settled:
        frequent = spark.sparkContext.broadcast(known)
        short = short_with(frequent)
    whole = settled and max(map(len, counts)) < frequent_most  # else some frequent shingles are ordered as rare ones
    post = base.select("node", "n", "window").mapInArrow(_postings(frequent, buckets, percent), "bucket int, blob binary")
    post = post.union(_by_id(docs, short, _postings_of_texts(frequent, buckets, percent, words, names), "bucket int, blob binary"))
    found = common.keep(post.groupBy("bucket").applyInArrow(_candidates(percent, 2 * long), "kind int, a long, b long, na int, nb int, c long, ok long, dense long"), "candidates")
    # sets that are alike share so many shingles of their prefixes; for dense ones long lists may hold some of those
    least = F.lit(1) if whole is False else F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent)) - F.ceil(percent * F.greatest("na", "nb") / 100) + 1
    pairs = found.where("kind = 0").groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), *(F.sum(k).alias(k) for k in ("c", "ok", "dense")))
    pairs = common.keep(pairs.where("ok > 0").where((F.col("dense") > 0) | (F.col("c") >= least)).select("a", "b", "na", "nb", "c"), "pairs")
    rest = found.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("node"), F.col("na").alias("n"))

    # one document for each set that has a candidate, and its whole set
    named = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(rest.select("node")).distinct()
    first = base.where("window is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))  # a row for each task that has met the set, so no task gets all copies of one
    ids = first.join(named, "node", "left_semi")
    sets = common.keep(_by_id(docs, ids.select("doc_id"), _set_blobs(words, names), "node long, tokens binary").dropDuplicates(["node"]), "sets")

    def verify(edges: DataFrame, label: str) -> DataFrame:
        left = edges.select("a", "b").join(sets.select(F.col("node").alias("b"), F.col("tokens").alias("ys")), "b")
        whole = left.join(sets.select(F.col("node").alias("a"), F.col("tokens").alias("xs")), "a")
        return common.keep(whole.select("a", "b", "xs", "ys").mapInArrow(_verified(percent), "a long, b long, shared long, na long, nb long, alike boolean"), label)

    def both_ways(df: DataFrame, *more: str) -> DataFrame:
        return df.select(F.col("a").alias("v"), F.col("b").alias("u"), *more).union(df.select(F.col("b").alias("v"), F.col("a").alias("u"), *more))

    # each set's most similar neighbour first: by the share of its index entries that both have
    best = both_ways(pairs, "c").groupBy("v").agg(F.max(F.struct("c", "u")).alias("best")).select(F.least("v", "best.u").alias("a"), F.greatest("v", "best.u").alias("b")).distinct()
    links = last(verify(best, "verified").where("alike"), "links")
    labels = common.keep(connected_components(links.select("a", "b")), "labels")

    def labelled(df: DataFrame, node: str, name: str) -> DataFrame:
        known = labels.select(F.col("node").alias(node), F.col("label").alias(f"known_{name}"))
        return df.join(known, node, "left").withColumn(name, F.coalesce(f"known_{name}", node)).drop(f"known_{name}")

    between = labelled(labelled(pairs.select("a", "b", "na", "nb"), "a", "la"), "b", "lb").where("la != lb").select("a", "b", "na", "nb")
    # a set's leader: of itself and the sets that it was found alike to, the one with most such links; differ: shingles that only one of both has
    ways = both_ways(links, "shared", "na", "nb")
    degree = ways.groupBy("v").agg(F.count("*").alias("links"))
    lead = ways.join(degree.select(F.col("v").alias("u"), F.col("links").alias("u_links")), "u").join(degree, "v")
    lead = lead.groupBy("v").agg(F.max(F.struct("u_links", "u", (F.col("na") + F.col("nb") - 2 * F.col("shared")).alias("differ"))).alias("top"), F.max("links").alias("links"))
    own = (F.col("links") > F.col("top.u_links")) | ((F.col("links") == F.col("top.u_links")) & (F.col("v") > F.col("top.u")))
    lead = common.keep(lead.select("v", F.when(own, F.col("v")).otherwise(F.col("top.u")).alias("leader"), F.when(own, 0).otherwise(F.col("top.differ")).cast("long").alias("differ")), "leaders")

    def led(df: DataFrame, node: str) -> DataFrame:
        known = lead.select(F.col("v").alias(node), F.col("leader").alias(f"l{node}"), F.col("differ").alias(f"d{node}"))
        return df.join(known, node, "left").withColumns({f"l{node}": F.coalesce(f"l{node}", node), f"d{node}": F.coalesce(f"d{node}", F.lit(0))})

    between = common.keep(led(led(between, "a"), "b").withColumns({"x": F.least("la", "lb"), "y": F.greatest("la", "lb")}), "between")
    asked = verify(between.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "answers")
    answers = asked.select(F.col("a").alias("x"), F.col("b").alias("y"), "shared", (F.col("na") + F.col("nb")).alias("sizes"))
    # 2 |a & b| = |a| + |b| - |a ^ b|, and a ^ b differs from the leaders' by no more than both sets from theirs
    bound = lambda sign: F.floor((F.col("na") + F.col("nb") - (F.col("sizes") - 2 * F.col("shared")) + sign * (F.col("da") + F.col("db"))) / 2)
    least = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    derived = common.keep(between.join(answers, ["x", "y"]).select("a", "b", F.when(F.col("da") + F.col("db") == 0, F.col("shared")).alias("shared"), (bound(1) >= least).alias("may"), (bound(-1) >= least).alias("must")), "derived")
    links2 = verify(derived.where("may and not must"), "verified").where("alike").select("a", "b", "shared").union(derived.where("must").select("a", "b", "shared"))

    # long lists that hold several classes: sets outside the largest one meet all sets of a size near theirs
    rest = labelled(rest, "node", "label")
    kinds = rest.groupBy("token", "label").agg(F.count("*").alias("size")).groupBy("token").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("classes")).where("classes > 1")
    rest = common.keep(rest.join(common.few(common.keep(kinds.select("token", F.col("top.label").alias("largest")), "mixed")), "token").withColumn("band", F.floor(F.log(F.col("n")) / -np.log(percent / 100)).cast("int")), "open")
    near = [F.array(*(F.col("band") + k for k in (-2, -1, 0, 1, 2)))]  # one to spare for rounding
    right = rest.select("token", "node", "label", "n", F.explode(*near).alias("band"))
    shares = lambda df: F.ceil(F.sum("n") / _BLOCK).cast("int")
    odd = rest.where("label != largest")
    plan = odd.groupBy("token", "band").agg(shares(odd).alias("lefts")).join(right.groupBy("token", "band").agg(shares(right).alias("rights")), ["token", "band"])
    plan = common.few(common.keep(plan, "plan"))
    deal = lambda df, mine, others, side: df.join(plan, ["token", "band"]).select("token", "band", "node", "label", F.lit(side).alias("side"), F.pmod(F.xxhash64("node"), F.col(mine)).cast("int").alias("mine"), F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias("other"))
    blocks = deal(odd, "lefts", "rights", 0).withColumnsRenamed({"mine": "p", "other": "q"}).unionByName(deal(right, "rights", "lefts", 1).withColumnsRenamed({"mine": "q", "other": "p"}))
    grouped = blocks.join(sets, "node").select("token", "band", "p", "q", "side", "node", "label", "tokens").groupBy("token", "band", "p", "q")
    links2 = last(links2.union(grouped.applyInArrow(_links_of_blocks(percent), "a long, b long, shared long")).distinct(), "links")
    ends = labelled(labelled(links2.select("a", "b"), "a", "la"), "b", "lb").select(F.col("la").alias("a"), F.col("lb").alias("b"))
    merged = connected_components(ends)

    final = base.select("doc_id", "n", "node").join(labels, "node", "left").withColumn("one", F.coalesce("label", "node")).drop("label")
    final = final.join(merged.select(F.col("node").alias("one"), "label"), "one", "left").withColumn("one", F.coalesce("label", "one")).select("doc_id", "n", "node", "one")
    final = last(final, "classes")
    # classes that hold more than one in _HOT rows, so _HOT at most, are broadcast: no task gets all rows of one
    rows = final.where("n > 0")
    least = last(rows.groupBy("one").agg(F.min("doc_id").alias("least"), F.count("*").alias("size")), "least")
    total = final.count()
    hot = F.broadcast(least.where(F.col("size") * _HOT > total))
    cold = rows.join(hot.select("one"), "one", "left_anti").join(least.where(F.col("size") * _HOT <= total), "one")
    members = rows.join(hot, "one").unionByName(cold).select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), F.col("node").alias("set_id"))
    members = members.union(final.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("set_id")))
    return members, links.select("a", "b", "shared").union(links2)
