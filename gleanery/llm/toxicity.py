"""Toxicity by class-conditional Kneser-Ney models.

Two character models, one of toxic and one of ordinary documents, tell how likely each word is letter by letter. Contexts that
one class has not seen fall back on its shorter ones and, below three letters, on continuation counts that both classes share, so
rare expressions are judged by what is known of their parts. A text is compared by length-normalised log-likelihoods: of the
whole, and of the words that speak most for the toxic model; a logistic curve fitted on labelled rows outside the counts
turns those into a score.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .shingles import mix, word_hashes

FOLDS, FOLD = 3, 1
THRESHOLD = 0.7
ORDER = 5
DISCOUNT = 0.75
#: Most n-grams (some 60 bytes each) of models that workers hold; larger ones stay in tables. And labelled rows that the curve is fitted on.
MOST_GRAMS = 1_500_000
CURVE_ROWS = 20_000
#: Bytes of words that a worker remembers; it then forgets the oldest, which costs time only.
REMEMBERED = 72 << 20
#: Letters of a word at most; longer runs of letters, as in scripts without spaces, are words of so many each.
PIECE = 64
_EVIDENCE = 6
#: What the curve weighs the ratios by before it has seen rows: the intercept; the whole text's ratio; the three highest words', the share of high ones, the length.
PRIOR = np.array([-5.0, 0.5, 0.5, 0.3, 0.2, 0.1, 0.0])
_LETTERS = re.compile(r"[^\W\d_]+")
_cache: dict[str, common.Memory] = {}


def _padded(word: str) -> str:
    return "\x01" * (ORDER - 1) + word + "\x02"


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ORDER-grams of words with starts padded and an end, as rows of code points; and the word of each."""
    padded = list(map(_padded, words))
    codes = np.frombuffer("".join(padded).encode("utf-32-le"), np.uint32)
    if not len(codes):
        return np.zeros((0, ORDER), np.uint32), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(words)), list(map(len, padded)))
    n = len(codes) - ORDER + 1
    inside = owner[:n] == owner[ORDER - 1 :]
    return np.lib.stride_tricks.sliding_window_view(codes, ORDER)[inside], owner[:n][inside]


def _keys(codes: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row of code points."""
    h = np.full(len(codes), codes.shape[1], np.uint64)
    for k in range(codes.shape[1]):
        h = mix((h ^ codes[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15))
    return h


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted stand in sorted keys, and whether they do."""
    i = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return i, (keys[i] == wanted) if len(keys) else np.zeros(len(wanted), bool)


class KneserNey:
    """Log-likelihood ratio (toxic over ordinary) of words, from counts of ORDER-grams (rows of code points) in either class."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        levels = []  # from the longest: sorted keys, counts, keys of shorter grams, and of contexts their keys, sums and kinds
        counts = counts.astype(np.float64).reshape(-1, 2)
        for k in range(ORDER, 0, -1):
            key, shorter = _keys(codes), _keys(codes[:, 1:])
            order = np.argsort(key)
            context, of = np.unique(_keys(codes[:, :-1]), return_inverse=True)
            total, kinds = (np.column_stack([np.bincount(of, x[:, c], len(context)) for c in (0, 1)]) for x in (counts, (counts > 0).astype(np.float64)))
            levels.append((key[order], counts[order], shorter[order], of[order], context, total, kinds))
            # how many letters precede each shorter gram: by class for three letters and more, of both together below
            seen = (counts > 0).astype(np.float64)
            if k - 1 <= 2:
                seen = np.repeat((seen.sum(axis=1, keepdims=True) > 0).astype(np.float64), 2, axis=1)
            _, first, of = np.unique(shorter, return_index=True, return_inverse=True)
            codes, counts = codes[first, 1:], np.column_stack([np.bincount(of, seen[:, c], len(first)) for c in (0, 1)])
        self.letters = max(len(levels[-1][0]), 1)
        # from the shortest: sorted keys and chances by class; contexts, and the share that they leave to shorter ones
        self.levels: list[tuple] = []
        for key, counts, shorter, of, context, total, kinds in reversed(levels):
            below = self._shorter(shorter)
            n, t = total[of], kinds[of]
            p = np.where(n > 0, (np.maximum(counts - DISCOUNT, 0) + DISCOUNT * t * below) / np.maximum(n, 1e-9), below)
            self.levels.append((key, p, context, np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1e-9), 1.0)))

    def _shorter(self, keys: np.ndarray) -> np.ndarray:
        if not self.levels:
            return np.full((len(keys), 2), 1 / (self.letters + 1))
        return self.levels[-1][1][_find(self.levels[-1][0], keys)[0]] if len(keys) else np.zeros((0, 2))

    def chances(self, codes: np.ndarray) -> np.ndarray:
        """Of each gram's last letter after the others, by class: its own chance at the longest length at which it is known, times what longer contexts leave."""
        share = np.ones((len(codes), 2))
        out = np.full((len(codes), 2), 1 / (self.letters + 1))
        open_ = np.arange(len(codes))
        for k in range(ORDER, 0, -1):
            keys, p, contexts, left = self.levels[k - 1]
            rows = codes[open_, ORDER - k :]
            i, known = _find(keys, _keys(rows))
            if known.any():
                out[open_[known]] = p[i[known]]
            open_, rows = open_[~known], rows[~known]
            if not len(open_):
                break
            j, there = _find(contexts, _keys(rows[:, :-1]))
            share[open_[there]] *= left[j[there]]
        return out * share

    def ratios(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sum over a word's letters of the log ratio, and its number of letters, the end included."""
        codes, owner = _grams(words)
        _, first, back = np.unique(_keys(codes), return_index=True, return_inverse=True)
        p = self.chances(codes[first])
        llr = np.log(p[:, 1] + 1e-12) - np.log(p[:, 0] + 1e-12)
        return np.bincount(owner, llr[back], len(words)), np.array([len(w) + 1 for w in words], np.int64)


def _words_of(raw: bytes) -> list[str]:
    """The words, in lower case, of what stands between spaces; very long ones in pieces."""
    found = _LETTERS.findall(raw.decode("utf-8", "replace").lower())
    return [w[i : i + PIECE] for w in found for i in range(0, len(w), PIECE)] if len(raw) > PIECE else found


def _evidence_of(ratio: np.ndarray, size: np.ndarray, top: np.ndarray) -> list[float]:
    """Of a text, from the sums and the highest ratios of what stands between its spaces."""
    three = np.sort(np.partition(top, len(top) - min(3, len(top)))[-3:])[::-1]
    return [ratio.sum() / max(size.sum(), 1), *three, *np.zeros(3 - len(three)), (top > 6).sum() / len(top), np.log1p(len(top))]


class ToxicityModel:
    def __init__(self, grams: KneserNey | GramTables, weights: np.ndarray, name: str):
        self.grams, self.weights, self.name = grams, weights, name

    def evidence(self, data: list[bytes], cache: common.Memory | None = None) -> np.ndarray:
        """Per text: the whole text's length-normalised ratio, the three highest words' ratios, and its length."""
        cache = common.Memory(REMEMBERED) if cache is None else cache
        out = np.zeros((len(data), _EVIDENCE))
        joined = b"\n".join(data)
        words = joined.split()
        if not words:
            return out
        starts, hashes = word_hashes(joined)
        _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        some = [words[i] for i in first]
        found = [cache.get(w, 150 + 2 * len(w)) for w in some]
        fresh = [i for i, v in enumerate(found) if v is None]
        parts = [_words_of(some[i]) for i in fresh]
        flat = sorted({y for x in parts for y in x})
        if flat:
            ratio, size = self.grams.ratios(flat)
            known = dict(zip(flat, zip(ratio.tolist(), size.tolist())))
        for i, ys in zip(fresh, parts):
            found[i] = v = (sum(known[y][0] for y in ys), sum(known[y][1] for y in ys), max((known[y][0] for y in ys), default=0.0))
            if len(some[i]) <= 256:
                cache.put(some[i], v, 150 + 2 * len(some[i]))
        v = np.array(found)[back]
        ends = np.searchsorted(starts, np.cumsum([len(x) + 1 for x in data]))
        for i, (a, b) in enumerate(zip([0, *ends[:-1]], ends)):
            if b > a:
                out[i] = _evidence_of(*v[a:b].T)
        return out

    def score(self, data: list[bytes], cache: common.Memory | None = None) -> np.ndarray:
        return curve(self.evidence(data, cache), self.weights)


def _inputs(e: np.ndarray) -> np.ndarray:
    """What the curve weighs: the ratios, bounded, and the length that makes high ones likelier by chance."""
    top = np.clip(e[:, 1:4], -5, 15)
    return np.column_stack([np.ones(len(e)), np.clip(e[:, 0], -2, 2), top, np.minimum(e[:, 4] * 100, 10), e[:, 5]])


def curve(e: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_inputs(e) @ weights, -30, 30)))


def fit_curve(e: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton's method, pulled towards PRIOR: few rows, or rows of one class only, leave them near it, so that a score always rises with the ratios."""
    x, pull = _inputs(e), np.full(len(PRIOR), ridge)
    pull[0] = 0.02

    def loss(w):
        z = x @ w
        return (np.logaddexp(0, z) - y * z).sum() + (pull * (w - PRIOR) ** 2).sum() / 2

    w = PRIOR.copy()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * (w - PRIOR))
        before = loss(w)
        while np.abs(step).max() >= 1e-8 and loss(w + step) > before:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def share_curve(y: np.ndarray) -> np.ndarray:
    """Weights where nothing was counted: the share of toxic rows for any text (a half for none)."""
    w = np.zeros(len(PRIOR))
    share = (y.sum() + 0.5) / (len(y) + 1)
    w[0] = np.log(share / (1 - share))
    return w


class GramTables:
    """The same models as KneserNey's, of any size: its levels as tables, of which joins give the ratios of whole tables of texts."""

    def __init__(self, grams: DataFrame):
        self.levels: list[tuple[DataFrame, DataFrame]] = []  # from the longest: grams with counts; contexts with sums and kinds
        some = [(F.col(c) > 0).cast("long") for c in ("c0", "c1")]
        for k in range(ORDER, 0, -1):
            context = grams.groupBy(F.substring("gram", 1, k - 1).alias("context"))
            self.levels.append((grams, common.keep(context.agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"), F.sum(some[0]).alias("t0"), F.sum(some[1]).alias("t1")), "contexts")))
            if k > 1:
                seen = some if k - 1 > 2 else [F.greatest(*some)] * 2
                grams = common.keep(grams.groupBy(_last(k - 1).alias("gram")).agg(F.sum(seen[0]).alias("c0"), F.sum(seen[1]).alias("c1")), "grams")
        self.letters = max(grams.count(), 1)

    def chances(self, grams: DataFrame) -> DataFrame:
        """gram, p0, p1 of each different gram."""
        wanted = [common.keep(grams.select("gram").distinct(), "wanted")]
        for k in range(ORDER - 1, 0, -1):
            wanted.append(common.keep(wanted[-1].select(_last(k).alias("gram")).distinct(), "wanted"))
        p = None
        for k in range(1, ORDER + 1):
            level, contexts = self.levels[ORDER - k]
            rows = wanted[ORDER - k].join(level, "gram", "left").withColumn("context", F.substring("gram", 1, k - 1)).join(contexts, "context", "left")
            if p is None:
                rows = rows.withColumns({"p0": F.lit(1 / (self.letters + 1)), "p1": F.lit(1 / (self.letters + 1))})
            else:
                rows = rows.withColumn("shorter", _last(k - 1)).join(p.withColumnRenamed("gram", "shorter"), "shorter")
            own = [F.when(F.col(f"n{i}") > 0, (F.greatest(F.coalesce(f"c{i}", F.lit(0)) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"t{i}") * F.col(f"p{i}")) / F.col(f"n{i}")).otherwise(F.col(f"p{i}")) for i in (0, 1)]
            p = common.keep(rows.select("gram", own[0].alias("p0"), own[1].alias("p1")), "chances")
        return p

    def evidence(self, docs: DataFrame, mark: str) -> DataFrame:
        """mark and e (as ToxicityModel.evidence) of each row of docs."""
        kind = docs.schema[mark].dataType.simpleString()
        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(mark).alias("mark"), "text")
        rows = common.keep(rows.mapInArrow(_row_tokens, f"row long, mark {kind}, tokens array<struct<token: binary, size: long, times: long>>"), "rows")
        tokens = common.keep(docs.select("text").mapInArrow(_different_tokens, "token binary, raw binary").dropDuplicates(["token"]), "tokens")
        grams = common.keep(tokens.mapInArrow(_token_grams, "token binary, part int, gram string, times long"), "token-grams")
        ratio = F.sum(F.col("times") * (F.log(F.col("p1") + 1e-12) - F.log(F.col("p0") + 1e-12)))
        parts = grams.join(self.chances(grams), "gram").groupBy("token", "part").agg(ratio.alias("ratio"))
        ratios = common.keep(parts.groupBy("token").agg(F.sum("ratio").alias("ratio"), F.max("ratio").alias("top")), "ratios")
        each = rows.select("row", F.explode("tokens").alias("t")).select("row", "t.*").join(ratios, "token", "left").na.fill(0.0, ["ratio", "top"])
        # what stands between spaces is sorted, so that equal texts get equal sums
        each = each.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("ratio", "size", "top", "times"))).alias("found"))
        return rows.select("row", "mark").join(each, "row", "left").select("mark", "found").mapInArrow(_evidence_rows, f"mark {kind}, e array<double>")


def _last(k: int):
    return F.substring("gram", -k, k)


def _token(raw: bytes) -> bytes:
    """A short name of what stands between spaces: itself, or of longer ones 128 bits."""
    return raw if len(raw) < 16 else hashlib.blake2b(raw, digest_size=16).digest()


def _row_tokens(batches):
    for batch in batches:
        out = []
        for data in common.text_bytes(batch.column("text")):
            times: dict[bytes, int] = {}
            for w in data.split():
                times[w] = times.get(w, 0) + 1
            out.append([{"token": _token(w), "size": sum(len(y) + 1 for y in _words_of(w)), "times": n} for w, n in times.items()])
        kind = pa.list_(pa.struct([("token", pa.binary()), ("size", pa.int64()), ("times", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("mark"), pa.array(out, kind)], ["row", "mark", "tokens"])


def _different_tokens(batches):
    for batch in batches:
        raw = list({w for data in common.text_bytes(batch.column("text")) for w in data.split()})
        yield pa.RecordBatch.from_arrays([pa.array([_token(w) for w in raw], pa.binary()), pa.array(raw, pa.binary())], ["token", "raw"])


def _token_grams(batches):
    for batch in batches:
        token, raw = batch.column("token").to_pylist(), batch.column("raw").to_pylist()
        for i, j in common.by_bytes(raw, len, 1 << 20):
            at, part, words = [], [], []
            for n in range(i, j):
                for k, y in enumerate(_words_of(raw[n])):
                    at.append(n), part.append(k), words.append(y)
            codes, owner = _grams(words)
            _, first, times = np.unique(mix(_keys(codes) + owner.astype(np.uint64)), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([token[at[o]] for o in owner[first]], pa.binary()), pa.array([part[o] for o in owner[first]], pa.int32()), _strings(codes[first]), pa.array(times.astype(np.int64))], ["token", "part", "gram", "times"])


def _evidence_rows(batches):
    for batch in batches:
        e = []
        for found in batch.column("found").to_pylist():
            v = np.array([[t["ratio"], t["size"], t["top"]] for t in found or ()]).reshape(-1, 3)
            v = np.repeat(v, np.array([t["times"] for t in found or ()], np.int64), axis=0)
            e.append(_evidence_of(*v.T) if len(v) else [0.0] * _EVIDENCE)
        yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(e, pa.list_(pa.float64()))], ["mark", "e"])


def _strings(codes: np.ndarray) -> pa.Array:
    text = np.ascontiguousarray(codes).tobytes().decode("utf-32-le")
    return pa.array([text[i : i + ORDER] for i in range(0, len(text), ORDER)], pa.string())


def _word_counts(batches):
    """Words with their counts in ordinary and toxic texts, summed up by task."""
    tally: tuple[dict, dict] = ({}, {})
    held = 0

    def out():
        merged: dict[str, list[int]] = {}
        for k in (0, 1):
            for raw, n in tally[k].items():
                for w in _words_of(raw):
                    merged.setdefault(w, [0, 0])[k] += n
            tally[k].clear()
        return pa.RecordBatch.from_arrays([pa.array(list(merged), pa.string()), pa.array([c[0] for c in merged.values()], pa.int64()), pa.array([c[1] for c in merged.values()], pa.int64())], ["word", "c0", "c1"])

    for batch in batches:
        for label, data in zip(batch.column("label").to_pylist(), common.text_bytes(batch.column("text"))):
            t = tally[1 if label else 0]
            for w in data.split():
                if w not in t:
                    held += len(w) + 100
                t[w] = t.get(w, 0) + 1
            if held > 64 << 20:
                yield out()
                held = 0
    yield out()


def _gram_counts(batches):
    for batch in batches:
        c = np.column_stack([np.asarray(batch.column("c0")), np.asarray(batch.column("c1"))])
        codes, owner = _grams(batch.column("word").to_pylist())
        _, first, back = np.unique(_keys(codes), return_index=True, return_inverse=True)
        sums = [np.bincount(back, c[owner, k], len(first)).astype(np.int64) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([_strings(codes[first]), pa.array(sums[0]), pa.array(sums[1])], ["gram", "c0", "c1"])


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == FOLD


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", most_grams: int = MOST_GRAMS, curve_rows: int = CURVE_ROWS) -> ToxicityModel:
    """Models from all labelled rows that are not held out: the curve is fitted on a fifth, `curve_rows` at most, and all others are counted.

    Null ids and labels are left out; of the rows of one id one is taken for the curve and all are counted, of an id's labels the largest. Other columns are not read.
    With few rows for the curve, or none of one class, its weights stay near PRIOR. All n-grams count: up to `most_grams` of them go to the workers, more are kept as scratch tables and joined.
    """
    spark = documents.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("known_id"), F.col(label).cast("double").alias("label")).where("known_id is not null and label is not null").where(~held_out(F.col("known_id")))
    known = known.groupBy("known_id").agg(F.max("label").alias("label")).withColumn("part", F.pmod(F.xxhash64("known_id"), F.lit(5)))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = known.where("part = 0").orderBy(F.xxhash64("known_id", F.lit(1)), "known_id").limit(curve_rows).select("known_id", "label")
    counted = common.few(known.join(F.broadcast(sample.select("known_id")), "known_id", "left_anti").select("known_id", "label"))
    words = docs.join(counted, F.col("doc_id") == F.col("known_id")).select("label", "text").mapInArrow(common.freeing(_word_counts), "word string, c0 long, c1 long")
    words = words.groupBy("word").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    grams = words.mapInArrow(common.freeing(_gram_counts), "gram string, c0 long, c1 long").groupBy("gram").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    grams = common.keep(grams, "grams")
    n_grams = grams.count()
    if n_grams <= most_grams:
        got = grams.toArrow()
        codes = np.frombuffer("".join(got.column("gram").to_pylist()).encode("utf-32-le"), np.uint32).reshape(-1, ORDER)
        model = KneserNey(codes, np.column_stack([np.asarray(got.column("c0")), np.asarray(got.column("c1"))]).reshape(-1, 2))
    else:
        model = GramTables(grams)
    name = f"{spark.sparkContext.applicationId}-{id(model)}"
    rows = common.one_text(docs.join(F.broadcast(sample), F.col("doc_id") == F.col("known_id")))
    if isinstance(model, GramTables):
        rows = model.evidence(rows, "label").withColumnRenamed("mark", "label").toArrow()
    else:
        early = spark.sparkContext.broadcast(ToxicityModel(model, np.zeros(7), name))
        rows = rows.mapInArrow(_evidence(early), "label double, e array<double>").toArrow()
    e = np.array(rows.column("e").to_pylist(), np.float64).reshape(rows.num_rows, _EVIDENCE)
    y = np.asarray(rows.column("label"), np.float64)
    order = np.lexsort((y, *e.T[::-1])) if len(y) else slice(None)
    return ToxicityModel(model, fit_curve(e[order], y[order]) if n_grams else share_curve(y), name)


def _remembered(name: str) -> common.Memory:
    if name not in _cache:
        _cache.clear()  # one model at a time
        _cache[name] = common.Memory(REMEMBERED)
    return _cache[name]


def _evidence(model):
    def run(batches):
        from gleanery.llm.toxicity import _remembered

        cache = _remembered(model.value.name)
        for batch in batches:
            e = model.value.evidence(common.text_bytes(batch.column("text")), cache)
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(e), pa.list_(pa.float64()))], ["label", "e"])

    return common.freeing(run, "toxicity")


def _scorer(model, threshold: float):
    def run(batches):
        from gleanery.llm.toxicity import _remembered

        cache = _remembered(model.value.name)
        for batch in batches:
            data = common.text_bytes(batch.column("text"))
            s = np.concatenate([np.zeros(0), *(model.value.score(data[i:j], cache) for i, j in common.by_bytes(data, len, 4 << 20))])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return common.freeing(run, "toxicity")


def _table_scorer(weights: np.ndarray, threshold: float):
    def run(batches):
        for batch in batches:
            s = curve(np.array(batch.column("e").to_pylist(), np.float64).reshape(-1, _EVIDENCE), weights)
            yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return common.freeing(run, "toxicity")


def score(documents: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from `threshold` on). Only the text tells the score; null counts as empty.

    Rows are independent: repeated rows give equal results; an empty table gives an empty table. Long texts are read whole, other columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if isinstance(model.grams, GramTables):
        return model.grams.evidence(docs, "doc_id").mapInArrow(_table_scorer(model.weights, threshold), "doc_id long, score double, predicted int")
    return docs.mapInArrow(_scorer(documents.sparkSession.sparkContext.broadcast(model), threshold), "doc_id long, score double, predicted int")
