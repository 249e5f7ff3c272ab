"""Quality classifier: a generalised additive model with pairwise interactions.

Features of a text are binned; each feature has a lookup table that cyclic boosting of shallow trees fills, one feature after the other, a small
step at a time; the strongest pairs of features get tables of their own in the same way. A score is the sum of the table
entries of a text's bins, through the logistic function, so it can be read off feature by feature.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

FOLDS = 5
#: Labelled rows that the model is fitted on at most: those least by a hash of doc_id.
SAMPLE_ROWS = 20_000
THRESHOLD = 0.3
_BATCH = 4 << 20
FEATURES = ("log_bytes", "log_words", "upper", "digits", "marks", "exclaims", "percents", "stars", "bars", "stops", "non_ascii", "control", "mean_word", "longest_word", "distinct_words", "repeats", "top_word", "log_lines", "distinct_lines", "words_a_line", "short_words")
_CLASSES = {"upper": range(65, 91), "digits": range(48, 58), "marks": [b for b in range(33, 127) if not chr(b).isalnum()], "exclaims": b"!?", "percents": b"%$&#", "stars": b"*_~^=<>", "bars": b"|\\/", "stops": b".,;:", "non_ascii": range(128, 256), "control": [*range(0, 9), *range(14, 32), 127]}
_TABLE = np.zeros((256, len(_CLASSES)))
for _i, _members in enumerate(_CLASSES.values()):
    _TABLE[list(_members), _i] = 1


def features(data: bytes) -> np.ndarray:
    """One row of FEATURES; an empty text has zeros."""
    n = len(data)
    counts = np.zeros(256)
    for at in range(0, n, 1 << 24):
        counts += np.bincount(np.frombuffer(data, np.uint8, min(n - at, 1 << 24), at), minlength=256)
    shares = counts @ _TABLE / max(n, 1)
    words = data.split()
    lines = data.split(b"\n") if data else []
    w = max(len(words), 1)
    if words:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        tally: dict[bytes, int] = {}
        for x in words:
            tally[x] = tally.get(x, 0) + 1
        mean, longest, short = sizes.mean(), int(sizes.max()), (sizes <= 2).mean()
        distinct, most = len(tally) / w, max(tally.values()) / w
        repeats = sum(map(operator.eq, words, words[1:])) / w
    else:
        mean = longest = short = distinct = most = repeats = 0.0
    k = max(len(lines), 1)
    return np.array([np.log1p(n), np.log1p(len(words)), *shares, mean, longest, distinct, repeats, most, np.log1p(len(lines)), len(set(lines)) / k, len(words) / k, short])


def _rows(data: list[bytes]) -> np.ndarray:
    return np.array([features(x) for x in data]).reshape(len(data), len(FEATURES))


class AdditiveModel:
    """Lookup tables by feature and by pair of features; score(x) is the chance of label 1."""

    def __init__(self, bins: int = 64, coarse: int = 12, rounds: int = 150, pairs: int = 6, pair_rounds: int = 60, rate: float = 0.15, leaves: int = 3, ridge: float = 2.0):
        self.bins, self.coarse, self.rounds, self.pair_count, self.pair_rounds, self.rate, self.leaves, self.ridge = bins, coarse, rounds, pairs, pair_rounds, rate, leaves, ridge
        self.start, self.edges, self.tables, self.pairs, self.coarse_edges = 0.0, [], [], [], []

    def _tree(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """A step function over bins of at most `leaves` values that lowers the loss most, one split at a time."""
        parts = [(0, len(g))]
        value = lambda a, b: g[a:b].sum() / (h[a:b].sum() + self.ridge)
        for _ in range(self.leaves - 1):
            best = (1e-9, None, 0)
            for p, (a, b) in enumerate(parts):
                if b - a < 2:
                    continue
                gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
                gs, hs = g[a:b].sum(), h[a:b].sum()
                gain = gl**2 / (hl + self.ridge) + (gs - gl) ** 2 / (hs - hl + self.ridge) - gs**2 / (hs + self.ridge)
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (gain[at], p, a + at + 1)
            if best[1] is None:
                break
            a, b = parts.pop(best[1])
            parts += [(a, best[2]), (best[2], b)]
        out = np.zeros(len(g))
        for a, b in parts:
            out[a:b] = value(a, b)
        return out

    def _quad(self, g: np.ndarray, h: np.ndarray):
        """The best cut of a table into four: (gain, step function)."""
        gc, hc = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
        parts = lambda c: (c[:-1, :-1], c[:-1, -1:] - c[:-1, :-1], c[-1:, :-1] - c[:-1, :-1], c[-1, -1] - c[:-1, -1:] - c[-1:, :-1] + c[:-1, :-1])
        gain = sum(a**2 / (b + self.ridge) for a, b in zip(parts(gc), parts(hc)))
        i, j = np.unravel_index(gain.argmax(), gain.shape)
        out = np.empty_like(g)
        for rows in (slice(0, i + 1), slice(i + 1, None)):
            for cols in (slice(0, j + 1), slice(j + 1, None)):
                out[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + self.ridge)
        return gain[i, j], out

    def fit(self, x: np.ndarray, y: np.ndarray) -> "AdditiveModel":
        n, d = x.shape if len(x) else (0, len(FEATURES))
        share = (y.sum() + 0.5) / (n + 1)
        self.start = float(np.log(share / (1 - share)))
        quantiles = lambda f, k: np.unique(np.quantile(x[:, f], np.linspace(0, 1, k + 1)[1:-1])) if n else np.zeros(0)
        self.edges = [quantiles(f, self.bins) for f in range(d)]
        self.coarse_edges = [quantiles(f, self.coarse) for f in range(d)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs = []
        if n < 20 or y.min() == y.max():
            return self
        where = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)]
        z = np.full(n, self.start)
        for _ in range(self.rounds):
            for f in range(d):
                p = 1 / (1 + np.exp(-z))
                k = len(self.tables[f])
                step = self.rate * self._tree(np.bincount(where[f], y - p, k), np.bincount(where[f], p * (1 - p), k))
                self.tables[f] += step
                z += step[where[f]]
        coarse = [np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.coarse_edges)]
        shape = [len(e) + 1 for e in self.coarse_edges]
        p = 1 / (1 + np.exp(-z))

        def sums(a, b, p):
            cell, size = coarse[a] * shape[b] + coarse[b], shape[a] * shape[b]
            return cell, np.bincount(cell, y - p, size).reshape(shape[a], shape[b]), np.bincount(cell, p * (1 - p), size).reshape(shape[a], shape[b])

        gains = sorted(((self._quad(*sums(a, b, p)[1:])[0], a, b) for a in range(d) for b in range(a + 1, d) if shape[a] > 1 and shape[b] > 1), reverse=True)
        self.pairs = [[a, b, np.zeros((shape[a], shape[b]))] for _, a, b in gains[: self.pair_count]]
        for _ in range(self.pair_rounds):
            for pair in self.pairs:
                p = 1 / (1 + np.exp(-z))
                cell, g, h = sums(pair[0], pair[1], p)
                step = self.rate * self._quad(g, h)[1]
                pair[2] += step
                z += step.ravel()[cell]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.start)
        for f, (e, t) in enumerate(zip(self.edges, self.tables)):
            z += t[np.searchsorted(e, x[:, f], "right")]
        for a, b, t in self.pairs:
            z += t[np.searchsorted(self.coarse_edges[a], x[:, a], "right"), np.searchsorted(self.coarse_edges[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-z))


def held_out(doc_id, folds: int = FOLDS, fold: int = 0):
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def _feature_rows(batches):
    for batch in batches:
        data = common.text_bytes(batch.column("text"))
        x = _rows(data)
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label: str = "quality") -> AdditiveModel:
    """A model from the labelled rows that are not held out, `sample_rows` of them at most. Null ids and labels are left out; of the rows of one id one is taken, of an id's labels the largest. Other columns are not read."""
    known = labels.select(F.col("doc_id").cast("long").alias("known_id"), F.col(label).cast("double").alias("label")).where("known_id is not null and label is not null").where(~held_out(F.col("known_id")))
    known = known.groupBy("known_id").agg(F.max("label").alias("label"))
    sample = known.orderBy(F.xxhash64("known_id"), "known_id").limit(sample_rows)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = common.one_text(docs.join(F.broadcast(sample), F.col("doc_id") == F.col("known_id"))).mapInArrow(common.freeing(_feature_rows), "label double, x array<double>")
    got = rows.toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(got.num_rows, len(FEATURES))
    y = np.asarray(got.column("label"), np.float64)
    order = np.lexsort((y, *x.T[::-1])) if len(y) else slice(None)  # the rows come in any order
    return AdditiveModel().fit(x[order], y[order])


def _scorer(model, threshold: float, keep_only: bool):
    def run(batches):
        for batch in batches:
            data = common.text_bytes(batch.column("text"))
            score = np.concatenate([np.zeros(0), *(model.value.score(_rows(data[i:j])) for i, j in common.by_bytes(data, len, _BATCH))])
            if keep_only:
                yield batch.filter(pa.array(score >= threshold))
            else:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return common.freeing(run)


def score(documents: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from `threshold` on). Only the text tells the score; null counts as empty.

    Rows are independent: repeated rows give equal results; an empty table gives an empty table. Long texts are read whole, other columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scorer(documents.sparkSession.sparkContext.broadcast(model), threshold, False), "doc_id long, score double, predicted int")


def keep_good(documents: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of documents, unchanged, whose score reaches the threshold."""
    return documents.mapInArrow(_scorer(documents.sparkSession.sparkContext.broadcast(model), threshold, True), documents.schema)
