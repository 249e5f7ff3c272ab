import random

import numpy as np
import pytest
from prose import prose

from gleanery.llm import quality, toxicity


def crc_mod(doc_id, n):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % n


def junk(rng):
    return rng.choice([lambda: " ".join(w + "%%%" for w in prose(rng, 60).split()), lambda: "the " * 80, lambda: prose(rng, 60).upper().replace(" ", "!! ")])()


def toxic(rng):
    w = prose(rng, rng.randint(30, 200)).split()
    for _ in range(rng.randint(2, 4)):
        w.insert(rng.randrange(len(w)), rng.choice(["grumzak", "Blorvex,", "vrixl" + prose(rng, 1)]))
    return " ".join(w)


def labelled(on_disk, column, make, n=1500):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        rows.append((i, make(rng) if bad else prose(rng, rng.randint(30, 200))))
        labels.append((i, int(bad) if column == "toxic" else 1 - int(bad)))
    docs = on_disk([*rows, (None, None), (90_000, ""), (90_001, "the"), (5, rows[5][1])])
    return docs, on_disk([*labels, (None, 1), (90_002, None)], "labels", f"doc_id long, {column} int"), dict(labels)


def held_out_accuracy(got, truth, n, fold):
    rows = [r for r in got if r.doc_id in truth and crc_mod(r.doc_id, n) == fold]
    assert len(rows) > 100 and all(0 <= r.score <= 1 for r in got)
    return sum(r.predicted == truth[r.doc_id] for r in rows) / len(rows)


def test_quality(spark, on_disk):
    docs, labels, truth = labelled(on_disk, "quality", junk)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == 1504 and held_out_accuracy(got, truth, 5, 0) > 0.98
    assert all(r.predicted == (r.score >= 0.3) for r in got) and model.pairs and any(np.abs(t).max() > 0 for _, _, t in model.pairs)
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)


def test_quality_scores_are_table_sums(spark, on_disk):
    docs, labels, _ = labelled(on_disk, "quality", junk, 400)
    model = quality.fit(docs, labels)
    x = np.array([quality.features(b"The quick. brown fox\njumps!! over"), quality.features(b"")])
    z = np.full(2, model.start)
    for i in range(2):
        for f, (e, t) in enumerate(zip(model.edges, model.tables)):
            z[i] += t[sum(e <= x[i, f])]
        for a, b, t in model.pairs:
            z[i] += t[sum(model.coarse_edges[a] <= x[i, a]), sum(model.coarse_edges[b] <= x[i, b])]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-z)))


def test_toxicity(spark, on_disk):
    docs, labels, truth = labelled(on_disk, "toxic", toxic)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 1504 and held_out_accuracy(got, truth, 3, 1) > 0.95
    # a rare expression is judged by its parts
    ratio, size = model.grams.ratios(["vrixlqq", "tionble"])
    assert ratio[0] / size[0] > 0.3 > ratio[1] / size[1]


def plain_kneser_ney(counted):
    """The log ratio of a word by the textbook, one letter after the other; counted: (word, ordinary count, toxic count)."""
    grams = {k: {} for k in range(1, 6)}
    for w, *c in counted:
        x = "\x01" * 4 + w + "\x02"
        for i in range(len(x) - 4):
            have = grams[5].setdefault(x[i : i + 5], [0, 0])
            have[0], have[1] = have[0] + c[0], have[1] + c[1]
    for k in (4, 3, 2, 1):
        for g, c in grams[k + 1].items():
            have = grams[k].setdefault(g[1:], [0, 0])
            for j in (0, 1):
                have[j] += c[j] > 0 if k > 2 else max(c) > 0

    def chance(g, j):
        if not g:
            return 1 / (len(grams[1]) + 1)
        after = [c[j] for h, c in grams[len(g)].items() if h[:-1] == g[:-1]]
        n, kinds, below = sum(after), sum(x > 0 for x in after), chance(g[1:], j)
        c = grams[len(g)].get(g, (0, 0))[j]
        return (max(c - 0.75, 0) + 0.75 * kinds * below) / n if n else below

    def ratio(w):
        x = "\x01" * 4 + w + "\x02"
        return sum(np.log(chance(x[i : i + 5], 1) + 1e-12) - np.log(chance(x[i : i + 5], 0) + 1e-12) for i in range(len(x) - 4))

    return ratio


def model_of(counted):
    codes, owner = toxicity._grams([w for w, *_ in counted])
    _, first, back = np.unique(toxicity._keys(codes), return_index=True, return_inverse=True)
    return toxicity.KneserNey(codes[first], np.column_stack([np.bincount(back, np.array([c[k] for _, *c in counted])[owner]) for k in (0, 1)]))


def test_ratios_are_those_of_plain_kneser_ney():
    rng = random.Random(2)
    letters = "aab\u0430\u4e00\u1100\U00020000"  # letters that a folded alphabet would take for each other
    counted = [("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))), rng.randint(0, 3), rng.randint(0, 3)) for _ in range(60)]
    counted = [x for x in counted if max(x[1:])] + [("only", 0, 2), ("other", 2, 0)]
    words = [w for w, *_ in counted] + ["", "zzz", "aba", "o\u4e00ly", "x" * 64]
    ratio, size = model_of(counted).ratios(words)
    want = plain_kneser_ney(counted)
    assert np.allclose(ratio, [want(w) for w in words]) and list(size) == [len(w) + 1 for w in words]


def test_chances_add_up():
    counted = [("hallo", 1, 1), ("hello", 2, 0), ("hall", 1, 2), ("help", 0, 3)]
    model = model_of(counted)
    letters = sorted({c for w, *_ in counted for c in w} | {"\x02"})
    for context in ("\x01hal", "\x01hel", "\x01xyz"):
        p = model.chances(np.array([[ord(c) for c in context + x] for x in letters], np.uint32))
        rest = model.chances(np.array([[ord(c) for c in context + "\u4e00"]], np.uint32))
        assert (p > 0).all() and np.allclose(p.sum(axis=0) + rest[0], 1)


def test_no_labels_and_no_rows(spark, on_disk):
    docs, none = on_disk([(1, "some text"), (2, None)]), on_disk([], "labels", "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.score(docs, quality.fit(docs, none)).collect()] == [0.5, 0.5]
    assert [r.score for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()] == [0.5, 0.5]
    empty = on_disk([], "empty")
    assert quality.score(empty, quality.fit(empty, none)).count() == 0 and toxicity.score(empty, toxicity.fit(empty, none)).count() == 0


def test_toxicity_with_more_grams_than_workers_hold(spark, on_disk):
    docs, labels, _ = labelled(on_disk, "toxic", toxic, 300)
    held, joined = toxicity.fit(docs, labels), toxicity.fit(docs, labels, most_grams=100)
    assert isinstance(joined.grams, toxicity.GramTables) and joined.grams.levels[0][0].count() == len(held.grams.levels[-1][0]) > 100
    assert np.allclose(held.weights, joined.weights)
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(7, "ünseen xyzzy" * 1000 + " vrixl ... grumzak"), (8, "\u0e01" * 5000)], "doc_id long, text string"))
    a, b = (sorted(((-1 if r.doc_id is None else r.doc_id), r.score, r.predicted) for r in toxicity.score(more, m).collect()) for m in (held, joined))
    assert len(a) == len(b) == 306 and [(x[0], x[2]) for x in a] == [(x[0], x[2]) for x in b] and np.allclose([x[1] for x in a], [x[1] for x in b])


def test_long_runs_of_letters_are_counted_whole():
    import pyarrow as pa

    word = "".join(chr(97 + i * i % 23) for i in range(1234))
    batch = pa.RecordBatch.from_pydict({"label": [1.0, 0.0], "text": [word + " short", "x" * 196]})
    got = {}
    for b in toxicity._gram_counts(toxicity._word_counts([batch])):
        for g, c0, c1 in zip(*(b.column(k).to_pylist() for k in ("gram", "c0", "c1"))):
            got[g] = tuple(np.add(got.get(g, (0, 0)), (c0, c1)))
    want = {}
    for words, c in (([*(word[i : i + 64] for i in range(0, 1234, 64)), "short"], (0, 1)), (["x" * 64] * 3 + ["x" * 4], (1, 0))):
        for g in toxicity._strings(toxicity._grams(words)[0]).to_pylist():
            want[g] = tuple(np.add(want.get(g, (0, 0)), c))
    assert got == want


def test_all_labels_but_the_curves_are_counted(spark, on_disk):
    names = {i: "".join(chr(0x430 + int(d)) for d in f"{i:06d}") for i in range(200)}
    docs, labels = on_disk(list(names.items())), on_disk([(i, i % 2) for i in names], "labels", "doc_id long, toxic int")
    held = set(toxicity.fit(docs, labels, curve_rows=3).grams.levels[-1][0].tolist())
    learned = [i for i, w in names.items() if crc_mod(i, 3) != 1 and set(toxicity._keys(toxicity._grams([w])[0]).tolist()) <= held]
    rest = [i for i in names if crc_mod(i, 3) != 1]
    assert len(rest) - 3 <= len(learned) <= len(rest)


def test_trees_are_those_of_an_exhaustive_search():
    rng = np.random.default_rng(8)
    m = quality.AdditiveModel(leaves=2)
    for _ in range(20):
        g, h = rng.normal(size=9), rng.uniform(0.1, 1, 9)
        gain = lambda parts: sum(g[p].sum() ** 2 / (h[p].sum() + m.ridge) for p in parts)
        best = max(range(1, 9), key=lambda k: gain([slice(0, k), slice(k, 9)]))
        want = np.empty(9)
        for p in (slice(0, best), slice(best, 9)):
            want[p] = g[p].sum() / (h[p].sum() + m.ridge)
        if gain([slice(0, best), slice(best, 9)]) - gain([slice(0, 9)]) > 1e-9:
            assert np.allclose(m._tree(g, h), want)
        g, h = rng.normal(size=(4, 5)), rng.uniform(0.1, 1, (4, 5))
        parts = lambda i, j: [(r, c) for r in (slice(0, i + 1), slice(i + 1, 4)) for c in (slice(0, j + 1), slice(j + 1, 5))]
        most = max(sum(g[p].sum() ** 2 / (h[p].sum() + m.ridge) for p in parts(i, j)) for i in range(3) for j in range(4))
        assert np.isclose(m._quad(g, h)[0], most)


def test_fitting_is_newton_boosting_feature_by_feature():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (300, 2)).astype(float)
    y = ((x[:, 0] > 2) ^ (rng.random(300) < 0.2)).astype(float)
    m = quality.AdditiveModel(rounds=3, pairs=0, leaves=2)
    m.fit(x, y)
    z, tables = np.full(300, m.start), [np.zeros(len(e) + 1) for e in m.edges]
    for _ in range(3):
        for f in range(2):
            p = 1 / (1 + np.exp(-z))
            at = np.array([sum(e <= v for e in m.edges[f]) for v in x[:, f]])
            g = np.array([(y - p)[at == b].sum() for b in range(len(tables[f]))])
            h = np.array([(p * (1 - p))[at == b].sum() for b in range(len(tables[f]))])
            step = m.rate * m._tree(g, h)
            tables[f] += step
            z += step[at]
    assert all(np.allclose(a, b) for a, b in zip(m.tables, tables)) and np.allclose(m.score(x), 1 / (1 + np.exp(-z)))


@pytest.mark.parametrize("n, every", [(40, 3), (120, 4), (300, 60)])
def test_toxicity_ranks_with_few_labels_or_one_class_for_the_curve(spark, on_disk, n, every):
    """Too few rows for a curve, or ordinary ones only, still give scores that rise with the ratios, not one score for all texts."""
    rng, rows, labels = random.Random(n), [], []
    for i in range(n):
        bad = i % every == 0
        rows.append((i, " ".join(rng.choices("the of and house water day people number word line".split(), k=20) + ["stupidscum"] * bad)))
        labels.append((i, int(bad)))
    docs, labels = on_disk(rows), on_disk(labels, "labels", "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect() if crc_mod(r.doc_id, 3) == 1}
    bad, fine = ([s for i, s in got.items() if (i % every == 0) == k] for k in (True, False))
    assert bad and fine and min(bad) > max(fine)


def test_the_curve_of_separable_rows_ends(rng):
    y = np.arange(400) % 2.0
    e = np.column_stack([y * 30 - 15 + k for k in range(toxicity._EVIDENCE)])
    w = toxicity.fit_curve(e, y)
    p = toxicity.curve(e, w)
    assert np.isfinite(w).all() and p[y == 1].min() > 0.9 and p[y == 0].max() < 0.1
    assert np.allclose(toxicity.fit_curve(e[:0], y[:0]), toxicity.PRIOR)
