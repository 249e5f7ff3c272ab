"""Spelling variants and phrase collocations against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import phrases, spelling


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_words(rows, noise):
    n = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    form, near = {}, {}
    for w in words:
        around = [v for v in words if one_edit(w, v)]
        near[w] = len(around)
        best = min(around, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], near[w], words[form[w]] if w in form else None))
    return sorted(out)


def variants_of(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + rng.choice("abcé") + word[i:], word[:i] + rng.choice("abcé") + word[i + 1 :]])


def texts_of_words(rng):
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 11))) for _ in range(60)]
    base += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "abcabcab", "résumés", "Résumés", "ÉTUDES"] + ["prefix" + "".join(rng.choice("abcé") for _ in range(3)) for _ in range(40)]
    pool = []
    for w in base:
        v = variants_of(rng, w)
        pool += [w] * rng.choice([5, 30, 160]) + [v] * rng.choice([1, 5, 6]) + [variants_of(rng, v)] * 5
    rng.shuffle(pool)
    rows = [(i, " ".join(pool[i::50])) for i in range(50)]
    return rows + [(None, "aaaaaaa aaaaaaa"), (7, None), (8, ""), (3, rows[3][1]), (3, rows[3][1]), (60, "x" * 3000 + " " + "y" * 5000), (61, "1 2 3")]


@pytest.mark.parametrize("block, noise", [(spelling.BLOCK, 7), (2, 199), (5, 3)])
def test_spelling_variants(spark, on_disk, rng, block, noise):
    rows = texts_of_words(rng)
    got = spelling.spelling_variants(on_disk(rows), noise=noise, block=block)
    assert sorted(tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()) == brute_variants(brute_words(rows, noise))


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_near_words_with_hot_prefixes_and_suffixes(spark, rng, block):
    words = {"stemstem" + "".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(150)} | {"".join(rng.choice("ab") for _ in range(rng.randint(1, 6))) + "endend" for _ in range(80)} | {"a" * n for n in range(6, 15)}
    n = {w: rng.randint(5, 9) for w in words}
    got = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(spark.createDataFrame(list(n.items()), "word string, n long"), block).collect()}
    want = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        if near:
            best = min(near, key=lambda v: (-n[v], v))
            want[w] = (len(near), n[best], best)
    assert got == want


def test_roots_follow_long_ways(spark):
    way = [(f"w{i}", f"w{i + 1}") for i in range(40)]
    got = {r.word: r.root for r in spelling._roots(spark.createDataFrame(way, "word string, form string")).collect()}
    assert got == {w: "w40" for w, _ in way}


def test_spelling_of_nothing(spark, on_disk):
    assert spelling.spelling_variants(on_disk([], "empty")).collect() == []
    assert spelling.spelling_variants(on_disk([(1, None), (2, ""), (3, "few")], "few")).collect() == []


def brute_phrases(rows, least, top):
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall("[^ \t]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        kept = []
        for p, a in c.items():
            if len(p) < 2 or a < least:
                continue
            score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and b >= least and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in c.items()):
                kept.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def phrase_rows(rng):
    words = ["of", "the", "New", "york", "été", "a b", "x", "stock", "Market", "once", "upon", "time", "\x1cctl"]
    def text():
        out = []
        for _ in range(rng.randint(0, 60)):
            out.append(rng.choice(words) if rng.random() < 0.6 else rng.choice(["New  york stock Market", "once upon\ta time", "x x x x x", "of the été."]))
            out.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!?", "\r\n"]))
        return "".join(out)
    return [(rng.choice(["en", "fr", None, "und"]), text()) for _ in range(300)] + [("en", None), ("xx", ""), ("xx", "only two"), ("zz", "again and again " * 4000)] + [("fr", "one copy of many copies here")] * 200


@pytest.mark.parametrize("cells, top, least", [(None, 2000, 30), (64, 5, 30), (8, 2000, 300)])
def test_collocations(spark, rng, tmp_path, cells, top, least, monkeypatch):
    rows = phrase_rows(rng)
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("other") for c in ("n", "k", "phrase", "block")})
    df.repartition(4).write.parquet(f"{tmp_path}/documents")
    got = phrases.collocations(spark.read.parquet(f"{tmp_path}/documents"), least=least, top=top, cells=cells)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == brute_phrases(rows, least, top)


def test_long_texts_are_cut_at_breaks_only():
    rng = random.Random(3)
    text = "".join(rng.choice(["word ", "an other", ".", ",\n", "x" * 30]) for _ in range(500)).encode()
    parts = list(phrases._parts(text, 50))
    assert len(parts) > 20 and re.sub(rb"[.,\n]", b"", b"".join(parts)) == re.sub(rb"[.,\n]", b"", text)
    assert list(phrases._parts(b"a" * 500, 50)) == [b"a" * 500]


def test_scores_beyond_64_bits(spark):
    a = spark.range(1).select(F.expr(f"CAST((CAST({phrases.SCALE} AS DECIMAL(38,0)) * CAST(9000000000000000000 AS DECIMAL(38,0))) DIV (CAST(9100000000000000000 AS DECIMAL(38,0)) + CAST(9000000000000000001 AS DECIMAL(38,0))) AS BIGINT)")).first()[0]
    assert a == 2_000_000 * 9000000000000000000 // (9100000000000000000 + 9000000000000000001)


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_sketch_grows_with_text_in_blocks(spark, rng, monkeypatch):
    """A sketch of more cells than are summed up at once (three for each word) lets hardly any rare sequence through."""
    monkeypatch.setattr(phrases, "BLOCK", 1 << 12)
    rows = [("en", " ".join(f"w{rng.randrange(3000)}" for _ in range(500))) for _ in range(60)] + [("en", "once upon a time")] * 40
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    cells = 1 << 17
    bits = phrases._surviving(df, 30, cells)
    assert [int(np.unpackbits(b).sum()) for b in bits][1:] == [6, 4, 2]  # two bits for each of the sequences of `once upon a time`
    assert {r.phrase for r in phrases.phrase_counts(df, cells=cells).where("k = 4").collect()} == {"once upon a time"}
