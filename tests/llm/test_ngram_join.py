import random

import pytest
from prose import prose, word

from gleanery.llm import ngram_join
from gleanery.llm.components import connected_components


def shingles(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} - {()} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def classes(rows):
    """Smallest id and set size of each row by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def result(df, **options):
    members, _ = ngram_join.near_duplicates(df, **options)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in members.collect())


def edited(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        k = rng.randrange(len(w))
        rng.choice([lambda: w.__setitem__(k, word(rng)), lambda: w.insert(k, word(rng)), lambda: w.pop(k) if len(w) > 3 else None])()
    return " ".join(w)


def corpus(rng):
    rows, passage = [], prose(rng, 40)
    for g in range(6):
        base = prose(rng, rng.randint(30, 120))
        for _ in range(rng.randint(1, 14)):
            rows.append(edited(rng, base, rng.randint(0, 5)))
    rows += [prose(rng, rng.randint(5, 60)) + " " + passage + " " + prose(rng, rng.randint(5, 60)) for _ in range(30)]
    rows += [rows[0], rows[0].upper(), "a b", "A\tb\n", "a b c", "", None, "   ", "a b c d e", "a b c d e f"]
    return list(enumerate(rows, 100))


@pytest.mark.parametrize("long", [2, 8, 64])
def test_classes_are_those_of_all_pairs(spark, on_disk, rng, long):
    rows = corpus(rng)
    assert result(on_disk(rows), long=long) == classes(rows)


def test_one_group_of_near_copies(spark, on_disk):
    rng = random.Random(3)
    base = prose(rng, 100)
    rows = [(i, edited(rng, base, rng.randint(0, 6))) for i in range(150)] + [(1000 + i, base) for i in range(50)]
    assert result(on_disk(rows), long=16) == classes(rows)


def test_repeated_rows_null_ids_and_long_texts(spark, on_disk, rng):
    long = prose(rng, 30_000)
    rows = [(5, "one two three four five six"), (5, "one two three four five six"), (None, "one two three four five six"), (9, long), (8, edited(rng, long, 100)), (7, None)]
    got = result_with_null(on_disk(rows))
    assert got == sorted([(5, 2, 5), (5, 2, 5), (None, 2, 5), (9, got_size(long), 8), (8, got_size(rows[4][1]), 8), (7, 0, 7)], key=repr)


def got_size(text):
    return len(shingles(text))


def result_with_null(df):
    members, _ = ngram_join.near_duplicates(df)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in members.collect()), key=repr)


def test_empty_table(spark, on_disk):
    assert result(on_disk([])) == []


def test_links_are_exact(spark, on_disk, rng):
    rows = corpus(rng)
    members, links = ngram_join.near_duplicates(on_disk(rows))
    text = {r.set_id: r.doc_id for r in members.collect()}
    by_id = dict(rows)
    found = links.collect()
    assert found
    for r in found:
        a, b = shingles(by_id[text[r.a]]), shingles(by_id[text[r.b]])
        assert r.shared in (None, len(a & b)) and 100 * len(a & b) >= 80 * len(a | b)


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 50 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 50 for i in [*range(50, 80), 100]}, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_that_sums_of_letters_take_for_each_other():
    from gleanery.llm.shingles import shingle_sets

    word = b"a"
    for _ in range(10):  # Thue-Morse: letter sums weighted by powers of any odd number are equal modulo 2^64
        word += word.translate(bytes.maketrans(b"ab", b"ba"))
    other = word.translate(bytes.maketrans(b"ab", b"ba"))
    sets = shingle_sets([word, other, word[:40], other[:40], word, b" ".join([word[:9]] * 9), b"x" * 64, b"x" * 65])
    assert len({s.tobytes() for s in sets}) == 7 and (sets[0] == sets[4]).all()


def test_sets_that_share_a_name(spark, on_disk, rng):
    rows = corpus(rng)
    assert result(on_disk(rows), name_bits=5) == classes(rows)


@pytest.mark.parametrize("most", [1, 4])
def test_more_frequent_shingles_than_are_sought(spark, on_disk, most):
    rng = random.Random(4)
    common = [prose(rng, 12) for _ in range(4)]
    rows = [(i, edited(rng, " ".join(rng.sample(common, 3)), rng.randint(0, 2))) for i in range(120)]
    assert result(on_disk(rows), long=4, frequent_most=most) == classes(rows)
    assert result(on_disk(rows, "again"), long=4) == classes(rows)


def test_answers_are_derived(spark, on_disk):
    """Two groups round two texts that are 84 % alike: pairs across follow from what their leaders have in common."""
    rng = random.Random(9)
    base = prose(rng, 400).split()
    other = base[:365] + prose(rng, 35).split()
    rows = [(i, edited(rng, " ".join(base), 1)) for i in range(30)] + [(100 + i, edited(rng, " ".join(other), 1)) for i in range(30)]
    members, links = ngram_join.near_duplicates(on_disk(rows))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in members.collect()) == classes(rows)
    assert {r.shared is None for r in links.collect()} == {False, True}
