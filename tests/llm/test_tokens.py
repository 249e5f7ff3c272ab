import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from prose import prose
from hypothesis import given, settings
from hypothesis import strategies as st

from gleanery.llm import bpe_codec, packing, token_counts

ODD = st.text(alphabet=st.sampled_from(list(" \n\t\r▁　\xa0\x85\x1c\x00aAeéñßİΣςthe.,!?%$0123'漢字🙂́s<|>")), max_size=60)
WORDS = st.lists(st.sampled_from([" ", "  ", "\n", "the", "tion", "é", "Ünter", "don't", "<|endoftext|>", "x1y2", "...", "▁", "un"]), max_size=30).map("".join)


@pytest.fixture(scope="module")
def piece():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.PieceCounter(path), sentencepiece.SentencePieceProcessor(model_file=path)


@pytest.fixture(scope="module")
def codec():
    return bpe_codec.ChunkCodec(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def words():
    return packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(ODD, WORDS, st.text(max_size=40).filter(lambda t: t.isprintable())))
def test_counts(piece, text):
    own, library = piece
    assert own.count(text) == len(library.encode(text))


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(ODD, WORDS, st.tuples(WORDS, WORDS, ODD, WORDS).map("".join)))
@pytest.mark.parametrize("mask, least", [(0, 1), (3, 1), (7, 8)])
def test_codec_with_cuts_anywhere(codec, text, mask, least):
    before, (bpe_codec.MASK, bpe_codec.LEAST) = (bpe_codec.MASK, bpe_codec.LEAST), (mask, least)
    try:
        ids = codec.library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids and codec.decode(ids) == codec.library.decode(ids, skip_special_tokens=False) == text
    finally:
        bpe_codec.MASK, bpe_codec.LEAST = before


@pytest.mark.parametrize("text", [" " * 1_000_000, "a" * 300_000, "\n " * 50_000, "漢字" * 50_000, "ab" * 60_000 + " " * 60_000 + "x", "\u0558\u088f 1\u0c5c." * 3000], ids=lambda t: repr(t[:6]))
def test_codec_on_long_and_odd_texts(codec, text):
    assert codec.encode(text) == codec.library.encode(text, add_special_tokens=False).ids


def test_joins_are_repaired(codec, rng, monkeypatch):
    """Cuts fall within words, so chunks put side by side are not the text's ids; encoding anew around the joins mends that."""
    text = prose(rng, 3000)
    data = text.encode()
    places = [0, *bpe_codec.cuts(data), len(data)]
    ids = codec.library.encode(text, add_special_tokens=False).ids
    assert [i for a, b in zip(places, places[1:]) for i in codec.library.encode(data[a:b].decode(), add_special_tokens=False).ids] != ids
    assert codec.encode(text) == ids


def test_a_chunk_met_again_is_not_encoded_again(rng):
    own = bpe_codec.ChunkCodec(public_tokenizers.path("byte_bpe_50k.json"))
    text = prose(rng, 3000)
    starts = ["", "One. ", "Two or three. "]
    for start in starts:
        own.encode(start + text)
    calls, engine = [], own.engine
    own.engine = lambda t: calls.append(len(t)) or engine(t)
    assert own.encode("Four? " + text) == own.library.encode("Four? " + text, add_special_tokens=False).ids
    assert sum(calls) < len(text) / 4


@pytest.mark.parametrize("text", ["Hello world", "one two three", "x<|endoftext|>a b<|endoftext|>a b", "é " * 9 + "end"])
def test_joined_ids_of_chunks_met_again(text):
    """A remembered chunk with a single space between words has no ids between its first and its last place; that must leave no mark in the joined ids."""
    own = bpe_codec.ChunkCodec(public_tokenizers.path("byte_bpe_50k.json"))
    ids = own.library.encode(text, add_special_tokens=False).ids
    for _ in range(4):
        parts = list(own.parts(text))
        assert ",".join([e[0] for e in parts]) == ",".join(map(str, ids)) and sum([e[2] for e in parts]) == len(ids) and b"".join([e[1] for e in parts]).decode() == text


def test_codec_rows_of_repeated_short_texts(spark, on_disk, codec):
    rows = [(k, t) for k in range(5) for t in ("Hello world", "one two three", "a b", None)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    ids = {t: codec.library.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    got = bpe_codec.encode_and_decode(on_disk(rows, parts=1)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted((d, len(ids[t]), sha(",".join(map(str, ids[t]))), sha(t or "")) for d, t in rows)


def test_cuts_follow_content(rng):
    text = prose(rng, 8000)
    a, b = text.encode(), ("other start " + text).encode()
    cuts_a, cuts_b = set(bpe_codec.cuts(a)), {c - 12 for c in bpe_codec.cuts(b)}
    assert len(cuts_a) > 50 and len(cuts_a & cuts_b) > 0.9 * len(cuts_a)


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(ODD, WORDS))
def test_word_ids(words, text):
    assert words.ids(text) == words.encoded(text)


def edge_rows(rng):
    return [(1, "the cat. The  cat"), (1, "the cat. The  cat"), (2, None), (3, ""), (None, "x"), (4, prose(rng, 20_000)), (5, "y" * 20_000), (6, " " * 3000 + "é")]


def test_count_rows(spark, on_disk, rng, piece):
    rows = edge_rows(rng)
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(on_disk(rows)).collect()), key=repr)
    count = lambda t: len(piece[1].encode(t or ""))
    assert got == sorted(((d, len((t or "").encode()), count(t), count(t) > 4096) for d, t in rows), key=repr)
    assert token_counts.token_counts(on_disk([], "empty")).collect() == []


def test_codec_rows(spark, on_disk, rng, codec):
    rows = edge_rows(rng)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for d, t in rows:
        ids = codec.library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    df = on_disk(rows)
    got = bpe_codec.encode_and_decode(df).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=repr) == sorted(want, key=repr)
    assert {(r.doc_id, r.decoded) for r in bpe_codec.encode_and_decode(df, with_ids=True).collect()} == {(d, t or "") for d, t in rows}


def check_packing(got, rows, capacity, ids_of, most=None, cost=None):
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append(r)
    for parts in bins.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))] and sum(p.length for p in parts) <= capacity
        assert most is None or len(parts) <= most
        assert cost is None or len(parts) == 1 or sum(p.length**2 for p in parts) <= cost
    want = []
    for d, t in rows:
        data = ids_of(t or "") + np.array([1], "<u4").tobytes()
        want += [(d, k, a // 4, len(data[a : a + 4 * capacity]) // 4, zlib.crc32(data[a : a + 4 * capacity])) for k, a in enumerate(range(0, len(data), 4 * capacity))]
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    return len(bins), sum(r.length for r in got)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_rows(spark, on_disk, rng, words, rule):
    rows = edge_rows(rng) + [(10 + i, prose(rng, rng.randint(1, 900))) for i in range(200)]
    bins, total = check_packing(packing.pack(on_disk(rows), rule=rule).collect(), rows, 4096, words.encoded)
    assert bins <= -(-total // 4096) * 1.03 + 1
    tight = packing.pack(spark.read.parquet(str(on_disk(rows, "again").inputFiles()[0]).rsplit("/", 1)[0]), capacity=512, most_documents=3, most_cost=150_000, weights=(1.0, 0.5, 0.5), rule=rule, group=50)
    check_packing(tight.collect(), rows, 512, words.encoded, 3, 150_000)
    assert packing.pack(on_disk([], "empty")).collect() == []


def test_best_fit_takes_the_tightest_bin():
    items = np.array([[6.0], [5.0], [4.0], [5.0], [1.0]])
    assert packing.best_fit(items, np.array([10.0]), np.array([1.0])).tolist() == [0, 1, 0, 1, 2]


def test_all_three_capacities_choose():
    """Two open bins hold the next piece with as many tokens left; documents and squared lengths decide between them."""
    items = np.array([[x, 1.0, x * x] for x in (6.0, 3.0, 3.0, 2.0)])
    capacity = np.array([8.0, 8.0, 64.0])
    by_tokens = packing.best_fit(items[[0, 1, 2, 3]], capacity, np.array([1.0, 0.0, 0.0])).tolist()
    assert by_tokens == [0, 1, 1, 0]
    # bins of 6 (one piece) and of 3 + 3 (two pieces): the rest of tokens is the same, that of the others is not
    assert packing.best_fit(items, capacity, np.array([1.0, 1.0, 0.0])).tolist()[3] == 1
    assert packing.best_fit(items, capacity, np.array([1.0, 0.0, 1.0])).tolist()[3] == 0
    assert all(w > 0 for w in packing.WEIGHTS)


def test_other_capacities_cost_no_sequences(rng):
    x = np.sort(np.minimum(np.random.default_rng(3).lognormal(6.3, 1.2, 4000).astype(int) + 1, 4095))[::-1].astype(float)
    items = np.column_stack([x, np.ones(len(x)), x * x])
    capacity = np.array([4096, 4096, 4096.0**2])
    plain, own = (len(set(packing.best_fit(items, capacity, np.array(w)).tolist())) for w in ((1.0, 0.0, 0.0), packing.WEIGHTS))
    assert own <= plain <= -(-x.sum() // 4096) + 2
