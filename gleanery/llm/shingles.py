"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once in numpy."""

from __future__ import annotations

import numpy as np

WORDS = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BY_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)
#: Words of more bytes are hashed one by one.
LONG = 64
_powers: dict[int, np.ndarray] = {}


def power_table(base: int, n: int) -> np.ndarray:
    """The first n powers of base, modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(part: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Of each word of part: eight bytes after the other are mixed into what the ones before gave, so no sum of letters tells the hash."""
    import xxhash

    size = last - first
    eights = np.ndarray(len(part), np.uint64, np.concatenate([part, np.zeros(8, np.uint8)]), 0, (1,))  # the eight bytes from each place on
    h = mix(size.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    open_ = np.flatnonzero(size <= LONG)
    for at in range(0, LONG, 8):
        open_ = open_[size[open_] > at]
        if not len(open_):
            break
        x = eights[first[open_] + at]
        unused = np.maximum(8 - (size[open_] - at), 0).astype(np.uint64) * np.uint64(8)
        h[open_] = mix((h[open_] ^ ((x << unused) >> unused)) * np.uint64(0x9E3779B97F4A7C15))
    for i in np.flatnonzero(size > LONG):
        h[i] = xxhash.xxh3_64_intdigest(part[first[i] : last[i]].tobytes())
    return h


def word_hashes(data: bytes, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Start of each whitespace-separated word of lower-cased bytes, and its hash; works in blocks cut at white space."""
    starts, hashes, at = [], [], 0
    flat = np.frombuffer(data, np.uint8)
    while at < len(flat):
        stop = min(len(flat), at + block)
        while stop < len(flat) and not _SPACE[flat[stop]]:
            more = _SPACE[flat[stop : stop + block]]
            stop += int(more.argmax()) if more.any() else len(more)
        part = flat[at:stop]
        word = ~_SPACE[part]
        edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            starts.append(first + at)
            hashes.append(_hashes(part, first, last))
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(data: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """For each text its set of distinct shingles, sorted: of `words` words, or the whole sequence if it is shorter; no words, no shingles."""
    lowered = [x.lower() for x in data]
    begin = np.zeros(len(data) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in lowered], out=begin[1:])
    starts, hashes = word_hashes(b"\n".join(lowered))
    cut = np.searchsorted(starts, begin)
    place = np.resize(_BY_PLACE, words) if words <= len(_BY_PLACE) else mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    out = []
    if len(hashes) >= words:
        n = len(hashes) - words + 1
        runs = np.zeros(n, np.uint64)
        for k in range(words):
            runs += hashes[k : k + n] * place[k]
        runs = mix(runs)
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= words:
            s = np.sort(runs[a : b - words + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            short = int((hashes[a:b] * place[: b - a]).sum(dtype=np.uint64)) + int(b - a) * 0x2545F4914F6CDD1D & (1 << 64) - 1
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
