"""Invented text for the tests of this folder."""

SYLLABLES = "the ti on an er ha re ou st nd is at en or in ble ed tion".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))
