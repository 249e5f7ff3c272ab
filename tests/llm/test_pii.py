"""Personal data against brute force: base patterns as the contract writes them, and the scoring of contexts in plain loops."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanery.llm import pii, queries

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(c if i % 2 == 0 else 2 * c - 9 * (c > 4) for i, c in enumerate(map(int, reversed(d)))) % 10 == 0


def sound(kind, text):
    d = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(x) <= 255 for x in text.split("."))
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    return kind != "phone" or 9 <= len(d) <= 15


def base(text):
    return {k: [(m.start(), m.end()) for m in re.finditer(p, text) if sound(k, m[0])] for k, p in BASE.items()}


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k in BASE for a, b in sorted(spans[k]))


def tokens(text):
    """Matches of the token pattern with their words around, by another route: the regex module reads the same syntax."""
    import regex

    found = list(regex.finditer(pii._TOKEN.replace(r"\x20", " "), text))
    out = []
    for i, m in enumerate(found):
        left = text[found[i - 1].end() if i else 0 : m.start()][-pii.CONTEXT :].lower()
        right = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)][: pii.CONTEXT].lower()
        a, b = ["^" if not i else "#"] * 2 + re.findall(r"\S+", left), re.findall(r"\S+", right) + ["$" if i + 1 == len(found) else "#"] * 2
        v, kind = m[0], next((k for k, p in BASE.items() if re.fullmatch(p, m[0]) and sound(k, m[0])), None)
        d = re.sub("[^0-9]", "", v)
        instance = d if kind == "card" else "+" + d if kind == "phone" else v.lower()
        out.append((m.start(), m.end(), instance, kind, kind is None and len(v) >= 6 and (len(d) >= 4 or "@" in v), [("left", a[-2], a[-1]), ("right", b[0], b[1]), ("around", a[-1], b[0])]))
    return out


def brute(rows, support, confidence, certainty, rounds=pii.ROUNDS):
    seen = [tokens(t or "") for _, t in rows]
    stand, kinds, maybe = defaultdict(set), {}, set()
    for x in seen:
        for _, _, i, kind, candidate, patterns in x:
            kinds[i] = kind
            if candidate:
                maybe.add(i)
            for p in patterns:
                stand[p].add(i)
    found = {}
    for _ in range(rounds):
        left = defaultdict(lambda: 1.0)
        for p, s in stand.items():
            for k in BASE:
                hits = sum(kinds[i] == k for i in s) + sum(found[i][1] for i in s if i in found and found[i][0] == k)
                share = round(hits / (len(s) + 1), 9)
                if round(hits, 9) >= support and share >= confidence:
                    for i in s & maybe:
                        left[i, k] *= 1 - share
        now = {}
        for (i, k), x in left.items():
            if round(1 - x, 9) >= certainty:
                now[i] = max(now.get(i, (k, 0)), (k, round(1 - x, 9)), key=lambda y: (y[1], -list(BASE).index(y[0])))
        if now == found:
            break
        found = now
    out = []
    for (d, t), x in zip(rows, seen):
        spans = base(t or "")
        every = {k: list(v) for k, v in spans.items()}
        for a, b, i, _, candidate, _ in x:
            if candidate and i in found and not any(c < b and a < e for v in spans.values() for c, e in v):
                every[found[i][0]].append((a, b))
        out.append((d, *(len(spans[k]) for k in BASE), joined(spans), joined(every)))
    return sorted(out, key=repr), found


def card(rng, n=16):
    d = "4" + "".join(rng.choice("0123456789") for _ in range(n - 2))
    return next(d + c for c in "0123456789" if luhn(d + c))


def identifier(rng):
    return rng.choice([
        lambda: f"{rng.choice(['ab', 'Jo.X', 'q_9%+-'])}{rng.randint(0, 99)}@mail{rng.randint(0, 3)}.example.com", lambda: ".".join(str(rng.randint(0, 280)) for _ in range(4)),
        lambda: card(rng), lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", lambda: str(rng.randint(0, 10**rng.randint(1, 18))), lambda: f"id{rng.randint(0, 10**6)}x",
    ])()


ODD = [
    "a@b.c@d.e", "a@b.com.@c.d", "a@b.com_x@y.z.w", "a@b..c", "@b.c x@y", "1.2.3.4.5.6.7.8", "01.002.0003.00000000255", "256.1.1.1 1.1.1", "1.2.3.4a 5.6.7", "4111 1111-1111 1111", "41111111111111110000000000", "4111111111111111 4111111111111111",
    "+1 2 3 4 5 6 7 8 9+12345678", "+1 (((", "++12345678901", "é+33 1 23 45 67 89é", "\U0001d518 a@b.c \U0001d518 4111111111111111", "5--4111111111111111", "9" * 3000, "1 " * 2000, "x@" * 1000, "a.b" * 2000, "a@b" + ".c" * 3000, "1." * 3000, "+" * 500, "- 1-2 3", None, "", "\n\t", "4111 1111 1111 1111\n", "x4111111111111111y",
]


def planted(rng):
    rows = []
    for i in range(30):
        rows.append((i, f"please call my desk +1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)} before noon {'so ' * rng.randint(0, 3)}ok"))
        rows.append((100 + i, f"her address was written to us{i}@mail.example.org and nowhere else {'so ' * rng.randint(0, 3)}"))
    # unseen ones: by the first context alone, and by one that only those tell
    rows += [(200, "please call my desk 689-555-4072 before noon"), (201, "her address was written to bob(at)host-77 and bob@localhost and nowhere else"), (202, "number 689-555-4072 stands here too")]
    rows += [(300 + i, f"please call my desk +1 ({300 + i}) 555-0000 before noon or at home extension {555000 + i} today said bo") for i in range(12)]
    return rows + [(400, "the year 202411 of order 7777777 and code 1234567")] + [(500 + i, rows[0][1]) for i in range(40)]


def as_rows(df):
    return sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_spans, r.spans) for r in df.collect()), key=repr)


@pytest.mark.parametrize("support, confidence, certainty", [(3, 0.8, 0.9), (1, 0.3, 0.3)])
def test_personal_data(spark, on_disk, rng, support, confidence, certainty):
    words = "the of call me at mail: write to é server, and card no.".split()
    rows = [(i, t) for i, t in enumerate(ODD)] + planted(rng) + [(None, "x@y.zz"), (3, "x@y.zz")]
    for i in range(400):
        rows.append((1000 + i, "".join(f"{rng.choice(words)} {rng.choice(words)}{rng.choice([' ', ' ', '=', chr(10)])}{identifier(rng)}{rng.choice([' ', ', ', '. ', chr(10), '-'])}" for _ in range(rng.randint(0, 5))) + rng.choice(words)))
    got = as_rows(pii.personal_data(on_disk(rows), support, confidence, certainty))
    want, found = brute(rows, support, confidence, certainty)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == b
    assert found


def test_contexts_tell_what_patterns_do_not(spark, on_disk, rng):
    rows = planted(rng)
    text = {d: t for d, t in rows}
    got = {r.doc_id: r for r in pii.personal_data(on_disk(rows)).collect()}
    at = text[200].index("689")
    assert got[200].spans == f"phone:{at}:{at + 12}" and got[200].base_spans == "" and got[200].n_found == 1
    assert got[202].spans == "phone:7:19"  # the same number in another place
    assert got[400].spans == got[400].base_spans == ""
    assert all(got[i].spans == got[i].base_spans for i in [*range(30), *range(100, 130)])


def test_long_arrays_of_spans(spark, on_disk):
    text = " ".join(f"u{i}@h.io" for i in range(1500))
    (r,) = pii.personal_data(on_disk([(1, text)])).collect()
    assert r.base_spans == joined(base(text)) and r.n_email == 1500


def test_no_texts(spark, on_disk):
    assert pii.personal_data(on_disk([], "empty")).collect() == []


def test_query_and_its_plan(spark, sf_dir):
    got = queries.op11_personal_data(spark, sf_dir)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in got.collect():
        spans = base(text[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(spans[k]) for k in BASE)
        assert r.base_sha256 == hashlib.sha256(joined(spans).encode()).hexdigest() and set(filter(None, joined(spans).split(","))) <= set(r.spans.split(","))
