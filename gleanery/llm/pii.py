"""Personal data: spans by fixed patterns, which then teach the contexts that tell further identifiers. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
# Possessive quantifiers where nothing after them could match what they give back: the same matches, in linear time and without recursion.
# A match begins where a run does, or where the match before ended.
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}"
_CARD = r"[0-9](?<![0-9]{2})(?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_BASE = {"email": r"(?:\G|(?<![A-Za-z0-9._%+-]))" + _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: What looks like an identifier: the kinds above, and runs of letters, digits and marks that hold a digit or @.
_RUN = r"\p{L}\p{N}@._%+/-"
_TOKEN = "|".join([rf"(?<![A-Za-z0-9._%+-]){_EMAIL}", _PHONE, rf"{_IP}(?![{_RUN}])(?!\.[0-9])", rf"{_CARD}(?![\p{{L}}@_%+/-])", rf"(?<![{_RUN}])(?=[\p{{L}}._%+/-]*+[0-9@])[{_RUN}]*[\p{{L}}\p{{N}}]"])

#: Code points before and after an identifier that its context is taken from.
CONTEXT = 64
#: Distinct known identifiers of one kind that a pattern needs, and the share of all that stand in it.
SUPPORT, CONFIDENCE = 3, 0.8
#: How certain an identifier must be, by all confident patterns that it stands in.
CERTAINTY = 0.9
ROUNDS = 6
_BLOCK = 256


def _added_up(parts: Column, value) -> Column:
    """Of an array of (gap, size, ...) the array of value(start, end, part), start being all gaps and sizes before and the part's own gap. Summed up in blocks, so that long arrays don't cost their square."""
    empty = F.array().cast("array<int>")
    ends = lambda xs, step: F.aggregate(xs, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda t, x: F.struct((t["at"] + step(x)).alias("at"), F.concat(t["out"], F.array(t["at"] + step(x))).alias("out")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _BLOCK).cast("int")), lambda b: F.slice(parts, b * _BLOCK + 1, F.lit(_BLOCK)))
    summed = F.transform(blocks, lambda b: ends(b, lambda x: x["gap"] + x["size"]))
    before = ends(summed, lambda x: x["at"])["out"]
    placed = F.flatten(F.zip_with(summed, before, lambda s, after: F.transform(s["out"], lambda e: e + after - s["at"])))
    return F.when(F.size(parts) > 0, F.zip_with(parts, placed, lambda p, end: value(end - p["size"], end, p)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    digit = lambda i: F.substr(digits, n - i, F.lit(1)).cast("int")
    twice = lambda c: c * 2 - F.when(c > 4, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda t, i: t + F.when(i % 2 == 1, twice(digit(i))).otherwise(digit(i)))
    return F.when((n >= 13) & (n <= 19), total % 10 == 0).otherwise(False)


def _sound(kind: str, text: Column) -> Column:
    """Whether a match of a kind's pattern is one of its kind."""
    if kind == "ip":
        return text.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return _luhn(_digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def _of(spans, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def kind_of(text: Column) -> Column:
    """The kind that a whole text is by its pattern, the first of those listed; else null."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed([("email", _EMAIL), ("ip", _IP), ("card", _CARD), ("phone", _PHONE)]):
        out = F.when(text.rlike(f"^(?:{pattern})$") & _sound(kind, text), F.lit(kind)).otherwise(out)
    return out


def _sound_spans(kind: str) -> Column:
    placed = _added_up(F.col(f"x_{kind}"), lambda a, b, p: F.struct(F.lit(kind).alias("kind"), a.alias("start"), b.alias("end"), p["value"].alias("value")))
    return F.filter(placed, lambda x: _sound(kind, x["value"]))


def read_texts(documents: DataFrame) -> DataFrame:
    """row, doc_id, base (array of kind, start, end), tokens (array of start, end, value, before, after) of each text, kept: texts are read once and not written."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digits = F.col("t").rlike("[0-9]")
    needs = {"email": F.col("t").contains("@"), "ip": digits, "card": digits, "phone": F.col("t").contains("+"), "token": digits | F.col("t").contains("@")}
    patterns = _BASE | {"token": _TOKEN}
    none = F.array().cast("array<string>")
    rows = documents.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("t"))
    # one step after the other, so that nothing is computed twice
    rows = rows.withColumns({f"m_{k}": F.when(needs[k], F.regexp_extract_all("t", F.lit(p), 0)).otherwise(none) for k, p in patterns.items()})
    rows = rows.withColumns({f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split("t", p, -1)).otherwise(none) for k, p in patterns.items()})
    parts = lambda k: F.zip_with(F.slice(f"p_{k}", F.lit(1), F.size(f"m_{k}")), f"m_{k}", lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("size"), m.alias("value"), F.right(p, F.lit(CONTEXT)).alias("before")))
    rows = rows.withColumns({f"x_{k}": parts(k) for k in patterns})
    spans = {f"s_{k}": _sound_spans(k) for k in KINDS}
    tokens = _added_up(F.col("x_token"), lambda a, b, p: F.struct(a.alias("start"), b.alias("end"), p["value"].alias("value"), p["before"].alias("before")))
    rows = rows.withColumns(spans | {"s_token": tokens})
    found = F.flatten(F.array(*(F.coalesce(F.transform(f"s_{k}", lambda x: x.dropFields("value")), F.array().cast("array<struct<kind:string,start:int,end:int>>")) for k in KINDS)))
    after = F.transform("s_token", lambda x, i: x.withField("after", F.left(F.get("p_token", i + 1), F.lit(CONTEXT))))
    return common.keep(rows.select("row", "doc_id", found.alias("base"), after.alias("tokens")), "personal")


def _occurrences(read: DataFrame) -> DataFrame:
    """row, start, end, instance, kind (null if no pattern knows it), candidate (long enough, with four digits or @), l1, l2, r1, r2 (the words before and after, nearest first) of each token."""
    rows = read.select("row", F.posexplode("tokens").alias("i", "x"), F.size("tokens").alias("n")).select("row", "i", "n", "x.*")
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"\S+"), 0)
    rows = rows.withColumns({"kind": kind_of(F.col("value")), "b": F.reverse(words("before")), "a": words("after")})
    start, end = F.when(F.col("i") == 0, "^").otherwise("#"), F.when(F.col("i") == F.col("n") - 1, "$").otherwise("#")
    word = lambda c, i, edge: F.coalesce(F.get(c, F.lit(i)), edge)
    instance = F.when(F.col("kind") == "card", _digits(F.col("value"))).when(F.col("kind") == "phone", F.concat(F.lit("+"), _digits(F.col("value")))).otherwise(F.lower("value"))
    candidate = F.col("kind").isNull() & (F.length("value") >= 6) & ((F.length(_digits(F.col("value"))) >= 4) | F.col("value").contains("@"))
    return rows.select("row", "start", "end", instance.alias("instance"), "kind", candidate.alias("candidate"), word("b", 0, start).alias("l1"), word("b", 1, start).alias("l2"), word("a", 0, end).alias("r1"), word("a", 1, end).alias("r2"))


def _graph(seen: DataFrame) -> DataFrame:
    """pattern, instance, kind, candidate: which identifiers stand in which lexical patterns, each once however many copies a text has."""
    join = lambda side, *words: F.concat_ws("\x01", F.lit(side), *words)
    patterns = F.array(join("left", "l2", "l1"), join("right", "r1", "r2"), join("around", "l1", "r1"))
    return seen.select(F.explode(patterns).alias("pattern"), "instance", "kind", "candidate").groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.max("candidate").alias("candidate"))


def _discovered(seen: DataFrame, support: float, confidence: float, certainty: float, rounds: int) -> DataFrame:
    """instance, kind: the candidates that confident patterns tell, found by scoring patterns and identifiers in turns until nothing changes."""
    edges = common.keep(_graph(seen), "graph")
    # a pattern in which no candidate stands finds none
    stats = edges.groupBy("pattern").agg(F.count("*").alias("n"), F.max("candidate").alias("any"), *(F.count_if(F.col("kind") == k).alias(k) for k in KINDS)).where("any")
    stats = common.keep(stats, "patterns")
    edges = common.keep(edges.where("candidate").select("pattern", "instance"), "candidates")
    seeds = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("double").alias("hits")) for k in KINDS))
    seeds = stats.select("pattern", F.inline(F.filter(seeds, lambda x: x["hits"] > 0)))
    found, mark = None, None
    for _ in range(rounds):
        hits = seeds
        if found is not None:  # what was found counts by its certainty
            hits = hits.unionByName(edges.join(common.few(found), "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("hits"))).groupBy("pattern", "kind").agg(F.sum("hits").alias("hits"))
        share = F.round(F.col("hits") / (F.col("n") + 1), 9)  # sums come in any order
        sure = hits.where(F.round("hits", 9) >= support).join(stats.select("pattern", "n"), "pattern").select("pattern", "kind", share.alias("share")).where(F.col("share") >= confidence)
        sure = common.few(common.keep(sure, "sure"))
        scored = edges.join(sure, "pattern").groupBy("instance", "kind").agg(F.round(1 - F.exp(F.sum(F.log1p(-F.col("share")))), 9).alias("score")).where(F.col("score") >= certainty)
        order = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
        found = common.keep(scored.groupBy("instance").agg(F.max(F.struct("score", (-order).alias("order"), "kind")).alias("b")).select("instance", "b.kind", "b.score"), "found")
        now = found.agg(F.count("*"), F.sum(F.xxhash64("instance", "kind", "score").cast("decimal(20,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
    return found


def _joined(spans: Column) -> Column:
    """kind:start:end, by kind as listed, then start, joined by commas."""

    def told(kind: str) -> Column:
        placed = F.array_sort(F.transform(_of(spans, kind), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
        return F.transform(placed, lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))

    return F.array_join(F.flatten(F.array(*(told(k) for k in KINDS))), ",")


def personal_data(documents: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, certainty: float = CERTAINTY, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans, n_found of each row: the personal data in its whole text.

    Base spans are the leftmost matches of each kind's pattern that do not overlap, without those that are not of the kind (parts over 255, a wrong
    check digit, too few digits). They are seeds: each lexical pattern (the two words before, the two after, one on each side) is scored for a kind by
    the share of distinct known identifiers among all that stand in it (`support` of them at least, share hits / (n + 1)), each other identifier by all confident patterns it stands
    in, 1 - product(1 - share). Those certain enough count as known in the next round. All places of an identifier found so are added as spans of its kind, unless they overlap a
    base span. Places are code points, ends exclusive.

    Null and empty texts have no spans; an empty table gives an empty table; repeated rows and null ids are rows like others, and repeated texts count once in scores. Long texts are read whole;
    context words are cut at 64 code points from the identifier. Other columns are not read.
    """
    read = read_texts(documents)
    seen = _occurrences(read)
    found = _discovered(seen, support, confidence, certainty, rounds)
    places = seen.where("candidate").select("row", "start", "end", "instance").join(common.few(found.select("instance", "kind")), "instance")
    added = places.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))  # no more than the row's own text has
    rows = read.select("row", "doc_id", "base").join(added, "row", "left")
    clear = F.filter("added", lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    rows = rows.withColumn("added", F.when(F.col("added").isNull(), F.array().cast("array<struct<kind:string,start:int,end:int>>")).otherwise(clear))
    counts = [F.size(_of("base", k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, _joined(F.col("base")).alias("base_spans"), _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_found"))
