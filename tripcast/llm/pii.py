"""Personal data by weak supervision, in DataFrame operations only.

Base spans come from fixed patterns and checks (email, ip, card, phone).  The
method adds spans of the same kinds written in other ways, and access tokens,
by aggregating weak labelers:

1. Wide patterns propose candidates of each kind (``KINDS``).
2. Labelers look at a candidate and vote yes, no or nothing: its form
   (regular expressions, check digits), a gazetteer (mail domains, dialling
   codes, key names) and its context (words and signs just before and after).
3. Candidates are counted by (kind, votes) over all documents: at most
   3 ** labelers rows per kind, whatever the corpus.  On this table
   expectation-maximisation estimates how often each labeler is right on true
   and on false candidates, and how often candidates are true.
4. The posteriors weight the table's rows, on which a logistic model per kind
   is fitted over the votes.  It is the final classifier: its few weights go
   into the scoring pass as plain numbers.
5. A candidate it calls likely becomes a span unless it crosses a base span of
   its kind; base spans always stay.

Positions come from splitting a text at the matches and adding up the lengths
of the parts, in two levels so that many matches stay cheap; patterns are
possessive or anchored where that can't change a match, so long runs are
scanned once.

Cases: a null or empty text has no spans; texts are scanned whole; kinds may
cross each other, as base kinds may; without candidates the model is the
prior; empty tables give no rows; repeated rows each get theirs; extra columns
are kept, and refused if named like an added one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcast.llm.common import table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
#: fixed values: the base patterns. Possessive, and started only where the run before can't be part of the
#: match: the same leftmost matches as the plain forms, in one pass over long runs.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: wide patterns: the base forms written in other ways, and tokens
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}+(?:[./_][0-9]{4}+){3}+(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:\([0-9]{3}+\)\x20?|[0-9]{3}+[.-])[0-9]{3}+[.-][0-9]{4}+(?![0-9A-Za-z-])",
    "secret": r"(?<![A-Za-z0-9])[A-Za-z0-9_-]{20,}+",
}
#: what a text must hold for a kind to be looked for at all
NEEDS = {
    ("base", "email"): "@", ("base", "phone"): r"\+[0-9]", ("base", "ip"): r"[0-9]\.[0-9]",
    ("base", "card"): "[0-9][ -]?[0-9]", ("wide", "email"): r"[\(\[]at[\)\]]", ("wide", "ip"): "[0-9A-Fa-f]:[0-9A-Fa-f]",
    ("wide", "card"): "[0-9]{4}[./_][0-9]{4}", ("wide", "phone"): "[0-9]{3}[.-][0-9]{4}",
    ("wide", "secret"): "(?<![A-Za-z0-9])[A-Za-z0-9_-]{20}",
}
#: gazetteers
MAIL_ENDS = ("com", "org", "net", "edu", "gov", "info", "de", "fr", "es", "it", "uk", "eu", "example")
KEY_NAMES = ("token", "secret", "password", "passwd", "api_key", "apikey", "key", "auth", "bearer")
HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "write", "reach"), "ip": ("ip", "host", "server", "address", "ping"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment"),
    "phone": ("call", "phone", "tel", "mobile", "fax", "number"), "secret": KEY_NAMES,
}
AGAINST = ("version", "isbn", "page", "order", "id", "ref", "doi", "figure", "sha", "commit")
CONTEXT = 40                 # characters before and after a span that a labeler may read
CHUNK = 256                  # matches per step of the two-level running sum
ROUNDS = 50
LIKELY = 0.5
RIDGE = 0.05


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often it is used:
    inside a lambda Spark would repeat the expression."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def luhn(number: Column) -> Column:
    """Whether a string of digits has a right Luhn check digit."""

    def right(n: Column) -> Column:
        def worth(i: Column) -> Column:
            d = F.substring(F.concat(F.lit("0"), n), F.length(n) - i + 2, F.lit(1)).cast("int")
            return F.when(i % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

        places = F.sequence(F.lit(1), F.greatest(F.length(n), F.lit(1)))
        total = F.aggregate(places, F.lit(0), lambda a, i: a + worth(i))
        return (F.length(n) > 0) & (total % 10 == 0)

    return let(number, right)


def passes(kind: str, found: Column) -> Column:
    """The base check of a kind."""
    if kind == "ip":
        # at most 255: three digits at most but for leading zeros, and those
        return F.forall(F.split(found, r"\."), lambda p: p.rlike("^0*[0-9]{1,3}$")
                        & (F.substring(F.concat(F.lit("00"), p), -3, 3).cast("int") <= 255))
    if kind == "card":
        return F.length(digits(found)).between(14, 19) & luhn(digits(found))
    if kind == "phone":
        return F.length(digits(found)).between(10, 15)
    return F.lit(True)


def running(lengths: Column) -> Column:
    """Sums of all earlier numbers, for each: sums over chunks of ``CHUNK``
    first, then inside a chunk."""
    zero = F.lit(0).cast("long")

    def total(numbers: Column) -> Column:
        return F.aggregate(numbers, zero, lambda a, x: a + x)

    def before(numbers: Column, base: Column) -> Column:
        return F.transform(numbers, lambda _, i: base + total(F.slice(numbers, F.lit(1), i)))

    def cut(numbers: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / CHUNK).cast("int")),
                           lambda c: F.slice(numbers, c * CHUNK + 1, F.lit(CHUNK)))

    def added(chunks: Column) -> Column:
        bases = let(F.transform(chunks, total), lambda sums: before(sums, zero))
        return F.flatten(F.transform(F.arrays_zip(chunks.alias("numbers"), bases.alias("base")),
                                     lambda c: before(c["numbers"], c["base"])))

    return let(lengths, lambda numbers: let(cut(numbers), added))


def matches(text: Column, kind: str, pattern: str, need: str) -> Column:
    """All matches as (kind, start, end, found, before, after), by position."""
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(pair: Column) -> Column:
        gaps, found = pair["gaps"], pair["found"]
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found,
                             lambda g, m: (F.length(g) + F.length(m)).cast("long"))
        return F.transform(
            F.arrays_zip(found.alias("found"), running(lengths).alias("at"),
                         F.slice(gaps, F.lit(1), F.size(found)).alias("before"),
                         F.slice(gaps, F.lit(2), F.size(found)).alias("after")),
            lambda s: F.struct(
                F.lit(kind).alias("kind"), (s["at"] + F.length(s["before"])).alias("start"),
                (s["at"] + F.length(s["before"]) + F.length(s["found"])).alias("end"), s["found"].alias("found"),
                F.substring(s["before"], -CONTEXT, CONTEXT).alias("before"),
                F.substring(s["after"], 1, CONTEXT).alias("after")))

    held = let(F.struct(gaps.alias("gaps"), found.alias("found")),
               lambda p: F.when(F.size(p["found"]) > 0, placed(p)).otherwise(F.lit(None)))
    return F.when(text.rlike(need), F.coalesce(held, no_match())).otherwise(no_match())


def no_match() -> Column:
    return F.expr("cast(array() as array<struct<kind:string,start:bigint,end:bigint,found:string,before:string,"
                  "after:string>>)")


def vote(yes: Column, no: Column) -> Column:
    """1, -1 or 0."""
    return F.when(yes, F.lit("+")).when(no, F.lit("-")).otherwise(F.lit("0"))


def has_word(text: Column, words: tuple[str, ...]) -> Column:
    return F.lower(text).rlike(r"(?<![a-z])(?:" + "|".join(w.replace("-", r"\-") for w in words) + r")(?![a-z])")


def votes(c: Column, kind: str) -> list[Column]:
    """What each labeler of a kind says of a candidate."""
    found, before, after = c["found"], c["before"], c["after"]
    number = digits(found)
    near = F.concat(F.substring(before, -24, 24), F.lit(" "), F.substring(after, 1, 16))
    context = vote(has_word(near, HINTS[kind]), has_word(F.substring(before, -24, 24), AGAINST))
    open_ = vote(before.rlike(r"(?:^|[\s:=(<\"'|])$") & ~after.rlike(r"^[A-Za-z0-9]"), before.rlike(r"[/\\_#-]$"))
    if kind == "email":
        name = F.lower(F.regexp_extract(found, r"([A-Za-z0-9-]+)$", 1))
        return [vote(found.rlike(r"^[A-Za-z0-9]"), found.rlike(r"^[._%+-]")),
                        vote(name.isin(*MAIL_ENDS), ~name.rlike("^[a-z]{2,6}$")), context, open_]
    if kind == "ip":
        parts = F.array_distinct(F.split(F.lower(found), "[:.]"))
        return [vote(F.size(parts) > 3, F.size(parts) < 2),
                        vote(found.rlike(r"^(?:2[0-9a-f]{3}|fe80|fd|1[0-9]{1,2}\.)"), found.rlike(r"^(?:0|255)[.:]")),
                        context, open_]
    if kind == "card":
        return [vote(luhn(number), ~luhn(number)),
                        vote(number.rlike("^(?:4|5[1-5]|3[47]|6011)"), number.rlike("^0")), context, open_]
    if kind == "phone":
        return [vote(F.length(number).between(10, 15), F.length(number) < 10),
                        vote(found.rlike(r"^\+?[(1-9]") & ~number.rlike("^0"), number.rlike(r"^(.)\1+$")), context, open_]
    kinds = sum((found.rlike(p).cast("int") for p in ("[a-z]", "[A-Z]", "[0-9]")), F.lit(0))
    return [
        vote((F.length(found) >= 32) & found.rlike("^[0-9a-f]+$") & (kinds > 1) | (kinds == 3), kinds < 2),
        vote(F.length(F.regexp_replace(found, "[^0-9]", "")) * 5 >= F.length(found), ~found.rlike("[0-9]")),
        vote(has_word(before, KEY_NAMES) & before.rlike(r"[=:]\s*[\"']?$"), before.rlike("[A-Za-z,.] ?$")),
        vote(before.rlike("[\"']$") & after.rlike("^[\"']"), before.rlike(r"[/\\#-]$"))]


def candidates(text: Column) -> dict[str, tuple[Column, Column]]:
    """By kind: the base spans and the further candidates."""
    def of(kind: str) -> tuple[Column, Column]:
        wide = matches(text, kind, WIDE[kind], NEEDS["wide", kind])
        if kind not in BASE:
            return no_match(), wide
        base = matches(text, kind, PATTERNS[kind], NEEDS["base", kind])
        return F.filter(base, lambda s: passes(kind, s["found"])), wide

    return {kind: of(kind) for kind in KINDS}


def expectation_maximisation(rows: list[tuple[str, int]]) -> list[float]:
    """Chance that each row's candidates are true, from (votes, count): a
    two-class model with independent labelers, started from the majority."""
    signs = "+-0"
    width = len(rows[0][0])
    chance = [min(0.9, max(0.1, 0.5 + 0.4 * (v.count("+") - v.count("-")) / width)) for v, _ in rows]
    for _ in range(ROUNDS):
        total = [sum(n for _, n in rows) + 2.0, 0.0]
        total[1] = sum(p * n for p, (_, n) in zip(chance, rows, strict=True)) + 1.0
        prior = total[1] / total[0]
        rate = [[{s: 1.0 for s in signs} for _ in range(width)] for _ in (0, 1)]
        for p, (v, n) in zip(chance, rows, strict=True):
            for k, s in enumerate(v):
                rate[1][k][s] += p * n
                rate[0][k][s] += (1 - p) * n
        for side in rate:
            for table_ in side:
                z = sum(table_.values())
                for s in signs:
                    table_[s] /= z
        after = []
        for v, _ in rows:
            gap = math.log(prior / (1 - prior)) + sum(math.log(rate[1][k][s] / rate[0][k][s]) for k, s in enumerate(v))
            after.append(1 / (1 + math.exp(-max(-30.0, min(30.0, gap)))))
        chance = after
    # the classes carry no names: the true one is that whose labelers say yes more often
    lean = sum(rate[1][k]["+"] - rate[0][k]["+"] - rate[1][k]["-"] + rate[0][k]["-"] for k in range(width))
    return chance if lean >= 0 else [1 - p for p in chance]


def logistic(rows: list[tuple[str, int]], chance: list[float]) -> list[float]:
    """Weights (intercept first) of a logistic model of the chance over the
    votes as +1, -1 and 0, by gradient steps on the counted rows."""
    x = [[1.0] + [{"+": 1.0, "-": -1.0, "0": 0.0}[s] for s in v] for v, _ in rows]
    weight, total = [0.0] * len(x[0]), sum(n for _, n in rows)
    for _ in range(400):
        step = [-RIDGE * w / len(weight) for w in weight]
        for xi, (_, n), y in zip(x, rows, chance, strict=True):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weight, xi, strict=True))))))
            for k, a in enumerate(xi):
                step[k] += (y - p) * a * n / total
        weight = [w + s for w, s in zip(weight, step, strict=True)]
    return weight


def fit(docs: DataFrame, text: str = "text") -> dict[str, list[float]]:
    """Weights by kind, from the votes on all candidates of all documents."""
    body = F.coalesce(F.col(text), F.lit(""))

    def seen(kind: str, base: Column, wide: Column) -> Column:
        return F.transform(F.concat(base, wide), lambda c: F.struct(
            F.lit(kind).alias("kind"), F.concat(*votes(c, kind)).alias("votes")))

    found = [seen(kind, *both) for kind, both in candidates(body).items()]
    counts = docs.select(F.explode(F.concat(*found)).alias("c")).groupBy("c.kind", "c.votes").count().collect()
    model = {}
    for kind in KINDS:
        rows = sorted((r["votes"], r["count"]) for r in counts if r["kind"] == kind)
        if rows:
            model[kind] = logistic(rows, expectation_maximisation(rows))
    return model


def with_spans(docs: DataFrame, model: dict[str, list[float]], text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (start, kind
    number, end, kind), by start, then kind."""
    if clash := {"base_spans", "spans", "pii__"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are named like added ones")

    def plain(found: Column, kind: str) -> Column:
        return F.transform(found, lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                     c["end"].alias("end"), F.lit(kind).alias("kind")))

    def likely(c: Column, kind: str) -> Column:
        total = F.lit(model[kind][0])
        for weight, sign in zip(model[kind][1:], votes(c, kind), strict=True):
            total = total + F.when(sign == "+", weight).when(sign == "-", -weight).otherwise(0.0)
        return total >= math.log(LIKELY / (1 - LIKELY))

    def added(base: Column, wide: Column, kind: str) -> Column:
        if kind not in model:
            return F.filter(wide, lambda c: F.lit(False))
        return F.filter(wide, lambda c: likely(c, kind) & ~F.exists(
            base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))

    found = candidates(F.coalesce(F.col(text), F.lit("")))
    # evaluated once each: a column that a projection of its own holds
    held = docs.withColumn("pii__", F.struct(*[F.struct(b.alias("base"), w.alias("wide")).alias(k)
                                               for k, (b, w) in found.items()]))
    base = {k: F.col(f"pii__.{k}.base") for k in KINDS}
    more = {k: added(base[k], F.col(f"pii__.{k}.wide"), k) for k in KINDS}
    return held.withColumns({
        "base_spans": F.array_sort(F.concat(*[plain(base[k], k) for k in BASE])),
        "spans": F.array_sort(F.concat(*[plain(base[k], k) for k in BASE], *[plain(more[k], k) for k in KINDS])),
    }).drop("pii__")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with its spans replaced by their kind in angle brackets; spans
    that cross become one, of the kind that begins first."""
    def merged_of(both: Column) -> Column:
        # spans by start, and all ends in order: a span begins a stretch of its own where as many spans have
        # ended as come before it, and the stretch ends with the last end before the next one begins
        spans_, ends = both["spans"], both["ends"]
        places = F.sequence(F.lit(1), F.size(spans_))
        first = F.filter(places, lambda i: (i == 1) | (F.try_element_at(ends, i - 1) <= F.element_at(spans_, i)["start"]))

        def stretch(begins: Column) -> Column:
            def one(i: Column, k: Column) -> Column:
                after = F.coalesce(F.try_element_at(begins, k + 2), F.size(spans_) + 1)
                s = F.element_at(spans_, i)
                return F.struct(s["start"].alias("start"), F.element_at(ends, after - 1).alias("end"), s["kind"].alias("kind"))

            return F.transform(begins, one)

        return let(first, stretch)

    def rebuilt(merged: Column) -> Column:
        def part(s: Column, i: Column) -> Column:
            begin = F.coalesce(F.try_element_at(merged, F.when(i > 0, i))["end"], F.lit(0))
            return F.concat(F.substring(text, (begin + 1).cast("int"), (s["start"] - begin).cast("int")),
                            F.lit("<"), s["kind"], F.lit(">"))

        last = F.element_at(merged, -1)["end"]
        return F.concat(F.array_join(F.transform(merged, part), ""),
                        F.substring(text, (last + 1).cast("int"), F.length(text)))

    held = F.struct(spans.alias("spans"), F.array_sort(F.transform(spans, lambda s: s["end"])).alias("ends"))
    return F.when(F.size(spans) == 0, text).otherwise(let(let(held, merged_of), rebuilt))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = with_spans(docs, fit(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(joined(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
