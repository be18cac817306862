"""Secret scan: key patterns, and sliding-window entropy over candidate strings."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns and least lengths of the three base kinds.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex")

#: Entropy terms c * log2(c), as whole millionths, so that sums do not depend on their order.
SCALE = 1_000_000


@dataclass(frozen=True)
class EntropyRule:
    """Candidates of one character class: runs at least ``window`` long that hold a digit and a letter."""

    kind: str
    run: str
    window: int
    bits: float

    @property
    def most(self) -> int:
        """The sum of c * log2(c) over a window's character counts at ``bits`` of entropy."""
        return round(SCALE * self.window * (math.log2(self.window) - self.bits))


RULES = (
    EntropyRule("entropy_hex", r"[0-9A-Fa-f]{20,}", 20, 2.9),
    EntropyRule("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}", 20, 3.7),
)
#: Candidates in which this is found are no secrets: placeholders, counters, identifiers, paths.
ALLOWED = (
    r"(?i)example|sample|placeholder|dummy|changeme|xxxx|your[_-]|lorem",
    r"^[0-9]+$|^[A-Za-z_+/=-]+$",
    r"(?i)0123456789|abcdefghij",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^/?([a-z]+/)+",
)

SPAN = "struct<start:int,rank:int,end:int,kind:string>"


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches as ``(start, end, hit, value)``, in code points.

    ``value`` is the pattern's group ``group``. The text between matches comes from
    a split by the same pattern, so running lengths of both give the places.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    both = F.zip_with(hits, values, lambda h, v: F.struct(h.alias("hit"), v.alias("value")))
    steps = F.zip_with(F.split(text, pattern, -1), both, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), m["hit"].alias("hit"), m["value"].alias("value"),
    ))
    spans = "array<struct<start:int,end:int,hit:string,value:string>>"

    def advance(s: Column, m: Column) -> Column:
        begin = s["at"] + m["gap"]
        end = begin + F.coalesce(F.length(m["hit"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), m["hit"].alias("hit"), m["value"].alias("value"))
        found = F.when(m["hit"].isNotNull(), F.concat(s["found"], F.array(span))).otherwise(s["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def piece(s: Column, own: Column) -> Column:
        # An array grows by copying it, so matches are gathered in short arrays first.
        start = F.struct(s["at"].alias("at"), F.array().cast(spans).alias("found"))
        done = F.aggregate(own, start, advance)
        return bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(s["found"], F.array(d["found"])).alias("found")))

    state = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{spans}>").alias("found"))
    return F.flatten(F.aggregate(pieces(steps), state, piece, lambda s: s["found"]))


def bound(value: Column, then) -> Column:
    """``then`` of a value that is computed once, wherever it is used inside."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


#: Elements of an array that are looked at together.
PIECE = 256


def pieces(array: Column) -> Column:
    """The array cut into arrays of ``PIECE`` elements."""
    def cut(a: Column) -> Column:
        last = F.greatest(F.ceil(F.size(a) / PIECE).cast("int"), F.lit(1)) - 1
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(a, k * PIECE + 1, F.lit(PIECE)))

    return bound(array, cut)


def _ranked(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")
    ))


#: Characters of a candidate. Counts of twelve of them lie in one long, five bits each.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
COUNT_BITS, PER_LONG = 5, 12
LONGS = -(-(len(ALPHABET) + 1) // PER_LONG)


def least_spread(candidate: Column, window: int) -> Column:
    """The least sum of c * log2(c), in millionths, that any window of the candidate has.

    Counts are kept from one window to the next: the entering character adds one,
    the leaving one takes one away, and only their two terms of the sum change. A window
    has at most 31 characters; those outside ``ALPHABET`` count as one. Each character
    costs the same however long the candidate is.
    """
    if window >= 1 << COUNT_BITS:
        raise ValueError(f"a window has fewer than {1 << COUNT_BITS} characters")
    terms = F.array(*[F.lit(round(SCALE * c * math.log2(c)) if c else 0) for c in range(window + 1)])
    counts = [f"c{i}" for i in range(LONGS)]
    start = F.struct(
        *[F.lit(0).cast("bigint").alias(c) for c in counts], F.lit(0).cast("bigint").alias("total"),
        F.lit(0).alias("n"), F.lit(None).cast("bigint").alias("least"),
    )

    def place(code: Column) -> tuple[Column, Column]:
        return F.floor(code / PER_LONG).cast("int"), code % PER_LONG * COUNT_BITS

    def count(of: dict[str, Column], code: Column) -> Column:
        long, shift = place(code)
        held = F.lit(0).cast("bigint")
        for i, c in enumerate(counts):
            held = F.when(long == i, of[c]).otherwise(held)
        return F.call_function("shiftright", held, shift).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)).cast("int")

    def changed(of: dict[str, Column], code: Column, by: int) -> dict[str, Column]:
        long, shift = place(code)
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
        return {c: F.when(long == i, of[c] + by * one).otherwise(of[c]) for i, c in enumerate(counts)}

    def term(c: Column) -> Column:
        return F.get(terms, c).cast("bigint")

    def leave(s: Column, x: Column) -> Column:
        held = {c: s[c] for c in counts}
        c = count(held, x["leave"])
        left = changed(held, x["leave"], -1)
        total = s["total"] + term(c - 1) - term(c)
        gone = F.struct(*[left[c].alias(c) for c in counts], total.alias("total"), s["n"].alias("n"), s["least"].alias("least"))
        return F.when(x["leave"] >= 0, gone).otherwise(s)

    def enter(s: Column, x: Column) -> Column:
        held = {c: s[c] for c in counts}
        c = count(held, x["enter"])
        more = changed(held, x["enter"], 1)
        total = s["total"] + term(c + 1) - term(c)
        least = F.when(s["n"] + 1 >= window, F.least(s["least"], total)).otherwise(s["least"])
        return F.struct(
            *[more[c].alias(c) for c in counts], total.alias("total"), (s["n"] + 1).alias("n"), least.alias("least")
        )

    codes = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(ALPHABET), ch))

    def moves(code: Column) -> Column:
        before = F.concat(F.array_repeat(F.lit(-1), window), code)
        both = F.zip_with(code, before, lambda e, o: F.struct(e.alias("enter"), o.alias("leave")))
        return F.slice(both, F.lit(1), F.size(code))

    steps = bound(codes, moves)
    found = F.aggregate(steps, start, lambda s, x: bound(leave(s, x), lambda t: enter(t, x)), lambda s: s["least"])
    return F.when(F.length(candidate) >= window, found)


def base_spans(text: Column) -> Column:
    """Spans of the three base kinds, each with the rank of its kind."""
    kept = F.filter(located(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    found = (kept, located(text, ACCESS), located(text, HEX))
    return F.concat(*[_ranked(spans, rank, KINDS[rank]) for rank, spans in enumerate(found)])


def entropy_spans(text: Column, rules: tuple[EntropyRule, ...] = RULES) -> Column:
    """Candidates with a window of high entropy that no allow-list pattern suppresses."""
    def wanted(rule: EntropyRule):
        def test(s: Column) -> Column:
            allowed = F.lit(False)
            for pattern in ALLOWED:
                allowed = allowed | s["hit"].rlike(pattern)
            return F.when(allowed, F.lit(False)).otherwise(least_spread(s["hit"], rule.window) <= rule.most)

        return test

    return F.concat(*[
        _ranked(F.filter(located(text, rule.run), wanted(rule)), rank, rule.kind)
        for rank, rule in enumerate(rules, start=len(KINDS))
    ])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Adds ``secret_spans`` to ``docs``: all spans of the whole text, by start, then kind.

    Base spans are the leftmost non-overlapping matches of each kind. Entropy
    spans cover candidate strings one of whose windows reaches its class's bits. A
    null text counts as empty. No shuffle; texts without a match are only scanned.
    A column of that name is replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    base = F.when(text.rlike(f"{ASSIGN}|{ACCESS}|{HEX}"), base_spans(text)).otherwise(none)
    entropy = F.when(text.rlike(RULES[1].run), entropy_spans(text)).otherwise(none)
    both = F.sort_array(F.concat(base, entropy))
    return docs.withColumn("secret_spans", both)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
