"""Conversation structure repair: the cheapest edits that make turns alternate, with an audit of them.

An audit is a string of one letter per edit. The dynamic program keeps, for each state of
the wanted order of roles, one prefix as a node that is linked to the prefix before it,
so that prefixes share their beginnings. Nodes know their ancestors at powers of two
and a rolling hash; ties between audits are settled by searching the longest common
prefix along those ancestors, and equal hashes are verified on the letters.

Rows are range-partitioned in the order of turns, so a conversation that holds a third
of all rows lies in many tasks. What a task cannot finish it describes by blocks: the
cheapest audit from each state to each state. Blocks are then chained by the same
program, whose nodes hold a block's audit instead of a letter.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapstrata.llm.common import small_batches, stored

# The edits in ASCII order, their costs, and what each state takes next.
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 2, 5, 1, 5
EMPTY, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STEPS = {
    (EMPTY, "s"): AFTER_SYSTEM, (EMPTY, "u"): AFTER_USER, (AFTER_SYSTEM, "u"): AFTER_USER,
    (AFTER_USER, "a"): AFTER_ASSISTANT, (AFTER_ASSISTANT, "u"): AFTER_USER,
}
WHOLE = (EMPTY, AFTER_ASSISTANT)
LEGAL = {"su", "ua", "au"}
WHITE = " \t\n\x0b\x0c\r"
ENDINGS = ".!?"

FORCED, TRUNCATED, SOUND = range(3)
#: Rows and characters after which a conversation's rows are described as a block.
BLOCK_ROWS = 2048
BLOCK_CHARS = 1 << 22

_BASE, _MODULUS = 911_382_323, (1 << 61) - 1


def given_role(state: int) -> str:
    """The role that an inserted or reroled turn gets in a state."""
    return "assistant" if state == AFTER_USER else "user"


class Edits:
    """Prefixes of audits as linked nodes; node 0 is the empty one."""

    def __init__(self):
        self.label, self.depth, self.hash, self.above = [""], [0], [0], [[]]
        self._known: dict[str, tuple[int, int]] = {}

    def _label_hash(self, label: str) -> tuple[int, int]:
        if label not in self._known:
            value = 0
            for letter in label:
                value = (value * _BASE + ord(letter)) % _MODULUS
            self._known[label] = value, pow(_BASE, len(label), _MODULUS)
        return self._known[label]

    def add(self, parent: int, label: str) -> int:
        value, power = self._label_hash(label)
        above = [parent]
        while len(self.above[above[-1]]) >= len(above):
            above.append(self.above[above[-1]][len(above) - 1])
        self.label.append(label)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * power + value) % _MODULUS)
        self.above.append(above)
        return len(self.label) - 1

    def parent(self, node: int) -> int:
        return self.above[node][0]

    def labels(self, node: int, stop_depth: int = 0) -> list[str]:
        """The labels from below ``stop_depth`` down to the node."""
        found = []
        while self.depth[node] > stop_depth:
            found.append(self.label[node])
            node = self.parent(node)
        return found[::-1]

    def text(self, node: int, stop_depth: int = 0) -> str:
        return "".join(self.labels(node, stop_depth))

    def _lift(self, node: int, depth: int) -> int:
        while self.depth[node] > depth:
            step = (self.depth[node] - depth).bit_length() - 1
            node = self.above[node][step]
        return node

    def _same(self, a: int, b: int) -> bool:
        """Whether nodes of equal depth and hash have equal labels, up to the node they share."""
        while a != b:
            if self.label[a] != self.label[b]:
                return False
            a, b = self.parent(a), self.parent(b)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the text of ``a`` comes before that of ``b``."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self._lift(a, depth), self._lift(b, depth)
        if self.hash[x] != self.hash[y]:
            for step in range(len(self.above[x]) - 1, -1, -1):
                if step < len(self.above[x]):
                    up, over = self.above[x][step], self.above[y][step]
                    if self.hash[up] != self.hash[over]:
                        x, y = up, over
            x, y = self.parent(x), self.parent(y)
            depth = self.depth[x]
        if not self._same(x, y):
            return self.text(a) < self.text(b)
        if self.depth[a] > depth and self.depth[b] > depth:
            first, second = self.label[self._lift(a, depth + 1)], self.label[self._lift(b, depth + 1)]
            if not first.startswith(second) and not second.startswith(first):
                return first < second
        return self.text(a, depth) < self.text(b, depth)


class Front:
    """The best prefix of each state: its cost and node, or nothing."""

    def __init__(self, edits: Edits):
        self.edits = edits
        self.best: list[tuple[int, int] | None] = [None] * 4
        self.offers: list[tuple[int, int, str] | None] = [None] * 4

    def offer(self, state: int, cost: int, node: int, label: str) -> None:
        held = self.offers[state]
        if held is None or cost < held[0]:
            self.offers[state] = cost, node, label
        elif cost == held[0] and (node, label) != held[1:]:
            new, old = self.edits.add(node, label), self.edits.add(held[1], held[2])
            if self.edits.less(new, old):
                self.offers[state] = cost, node, label

    def settle(self) -> None:
        self.best = [None if o is None else (o[0], self.edits.add(o[1], o[2])) for o in self.offers]
        self.offers = [None] * 4

    def insert(self) -> None:
        """Turns inserted here, in an order in which one visit of each state is enough."""
        edits = self.edits
        for state in (EMPTY, AFTER_SYSTEM, AFTER_ASSISTANT, AFTER_USER):
            if self.best[state] is None:
                continue
            cost, node = self.best[state][0] + INSERT_COST, self.best[state][1]
            to = STEPS[state, given_role(state)[0]]
            held = self.best[to]
            if held is None or cost < held[0]:
                self.best[to] = cost, edits.add(node, INSERT)
            elif cost == held[0]:
                new = edits.add(node, INSERT)
                if edits.less(new, held[1]):
                    self.best[to] = cost, new


def block_paths(rows: list[tuple[str, int]], start: int) -> list[tuple[int, str] | None]:
    """Cheapest cost and audit from ``start`` to each state over rows of ``(role initial, kind)``."""
    edits = Edits()
    front = Front(edits)
    front.best[start] = 0, 0
    front.insert()
    for initial, kind in rows:
        extra = TRUNCATED_COST if kind == TRUNCATED else 0
        for state, held in enumerate(front.best):
            if held is None:
                continue
            cost, node = held
            front.offer(state, cost + DELETE_COST, node, DELETE)
            if kind == FORCED:
                continue
            if (state, initial) in STEPS:
                front.offer(STEPS[state, initial], cost + extra, node, KEEP)
            role = given_role(state)
            front.offer(STEPS[state, role[0]], cost + extra + REROLE_COST, node, REROLE)
        front.settle()
        front.insert()
    return [None if held is None else (held[0], edits.text(held[1])) for held in front.best]


def best_of(edits: Edits, best: list[tuple[int, int] | None]) -> tuple[int, int]:
    """The cheaper prefix, then the ASCII-least one, among the states that end a whole conversation."""
    ends = [best[state] for state in WHOLE if best[state] is not None]
    chosen = ends[0]
    for cost, node in ends[1:]:
        if cost < chosen[0] or cost == chosen[0] and edits.less(node, chosen[1]):
            chosen = cost, node
    return chosen


def repaired_lines(
    turns: list[tuple[str, str]], audit: str, state: int
) -> list[tuple[str, str]]:
    """Role and text of the turns that an audit leaves, read from a state on."""
    left, at = [], 0
    for letter in audit:
        role = given_role(state)
        if letter == INSERT:
            left.append((role, ""))
        else:
            own, text = turns[at]
            at += 1
            if letter == DELETE:
                continue
            role = own if letter == KEEP else role
            left.append((role, text))
        state = STEPS[state, role[0]]
    return left


class _Block:
    """Rows of one conversation in order, and what is counted on the way."""

    def __init__(self, conv, number: int, continued: bool = False):
        self.conv, self.number, self.continued = conv, number, continued
        self.rows: list[tuple[str, int]] = []
        self.turns: list[tuple[str, str]] = []
        self.chars = 0
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.low = self.high = None
        self.distinct = 0

    def full(self) -> bool:
        return len(self.rows) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def add(self, turn, role: str, text: str, seen: bool) -> None:
        ending = text.rstrip(WHITE)
        kind = SOUND
        if not ending:
            self.counts["blank"] += 1
            kind = FORCED
        elif seen:
            self.counts["duplicate"] += 1
            kind = FORCED
        elif ending[-1] not in ENDINGS:
            self.counts["truncated"] += 1
            kind = TRUNCATED
        if self.rows and self.rows[-1][0] + role[:1] not in LEGAL:
            self.counts["illegal"] += 1
        self.rows.append((role[:1], kind))
        self.turns.append((role, "" if kind == FORCED else text))
        self.chars += len(self.turns[-1][1])
        if turn is not None:
            if turn != self.high:
                self.distinct += 1
            self.low = turn if self.low is None else self.low
            self.high = turn

    def record(self, part: int, closed: bool) -> dict:
        if closed:
            paths = block_paths(self.rows, EMPTY)
            chosen = min(p for p in (paths[s] for s in WHOLE) if p is not None)
            paths = [{"cost": chosen[0], "audit": chosen[1]}]
        else:
            paths = [
                None if p is None else {"cost": p[0], "audit": p[1]}
                for start in range(4) for p in block_paths(self.rows, start)
            ]
        return {
            "conv_id": self.conv, "part": part, "block": self.number, "closed": closed, **self.counts,
            "first": self.rows[0][0] if self.rows else None, "last": self.rows[-1][0] if self.rows else None,
            "low": self.low, "high": self.high, "distinct": self.distinct, "paths": paths,
            "turns": [{"role": r, "text": t} for r, t in self.turns],
        }


_LINE = pa.struct([("role", pa.string()), ("text", pa.string())])
_PATH = pa.struct([("cost", pa.int64()), ("audit", pa.string())])
_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_BLOCK = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("block", pa.int64()), ("closed", pa.bool_())]
    + [(c, pa.int64()) for c in _COUNTS]
    + [("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()),
       ("distinct", pa.int64()), ("paths", pa.list_(_PATH)), ("turns", pa.list_(_LINE))]
)
BLOCK_DDL = (
    "conv_id long, part long, block long, closed boolean, blank long, duplicate long, truncated long, "
    "illegal long, first string, last string, low long, high long, distinct long, "
    "paths array<struct<cost: long, audit: string>>, turns array<struct<role: string, text: string>>"
)
#: Records handed on at once; a block's record may hold some megabytes of text.
_AT_ONCE = 64


def _sent(records, schema):
    waiting, chars = [], 0
    for record in records:
        waiting.append(record)
        chars += sum(len(t["text"]) for t in record.get("turns") or record.get("lines") or ())
        if len(waiting) >= _AT_ONCE or chars >= BLOCK_CHARS:
            yield pa.RecordBatch.from_pylist(waiting, schema)
            waiting, chars = [], 0
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema)


def _described(batches):
    """Blocks of a sorted partition, numbered through. A conversation at its edge may go on in another one."""
    part = TaskContext.get().partitionId()

    def records():
        block, edge = None, True
        for batch in batches:
            for conv, turn, role, text, present, times, first in zip(
                *(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "times", "is_first")),
                strict=True,
            ):
                if block is None or block.conv != conv:
                    if block is not None:
                        yield block.record(part, closed=not edge and not block.continued)
                        edge = False
                    block = _Block(conv, 0 if block is None else block.number + 1)
                if not present:
                    continue
                for copy in range(times):
                    if block.full():
                        yield block.record(part, closed=False)
                        block = _Block(conv, block.number + 1, continued=True)
                    block.add(turn, role, text, copy > 0 or not first)
        if block is not None:
            yield block.record(part, closed=False)

    yield from _sent(records(), _BLOCK)


def ordered_rows(rows: DataFrame, present: Column) -> DataFrame:
    """Distinct rows with their number, marked where role and text stand first, sorted over partitions.

    Equal rows are counted in the map tasks, so no number of copies meets in one task. The
    range keys hold the beginning of a text only, which goes along with the order of whole texts.
    """
    keys = ["conv_id", "turn", "role", "text", "present"]
    plain = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        *[F.when(present, F.coalesce(F.col(c).cast("string"), F.lit(" "))).otherwise("").alias(c) for c in ("role", "text")],
        present.alias("present"),
    )
    counted = stored(plain.groupBy(*keys).agg(F.count(F.lit(1)).alias("times")), "repair-rows")
    same = [F.col("conv_id"), F.col("role"), F.sha2("text", 256)]
    # Null turns come first.
    place = F.struct(F.col("turn").isNotNull().alias("dated"), F.coalesce("turn", F.lit(0)).alias("turn"))
    repeated = (
        counted.where("present").groupBy(*[c.alias(n) for c, n in zip(same, ("_conv", "_role", "_text"), strict=True)])
        .agg(F.min(place).alias("_place"), F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
    )
    repeated = stored(repeated.drop("_n"), "repair-repeated")
    joined = counted.join(
        repeated, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (same[2] == F.col("_text")), "left"
    )
    marked = joined.select(*keys, "times", F.coalesce(F.col("_place") == place, F.lit(True)).alias("is_first"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = marked.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("text", 1, 64))
    return ranged.sortWithinPartitions("conv_id", "turn", "role", "text")


def _chained(batches):
    """Blocks of a conversation in order to its audit, and each block's own part of it."""

    def finished(conv, blocks):
        edits = Edits()
        front = Front(edits)
        front.best[EMPTY] = 0, 0
        totals = dict.fromkeys(_COUNTS, 0)
        low = high = last = None
        distinct = 0
        arrival: dict[int, int] = {}
        names = []
        for block in blocks:
            for start, held in enumerate(front.best):
                for end in range(4):
                    path = block["paths"][4 * start + end]
                    if held is not None and path is not None:
                        front.offer(end, held[0] + path["cost"], held[1], path["audit"])
            before = front.best
            offers = front.offers
            front.settle()
            for end, offer in enumerate(offers):
                if offer is not None:
                    start = next(s for s, held in enumerate(before) if held is not None and held[1] == offer[1])
                    arrival[front.best[end][1]] = start
            names.append((block["part"], block["block"]))
            for c in _COUNTS:
                totals[c] += block[c]
            if block["first"] is not None:
                if last is not None and last + block["first"] not in LEGAL:
                    totals["illegal"] += 1
                last = block["last"]
            if block["low"] is not None:
                distinct += block["distinct"] - (high == block["low"])
                low, high = block["low"] if low is None else low, block["high"]
        cost, node = best_of(edits, front.best)
        audit = edits.text(node)
        for part, number in reversed(names):
            yield {"conv_id": conv, "part": part, "block": number, "start": arrival[node], "audit": edits.label[node]}
            node = edits.parent(node)
        gaps = 0 if low is None else high - low + 1 - distinct
        yield {"conv_id": conv, "part": None, "gaps": gaps, **totals, "cost": cost, "audit": audit}

    def records():
        conv, blocks = None, []
        for batch in batches:
            for block in batch.to_pylist():
                if blocks and block["conv_id"] != conv:
                    yield from finished(conv, blocks)
                    blocks = []
                conv = block["conv_id"]
                blocks.append(block)
        if blocks:
            yield from finished(conv, blocks)

    yield from _sent(records(), _CHAIN)


_CHAIN = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("block", pa.int64()), ("start", pa.int32()), ("gaps", pa.int64())]
    + [(c, pa.int64()) for c in _COUNTS] + [("cost", pa.int64()), ("audit", pa.string())]
)
CHAIN_DDL = (
    "conv_id long, part long, block long, start int, gaps long, blank long, duplicate long, truncated long, "
    "illegal long, cost long, audit string"
)


def _left(batches):
    """The turns that each block's audit leaves."""

    def records():
        for batch in batches:
            for block in batch.to_pylist():
                turns = [(t["role"], t["text"]) for t in block["turns"]]
                lines = repaired_lines(turns, block["audit"], block["start"])
                yield {
                    **{c: block[c] for c in ("conv_id", "part", "block", "closed")},
                    "lines": [{"role": r, "text": t} for r, t in lines],
                }

    yield from _sent(records(), _LINES)


_LINES = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int64()), ("block", pa.int64()), ("closed", pa.bool_()), ("lines", pa.list_(_LINE))]
)
LINES_DDL = "conv_id long, part long, block long, closed boolean, lines array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Repair:
    """``audits``: one row per conversation. ``lines``: the repaired turns of its blocks, by ``part`` and ``block``."""

    audits: DataFrame
    lines: DataFrame


def repair_conversations(rows: DataFrame, present: Column | None = None) -> Repair:
    """Audit and repair conversations of ``conv_id, turn, role, text``; other columns play no part.

    Turns go by ``turn``, null first, then by role and text. A null role or text counts as one
    space, null ids are one conversation. A row that is blank, or whose role and text stood
    earlier in the conversation, must be deleted. Repeated rows, empty and very long texts are
    rows like others. A row for which ``present`` is false only names its conversation;
    a conversation without other rows has zeros and an empty audit. Of an empty table nothing is left.
    """
    small_batches(rows.sparkSession)
    ordered = ordered_rows(rows, F.lit(True) if present is None else F.coalesce(present, F.lit(False)))
    blocks = stored(ordered.mapInArrow(_described, BLOCK_DDL), "repair-blocks")
    # One block of every open conversation at least: few rows, without texts.
    opened = blocks.where(~F.col("closed")).drop("turns")
    chained = opened.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    chains = stored(chained.mapInArrow(_chained, CHAIN_DDL), "repair-chains")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct"), F.lit(0))
    path = F.col("paths")[0]
    closed = blocks.where("closed").select(
        "conv_id", gaps.alias("gaps"), *_COUNTS, path["cost"].alias("cost"), path["audit"].alias("audit")
    )
    audits = closed.unionByName(
        chains.where(F.col("part").isNull()).select("conv_id", "gaps", *_COUNTS, "cost", "audit")
    )
    choices = chains.where(F.col("part").isNotNull()).select("part", "block", "start", F.col("audit").alias("own"))
    wanted = ["conv_id", "part", "block", "closed", "turns", "audit", "start"]
    whole = blocks.where("closed").select(
        "conv_id", "part", "block", "closed", "turns", path["audit"].alias("audit"), F.lit(EMPTY).alias("start")
    )
    pieces = (
        blocks.where(~F.col("closed")).select("conv_id", "part", "block", "closed", "turns")
        .join(choices, ["part", "block"]).withColumnRenamed("own", "audit").select(*wanted)
    )
    return Repair(audits, whole.unionByName(pieces).mapInArrow(_left, LINES_DDL))


def _joined(lines: Column) -> Column:
    return F.array_join(F.transform(lines, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _streamed(batches):
    """Digest of the pieces of each conversation, read one after the other."""

    def records():
        conv, running, begun, any_row = None, None, False, False
        for batch in batches:
            for here, piece in zip(batch.column("conv_id").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                if not any_row or here != conv:
                    if any_row:
                        yield {"conv_id": conv, "digest": running.hexdigest()}
                    conv, running, begun, any_row = here, hashlib.sha256(), False, True
                if piece:
                    running.update((("\n" if begun else "") + piece).encode())
                    begun = True
        if any_row:
            yield {"conv_id": conv, "digest": running.hexdigest()}

    schema = pa.schema([("conv_id", pa.int64()), ("digest", pa.string())])
    for record in records():
        yield pa.RecordBatch.from_pylist([record], schema)


def repaired_digests(lines: DataFrame) -> DataFrame:
    """``conv_id, digest``: SHA-256 of the repaired turns as ``role:text``, joined by newlines.

    A hash is read in order, so the pieces of a conversation in several blocks pass through one
    task, one piece at a time; all other conversations are hashed where they are.
    """
    pieces = lines.select("conv_id", "part", "block", "closed", _joined(F.col("lines")).alias("piece"))
    alone = pieces.where("closed").select("conv_id", F.sha2("piece", 256).alias("digest"))
    several = pieces.where(~F.col("closed")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return alone.unionByName(several.select("conv_id", "piece").mapInArrow(_streamed, "conv_id long, digest string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` damaged by the remainder of ``crc32(conv_id:turn)`` by 20.

    0 drops the row (``present`` is false), 1 empties its text, 2 removes its sentence endings, 3
    repeats it, 4 gives it to the user. Nulls, in the key as well, count as one space.
    """
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    fault = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ENDINGS, "")).otherwise(text).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
