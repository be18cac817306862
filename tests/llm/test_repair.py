"""Conversation repair against enumeration and a plain dynamic program on whole strings."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from snapstrata.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
WHITE = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLE = {"u": "user", "a": "assistant"}


def faults(rows):
    """Kind of each row: blank, duplicate, truncated or None."""
    seen, kinds = set(), []
    for _, role, text in rows:
        ending = text.rstrip(WHITE)
        if not ending:
            kinds.append("blank")
        elif (role, text) in seen:
            kinds.append("duplicate")
        elif ending[-1] not in ".!?":
            kinds.append("truncated")
        else:
            kinds.append(None)
        seen.add((role, text))
    return kinds


def plain(rows):
    """Cost, audit and lines by a program over whole audits, of which it keeps the least."""
    best = {0: (0, "", [])}

    def offer(to, state, cost, audit, lines):
        if state not in to or (cost, audit) < to[state][:2]:
            to[state] = (cost, audit, lines)

    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                for letter in "ua":
                    if (state, letter) in NEXT:
                        offer(best, NEXT[state, letter], cost + 5, audit + "I", lines + [f"{ROLE[letter]}:"])
        return best

    best = inserted(best)
    for (_, role, text), kind in zip(rows, faults(rows), strict=True):
        after = {}
        more = 5 if kind == "truncated" else 0
        for state, (cost, audit, lines) in best.items():
            offer(after, state, cost + 2, audit + "D", lines)
            if kind in ("blank", "duplicate"):
                continue
            if (state, role[:1]) in NEXT:
                offer(after, NEXT[state, role[:1]], cost + more, audit + "K", lines + [f"{role}:{text}"])
            for letter in "ua":
                if (state, letter) in NEXT:
                    line = f"{ROLE[letter]}:{text}"
                    offer(after, NEXT[state, letter], cost + more + 1, audit + "R", lines + [line])
        best = inserted(after)
    return min(best[s] for s in (0, 3) if s in best)


def enumerated(rows):
    """The same by trying all edits, with up to two insertions at each place."""
    gaps = ["", "u", "a", "ua", "au"]
    kinds = faults(rows)
    options = []
    for (_, role, _), kind in zip(rows, kinds, strict=True):
        more = 5 if kind == "truncated" else 0
        free = kind not in ("blank", "duplicate")
        options.append([("D", "", 2)] + free * [("K", role[:1] or "?", more), ("R", "u", more + 1), ("R", "a", more + 1)])
    found = None
    for edits in itertools.product(*options):
        for added in itertools.product(gaps, repeat=len(rows) + 1):
            roles, audit, cost = added[0], "I" * len(added[0]), 5 * sum(map(len, added))
            for (letter, role, price), gap in zip(edits, added[1:], strict=True):
                roles, audit, cost = roles + role + gap, audit + letter + "I" * len(gap), cost + price
            body = roles.removeprefix("s")
            if roles and (not body or body != "ua" * (len(body) // 2)):
                continue
            if found is None or (cost, audit) < found:
                found = (cost, audit)
    return found


def expected(rows):
    kinds, turns = faults(rows), [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    cost, audit, lines = plain(rows)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in {"su", "ua", "au"} for a, b in itertools.pairwise(initials)),
        "cost": cost, "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def in_order(rows):
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def made(rng, n, roles=("user", "assistant", "system", "tool", "", None)):
    texts = ["Yes.", "No!", "cut off", "", " \t", "Ends. \n", None, "é?", "Yes."]
    weights = (6, 6, 2, 1, 1, 1)[: len(roles)]
    return [(rng.choice([None, *range(n)]), rng.choices(roles, weights)[0], rng.choice(texts)) for _ in range(n)]


def check(spark, conversations, parts=None):
    rows = [(c, *r, "clash") for c, of in conversations.items() for r in of]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts or 3)
    repaired = repair.repair_conversations(frame)
    digests = {r.conv_id: r.digest for r in repair.repaired_digests(repaired.lines).collect()}
    audits = repaired.audits.collect()
    assert len(audits) == len(conversations) == len(digests)
    for row in audits:
        got = row.asDict() | {"repaired_sha256": digests[row.conv_id]}
        assert got == {"conv_id": row.conv_id, **expected(in_order(conversations[row.conv_id]))}, row.conv_id


def test_plain_version_equals_enumeration():
    rng = random.Random(4)
    for _ in range(60):
        rows = in_order(made(rng, rng.randint(0, 3)))
        assert plain(rows)[:2] == enumerated(rows)


def test_block_paths_equal_the_plain_version():
    rng = random.Random(5)
    kinds = {"blank": repair.FORCED, "duplicate": repair.FORCED, "truncated": repair.TRUNCATED, None: repair.SOUND}
    for _ in range(300):
        rows = in_order(made(rng, rng.randint(0, 14)))
        items = [(r[:1], kinds[k]) for (_, r, _), k in zip(rows, faults(rows), strict=True)]
        paths = repair.block_paths(items, repair.EMPTY)
        assert min(paths[s] for s in repair.WHOLE if paths[s] is not None) == plain(rows)[:2]


def test_conversations_in_one_block_and_over_many(spark, monkeypatch):
    rng = random.Random(6)
    conversations = {i: made(rng, rng.randint(1, 12)) for i in range(60)}
    conversations[None] = made(rng, 6)
    conversations[1000] = made(rng, 150, ("user", "assistant"))
    conversations[1001] = [(None, "user", "Same.")] * 40 + [(t, "user", "Same.") for t in range(40)]
    check(spark, conversations)
    monkeypatch.setattr(repair, "BLOCK_ROWS", 3)
    check(spark, conversations)


def test_colliding_hashes_change_nothing(spark, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(repair, "_MODULUS", 3)
    for _ in range(100):
        rows = in_order(made(rng, rng.randint(0, 14), ("user", "assistant", "system")))
        kinds = {"blank": 0, "duplicate": 0, "truncated": 1, None: 2}
        items = [(r[:1], kinds[k]) for (_, r, _), k in zip(rows, faults(rows), strict=True)]
        paths = repair.block_paths(items, repair.EMPTY)
        assert min(paths[s] for s in repair.WHOLE if paths[s] is not None) == plain(rows)[:2]


def test_long_ties_are_settled_along_ancestors():
    edits = repair.Edits()
    a = b = 0
    for i in range(3000):
        letter = "KRD"[i % 3]
        a, b = edits.add(a, letter), edits.add(b, letter)
    assert not edits.less(a, b) and not edits.less(b, a)
    x, y = edits.add(a, "D"), edits.add(b, "K")
    for _ in range(70):
        x, y = edits.add(x, "R"), edits.add(y, "D")
    assert edits.less(x, y) and not edits.less(y, x)


def test_long_texts_and_no_rows(spark):
    long = "word " * 400_000
    check(spark, {1: [(0, "user", long + "."), (1, "assistant", long), (2, "assistant", long + ".")]})
    assert repair.repair_conversations(spark.createDataFrame([], SCHEMA)).audits.count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_the_plain_version(spark, sf):
    path = f"/root/testdata/{sf}"
    conversations = {}
    for r in spark.read.parquet(f"{path}/conversations.parquet").collect():
        rows = conversations.setdefault(r.conv_id, [])
        fault = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = {1: "", 2: "".join(c for c in r.text if c not in ".!?")}.get(fault, r.text)
        role = "user" if fault == 4 else r.role
        rows += [(r.turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    got = {r.conv_id: r.asDict() for r in queries.QUERIES["op12_structure_repair"](spark, path).collect()}
    assert got == {c: {"conv_id": c, **expected(in_order(rows))} for c, rows in conversations.items()}


def test_damage_takes_nulls_as_spaces(spark):
    rows = spark.createDataFrame([(None, t, None, None, "") for t in range(60)] + [(1, None, "user", "Hi.", "")], SCHEMA)
    got = {}
    for r in repair.damaged(rows).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.present))
    for t in range(60):
        fault = zlib.crc32(f" :{t}".encode()) % 20
        role = "user" if fault == 4 else " "
        assert got[None, t] == [(role, "" if fault == 1 else " ", fault != 0)] * (2 if fault == 3 else 1)
    assert F.col("x") is not None and len(got[1, None]) == (2 if zlib.crc32(b"1: ") % 20 == 3 else 1)
