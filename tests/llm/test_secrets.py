"""Windows of candidates and places of matches against plain versions, long ones included."""

import hashlib
import math
import random
import re
import time
from collections import Counter

from pyspark.sql import functions as F

from snapstrata.llm import queries, secrets

LETTERS = secrets.ALPHABET


def spread(s):
    return sum(round(secrets.SCALE * c * math.log2(c)) for c in Counter(s).values())


def plain_least(text, window):
    return min((spread(text[i : i + window]) for i in range(len(text) - window + 1)), default=None)


def test_least_spread_equals_a_plain_count(spark):
    rng = random.Random(3)
    texts = ["", "a", "a" * 20, "ab" * 30] + ["".join(rng.choices(LETTERS[: rng.randint(1, 67)], k=rng.randint(1, 300))) for _ in range(80)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for window in (2, 8, 20, 31):
        got = rows.select("t", secrets.least_spread(F.col("t"), window).alias("least")).collect()
        assert [r.least for r in got] == [plain_least(r.t, window) for r in got]


def test_a_very_long_candidate(spark):
    rng = random.Random(4)
    text = "".join(rng.choices("gz1", k=900_000)) + "x9K2mQ7vRt4LpZ8wB3nYc5" + "".join(rng.choices("gz1", k=100_000))
    rows = spark.createDataFrame([(text,), ("".join(rng.choices("gz1", k=1_000_000)),)], "text string").coalesce(1)
    started = time.perf_counter()
    found = [r.secret_spans for r in secrets.scan_secrets(rows).collect()]
    seconds = time.perf_counter() - started
    assert [[(s.start, s.end, s.kind) for s in f] for f in found] == [[(0, len(text), "entropy_base64")], []]
    assert seconds < 90, seconds


def test_places_of_very_many_matches(spark):
    rng = random.Random(5)
    parts = [rng.choice(["é word ", "token: abcdef ", "AKIA" + "Q7" * 9 + " ", "0af" * 9 + " ", "x" * 7 + "\n"]) for _ in range(6000)]
    text = "".join(parts)
    got = secrets.scan_secrets(spark.createDataFrame([(text,)], "text string")).first().secret_spans
    want = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= 6]
    want += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text)]
    want += [(m.start(), 2, m.end()) for m in re.finditer(secrets.HEX, text)]
    assert [(s.start, s.rank, s.end) for s in got if s.rank < 3] == sorted(want) and len(want) > 3000


def test_query_equals_a_plain_scan(spark):
    """Counts, digest and all spans of every document of the smallest table."""
    path = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op2_secrets"](spark, path).collect()}
    assert got.keys() == texts.keys()
    for doc, text in texts.items():
        base = [(m.start(), 0, m.end(), "assign") for m in re.finditer(secrets.ASSIGN, text) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end(), "access") for m in re.finditer(secrets.ACCESS, text)]
        base += [(m.start(), 2, m.end(), "hex") for m in re.finditer(secrets.HEX, text)]
        more = []
        for rank, rule in enumerate(secrets.RULES, start=3):
            for m in re.finditer(rule.run, text):
                allowed = any(re.search(p, m[0]) for p in secrets.ALLOWED)
                if not allowed and plain_least(m[0], rule.window) <= rule.most:
                    more.append((m.start(), rank, m.end(), rule.kind))

        def listed(spans):
            return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans))

        r = got[doc]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == k for s in base) for k in secrets.KINDS]
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest() and r.spans == listed(base + more)
