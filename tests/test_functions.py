import base64
import json

import pytest
from pyspark.sql import functions as F

from snapstrata.functions import html as H
from snapstrata.functions import messages as M
from snapstrata.functions import numbers as N
from snapstrata.functions import paths as P
from snapstrata.functions import text as X
from workload.text import fragments

BASE = "https://stats.example.org"


def test_percent_to_fraction(one):
    values = ["89%", "67%", " 5% ", "12", "", " ", "%", "n/a", None]
    assert one(N.percent_to_fraction, values) == [0.89, 0.67, 0.05, 0.12, *[None] * 5]


def test_ratio_parts(one):
    values = ["2/3", "0/4", "0/0", "2", "x/y", "", None, " 1 / 2 "]
    assert one(lambda t: N.ratio_part(t, 0), values) == [2, 0, 0, 2, None, None, None, 1]
    assert one(lambda t: N.ratio_part(t, 1), values) == [3, 4, 0, None, None, None, None, 2]


def test_ratio_is_half_up_and_null_safe(spark):
    rows = spark.sql("SELECT * FROM VALUES (201, 200), (1, 3), (5, 0), (null, 2), (1, 8) t(a, b)")
    found = [r[0] for r in rows.select(N.ratio(F.col("a"), F.col("b"))).collect()]
    assert found == [1.01, 0.33, None, None, 0.13]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [(0.1,), (0.2,), (0.3,)] * 100
    rows = spark.createDataFrame(values, "v double")
    sums = {str(rows.repartition(n).agg(N.exact_sum(F.col("v"))).first()[0]) for n in (1, 3, 7)}
    assert sums == {"60.0000"}


def test_weighted_mean_needs_both(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (1.0D, 10), (2.0D, 30), (null, 5), (9.0D, null) t(v, w)"
    )
    assert rows.agg(N.weighted_mean(F.col("v"), F.col("w"))).first()[0] == 1.75
    odd = spark.sql("SELECT * FROM VALUES (1D, 10), (double('NaN'), 10), (1e17D, 10) AS t(v, w)")
    assert odd.agg(N.weighted_mean(F.col("v"), F.col("w"))).first()[0] == 1.0
    assert rows.where("w = 5").agg(N.weighted_mean(F.col("v"), F.col("w"))).first()[0] is None


def test_whitespace_tokens(one):
    values = ["\tA b\n c ", "x", "", "  ", None, "a b"]
    assert one(X.whitespace_tokens, values) == [["A", "b", "c"], ["x"], [], [], [], ["a", "b"]]
    assert one(lambda t: X.token_or_default(X.whitespace_tokens(t), 1), ["a b", "a"]) == ["b", "N/A"]


def test_small_text(one):
    assert one(X.asset_stem, ["/img/x/jett.a.png", "jett.png", "jett", "", None]) == [
        "jett", "jett", "jett", "", None,
    ]
    assert one(X.id_from_href, ["/player/9/nick", "/player", None]) == ["9", None, None]
    assert one(X.safe_text, [" a\n", " b", None]) == ["a", "b", ""]
    assert one(X.timespan, ["all", "ALL", "30"]) == ["all", "all", "30d"]
    assert one(X.region_from_flag, ["flag mod-us", " flag mod-kr ", "", None]) == [
        "us", "kr", "", "",
    ]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("TBD", "TBD"), ("tbd Prize Pool", "TBD"), ("$250,000 Prize Pool", "$250,000"),
        ("250,000", "$250,000"), ("12", ""), ("123", "$123"), ("$1 000 PRIZE POOL", ""),
        (" $5,000\n prize pool in all", "$5,000"), ("Prize Pool: $5", ""), ("", ""), (None, ""),
    ],
)
def test_prize_value(one, text, expected):
    assert one(X.prize_value, [text]) == [expected]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Jul 15—Aug 31", "Jul 15—Aug 31"), ("on Jul 15 - never", "on Jul 15 - never"),
        ("Jul 15-31", "Jul 15-31"), ("Sep 15—TBD", "TBD"), ("tbd", "TBD"), ("TBDX", ""),
        ("Dates\n Oct 3 \nNov 4", "Oct 3"), ("Prize Oct 3\nfrom — to", "from — to"),
        ("nothing", ""), ("", ""), (None, ""),
    ],
)
def test_date_range_text(one, text, expected):
    assert one(X.date_range_text, [text]) == [expected]


def test_urls(one):
    values = ["//host/x.png", "/x.png", "https://host/x.png", "", None]
    assert one(lambda t: X.normalize_image_url(t, BASE), values) == [
        "https://host/x.png", f"{BASE}/x.png", "https://host/x.png", "", "",
    ]
    assert one(lambda t: X.absolute_url(t, BASE), ["/a", "b", "", None]) == [f"{BASE}/a", "b", "", ""]


def test_paths(spark, one):
    path = "bronze/event_id=1/region=eu/map=haven/agent=jett/snapshot_date=2024-01-01/data.csv"
    row = spark.sql(
        "SELECT 1 AS e, 'eu' AS r, 'haven' AS m, 'jett' AS a, DATE '2024-01-01' AS d"
    )
    built = row.select(P.partition_path(*[F.col(c) for c in "ermad"])).first()[0]
    assert built == path
    assert row.select(
        P.partition_path(F.col("e"), F.lit(None).cast("string"), F.col("m"), F.col("a"), F.col("d"))
    ).first()[0] is None
    others = ["snapshot_date=2024-01-02/x", "a/my_snapshot_date=3/x", "a/b.csv", "snapshot_date=/x"]
    assert one(P.path_snapshot, [path, *others]) == ["2024-01-01", "2024-01-02", "", "", ""]
    assert one(P.path_prefix, [path]) == ["bronze/event_id=1/region=eu/map=haven/agent=jett"]
    assert one(P.below_root, [f"file:///lake/{path}"]) == [path.removeprefix("bronze/")]


def b64(value) -> str:
    raw = value if isinstance(value, bytes) else json.dumps(value).encode()
    return base64.b64encode(raw).decode()


def test_decode_message(one):
    body = {"row_id": 3, "blob_path": "p", "success": True}
    values = [
        b64(body), "!!!", b64(b"not json"), b64([1, 2]), b64(5), b64({}), b64(b"\xff\xfe{}"), None,
        b64({"row_id": "x", "success": False}),
    ]
    found = one(M.decode_message, values)
    assert found[0].asDict() == {**body, "error": None}
    assert found[1:5] == [None] * 4
    assert found[5].row_id is None and found[5].success is None
    assert found[6] is None and found[7] is None
    assert found[8].row_id is None and found[8].success is False


def test_decode_message_by_rule(one):
    rows = [("12", 1), (12.0, "false"), (1.5, 0), (7, ""), (3_000_000_000, [])]
    values = [b64({"row_id": r, "success": s}) for r, s in rows]
    found = one(M.decode_message, [*values, b64(b'{"row_id": 1, "success": true} more'), b64(b'{"row_id": 1}] {')])
    assert [(b.row_id, b.success) for b in found[:5]] == [
        (12, True), (12, True), (None, False), (7, False), (3_000_000_000, False),
    ]
    assert found[5:] == [None, None]


def test_encode_is_undone_by_decode(spark):
    rows = spark.sql("SELECT 12L AS r, repeat('long/path/', 20) AS p, true AS s")
    data = M.encode_completion(F.col("r"), F.col("p"), F.col("s"))
    found = rows.select(data.alias("d"), M.decode_message(data).alias("b")).first()
    assert "\n" not in found.d
    assert (found.b.row_id, found.b.blob_path, found.b.success) == (12, "long/path/" * 20, True)


def test_attribute_and_entities(one):
    values = ["<a data-href='no' href=\"/p/1?a=1&amp;b=2\">", "<a HREF='/q'>", "<a>"]
    assert one(lambda t: H.attribute(t, "href"), values) == ["/p/1?a=1&b=2", "/q", ""]
    assert one(H.cell_text, ["<b>1 &lt; 2</b>", "&amp;lt;", "x"]) == ["1 < 2", "&lt;", "x"]


def test_fragments_lie_in_as_many_tasks_as_the_session_shuffles_to(spark, tmp_path):
    orders = spark.createDataFrame([(11, 5, "1-URGENT"), (5, 7, "2-HIGH")], "o_orderkey long, o_custkey long, o_orderpriority string")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, "x")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = fragments(spark, str(tmp_path))
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.id for r in found.collect()) == ["d1", "o11", "o5"]
