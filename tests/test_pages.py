import pytest
from pyspark.sql import functions as F

from snapstrata.functions.html import decode_entities, link_targets
from snapstrata.operators import pages as P
from snapstrata.schemas import BRONZE_FIELDS
from workload.stats_pages import stats_pages

COLOURS = [f"{i}.5" for i in range(11)]


def cells(colours=COLOURS, name="Ace", org="TEAM", picture=True, rounds="20", clutch="2/3",
          kmax="22", last=(1, 2, 3, 4, 5), href="/player/9/ace", quote='"', close="</td>"):
    q = quote
    link = f"<a href={q}{href}{q}>\n\t<div>{name}</div>\n<div>{org}</div></a>" if href else name
    parts = [f"<td class={q}mod-player mod-a{q}>{link}{close}"]
    image = f"<img src={q}/img/agents/jett.min.png{q}>" if picture else ""
    parts.append(f"<td class={q}mod-agents{q}><div>{image}</div>{close}")
    if rounds is not None:
        parts.append(f"<td class={q}mod-rnd{q}>{rounds}{close}")
    parts += [f"<td class={q}mod-color-sq mod-{i}{q}><span>{c}</span>{close}"
              for i, c in enumerate(colours)]
    if clutch is not None:
        parts.append(f"<td class={q}mod-cl{q}> {clutch}\n{close}")
    if kmax is not None:
        parts.append(f"<td class={q}mod-kmax{q}><a href={q}/m/1{q}> {kmax} </a>{close}")
    parts += [f"<td> {v} {close}" for v in last]
    return "".join(parts)


def page(*rows, body=True):
    inside = "".join(f"<tr>{r}</tr>" for r in rows)
    if body:
        inside = f"<tbody>{inside}</tbody>"
    return f"<html><table class='x'><thead><tr><td>Player</td></tr></thead>{inside}</table></html>"


@pytest.fixture
def parse(spark):
    def run(*pages):
        rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
        return P.stats_page_rows(rows).orderBy("page_id", "row_no").collect()

    return run


def test_whole_row(parse):
    found = parse(page(cells()))[0].asDict()
    assert list(found) == ["page_id", "row_no", *BRONZE_FIELDS]
    assert found["player_id"] == "9" and found["player"] == "Ace" and found["org"] == "TEAM"
    assert found["agents"] == "jett" and found["rounds_played"] == "20"
    assert [found[c] for c in P.COLOUR_CELLS] == COLOURS
    assert [found[c] for c in P.LAST_CELLS] == list("12345")
    assert found["clutches_won_played_ratio"] == "2/3"
    assert found["max_kills_in_single_map"] == "22"


def test_bad_rows_are_skipped(parse):
    bad = [
        "<td> &nbsp; </td>", "", cells(clutch=None), cells(rounds=None), cells(kmax=None),
        cells(colours=COLOURS[:10]), cells(href=None), cells(href="/player"),
    ]
    rows = parse(page(*bad, cells(name="Last")))
    assert [(r.row_no, r.player) for r in rows] == [(8, "Last")]


def test_missing_parts_get_a_default(parse):
    rows = parse(page(cells(org=""), cells(picture=False), cells(name="A &amp; B", org="")))
    assert [(r.player, r.org, r.agents) for r in rows] == [
        ("Ace", "N/A", "jett"), ("Ace", "TEAM", "N/A"), ("A", "&", "jett"),
    ]


def test_irregular_markup(parse):
    plain = parse(page(cells()))[0]
    single = parse(page(cells(quote="'")))[0]
    no_body = parse(page(cells(), body=False))[0]
    upper = parse(page(cells()).replace("<td", "<TD").replace("</td>", "</TD >")
                  .replace("<tr>", "<TR\n>").replace("</tr>", ""))[0]
    open_cells = parse(page(cells(close="")))[0]
    assert plain == single == no_body == upper == open_cells


def test_several_tables_and_hidden_parts(parse):
    html = (page(cells(name="One")) + "<!--" + page(cells(name="Gone")) + "-->"
            + "<script>var x = '<table><tr><td>'</script>" + page(cells(name="Two")) + "<p>end</p>")
    assert [r.player for r in parse(html)] == ["One", "Two"]
    assert parse("<p>no table</p>", "", None, "<tr><td>x</td></tr>") == []


def test_links(spark):
    pages = spark.createDataFrame(
        [(1, '<a href="/player/3/x">a</a><a href="b">b</a><a href="">c</a>'), (2, "none")],
        "page_id int, html string",
    )
    found = P.page_links(pages, "https://h").orderBy("link_no").collect()
    assert [(r.href, r.url, r.link_id) for r in found] == [
        ("/player/3/x", "https://h/player/3/x", "3"), ("b", "b", None), ("", "", None),
    ]


def test_extract_fields_is_one_projection(spark):
    rows = spark.createDataFrame([(1, "$5,000 Prize Pool"), (2, None)], "id int, text string")
    found = P.extract_fields(rows, "https://h").orderBy("id").collect()
    assert (found[0].prize, found[0].name, found[0].dates) == ("$5,000", "$5,000", "")
    assert (found[1].prize, found[1].org, found[1].url) == ("", "N/A", "")


def test_no_python_in_the_plan(spark, capsys):
    pages = spark.createDataFrame([(1, page(cells()))], "page_id int, html string")
    P.stats_page_rows(pages.withColumn("html", F.upper("html"))).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and plan.count("Generate") == 1


def test_links_follow_the_attribute_rule(spark):
    html = (
        "<a href='/a'><A HREF=\"/b\"><a data-href=\"/c\" href=\"/d?x=1&amp;y=2\"><a title=\" href='/no'\">"
        "<!-- <a href='/old'> --><script>'<a href=\"/js\">'</script><a href = /e class=x><a href=\"\">"
    )
    rows = spark.createDataFrame([(html,), (None,), ("",), ("no tags",)], "html string")
    got = [r[0] for r in rows.select(link_targets(F.col("html"))).collect()]
    assert got == [["/a", "/b", "/d?x=1&y=2", "/e", ""], None, [], []]


def test_character_references(spark):
    pairs = [
        ("Jos&#233; &#x27;x&#x27; &eacute;", "José 'x' é"), ("a&nbsp;b", "a\u00a0b"), ("&amp;lt; &#38;lt;", "&lt; &lt;"),
        ("&unknown; & &#0; &#xD800; &#x1F600;", "&unknown; & \ufffd \ufffd \U0001f600"), ("&", "&"), ("", ""), (None, None),
    ]
    rows = spark.createDataFrame(pairs, "text string, want string")
    for r in rows.select("want", decode_entities(F.col("text")).alias("got")).collect():
        assert r.got == r.want


def test_quoted_brackets_do_not_end_a_tag(parse, spark):
    plain = parse(page(cells()))[0]
    odd = page(cells()).replace('<td class="mod-rnd"', '<td title="20 > 19" data-x=\'</td><tr>\' class="mod-rnd"')
    odd = odd.replace("<a href", "<a title=\'a<b>c\' href").replace("<div>", '<div data-t="</tr></table>">')
    odd = odd.replace("<table ", '<table summary="<!-- a > b --><script>" ')
    assert parse(odd)[0] == plain
    html = """<a title="x > y" href="/a?b=<c>&amp;d"><a href='/b>' class=it's><a href=/c title=don't><p>a = "b <a href='/d'>"""
    rows = spark.createDataFrame([(html,)], "html string")
    assert rows.select(link_targets(F.col("html"))).first()[0] == ["/a?b=<c>&d", "/b>", "/c", "/d"]


def test_nested_tables_keep_their_rows_apart(parse):
    inner = f"<table><tr>{cells(name='Inner')}</tr></table>"
    outer = (
        f"<table><tr>{cells(name='First')}<td>{inner}</td></tr><tr>{cells(name='Second')}</tr></table>"
        f"<table><tr>{cells(name='Third')}</tr>"
    )
    rows = parse(outer)
    # The inner table is no part of the first row's cells, and its row comes after those around it.
    assert [(r.row_no, r.player) for r in rows] == [(0, "First"), (1, "Second"), (2, "Inner"), (3, "Third")]
    assert [r.first_deaths for r in rows] == ["", "5", "5", "5"]
    assert parse("</table>" + page(cells()) + "</table></table>")[0].player == "Ace"


def test_pages_are_made_in_as_many_tasks_as_the_session_shuffles_to(spark, tmp_path):
    lines = [(1, 1, 1, 1), (1, 2, 1, 2), (2, 1, None, 3), (2, 1, None, 3)]
    rows = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long")
    rows.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    pages = stats_pages(spark, str(tmp_path))
    assert pages.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.l_suppkey for r in pages.collect()) == [1, 2, 3, 3]


def test_cell_ends_and_classes_in_any_spelling(spark):
    row = cells(close="</TD >").replace(' class="mod-rnd"', ' title="subclass = x" Class = "a mod-rnd"')
    found = P.stats_page_rows(spark.createDataFrame([(page(row),)], "html string")).collect()
    assert [(r.player, r.rounds_played, r.kills) for r in found] == [("Ace", "20", "1")]


def plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_a_row_is_searched_once_for_each_of_its_cells(spark):
    pages = spark.createDataFrame([(1, page(cells()))], "page_id int, html string").withColumn("html", F.upper("html"))
    found = plan(P.stats_page_rows(pages))
    # Once to see that the cell is there, once for what it holds.
    assert found.count(" mod-rnd ") == found.count(" mod-cl ") == found.count(" mod-kmax ") == 2


def test_cells_are_cut_for_the_whole_row_at_once(spark):
    pages = spark.createDataFrame([(1, page(cells()))], "page_id int, html string").withColumn("html", F.upper("html"))
    found = plan(P.page_table_rows(pages))
    assert "substring_index" not in found and found.count("regexp_extract_all") == 4


def test_cells_of_odd_rows(spark):
    html = (
        "<table><tr><td>a <<<< b<<<</a></TD ></td><td class='x\ty'>c</td foo>d</td><td title=\"1 > 0\" class = 'q\x1ep'>e"
        "<td <td class=\"z\"></td><td></tr\n>gone<TR>none</table><tr><td>outside</td></tr>"
    )
    pages = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<!-- <table><tr><td> -->")], "page_id int, html string")
    rows = P.page_table_rows(pages).orderBy("page_id", "row_no").collect()
    assert [(r.page_id, r.row_no, [tuple(c) for c in r.cells]) for r in rows] == [
        (1, 0, [("  ", "a <<<< b<<<</a>"), (" x y ", "c</td foo>d"), (" q\x1ep ", "e"), (" z ", ""), ("  ", "")]),
        (1, 1, []),
    ]
    html = "<table><!-- a --><tr><td>1<table>x<tr><td>2<!-- b --></td></table>3</td></tr></table><tr><<!-- c -->td>4"
    rows = P.page_table_rows(spark.createDataFrame([(html,)], "html string")).orderBy("row_no").collect()
    assert [[c.body for c in r.cells] for r in rows] == [["13"], ["2"]]
