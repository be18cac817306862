"""Text expressions over fragments of every known form and over whole documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snapstrata.functions import text as X
from snapstrata.functions.html import link_targets
from snapstrata.operators.pages import extract_fields, page_links
from workload.registry import query
from workload.views import FRAGMENTS, read_tables, run

BASE_URL = "https://stats.example.org"
WITH_FRAGMENTS = f"WITH fragments AS ({FRAGMENTS})"

# White space as the library understands it, for an engine whose \s is ASCII only.
BLANK = r"[\s\x{0B}\x{85}\p{Z}]"
STRIPPED = f"regexp_replace(text, '^{BLANK}+|{BLANK}+$', '', 'g')"
FLAT = f"regexp_replace(replace(text, chr(9), ''), '^{BLANK}+|{BLANK}+$', '', 'g')"
TOKENS = f"""CASE WHEN coalesce({FLAT}, '') = '' THEN CAST([] AS VARCHAR[])
  ELSE regexp_split_to_array({FLAT}, '{BLANK}+') END"""
LABEL_AT = "strpos(lower(text), 'prize pool')"
HEAD = f"CASE WHEN {LABEL_AT} > 0 THEN substr(text, 1, {LABEL_AT} - 1) ELSE text END"
AMOUNT = f"""regexp_replace(regexp_replace({HEAD}, '^{BLANK}+|{BLANK}+$', '', 'g'),
  '{BLANK}+', ' ', 'g')"""
PRIZE = f"""CASE WHEN upper({AMOUNT}) = 'TBD' THEN 'TBD'
  WHEN regexp_full_match({AMOUNT}, '\\$[\\d,]+') THEN {AMOUNT}
  WHEN regexp_full_match({AMOUNT}, '[\\d,]+') AND length({AMOUNT}) > 2 THEN '$' || {AMOUNT}
  ELSE '' END"""
RANGE = f"[A-Za-z]{{3}}{BLANK}+\\d+[—–-]+[A-Za-z]*{BLANK}*\\d+"
LINES = f"""list_transform(string_split({STRIPPED}, chr(10)),
  lambda x: regexp_replace(x, '^{BLANK}+|{BLANK}+$', '', 'g'))"""
DATED = f"""list_filter({LINES}, lambda x: x <> ''
  AND NOT regexp_matches(x, '(?i)dates|label|prize|pool')
  AND regexp_matches(x, 'Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec|—'))"""
DATES = f"""CASE WHEN regexp_matches(text, '{RANGE}') THEN regexp_extract(text, '{RANGE}', 0)
  WHEN regexp_matches(text, '(?i)(^|[^\\pL\\pN_])TBD($|[^\\pL\\pN_])') THEN 'TBD'
  ELSE coalesce(({DATED})[1], '') END"""
STEM = "split_part(list_last(string_split(text, '/')), '.', 1)"
THIRD = "(string_split(text, '/'))[3]"
REGION = f"""coalesce(regexp_replace(replace(text, 'flag mod-', ''),
  '^{BLANK}+|{BLANK}+$', '', 'g'), '')"""
IMAGE = f"""CASE WHEN text LIKE '//%' THEN 'https:' || text
  WHEN text LIKE '/%' THEN '{BASE_URL}' || text ELSE coalesce(text, '') END"""
URL = f"CASE WHEN text LIKE '/%' THEN '{BASE_URL}' || text ELSE coalesce(text, '') END"
SPAN = "CASE WHEN lower(text) = 'all' THEN 'all' ELSE text || 'd' END"


def fragments(spark, sf_dir):
    """All fragments, in as many tasks as the session shuffles to: a file of few bytes holds many of them."""
    return run(spark, sf_dir, FRAGMENTS).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def _register(name: str, expression: str, build) -> None:
    @query(name, f"{WITH_FRAGMENTS} SELECT id, {expression} AS value FROM fragments")
    def _(spark, sf_dir):
        value: Column = build(F.col("text"))
        return fragments(spark, sf_dir).select("id", value.alias("value"))


_register("asset_stem", STEM, X.asset_stem)
_register("safe_text", f"coalesce({STRIPPED}, '')", X.safe_text)
_register("prize_value", PRIZE, X.prize_value)
_register("date_range_text", DATES, X.date_range_text)
_register("region_from_flag", REGION, X.region_from_flag)
_register("normalize_image_url", IMAGE, lambda t: X.normalize_image_url(t, BASE_URL))


@query(
    "whitespace_tokens",
    f"""{WITH_FRAGMENTS} SELECT id, coalesce(({TOKENS})[1], '') AS name,
    coalesce(({TOKENS})[2], 'N/A') AS org, CAST(len({TOKENS}) AS INTEGER) AS n_tokens
    FROM fragments""",
)
def _(spark, sf_dir):
    rows = fragments(spark, sf_dir).withColumn("t", X.whitespace_tokens(F.col("text")))
    return rows.select(
        "id",
        X.token_or_default(F.col("t"), 0, "").alias("name"),
        X.token_or_default(F.col("t"), 1).alias("org"),
        F.size("t").alias("n_tokens"),
    )


# Time spans as the ledger's callers write them: a number of days, or all in any case.
SPANS = """SELECT o_orderkey AS id,
  CASE CAST(o_custkey % 5 AS INT) WHEN 0 THEN 'all' WHEN 1 THEN 'All' WHEN 2 THEN 'ALL'
       ELSE CAST(o_custkey % 90 AS STRING) END AS text FROM orders"""


@query("timespan_normalize", f"WITH spans AS ({SPANS}) SELECT id, {SPAN} AS value FROM spans")
def _(spark, sf_dir):
    return run(spark, sf_dir, SPANS).select("id", X.timespan(F.col("text")).alias("value"))


@query(
    "extract_fields",
    f"""{WITH_FRAGMENTS} SELECT id, text, coalesce(({TOKENS})[1], '') AS name,
    coalesce(({TOKENS})[2], 'N/A') AS org, coalesce({STRIPPED}, '') AS stripped,
    {STEM} AS stem, {PRIZE} AS prize, {DATES} AS dates, {REGION} AS region,
    {IMAGE} AS image_url, {URL} AS url FROM fragments""",
)
def _(spark, sf_dir):
    return extract_fields(fragments(spark, sf_dir), BASE_URL)


# What the links of ``spelt_pages`` are, told from the pages as they were before.
LINKS = """SELECT page_id, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS link_no,
  unnest(hrefs) AS text
  FROM (SELECT page_id, list_prepend('/page/' || CAST(page_id AS VARCHAR) || '?a=1&b=é',
    list_transform(regexp_extract_all(html, 'href="([^"]*)"', 1), lambda x: replace(x, '&amp;', '&'))) AS hrefs
    FROM pages)"""


def spelt_pages(spark, sf_dir):
    """The pages with their links spelt in several ways, and one more link in front."""
    html, kind = F.col("html"), F.col("page_id") % 3
    spelt = (
        F.when(kind == 1, F.replace(html, F.lit('href="'), F.lit('HREF = "')))
        .when(kind == 2, F.replace(html, F.lit('href="'), F.lit('data-href="/none" Href="')))
        .otherwise(html)
    )
    first = F.concat(F.lit("<a href='/page/"), F.col("page_id"), F.lit("?a=1&amp;b=&#233;'>"))
    return read_tables(spark, sf_dir, "pages")["pages"].withColumn("html", F.concat(first, spelt))


@query(
    "page_links",
    f"""WITH links AS ({LINKS}) SELECT page_id, link_no, text AS href, {URL} AS url,
    {THIRD} AS link_id FROM links""",
)
def _(spark, sf_dir):
    return page_links(spelt_pages(spark, sf_dir), BASE_URL)


def _links(spark, sf_dir):
    pages = spelt_pages(spark, sf_dir)
    return pages.select("page_id", F.explode(link_targets(F.col("html"))).alias("text"))


@query(
    "absolute_url",
    f"WITH links AS ({LINKS}) SELECT page_id, text AS href, {URL} AS url FROM links",
)
def _(spark, sf_dir):
    links = _links(spark, sf_dir)
    url = X.absolute_url(F.col("text"), BASE_URL)
    return links.select("page_id", F.col("text").alias("href"), url.alias("url"))


@query(
    "id_from_href",
    f"""WITH links AS ({LINKS}) SELECT page_id, text AS href, {THIRD} AS link_id FROM links
    UNION ALL SELECT page_id, url AS href, (string_split(url, '/'))[3] AS link_id FROM pages""",
)
def _(spark, sf_dir):
    urls = read_tables(spark, sf_dir, "pages")["pages"].select("page_id", F.col("url").alias("text"))
    links = _links(spark, sf_dir).unionByName(urls)
    return links.select(
        "page_id", F.col("text").alias("href"), X.id_from_href(F.col("text")).alias("link_id")
    )
