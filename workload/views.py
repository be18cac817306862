"""Views over the given tables that have the shapes the library works on.

The SQL texts run unchanged in Spark and in the checking engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from snapstrata.schemas import map_values_sql

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

_DIMENSIONS = """
FROM lineitem l
JOIN orders o   ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n   ON c.c_nationkey = n.n_nationkey
JOIN region r   ON n.n_regionkey = r.r_regionkey
"""

BRONZE = f"""
SELECT
  CAST(o.o_custkey % 200 AS INT) AS player_id,
  concat(' P', CAST(o.o_custkey % 200 AS STRING), ' ') AS player,
  concat('org_', CAST(o.o_custkey % 20 AS STRING)) AS org,
  concat('agent_', CAST(l.l_suppkey % 10 AS STRING)) AS agents,
  CAST(l.l_quantity AS INT) - 1 AS rounds_played,
  CASE WHEN l.l_returnflag = 'A' THEN NULL
       ELSE CAST(l.l_partkey % 200 AS DOUBLE) / 100 END AS rating,
  CAST(l.l_suppkey % 300 AS DOUBLE) AS average_combat_score,
  CASE WHEN l.l_suppkey % 7 = 0 OR l.l_returnflag = 'R' THEN NULL
       ELSE CAST(l.l_linenumber AS DOUBLE) / 2 END AS kill_deaths,
  CASE WHEN l.l_returnflag = 'N' THEN NULL
       ELSE concat(CAST(l.l_partkey % 101 AS STRING), '%') END AS kill_assists_survived_traded,
  CASE WHEN l.l_returnflag = 'A' THEN NULL
       ELSE CAST(l.l_partkey % 180 AS DOUBLE) END AS average_damage_per_round,
  CAST(l.l_linenumber AS DOUBLE) / 4 AS kills_per_round,
  CAST(l.l_linenumber AS DOUBLE) / 8 AS assists_per_round,
  CASE WHEN l.l_partkey % 4 = 0 THEN NULL
       ELSE CAST(l.l_partkey % 4 AS DOUBLE) / 4 END AS first_kills_per_round,
  CASE WHEN l.l_returnflag = 'R' THEN NULL
       ELSE CAST(l.l_suppkey % 4 AS DOUBLE) / 4 END AS first_deaths_per_round,
  CASE WHEN l.l_returnflag = 'R' THEN ''
       ELSE concat(CAST(l.l_suppkey % 101 AS STRING), '%') END AS headshot_percentage,
  CASE WHEN l.l_linenumber = 1 THEN NULL
       ELSE concat(CAST(l.l_linenumber * 10 AS STRING), '%') END AS clutch_success_percentage,
  CASE WHEN l.l_linestatus = 'O' THEN NULL
       ELSE concat(CAST(l.l_linenumber - 1 AS STRING), '/',
                   CAST(l.l_linenumber - 1 + l.l_suppkey % 3 AS STRING))
       END AS clutches_won_played_ratio,
  CAST(l.l_partkey % 30 AS INT) AS max_kills_in_single_map,
  CAST(l.l_linenumber * (l.l_partkey % 6) AS INT) AS kills,
  CAST(l.l_suppkey % 7 AS INT) AS deaths,
  CAST(l.l_linenumber AS INT) AS assists,
  CAST(l.l_partkey % 4 AS INT) AS first_kills,
  CAST(l.l_suppkey % 4 AS INT) AS first_deaths,
  CAST(o.o_custkey % 8 AS INT) AS event_id,
  lower(substr(r.r_name, 1, 2)) AS region,
  concat('map_', CAST(l.l_partkey % 12 AS STRING)) AS map,
  concat('agent_', CAST(l.l_suppkey % 10 AS STRING)) AS agent,
  make_date(year(o.o_orderdate), 1, 1) AS snapshot_date
{_DIMENSIONS}
"""

# Ledger ids are order keys; map ids outside the dimension have no name.
LEDGER = f"""
SELECT o.o_orderkey AS id, o.o_custkey % 8 AS event_id,
       CAST(o.o_orderkey % 15 AS STRING) AS map_id, m.map_name AS map_name,
       lower(substr(o.o_orderpriority, 1, 2)) AS region_abbr,
       concat('agent_', CAST(o.o_custkey % 10 AS STRING)) AS agent,
       o.o_orderstatus <> 'P' AS is_completed, o.o_orderkey % 3 = 0 AS is_scrapped,
       CASE WHEN o.o_orderkey % 3 = 0 THEN CAST(o.o_orderdate AS TIMESTAMP) END AS last_scraped
FROM orders o
LEFT JOIN (SELECT * FROM (VALUES {map_values_sql()}) AS t(map_id, map_name)) m
  ON m.map_id = CAST(o.o_orderkey % 15 AS STRING)
"""

# A partition file exists for every order that has line items.
LISTING = f"""
SELECT concat('bronze/event_id=', CAST(g.event_id AS STRING), '/region=', g.region_abbr,
              '/map=', coalesce(g.map_name, concat('map_', g.map_id)), '/agent=', g.agent,
              '/snapshot_date=', CAST(CAST(o.o_orderdate AS DATE) AS STRING), '/data.csv') AS path
FROM ({LEDGER}) g JOIN orders o ON o.o_orderkey = g.id
WHERE g.id IN (SELECT l_orderkey FROM lineitem)
"""

# One file per line item; some lie outside any snapshot folder.
FILES = f"""
SELECT concat('bronze/event_id=', CAST(o.o_custkey % 8 AS STRING),
              '/region=', lower(substr(r.r_name, 1, 2)),
              '/map=map_', CAST(l.l_partkey % 12 AS STRING),
              '/agent=agent_', CAST(l.l_suppkey % 10 AS STRING),
              CASE WHEN l.l_linenumber = 7 THEN '/_index'
                   ELSE concat('/snapshot_date=', CAST(year(o.o_orderdate) AS STRING), '-01-01') END,
              '/part-', CAST(l.l_orderkey AS STRING), '-', CAST(l.l_linenumber AS STRING),
              '.csv') AS path
{_DIMENSIONS}
"""

# Kinds of completion messages, most of them well formed.
MESSAGES = """
SELECT event_id, CAST(event_id AS STRING) AS ack_id, user_id AS row_id, ts,
       event_type <> 'error' AS success,
       concat('bronze/event_id=', CAST(user_id % 8 AS STRING), '/data.csv') AS blob_path,
       CASE WHEN event_id % 97 = 0 THEN 'not base64'
            WHEN event_id % 89 = 0 THEN 'not json'
            WHEN event_id % 83 = 0 THEN 'not an object'
            WHEN event_id % 79 = 0 THEN 'no row id'
            WHEN event_id % 73 = 0 THEN 'no success'
            WHEN event_id % 71 = 0 THEN 'text id'
            WHEN event_id % 67 = 0 THEN 'decimal id'
            WHEN event_id % 61 = 0 THEN 'number success'
            WHEN event_id % 59 = 0 THEN 'text success'
            WHEN event_id % 53 = 0 THEN 'trailing'
            ELSE 'whole' END AS kind
FROM events
"""

MESSAGE_BODIES = f"""
SELECT m.*,
       CASE kind WHEN 'not json' THEN 'row 7 done'
                 WHEN 'not an object' THEN '[1, 2]'
                 WHEN 'no row id' THEN concat('{{"blob_path": "', blob_path, '", "success": ',
                                              CAST(success AS STRING), '}}')
                 WHEN 'no success' THEN concat('{{"row_id": ', CAST(row_id AS STRING),
                                               ', "blob_path": "', blob_path, '"}}')
                 WHEN 'text id' THEN concat('{{"row_id": "', CAST(row_id AS STRING), '", "blob_path": "',
                                            blob_path, '", "success": ', CAST(success AS STRING), '}}')
                 WHEN 'decimal id' THEN concat('{{"row_id": ', CAST(row_id AS STRING), '.0, "blob_path": "',
                                               blob_path, '", "success": ', CAST(success AS STRING), '}}')
                 WHEN 'number success' THEN concat('{{"row_id": ', CAST(row_id AS STRING), ', "blob_path": "',
                      blob_path, '", "success": ', CASE WHEN success THEN '1' ELSE '0' END, '}}')
                 WHEN 'text success' THEN concat('{{"row_id": ', CAST(row_id AS STRING), ', "blob_path": "',
                      blob_path, '", "success": "', CASE WHEN success THEN 'false' ELSE '' END, '"}}')
                 WHEN 'trailing' THEN concat('{{"row_id": ', CAST(row_id AS STRING), ', "success": true}} done')
                 ELSE concat('{{"row_id": ', CAST(row_id AS STRING), ', "blob_path": "', blob_path,
                             '", "success": ', CAST(success AS STRING), '}}') END AS body
FROM ({MESSAGES}) m
"""

# Text fragments: every form the extractors know, and whole documents.
FRAGMENTS = """
SELECT concat('o', CAST(o_orderkey AS STRING)) AS id,
       CASE CAST(o_orderkey % 16 AS INT)
         WHEN 0 THEN 'TBD Prize Pool'
         WHEN 1 THEN concat('$', CAST(o_custkey AS STRING), ',000 Prize Pool')
         WHEN 2 THEN concat(CAST(o_custkey AS STRING), ',500 prize pool of all')
         WHEN 3 THEN CAST(o_custkey % 200 AS STRING)
         WHEN 4 THEN concat('Jul ', CAST(o_custkey % 31 AS STRING), '—Aug ',
                            CAST(o_orderkey % 29 AS STRING))
         WHEN 5 THEN concat('Sep ', CAST(o_custkey % 31 AS STRING), '—TBD')
         WHEN 6 THEN concat('flag mod-', lower(substr(o_orderpriority, 3, 2)), ' ')
         WHEN 7 THEN concat('//host', CAST(o_custkey AS STRING), '/x.a.png')
         WHEN 8 THEN concat('/img/', CAST(o_custkey AS STRING), '.png')
         WHEN 9 THEN concat('https://host/', CAST(o_custkey AS STRING), '.svg.gz')
         WHEN 10 THEN concat('  name', CAST(o_custkey AS STRING), chr(9), ' org',
                             CAST(o_custkey % 7 AS STRING), chr(10), 'rest ')
         WHEN 11 THEN concat('Dates', chr(10), ' Starts Oct ', CAST(o_custkey % 31 AS STRING))
         WHEN 12 THEN NULL
         WHEN 13 THEN ''
         WHEN 14 THEN concat('player', CAST(o_custkey AS STRING))
         ELSE concat('/player/', CAST(o_custkey AS STRING), '/nick') END AS text
FROM orders
UNION ALL
SELECT concat('d', CAST(doc_id AS STRING)) AS id, text FROM documents
"""


# Opened tables, so that file schemas are read once per application. No rows are held.
_OPENED: dict[tuple[str, str], DataFrame] = {}


def read_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    for name in names:
        owner = (spark.sparkContext.applicationId, f"{sf_dir.rstrip('/')}/{name}.parquet")
        if owner not in _OPENED or _OPENED[owner].sparkSession is not spark:
            _OPENED[owner] = spark.read.parquet(owner[1])
    return {
        n: _OPENED[spark.sparkContext.applicationId, f"{sf_dir.rstrip('/')}/{n}.parquet"]
        for n in names
    }


_PRIVATE = "snapstrata_workload"


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a text over the given tables. They get names of their own, so no view of the session is replaced."""
    named = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql))
    needed = [t for t in TABLES if t in named]
    for name, table in read_tables(spark, sf_dir, *needed).items():
        table.createOrReplaceTempView(f"{_PRIVATE}_{name}")
    private = re.sub(
        r"\b(FROM|JOIN)(\s+)(\w+)",
        lambda m: f"{m[1]}{m[2]}{_PRIVATE}_{m[3]}" if m[3] in needed else m[0],
        sql,
    )
    return spark.sql(private)


# The orders find their region before the line items come, of which there are several to an order.
_ORDERS_FIRST = """
FROM lineitem l
JOIN (SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, c.c_nationkey
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) o ON l.l_orderkey = o.o_orderkey
JOIN nation n   ON o.c_nationkey = n.n_nationkey
JOIN region r   ON n.n_regionkey = r.r_regionkey
"""


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, BRONZE.replace(_DIMENSIONS, _ORDERS_FIRST))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, LEDGER)
