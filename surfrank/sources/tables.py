"""Edge sources derived from the driver's parquet tables.

Each function takes ``(spark, sf_dir)`` and returns ``(src, dst)``; only the
needed columns are read, so the parquet scans are pruned.

* ``part_supp``: part -> supplier per lineitem row, text ids ``P<partkey>``
  and ``S<suppkey>`` (sinks, duplicates);
* ``raw_part_supp``: the same with the raw bigint keys, which share one
  number space on purpose (self-links);
* ``cust_part``: customer <-> part for every ordered line, both directions;
* ``event_flow``: per user, each event ``user:event_type`` links to the
  user's next event in ``(ts, event_id)`` order (self-links, heavy duplicates);
* ``page_links``: page url -> every ``href="..."`` target in its html, resolved
  against the page's host and scheme when it begins with a slash;
* ``flag_order``: return flag <-> order per lineitem row (three hub sources
  that own a third of all edges);
* ``type_user``: event type <-> user per event (a handful of hub sources).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequence import with_next

HREF_PATTERN = 'href="([^"]*)"'
HOST_PATTERN = "^([a-z]+://[^/]*)"
# ordered lines that one task joins at most, on average, whatever the session's number of shuffle partitions
LINES_PER_TASK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("src"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("dst"),
    )


def raw_part_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


def cust_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    tasks = math.ceil(li.count() / LINES_PER_TASK)  # the count reads file footers alone
    if tasks > 1:  # dealt by the number of lines, so that a task's memory does not grow with the table
        tasks = max(tasks, spark.sparkContext.defaultParallelism)
        li, orders = li.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    both = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("c"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("p"),
    )
    return both.select(F.col("c").alias("src"), F.col("p").alias("dst")).unionByName(
        both.select(F.col("p").alias("src"), F.col("c").alias("dst"))
    )


def event_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(
        "user_id",
        "ts",
        "event_id",
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_type")).alias("node"),
    )
    linked = with_next(ev, "user_id", ["ts", "event_id"], "node", out="next_node")
    return linked.filter(F.col("next_node").isNotNull()).select(
        F.col("node").alias("src"), F.col("next_node").alias("dst")
    )


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("url", "html")
    href = F.explode(F.regexp_extract_all(F.col("html"), F.lit(HREF_PATTERN), F.lit(1))).alias("href")
    host = F.regexp_extract("url", HOST_PATTERN, 1)
    return pages.select("url", href).select(
        F.col("url").alias("src"),
        F.when(F.startswith("href", F.lit("/")), F.concat(host, F.col("href"))).otherwise(F.col("href")).alias("dst"),
    )


def type_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event type <-> user for every event: the few event types are hub sources."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("t"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("u")
    )
    return ev.select(F.col("t").alias("src"), F.col("u").alias("dst")).unionByName(
        ev.select(F.col("u").alias("src"), F.col("t").alias("dst"))
    )


def flag_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """return flag <-> order: each flag links to a large share of all orders."""
    li = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("f"), F.concat(F.lit("O"), F.col("l_orderkey").cast("string")).alias("o")
    )
    return li.select(F.col("f").alias("src"), F.col("o").alias("dst")).unionByName(
        li.select(F.col("o").alias("src"), F.col("f").alias("dst"))
    )


GRAPHS = {
    "part_supp": part_supp,
    "raw_part_supp": raw_part_supp,
    "cust_part": cust_part,
    "event_flow": event_flow,
    "page_links": page_links,
    "type_user": type_user,
    "flag_order": flag_order,
}

# DuckDB text of the same graphs, for the oracle queries.
GRAPH_SQL = {
    "flag_order": (
        "select l_returnflag as src, 'O' || l_orderkey as dst from lineitem "
        "union all select 'O' || l_orderkey, l_returnflag from lineitem"
    ),
    "part_supp": "select 'P' || l_partkey as src, 'S' || l_suppkey as dst from lineitem",
    "raw_part_supp": "select l_partkey as src, l_suppkey as dst from lineitem",
    "cust_part": (
        "select src, dst from (with b as (select 'C' || o_custkey as c, 'P' || l_partkey as p "
        "from orders join lineitem on o_orderkey = l_orderkey) "
        "select c as src, p as dst from b union all select p, c from b)"
    ),
    "event_flow": (
        "select src, dst from (select user_id || ':' || event_type as src, "
        "lead(user_id || ':' || event_type) over (partition by user_id order by ts, event_id) as dst "
        "from events) where dst is not null"
    ),
    "type_user": (
        "select event_type as src, 'U' || user_id as dst from events "
        "union all select 'U' || user_id, event_type from events"
    ),
    "page_links": (
        "select url as src, case when starts_with(href, '/') "
        "then regexp_extract(url, '^([a-z]+://[^/]*)', 1) || href else href end as dst from "
        "(select url, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) as href from pages)"
    ),
}
