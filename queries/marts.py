"""Business marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import query, table
from stratalake.plans import marts

REVENUE = """cast(l_extendedprice AS decimal(18,2))
  * (cast(1 AS decimal(6,4)) - cast(l_discount AS decimal(6,4)))"""


def _plain(df: DataFrame, money: list[str]) -> DataFrame:
    """Exact decimals leave as doubles, so engines that widen decimals differently agree."""
    return df.withColumns({c: F.col(c).cast("double") for c in money})


@query(
    "gold_sales_denormalized",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey,
      o_orderdate AS order_date, o_orderstatus AS order_status, c_name AS customer_name,
      c_mktsegment AS customer_segment, n_name AS customer_nation, r_name AS customer_region,
      p_brand AS part_brand, p_type AS part_type, s_name AS supplier_name,
      cast(cast({REVENUE} AS decimal(18,2)) AS double) AS revenue
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
      LEFT JOIN customer ON o_custkey = c_custkey
      LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
      LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def gold_sales_denormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["lineitem", "orders", "customer", "nation", "region", "part", "supplier"]
    return _plain(
        marts.sales_denormalized(*[table(spark, sf_dir, n) for n in names]), ["revenue"]
    )


@query(
    "gold_customer_360",
    """WITH spending AS (
      SELECT o_custkey, count(*) AS n, sum(cast(o_totalprice AS decimal(18,2))) AS total,
             min(o_orderdate) AS first_day, max(o_orderdate) AS last_day
      FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_segment,
           n_name AS nation, c_acctbal AS account_balance, coalesce(n, 0) AS order_count,
           coalesce(cast(total AS double), 0) AS total_spend,
           first_day AS first_order_date, last_day AS last_order_date,
           cast((2 * cast(total * 100 AS bigint) + n) // (2 * n) AS bigint) / 100.0
             AS average_order_value
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
      LEFT JOIN spending ON c_custkey = o_custkey""",
)
def gold_customer_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.customer_360(*[table(spark, sf_dir, n) for n in ("customer", "nation", "orders")])
    return _plain(mart, ["account_balance", "total_spend", "average_order_value"])


@query(
    "gold_sales_metrics",
    f"""WITH sold AS (
      SELECT year(o_orderdate) AS order_year, month(o_orderdate) AS order_month,
             c_mktsegment AS customer_segment, l_orderkey, l_quantity, {REVENUE} AS revenue
      FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey)
    SELECT order_year, order_month, customer_segment, count(DISTINCT l_orderkey) AS order_count,
           sum(l_quantity) AS units, cast(cast(sum(revenue) AS decimal(18,2)) AS double) AS revenue,
           cast((2 * cast(cast(sum(revenue) AS decimal(18,2)) * 100 AS bigint)
                 + count(DISTINCT l_orderkey)) // (2 * count(DISTINCT l_orderkey)) AS bigint)
             / 100.0 AS average_order_value
    FROM sold GROUP BY ALL""",
)
def gold_sales_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["lineitem", "orders", "customer"]
    mart = marts.sales_metrics(*[table(spark, sf_dir, n) for n in names])
    return _plain(mart, ["units", "revenue", "average_order_value"])


@query(
    "gold_operational_kpis",
    """SELECT cast(cast(ts AS date) AS timestamp) AS day, count(*) AS events,
      count(DISTINCT user_id) AS active_users, count(*) FILTER (event_type = 'error') AS errors,
      count(*) FILTER (event_type = 'purchase') AS purchases,
      coalesce(cast(sum(cast(value AS decimal(18,2))) FILTER (event_type = 'purchase') AS double),
               0) AS purchase_value,
      cast(count(*) FILTER (event_type = 'error') AS double) / count(*) AS error_rate
    FROM events GROUP BY cast(ts AS date)""",
)
def gold_operational_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.operational_kpis(table(spark, sf_dir, "events"))
    return _plain(mart, ["purchase_value"]).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query(
    "gold_customer_features",
    """SELECT o_custkey AS customer_id,
      date_diff('day', cast(max(o_orderdate) AS date), date '2001-12-31') AS recency_days,
      count(*) AS frequency, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS monetary,
      cast(count(*) FILTER (o_orderpriority = '1-URGENT') AS double) / count(*) AS urgent_share
    FROM orders GROUP BY o_custkey""",
)
def gold_customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = marts.customer_features(table(spark, sf_dir, "orders"), date(2001, 12, 31))
    return _plain(mart, ["monetary"])
