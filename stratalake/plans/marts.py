"""Business marts over a star schema of orders, lines, customers, parts and suppliers.

Money is computed in decimals, exact whatever the order of summation, and cast once at the
end. Joins carry no broadcast hints: dimensions grow with the business, so the planner decides
by the sizes it sees, and adaptive execution splits a partition that one key makes too large.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# A line's price and rate are declared just wide enough that their product has 18 digits, which
# Spark computes on plain integers; one digit more would make every row a big-decimal object.
LINE_PRICE, RATE, QUANTITY = "decimal(11,2)", "decimal(5,4)", "decimal(8,2)"


def line_revenue() -> Column:
    """Discounted price of one order line, exact."""
    paid = F.lit(1).cast(RATE) - F.col("l_discount").cast(RATE)
    return F.col("l_extendedprice").cast(LINE_PRICE) * paid


def _money(value: Column) -> Column:
    return value.cast(MONEY)


def sales_denormalized(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    part: DataFrame,
    supplier: DataFrame,
) -> DataFrame:
    """One row per order line with its order, customer, part and supplier; no line is lost.

    Customers, nations and regions join the orders first: those rows are a fraction of the
    lines, so the lines move once for their order and not once more for each of these.
    """
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    buyers = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey",
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("n_name").alias("customer_nation"),
        F.col("r_name").alias("customer_region"),
    )
    sold = orders.join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left")
    parts = part.select(
        "p_partkey", F.col("p_brand").alias("part_brand"), F.col("p_type").alias("part_type")
    )
    sellers = supplier.select("s_suppkey", F.col("s_name").alias("supplier_name"))
    return (
        lineitem.join(sold, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey",
            F.col("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            "customer_name", "customer_segment", "customer_nation", "customer_region",
            "part_brand", "part_type", "supplier_name",
            _money(line_revenue()).alias("revenue"),
        )
    )


def customer_360(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer: who they are and what they ordered; without orders, zeros.

    Orders shrink to one row per customer before the join, combined before their shuffle.
    """
    spending = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(F.col("o_totalprice").cast(MONEY)).alias("total"),
        F.min("o_orderdate").alias("first_order_date"),
        F.max("o_orderdate").alias("last_order_date"),
    )
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    joined = named.join(spending, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("n_name").alias("nation"),
        F.col("c_acctbal").cast(MONEY).alias("account_balance"),
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        _money(F.coalesce("total", F.lit(0))).alias("total_spend"),
        "first_order_date",
        "last_order_date",
        _money(F.col("total") / F.col("order_count")).alias("average_order_value"),
    )


def sales_metrics(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Per order year, month and customer segment: orders, units, revenue, average order value.

    Lines shrink to one row per order before the join, so orders are counted without a
    distinct, and the join moves a fraction of the lines. Lines without their order, and orders
    without their customer, count under a null month or segment; no revenue is lost.
    """
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_quantity").cast(QUANTITY)).alias("units"),
        F.sum(line_revenue()).alias("revenue"),
    )
    sold = per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    bought = sold.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    grouped = bought.groupBy(
        F.year("o_orderdate").cast("bigint").alias("order_year"),
        F.month("o_orderdate").cast("bigint").alias("order_month"),
        F.col("c_mktsegment").alias("customer_segment"),
    ).agg(
        F.count(F.lit(1)).alias("order_count"),
        _money(F.sum("units")).alias("units"),
        _money(F.sum("revenue")).alias("revenue"),
    )
    average = _money(F.col("revenue") / F.col("order_count"))
    return grouped.withColumn("average_order_value", average)


def operational_kpis(events: DataFrame) -> DataFrame:
    """Per day: events, active users, errors and their rate, purchases and their value.

    Rows shrink to one per day and user first, so the distinct users of a day are a plain
    count and a user with very many events reaches the shuffle already combined.
    """
    kind, value = F.col("event_type"), F.col("value").cast(MONEY)
    per_user = events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(kind == "error").alias("errors"),
        F.count_if(kind == "purchase").alias("purchases"),
        F.sum(F.when(kind == "purchase", value)).alias("spent"),
    )
    per_day = per_user.groupBy("day").agg(
        F.sum("events").alias("events"),
        F.count("user_id").alias("active_users"),
        F.sum("errors").alias("errors"),
        F.sum("purchases").alias("purchases"),
        _money(F.coalesce(F.sum("spent"), F.lit(0))).alias("purchase_value"),
    )
    return per_day.withColumn(
        "error_rate", F.col("errors").cast("double") / F.col("events").cast("double")
    )


def customer_features(orders: DataFrame, at: date) -> DataFrame:
    """Per customer with orders: days since the last one, number, value, share urgent."""
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double")
    return orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.date_diff(F.lit(at), F.max("o_orderdate").cast("date")).cast("bigint").alias(
            "recency_days"
        ),
        F.count(F.lit(1)).alias("frequency"),
        _money(F.sum(F.col("o_totalprice").cast(MONEY))).alias("monetary"),
        (urgent / F.count(F.lit(1))).alias("urgent_share"),
    )
