"""The shapes that specifications speak of, taken from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import table

# Columns, rules and expressions that a sales and a customer source declare.
DAILY_SALES_COLUMNS = [
    {"name": "transaction_id", "type": "string", "nullable": False},
    {"name": "transaction_date", "type": "date", "format": "yyyy-MM-dd", "nullable": False},
    {"name": "customer_id", "type": "string", "nullable": False},
    {"name": "product_code", "type": "string", "nullable": False},
    {"name": "quantity", "type": "integer", "nullable": False, "constraints": {"min": 1}},
    {"name": "unit_price", "type": "decimal(10,2)", "nullable": False, "constraints": {"min": 0}},
    {"name": "total_amount", "type": "decimal(10,2)", "nullable": False,
     "constraints": {"min": 0}},
    {"name": "payment_method", "type": "string", "nullable": True},
    {"name": "store_location", "type": "string", "nullable": True},
]
DAILY_SALES = {"strict_validation": True, "columns": DAILY_SALES_COLUMNS}

PAYMENT_RULES = [
    {"from": ["1-URGENT", "2-HIGH"], "to": "Fast"},
    {"from": ["4-NOT SPECIFIED"], "to": "Unknown"},
]
LOCATION_RULES = [{"from": ["F", "O"], "to": "Settled"}]

# The steps of the sales cleansing: checks, value mapping, derived columns. Fixed values.
SALES_STEPS = [
    {
        "type": "data_quality_checks",
        "checks": [
            {"type": "null_check", "columns": ["transaction_id", "customer_id", "product_code"],
             "threshold": 0},
            {"type": "duplicate_check", "columns": ["transaction_id"], "threshold": 0},
            {"type": "range_check", "column": "total_amount", "min": 0},
        ],
    },
    {
        "type": "standardization",
        "rules": {"payment_method": PAYMENT_RULES, "store_location": LOCATION_RULES},
    },
    {
        "type": "derived_columns",
        "columns": [
            {"name": "transaction_year", "expression": "YEAR(transaction_date)"},
            {"name": "transaction_month", "expression": "MONTH(transaction_date)"},
            {"name": "transaction_quarter", "expression": "QUARTER(transaction_date)"},
            {
                "name": "revenue_category",
                "expression": "CASE WHEN total_amount >= 1000 THEN 'High Value' "
                "WHEN total_amount >= 100 THEN 'Medium Value' ELSE 'Low Value' END",
            },
            {"name": "discount_amount", "expression": "(unit_price * quantity) - total_amount"},
        ],
    },
]

CENTS = "cast(round(l_extendedprice * 100) as bigint)"
PERCENT_PAID = "(100 - cast(round(l_discount * 100) as bigint))"


def daily_sales_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines as a raw source would deliver them: all text.

    Money is whole cents before it becomes text, so that every engine sees the same digits.
    """
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    unit, total = f"({CENTS} div cast(l_quantity as bigint))", f"(({CENTS} * {PERCENT_PAID}) div 100)"
    return sold.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_code"),
        F.col("l_quantity").cast("int").cast("string").alias("quantity"),
        F.expr(f"cast(cast({unit} as decimal(10,0)) * 0.01 as string)").alias("unit_price"),
        F.expr(f"cast(cast({total} as decimal(10,0)) * 0.01 as string)").alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_orderstatus").alias("store_location"),
    )


# The same, for DuckDB, cents kept as integers.
SALES_SQL = """
sales AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
         cast(o_orderdate AS date) AS transaction_date,
         cast(o_custkey AS varchar) AS customer_id,
         cast(l_partkey AS varchar) AS product_code,
         cast(l_quantity AS bigint) AS quantity,
         cast(round(l_extendedprice * 100) AS bigint) // cast(l_quantity AS bigint) AS unit_cents,
         cast(round(l_extendedprice * 100) AS bigint)
           * (100 - cast(round(l_discount * 100) AS bigint)) // 100 AS total_cents,
         o_orderpriority AS payment_method,
         o_orderstatus AS store_location
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# Fixed value: what an e-mail address looks like.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# Customers as text, with gaps and loose spellings to clean.
CUSTOMER_COLUMNS = [
    {"name": "customer_id", "type": "string", "nullable": False},
    {"name": "customer_name", "type": "string", "nullable": False,
     "constraints": {"max_length": 255}},
    {"name": "email", "type": "string", "nullable": True,
     "pattern": EMAIL},
    {"name": "phone", "type": "string", "nullable": True},
    {"name": "city", "type": "string", "nullable": True},
    {"name": "customer_segment", "type": "string", "nullable": True},
    {"name": "is_active", "type": "boolean", "nullable": False, "default": True},
]
CUSTOMERS = {"strict_validation": True, "columns": CUSTOMER_COLUMNS}


def customers_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    named = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    balance = F.col("c_acctbal")
    return named.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("  "), F.initcap("c_name"), F.lit(" ")).alias("customer_name"),
        F.when(balance > 9000, F.concat(F.lit("nobody.at."), "c_mktsegment"))
        .when(balance >= 0, F.concat("c_mktsegment", F.lit(".Desk@Example.com ")))
        .alias("email"),
        F.concat(F.lit("+("), "c_nationkey", F.lit(") "), "c_custkey").alias("phone"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.when(balance < 1000, F.lit(None)).when(balance < 5000, "false").otherwise("true").alias(
            "is_active"
        ),
    )


CUSTOMERS_SQL = """
customers AS (
  SELECT cast(c_custkey AS varchar) AS customer_id,
         '  ' || c_name || ' ' AS customer_name,
         CASE WHEN c_acctbal > 9000 THEN 'nobody.at.' || c_mktsegment
              WHEN c_acctbal >= 0 THEN c_mktsegment || '.Desk@Example.com ' END AS email,
         '+(' || c_nationkey || ') ' || c_custkey AS phone,
         n_name AS city,
         c_mktsegment AS customer_segment,
         CASE WHEN c_acctbal < 1000 THEN NULL
              WHEN c_acctbal < 5000 THEN 'false' ELSE 'true' END AS is_active
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
