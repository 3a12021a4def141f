"""Casting, enforcing, cleaning and combining columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.inputs import (
    CUSTOMERS, CUSTOMERS_SQL, DAILY_SALES, LOCATION_RULES, PAYMENT_RULES, SALES_SQL, SALES_STEPS,
    customers_text, daily_sales_text,
)
from queries.registry import query, table
from stratalake.operators.columns import (
    add_audit_columns, default_nulls, derive_columns, filter_not_null, standardize_columns,
    union_by_name,
)
from stratalake.operators.dedup import deduplicate_latest
from stratalake.operators.enforce import (
    add_missing_columns, cast_columns, drop_extra_columns, enforce_schema, fill_defaults,
)
from stratalake.plans.cleansing import apply_steps


@query(
    "audit_columns",
    """SELECT o_orderkey, o_totalprice, timestamp '2024-01-15 06:00:00' AS ingestion_timestamp,
       'erp' AS source_system, 'orders/' || o_orderstatus AS source_file, 'b1' AS batch_id
       FROM orders""",
)
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    file = F.concat(F.lit("orders/"), "o_orderstatus")
    at = F.lit("2024-01-15 06:00:00").cast("timestamp_ntz")
    kept = ["o_orderkey", "o_totalprice", "ingestion_timestamp", "source_system", "source_file"]
    return add_audit_columns(orders, "erp", file, "b1", at).select(*kept, "batch_id")


@query(
    "enforce_cast",
    """SELECT try_cast(nullif(o_orderstatus, 'P') AS varchar) AS status,
       CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END AS order_number,
       cast(round(o_totalprice * 100) AS bigint) / 100.0 AS price,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_totalprice END AS price_double
       FROM orders""",
)
def enforce_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text in, declared types out; what is no number becomes null."""
    schema = {
        "columns": [
            {"name": "status", "type": "string"},
            {"name": "order_number", "type": "long"},
            {"name": "price", "type": "decimal(12,2)"},
            {"name": "price_double", "type": "double"},
        ]
    }
    status = F.col("o_orderstatus")
    text = table(spark, sf_dir, "orders").select(
        F.nullif(status, F.lit("P")).alias("status"),
        F.when(status == "F", "n/a").otherwise(F.col("o_orderkey").cast("string")).alias(
            "order_number"
        ),
        F.col("o_totalprice").cast("string").alias("price"),
        F.when(status == "O", "12,5").otherwise(F.col("o_totalprice").cast("string")).alias(
            "price_double"
        ),
    )
    return cast_columns(text, schema).withColumn("price", F.col("price").cast("double"))


@query(
    "enforce_default",
    f"""WITH {CUSTOMERS_SQL}
    SELECT customer_id, coalesce(cast(is_active AS boolean), true) AS is_active, email
    FROM customers""",
)
def enforce_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = cast_columns(customers_text(spark, sf_dir), CUSTOMERS)
    return fill_defaults(typed, CUSTOMERS).select("customer_id", "is_active", "email")


@query(
    "enforce_missing",
    """SELECT s_suppkey, s_name, cast(NULL AS varchar) AS email, cast(NULL AS double) AS rating
       FROM supplier""",
)
def enforce_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {
        "columns": [
            {"name": "s_suppkey", "type": "long"},
            {"name": "email", "type": "string"},
            {"name": "rating", "type": "double"},
        ]
    }
    return add_missing_columns(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), schema)


@query("enforce_drop_extra", "SELECT p_partkey, p_name FROM part")
def enforce_drop_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"columns": [{"name": "p_partkey", "type": "long"}, {"name": "p_name"}]}
    return drop_extra_columns(table(spark, sf_dir, "part"), schema)


@query(
    "enforce_schema",
    f"""WITH {SALES_SQL}
    SELECT transaction_id, cast(transaction_date AS timestamp) AS transaction_date, customer_id,
           product_code, cast(quantity AS integer) AS quantity, unit_cents / 100.0 AS unit_price,
           total_cents / 100.0 AS total_amount, payment_method, store_location
    FROM sales""",
)
def enforced_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enforce_schema(daily_sales_text(spark, sf_dir), DAILY_SALES)
    return rows.withColumns(
        {
            "transaction_date": F.col("transaction_date").cast("timestamp_ntz"),
            "unit_price": F.col("unit_price").cast("double"),
            "total_amount": F.col("total_amount").cast("double"),
        }
    )


@query(
    "derived_columns",
    """SELECT o_orderkey, year(o_orderdate) AS order_year, quarter(o_orderdate) AS order_quarter,
       CASE WHEN o_totalprice >= 300000 THEN 'High Value'
            WHEN o_totalprice >= 100000 THEN 'Medium Value' ELSE 'Low Value' END AS tier,
       year(o_orderdate) * 10 + quarter(o_orderdate) AS period
       FROM orders""",
)
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last expression uses the columns derived before it."""
    columns = [
        {"name": "order_year", "expression": "CAST(YEAR(o_orderdate) AS BIGINT)"},
        {"name": "order_quarter", "expression": "CAST(QUARTER(o_orderdate) AS BIGINT)"},
        {
            "name": "tier",
            "expression": "CASE WHEN o_totalprice >= 300000 THEN 'High Value' "
            "WHEN o_totalprice >= 100000 THEN 'Medium Value' ELSE 'Low Value' END",
        },
        {"name": "period", "expression": "order_year * 10 + order_quarter"},
    ]
    added = derive_columns(table(spark, sf_dir, "orders"), columns)
    return added.select("o_orderkey", *[c["name"] for c in columns])


@query(
    "standardize_values",
    """SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Fast'
            WHEN o_orderpriority IN ('4-NOT SPECIFIED') THEN 'Unknown'
            ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderstatus IN ('F', 'O') THEN 'Settled' ELSE o_orderstatus END AS o_orderstatus
       FROM orders""",
)
def standardize_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    rules = {"o_orderpriority": PAYMENT_RULES, "o_orderstatus": LOCATION_RULES}
    return standardize_columns(orders, rules)


@query(
    "standardize_strings",
    f"""WITH {CUSTOMERS_SQL}
    SELECT customer_id, upper(trim(customer_name)) AS customer_name, trim(lower(email)) AS email
    FROM customers""",
)
def standardize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "customer_name": [{"trim": True}, {"upper_case": True}],
        "email": [{"lower_case": True}, {"trim": True}],
    }
    rows = customers_text(spark, sf_dir).select("customer_id", "customer_name", "email")
    return standardize_columns(rows, rules)


@query(
    "standardize_regex",
    f"""WITH {CUSTOMERS_SQL}
    SELECT customer_id, regexp_replace(phone, '[^0-9]', '', 'g') AS phone FROM customers""",
)
def standardize_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = [{"regex_replace": {"pattern": "[^0-9]", "replacement": ""}}]
    rows = customers_text(spark, sf_dir).select("customer_id", "phone")
    return standardize_columns(rows, {"phone": digits})


@query(
    "null_handling",
    f"""WITH {CUSTOMERS_SQL}
    SELECT customer_id, coalesce(email, 'unknown@email.com') AS email FROM customers""",
)
def null_handling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers_text(spark, sf_dir).select("customer_id", "email")
    return default_nulls(rows, {"email": "unknown@email.com"})


@query(
    "parse_dates",
    """SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate END AS order_date,
       o_orderdate + interval 5 minute AS order_time
       FROM orders""",
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates by a pattern; text that does not follow it becomes null."""
    schema = {
        "columns": [
            {"name": "order_date", "type": "date", "format": "dd.MM.yyyy"},
            {"name": "order_time", "type": "timestamp_ntz", "format": "yyyyMMdd HHmm"},
        ]
    }
    day = F.col("o_orderdate")
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "dd.MM.yyyy"))
        .alias("order_date"),
        F.date_format(day + F.expr("interval 5 minutes"), "yyyyMMdd HHmm").alias("order_time"),
    )
    parsed = cast_columns(text, schema)
    return parsed.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


@query(
    "filter_not_null",
    f"WITH {CUSTOMERS_SQL} SELECT customer_id, email FROM customers WHERE email IS NOT NULL",
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers_text(spark, sf_dir).select("customer_id", "email")
    return filter_not_null(rows, ["email"])


@query(
    "deduplicate_latest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity,
              l_extendedprice
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
               "l_extendedprice"]
    return deduplicate_latest(
        table(spark, sf_dir, "lineitem").select(*columns),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate"],
        ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"],
    )


@query(
    "union_by_name",
    """SELECT c_custkey AS party_id, c_name AS name, c_mktsegment AS segment,
              cast(NULL AS bigint) AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = {"columns": [{"name": "party_id", "type": "long"}, {"name": "name"}]}
    buyers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    sellers = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").cast("bigint").alias("nation"),
        F.col("s_name").alias("name"),
        F.col("s_suppkey").cast("string").alias("party_id"),
    )
    return union_by_name([enforce_schema(buyers, schema), enforce_schema(sellers, schema)])


@query(
    "daily_sales_cleansing",
    f"""WITH {SALES_SQL},
    cleansed AS (
      SELECT year(transaction_date) AS transaction_year,
             quarter(transaction_date) AS transaction_quarter,
             CASE WHEN total_cents >= 100000 THEN 'High Value'
                  WHEN total_cents >= 10000 THEN 'Medium Value' ELSE 'Low Value' END
               AS revenue_category,
             CASE WHEN payment_method IN ('1-URGENT', '2-HIGH') THEN 'Fast'
                  WHEN payment_method = '4-NOT SPECIFIED' THEN 'Unknown'
                  ELSE payment_method END AS payment_method,
             total_cents, unit_cents * quantity - total_cents AS discount_cents
      FROM sales)
    SELECT transaction_year, transaction_quarter, revenue_category, payment_method,
           count(*) AS sales, cast(sum(total_cents) AS bigint) / 100.0 AS revenue,
           cast(sum(discount_cents) AS bigint) / 100.0 AS discount
    FROM cleansed GROUP BY ALL""",
)
def daily_sales_cleansing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales lines enforced, mapped, derived, and summed by period and category."""
    raw = enforce_schema(daily_sales_text(spark, sf_dir), DAILY_SALES)
    rows = apply_steps(raw, SALES_STEPS).rows
    return rows.groupBy(
        F.col("transaction_year").cast("bigint").alias("transaction_year"),
        F.col("transaction_quarter").cast("bigint").alias("transaction_quarter"),
        "revenue_category",
        "payment_method",
    ).agg(
        F.count(F.lit(1)).alias("sales"),
        F.sum("total_amount").cast("double").alias("revenue"),
        F.sum("discount_amount").cast("double").alias("discount"),
    )


@query(
    "customer_cleansing",
    f"""WITH {CUSTOMERS_SQL}
    SELECT customer_id, upper(trim(customer_name)) AS customer_name, trim(lower(email)) AS email,
           regexp_replace(phone, '[^0-9]', '', 'g') AS phone, city, customer_segment,
           coalesce(cast(is_active AS boolean), true) AS is_active
    FROM customers""",
)
def customer_cleansing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansed_customers(spark, sf_dir)


CUSTOMER_STEPS = [
    {
        "type": "data_quality_checks",
        "checks": [
            {"type": "null_check", "columns": ["customer_id", "customer_name"], "threshold": 0},
            {"type": "duplicate_check", "columns": ["customer_id"], "threshold": 0},
        ],
    },
    {
        "type": "standardization",
        "rules": {
            "customer_name": [{"trim": True}, {"upper_case": True}],
            "email": [{"lower_case": True}, {"trim": True}],
            "phone": [{"regex_replace": {"pattern": "[^0-9]", "replacement": ""}}],
        },
    },
]


def cleansed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_steps(
        enforce_schema(customers_text(spark, sf_dir), CUSTOMERS), CUSTOMER_STEPS
    ).rows


@query(
    "silver_df_transform",
    """SELECT o_orderkey, o_totalprice * 2 AS doubled,
              timestamp '2024-01-15 07:00:00' AS processed_timestamp FROM orders""",
)
def silver_df_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    from stratalake.operators.columns import add_processed_timestamp
    from stratalake.plans.transforms import df_transform

    def enrich(df: DataFrame, factor: int) -> DataFrame:
        doubled = df.select("o_orderkey", (F.col("o_totalprice") * factor).alias("doubled"))
        at = F.lit("2024-01-15 07:00:00").cast("timestamp_ntz")
        return add_processed_timestamp(doubled, at)

    return df_transform(table(spark, sf_dir, "orders"), enrich, factor=2)
