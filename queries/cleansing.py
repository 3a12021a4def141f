"""Whole cleansing runs: from a stored table through checks and steps to a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.columns import CUSTOMER_STEPS
from queries.inputs import (
    CUSTOMERS, CUSTOMERS_SQL, DAILY_SALES, SALES_SQL, SALES_STEPS, customers_text,
    daily_sales_text,
)
from queries.registry import query
from queries.storage import target
from stratalake.operators.enforce import enforce_schema
from stratalake.plans.cleansing import run_cleansing
from stratalake.session import scratch_dir
from stratalake.sinks.history import HistoryStore
from stratalake.sinks.tables import replace_table_as, table_name, write_table

FIRST, SECOND = "2024-01-01 00:00:00", "2024-06-01 00:00:00"
CAPTURE = {
    "type": "scd_type_2",
    "business_keys": ["customer_id"],
    "tracked_columns": ["customer_name", "email", "customer_segment"],
    "scd_columns": {"version": "record_version"},
}


def cleansed_sales(spark: SparkSession, sf_dir: str) -> tuple[dict, dict]:
    """The stored sales and the verdicts on them."""
    folder = scratch_dir(spark, "cleansing-sales")
    source, sales = target(folder, "raw_sales"), target(folder, "sales")
    verdicts = target(folder, "verdicts")
    write_table(enforce_schema(daily_sales_text(spark, sf_dir), DAILY_SALES), source)
    definition = {
        "source": source,
        "target": sales,
        "transformations": SALES_STEPS,
        "write_mode": "overwrite",
        "partition_by": ["transaction_year", "transaction_month"],
    }
    run_cleansing(spark, definition, quality_table=verdicts, batch_id="b1", environment="dev")
    return sales, verdicts


@query(
    "cleansing_sales",
    f"""WITH {SALES_SQL}
    SELECT transaction_id, year(transaction_date) AS transaction_year,
           month(transaction_date) AS transaction_month,
           CASE WHEN payment_method IN ('1-URGENT', '2-HIGH') THEN 'Fast'
                WHEN payment_method = '4-NOT SPECIFIED' THEN 'Unknown'
                ELSE payment_method END AS payment_method,
           CASE WHEN store_location IN ('F', 'O') THEN 'Settled' ELSE store_location END
             AS store_location,
           CASE WHEN total_cents >= 100000 THEN 'High Value'
                WHEN total_cents >= 10000 THEN 'Medium Value' ELSE 'Low Value' END
             AS revenue_category,
           total_cents / 100.0 AS total_amount
    FROM sales""",
)
def cleansing_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales checked, mapped, derived and stored by year and month."""
    sales, _ = cleansed_sales(spark, sf_dir)
    return spark.table(table_name(sales)).select(
        "transaction_id",
        F.col("transaction_year").cast("bigint").alias("transaction_year"),
        F.col("transaction_month").cast("bigint").alias("transaction_month"),
        "payment_method",
        "store_location",
        "revenue_category",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


@query(
    "cleansing_verdicts",
    f"""WITH {SALES_SQL},
    counts AS (
      SELECT count(*) AS n,
             count(*) FILTER (transaction_id IS NULL OR customer_id IS NULL
                              OR product_code IS NULL) AS missing,
             count(*) - count(DISTINCT transaction_id) AS repeated,
             count(*) FILTER (total_cents < 0) AS negative
      FROM sales),
    found AS (
      SELECT 'null_check' AS check_type, missing AS failed, n FROM counts
      UNION ALL SELECT 'duplicate_check', repeated, n FROM counts
      UNION ALL SELECT 'range_check', negative, n FROM counts)
    SELECT check_type, CASE WHEN failed = 0 THEN 'passed' ELSE 'failed' END AS status,
           n AS records_checked, failed AS records_failed, 'b1' AS batch_id, 'dev' AS environment
    FROM found""",
)
def cleansing_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checks of the same run left in the quality table."""
    _, verdicts = cleansed_sales(spark, sf_dir)
    return spark.table(table_name(verdicts)).select(
        "check_type", "status", "records_checked", "records_failed", "batch_id", "environment"
    )


@query(
    "cleansing_history",
    f"""WITH {CUSTOMERS_SQL},
    cleansed AS (
      SELECT customer_id, upper(trim(customer_name)) AS customer_name,
             trim(lower(email)) AS email, customer_segment,
             coalesce(cast(is_active AS boolean), true) AS active
      FROM customers)
    SELECT customer_id, customer_name, email, customer_segment, 1 AS record_version,
           timestamp '{FIRST}' AS valid_from,
           CASE WHEN active THEN timestamp '{SECOND}' END AS valid_to, NOT active AS is_current
    FROM cleansed
    UNION ALL
    SELECT customer_id, customer_name, email, 'PREMIUM', 2, timestamp '{SECOND}', NULL, true
    FROM cleansed WHERE active""",
)
def cleansing_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers checked, cleaned and kept as a Type-2 dimension over two snapshots."""
    folder = scratch_dir(spark, "cleansing-customers")
    source = target(folder, "raw_customers")
    definition = {
        "source": source,
        "target": {"path": f"{folder}/customers"},
        "transformations": CUSTOMER_STEPS,
        "change_data_capture": CAPTURE,
    }
    raw = enforce_schema(customers_text(spark, sf_dir), CUSTOMERS)
    upgraded = F.when(F.col("is_active"), "PREMIUM").otherwise(F.col("customer_segment"))
    snapshots = {FIRST: raw, SECOND: raw.withColumn("customer_segment", upgraded)}
    for taken, rows in snapshots.items():
        replace_table_as(rows, source)
        run_cleansing(spark, definition, as_of=taken, environment="prod")
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("valid_from", "valid_to")]
    kept = [*CAPTURE["business_keys"], *CAPTURE["tracked_columns"], "record_version", "is_current"]
    return HistoryStore(spark, f"{folder}/customers", CAPTURE).read().select(*kept, *times)
