"""Schema validation, quality checks, gate and profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.inputs import (
    CUSTOMERS_SQL, DAILY_SALES, EMAIL, SALES_SQL, SALES_STEPS, customers_text, daily_sales_text,
)
from queries.registry import query, table
from stratalake.operators.enforce import enforce_schema
from stratalake.operators.profiles import merged_profile, profile_part
from stratalake.operators.quality import (
    GATES, checked_now, profile_columns, quality_gate, quality_results, quality_summary,
)
from stratalake.operators.validate import validate_schema
from stratalake.session import scratch_dir

RULED = {
    "columns": [
        {"name": "o_orderkey", "type": "long", "nullable": False},
        {"name": "o_totalprice", "type": "decimal(12,2)", "nullable": False,
         "constraints": {"min": 50000, "max": 400000}},
        {"name": "o_orderpriority", "type": "string", "constraints": {"max_length": 8},
         "pattern": "^[1-4]-"},
        {"name": "o_orderdate", "type": "date", "format": "yyyy-MM-dd", "nullable": False},
    ]
}


@query(
    "schema_validation",
    """WITH raw AS (
      SELECT cast(o_orderkey AS varchar) AS o_orderkey, o_totalprice, o_orderpriority,
             CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F'
                  THEN 'not a date' ELSE 'fine' END AS o_orderdate FROM orders),
    counted AS (
      SELECT count(*) FILTER (o_orderkey IS NULL) AS keys,
             count(*) FILTER (o_totalprice < 50000) AS low,
             count(*) FILTER (o_totalprice > 400000) AS high,
             count(*) FILTER (length(o_orderpriority) > 8) AS long,
             count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-4]-')) AS mismatch,
             count(*) FILTER (o_orderdate = 'not a date') AS badcast,
             count(*) FILTER (o_orderdate IS NULL OR o_orderdate = 'not a date') AS nodate
      FROM raw)
    SELECT "column", rule, level, violations, violations = 0 AS passed FROM (
      SELECT 'o_orderkey' AS "column", 'cast' AS rule, 'error' AS level,
             cast(0 AS bigint) AS violations
      UNION ALL SELECT 'o_orderkey', 'not_null', 'error', keys FROM counted
      UNION ALL SELECT 'o_totalprice', 'cast', 'error', 0
      UNION ALL SELECT 'o_totalprice', 'not_null', 'error', 0
      UNION ALL SELECT 'o_totalprice', 'min', 'error', low FROM counted
      UNION ALL SELECT 'o_totalprice', 'max', 'error', high FROM counted
      UNION ALL SELECT 'o_orderpriority', 'cast', 'error', 0
      UNION ALL SELECT 'o_orderpriority', 'max_length', 'error', long FROM counted
      UNION ALL SELECT 'o_orderpriority', 'pattern', 'warning', mismatch FROM counted
      UNION ALL SELECT 'o_orderdate', 'cast', 'error', badcast FROM counted
      UNION ALL SELECT 'o_orderdate', 'not_null', 'error', nodate FROM counted)""",
)
def schema_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules of a text source in one aggregate: casts, nulls, ranges, lengths, patterns."""
    status = F.col("o_orderstatus")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("o_totalprice"),
        "o_orderpriority",
        F.when(status == "P", None).when(status == "F", "not a date").otherwise(day).alias(
            "o_orderdate"
        ),
    )
    return validate_schema(text, RULED, untyped=True)


@query(
    "schema_structure",
    """SELECT * FROM (VALUES
      ('c_custkey', 'type', 'error', cast(0 AS bigint), true),
      ('c_name', 'type', 'error', 1, false),
      ('c_acctbal', 'type', 'error', 0, true),
      ('c_nationkey', 'type', 'error', 0, true),
      ('c_phone', 'missing', 'error', 1, false),
      ('c_mktsegment', 'unexpected', 'warning', 1, false),
      ('c_custkey', 'not_null', 'error', (SELECT count(*) FROM customer WHERE c_custkey IS NULL),
       true)) AS t("column", rule, level, violations, passed)""",
)
def schema_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A typed source against its declaration: types, missing and undeclared columns."""
    schema = {
        "columns": [
            {"name": "c_custkey", "type": "long", "nullable": False},
            {"name": "c_name", "type": "date"},
            {"name": "c_acctbal", "type": "double"},
            {"name": "c_nationkey", "type": "integer"},
            {"name": "c_phone", "type": "string", "nullable": False},
            {"name": "c_fax", "type": "string"},
        ]
    }
    return validate_schema(table(spark, sf_dir, "customer"), schema, strict=True)


@query(
    "dq_null_check",
    f"""WITH {CUSTOMERS_SQL},
    n AS (SELECT count(*) AS total, count(*) FILTER (email IS NULL) AS e,
                 count(*) FILTER (is_active IS NULL) AS a FROM customers)
    SELECT 'strict' AS check_name, 'null_check' AS check_type, e + a = 0 AS passed,
           total AS records_checked, e + a AS records_failed,
           nullif(concat_ws(',', CASE WHEN e > 0 THEN 'email' END,
                                 CASE WHEN a > 0 THEN 'is_active' END), '') AS failed_columns,
           '{{"customer_id":0,"email":' || e || ',"is_active":' || a || '}}' AS details FROM n
    UNION ALL
    SELECT 'lenient', 'null_check', e * 100.0 / total <= 10 AND a * 100.0 / total <= 10,
           total, e + a,
           nullif(concat_ws(',', CASE WHEN e * 100.0 / total > 10 THEN 'email' END,
                                 CASE WHEN a * 100.0 / total > 10 THEN 'is_active' END), ''),
           '{{"email":' || e || ',"is_active":' || a || '}}' FROM n""",
)
def dq_null_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        {"name": "strict", "type": "null_check", "columns": ["customer_id", "email", "is_active"]},
        {"name": "lenient", "type": "null_check", "columns": ["email", "is_active"],
         "threshold": 10},
    ]
    return quality_results(customers_text(spark, sf_dir), checks)


@query(
    "dq_duplicate_check",
    """WITH k AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber),
    d AS (SELECT cast(sum(n) AS bigint) AS total, count(*) AS keys FROM k)
    SELECT 'lines' AS check_name, total = keys AS passed, total AS records_checked,
           total - keys AS records_failed,
           '{"total_rows":' || total || ',"distinct_rows":' || keys || ',"duplicate_count":'
             || (total - keys) || '}' AS details FROM d
    UNION ALL
    SELECT 'lines tolerated', true, total, total - keys,
           '{"total_rows":' || total || ',"distinct_rows":' || keys || ',"duplicate_count":'
             || (total - keys) || '}' FROM d""",
)
def dq_duplicate_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thresholds on one key: one grouping serves both."""
    keys = ["l_orderkey", "l_linenumber"]
    checks = [
        {"name": "lines", "type": "duplicate_check", "columns": keys},
        {"name": "lines tolerated", "type": "duplicate_check", "columns": keys,
         "threshold": 10**15},
    ]
    kept = ["check_name", "passed", "records_checked", "records_failed", "details"]
    return quality_results(table(spark, sf_dir, "lineitem"), checks).select(*kept)


@query(
    "dq_range_check",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_quantity < 5) AS low,
      count(*) FILTER (l_quantity > 45) AS high,
      count(*) FILTER (l_quantity <= 1) AS low_open,
      count(*) FILTER (l_discount < 0) AS neg FROM lineitem)
    SELECT 'closed' AS check_name, low + high = 0 AS passed, n AS records_checked,
           low + high AS records_failed,
           '{"below":' || low || ',"above":' || high || '}' AS details FROM c
    UNION ALL SELECT 'open', low_open = 0, n, low_open, '{"below":' || low_open || '}' FROM c
    UNION ALL SELECT 'discount', neg = 0, n, neg, '{"below":' || neg || '}' FROM c""",
)
def dq_range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        {"name": "closed", "type": "range_check", "column": "l_quantity", "min": 5, "max": 45},
        {"name": "open", "type": "range_check", "column": "l_quantity", "min": 1,
         "inclusive": False},
        {"name": "discount", "type": "range_check", "column": "l_discount", "min": 0},
    ]
    kept = ["check_name", "passed", "records_checked", "records_failed", "details"]
    return quality_results(table(spark, sf_dir, "lineitem"), checks).select(*kept)


@query(
    "dq_pattern_check",
    f"""WITH {CUSTOMERS_SQL},
    c AS (SELECT count(*) AS n,
      count(*) FILTER (NOT regexp_matches(trim(email), '{EMAIL}')) AS bad,
      count(*) FILTER (NOT regexp_matches(customer_id, '[0-9]')) AS none FROM customers)
    SELECT 'email' AS check_name, bad = 0 AS passed, n AS records_checked, bad AS records_failed
    FROM c UNION ALL SELECT 'id', none = 0, n, none FROM c""",
)
def dq_pattern_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        {"name": "email", "type": "pattern_check", "column": "email", "pattern": EMAIL},
        {"name": "id", "type": "pattern_check", "column": "customer_id", "pattern": "[0-9]"},
    ]
    rows = customers_text(spark, sf_dir).withColumn("email", F.trim("email"))
    kept = ["check_name", "passed", "records_checked", "records_failed"]
    return quality_results(rows, checks).select(*kept)


@query(
    "dq_custom_sql",
    """WITH c AS (SELECT count(*) AS n,
      count(*) FILTER (NOT (o_totalprice < 450000 OR o_orderpriority = '1-URGENT')) AS bad,
      count(*) FILTER (NOT (nullif(o_orderstatus, 'P') <> 'F')) AS f FROM orders)
    SELECT 'large orders are urgent' AS check_name, bad = 0 AS passed, n AS records_checked,
           bad AS records_failed FROM c
    UNION ALL SELECT 'null passes', f = 0, n, f FROM c""",
)
def dq_custom_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        {"name": "large orders are urgent", "type": "custom_sql",
         "condition": "o_totalprice < 450000 OR o_orderpriority = '1-URGENT'"},
        {"name": "null passes", "type": "custom_sql",
         "condition": "nullif(o_orderstatus, 'P') <> 'F'"},
    ]
    kept = ["check_name", "passed", "records_checked", "records_failed"]
    return quality_results(table(spark, sf_dir, "orders"), checks).select(*kept)


SALES_CHECKS = SALES_STEPS[0]["checks"] + [
    {"type": "custom_sql", "condition": "unit_price * quantity >= total_amount"},
    {"type": "range_check", "column": "no_such_column", "min": 0},
    {"type": "spell_check", "columns": ["store_location"]},
]
# Null, duplicate and range verdicts, then the SQL check, then two that cannot run and so fail.
SALES_VERDICTS = f"""WITH {SALES_SQL},
    v AS (SELECT count(*) AS n, count(DISTINCT transaction_id) AS keys,
                 count(*) FILTER (unit_cents * quantity < total_cents) AS odd FROM sales),
    verdicts AS (
      SELECT 2 + cast(n = keys AS int) + cast(odd = 0 AS int) AS good, n FROM v)"""


def sales_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enforce_schema(daily_sales_text(spark, sf_dir), DAILY_SALES)
    return quality_results(rows, SALES_CHECKS)


@query(
    "dq_summary",
    f"""{SALES_VERDICTS}
    SELECT cast(6 AS bigint) AS total_checks, cast(good AS bigint) AS passed_checks,
           cast(6 - good AS bigint) AS failed_checks, n AS total_rows, good = 6 AS passed
    FROM verdicts""",
)
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_summary(sales_results(spark, sf_dir))


@query(
    "dq_gate",
    f"""{SALES_VERDICTS}
    SELECT 'dev' AS environment, cast(6 AS bigint) AS total_checks,
           cast(6 - good AS bigint) AS failed_checks, cast(10 AS bigint) AS max_error_threshold,
           6 - good <= 10 AS passed FROM verdicts
    UNION ALL SELECT 'test', 6, 6 - good, 5, 6 - good <= 5 FROM verdicts
    UNION ALL SELECT 'prod', 6, 6 - good, 0, 6 - good <= 0 FROM verdicts""",
)
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gates of three environments over one set of results, a row per check, found once."""
    rows = enforce_schema(daily_sales_text(spark, sf_dir), DAILY_SALES)
    results = checked_now(rows, SALES_CHECKS)
    gates = [
        quality_gate(results, gate["max_error_threshold"]).select(
            F.lit(name).alias("environment"), "*"
        )
        for name, gate in GATES.items()
    ]
    return reduce(DataFrame.unionAll, gates)


@query(
    "profile_columns",
    "WITH "
    + CUSTOMERS_SQL
    + " UNION ALL ".join(
        f""" SELECT '{c}' AS column_name, count(*) AS row_count,
        count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count,
        cast(min({c}) AS varchar) AS min_value, cast(max({c}) AS varchar) AS max_value,
        {mean} AS mean_value FROM {t}"""
        for c, t, mean in [
            ("email", "customers", "cast(NULL AS double)"),
            ("is_active", "customers", "cast(NULL AS double)"),
            ("customer_segment", "customers", "cast(NULL AS double)"),
            ("customer_number", "(SELECT *, cast(customer_id AS bigint) AS customer_number"
             " FROM customers)", "avg(customer_number)"),
        ]
    ),
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = customers_text(spark, sf_dir)
    rows = rows.withColumn("customer_number", F.col("customer_id").cast("bigint"))
    columns = ["email", "is_active", "customer_segment", "customer_number"]
    return profile_columns(rows, columns, exact=True)


PROFILED = ["o_totalprice", "o_custkey", "o_orderpriority"]


@query(
    "profile_merged",
    "WITH g AS (SELECT 1.01::DOUBLE / 0.99::DOUBLE AS growth), "
    + ", ".join(
        f"""b_{c} AS (SELECT bucket, sum(n) OVER (ORDER BY bucket) AS reached, sum(n) OVER () AS total
        FROM (SELECT CASE WHEN {c} = 0 THEN -1000000
                ELSE cast(ceil(ln({c}::DOUBLE) / ln(growth)) AS bigint) END AS bucket, count(*) AS n
              FROM orders, g WHERE {c} IS NOT NULL GROUP BY 1))"""
        for c in PROFILED[:2]
    )
    + " UNION ALL ".join(
        f""" SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
        true AS distinct_near, NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text,
        min({c})::DOUBLE AS min_number, max({c})::DOUBLE AS max_number,
        round(avg({c}::DOUBLE), 3) AS mean, """
        + ", ".join(
            f"""(SELECT CASE WHEN min(bucket) = -1000000 THEN 0
              ELSE round(2 * pow(max(growth), min(bucket)) / (max(growth) + 1), 3) END FROM b_{c}, g
            WHERE reached >= ceil(total * {q})) AS {label}"""
            for q, label in [("0.5::DOUBLE", "median"), ("0.99::DOUBLE", "p99")]
        )
        + " FROM orders"
        for c in PROFILED[:2]
    )
    + """ UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority), true,
        min(o_orderpriority), max(o_orderpriority), NULL, NULL, NULL, NULL, NULL FROM orders""",
)
def merged_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads are profiled as they come, their profiles stored and merged without their rows."""
    orders, path = table(spark, sf_dir, "orders"), scratch_dir(spark, "profiles")
    for load in range(3):
        rows = orders.filter(F.pmod(F.year("o_orderdate"), F.lit(3)) == load)
        profile_part(rows, PROFILED, f"load {load}").write.mode("append").parquet(path)
    merged = merged_profile(spark.read.parquet(path), (0.5, 0.99))
    exact = profile_columns(orders, PROFILED, exact=True).select(
        "column_name", F.col("distinct_count").alias("exact")
    )
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * 0.06
    return merged.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", near.alias("distinct_near"), "min_text", "max_text",
        "min_number", "max_number", F.round("mean", 3).alias("mean"),
        F.round(F.col("quantiles")[0], 3).alias("median"),
        F.round(F.col("quantiles")[1], 3).alias("p99"),
    )
