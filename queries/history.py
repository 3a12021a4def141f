"""Type-2 dimensions: loads, merges, point in time, lookups, history from a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import query, table
from stratalake.operators import scd2
from stratalake.session import scratch_dir
from stratalake.sinks.history import HistoryStore
from stratalake.streaming.history import maintain_history

SPEC = {
    "type": "scd_type_2",
    "business_keys": ["customer_id"],
    "tracked_columns": ["customer_name", "email", "customer_segment"],
    "update_only_columns": ["balance"],
    "scd_columns": {
        "valid_from": "valid_from_date",
        "valid_to": "valid_to_date",
        "is_current": "is_current_flag",
        "version": "record_version",
        "hash": "record_hash",
    },
}
FIRST, SECOND, THIRD = "2024-01-01 00:00:00", "2024-06-01 00:00:00", "2024-09-01 00:00:00"
TIME = "timestamp_ntz"


def first_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of all nations but one, which arrive later."""
    return customers(spark, sf_dir, "c_nationkey <> 3")


def customers(spark: SparkSession, sf_dir: str, present: str = "true") -> DataFrame:
    rich = F.col("c_acctbal") >= 0
    return table(spark, sf_dir, "customer").filter(present).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(rich, F.concat("c_mktsegment", F.lit("@example.com"))).alias("email"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("c_acctbal").alias("balance"),
    )


def second_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nation new, one absent; wealth changes segment, debt gains an email, all balances grow."""
    wealthy, debt = F.col("c_acctbal") > 5000, F.col("c_acctbal") < 0
    email = F.concat("c_mktsegment", F.lit("@example.com"))
    return table(spark, sf_dir, "customer").filter("c_nationkey <> 5").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(debt, "late@example.com").otherwise(email).alias("email"),
        F.when(wealthy, "PREMIUM").otherwise(F.col("c_mktsegment")).alias("customer_segment"),
        (F.col("c_acctbal") + 1).alias("balance"),
    )


HASH = """sha256(concat(
  coalesce(length(customer_name) || ':' || customer_name, 'N'),
  coalesce(length(email) || ':' || email, 'N'),
  coalesce(length(customer_segment) || ':' || customer_segment, 'N')))"""
SNAPSHOTS = f"""
first_raw AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         CASE WHEN c_acctbal >= 0 THEN c_mktsegment || '@example.com' END AS email,
         c_mktsegment AS customer_segment, c_acctbal AS balance
  FROM customer WHERE c_nationkey <> 3),
first AS (SELECT *, {HASH} AS record_hash FROM first_raw),
second_raw AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         CASE WHEN c_acctbal < 0 THEN 'late@example.com'
              ELSE c_mktsegment || '@example.com' END AS email,
         CASE WHEN c_acctbal > 5000 THEN 'PREMIUM' ELSE c_mktsegment END AS customer_segment,
         c_acctbal + 1 AS balance
  FROM customer WHERE c_nationkey <> 5),
second AS (SELECT *, {HASH} AS record_hash FROM second_raw),
dim AS (
  SELECT f.customer_id, f.customer_name, f.email, f.customer_segment,
         CASE WHEN s.customer_id IS NOT NULL AND s.record_hash = f.record_hash
              THEN s.balance ELSE f.balance END AS balance,
         timestamp '{FIRST}' AS valid_from_date,
         CASE WHEN s.record_hash <> f.record_hash THEN timestamp '{SECOND}' END AS valid_to_date,
         s.customer_id IS NULL OR s.record_hash = f.record_hash AS is_current_flag,
         1 AS record_version, f.record_hash
  FROM first f LEFT JOIN second s ON f.customer_id = s.customer_id
  UNION ALL
  SELECT s.customer_id, s.customer_name, s.email, s.customer_segment, s.balance,
         timestamp '{SECOND}', NULL, true,
         CASE WHEN f.customer_id IS NULL THEN 1 ELSE 2 END, s.record_hash
  FROM second s LEFT JOIN first f ON f.customer_id = s.customer_id
  WHERE f.customer_id IS NULL OR s.record_hash <> f.record_hash)"""


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.initial_load(first_snapshot(spark, sf_dir), SPEC, FIRST, TIME)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.merge(loaded(spark, sf_dir), second_snapshot(spark, sf_dir), SPEC, SECOND)


@query(
    "scd2_initial_load",
    f"""WITH everyone AS (
      SELECT c_custkey AS customer_id, c_name AS customer_name,
             CASE WHEN c_acctbal >= 0 THEN c_mktsegment || '@example.com' END AS email,
             c_mktsegment AS customer_segment, c_acctbal AS balance
      FROM customer)
    SELECT customer_id, customer_name, email, customer_segment, balance,
           timestamp '{FIRST}' AS valid_from_date, cast(NULL AS timestamp) AS valid_to_date,
           true AS is_current_flag, 1 AS record_version, {HASH} AS record_hash FROM everyone""",
)
def scd2_initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.initial_load(customers(spark, sf_dir), SPEC, FIRST, TIME)


@query("scd2_merge", f"WITH {SNAPSHOTS} SELECT * FROM dim")
def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir)


@query(
    "scd2_update_only",
    f"""WITH {SNAPSHOTS}
    SELECT d.customer_id, d.record_version, d.is_current_flag, d.valid_from_date, d.valid_to_date,
           CASE WHEN d.is_current_flag AND s.customer_id IS NOT NULL THEN s.balance * 2
                ELSE d.balance END AS balance
    FROM dim d LEFT JOIN second s ON d.customer_id = s.customer_id""",
)
def scd2_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third snapshot in which only balances differ opens no version."""
    third = second_snapshot(spark, sf_dir).withColumn("balance", F.col("balance") * 2)
    dim = scd2.merge(merged(spark, sf_dir), third, SPEC, THIRD)
    return dim.select("customer_id", "record_version", "is_current_flag", "valid_from_date",
                      "valid_to_date", "balance")


@query(
    "scd2_current",
    f"""WITH {SNAPSHOTS}
    SELECT customer_id, customer_segment, record_version FROM dim WHERE is_current_flag""",
)
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = scd2.current(merged(spark, sf_dir), SPEC)
    return dim.select("customer_id", "customer_segment", "record_version")


@query(
    "scd2_as_of",
    f"""WITH {SNAPSHOTS}
    SELECT 'before' AS moment, customer_id, record_version FROM dim
    WHERE valid_from_date <= timestamp '2024-03-15' AND
          (valid_to_date IS NULL OR timestamp '2024-03-15' < valid_to_date)
    UNION ALL
    SELECT 'at the change', customer_id, record_version FROM dim
    WHERE valid_from_date <= timestamp '{SECOND}' AND
          (valid_to_date IS NULL OR timestamp '{SECOND}' < valid_to_date)""",
)
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = merged(spark, sf_dir)
    kept = ["customer_id", "record_version"]
    before = scd2.as_of(dim, SPEC, "2024-03-15 00:00:00").select(F.lit("before").alias("moment"), *kept)
    change = scd2.as_of(dim, SPEC, SECOND).select(F.lit("at the change").alias("moment"), *kept)
    return before.unionAll(change)


FEED_SPEC = {
    "business_keys": ["user_id"],
    "tracked_columns": ["event_type"],
    "update_only_columns": ["value"],
}
# The plain formulation: one window per user over all of the user's rows.
HISTORY_SQL = """
marked AS (
  SELECT *, CASE WHEN row_number() OVER w = 1
                   OR event_type IS DISTINCT FROM lag(event_type) OVER w
                 THEN 1 ELSE 0 END AS opens
  FROM feed WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (
  SELECT *, cast(sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS integer) AS version
  FROM marked),
runs AS (
  SELECT user_id, event_type, version, max_by(value, ts) AS value, min(ts) AS valid_from
  FROM numbered GROUP BY user_id, event_type, version),
history AS (
  SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY version) AS valid_to FROM runs)"""
FULL_HISTORY = """SELECT user_id, event_type, value, valid_from, valid_to,
  valid_to IS NULL AS is_current, version,
  sha256(length(event_type) || ':' || event_type) AS hash FROM history"""


@query("scd2_build_history", f"WITH feed AS (SELECT * FROM events), {HISTORY_SQL} {FULL_HISTORY}")
def scd2_build_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.build_history(table(spark, sf_dir, "events"), FEED_SPEC, "ts", ["event_id"])


@query(
    "scd2_build_history_split",
    f"WITH feed AS (SELECT * FROM events), {HISTORY_SQL} {FULL_HISTORY}",
)
def scd2_build_history_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every user's rows cut into several splits."""
    events = table(spark, sf_dir, "events")
    return scd2.build_history(events, FEED_SPEC, "ts", ["event_id"], rows_per_split=20)


LOOKUP_SQL = f"""WITH feed AS (SELECT * FROM events WHERE event_type <> 'error'), {HISTORY_SQL}
    SELECT e.event_id, e.user_id, e.ts, h.event_type AS doing, h.version AS doing_version
    FROM events e LEFT JOIN history h ON e.user_id = h.user_id AND h.valid_from <= e.ts
      AND (h.valid_to IS NULL OR e.ts < h.valid_to)"""


@query("scd2_fact_lookup", LOOKUP_SQL)
def scd2_fact_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each user was doing last, at the time of every event; errors are no doing."""
    return doing_at_events(spark, sf_dir, rows_per_split=1_000_000)


@query("scd2_fact_lookup_split", LOOKUP_SQL)
def scd2_fact_lookup_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every user's facts and versions cut into several splits."""
    return doing_at_events(spark, sf_dir, rows_per_split=20)


def doing_at_events(spark: SparkSession, sf_dir: str, rows_per_split: int) -> DataFrame:
    events = table(spark, sf_dir, "events")
    doing = scd2.build_history(
        events.filter("event_type <> 'error'"),
        {"business_keys": ["user_id"], "tracked_columns": ["event_type"]},
        "ts",
        ["event_id"],
    )
    dim = doing.withColumnsRenamed({"event_type": "doing", "version": "doing_version"})
    facts = events.select("event_id", "user_id", "ts")
    return scd2.lookup(facts, dim, FEED_SPEC, "ts", ["doing", "doing_version"], rows_per_split)


@query("stream_scd2", f"WITH feed AS (SELECT * FROM events), {HISTORY_SQL} {FULL_HISTORY}")
def stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, kept up by a stream that sees the feed arrive in three parts."""
    events = table(spark, sf_dir, "events")
    folder = scratch_dir(spark, "stream-scd2")
    store = HistoryStore(spark, f"{folder}/dim", FEED_SPEC)
    parts = ["ts < '2024-01-08'", "ts >= '2024-01-08' AND ts < '2024-01-21'", "ts >= '2024-01-21'"]
    for part in parts:
        events.filter(part).write.mode("append").parquet(f"{folder}/feed")
        feed = spark.readStream.schema(events.schema).parquet(f"{folder}/feed")
        maintain_history(feed, store, "ts", f"{folder}/checkpoint", ["event_id"]).awaitTermination()
    columns = ["user_id", "event_type", "value", "valid_from", "valid_to", "is_current", "version"]
    return store.read().select(*columns, "hash")
