import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stratalake.operators import scd2, splits
from stratalake.sinks.history import HistoryStore
from stratalake.streaming.history import maintain_history
from tests.conftest import FAILURES, rows_of

SPEC = {
    "business_keys": ["id"],
    "tracked_columns": ["a", "b"],
    "update_only_columns": ["u"],
}
FIELDS = "id int, a string, b string, u int"
D1, D2, D3 = "2024-01-01", "2024-02-01", "2024-03-01"
VIEW = ["id", "a", "b", "u", "version", "is_current"]


def load(frame, *rows, at=D1):
    return scd2.initial_load(frame(FIELDS, *rows), SPEC, at)


def invariants(dim, keys=("id",), start="valid_from", end="valid_to"):
    """One current row per key; versions 1..n; intervals half-open, contiguous, not empty."""
    by_key = {}
    for r in dim.collect():
        by_key.setdefault(tuple(r[k] for k in keys), []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.version)
        assert [r.version for r in versions] == list(range(1, len(versions) + 1))
        assert [r.is_current for r in versions] == [False] * (len(versions) - 1) + [True]
        for before, after in zip(versions, versions[1:]):
            assert before[start] < before[end] == after[start]
        assert versions[-1][end] is None


def test_each_case_of_the_merge(frame):
    dim = load(
        frame, (1, "x", "y", 1), (2, "x", "y", 1), (3, "x", "y", 1), (4, "x", "y", 1),
        (5, "x", "y", 1),
    )
    snapshot = frame(
        FIELDS, (1, "x", "y", 1), (2, "z", "y", 1), (3, "x", "y", 9), (4, "z", "y", 9),
        (6, "n", None, 1),
    )
    merged = scd2.merge(dim, snapshot, SPEC, D2)
    assert rows_of(merged, *VIEW) == [
        (1, "x", "y", 1, 1, True),
        (2, "x", "y", 1, 1, False),
        (2, "z", "y", 1, 2, True),
        (3, "x", "y", 9, 1, True),
        (4, "x", "y", 1, 1, False),
        (4, "z", "y", 9, 2, True),
        (5, "x", "y", 1, 1, True),
        (6, "n", None, 1, 1, True),
    ]
    invariants(merged)
    assert rows_of(scd2.merge(merged, snapshot, SPEC, D3)) == rows_of(merged)
    assert merged.schema.names == dim.schema.names


@pytest.mark.parametrize(
    "before, after",
    [((None, "v"), ("v", None)), ((None, None), ("", None)), (("a", "bc"), ("ab", "c")),
     ((None, "v"), ("v", "v")), (("v", "v"), ("v", None))],
)
def test_null_and_swapped_values_are_changes(frame, before, after):
    dim = load(frame, (1, *before, 0))
    merged = scd2.merge(dim, frame(FIELDS, (1, *after, 0)), SPEC, D2)
    assert merged.count() == 2
    invariants(merged)


def test_bad_snapshots_and_times_stop_the_merge(frame):
    dim = load(frame, (1, "x", "y", 1))
    for snapshot in [
        frame(FIELDS, (2, "x", "y", 1), (2, "x", "y", 1)), frame(FIELDS, (None, "x", "y", 1)),
    ]:
        with pytest.raises(FAILURES):
            scd2.merge(dim, snapshot, SPEC, D2).collect()
        with pytest.raises(FAILURES):
            scd2.initial_load(snapshot, SPEC, D1).count()
    changed = frame(FIELDS, (1, "z", "y", 1))
    with pytest.raises(FAILURES):
        scd2.merge(dim, changed, SPEC, D1).count()
    same = frame(FIELDS, (1, "x", "y", 1))
    assert scd2.merge(dim, same, SPEC, D1).count() == 1


def test_columns_outside_the_spec_come_with_the_version(frame):
    fields = FIELDS + ", source_file string"
    dim = scd2.initial_load(frame(fields, (1, "x", "y", 1, "f1"), (2, "x", "y", 1, "f1")), SPEC, D1)
    after = frame(fields, (1, "x", "y", 1, "f2"), (2, "z", "y", 1, "f2"))
    got = rows_of(scd2.merge(dim, after, SPEC, D2), "id", "version", "source_file")
    assert got == [(1, 1, "f1"), (2, 1, "f1"), (2, 2, "f2")]


def test_point_in_time(frame):
    dim = scd2.merge(load(frame, (1, "x", "y", 1)), frame(FIELDS, (1, "z", "y", 1)), SPEC, D2)
    at = lambda when: rows_of(scd2.as_of(dim, SPEC, when), "version")
    assert at("2023-12-31") == [] and at(D1) == [(1,)] and at("2024-01-31 23:59:59") == [(1,)]
    assert at(D2) == [(2,)] and at("2030-01-01") == [(2,)]
    assert rows_of(scd2.current(dim, SPEC), "version") == [(2,)]


def brute_history(feed, update_only):
    """The history of (key, time, order, state, value) rows, one at a time."""
    out, latest = [], {}
    by_key = {}
    for key, time, order, state, value in feed:
        by_key.setdefault(key, {})[time] = max(
            by_key.get(key, {}).get(time, (-1,)), (order, state, value), key=lambda x: x[0]
        )
    for key, moments in by_key.items():
        versions = []
        for time in sorted(moments):
            _, state, value = moments[time]
            if not versions or versions[-1]["state"] != state:
                if versions:
                    versions[-1]["end"] = time
                versions.append({"state": state, "start": time, "end": None, "value": value})
            versions[-1]["value"] = value
        for n, v in enumerate(versions, 1):
            row = (key, v["state"], v["start"], v["end"], n)
            out.append(row + ((v["value"],) if update_only else ()))
    return sorted(out, key=str)


def random_feed(seed, rows=400, hot=1 / 3):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    feed = []
    for order in range(rows):
        key = 0 if rng.random() < hot else rng.randint(1, 9)
        # Half of the rows crowd into one hour, one lies years away: splits of unequal size.
        minutes = rng.randint(0, 60) if rng.random() < 0.5 else rng.randint(0, 50_000)
        if order == 7:
            minutes = 3_000_000
        state = rng.choice([None, "p", "q"])
        feed.append((key, start + timedelta(minutes=minutes), order, state, rng.randint(0, 99)))
    return feed


FEED = "k int, t timestamp_ntz, o int, s string, v int"


@pytest.mark.parametrize("update_only", [False, True])
@pytest.mark.parametrize("seed, rows_per_split", [(1, 10**6), (1, 5), (2, 5), (3, 1), (4, 40)])
def test_history_equals_one_row_at_a_time(frame, seed, rows_per_split, update_only):
    feed = random_feed(seed)
    spec = {"business_keys": ["k"], "tracked_columns": ["s"]}
    spec |= {"update_only_columns": ["v"]} if update_only else {}
    got = scd2.build_history(frame(FEED, *feed), spec, "t", ["o"], rows_per_split)
    columns = ["k", "s", "valid_from", "valid_to", "version"] + (["v"] if update_only else [])
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == brute_history(
        feed, update_only
    )
    invariants(got, ["k"])


@pytest.mark.parametrize("rows_per_split", [10**6, 4])
def test_batches_of_changes_equal_the_whole_feed(frame, rows_per_split):
    spec = {"business_keys": ["k"], "tracked_columns": ["s"], "update_only_columns": ["v"]}
    feed = sorted({(r[0], r[1]): r for r in random_feed(5)}.values(), key=lambda r: r[1])
    whole = scd2.build_history(frame(FEED, *feed), spec, "t", ["o"])
    cut = [feed[:100], feed[100:101], feed[101:300], feed[300:]]
    dim = scd2.build_history(frame(FEED, *cut[0]), spec, "t", ["o"])
    for part in cut[1:]:
        closed, now = dim.filter("NOT is_current"), dim.filter("is_current")
        changed = scd2.apply_changes(now, frame(FEED, *part), spec, "t", ["o"], rows_per_split)
        dim = frame(whole.schema, *closed.unionByName(changed).select(*whole.columns).collect())
    assert rows_of(dim) == rows_of(whole)


@pytest.mark.parametrize("rows_per_split", [10**6, 1])
@pytest.mark.parametrize("early", [datetime(2024, 1, 5), datetime(2023, 1, 5)])
def test_changes_must_come_after_the_current_version(frame, early, rows_per_split):
    spec = {"business_keys": ["k"], "tracked_columns": ["s"]}
    now = scd2.build_history(frame(FEED, (1, datetime(2024, 1, 5), 0, "p", 0)), spec, "t")
    late = frame(FEED, (1, early, 1, "q", 0), (1, datetime(2024, 2, 1), 2, "p", 0))
    with pytest.raises(FAILURES):
        scd2.apply_changes(now, late, spec, "t", ["o"], rows_per_split).collect()


def test_null_keys_and_times_in_a_feed_are_errors(frame):
    spec = {"business_keys": ["k"], "tracked_columns": ["s"]}
    for row in [(None, datetime(2024, 1, 1), 0, "p", 0), (1, None, 0, "p", 0)]:
        with pytest.raises(FAILURES):
            scd2.build_history(frame(FEED, row), spec, "t").collect()


@pytest.mark.parametrize("versions_per_split", [None, 32, 3, 1])
def test_lookup_equals_a_nested_loop(frame, versions_per_split):
    spec = {"business_keys": ["k"], "tracked_columns": ["s"]}
    feed = random_feed(6)
    dim = scd2.build_history(frame(FEED, *feed), spec, "t", ["o"])
    versions = dim.collect()
    rng = random.Random(7)
    moments = [r[1] for r in feed]
    facts = [
        (i, rng.choice([None, *range(12)]),
         rng.choice([None, datetime(2020, 1, 1), datetime(2040, 1, 1), *moments]))
        for i in range(300)
    ]
    expected = []
    for i, k, t in facts:
        hits = [
            v.version for v in versions
            if k is not None and t is not None and v.k == k and v.valid_from <= t
            and (v.valid_to is None or t < v.valid_to)
        ]
        assert len(hits) <= 1
        expected.append((i, hits[0] if hits else None))
    got = scd2.lookup(
        frame("i int, k int, t timestamp_ntz", *facts), dim, spec, "t", ["version"],
        versions_per_split,
    )
    assert sorted(map(tuple, got.select("i", "version").collect())) == expected


def test_lookup_by_dates_and_other_time_types(frame):
    dim = scd2.merge(load(frame, (1, "x", "y", 1)), frame(FIELDS, (1, "z", "y", 1)), SPEC, D2)
    facts = frame("id int, d date", (1, datetime(2024, 1, 5)), (1, datetime(2024, 2, 1)), (2, None))
    facts = facts.withColumn("at", F.col("d").cast("timestamp"))
    got = scd2.lookup(facts, dim, SPEC, "at", ["a"], 1)
    assert rows_of(got, "id", "a") == [(1, "x"), (1, "z"), (2, None)]


def test_store_shows_only_committed_epochs_and_repeats_nothing(spark, frame, tmp_path):
    spec = {"business_keys": ["k"], "tracked_columns": ["s"]}
    store = HistoryStore(spark, f"file://{tmp_path}/dim", spec)
    assert store.latest() is None
    with pytest.raises(ValueError):
        store.read()
    first = scd2.build_history(frame(FEED, (1, datetime(2024, 1, 1), 0, "p", 0)), spec, "t")
    assert store.commit(first, 0) == 1
    second = frame(FEED, (1, datetime(2024, 1, 2), 0, "q", 0), (2, datetime(2024, 1, 2), 0, "q", 0))
    changed = scd2.apply_changes(store.current(), second, spec, "t")
    # A write that died before its commit: its folder is there, its epoch is not.
    changed.write.partitionBy("is_current").parquet(store.folder(1))
    assert rows_of(store.read(), "k", "version") == [(1, 1)]
    assert store.commit(changed, 1) == 3
    assert store.commit(changed, 1) == 0
    assert rows_of(store.read(), "k", "version", "is_current") == [
        (1, 1, False), (1, 2, True), (2, 1, True),
    ]
    assert rows_of(store.current(), "k") == [(1,), (2,)]


def test_frequent_keys_are_cut_along_time_and_order_is_kept(frame):
    feed = [(0, datetime(2024, 1, 1) + timedelta(hours=i), i, "p", 0) for i in range(100)]
    feed += [(1, datetime(2024, 1, 1), 0, "p", 0), (2, datetime(2024, 1, 1), 0, "p", 0)] + [
        (2, datetime(2024, 1, 1), 1, "p", 0) for _ in range(20)
    ]
    df = frame(FEED, *feed)
    cut = splits.with_splits(df, splits.hot_keys(df, ["k"], "t", 10), ["k"], "t")
    parts = [r[splits.SPLIT] for r in cut.filter("k = 0").orderBy("t").collect()]
    assert parts == sorted(parts) and set(parts) == set(range(1, 11))
    assert max(parts.count(p) for p in parts) <= 11
    assert {r[splits.SPLIT] for r in cut.filter("k = 1").collect()} == {0}
    # Rows of one key at one moment cannot be told apart by time: one split.
    assert {r[splits.SPLIT] for r in cut.filter("k = 2").collect()} == {1}
    rare = splits.hot_keys(df, ["k"], "t", 10, share=0.5)
    assert [r.k for r in rare.collect()] == [0]


def test_keys_can_be_cut_along_any_number_or_time(frame):
    df = frame("k int, d date, n decimal(10,2), s string", (1, datetime(2024, 1, 1), None, "x"))
    for column in ("d", "n", "k"):
        assert splits.hot_keys(df, ["k"], column, 0).count() == 1
    with pytest.raises(TypeError):
        splits.hot_keys(df, ["k"], "s", 0)


def test_streams_onto_a_filled_store_skip_and_repeat_nothing(spark, tmp_path):
    spec = {"business_keys": ["k"], "tracked_columns": ["v"]}
    store = HistoryStore(spark, f"file://{tmp_path}/dim", spec)
    fields = "k string, v int, t timestamp_ntz"

    def changes(*rows):
        return spark.sql("SELECT * FROM VALUES " + ", ".join(rows) + " AS c(k, v, t)").to(
            spark.createDataFrame([], fields).schema
        )

    first = changes("('a', 1, timestamp_ntz'2024-01-01')", "('b', 1, timestamp_ntz'2024-01-01')")
    store.commit(scd2.build_history(first, spec, "t"), 0)

    def deliver(rows, checkpoint):
        rows.write.mode("append").parquet(f"file://{tmp_path}/feed-{checkpoint}")
        feed = spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/feed-{checkpoint}")
        maintain_history(feed, store, "t", f"file://{tmp_path}/{checkpoint}").awaitTermination()
        found = store.read().select("k", "v", "version", "is_current").collect()
        return sorted(tuple(r) for r in found)

    news = changes("('a', 2, timestamp_ntz'2024-02-01')", "('c', 1, timestamp_ntz'2024-02-01')")
    after = [("a", 1, 1, False), ("a", 2, 2, True), ("b", 1, 1, True), ("c", 1, 1, True)]
    assert deliver(news, "one") == after
    assert deliver(news, "one") == after  # the same changes again, in a second batch
    assert deliver(news, "two") == after  # and from a stream of another checkpoint
    late = changes("('a', 9, timestamp_ntz'2023-01-01')")
    assert deliver(late, "two") == after
    assert [r.v for r in spark.read.parquet(store.late).collect()] == [9]


def test_a_burst_is_cut_as_finely_as_its_rows_ask_for(spark):
    burst = spark.range(100_000).selectExpr(
        "1 AS k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 0.036) AS t"
    )
    stray = spark.sql("SELECT 1 AS k, timestamp_ntz'1970-01-01' AS t")
    same = spark.range(5000).selectExpr("2 AS k", "timestamp_ntz'2024-01-01' AS t")
    few = spark.range(1000).selectExpr("cast(10 + id % 9 AS int) AS k", "timestamp_ntz'2024-01-01' AS t")
    df = burst.unionAll(stray).unionAll(same).unionAll(few)
    cut = splits.with_splits(df, splits.hot_keys(df, ["k"], "t", 1000), ["k"], "t")
    sizes = cut.groupBy("k", splits.SPLIT).agg(
        F.count("*").alias("n"), F.min("t").alias("low"), F.max("t").alias("high")
    ).collect()
    burst_sizes = sorted((r[splits.SPLIT], r.n, r.low, r.high) for r in sizes if r.k == 1)
    assert len(burst_sizes) > 50 and max(n for _, n, _, _ in burst_sizes) <= 2000
    assert all(a[3] < b[2] for a, b in zip(burst_sizes, burst_sizes[1:], strict=False))
    assert [r.n for r in sizes if r.k == 2] == [5000]
    assert {r[splits.SPLIT] for r in sizes if r.k >= 10} == {0}


def test_frequent_keys_with_many_rows_of_one_time(frame):
    spec = {"business_keys": ["k"], "tracked_columns": ["s"], "update_only_columns": ["v"]}
    times = [datetime(2024, 1, 1) + timedelta(seconds=i // 50) for i in range(400)]
    feed = [(1, t, i, "pq"[i * 7 % 5 % 2], i) for i, t in enumerate(times)]
    feed += [(2, times[0], 3, "p", 1), (2, times[0], 5, None, 2)]
    columns = ["k", "s", "valid_from", "valid_to", "version", "v"]
    for rows_per_split in (10**6, 30, 1):
        got = scd2.build_history(frame(FEED, *feed), spec, "t", ["o"], rows_per_split)
        assert sorted(map(tuple, got.select(*columns).collect()), key=str) == brute_history(feed, True)


def test_lookup_merges_facts_and_versions_without_a_join(frame):
    spec = {"business_keys": ["k"], "tracked_columns": ["s"]}
    dim = scd2.build_history(frame(FEED, *random_feed(6)), spec, "t", ["o"])
    dim = frame(dim.schema, *dim.collect())
    facts = frame("i int, k int, t timestamp_ntz, __at int, version string",
                  *[(i, None, datetime(2024, 1, 1), i, "own") for i in range(50)])
    found = scd2.lookup(facts, dim.withColumnRenamed("version", "ver"), spec, "t", ["ver"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, found.collect())) == [
        (i, None, datetime(2024, 1, 1), i, "own", None) for i in range(50)
    ]
    assert scd2.lookup(facts.limit(0), dim, spec, "t", ["s"]).count() == 0
    assert scd2.lookup(facts, dim.limit(0), spec, "t", ["s"], 1).filter("s IS NULL").count() == 50
