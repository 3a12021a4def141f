"""Vantage-point trees against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import vantage_trees

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k):
    found = set()
    for q, v in asked:
        near = sorted(
            (float(np.sqrt(np.add.accumulate((v - w) * (v - w))[-1])), i)
            for i, w in rows if i != q and len(w) == len(v)
        )
        found |= {(q, rank, i, s) for rank, (s, i) in enumerate(near[:k], 1)}
    return found


def clustered(count, dimensions, clusters, seed=5):
    numbers = np.random.default_rng(seed)
    middles = numbers.normal(size=(clusters, dimensions)) * 10
    v = middles[numbers.integers(clusters, size=count)] + numbers.normal(size=(count, dimensions))
    return list(enumerate(v.astype(np.float32)))


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in rows], VECTORS)


def wide(rows):
    return [(i, v.astype(np.float64)) for i, v in rows]


def test_factor_one_is_exact_and_greater_ones_find_most(spark, monkeypatch):
    monkeypatch.setattr(vantage_trees, "SHARD_BYTES", 64 * 8 * 300)  # many shards
    for rows in (clustered(3000, 16, 40), clustered(2500, 64, 1)):
        df = frame(spark, rows).repartition(4)
        asked = [r for r in wide(rows) if r[0] % 50 == 0]
        expected = brute(wide(rows), asked, 10)
        queries = df.filter("vec_id % 50 = 0")
        assert {tuple(r) for r in vantage_trees.nearest(df, queries).collect()} == expected
        for factor in (2.0, 4.0):
            got = vantage_trees.nearest(df, queries, factor=factor).collect()
            pairs = {(r.query_id, r.vec_id) for r in got}
            assert len(pairs & {(q, i) for q, _, i, _ in expected}) >= 0.9 * len(expected)


def test_trees_prune_and_prune_more_when_relaxed():
    rows = clustered(4000, 16, 40)
    ids = np.array([i for i, _ in rows])
    v = np.stack([x for _, x in wide(rows)])
    tree = vantage_trees.grown(ids, v)
    names, vectors = vantage_trees.vectors_of(tree["ids"], tree["v"], 16)
    looked = []
    for factor in (1.0, 3.0):
        best = vantage_trees.Best(ids[:100], v[:100], 10)
        looked.append(vantage_trees.search(
            best, names, vectors, np.frombuffer(tree["vantages"], "<i4"),
            np.frombuffer(tree["bounds"], "<f8").reshape(-1, 4), factor,
        ))
    everything = 100 * len(vantage_trees.halves(len(v))[-1])
    assert looked[1] < looked[0] < everything / 2


def test_equal_vectors_go_by_identifier(spark):
    same = [(i, np.ones(8, np.float32)) for i in range(900)]
    rows = same + [(i + 900, v) for i, v in clustered(100, 8, 3)]
    df = frame(spark, rows)
    asked = [r for r in wide(rows) if r[0] in (0, 450, 950)]
    got = vantage_trees.nearest(df, df.filter("vec_id IN (0, 450, 950)"), k=7).collect()
    assert {tuple(r) for r in got} == brute(wide(rows), asked, 7)


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [0.5, 9.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, None, 1),
        (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [], 1),
        (None, [1.0, 0.0], 1), (8, [3.0, 4.0], 1), (9, [1.0, 2.0, 3.0], 1), (100, [2.0, 0.0], None),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    clash = df.withColumns({c: F.lit(1) for c in ("id", "v", "d", "part", "score", "rank")})
    for given in (df, clash):
        found = vantage_trees.nearest(given, given.filter("vec_id % 100 = 0"), k=3)
        assert sorted(map(tuple, found.collect())) == [
            # Of the two queries 0 the one with the lesser vector, (0.5, 9), counts.
            (0, 1, 8, 31.25**0.5), (0, 2, 1, 64.25**0.5), (0, 3, 1, 64.25**0.5),
            (100, 1, 0, 1.0), (100, 2, 1, 2**0.5), (100, 3, 1, 2**0.5),
        ]
    few = vantage_trees.nearest(df.filter("vec_id IN (8, 100)"), df.filter("vec_id = 100"), k=3)
    assert [tuple(r) for r in few.collect()] == [(100, 1, 8, 17**0.5)]
    assert vantage_trees.nearest(df.limit(0), df).count() == 0
    assert vantage_trees.nearest(df, df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        vantage_trees.nearest(df, df, factor=0.5)


def test_no_copies_of_queries_are_broadcast(spark):
    # a join of few blocks with the shards was planned as a broadcast of a copy for every part.
    df = frame(spark, clustered(500, 8, 3))
    found = vantage_trees.nearest(df, df.filter("vec_id % 20 = 0"), k=5)
    assert "Broadcast" not in found._jdf.queryExecution().toString()


def test_all_groups_meet_all_parts(spark, monkeypatch):
    monkeypatch.setattr(vantage_trees, "SHARD_BYTES", 8 * 8 * 130)
    monkeypatch.setattr(vantage_trees, "QUERY_BLOCK", 16)
    rows = clustered(1500, 8, 1) + [(i + 1500, v) for i, v in clustered(300, 6, 2)]
    df = frame(spark, rows).repartition(3)
    asked = [r for r in wide(rows) if r[0] % 10 == 0]
    expected = brute(wide(rows), asked, 4)
    # One group, some, and as many as there are blocks; parts of one shard and of all.
    for held, there in ((10**9, 1), (9000, 1), (1, 1), (9000, 10**6), (9000, 0)):
        monkeypatch.setattr(vantage_trees, "GROUP_BYTES", held)
        tiling = vantage_trees.tiling
        with monkeypatch.context() as patch:
            patch.setattr(vantage_trees, "tiling", lambda *a, t=there: tiling(*a[:3], a[3] * t, *a[4:]))
            got = vantage_trees.nearest(df, df.filter("vec_id % 10 = 0"), k=4).collect()
        assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_tiles_send_little_and_hold_little():
    # 600 tasks, 1,900 shards of 14.8 million rows and 290 blocks of a hundredth of them.
    there, asked = 14_800_000 * 65, 148_000 * 95
    parts, groups = vantage_trees.tiling(600, 1900, 290, there, asked, 148_000 * 698)
    assert 300 <= parts * groups <= 600 and groups * vantage_trees.GROUP_BYTES >= 148_000 * 698
    assert parts * asked + groups * there < 0.6 * (600 * asked + there)  # against one group
    assert vantage_trees.tiling(8, 3, 2, 10**9, 10, 10) == (3, 2)  # no more than there are pieces
    assert vantage_trees.tiling(8, 0, 0, 0, 0, 0) == (1, 1)
    assert vantage_trees.tiling(200, 50, 5000, 10**6, 10**8, 10**9) == (1, 200)  # many queries


def test_pieces_are_dealt_evenly(spark):
    for wrote, ways in (([200] + [1] * 200, 100), ([8] * 24, 25), ([1] * 30, 6), ([7] * 40, 7)):
        rows = [((task << vantage_trees.ROW_BITS) + i,) for task, n in enumerate(wrote) for i in range(n)]
        df = spark.createDataFrame(rows, "number long")
        way = vantage_trees.dealt(F.col("number"), max(wrote), ways)
        counts = [r["count"] for r in df.groupBy(way.alias("way")).count().collect()]
        assert sum(counts) == len(rows) and max(counts) <= -(-len(rows) // ways) + 2
