"""Exact nearest vectors by integer inner product, selected with distributed histograms.

Queries form blocks, and every block of them meets every block of candidates; a pair of blocks is
one matrix product inside a task. Scores are never stored. A round counts, for each query, how many
scores fall into each of ``BINS`` equal bins of its interval; summed over all pairs, the counts say
which bin holds the k-th score, and that bin is the next interval. When it is one score wide, or
holds few scores besides the better ones, a last pass keeps the scores that reach it, ranks them
with ties to the smaller identifier, and cuts each pair's share at k before anything moves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.shipping import by_value
from stratalake.llm.common import stage

BINS = 128
#: Rows in a block of queries and in one of candidates.
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 4096
#: An interval is narrow enough once at most this many scores per wanted one reach it.
SLACK = 4


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` in whole numbers, in the cheapest type that holds every partial sum."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if largest < 2**63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise OverflowError("scores beyond 64 bits")


def scaled_vectors(df: DataFrame, factor: int, id_column: str, vector_column: str) -> DataFrame:
    """``id, v``: whole-number vectors of rows whose components are all there and finite."""
    scaled = F.transform(
        vector_column, lambda x: F.floor(F.lit(float(factor)) * x.cast("double")).cast("long")
    )
    sound = F.forall(
        vector_column,
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return df.filter(F.col(id_column).isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(id_column).cast("long").alias("id"), scaled.alias("v"), F.size(vector_column).alias("d")
    )


def packed(ids: np.ndarray, vectors: np.ndarray) -> dict[str, object]:
    """A block as bytes, its numbers in the smallest type that holds them."""
    largest = int(np.abs(vectors).max(initial=0))
    kind = next(t for t in ("<i2", "<i4", "<i8") if largest <= np.iinfo(t).max)
    return {"ids": ids.astype("<i8").tobytes(), "v": vectors.astype(kind).tobytes()}


def unpacked(ids: bytes, vectors: bytes, d: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    size = len(vectors) // max(1, len(names) * d)
    flat = np.frombuffer(vectors, f"<i{size}" if size else "<i8")
    return names, flat.reshape(len(names), d)


def query_block(rows: pd.DataFrame) -> pd.DataFrame:
    block, d = int(rows["block"].iloc[0]), int(rows["d"].iloc[0])
    v = np.concatenate(rows["v"].to_list()).astype(np.int64).reshape(len(rows), d)
    names = rows["id"].to_numpy(np.int64)
    return pd.DataFrame([{"block": block, "d": d, **packed(names, v)}])


def candidate_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("d", pa.int32()), ("c_ids", pa.binary()), ("c_v", pa.binary())])
    for got in batches:
        names, lengths = got["id"].to_numpy(), got["d"].to_numpy()
        flat = got["v"].flatten().to_numpy()
        ends = np.cumsum(lengths)
        for d in np.unique(lengths):
            rows = np.flatnonzero(lengths == d)
            for at in range(0, len(rows), CANDIDATE_BLOCK):
                some = rows[at : at + CANDIDATE_BLOCK]
                take = (ends[some] - d)[:, None] + np.arange(d)
                block = packed(names[some], flat[take])
                row = {"d": int(d), "c_ids": block["ids"], "c_v": block["v"]}
                yield pa.RecordBatch.from_pylist([row], schema)


def count_bins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per query and bin of its interval the scores that one pair of blocks has there."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            names, v = unpacked(row.ids, row.v, row.d)
            others, w = unpacked(row.c_ids, row.c_v, row.d)
            rows = np.searchsorted(names, row.names)
            low, high, width = (np.asarray(x)[:, None] for x in (row.lows, row.highs, row.widths))
            names = names[rows]
            scores = exact_product(v[rows], w)
            inside = (scores >= low) & (scores < high) & (names[:, None] != others[None, :])
            bins = (scores - low) // width + np.arange(len(rows))[:, None] * BINS
            counts = np.bincount(bins[inside], minlength=len(rows) * BINS)
            hit = np.flatnonzero(counts)
            yield pd.DataFrame({"id": names[hit // BINS], "bin": hit % BINS, "n": counts[hit]})


def keep_best(k: int):
    def kept(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                names, v = unpacked(row.ids, row.v, row.d)
                others, w = unpacked(row.c_ids, row.c_v, row.d)
                rows = np.searchsorted(names, row.names)
                names = names[rows]
                scores = exact_product(v[rows], w)
                good = scores >= np.asarray(row.lows)[:, None]
                q, c = np.nonzero(good & (names[:, None] != others[None, :]))
                s = scores[q, c]
                order = np.lexsort((others[c], -s, q))
                q, c, s = q[order], c[order], s[order]
                best = np.arange(len(q)) - np.searchsorted(q, q) < k
                yield pd.DataFrame(
                    {"query_id": names[q[best]], "vec_id": others[c[best]], "score": s[best]}
                )

    return kept


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    factor: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of ``vectors`` for each of ``queries``.

    Components x count as floor(factor * x). A row is no candidate of the query of its own
    identifier. Rows whose vector is null or has a null or non-finite component, or without
    identifier, take no part; a query meets candidates of its own length only; with fewer than
    ``k`` candidates it gets all. A repeated query answers once, a repeated candidate counts as
    often as it is there. Other columns are not read. Empty tables give an empty result.
    """
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    candidates = scaled_vectors(vectors, factor, id_column, vector_column)
    asked = scaled_vectors(queries, factor, id_column, vector_column).dropDuplicates(["id"])
    asked = stage(asked, "queries")
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
    blocks = (
        asked.groupBy("block", "d")
        .applyInPandas(
            by_value(lambda rows: query_block(rows.sort_values("id"))),
            "block long, d int, ids binary, v binary",
        )
    )
    blocks = stage(blocks, "query-blocks")
    stored = candidates.mapInArrow(by_value(candidate_blocks), "d int, c_ids binary, c_v binary")
    stored = stage(
        stored.withColumn("part", F.pmod(F.xxhash64("c_ids"), F.lit(parts))), "candidate-blocks"
    )

    def pairs(state: DataFrame) -> DataFrame:
        """Every block of candidates beside every block of queries that ``state`` has rows of."""
        names = [c for c in ("low", "high", "width") if c in state.columns]
        listed = (
            asked.select("id", "d", "block")
            .join(state, "id")
            .groupBy("block", "d")
            .agg(F.sort_array(F.collect_list(F.struct("id", *names))).alias("s"))
            .select(
                "block",
                "d",
                F.col("s.id").alias("names"),
                *[F.col(f"s.{c}").alias(f"{c}s") for c in names],
            )
        )
        all_parts = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
        return (
            blocks.join(listed, ["block", "d"])
            .withColumn("part", F.explode(all_parts))
            .join(stored, ["part", "d"])
            .drop("part", "block")
        )

    # A score lies within the product of lengths. Interval: low <= score < high.
    norms = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = candidates.groupBy("d").agg(F.sqrt(F.max(norms)).alias("longest"))
    reach = F.ceil(F.sqrt(norms) * F.col("longest")).cast("long") + 1
    state = asked.join(longest, "d").select("id", (-reach).alias("low"), (reach + 1).alias("high"))
    width = F.ceil((F.col("high") - F.col("low")) / F.lit(BINS)).cast("long")
    state = state.select("*", width.alias("width"), F.lit(0).cast("long").alias("above"))
    found_all = None
    state = stage(state, "intervals")
    down = Window.partitionBy("id").orderBy(F.desc("bin"))
    while state.limit(1).count():
        counts = (
            pairs(state)
            .mapInPandas(by_value(count_bins), "id long, bin int, n long")
            .groupBy("id", "bin")
            .agg(F.sum("n").alias("n"))
        )
        reached = (
            counts.join(state.select("id", "above"), "id")
            .withColumn("reached", F.col("above") + F.sum("n").over(down))
            .filter(F.col("reached") >= k)
            .groupBy("id")
            .agg(
                F.max("bin").alias("bin"),
                F.max_by("reached", "bin").alias("reached"),
                F.max_by("n", "bin").alias("n"),
            )
        )
        low = F.col("low") + F.col("bin") * F.col("width")
        step = state.join(reached, "id", "left").select(
            "id",
            F.coalesce(low, F.col("low")).alias("low"),  # fewer than k candidates: all of them
            F.least(F.col("high"), low + F.col("width")).alias("high"),
            (F.col("reached") - F.col("n")).alias("above"),
            (
                F.col("bin").isNull() | (F.col("width") == 1) | (F.col("reached") <= SLACK * k)
            ).alias("done"),
        )
        step = stage(step, "intervals")
        done = step.filter("done").select("id", "low")
        found_all = done if found_all is None else found_all.unionAll(done)
        state = step.filter("not done").select(
            "id", "low", "high", width.alias("width"), "above"
        )
    if found_all is None:
        found_all = state.select("id", "low")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs(found_all)
        .mapInPandas(by_value(keep_best(k)), "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
