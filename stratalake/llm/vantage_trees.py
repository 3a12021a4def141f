"""Nearest vectors by Euclidean distance, searched in one vantage-point tree per shard.

A shard is a bounded run of rows as a task reads them, so no key decides its size. Its tree halves
the rows again and again by their distance to a vantage point, by rank instead of by value, so equal
vectors split, too. A node keeps the least and greatest distance of either half. By the triangle
inequality no row of a half is nearer to a query than the gap between the query's distance and
these bounds; the half is skipped if ``factor`` times the gap exceeds the query's k-th distance so
far. Factor one is exact, greater ones skip more. Every block of queries meets every shard: blocks
are dealt into groups and shards into parts, and a task gets one group and one part. It holds the
group's best rows from shard to shard, so each further tree prunes with what is known.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.shipping import by_value
from stratalake.llm.common import stage

#: Rows of a tree's leaf and of a block of queries; bytes of a shard's components.
LEAF, QUERY_BLOCK, SHARD_BYTES = 64, 512, 4_000_000
#: Bytes of the queries and their best rows in a group, which a task holds at once.
GROUP_BYTES = 64_000_000
#: Bits of ``monotonically_increasing_id`` that number the rows of a task.
ROW_BITS = 33
#: Room for rounding, relative to the numbers that a bound is made of.
ROUNDING = 1e-9


def sound_vectors(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, v, d`` of the rows that take part."""
    v = F.transform(vector_column, lambda x: x.cast("double"))
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return (
        df.select(F.col(id_column).cast("long").alias("id"), v.alias("v"))
        .filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
        .filter(F.exists("v", lambda x: x != 0.0))
        .withColumn("d", F.size("v"))
    )


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, squares added from the first component to the last, as SQL would."""
    gap = a - b
    return np.sqrt(np.add.accumulate(gap * gap, axis=1)[:, -1])


def halves(rows: int) -> list[list[tuple[int, int]]]:
    """The runs of rows at each level of a tree, the last one being its leaves."""
    levels = [[(0, rows)]]
    while max(end - start for start, end in levels[-1]) > LEAF:
        levels.append([
            run
            for start, end in levels[-1]
            for run in ((start, (start + end) // 2), ((start + end) // 2, end))
        ])
    return levels


def packed(v: np.ndarray) -> bytes:
    """Components in four bytes each where that loses nothing, else in eight."""
    with np.errstate(over="ignore"):
        short = v.astype("<f4")
    return (short if (short == v).all() else v.astype("<f8")).tobytes()


def grown(ids: np.ndarray, v: np.ndarray) -> dict[str, bytes]:
    """A tree: rows in its order, a vantage row per node and the bounds of the node's halves."""
    order = np.arange(len(v))
    vantages, bounds = [], []
    for runs in halves(len(v))[:-1]:
        for start, end in runs:
            rows = order[start:end]
            corner = rows[np.argmax(distances(v[rows], v[rows[:1]]))]
            far = distances(v[rows], v[corner][None, :])
            by_distance = np.argsort(far, kind="stable")
            order[start:end] = rows[by_distance]
            far = far[by_distance]
            middle = (end - start) // 2
            vantages.append(corner)
            bounds.append((far[0], far[middle - 1], far[middle], far[-1]))
    place = np.empty(len(v), np.int32)
    place[order] = np.arange(len(v), dtype=np.int32)
    return {
        "ids": ids[order].astype("<i8").tobytes(),
        "v": packed(v[order]),
        "vantages": place[np.asarray(vantages, int)].astype("<i4").tobytes(),
        "bounds": np.asarray(bounds, "<f8").tobytes(),
    }


def vectors_of(ids: bytes, v: bytes, d: int) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, "<i8")
    kind = f"<f{len(v) // (len(names) * d)}"
    return names, np.frombuffer(v, kind).astype(np.float64).reshape(len(names), d)


class Best:
    """The ``k`` nearest rows of each query of a block so far."""

    def __init__(self, names: np.ndarray, v: np.ndarray, k: int):
        self.names, self.v = names, v
        self.squares = (v * v).sum(axis=1)
        self.far = np.full((len(names), k), np.inf)
        self.ids = np.full((len(names), k), np.iinfo(np.int64).max)
        self.there = np.zeros((len(names), k), bool)

    def reach(self) -> np.ndarray:
        """A row farther than this cannot be among the best any more."""
        return np.where(self.there[:, -1], self.far[:, -1], np.inf)

    def meet(self, asked: np.ndarray, ids: np.ndarray, v: np.ndarray) -> None:
        """Compare the queries numbered ``asked`` with rows; exactly only where it can matter."""
        squares = (v * v).sum(axis=1)
        both = self.squares[asked][:, None] + squares[None, :]
        rough = both - 2 * (self.v[asked] @ v.T)
        limit = self.reach()[asked][:, None] ** 2
        near = ~(rough - ROUNDING * both > limit) & (self.names[asked][:, None] != ids[None, :])
        some = np.flatnonzero(near.any(axis=1))
        if not len(some):
            return
        q, c = np.nonzero(near[some])
        k = self.far.shape[1]
        far = np.full((len(some), k + near.shape[1]), np.inf)
        names = np.full(far.shape, np.iinfo(np.int64).max)
        there = np.zeros(far.shape, bool)
        rows = asked[some]
        far[:, :k], names[:, :k], there[:, :k] = self.far[rows], self.ids[rows], self.there[rows]
        far[q, k + c] = distances(self.v[rows[q]], v[c])
        names[q, k + c], there[q, k + c] = ids[c], True
        first = np.lexsort((names, far, ~there), axis=1)[:, :k]
        self.far[rows] = np.take_along_axis(far, first, 1)
        self.ids[rows] = np.take_along_axis(names, first, 1)
        self.there[rows] = np.take_along_axis(there, first, 1)


def search(best: Best, ids: np.ndarray, v: np.ndarray, vantages: np.ndarray, bounds: np.ndarray,
           factor: float) -> int:
    """Look for nearer rows in one tree; the number of pairs of a query and a leaf looked at."""
    levels = halves(len(v))
    leaves = levels[-1]
    # First the leaf where a query itself would lie: its rows bound what is worth a look.
    home, first = np.zeros(len(best.names), int), 0
    for runs in levels[:-1]:
        for number in np.unique(home):
            rows = np.flatnonzero(home == number)
            at = first + number
            far = distances(best.v[rows], v[vantages[at]][None, :])
            home[rows] = 2 * number + (far - bounds[at, 1] > bounds[at, 2] - far)
        first += len(runs)
    for number in np.unique(home):
        start, end = leaves[number]
        best.meet(np.flatnonzero(home == number), ids[start:end], v[start:end])
    looked = len(home)
    # Then all nodes from the top; a query's gap to a half is no less than its gap to the whole.
    gaps, first = np.zeros((len(home), 1)), 0
    reach = best.reach()
    for runs in levels[:-1]:
        below = np.full((len(home), 2 * len(runs)), np.inf)
        for number in range(len(runs)):
            rows = np.flatnonzero(~(factor * gaps[:, number] > reach))
            if not len(rows):
                continue
            far = distances(best.v[rows], v[vantages[first + number]][None, :])
            for side in (0, 1):
                least, most = bounds[first + number, 2 * side : 2 * side + 2]
                gap = np.maximum(least - far, far - most) - ROUNDING * (far + most)
                below[rows, 2 * number + side] = np.maximum(gap, gaps[rows, number])
        gaps, first = below, first + len(runs)
    for number in np.argsort(gaps.sum(axis=0), kind="stable"):
        rows = np.flatnonzero(~(factor * gaps[:, number] > best.reach()) & (home != number))
        if len(rows):
            start, end = leaves[number]
            best.meet(rows, ids[start:end], v[start:end])
            looked += len(rows)
    return looked


def index_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One tree per shard: rows of equal length as they come, ``SHARD_BYTES`` of them or the rest."""
    columns = ("ids", "v", "vantages", "bounds")
    schema = pa.schema([("d", pa.int32()), ("rows", pa.int32()), *[(c, pa.binary()) for c in columns]])
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def tree(d: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_pylist([{"d": d, "rows": len(v), **grown(ids, v)}], schema)

    for got in batches:
        ids, lengths = got["id"].to_numpy(), got["d"].to_numpy()
        flat = got["v"].flatten().to_numpy()
        ends = np.cumsum(lengths, dtype=np.int64)
        for d in map(int, np.unique(lengths)):
            rows = np.flatnonzero(lengths == d)
            full = max(2 * LEAF, SHARD_BYTES // (8 * d))
            while len(rows):
                room = full - sum(len(x) for x, _ in held.get(d, ()))
                some, rows = rows[:room], rows[room:]
                take = (ends[some] - d)[:, None] + np.arange(d)
                held.setdefault(d, []).append((ids[some], flat[take]))
                if len(some) == room:
                    yield tree(d, held.pop(d))
    for d, parts in held.items():
        yield tree(d, parts)


def query_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("d", pa.int32()), ("rows", pa.int32()), ("ids", pa.binary()), ("v", pa.binary())])
    for got in batches:
        ids, lengths = got["id"].to_numpy(), got["d"].to_numpy()
        flat = got["v"].flatten().to_numpy()
        ends = np.cumsum(lengths, dtype=np.int64)
        for d in map(int, np.unique(lengths)):
            rows = np.flatnonzero(lengths == d)
            for at in range(0, len(rows), QUERY_BLOCK):
                some = rows[at : at + QUERY_BLOCK]
                v = flat[(ends[some] - d)[:, None] + np.arange(d)]
                row = {"d": d, "rows": len(some), "ids": ids[some].astype("<i8").tobytes(), "v": packed(v)}
                yield pa.RecordBatch.from_pylist([row], schema)


FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def search_trees(k: int, factor: float):
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a tile follow each other, its blocks of queries before its shards."""
        tile, held = None, []

        def told(best: Best) -> pa.RecordBatch:
            q, rank = np.nonzero(best.there)
            return pa.RecordBatch.from_arrays(
                [pa.array(best.names[q]), pa.array(best.ids[q, rank]), pa.array(best.far[q, rank])],
                schema=FOUND,
            )

        for got in batches:
            for at in range(got.num_rows):
                row = got.slice(at, 1).to_pylist()[0]
                if row["tile"] != tile:
                    yield from map(told, held)
                    tile, held = row["tile"], []
                ids, v = vectors_of(row["ids"], row["v"], row["d"])
                if row["vantages"] is None:
                    held.append(Best(ids, v, k))
                    continue
                vantages = np.frombuffer(row["vantages"], "<i4")
                bounds = np.frombuffer(row["bounds"], "<f8").reshape(-1, 4)
                for best in held:
                    if best.v.shape[1] == row["d"]:
                        search(best, ids, v, vantages, bounds, factor)
        yield from map(told, held)

    return found


def tiling(tasks: int, shards: int, blocks: int, there: int, asked: int, held: int) -> tuple[int, int]:
    """Parts of the shards and groups of the blocks: some ``tasks`` tiles that send least.

    ``asked`` is sent once for each part, ``there`` once for each group; a group takes ``held`` bytes
    in all and ``GROUP_BYTES`` at most.
    """
    parts = round(math.sqrt(tasks * there / max(asked, 1)))
    parts = max(1, min(parts, tasks, shards))
    return parts, max(1, min(max(tasks // parts, math.ceil(held / GROUP_BYTES)), blocks))


def nth(number: Column) -> Column:
    """Which row of its task."""
    return number.bitwiseAND(F.lit(2**ROW_BITS - 1))


def dealt(number: Column, most: int, ways: int) -> Column:
    """One of ``ways``, dealt evenly within and across tasks, which wrote ``most`` rows each or fewer."""
    step = max(most, 1)
    while math.gcd(step, ways) > 1:
        step += 1
    return F.pmod(F.shiftright(number, ROW_BITS) * step + nth(number), F.lit(ways)).cast("int")


def every(ways: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))


def build_index(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per shard, written below ``spark.checkpoint.dir``: its length, rows, tree and number."""
    sound = sound_vectors(vectors, id_column, vector_column)
    columns = "d int, rows int, ids binary, v binary, vantages binary, bounds binary"
    trees = sound.mapInArrow(by_value(index_trees), columns)
    return stage(trees.withColumn("number", F.monotonically_increasing_id()), "vantage-trees")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    factor: float = 1.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` found nearest to each query.

    ``score`` is the Euclidean distance in double precision, ties go to the smaller identifier. A
    row is no candidate of the query of its own identifier. Rows without identifier, or whose vector
    is null, empty, zero or has a null or non-finite component, take no part; a query meets
    candidates of its own length only; with fewer than ``k`` of them it gets all. Of several queries
    of one identifier the one with the least vector counts; a repeated candidate counts as often as
    it is there. Other columns are not read. Empty tables give an empty result. ``factor`` below one
    is an error; at one no row is missed.
    """
    if factor < 1:
        raise ValueError("a factor below one prunes less than exact search and finds the same")
    trees = build_index(vectors, id_column, vector_column)
    asked = sound_vectors(queries, id_column, vector_column)
    asked = asked.groupBy("id").agg(F.min("v").alias("v")).withColumn("d", F.size("v"))
    blocks = asked.mapInArrow(by_value(query_blocks), "d int, rows int, ids binary, v binary")
    blocks = stage(blocks.withColumn("number", F.monotonically_increasing_id()), "query-blocks")

    def summed(pieces: DataFrame, *sizes: Column) -> tuple[int, ...]:
        sums = [F.sum(F.col("rows").cast("long") * size) for size in sizes]
        got = pieces.agg(F.count("*"), F.max(nth(F.col("number"))) + 1, *sums).first()
        return tuple(x or 0 for x in got)

    d = F.col("d")
    # A row is its identifier and components, a query also the ``k`` rows of three that it gets back.
    shards, most_shards, there = summed(trees, d + 1)
    many, most_blocks, sent, held = summed(blocks, d + 1 + 3 * k, 8 * d + 17 * k + 16)
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, groups = tiling(tasks, shards, many, there, sent, held)
    # A union, not a join: Spark would broadcast few blocks, counted once, and hold all their copies.
    none = F.lit(None).cast("binary")
    number = F.col("number")
    asking = blocks.withColumn("group", dealt(number, most_blocks, groups)).withColumn("part", every(parts))
    met = trees.withColumn("part", dealt(number, most_shards, parts)).withColumn("group", every(groups))
    tiles = met.unionByName(asking.withColumns({"vantages": none, "bounds": none}))
    pairs = (
        tiles.withColumn("tile", F.col("group") * parts + F.col("part"))
        .withColumn("shard", F.col("vantages").isNotNull())
        .select("tile", "shard", "d", "ids", "v", "vantages", "bounds")
        .repartitionById(parts * groups, F.col("tile"))
        .sortWithinPartitions("tile", "shard")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        pairs.mapInArrow(
            by_value(search_trees(k, factor)), "query_id long, vec_id long, score double"
        )
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
