"""A Merkle manifest of a table: a tree per group of rows, and a tree over their roots.

Every level joins its nodes with their siblings: a node names the indices of its run, which are its
own shifted by slot offsets, and an equijoin on group and index brings the hashes. The rows of slot
zero then hash their run and emit the parent. What a node found, the hashes left and right of it, is
written once per level; a descent from the roots hands each node the path above it, so a parent's
path moves once per child and a proof is put together where its leaf is.

Hashes travel as 32 bytes and count as lowercase hexadecimal text wherever they are hashed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import stage

NO_PATH = "array<struct<left:binary,right:binary>>"


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256, as bytes, over each value's ``bytes:value``, ``-`` for null."""
    texts = [v.cast("string") for v in values]
    parts = [
        F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
        for t in texts
    ]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proof_hash(path: Column) -> Column:
    """The hash of all hashes of a path, from the leaf's siblings up, left to right."""
    runs = F.transform(path, lambda p: as_text(F.concat(p["left"], p["right"])))
    return F.sha2(F.array_join(runs, ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to along ``path``."""
    return F.aggregate(
        path,
        as_text(leaf),
        lambda h, p: F.sha2(F.concat(as_text(p["left"]), h, as_text(p["right"])), 256),
    )


def numbered(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``idx``, a row's place in its group from 0, and ``n``, the group's rows.

    Rows go to sorted ranges, so no task holds a group; what ranges must know of each other is one
    row per range and group. ``order`` must tell all rows of a group apart.
    """
    ranges = df.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id())
    ranges = stage(ranges, "ranges")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy("part", group).agg(F.count("*").alias("rows"))
    counts = counts.select(
        "part",
        group,
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
        F.sum("rows").over(Window.partitionBy(group)).alias("n"),
    )
    place = F.row_number().over(Window.partitionBy("part", group).orderBy(*order))
    return (
        ranges.withColumn("place", place)
        .join(counts, ["part", group])
        .withColumn("idx", F.col("before") + F.col("place") - 1)
        .drop("part", "before", "place")
    )


def with_siblings(nodes: DataFrame, fanout: int) -> DataFrame:
    """Nodes of trees that go on, with the hashes ``left`` and ``right`` of them in their run.

    ``up`` is the parent's hash in the row of slot zero, else null.
    """
    width = F.lit(fanout)
    slot = F.col("idx") % width
    offsets = F.sequence(F.lit(0), F.lit(fanout - 1))
    named = (
        nodes.select("grp", "idx", "n", F.explode(offsets).alias("offset"))
        .withColumn("sibling", F.col("idx") - slot + (slot + F.col("offset")) % width)
        .filter("sibling < n")
        .drop("offset")
    )
    hashes = nodes.select("grp", F.col("idx").alias("sibling"), "h")
    run = (
        named.join(hashes, ["grp", "sibling"])
        .groupBy("grp", "idx", "n")
        .agg(F.sort_array(F.collect_list(F.struct("sibling", "h"))).alias("run"))
    )

    def joined(keep) -> Column:
        chosen = F.filter("run", keep)
        return F.aggregate(chosen, F.unhex(F.lit("")), lambda s, x: F.concat(s, x["h"]))

    left = joined(lambda x: x["sibling"] < F.col("idx"))
    right = joined(lambda x: x["sibling"] > F.col("idx"))
    parent = F.unhex(F.sha2(as_text(joined(lambda x: F.lit(True))), 256))
    return run.select(
        "grp", "idx", "n", left.alias("left"), right.alias("right"), F.when(slot == 0, parent).alias("up")
    )


def grown(leaves: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The levels below the roots, from the leaves up, and the roots: ``grp, level, h``."""
    levels: list[DataFrame] = []
    nodes = leaves.select("grp", "idx", "n", "h")
    roots = nodes.filter("n = 1").select("grp", F.lit(0).alias("level"), "h")
    widest = nodes.agg(F.max("n")).first()[0] or 0
    while widest > 1:
        level = stage(with_siblings(nodes.filter("n > 1"), fanout), "merkle-level")
        levels.append(level)
        width = F.lit(fanout)
        nodes = level.filter("up IS NOT NULL").select(
            "grp",
            (F.col("idx") / width).cast("long").alias("idx"),
            F.ceil(F.col("n") / width).alias("n"),
            F.col("up").alias("h"),
        )
        done = nodes.filter("n = 1").select("grp", F.lit(len(levels)).alias("level"), "h")
        roots = roots.unionAll(done)
        widest = -(-widest // fanout)
    return levels, stage(roots, "merkle-roots")


def descended(levels: list[DataFrame], roots: DataFrame, fanout: int) -> DataFrame:
    """``grp, idx, path`` of all leaves, and what else ``roots`` carries beside their paths."""
    carried = [c for c in roots.columns if c not in ("grp", "level")]

    def tops(level: int) -> DataFrame:
        at = roots.filter(F.col("level") == level)
        return at.select("grp", F.lit(0).cast("long").alias("idx"), *carried)

    above = tops(len(levels))
    for number in range(len(levels) - 1, -1, -1):
        parents = above.withColumnRenamed("idx", "parent").withColumnRenamed("path", "rest")
        step = F.array(F.struct("left", "right"))
        below = (
            levels[number]
            .withColumn("parent", (F.col("idx") / F.lit(fanout)).cast("long"))
            .join(parents, ["grp", "parent"])
            .withColumn("path", F.concat(step, "rest"))
            .select("grp", "idx", *carried)
        )
        above = below.unionByName(tops(number))
    return above


def manifest(
    docs: DataFrame,
    columns: list[str],
    id_column: str = "doc_id",
    group_column: str = "lang",
    fanout: int = 8,
    suspects: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``id, leaf, subroot, root, path, suspect``, one row per row of ``docs``; hashes are bytes.

    ``path`` holds, from the leaf up, the hashes ``left`` and ``right`` of the way to the root;
    ``folded`` leads from a leaf along it and ``proof_hash`` digests it. ``suspect`` is the leaf of
    the row with the columns in ``suspects`` replaced by these expressions: a row whose own
    contents are in doubt. Within a group leaves ascend by identifier, null first; rows of equal
    identifier by their leaf, so equal rows are neighbours and repeats count. Groups ascend by
    their text, null first, and null and empty text are groups of their own. A group of one row has
    its leaf as subroot, a table of one group has that subroot as root. Columns not named are
    not read, whatever their names. An empty table gives an empty result.
    """
    if fanout < 2:
        raise ValueError("a run has at least two places")
    suspects = suspects or {}
    group = F.col(group_column).cast("string")
    leaves = docs.select(
        # '-' sorts before ':', as null does before all texts.
        F.coalesce(F.concat(F.lit(":"), group), F.lit("-")).alias("grp"),
        F.col(id_column).alias("id"),
        leaf_hash([F.col(c) for c in columns]).alias("h"),
        leaf_hash([suspects.get(c, F.col(c)) for c in columns]).alias("suspect"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # Written before they are sorted: ranges are sampled first, and texts are hashed once.
    leaves = stage(leaves, "merkle-leaves")
    leaves = stage(numbered(leaves, "grp", ["id", "h", "tie"]).drop("tie"), "merkle-numbered")
    levels, subroots = grown(leaves, fanout)
    over = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("member"), "level", "h")
    over = stage(
        numbered(over.withColumnRenamed("level", "depth"), "grp", ["member"]), "merkle-subroots"
    )
    top_levels, top = grown(over, fanout)
    top = top.select("grp", "level", F.col("h").alias("root"), F.expr(f"cast(array() as {NO_PATH})").alias("path"))
    beneath = descended(top_levels, top, fanout)
    tops = (
        over.join(beneath, ["grp", "idx"])
        .select(F.col("member").alias("grp"), F.col("depth").alias("level"),
                F.col("h").alias("subroot"), "root", "path")
    )
    paths = descended(levels, stage(tops, "merkle-tops"), fanout)
    return leaves.join(paths, ["grp", "idx"]).select(
        "id", F.col("h").alias("leaf"), "subroot", "root", "path", "suspect"
    )
