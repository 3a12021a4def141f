"""Connected components of a table of links, by hooking to the least neighbour and jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import stage


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``a, b`` links; the root is the component's least node.

    A round gives each root the least root next to any of its members, then points all members
    of a root there and on to where that points. Components at least halve in number with each
    round, and the least member is found by sums that combine before they move.
    """
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), "links")
    roots = stage(
        both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root")
        ),
        "roots",
    )
    while True:
        to = roots.select(F.col("node").alias("b"), F.col("root").alias("other"))
        here = roots.select(F.col("node").alias("a"), "root")
        # The least root beside each root, over all links of its members.
        beside = (
            both.join(here, "a")
            .join(to, "b")
            .filter("other < root")
            .groupBy("root")
            .agg(F.min("other").alias("hook"))
        )
        beside = stage(beside, "hooks")
        if not beside.limit(1).count():
            break
        onward = beside.select(F.col("root").alias("hook"), F.col("hook").alias("beyond"))
        jumped = beside.join(onward, "hook", "left").select(
            "root", F.coalesce("beyond", "hook").alias("hook")
        )
        roots = stage(
            roots.join(jumped, "root", "left").select("node", F.coalesce("hook", "root").alias("root")),
            "roots",
        )
    # Members may point at a node that has itself moved on; follow until nothing changes.
    while True:
        onward = roots.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        jumped = stage(
            roots.join(onward, "root").select("node", "root", "beyond"), "roots"
        )
        if not jumped.filter("beyond <> root").limit(1).count():
            return jumped.select("node", "root")
        roots = jumped.select("node", F.col("beyond").alias("root"))
