"""Connected components of a link table, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node reachable over ``links``.

    Every node holds a parent. A round hooks each node, and its parent, under
    the smallest grandparent seen among the node's neighbours, then shortcuts
    to the grandparent, so that long chains halve instead of moving one step a
    round. Rounds are written to the shared folder; only two sums come to the
    driver. Nodes without links, and links with a null end, are left out.
    """
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    both = materialize(ends.unionAll(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
    state = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("f"))
                        .select("u", "f", F.col("f").alias("g")), "parents")
    before = None
    while True:
        seen = both.join(state.select(F.col("u").alias("v"), "g"), "v").groupBy("u").agg(F.min("g").alias("m"))
        moved = state.join(seen, "u")
        parents = (
            state.select("u", F.least("f", "g").alias("f"))
            .unionAll(moved.select("u", F.col("m").alias("f")))
            .unionAll(moved.select(F.col("f").alias("u"), F.col("m").alias("f")))
            .groupBy("u").agg(F.min("f").alias("f"))
        )
        above = parents.select(F.col("u").alias("f"), F.col("f").alias("g"))
        state = materialize(parents.join(above, "f").select("u", "f", "g"), "parents")
        now = state.agg(F.sum(F.col("f").cast("decimal(38,0)")), F.sum(F.col("g").cast("decimal(38,0)"))).first()
        if now == before:
            return state.select(F.col("u").alias("node"), F.col("g").alias("root"))
        before = now
