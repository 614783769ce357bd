"""Connected components of a link table, in Spark alone.

Boruvka-style contraction: every component hooks onto its smallest neighbour,
pointers are jumped until they are flat, and links inside a component go. The
larger end of every link disappears in its round, so few rounds are needed;
neither links nor components ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected_components(links: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``.

    ``component`` is the smallest node that can be reached. Links may repeat,
    run in either direction or be loops; null ends are ignored. No links give
    no rows.
    """
    ends = links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    label = scratch.table(nodes.select("node", F.col("node").alias("component")), f"{name}-label-0")
    open_links = scratch.table(
        ends.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{name}-links-0",
    )
    step = 0
    while not open_links.isEmpty():
        step += 1
        parent = _hooks(open_links, scratch, f"{name}-{step}")
        low, high = parent.select(F.col("child").alias("a"), F.col("root").alias("ra")), parent.select(F.col("child").alias("b"), F.col("root").alias("rb"))
        moved = open_links.join(low, "a", "left").join(high, "b", "left").select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
        new_links = scratch.table(
            moved.filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
            f"{name}-links-{step}",
        )
        up = parent.select(F.col("child").alias("component"), "root")
        new_label = scratch.table(
            label.join(up, "component", "left").select("node", F.coalesce("root", "component").alias("component")),
            f"{name}-label-{step}",
        )
        scratch.drop(f"{name}-links-{step - 1}", f"{name}-label-{step - 1}", f"{name}-{step}-flat")
        open_links, label = new_links, new_label
    return label


def _hooks(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``(child, root)``: every component that has a smaller neighbour, with the root it ends at."""
    parent = scratch.table(links.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("root")), f"{name}-hook-0")
    jump = 0
    while True:
        above = parent.select(F.col("child").alias("root"), F.col("root").alias("above"))
        jumped = parent.join(above, "root", "left").select("child", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        jump += 1
        nxt = scratch.table(jumped, f"{name}-hook-{jump}")
        scratch.drop(f"{name}-hook-{jump - 1}")
        if nxt.filter("moved").isEmpty():
            return nxt.select("child", "root")
        parent = nxt.select("child", "root")
