"""Connected components of links between ids, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """The smallest id reachable from each id that has links to others: id, component.

    ``links`` has the long columns a and b, in any direction. In each round every
    id with a smaller neighbour hooks onto the smallest one; chains of hooks are
    shortened by pointer jumping, the links are renamed to their roots, and those
    inside one root vanish. Ids are never brought to the driver, and all state is
    in the shared folder. A hub with very many links is only ever summed over or
    joined with a table that has it once.
    """
    edges = written(_oriented(links.where("a IS NOT NULL AND b IS NOT NULL")), "edges")
    spark = links.sparkSession
    total = None
    while not edges.isEmpty():
        hooks = written(edges.groupBy("a").agg(F.min("b").alias("b")), "hooks")
        while True:
            onward = hooks.select(F.col("a").alias("b"), F.col("b").alias("c"))
            jumped = hooks.join(onward, "b", "left")
            if jumped.where("c IS NOT NULL").isEmpty():
                break
            hooks = _instead(hooks, jumped.select("a", F.coalesce("c", "b").alias("b")), "hooks")
        step = hooks.select(F.col("a").alias("id"), F.col("b").alias("component"))
        if total is None:
            total = written(step, "components")
        else:
            renamed = total.join(step.select(F.col("id").alias("component"), F.col("component").alias("next")), "component", "left")
            known = renamed.select("id", F.coalesce("next", "component").alias("component"))
            total = _instead(total, known.unionByName(step.join(total, "id", "left_anti")), "components")
        edges = _instead(edges, _oriented(_renamed(_renamed(edges, hooks, "a"), hooks, "b")), "edges")
        drop_written(hooks)
    drop_written(edges)
    return total if total is not None else spark.createDataFrame([], "id long, component long")


def _instead(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """``new`` written, and the files of ``old``, from which it was made, deleted."""
    out = written(new, name)
    drop_written(old)
    return out


def _renamed(edges: DataFrame, hooks: DataFrame, end: str) -> DataFrame:
    to = hooks.select(F.col("a").alias(end), F.col("b").alias("_to"))
    other = "b" if end == "a" else "a"
    return edges.join(to, end, "left").select(F.coalesce("_to", end).alias(end), other)


def _oriented(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")).distinct()
