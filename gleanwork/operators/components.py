"""Connected components by alternating stars.

Links point from the larger seed to the smaller one. A large-star step hangs
every node that points to ``v`` on the smallest neighbour of ``v``; a
small-star step hangs the other smaller neighbours of a node, and the node,
on its smallest one. Both keep the components and never add links, so hubs do
not grow; after a number of rounds that is logarithmic in practice every node
points to the smallest seed of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanwork.functions.joins import attach
from gleanwork.session import settle


def _by_seed(links: DataFrame, named: DataFrame, end: str) -> DataFrame:
    """``links`` with the node at ``end`` replaced by its seed. A hub ends many
    links, so seeds are attached to groups of links. Names of nodes pack well, so
    their written size does not tell that they fit a broadcast."""
    groups = links.groupBy(end).agg(F.count(F.lit(1)).alias("n")).join(
        named.select(F.col("node").alias(end), "seed").hint("merge"), end
    )
    other = "b" if end == "a" else "a"
    return attach(links, groups.hint("merge"), [end], "n").select(other, F.col("seed").alias(end))


def _smallest(links: DataFrame) -> DataFrame:
    """``<u, least, n>``: smallest neighbour below each node, and their number."""
    return links.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("n"))


def _large_star(links: DataFrame) -> DataFrame:
    pointed = links.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    below = _smallest(links).select(F.col("u").alias("v"), "least")
    hung = attach(links, pointed.join(below, "v", "left"), ["v"], "n")
    return hung.select("u", F.coalesce("least", "v").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    groups = settle(_smallest(links))
    others = attach(links, groups, ["u"], "n").filter(F.col("v") > F.col("least"))
    return (
        others.select(F.col("v").alias("u"), F.col("least").alias("v"))
        .unionByName(groups.select("u", F.col("least").alias("v")))
        .distinct()
    )


def _print(links: DataFrame) -> tuple:
    """Tells a set of links from another one."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``<node, label>`` from ``<node, seed>`` and undirected ``<a, b>``.

    Seeds are unique and ordered; a component is labelled with its smallest
    seed. Links to themselves and repeated links count nothing, a node without
    links keeps its seed. Nodes may have any number of links.
    """
    named = settle(nodes.select("node", "seed"))
    links = settle(edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct())
    seeded = _by_seed(settle(_by_seed(links, named, "a")), named, "b")
    links = settle(
        seeded.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _print(links)
    while before[0]:
        links = settle(_small_star(settle(_large_star(links))))
        now = _print(links)
        if now == before:
            break
        before = now
    found = named.join(links, F.col("seed") == F.col("u"), "left")
    return settle(found.select("node", F.coalesce("v", "seed").alias("label")))
