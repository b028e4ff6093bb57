"""Connected components of a graph of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.base import stored


def _towards_smaller(links: DataFrame) -> DataFrame:
    return (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to the smallest node it knows."""
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.min("b").alias("low"))
    smallest = smallest.select("a", F.least("a", "low").alias("low"))
    # only larger neighbours are handed on, so only the smaller end's minimum is needed
    return _towards_smaller(
        links.select(F.col("b").alias("a"), F.col("a").alias("larger"))
        .join(smallest, "a")
        .select(F.col("larger").alias("a"), F.col("low").alias("b"))
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours and itself to the smallest of them."""
    smallest = links.groupBy("a").agg(F.min("b").alias("low"))
    handed = links.join(smallest, "a")
    return _towards_smaller(
        handed.select(F.col("b").alias("a"), F.col("low").alias("b")).union(smallest)
    )


def _print(links: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(links.agg(F.count("*"), F.sum(mixed)).first())


def stars(links: DataFrame) -> DataFrame:
    """(node, root) for every node that some link (a, b) reaches except the roots themselves.

    The root is the smallest node of the component. A node without links, or linked
    only to itself, has no row. Each round is written to the shared folder; a hub's
    links stay rows, none is gathered in a list.
    """
    links = stored(_towards_smaller(links), "links")
    state = _print(links)
    while True:
        links = stored(_small_star(_large_star(links)), "links")
        before, state = state, _print(links)
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
