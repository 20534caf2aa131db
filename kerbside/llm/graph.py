"""Connected components of an edge table, for the operators that link rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.sources.workspace import stored


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of every node's neighbours and the node itself."""
    return edges.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))


def _hook(edges: DataFrame) -> DataFrame:
    """Every pair (u, v) becomes (v, m), with m the smallest of u and its neighbours, and u
    itself is tied to m."""
    small = _smallest(edges)
    moved = edges.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) of every node of ``edges`` (columns ``a``, ``b``, whole numbers): the
    smallest identifier that can be reached.

    Rounds alternate between tying a node's larger neighbours and its smaller ones to the
    smallest one in its neighbourhood, until nothing moves; the number of rounds grows with
    the logarithm of the longest path. Each round is written out, so the plan does not grow,
    and only counts reach the driver. A node with very many neighbours is one row among the
    minima, and its edges are split by adaptive execution.
    """
    current = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = _hook(both).filter("u > v")  # ties of larger neighbours, now all downwards
        current = stored(_hook(larger).filter("u > v"), "edges")
        mark = current.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
