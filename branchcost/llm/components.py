"""Connected components of a link table, by union-find within tasks and star contraction between them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchcost.llm.common import stage_table


def _local_forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Replace the links of a batch by links to the smallest node of each of its trees."""
    for b in batches:
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for u, v in zip(b["u"].tolist(), b["v"].tolist()):
            u, v = find(u), find(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
        rows = [(x, find(x)) for x in list(parent) if find(x) != x]
        yield pd.DataFrame(rows, columns=["u", "v"], dtype="int64")


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step on links (u, v) with u > v.

    Each node's smallest neighbour is found by partial aggregation and
    joined back; both sides of the join are written tables or plain
    shuffles, so the many links of one node are split by the skew join.
    """
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    least = stage_table(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    joined = both.join(least, "u")
    if large:  # neighbours above u are linked to the least of u and its neighbours
        out = joined.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
    else:  # u and its (smaller) neighbours are linked to the least of them
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in `links` (u, v); component is its smallest node.

    Repeats the two star steps until every node is linked to one root only;
    a large component needs about log(nodes) rounds, a star one. Links of a
    node with itself or with null are ignored.
    """
    clean = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = stage_table(clean.mapInPandas(_local_forest, "u bigint, v bigint").distinct(), "links")
    while not _is_stars(now):
        now = stage_table(_stars(stage_table(_stars(now, True), "stars"), False), "links")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _is_stars(links: DataFrame) -> bool:
    """Whether each u is in one link only and no v is a u."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("n")).unionByName(
        links.select(F.col("v").alias("x"), F.lit(0).alias("n"))
    )
    per_node = ends.groupBy("x").agg(F.sum("n").alias("out"), F.min("n").alias("least"))
    return not per_node.where("out > 1 OR (out = 1 AND least = 0)").take(1)
