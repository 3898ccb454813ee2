"""Connected components by randomised neighbour contraction.

Every round maps each node to the member of its closed neighbourhood with the
smallest hash (a new hash each round) and rewrites the edges to the images;
edges inside an image vanish. Node counts fall by a constant factor a round
on any graph, long chains included, and the maps are composed at the end.
Rounds are written to the shared checkpoint folder. Hubs are split by AQE: the
minimum is pre-aggregated, and the joins have one row per node on one side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node with an edge to another node; the
    component is its smallest node. ``edges``: a, b (long, not null)."""
    maps: list[DataFrame] = []
    e = edges.where(F.col("a") != F.col("b")).select("a", "b")
    e = cut_lineage(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                    "edges")
    while not e.isEmpty():
        salt = F.lit(len(maps))
        key = lambda c: F.struct(F.xxhash64(salt, c), F.col(c).alias("n"))  # noqa: E731, B023
        m = cut_lineage(
            e.groupBy("a").agg(F.min(key("b")).alias("_m")).select(
                "a", F.least("_m", key("a"))["n"].alias("m")
            ),
            "images",
        )
        maps.append(m)
        left = e.join(m, "a").select(F.col("m").alias("_ma"), F.col("b").alias("a"))
        e = cut_lineage(
            left.join(m, "a").select(F.col("_ma").alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b")).distinct(),
            "edges",
        )
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    out = maps[0].select(F.col("a").alias("node"), F.col("m").alias("root"))
    for m in maps[1:]:
        out = out.join(m.withColumnRenamed("a", "root"), "root", "left").select(
            "node", F.coalesce("m", "root").alias("root")
        )
    out = cut_lineage(out, "roots")
    least = out.groupBy("root").agg(F.min("node").alias("component"))
    return out.join(least, "root").select("node", "component")
