"""Multi-hop traversal."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.session import BROADCAST_ROW_LIMIT, staged

DEFAULT_HOPS = 3


@dataclass(frozen=True)
class Traversal:
    """``reached(start_id, node_id, hop)``, ``edges(start_id, hop, src_id, dst_id, relation, note)``
    and ``layers(start_id, hop, edges_found, new_nodes)``."""

    reached: DataFrame
    edges: DataFrame
    layers: DataFrame

    def details(self, nodes: DataFrame) -> DataFrame:
        """Node rows of reached ids; ids without a row are reached but not listed."""
        return self.reached.filter("hop > 0").join(nodes.select("node_id", "kind", "label"), "node_id")

    def summary(self) -> DataFrame:
        reached = self.reached.groupBy("start_id").agg(F.count_if(F.col("hop") > 0).alias("nodes_reached"))
        walked = self.layers.groupBy("start_id").agg(F.sum("edges_found").alias("edges_traversed"))
        return reached.join(walked, "start_id")


def _steps(edges: DataFrame, relation: str | None, direction: str) -> DataFrame:
    """One row per way to walk an edge: from ``node_id`` to ``neighbor``."""
    if relation:
        edges = edges.filter(F.col("relation") == relation)
    ways = {"out": [("src_id", "dst_id")], "in": [("dst_id", "src_id")]}
    pairs = ways.get(direction, ways["out"] + ways["in"])
    ends = F.array(*[F.struct(F.col(a).alias("node_id"), F.col(b).alias("neighbor")) for a, b in pairs])
    return edges.select(F.explode(ends).alias("way"), "src_id", "dst_id", "relation", "note").select(
        "way.*", "src_id", "dst_id", "relation", "note"
    )


# A node with more edges than this is a hub; its edges are dealt to one task per so many.
HUB_ROWS = 1_000_000
# Hubs are broadcast, so the limit above rises until there can be no more of them than this.
MOST_HUBS = 100_000


def adjacency(edges: DataFrame, relation: str | None, direction: str, hub_rows: int) -> tuple[DataFrame, DataFrame]:
    """The steps of all edges, written once, and the hubs among the nodes they leave with the
    number of parts their edges are dealt into."""
    steps = staged(_steps(edges, relation, direction))
    limit = max(hub_rows, steps.count() // MOST_HUBS)
    degrees = steps.groupBy("node_id").agg(F.count("*").alias("n")).filter(F.col("n") > limit)
    return steps, staged(degrees.select("node_id", F.ceil(F.col("n") / limit).cast("int").alias("parts")))


def dealt_join(steps: DataFrame, front: DataFrame, hubs: DataFrame) -> DataFrame:
    """Steps at the nodes of a frontier; those of a hub meet it in as many parts as its degree asks for."""
    hubs = F.broadcast(hubs)
    part = F.pmod(F.xxhash64("src_id", "dst_id", "relation", "note"), F.col("parts"))
    left = steps.join(hubs, "node_id", "left").withColumn("part", F.coalesce(part, F.lit(0).cast("bigint"))).drop("parts")
    parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)).cast("bigint") - 1)
    right = front.join(hubs, "node_id", "left").select("start_id", "node_id", F.explode(parts).alias("part"))
    return left.join(right, ["node_id", "part"])


def traverse(
    starts: DataFrame, edges: DataFrame, hops: int = DEFAULT_HOPS, relation: str | None = None, direction: str = "both",
    hub_rows: int = HUB_ROWS, broadcast_rows: int = BROADCAST_ROW_LIMIT,
) -> Traversal:
    """Level-by-level walk from many starts at once.

    ``starts(start_id)``. Each hop takes the edges at the nodes first reached one hop
    earlier, so an edge may show up again in a later hop; within a hop it counts once,
    with the smallest note. The steps are written once and read once per hop; what a hop
    touches is written, and gives both its edges and the next frontier. A frontier is counted
    and broadcast only when small; a larger one meets hubs in parts, which their degrees
    size. The walk ends early when a frontier is empty.
    """
    if hops < 1:
        raise ValueError("hops must be at least 1")
    steps, hubs = adjacency(edges, relation, direction, hub_rows)
    frontier = staged(starts.select("start_id", F.col("start_id").alias("node_id"), F.lit(0).alias("hop")).distinct())
    levels, walked = [frontier], []
    for hop in range(1, hops + 1):
        size = frontier.limit(broadcast_rows + 1).count()
        if size == 0:
            break
        front = frontier.select("start_id", "node_id")
        met = steps.join(F.broadcast(front), "node_id") if size <= broadcast_rows else dealt_join(steps, front, hubs)
        touched = staged(
            met.groupBy("start_id", F.lit(hop).alias("hop"), "src_id", "dst_id", "relation").agg(
                F.min("note").alias("note"),
                F.bool_or(F.col("neighbor") == F.col("dst_id")).alias("to_dst"),
                F.bool_or(F.col("neighbor") == F.col("src_id")).alias("to_src"),
            )
        )
        walked.append(touched.drop("to_dst", "to_src"))
        seen = reduce(DataFrame.unionByName, levels).select("start_id", F.col("node_id"))
        ends = F.array_compact(F.array(F.when(F.col("to_dst"), F.col("dst_id")), F.when(F.col("to_src"), F.col("src_id"))))
        frontier = staged(
            touched.select("start_id", F.explode(ends).alias("node_id"))
            .distinct()
            .join(seen, ["start_id", "node_id"], "left_anti")
            .withColumn("hop", F.lit(hop))
        )
        levels.append(frontier)
    reached = reduce(DataFrame.unionByName, levels)
    hop_edges = reduce(DataFrame.unionByName, walked)
    return Traversal(reached, hop_edges, _layers(reached, hop_edges, hops))


def _layers(reached: DataFrame, hop_edges: DataFrame, hops: int) -> DataFrame:
    """Edges and new nodes per hop; a hop is listed while the one before reached something."""
    listed = (
        reached.filter(F.col("hop") < hops)
        .select("start_id", (F.col("hop") + 1).alias("hop"), F.lit(0).alias("e"), F.lit(0).alias("n"), F.lit(1).alias("open"))
    )
    found = hop_edges.select("start_id", "hop", F.lit(1).alias("e"), F.lit(0).alias("n"), F.lit(0).alias("open"))
    new = reached.filter("hop > 0").select(
        "start_id", "hop", F.lit(0).alias("e"), F.lit(1).alias("n"), F.lit(0).alias("open")
    )
    return (
        listed.unionByName(found)
        .unionByName(new)
        .groupBy("start_id", "hop")
        .agg(F.sum("e").alias("edges_found"), F.sum("n").alias("new_nodes"), F.sum("open").alias("open"))
        .filter("open > 0")
        .drop("open")
    )
