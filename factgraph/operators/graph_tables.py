"""Canonical edges, derived nodes and compile coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions.text import label_of, parse_as_of
from factgraph.session import broadcast_if_small

# Destination kinds and canonical relations of the contract.
NODE_KINDS = ["repo", "external_tool", "concept"]
RELATIONS = [
    "alternative_to", "integrates_with", "extends", "depends_on", "related_to", "similar_to", "built_on",
    "deploys", "references", "replaces", "supports", "used_by", "wrapper_for",
]


def _filled(col: str) -> Column:
    return F.nullif(F.col(col), F.lit(""))


def canonical_edges(edges: DataFrame, mapping: DataFrame, relations: Sequence[str] = RELATIONS) -> DataFrame:
    """Edges with the canonical relation, provenance defaults and their errors.

    ``edges(shard, source_edge_index, src_id, dst_id, dst_kind, relation, type, note,
    as_of, source_file, source_relation)``; ``mapping(shard, observed_label,
    canonical_relation)`` comes from a contract document. A label without a mapping is
    kept; ``unmapped`` tells whether the result is canonical. The older key ``type``
    stands in for an empty ``relation``.
    """
    observed = F.coalesce(_filled("relation"), _filled("type"), F.lit(""))
    lookup = broadcast_if_small(
        mapping.groupBy("shard", F.col("observed_label").alias("observed_relation")).agg(
            F.max("canonical_relation").alias("canonical_relation")
        )
    )
    rows = edges.withColumn("observed_relation", observed).join(lookup, ["shard", "observed_relation"], "left")
    mapped = F.coalesce("canonical_relation", "observed_relation")
    errors = F.array_compact(
        F.array(
            F.when(F.coalesce("src_id", F.lit("")) == "", F.lit("missing src_id")),
            F.when(F.coalesce("dst_id", F.lit("")) == "", F.lit("missing dst_id")),
            F.when(
                ~F.coalesce("dst_kind", F.lit("")).isin(NODE_KINDS),
                F.concat(F.lit("invalid dst_kind '"), F.coalesce("dst_kind", F.lit("")), F.lit("'")),
            ),
        )
    )
    default_file = F.concat("shard", F.lit("/knowledge/graph.yaml"))
    return rows.select(
        "src_id", "dst_id", "dst_kind", mapped.alias("relation"), _filled("note").alias("note"),
        F.coalesce("as_of", F.lit("")).alias("as_of"), "shard",
        F.coalesce(_filled("source_file"), default_file).alias("source_file"),
        F.coalesce(_filled("source_relation"), "observed_relation").alias("source_relation"),
        "source_edge_index", "observed_relation",
        (~mapped.isin(list(relations))).alias("unmapped"), errors.alias("errors"),
    )


def observed_relations(edges: DataFrame) -> DataFrame:
    """Distinct (shard, label) over the first non-empty of relation and type."""
    label = F.coalesce(_filled("relation"), _filled("type"))
    return edges.select("shard", label.alias("observed_label")).filter("observed_label IS NOT NULL").distinct()


def external_nodes(edges: DataFrame) -> DataFrame:
    """Nodes for destinations that are no records.

    Kind comes from the first edge, ``as_of`` from the newest parsable one (the first
    on ties, the first edge's text when none parses). The sources of a node are listed
    by ``external_node_sources``; here they are counted.
    """
    pos = F.struct("shard", "source_edge_index")
    targets = edges.filter((F.col("dst_kind") != "repo") & F.col("dst_kind").isin(NODE_KINDS) & (F.col("dst_id") != ""))
    age = -F.unix_micros(parse_as_of("as_of"))
    firsts = targets.groupBy(F.col("dst_id").alias("node_id")).agg(
        F.min(F.struct(pos, "dst_kind", "as_of")).alias("first"),
        F.min(F.when(age.isNotNull(), F.struct(age, pos, F.col("as_of").alias("text")))).alias("newest"),
    )
    sources = external_node_sources(targets).groupBy("node_id").agg(F.count("*").alias("source_count"))
    label = label_of("node_id")
    return firsts.join(sources, "node_id", "left").select(
        "node_id",
        F.col("first.dst_kind").alias("kind"),
        label.alias("label"),
        F.coalesce("newest.text", "first.as_of").alias("as_of"),
        F.when(F.col("first.dst_kind") == "external_tool", label).alias("external_ref"),
        F.coalesce("source_count", F.lit(0).cast("bigint")).alias("source_count"),
    )


def external_node_sources(edges: DataFrame) -> DataFrame:
    """Distinct (node, source file) of destinations that are no records."""
    return (
        edges.filter((F.col("dst_kind") != "repo") & F.col("dst_kind").isin(NODE_KINDS) & (F.col("dst_id") != ""))
        .filter("source_file <> ''")
        .select(F.col("dst_id").alias("node_id"), "source_file")
        .distinct()
    )


def repo_nodes(repos: DataFrame) -> DataFrame:
    """Records as nodes: full name, else name, else id; the name is an alias when it differs."""
    label = F.coalesce(_filled("full_name"), _filled("name"), F.col("node_id"))
    return repos.select(
        "node_id",
        F.lit("repo").alias("kind"),
        label.alias("label"),
        F.array_compact(F.array(F.when(_filled("name") != label, F.col("name")))).alias("aliases"),
        "as_of",
    )


def graph_nodes(repos: DataFrame, edges: DataFrame) -> DataFrame:
    """Record nodes and derived external nodes in one table."""
    return repo_nodes(repos).unionByName(external_nodes(edges), allowMissingColumns=True)
