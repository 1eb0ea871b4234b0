"""Identifier resolution, neighbour, fact and text lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions.text import ascii_fold, casefold, contains_like, trim_ws


def _best_key(requests: DataFrame, wanted: list[tuple[int, Column]], keys: DataFrame) -> DataFrame:
    """Lowest-ranked (then first-ordered) node per identifier over (rank, key) pairs."""
    asked = requests.select("identifier").distinct()
    probes = asked.select(
        "identifier",
        F.explode(F.array(*[F.struct(F.lit(rank).alias("rank"), col.alias("key")) for rank, col in wanted])).alias("p"),
    ).select("identifier", "p.rank", "p.key")
    hits = (
        probes.join(keys, ["rank", "key"])
        .groupBy("identifier")
        .agg(F.min(F.struct("rank", "turn", "node_id")).alias("best"))
    )
    return asked.join(hits, "identifier", "left").select("identifier", F.col("best.node_id").alias("node_id"))


def resolve_identifiers(requests: DataFrame, repos: DataFrame) -> DataFrame:
    """Document-mode resolution: id, name, full name, then both names without case.

    ``requests(identifier)``; ``repos(node_id, name, full_name, ordinal)``. Of equal
    exact names the last record wins, of equal folded names the first. Identifiers
    without a record keep a null ``node_id``. All requests run in one join.
    """
    clean = repos.select(
        trim_ws("node_id").alias("node_id"),
        trim_ws("name").alias("name"),
        trim_ws("full_name").alias("full_name"),
        "ordinal",
    ).filter("node_id <> ''")
    ranked = [(1, F.col("node_id"), 1), (2, F.col("name"), -1), (3, F.col("full_name"), -1)]
    ranked += [(4, casefold("name"), 1), (5, casefold("full_name"), 1)]
    keys = clean.select(
        "node_id",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(rank).alias("rank"), key.alias("key"), (F.col("ordinal") * sign).alias("turn"))
                    for rank, key, sign in ranked
                ]
            )
        ).alias("k"),
    ).select("node_id", "k.*").filter("key <> ''")
    exact, folded = F.col("identifier"), casefold("identifier")
    return _best_key(requests, [(1, exact), (2, exact), (3, exact), (4, folded), (5, folded)], keys)


def resolve_identifiers_nocase(requests: DataFrame, repos: DataFrame) -> DataFrame:
    """Table-mode resolution: exact id, else name or full name without ASCII case, lowest id."""
    keys = repos.select(
        "node_id",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("rank"), F.col("node_id").alias("key")),
                F.struct(F.lit(2).alias("rank"), ascii_fold("name").alias("key")),
                F.struct(F.lit(2).alias("rank"), ascii_fold("full_name").alias("key")),
            )
        ).alias("k"),
    ).select("node_id", "k.*", F.lit(0).alias("turn")).filter("key IS NOT NULL")
    return _best_key(requests, [(1, F.col("identifier")), (2, ascii_fold("identifier"))], keys)


def repo_records(requests: DataFrame, repos: DataFrame) -> DataFrame:
    """Whole record per identifier; ``found`` is false when nothing matches."""
    resolved = resolve_identifiers_nocase(requests, repos)
    return resolved.join(repos, "node_id", "left").withColumn("found", F.col("node_id").isNotNull())


def neighbors(edges: DataFrame, node_id: str, direction: str = "both", relation: str | None = None) -> DataFrame:
    """Edges into and/or out of one node, in source order."""
    tests = {
        "out": F.col("src_id") == node_id,
        "in": F.col("dst_id") == node_id,
        "both": (F.col("src_id") == node_id) | (F.col("dst_id") == node_id),
    }
    found = edges.filter(tests[direction])
    if relation:
        found = found.filter(F.col("relation") == relation)
    return found.orderBy("src_id", "dst_kind", "dst_id", "relation")


def facts_for(facts: DataFrame, node_id: str, predicate: str | None = None) -> DataFrame:
    """Facts of one record; a predicate prunes partitions of the published table."""
    found = facts.filter(F.col("node_id") == node_id)
    if predicate:
        found = found.filter(F.col("predicate") == predicate)
    return found.orderBy("predicate", "fact_id")


def search(facts: DataFrame, term: str, field: str = "both", limit: int = 20) -> DataFrame:
    """Facts whose value and/or note holds ``term``; case-blind, wildcards kept."""
    fields = ["object_value", "note"] if field == "both" else [field]
    hit = F.lit(False)
    for name in fields:
        hit = hit | F.coalesce(contains_like(name, term), F.lit(False))
    return (
        facts.filter(hit)
        .select("fact_id", "node_id", "predicate", "object_kind", "object_value", "note")
        .orderBy("node_id", "predicate", "fact_id")
        .limit(limit)
    )


def in_category(category: str) -> Column:
    """Category equality without ASCII case."""
    return ascii_fold("category") == ascii_fold(F.lit(category))


def pattern_scope(
    facts: DataFrame,
    repos: DataFrame,
    predicate: str,
    category: str | None = None,
    value: str | None = None,
) -> DataFrame:
    """Facts of a predicate joined to their records, optionally by category and value."""
    picked = facts.filter(F.col("predicate") == predicate)
    if value:
        picked = picked.filter(contains_like("object_value", value))
    members = repos.select("node_id", "name", "full_name", "category")
    if category:
        members = members.filter(in_category(category))
    return picked.join(members, "node_id")


def select_repos(repos: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Records whose id, name or full name is listed; an empty list keeps all."""
    if not wanted:
        return repos
    names = list(wanted)
    return repos.filter(F.col("node_id").isin(names) | F.col("name").isin(names) | F.col("full_name").isin(names))
