"""Archetype coverage audit over records and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.functions.text import trim_ws

# Predicate families, in report order.
FAMILIES = {
    "structure": ["has_component", "has_config_option"],
    "tasks": ["supports_task"],
    "failures": ["has_failure_mode"],
    "protocols": ["uses_protocol", "exposes_api_endpoint", "has_extension_point"],
}

# Archetype, its categories, required families, and the protocol predicate it must show.
ARCHETYPES = [
    ("inference_serving", ["inference_serving"], ["structure", "tasks", "failures"], None),
    ("vector_database", ["vector_database", "vector_databases"], ["structure", "failures"], None),
    ("tunneling", ["tunneling", "vpn_mesh", "network_infrastructure"], ["structure", "protocols"], "uses_protocol"),
    (
        "agent_framework",
        ["agent_framework", "agent_frameworks", "agent_orchestration", "agent_platform"],
        ["structure", "tasks"],
        None,
    ),
    ("agent_cli", ["agent_cli"], ["structure", "tasks", "failures"], None),
    ("rag_frameworks", ["rag_frameworks"], ["structure", "tasks", "failures"], None),
    ("remote_access", ["remote_access"], ["structure", "tasks", "protocols"], "uses_protocol"),
    ("structured_outputs", ["structured_outputs"], ["structure", "tasks", "protocols"], None),
    ("ui_tools", ["ui_tools"], ["structure", "tasks"], None),
    ("workflow_builder", ["workflow_builder"], ["structure", "tasks"], None),
    ("cli_tool", ["cli_tool"], ["structure", "tasks", "failures"], None),
    ("machine_learning", ["machine_learning"], ["structure", "protocols", "failures"], "has_extension_point"),
    ("helm_chart_repo", ["helm_chart_repo", "helm_charts"], ["structure", "failures", "protocols"], "has_extension_point"),
    (
        "sdk_library",
        ["sdk_library", "sdk_monorepo", "sdk_client"],
        ["structure", "tasks", "failures", "protocols"],
        "uses_protocol",
    ),
    ("k8s_operator", ["k8s_operator"], ["structure", "tasks", "failures", "protocols"], "uses_protocol"),
    ("plugin_ecosystem", ["plugin_ecosystem"], ["structure", "failures", "protocols"], "uses_protocol"),
]
ARCHETYPE_SCHEMA = "archetype string, categories array<string>, required array<string>, protocol_check string"

# Section names the contract knows.
RECOGNIZED_SECTIONS = [
    "name", "node_id", "github_full_name", "html_url", "source", "provenance",
    "sparse", "directory", "category", "summary", "description", "notes", "metadata",
    "architecture", "configuration", "cli_arguments", "environment",
    "environment_variables", "key_features", "key_files", "core_modules",
    "tech_stack", "technology_stack", "ports", "type", "primary_language", "languages",
    "commands", "cli_commands", "common_tasks", "procedures", "quick_reference",
    "troubleshooting",
    "supported_protocols", "vpn_protocols", "api_protocols", "api_surface",
    "api_structure", "integrations", "extension_points", "sdk_usage", "cross_references",
    "code_patterns", "implementation_patterns", "testing",
    "key_sections", "content_coverage", "supplementary_files", "related_repos",
]

CHECKED_PREDICATES = ["uses_protocol", "has_extension_point"]


def archetype_rules(spark, rules=ARCHETYPES) -> DataFrame:
    """The rule table; one row per (archetype, category), the first archetype of a category wins."""
    rows, seen = [], set()
    for name, categories, required, check in rules:
        rows += [(name, c, required, check) for c in categories if c not in seen]
        seen.update(categories)
    schema = ARCHETYPE_SCHEMA.replace("categories array<string>", "category string")
    return spark.createDataFrame(rows, schema)


def coverage_audit(repos: DataFrame, facts: DataFrame, rules: DataFrame) -> DataFrame:
    """Families present and missing per record, failed predicate checks, and the class.

    Facts are reduced to one row of flags per record before any join; records without
    facts stay. ``rules`` comes from ``archetype_rules`` and is small by construction.
    """
    flags = [F.bool_or(F.col("predicate").isin(p)).alias("has_" + f) for f, p in FAMILIES.items()]
    checks = [F.bool_or(F.col("predicate") == p).alias("shows_" + p) for p in CHECKED_PREDICATES]
    per_repo = facts.groupBy("node_id").agg(F.count("*").alias("total_facts"), *flags, *checks)
    rows = (
        repos.select("node_id", "full_name", "name", trim_ws("category").alias("category"))
        .join(F.broadcast(rules), "category", "left")
        .join(per_repo, "node_id", "left")
    )
    rows = rows.na.fill(False).na.fill(0, ["total_facts"])
    matched = F.col("archetype").isNotNull()
    present = F.array_compact(F.array(*[F.when(F.col("has_" + f), F.lit(f)) for f in FAMILIES]))
    missing = F.array_compact(
        F.array(*[F.when(~F.col("has_" + f) & F.array_contains("required", f), F.lit(f)) for f in FAMILIES])
    )
    shown = F.lit(False)
    for p in CHECKED_PREDICATES:
        shown = shown | ((F.col("protocol_check") == p) & F.col("shows_" + p))
    failed = matched & F.col("protocol_check").isNotNull() & F.col("has_protocols") & ~shown
    empty = F.array().cast("array<string>")
    out = rows.select(
        "node_id", "full_name", "name", "category", "archetype", "total_facts",
        F.when(matched, present).otherwise(empty).alias("families_present"),
        F.when(matched, missing).otherwise(empty).alias("families_missing"),
        F.when(failed, F.array("protocol_check")).otherwise(empty).alias("predicate_check_failures"),
    )
    thin = (F.size("families_missing") > 0) | (F.size("predicate_check_failures") > 0)
    return out.withColumn(
        "behavioral_coverage",
        F.when(F.col("archetype").isNull(), "unmatched").when(thin, "thin").otherwise("full"),
    ).withColumn("no_facts", F.col("total_facts") == 0)


def unmapped_sections(facts: DataFrame, recognized: list[str] = RECOGNIZED_SECTIONS) -> DataFrame:
    """Distinct (record, section) whose exact section text the contract does not know."""
    odd = facts.filter(F.col("source_section").isNotNull() & ~F.col("source_section").isin(recognized))
    return odd.select("node_id", "source_section").distinct()


def audit_summary(audit: DataFrame) -> DataFrame:
    """Records per archetype and class."""
    name = F.coalesce("archetype", F.lit("unmatched"))
    return audit.groupBy(name.alias("archetype")).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("behavioral_coverage") == "full").alias("full"),
        F.count_if(F.col("behavioral_coverage") == "thin").alias("thin"),
    )


def thin_records(audit: DataFrame, archetype: str | None = None) -> DataFrame:
    """Thin records with what they miss, optionally of one archetype."""
    rows = audit.filter("behavioral_coverage = 'thin'")
    if archetype:
        rows = rows.filter(F.col("archetype") == archetype)
    return rows.select("archetype", "full_name", "node_id", "families_missing", "predicate_check_failures").orderBy(
        "archetype", "full_name", "node_id"
    )
