"""From document folders to a published read model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factgraph.functions.text import is_blank, parse_as_of
from factgraph.operators import aggregates, consolidate, extract, gates, graph_tables, records
from factgraph.operators.observed import Watch, none_broken, none_of
from factgraph.operators.setdiff import hash_ledger, missing_and_extra
from factgraph.session import cut_lineage, staged
from factgraph.sources import documents, snapshots


@dataclass(frozen=True)
class Build:
    """The four tables, the evidence beside the facts, all findings and the gates."""

    tables: dict[str, DataFrame]
    evidence: DataFrame
    findings: DataFrame
    gates: DataFrame


def build_facts(narratives: DataFrame, drafts: DataFrame, repos: DataFrame) -> tuple[consolidate.Consolidated, DataFrame]:
    """Facts and findings of resolved narrative and draft documents.

    Documents whose identity differs from their record give findings and, for
    narratives, no facts.
    """
    identity = repos.withColumn("file_stem", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]+$", ""))
    narrative = cut_lineage(records.resolve_documents(narratives, identity))
    draft = cut_lineage(records.resolve_documents(drafts, identity))
    parity = records.parity_findings(narrative, repos)
    sound = narrative.filter("error IS NULL AND node_id IS NOT NULL").join(parity.select("path").distinct(), "path", "left_anti")
    sections = extract.document_sections(sound)
    derived = extract.judge_facts(cut_lineage(extract.section_facts(sections)))
    drafted = extract.judge_facts(cut_lineage(extract.draft_facts(draft.filter("error IS NULL AND node_id IS NOT NULL"))))
    result = consolidate.consolidate(derived.valid.unionByName(drafted.valid.drop("shard")))

    def finding(df: DataFrame, file: str, section: str = "''") -> DataFrame:
        return df.selectExpr("severity", "reason", f"{file} AS source_file", f"{section} AS section", "detail")

    mismatches = parity.unionByName(records.parity_findings(draft, repos)).selectExpr(
        "'blocking' AS severity", "reason", "path AS source_file", "field AS section",
        "concat(field, ': expected ', coalesce(expected, ''), ', got ', actual) AS detail",
    )
    found = (
        finding(records.unresolved_findings(narrative), "source_file")
        .unionByName(finding(records.unresolved_findings(draft), "source_file"))
        .unionByName(mismatches)
        .unionByName(finding(extract.unmapped_section_findings(sections), "source_file", "section"))
        .unionByName(finding(derived.findings, "source_file", "source_section"))
        .unionByName(finding(drafted.findings, "source_file", "source_section"))
    )
    return result, found


def build_graph(
    spark: SparkSession, record_dir: str, edge_dir: str, mapping_dir: str, shard: str = "repos", watch: Watch | None = None
) -> dict[str, DataFrame]:
    """Record, node and edge rows of the document folders; gates over their rows go to ``watch``."""
    watch = watch or Watch()
    parsed = F.col("error").isNull()
    docs = watch.staged(
        documents.yaml_documents(spark, record_dir).withColumn("shard", F.lit(shard)),
        {"record_documents": F.count("*"), "structured_documents": F.count_if(parsed & records.has_mappings())},
        repo_documents_parse=none_of(~parsed),
    )
    sound = F.size("errors") == 0
    repos = watch.staged(
        records.compile_records(docs.filter("error IS NULL")),
        {"sound_records": F.count_if(sound), "structured_records": F.count_if(F.size("structured") > 0)},
        compile_errors_zero=none_of(~sound),
        stale_records_zero=none_of(parse_as_of("as_of").isNull()),
        repo_source_compiled=none_of(~F.col("source").eqNullSafe(F.lit("compiled_master"))),
    )
    watch.holds("repo_coverage_100pct", watch.values["sound_records"] == watch.values["record_documents"])
    watch.holds("structured_lists_kept", watch.values["structured_records"] == watch.values["structured_documents"])
    lists = documents.yaml_documents(spark, edge_dir)
    raw = documents.edge_entries(lists.filter("error IS NULL"), F.lit(shard))
    mapping = documents.relation_mapping(documents.yaml_documents(spark, mapping_dir).filter("error IS NULL"))
    edges = watch.staged(
        graph_tables.canonical_edges(raw, mapping),
        edge_errors_zero=none_of(F.size("errors") > 0),
        unmapped_relations_empty=none_of(F.col("unmapped")),
        edge_coverage=none_broken(gates.edge_rules()),
    )
    nodes = watch.staged(
        graph_tables.graph_nodes(repos, edges).withColumn("source", F.lit("compiled_master")),
        node_source_compiled=none_of(F.col("source") != "compiled_master"),
        node_kinds_known=none_of(~F.col("kind").isin(gates.NODE_KINDS)),
    )
    return {"documents": docs, "repos": repos, "edges": edges, "nodes": nodes}


def build_read_model(
    spark: SparkSession, record_dir: str, edge_dir: str, mapping_dir: str, narrative_dir: str, draft_dir: str, shard: str = "repos"
) -> Build:
    """All tables and gates; publish them with ``snapshots.publish`` when the gates hold."""
    watch = Watch()
    graph = build_graph(spark, record_dir, edge_dir, mapping_dir, shard, watch)
    repos, edges = graph["repos"], graph["edges"]
    texts = documents.narrative_and_drafts(spark, narrative_dir, draft_dir).withColumn("shard", F.lit(shard))
    result, findings = build_facts(texts.filter("kind = 'narrative'"), texts.filter("kind = 'draft'"), repos)
    reason = F.col("reason")
    findings = watch.staged(
        findings,
        unknown_predicates_zero=none_of(reason == "unknown_predicate"),
        identity_coverage=none_of(F.startswith("reason", F.lit("identity_"))),
        blocking_findings_zero=none_of(F.col("severity") == "blocking"),
    )
    facts = watch.staged(
        result.facts,
        deep_facts_parseable=none_of(F.col("fact_id").isNull() | is_blank("node_id") | is_blank("predicate") | is_blank("object_kind")),
        facts_with_evidence=none_of(F.col("evidence_count") == 0),
        confidence_bounds_valid=none_of(~F.coalesce(F.col("confidence").between(0.0, 1.0), F.lit(False))),
    )
    # What compares keys across rows or tables stays a query.
    keyed = gates.gate_results(
        {
            "unknown_repo_refs_zero": (gates.unknown_repo_refs(edges, repos), gates.none_left()),
            "duplicate_repo_node_ids_zero": (aggregates.duplicate_keys(repos, ["node_id"]), gates.none_left()),
            "external_policy_first_class": (gates.edge_policy_findings(edges, graph["nodes"], "first_class"), gates.none_left()),
            "external_policy_label_only": (gates.edge_policy_findings(edges, graph["nodes"], "label_only"), gates.none_left()),
            "duplicate_fact_ids_zero": (aggregates.duplicate_keys(facts, ["fact_id"]), gates.none_left()),
        }
    )
    checks = watch.results(spark, staged(keyed))
    flat = flat_graph(graph) | {"facts": facts.select(*FACT_COLUMNS)}
    return Build({n: snapshots.with_raw(df) for n, df in flat.items()}, result.evidence, findings, checks)


def rebuild_gate(first: Build, second: Build) -> DataFrame:
    """``gate, passed``: whether two builds of the same folders hold equal rows, by digest."""
    pair = [hash_ledger(x.tables).select("table", "rows", "digest") for x in (first, second)]
    return missing_and_extra(pair[0], pair[1], ["table", "rows", "digest"]).agg((F.count("*") == 0).alias("passed")).select(
        F.lit("hash_stable").alias("gate"), "passed"
    )


@dataclass(frozen=True)
class Model:
    """The four tables and where they come from: ``snapshot`` or ``documents``."""

    tables: dict[str, DataFrame]
    mode: str


def open_model(
    spark: SparkSession, root: str | None = None, record_dir: str | None = None, edge_dir: str | None = None,
    mapping_dir: str | None = None, facts_dir: str | None = None, shard: str = "repos",
) -> Model:
    """One way to the same four tables (A10): the published snapshot below ``root`` if there is
    one, else record, edge and mapping documents.

    Facts are optional with documents: without ``facts_dir``, which holds what
    ``snapshots.write_facts_by_repo`` wrote, the table has its columns and no rows, and every
    lookup answers as over a model without facts.
    """
    if root is not None and snapshots.current_snapshot(spark, root) is not None:
        return Model({t: snapshots.read_table(spark, root, t) for t in snapshots.TABLES}, "snapshot")
    if not (record_dir and edge_dir and mapping_dir):
        raise FileNotFoundError("neither a published snapshot nor document folders")
    graph = build_graph(spark, record_dir, edge_dir, mapping_dir, shard)
    tables = flat_graph(graph)
    columns = ", ".join(f"{c} {'double' if c == 'confidence' else 'string'}" for c in FACT_COLUMNS)
    tables["facts"] = spark.createDataFrame([], columns) if facts_dir is None else spark.read.parquet(facts_dir)
    return Model({n: snapshots.with_raw(tables[n]) for n in snapshots.TABLES}, "documents")


FACT_COLUMNS = [
    "fact_id", "node_id", "fact_type", "predicate", "object_kind", "object_value", "object_node_id", "confidence", "note", "as_of",
    "source_file", "source_section",
]


def flat_graph(graph: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Records, nodes and edges with the columns that are published."""
    return {
        "repos": graph["repos"].select("node_id", "name", "full_name", "html_url", "category", "shard", "summary", "source"),
        "nodes": graph["nodes"].select("node_id", "kind", "label"),
        "edges": graph["edges"].select("src_id", "dst_id", "dst_kind", "relation", "note", "as_of"),
    }
