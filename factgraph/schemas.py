"""Table shapes of the fact graph and the fixed vocabularies of its contract."""

from __future__ import annotations

CONTRACT_VERSION = "1.0.0"

REPOS = (
    "node_id string, name string, full_name string, html_url string, source string, category string, "
    "summary string, core_concepts array<string>, key_entry_points array<string>, "
    "build_run map<string,string>, shard string, source_file string, as_of string, raw string"
)
NODES = "node_id string, kind string, label string, aliases array<string>, as_of string, raw string"
EDGES = (
    "src_id string, dst_id string, dst_kind string, relation string, note string, as_of string, "
    "shard string, source_file string, source_relation string, source_edge_index int, raw string"
)
EVIDENCE = "struct<kind:string, ref:string, source_file:string, source_section:string, start_line:int, end_line:int>"
FACTS = (
    "fact_id string, node_id string, fact_type string, predicate string, object_kind string, "
    "object_value string, object_node_id string, note string, confidence double, as_of string, "
    f"extraction_mode string, source_file string, source_section string, evidence array<{EVIDENCE}>"
)
FINDINGS = (
    "severity string, reason string, shard string, source_file string, repo_node_id string, "
    "detail string, section string, fact_summary string"
)
GATES = "gate string, passed boolean, metric string"
SNAPSHOT_META = (
    "schema_version string, source_index_hash string, source_graph_hash string, source_facts_hash string, "
    "generated_at_utc string, repo_count bigint, node_count bigint, edge_count bigint, fact_count bigint"
)
REPO_FILES = "repo string, path string, size bigint, content string"
