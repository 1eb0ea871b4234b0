"""Document folders to a published read model."""

from __future__ import annotations

import pytest
import yaml

from factgraph.functions.registry import register_sql_functions
from factgraph.operators import records
from factgraph.plans.build import build_read_model
from factgraph.sources import documents, snapshots

RECORD = {
    "name": "demo", "node_id": "repo::o/demo", "github_full_name": "o/demo", "html_url": "https://github.com/o/demo",
    "source": "repos", "category": "agent_cli", "summary": "A demo", "core_concepts": [{"concept": "Loop"}, "Queue"],
    "key_entry_points": ["src/main.py"], "build_run": {"language": "python"}, "color": "blue",
    "provenance": {"shard": "repos", "as_of": "2026-01-02"},
}
IDENTITY = {k: RECORD[k] for k in ("name", "node_id", "github_full_name", "html_url", "source")}


def write(folder, name, payload):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(payload if isinstance(payload, str) else yaml.safe_dump(payload, sort_keys=False))


@pytest.fixture
def folders(tmp_path):
    other = RECORD | {"name": "lib", "node_id": "repo::o/lib", "github_full_name": "o/lib", "html_url": "https://github.com/o/lib"}
    write(tmp_path / "repos", "demo.yaml", RECORD)
    write(tmp_path / "repos", "lib.yaml", other)
    edges = [
        {"src_id": "repo::o/demo", "dst_id": "repo::o/lib", "dst_kind": "repo", "type": "uses", "as_of": "2026-01-01"},
        {"src_id": "repo::o/demo", "dst_id": "external_tool::redis", "dst_kind": "external_tool", "relation": "depends_on", "as_of": "2026-01-03"},
    ]
    write(tmp_path / "graph", "graph.yaml", {"edges": edges})
    rows = [{"shard": "repos", "observed_label": "uses", "canonical_relation": "depends_on"}]
    write(tmp_path / "contract", "mapping.yaml", {"mappings": rows})
    write(tmp_path / "deep", "demo.yaml", IDENTITY | {"tech_stack": ["Python"], "supported_protocols": ["gRPC"], "odd": {"x": 1}})
    fact = {"fact_type": "component", "predicate": "has_component", "object_kind": "concept", "object_value": "Core",
            "confidence": 0.9, "evidence": [{"kind": "file_line", "ref": "a.py:1"}]}
    write(tmp_path / "drafts", "demo.yaml", IDENTITY | {"facts": [fact]})
    return tmp_path


def built(spark, root):
    return build_read_model(spark, *[str(root / d) for d in ("repos", "graph", "contract", "deep", "drafts")])


def test_build_publish_and_read(spark, folders):
    build = built(spark, folders)
    assert {r["gate"]: r["passed"] for r in build.gates.collect() if not r["passed"]} == {}
    facts = {(r["predicate"], r["object_value"]) for r in build.tables["facts"].collect()}
    assert facts == {("has_component", "Python"), ("uses_protocol", "gRPC"), ("has_component", "Core")}
    assert [(r["reason"], r["section"]) for r in build.findings.collect()] == [("unmapped_section", "odd")]
    assert {r["relation"] for r in build.tables["edges"].collect()} == {"depends_on"}

    root = str(folders / "model")
    first = snapshots.publish(spark, root, build.tables)
    assert first.passed and first.changed and all(r["passed"] for r in first.gates.collect())
    again = snapshots.publish(spark, root, built(spark, folders).tables)
    assert again.passed and not again.changed and again.snapshot == first.snapshot
    stored = snapshots.read_table(spark, root, "facts")
    assert {(r["predicate"], r["object_value"]) for r in stored.collect()} == facts
    plan = stored.filter("predicate = 'uses_protocol'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(predicate" in plan


def test_failed_gate_leaves_the_old_snapshot(spark, folders):
    root, tables = str(folders / "model"), built(spark, folders).tables
    good = snapshots.publish(spark, root, tables)
    broken = dict(tables, nodes=tables["nodes"].filter("kind = 'repo'"))
    bad = snapshots.publish(spark, root, broken)
    assert not bad.passed and {r["gate"] for r in bad.gates.collect() if not r["passed"]} == {"no_orphan_edges"}
    assert snapshots.current_snapshot(spark, root) == good.snapshot
    assert snapshots.rebuild_difference(tables, tables).isEmpty()


def test_identity_mismatch_blocks_the_document(spark, folders):
    write(folders / "deep", "demo.yaml", IDENTITY | {"name": "Other", "tech_stack": ["Python"]})
    write(folders / "deep", "lost.yaml", {"name": "x", "tech_stack": ["Python"]})
    write(folders / "deep", "broken.yaml", "a: [")
    build = built(spark, folders)
    assert sorted(r["reason"] for r in build.findings.collect()) == ["identity_mismatch", "missing_shallow_match", "parse_error"]
    assert {r["object_value"] for r in build.tables["facts"].collect()} == {"Core"}
    failed = {r["gate"] for r in build.gates.collect() if not r["passed"]}
    assert failed == {"identity_coverage", "blocking_findings_zero"}


def test_yaml_scan_reports_instead_of_failing(spark, tmp_path):
    write(tmp_path / "d", "a.yaml", "x: 1\nwhen: 2024-01-01\n")
    write(tmp_path / "d", "b.yaml", "- 1\n")
    write(tmp_path / "d", "c.yaml", "x: [\n")
    write(tmp_path / "d", "e.yaml", "# nothing\n")
    write(tmp_path / "d", "f.txt", "x: 1")
    rows = {r["file"]: r["error"] for r in documents.yaml_documents(spark, str(tmp_path / "d")).collect()}
    assert rows["a.yaml"] is None and rows["b.yaml"] == "invalid_payload_shape" and rows["c.yaml"].startswith("parse_error")
    assert rows["e.yaml"] is None and "f.txt" not in rows
    # An unquoted date is no text.
    when = documents.yaml_documents(spark, str(tmp_path / "d"), pattern="a.yaml").select(documents.field("body", "$.when")).head()[0]
    assert when is None


def test_records_keep_unknown_keys_and_mappings(spark, folders):
    docs = documents.yaml_documents(spark, str(folders / "repos")).selectExpr("*", "'repos' AS shard")
    row = records.compile_records(docs).filter("name = 'demo'").head()
    assert row["core_concepts"] == ["Loop", "Queue"] and row["extras"] == {"color": '"blue"'} and row["errors"] == []
    assert row["structured"] == ['{"concept":"Loop"}']
    issues = records.required_key_issues(docs, deep=False).filter("path LIKE '%demo.yaml'").collect()
    assert [(r["severity"], r["message"]) for r in issues] == [("high", "missing required key: directory")]


def test_tree_scan_prunes(spark, tmp_path):
    for path in ("r1/src/a.py", "r1/node_modules/x.js", "r1/.terraform.d/y.tf", "r2/build/z.py", "r2/build.py"):
        target = tmp_path / "trees" / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text("x")
    rows = documents.repo_files(spark, str(tmp_path / "trees")).collect()
    assert sorted((r["repo"], r["path"], r["content"]) for r in rows) == [("r1", "src/a.py", "x"), ("r2", "build.py", "x")]


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT norm_term('Read-Only  ÄB'), ascii_fold('ÄB'), is_path_text('a b/c'), is_cli_text('tool-cli run'), is_route_text('get /x')"
    ).head()
    assert tuple(row) == ("read only b", "Äb", True, True, True)


def test_reports(spark, tmp_path):
    for run, value in (("2024-01-01", 1), ("2024-01-02", 2)):
        snapshots.write_report(spark.createDataFrame([(value,)], "v int"), str(tmp_path), "audit", run)
    assert [r["v"] for r in snapshots.latest_report(spark, str(tmp_path), "audit").collect()] == [2]
    stored = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "source string, hash string")
    now = spark.createDataFrame([("a", "1"), ("b", "9")], "source string, hash string")
    stale = {(r["source"], r["reason"]) for r in snapshots.stale_sources(stored, now).collect()}
    assert stale == {("b", "changed"), ("c", "not_found")}
