"""Gates over edges, nodes, records and status documents."""

from __future__ import annotations

import pytest

from factgraph.operators import audit, gates, profile, setdiff

EDGES = "src_id string, dst_id string, dst_kind string, relation string"


def policy(spark, nodes, edges, mode):
    n = spark.createDataFrame(nodes, "node_id string, kind string")
    return sorted(r["reason"] for r in gates.edge_policy_findings(spark.createDataFrame(edges, EDGES), n, mode).collect())


def test_policies(spark):
    nodes = [("repo::a", "repo"), ("repo::b", "repo"), ("tool::x", "external_tool")]
    edges = [("repo::a", "repo::b", "repo", "extends"), ("repo::a", "tool::x", "external_tool", "depends_on")]
    assert policy(spark, nodes, edges, "first_class") == [] == policy(spark, nodes, edges, "label_only")
    assert policy(spark, nodes[:2], edges, "first_class") == ["missing_dst_node"]
    assert policy(spark, nodes[:2], edges, "label_only") == []
    odd = [*nodes[:2], ("tool::x", "concept")]
    assert policy(spark, odd, edges, "first_class") == ["dst_kind_mismatch"] == policy(spark, odd, edges, "label_only")
    assert policy(spark, [("repo::a", "repo")], edges[:1], "label_only") == ["missing_dst_node"]


STATUS = (
    "doc string, present boolean, parsed boolean, mapping boolean, status string, "
    "phases map<string, struct<status:string,pending:array<string>,current_batch:array<string>>>, "
    "audit_present boolean, audit_parsed boolean, overall_verdict string, critical array<string>, high array<string>"
)
CLEAN = {"doc": "d", "present": True, "parsed": True, "mapping": True, "status": "in_progress", "phases": None,
         "audit_present": True, "audit_parsed": True, "overall_verdict": "READY_FOR_PRODUCTION", "critical": [], "high": []}


@pytest.mark.parametrize(
    ("changes", "rules"),
    [
        ({}, []),
        ({"present": False}, ["progress.missing"]),
        ({"parsed": False}, ["progress.parse"]),
        ({"mapping": False}, ["progress.shape"]),
        ({"status": " Complete "}, ["progress.complete_requires_phases"]),
        (
            {"status": "completed", "phases": {"x": ("pending", [], []), "y": ("complete", [], [])}},
            ["progress.complete_requires_all_phases_complete"],
        ),
        ({"phases": {"deepening": ("complete", ["a"], [])}}, ["progress.deepening_pending_must_be_empty"]),
        ({"phases": {"deepening": ("complete", [], ["a"])}}, ["progress.deepening_current_batch_must_be_empty"]),
        ({"phases": {"audit": ("complete", [], [])}, "audit_parsed": False}, ["progress.audit_requires_parseable_audit_report"]),
        (
            {"phases": {"audit": ("complete", [], [])}, "audit_parsed": False, "audit_present": False},
            ["progress.audit_requires_audit_report"],
        ),
        ({"critical": ["x"]}, ["audit.ready_verdict_forbidden_with_critical_issues"]),
        ({"high": ["x"]}, ["audit.ready_verdict_forbidden_with_high_issues"]),
    ],
)
def test_status_rules(spark, changes, rules):
    row = CLEAN | changes
    frame = spark.createDataFrame([tuple(row[c.split()[0]] for c in CLEAN)], STATUS)
    assert [r["reason"] for r in gates.status_findings(frame).collect()] == rules


@pytest.mark.parametrize(
    ("states", "overall", "ready", "ready_in_production"),
    [
        (("PASS", "PASS", "PASS"), "PASS", True, True),
        (("PASS", "PASS", "WARN"), "WARN", True, False),
        (("PASS", "PASS", "FAIL"), "FAIL", False, False),
        (("FAIL", "PASS", "WARN"), "BLOCKED", False, False),
        (("PASS", "FAIL", "FAIL"), "BLOCKED", False, False),
    ],
)
def test_overall_verdict(spark, states, overall, ready, ready_in_production):
    frame = spark.createDataFrame(list(zip(("parse", "status", "scope"), states, strict=True)), "gate string, status string")
    row = gates.overall_verdict(frame).head()
    assert (row["overall_status"], row["ready_state_allowed"]) == (overall, ready)
    assert gates.overall_verdict(frame, production=True).head()["ready_state_allowed"] == ready_in_production


@pytest.mark.parametrize(("high", "critical", "want"), [(0, 0, "READY_FOR_PRODUCTION"), (5, 0, "READY_WITH_NOTES"), (6, 0, "FIX_REQUIRED"), (0, 1, "FIX_REQUIRED")])
def test_audit_verdict(spark, high, critical, want):
    rows = [("high",)] * high + [("critical",)] * critical + [("low",)]
    assert gates.verdict(spark.createDataFrame(rows, "severity string")).head()["verdict"] == want


def test_alias_hints(spark):
    records = spark.createDataFrame([("a", "agent-cli"), ("b", "agent_cli"), ("c", "odd")], "full_name string, hint string")
    allowed = spark.createDataFrame([("agent_cli",)], "value string")
    aliases = spark.createDataFrame([("agent-cli", "agent_cli"), ("agent_cli", "gone")], "alias string, target string")
    found = {r["full_name"]: (r["reason"], r["target"]) for r in gates.allow_list_findings(records, allowed, aliases).collect()}
    assert found == {"a": ("alias", "agent_cli"), "c": ("unknown", None)}
    fixed = {r["full_name"]: r["hint"] for r in gates.fix_hints(records, aliases, allowed).collect()}
    assert fixed == {"a": "agent_cli", "b": "agent_cli", "c": "odd"}
    assert sorted(r["reason"] for r in gates.alias_table_findings(aliases, allowed).collect()) == ["alias_is_allowed", "target_not_allowed"]


def test_fixed_archetypes(spark):
    repos = spark.createDataFrame(
        [("1", "o/1", "1", " vector_databases "), ("2", "o/2", "2", "remote_access"), ("3", "o/3", "3", "other"), ("4", "o/4", "4", None)],
        "node_id string, full_name string, name string, category string",
    )
    facts = spark.createDataFrame(
        [("1", "has_component"), ("1", "has_failure_mode"), ("2", "has_component"), ("2", "supports_task"), ("2", "exposes_api_endpoint")],
        "node_id string, predicate string",
    )
    rows = {r["node_id"]: r for r in audit.coverage_audit(repos, facts, audit.archetype_rules(spark)).collect()}
    assert rows["1"]["behavioral_coverage"] == "full" and rows["1"]["archetype"] == "vector_database"
    assert rows["2"]["behavioral_coverage"] == "thin" and rows["2"]["predicate_check_failures"] == ["uses_protocol"]
    assert rows["3"]["behavioral_coverage"] == "unmatched" == rows["4"]["behavioral_coverage"] and rows["3"]["no_facts"]


def test_enum_agreement(spark):
    frame = spark.createDataFrame([("a", "x"), ("b", "x"), ("a", "y")], "source string, value string")
    found = {(r["value"], r["problem"]) for r in setdiff.enum_agreement(frame, ["x", "z"]).collect()}
    assert found == {("y", "not_in_every_source"), ("z", "required_missing")}


def test_content_hash_ignores_order_but_not_copies_or_nulls(spark):
    rows = [("a", 1), ("b", None), ("b", None)]
    shape = "x string, y int"

    def digest(data):
        return setdiff.content_hash(spark.createDataFrame(data, shape)).head()["digest"]

    assert digest(rows) == digest(rows[::-1]) != digest(rows[:2])
    assert digest([("", 1)]) != digest([(None, 1)])


def test_dangling_references(spark):
    files = spark.createDataFrame([("r", "src/a.py"), ("r", "docs/x/y.md")], "repo string, path string")
    refs = [("d", "r", "src/a.py:41-45"), ("d", "r", "docs/x/"), ("d", "r", "src/b.py"), ("e", "s", "src/a.py")]
    lost = profile.dangling_references(spark.createDataFrame(refs, "doc string, repo string, reference string"), files)
    assert sorted((r["doc"], r["reference"]) for r in lost.collect()) == [("d", "src/b.py"), ("e", "src/a.py")]
    assert profile.dangling_severity(lost).head().asDict() == {"missing": 2, "severity": "medium"}
