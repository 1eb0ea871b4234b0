"""Extraction, judging and consolidation of facts."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from factgraph.operators import consolidate, extract, gates

DOCS = "node_id string, shard string, path string, as_of string, j string"


def sections(spark, body):
    rows = [("repo::example/demo-repo", "repos", "deep/demo-repo.yaml", "2026-02-24", json.dumps(body))]
    return extract.document_sections(spark.createDataFrame(rows, DOCS).withColumn("body", F.parse_json("j")))


def facts_of(spark, body):
    keep = [k for k in body if k in extract.SECTIONS]
    return [r.asDict() for r in extract.section_facts(sections(spark, body), keep).collect()]


def values(facts, predicate, section=""):
    return {f["object_value"] for f in facts if f["predicate"] == predicate and f["source_section"].startswith(section)}


def test_testing_reference_and_integration_sections(spark):
    """A kiln controller nobody has built."""
    body = {
        "testing": {"framework": "bench rig", "structure": ["cold runs", "hot runs"], "how": {"daily": "make fire-test"}},
        "quick_reference": [
            {"name": "Glaze", "command": "make glaze ZONE=2"},
            {"topic": "Cooling", "syntax": "wait until the door unlocks"},
            "npm run vent",
        ],
        "integrations": {
            "alarm_webhooks": [{"url": "/hooks/overheat", "purpose": "siren", "method": "PUT"}, "/hooks/door"],
            "sensors": {"thermocouple": "Type K", "door": "Reed switch"},
        },
        "tech_stack": {"firmware": "Zig"},
        "technology_stack": ["Modbus", ["RS-485"]],
        "api_structure": {"mqtt": {"route": "/kiln/state"}, "zones": [{"endpoint": "/zones/all", "name": "/not/searched"}]},
    }
    facts = facts_of(spark, body)
    assert values(facts, "supports_task", "testing.") == {"make fire-test"}
    assert values(facts, "implements_pattern", "testing.") == {"bench rig", "cold runs", "hot runs"}
    assert values(facts, "supports_task", "quick_reference") == {"make glaze ZONE=2", "Cooling", "npm run vent"}
    assert values(facts, "exposes_api_endpoint") == {"/hooks/overheat", "/hooks/door", "/kiln/state", "/zones/all"}
    assert values(facts, "has_component") == {"Zig", "Modbus", "RS-485"}
    assert values(facts, "has_extension_point") == {"Type K", "Reed switch"}
    assert values(facts, "uses_protocol") == {"MQTT"}
    notes = {f["source_section"]: f["note"] for f in facts if f["predicate"] == "exposes_api_endpoint"}
    assert notes["integrations.alarm_webhooks[0]"] == "PUT; siren" and notes["api_structure.mqtt"] is None
    assert extract.unmapped_section_findings(sections(spark, body)).isEmpty()


def test_scalar_sections_and_ports(spark):
    body = {
        "type": "application_platform",
        "primary_language": "Go",
        "languages": ["Python", "Rust"],
        "ports": {"grpc": 19530, "metrics": 9091},
        "related_repos": ["langchain", "llama_index"],
    }
    facts = facts_of(spark, body)
    assert values(facts, "has_component", "type.") == {"application_platform"}
    assert values(facts, "has_component", "primary_language.") == {"Go"}
    assert values(facts, "has_component", "languages") == {"Python", "Rust"}
    assert values(facts, "has_extension_point", "related_repos") == {"langchain", "llama_index"}
    assert {f["note"] for f in facts if f["source_section"].startswith("ports")} == {"port: 19530", "port: 9091"}


def test_odd_shapes_and_notes(spark):
    long = "word " * 100
    body = {
        "troubleshooting": [{"issue": "slow", "fix": long, "confidence": "0.3"}, "no mapping", {"symptom": "hot", "confidence": 9}],
        "configuration": [{"options": [{"key": "a"}, "x", {"b": 1}]}, {"name": "c", "default": "d"}],
        "core_modules": {"z": {"path": "src/z", "description": "Z.", "submodules": ["q", " "]}, "a": {"path": "SRC/Z"}},
        "cli_arguments": "none",
        "environment": {"g": ["A", ""], "h": "x"},
        "sdk_usage": {"go": {"package": "'pkg>=1'"}, "py": "from tool.core import x", "sh": "nothing here"},
    }
    facts = facts_of(spark, body)
    by_section = {f["source_section"]: f for f in facts}
    assert by_section["troubleshooting[0]"]["confidence"] == 0.3 and by_section["troubleshooting[1]"]["confidence"] == 0.74
    note = by_section["troubleshooting[0]"]["note"]
    assert len(note) > 500 and not note.endswith("...") and note.startswith("fix: word")  # whole, never cut
    assert {s: f["object_value"] for s, f in by_section.items() if s.startswith("configuration")} == {
        "configuration[0].options[0]": "a",
        "configuration[0].options[2]": "b",
        "configuration[1]": "c",
    }
    # Keys run in order and the later spelling of a known path is left out.
    assert [f["object_value"] for f in facts if f["source_section"].startswith("core_modules")] == ["SRC/Z"]
    assert values(facts, "has_config_option", "environment") == {"A"}
    tools = {f["source_section"]: f["object_node_id"] for f in facts if f["source_section"].startswith("sdk_usage")}
    assert tools == {"sdk_usage.go": "external_tool::pkg", "sdk_usage.py": "external_tool::tool"}


def test_depth_is_unbounded(spark):
    tree = "Leaf"
    for i in range(60):
        tree = {f"k{i}": [tree]}
    assert [f["object_value"] for f in facts_of(spark, {"tech_stack": tree})] == ["Leaf"]


def draft(value, note="authoritative draft", **changes):
    row = {
        "fact_type": "implementation_pattern", "predicate": "implements_pattern", "object_kind": "concept",
        "object_value": value, "note": note, "confidence": 0.91, "as_of": "2026-02-24",
        "evidence": [{"kind": "file_block", "ref": "facts[0]", "source_file": "drafts/demo-repo.yaml"}],
    }
    return row | changes


def drafts_of(spark, rows, **judge):
    doc = [("repo::example/demo-repo", "repos", "drafts/demo-repo.yaml", "2026-02-24", json.dumps({"facts": rows}))]
    docs = spark.createDataFrame(doc, DOCS).withColumn("body", F.parse_json("j"))
    return extract.judge_facts(extract.draft_facts(docs), **judge)


def test_unknown_predicate_blocks_unless_lenient(spark):
    bad = draft("x", predicate="mystery_predicate")
    strict = drafts_of(spark, [bad])
    assert strict.valid.isEmpty()
    assert [(r["reason"], r["severity"]) for r in strict.findings.collect()] == [("unknown_predicate", "blocking")]
    assert [r["severity"] for r in drafts_of(spark, [bad], strict_predicates=False).findings.collect()] == ["non_blocking"]


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({"confidence": 1.2}, "invalid_confidence"),
        ({"confidence": "much"}, "invalid_confidence"),
        ({"object_kind": "operation"}, "unknown_object_kind"),
        ({"fact_type": "idea"}, "unknown_fact_type"),
        ({"object_value": " "}, "missing_object_value"),
        ({"object_kind": "external_tool"}, "missing_object_node_id"),
        ({"evidence": []}, "missing_or_invalid_evidence"),
        ({"evidence": [{"kind": "file_block"}]}, "invalid_evidence_required_fields"),
        ({"evidence": [{"kind": "rumour", "ref": "r"}]}, "unknown_evidence_kind"),
    ],
)
def test_draft_rules(spark, changes, reason):
    judged = drafts_of(spark, [draft("x", **changes)])
    assert [r["reason"] for r in judged.findings.collect()] == [reason] and judged.valid.isEmpty()


def test_draft_takes_the_place_of_the_merged_derived_fact(spark):
    pattern = {"pattern": "Factory Registration", "description": "d1", "location": "src/a.py"}
    derived = extract.judge_facts(
        extract.section_facts(sections(spark, {"implementation_patterns": [pattern, pattern]}), ["implementation_patterns"])
    )
    judged = drafts_of(spark, [draft("Factory Registration")])
    result = consolidate.consolidate(derived.valid.unionByName(judged.valid.drop("shard")))
    assert [r["note"] for r in result.facts.collect()] == ["authoritative draft"]
    assert sorted(r["reason"] for r in result.ledger.collect()) == ["draft_precedence_override", "duplicate_derived_merged"]
    assert gates.rule_findings(result.facts, gates.fact_rules(), ["fact_id"]).isEmpty()


def brute_consolidate(rows):
    """The sequential definition: merge derived rows, let drafts replace slots."""
    merged, out = {}, []
    for r in sorted(r for r in rows if r[2] == "derived"):
        key = (r[1], r[3])
        if key in merged:
            merged[key][1].update(r[4])
        else:
            merged[key] = (r, set(r[4]))
            out.append(key)
    final = [(merged[k][0][1], merged[k][0][3], frozenset(merged[k][1])) for k in out]
    index = {f[0]: i for i, f in enumerate(final)}
    for r in sorted(r for r in rows if r[2] == "draft"):
        fact = (r[1], r[3], frozenset(r[4]))
        if r[1] in index:
            final[index[r[1]]] = fact
        else:
            index[r[1]] = len(final)
            final.append(fact)
    return sorted((v, n, sorted(e)) for v, n, e in final)


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_consolidation_equals_the_sequential_definition(spark, hot_rows):
    import random

    rng = random.Random(3)
    rows = [
        (f"p{i:03d}", f"v{rng.randrange(6)}", rng.choice(["derived", "derived", "draft"]), f"n{rng.randrange(2)}",
         [f"e{rng.randrange(5)}" for _ in range(2)])
        for i in range(60)
    ]
    shape = (
        "node_id string, fact_type string, predicate string, object_kind string, object_value string, object_node_id string, "
        "note string, confidence double, as_of string, source_file string, source_section string, extraction_mode string, "
        f"evidence {consolidate.EVIDENCE_ARRAY}, pos string"
    )

    def frame(order):
        data = [
            ("n", "t", "p", "concept", v, None, note, 0.5, "2024", "f", "s", mode, [("k", e, "f", None, None, None) for e in ev], pos)
            for pos, v, mode, note, ev in order
        ]
        return spark.createDataFrame(data, shape).repartition(3)

    def outcome(order):
        result = consolidate.consolidate(frame(order), hot_rows)
        refs = result.evidence.groupBy("fact_id").agg(F.array_sort(F.collect_list("ref")).alias("refs"))
        full = result.facts.join(refs, "fact_id")
        return sorted((r["object_value"], r["note"], r["refs"], r["fact_id"]) for r in full.collect())

    got = outcome(rows)
    assert [g[:3] for g in got] == [tuple(x) for x in brute_consolidate(rows)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    assert outcome(shuffled) == got


def test_cold_facts_move_once_and_evidence_without_fields_counts(spark):
    schema = ", ".join(f"{c} {'double' if c == 'confidence' else 'string'}" for c in consolidate.CONTENT)
    schema += f", evidence {consolidate.EVIDENCE_ARRAY}, pos string"
    content = ("repo::kiln", "component", "has_component", "concept", "Zig", None, "n", 0.8, "2024", "f", "s", "derived")
    item = ("file_line", "line 1", "f", None, 1, None)
    rows = [(*content, [item, item, None], "1"), (*content, [item, (None,) * 6], "2"), (*content[:6], "other", *content[7:], [], "3")]
    result = consolidate.consolidate(spark.createDataFrame(rows, schema))
    for table in (result.facts, result.evidence, result.ledger):
        assert table._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r.note, r.copies, r.evidence_count) for r in result.facts.collect()) == [("n", 2, 2), ("other", 1, 0)]
    assert sorted(str(r.ref) for r in result.evidence.collect()) == ["None", "line 1"]
    assert [(r.reason, r.pos) for r in result.ledger.collect()] == [("duplicate_derived_merged", "2")]
    # The summary reads the candidates once, without their evidence.
    summary = consolidate.consolidation_summary(result)
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "evidence" not in plan and plan.count("Exchange hashpartitioning(collision_key") == 1
    busy = consolidate.consolidate(spark.createDataFrame(rows + [(*content[:-1], "draft", [item], "4")], schema), hot_rows=1)
    assert [tuple(x.head()) for x in (summary, consolidate.consolidation_summary(busy))] == [(2, 1, 0, 1), (2, 1, 1, 1)]



def test_best_confidence_keeps_the_first_of_equals_and_null_keys(spark):
    rows = [
        ("f", "p", "v", 0.5, 0), ("f", "p", "v", 0.9, 1), ("f", "p", "v", 0.9, 2), ("f", "p", None, 0.1, 3),
        ("f", None, "v", None, 4), ("g", "p", "v", None, 5),
    ]
    facts = spark.createDataFrame(rows, "source_file string, predicate string, object_value string, confidence double, pos int")
    assert sorted(r["pos"] for r in consolidate.best_confidence(facts).collect()) == [1, 3, 4, 5]
