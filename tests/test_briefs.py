"""Seeded briefs: values and order as the query tests of the blueprint state them."""

from __future__ import annotations

import pytest

from factgraph.operators import briefs, lookup, traversal

REPOS = "node_id string, name string, full_name string, category string, ordinal int"
FACTS = "fact_id string, node_id string, predicate string, object_kind string, object_value string, note string"
TIMEOUT = "Query timeout under high-ingest load"


def repo(owner, name, title, category, n):
    return (f"repo::{owner}/{name}", title, f"{owner}/{name}", category, n)


@pytest.fixture(scope="module")
def repos(spark):
    rows = [
        repo("qdrant", "qdrant", "Qdrant", "vector_database", 0),
        repo("weaviate", "weaviate", "Weaviate", "vector_database", 1),
        repo("lancedb", "lancedb", "LanceDB", "vector_database", 2),
        repo("chroma-core", "chroma", "Chroma", "vector_database", 3),
        repo("open-webui", "open-webui", "Open WebUI", "ui_tools", 4),
    ]
    return spark.createDataFrame(rows, REPOS)


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        ("1", "repo::qdrant/qdrant", "has_failure_mode", "issue", TIMEOUT, "Seen during sustained write load tests"),
        ("2", "repo::weaviate/weaviate", "has_failure_mode", "issue", TIMEOUT, "Manifests when indexing exceeds 1M vectors"),
        ("3", "repo::lancedb/lancedb", "has_failure_mode", "issue", TIMEOUT, ""),
        ("4", "repo::chroma-core/chroma", "has_failure_mode", "issue", "Background indexing stalls",
         "Reproducible with large batch writes"),
        ("5", "repo::open-webui/open-webui", "has_failure_mode", "issue", TIMEOUT, None),
        ("6", "repo::qdrant/qdrant", "uses_protocol", "protocol", "gRPC", None),
    ]
    return spark.createDataFrame(rows, FACTS)


@pytest.fixture(scope="module")
def more(spark, facts):
    rows = [
        ("7", "repo::chroma-core/chroma", "has_failure_mode", "issue", "Read-only startup fails after lockfile recovery", ""),
        ("8", "repo::chroma-core/chroma", "has_failure_mode", "issue", "NCCL timeout errors in multi-GPU", ""),
    ]
    return facts.unionByName(spark.createDataFrame(rows, FACTS))


def test_flat_pattern_is_ordered_by_name(facts, repos):
    rows = briefs.pattern(facts, repos, "has_failure_mode", "VECTOR_DATABASE", "timeout").collect()
    assert [r["name"] for r in rows] == ["LanceDB", "Qdrant", "Weaviate"]


def test_frequency_counts_and_examples(facts, repos):
    rows = briefs.pattern_frequency(facts, repos, "has_failure_mode", "vector_database").collect()
    assert [(r["object_value"], r["repo_count"], r["repo_fraction"], r["scope_repo_count"]) for r in rows] == [
        (TIMEOUT, 3, 0.75, 4),
        ("Background indexing stalls", 1, 0.25, 4),
    ]
    assert rows[0]["example_repos"] == ["lancedb/lancedb", "qdrant/qdrant", "weaviate/weaviate"]


def test_failure_brief_ranks_and_reports_a_thin_scope(facts, repos):
    rows = briefs.failure_brief(facts, repos, "vector_database").collect()
    assert [(r["failure_mode"], r["repo_count"], r["repo_fraction"]) for r in rows] == [
        (TIMEOUT, 3, 0.75),
        ("Background indexing stalls", 1, 0.25),
    ]
    assert len(rows[0]["evidence_notes"]) == 2
    assert briefs.failure_reliability(facts, repos, "vector_database").head()["scope_assessment"] == "thin"


@pytest.mark.parametrize(
    ("term", "found"),
    [
        ("Background", "Background indexing stalls"),
        ("batch writes", "Background indexing stalls"),
        ("read only", "Read-only startup fails after lockfile recovery"),
        ("multi gpu", "NCCL timeout errors in multi-GPU"),
        ("batch upserts", "Background indexing stalls"),
    ],
)
def test_failure_terms(more, repos, term, found):
    rows = briefs.failure_brief(more, repos, "vector_database", [term]).collect()
    assert [r["failure_mode"] for r in rows] == [found]


def test_many_terms_give_what_each_gives_alone(more, repos):
    terms = ["Background", "timeout", "read only", "?!"]
    together = briefs.failure_brief(more, repos, "vector_database", terms).collect()
    alone = [r for t in terms for r in briefs.failure_brief(more, repos, "vector_database", [t]).collect()]
    pick = ["term", "rank", "failure_mode", "repo_count", "example_repos", "evidence_notes"]
    assert [[r[c] for c in pick] for r in together] == [[r[c] for c in pick] for r in alone]


def test_empty_scope(facts, repos):
    assert briefs.failure_brief(facts, repos, "agent_framework").collect() == []
    assert briefs.failure_reliability(facts, repos, "agent_framework").head()["scope_assessment"] == "empty"


@pytest.fixture(scope="module")
def risk(spark):
    people = [repo("o", x, x, "agent_cli", i) for i, x in enumerate("abcde")] + [repo("o", "x", "x", "other_cat", 9)]
    loop = "Command-driven task loop"
    rows = [
        ("1", "a", "implements_pattern", loop), ("2", "b", "implements_pattern", loop), ("3", "c", "implements_pattern", loop),
        ("4", "c", "has_component", "ACP server"), ("5", "a", "uses_protocol", "gRPC"), ("6", "b", "uses_protocol", "gRPC"),
        ("6b", "d", "has_component", "Read-only job cache"), ("6c", "d", "uses_protocol", "Server-Sent Events"),
        ("6d", "e", "implements_pattern", "Multi-agent task orchestration"), ("7", "x", "implements_pattern", loop),
    ]
    facts = [(i, f"repo::o/{r}", p, "concept", v, None) for i, r, p, v in rows]
    return spark.createDataFrame(facts, FACTS), spark.createDataFrame(people, REPOS)


@pytest.mark.parametrize(
    ("kind", "term", "bucket", "count", "share"),
    [
        ("patterns", "command-driven", "established", 3, 0.6),
        ("patterns", "command driven task loop", "established", 3, 0.6),
        ("components", "ACP server", "rare", 1, 0.2),
        ("components", "ACP", "rare", 1, 0.2),
        ("components", "read only job cache", "rare", 1, 0.2),
        ("protocols", "MCP", "absent", 0, 0.0),
        ("protocols", "server sent events", "rare", 1, 0.2),
    ],
)
def test_risk_buckets(risk, kind, term, bucket, count, share):
    row = briefs.riskcheck(*risk, "AGENT_CLI", **{kind: [term]}).head()
    assert (row["bucket"], row["matched_repo_count"], row["matched_repo_fraction"]) == (bucket, count, share)
    assert len(row["example_repos"]) == count and "o/x" not in row["example_repos"]


def test_risk_order_counts_and_cut(risk):
    asked = {"patterns": ["command-driven"], "protocols": ["gRPC", "MCP"]}
    rows = briefs.riskcheck(*risk, "agent_cli", **asked).collect()
    assert [(r["bucket"], r["matched_repo_count"]) for r in rows] == [("established", 3), ("established", 2), ("absent", 0)]
    assert briefs.riskcheck_counts(briefs.riskcheck(*risk, "agent_cli", **asked, limit=2)).head().asDict() == {
        "established_in_category": 2,
        "rare_in_category": 0,
        "absent_from_category": 0,
    }
    assert briefs.corpus_health(*risk, "agent_cli").head().asDict() == {"scope_repo_count": 5, "fact_count_in_scope": 9}
    with pytest.raises(ValueError):
        briefs.riskcheck(*risk, "agent_cli")


def test_search_keeps_wildcards_and_folds_ascii_only(spark):
    rows = [("1", "n", "p", "k", "Straße 100%", ""), ("2", "n", "p", "k", "a\\b", ""), ("3", "n", "p", "k", None, "STRASSE")]
    facts = spark.createDataFrame(rows, FACTS)

    def ids(term, field="both"):
        return [r["fact_id"] for r in lookup.search(facts, term, field).collect()]

    assert ids("STRAß") == ["1"] and ids("s%0") == ["1"] and ids("a\\b") == ["2"] and ids("strasse", "note") == ["3"]


def test_resolution_order(spark):
    rows = [
        ("repo::1", "Same", "o/one", "c", 0), ("repo::2", "Same", "o/two", "c", 1), ("repo::3", "o/one", None, "c", 2),
        ("repo::4", "sAME", "O/TWO", "c", 3),
    ]
    repos = spark.createDataFrame(rows, REPOS)
    asked = spark.createDataFrame([("Same",), ("o/one",), ("SAME",), ("O/Two",), ("none",), ("repo::4",)], "identifier string")
    found = {r["identifier"]: r["node_id"] for r in lookup.resolve_identifiers(asked, repos).collect()}
    # Last exact name, name before full name, first folded name and full name.
    assert found == {"Same": "repo::2", "o/one": "repo::3", "SAME": "repo::1", "O/Two": "repo::2", "none": None, "repo::4": "repo::4"}


def brute_walk(edges, start, hops):
    seen, front, layers, all_edges = {start}, {start}, [], []
    for hop in range(1, hops + 1):
        hit = [(s, d, r, n) for s, d, r, n in edges if s in front or d in front]
        new = {x for s, d, _, _ in hit for x in (s, d)} - seen
        kept = {}
        for s, d, r, n in hit:
            kept[s, d, r] = min(kept.get((s, d, r), n), n)
        all_edges += [(hop, *k, n) for k, n in kept.items()]
        layers.append((hop, len(kept), len(new)))
        seen |= new
        front = new
        if not front:
            break
    return sorted(all_edges), layers, sorted(seen - {start})


@pytest.mark.parametrize("salted", [False, True])
def test_walk_equals_brute_force(spark, monkeypatch, salted):
    if salted:
        # Every frontier counts as large, so the salted join is taken.
        monkeypatch.setattr(traversal, "BROADCAST_ROW_LIMIT", 0)
    edges = [(f"n{i}", f"n{(i * 7 + 3) % 23}", "r", f"x{i}") for i in range(40)] + [("n1", "n5", "r", "a"), ("n1", "n5", "r", "b")]
    frame = spark.createDataFrame(edges, "src_id string, dst_id string, relation string, note string")
    starts = spark.createDataFrame([("n1",), ("lonely",)], "start_id string")
    walk = traversal.traverse(starts, frame)
    want_edges, want_layers, want_nodes = brute_walk(edges, "n1", 3)
    got = walk.edges.filter("start_id = 'n1'").collect()
    assert sorted((r["hop"], r["src_id"], r["dst_id"], r["relation"], r["note"]) for r in got) == want_edges
    layers = {(r["start_id"], r["hop"]): (r["edges_found"], r["new_nodes"]) for r in walk.layers.collect()}
    assert [(h, *layers["n1", h]) for h in sorted(k[1] for k in layers if k[0] == "n1")] == want_layers
    assert layers["lonely", 1] == (0, 0) and ("lonely", 2) not in layers
    assert sorted(r["node_id"] for r in walk.reached.filter("start_id = 'n1' AND hop > 0").collect()) == want_nodes


def test_walks_over_hubs_equal_walks_by_broadcast(spark):
    rows = [("hub", f"n{i}", "uses", f"note {i % 3}") for i in range(700)] + [(f"n{i}", f"m{i % 50}", "uses", None) for i in range(700)]
    rows += [("m1", "m1", "self", "s"), ("m2", "hub", "back", "b"), ("hub", "n1", "uses", "a")]
    edges = spark.createDataFrame(rows, "src_id string, dst_id string, relation string, note string")
    starts = spark.createDataFrame([("hub",), ("n5",), ("nowhere",)], "start_id string")

    def outcome(**limits):
        walk = traversal.traverse(starts, edges, 3, **limits)
        return [sorted(map(repr, df.collect())) for df in (walk.reached.select("start_id", "node_id", "hop"), walk.edges.select("start_id", "hop", "src_id", "dst_id", "relation", "note"), walk.layers)]

    assert outcome(hub_rows=30, broadcast_rows=0) == outcome()
    steps, hubs = traversal.adjacency(edges, None, "both", 30)
    assert {r.node_id: r.parts for r in hubs.collect()} == {"hub": 24}  # 702 steps leave the hub
    front = spark.createDataFrame([("s", "hub"), ("s", "n5")], "start_id string, node_id string")
    parts = traversal.dealt_join(steps, front, hubs).filter("node_id = 'hub'").groupBy("part").count().collect()
    assert len(parts) > 8 and max(r["count"] for r in parts) < 200
