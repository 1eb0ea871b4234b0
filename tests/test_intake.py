"""Ingestion, identity files and the admission stream on small inputs."""

from __future__ import annotations

import copy
import json

import pytest
from pyspark.sql import functions as F

from factgraph.functions.text import full_name_of_url, mentioned_full_names, slug, strip_branch_suffix
from factgraph.operators import identity, intake, setdiff
from factgraph.streaming.admission import admit_stream, candidate_files

ROWS = [
    {
        "name": "cloudflared", "github_full_name": "cloudflare/cloudflared", "source": "remote_metadata",
        "category": "network_infrastructure", "summary": "Cloudflare Tunnel client",
        "core_concepts": ["Tunnel client", "Zero trust edge"], "key_entry_points": ["cmd/cloudflared", "README.md"],
        "build_run": {"language": "go"},
    },
    {
        "name": "tailscale", "github_full_name": "tailscale/tailscale", "source": "remote_api", "category": "vpn_mesh",
        "summary": "WireGuard mesh network", "core_concepts": ["Mesh VPN"], "key_entry_points": ["cmd/tailscale"],
        "build_run": {"language": "go"},
    },
]
SHAPE = "idx int, j string, is_mapping boolean, default_shard string, default_as_of string"


def normalized(spark, rows):
    data = [(i, json.dumps(r), isinstance(r, dict), "repos", "2026-02-23") for i, r in enumerate(rows)]
    return intake.prepared_manifest(spark.createDataFrame(data, SHAPE).withColumn("entry", F.parse_json("j")))


def test_plain_manifest(spark):
    rows = normalized(spark, ROWS)
    records = {r["node_id"]: r for r in intake.load_all_or_nothing(rows).collect()}
    assert sorted(records) == ["repo::cloudflare/cloudflared", "repo::tailscale/tailscale"]
    assert all(r["local_cache_dir"] is None for r in records.values())
    assert records["repo::tailscale/tailscale"]["source_file"] == "repos/knowledge/repos/tailscale.yaml"
    assert all(r["passed"] for r in intake.ingestion_gates(rows).collect())


def test_fallback_fills_only_blanks(spark):
    rows = copy.deepcopy(ROWS)
    spare = {"summary": "From readme", "core_concepts": ["c"], "key_entry_points": ["k"], "build_run": {"language": "x"}}
    rows[0] |= {"summary": " ", "core_concepts": [], "key_entry_points": [], "build_run": {}, "readme_fallback": spare}
    rows[1] |= {"readme_fallback": spare}
    out = normalized(spark, rows)
    one, two = out.orderBy("idx").collect()
    assert one["fallback_fields"] == ["build_run", "core_concepts", "key_entry_points", "summary"] and one["summary"] == "From readme"
    assert two["fallback_fields"] == [] and two["summary"] == "WireGuard mesh network"
    metrics = intake.ingestion_metrics(out).head()
    assert (metrics["fallback_entries"], metrics["fallback_fields"], metrics["fallback_usage_pct"]) == (1, 4, 50.0)


def test_one_bad_row_blocks_the_load(spark):
    rows = normalized(spark, [*ROWS, {**ROWS[0], "summary": ""}, "text", {**ROWS[0], "source": "repos", "file_stem": "Other"}])
    assert intake.load_all_or_nothing(rows).isEmpty()
    reasons = sorted(r["reason"] for r in intake.ingestion_blockers(rows).collect())
    assert reasons == ["invalid_row", "invalid_row", "invalid_row"]
    twice = normalized(spark, [*ROWS, ROWS[0]])
    assert sorted(r["reason"] for r in intake.ingestion_blockers(twice).collect()) == ["duplicate_file", "duplicate_node_id"]


def test_two_runs_are_equal(spark):
    first, second = (intake.manifest_records(normalized(spark, ROWS)).drop("build_run", "extras") for _ in range(2))
    assert setdiff.multiset_diff(first, second).isEmpty()


def test_addresses(spark):
    def one(column, value):
        return spark.createDataFrame([(value,)], "t string").select(column("t")).head()[0]

    text = 'See "git+https://github.com/Own/Repo.git", git@github.com:a/b.git and https://github.com/x/y#top.'
    assert one(mentioned_full_names, text) == ["own/repo", "x/y", "a/b"]
    assert one(full_name_of_url, " https://github.com/Own/Repo.git/ ") == "Own/Repo"
    assert one(full_name_of_url, "https://github.com/Own/Repo/tree/main") == ""
    assert one(lambda c: slug(c, F.lit("fallback")), "-My Repo/É!-") == "my-repo-é"
    assert one(lambda c: slug(c, F.lit("fallback")), "!!") == "fallback"
    assert one(strip_branch_suffix, "tool-MAIN") == "tool"


@pytest.mark.parametrize(
    ("path", "content", "found"),
    [
        ("Cargo.toml", 'repository = "https://github.com/o/rust"\nhomepage = "https://github.com/o/no"', ["o/rust"]),
        ("setup.cfg", "Home-Page = https://github.com/o/cfg\nx = https://github.com/o/no", ["o/cfg"]),
        ("pom.xml", "<scm>https://github.com/o/pom/</scm>\n<name>https://github.com/o/no/</name>", ["o/pom"]),
        ("mkdocs.yml", "  repo_url: https://github.com/o/docs\nsite: https://github.com/o/no", ["o/docs"]),
        ("pubspec.yaml", "homepage: https://github.com/o/dart\nother: https://github.com/o/no", ["o/dart"]),
        (".goreleaser.yml", "url: https://GITHUB.com/o/rel\n", ["o/rel"]),
        ("pyproject.toml", '[tool.poetry]\nrepository = "https://github.com/o/poet"\n', ["o/poet"]),
        ("package.json", '{"repository": "https://github.com/o/a", "bugs": {"url": "https://github.com/o/b/issues"}}', ["o/a", "o/b"]),
        ("package.json", "not json https://github.com/o/no", []),
        ("sub/package.json", '{"repository": "https://github.com/o/no"}', []),
    ],
)
def test_root_files(spark, path, content, found):
    files = spark.createDataFrame([("r", path, content)], "repo string, path string, content string")
    assert sorted(r["full_name"] for r in identity.mine_candidates(files).collect()) == found


def test_choice_rules(spark):
    records = spark.createDataFrame([(r, ["tool"]) for r in "abcde"], "repo string, tokens array<string>")
    rows = [
        ("a", "x/tool", "pyproject_meta"), ("a", "y/tool", "go_mod_module"), ("b", "x/tool", "go_mod_module"),
        ("b", "y/tool", "go_mod_module"), ("c", "x/other", "setup_py_meta"), ("d", "x/p", "setup_py_meta"), ("d", "x/q", "git_origin"),
    ]
    seen = spark.createDataFrame([(*r, r[2]) for r in rows], "repo string, full_name string, source string, other_source string")
    got = {r["repo"]: (r["full_name"], r["status"]) for r in identity.choose_identity(records, seen).collect()}
    assert got == {
        "a": ("y/tool", "resolved"), "b": (None, "ambiguous_self"), "c": ("x/other", "resolved"),
        "d": (None, "ambiguous_other"), "e": (None, "none"),
    }


def test_stream_admits_each_name_once(spark, tmp_path):
    inbox, schema = tmp_path / "inbox", "pos bigint, url string"
    inbox.mkdir()
    address = "https://github.com/o/"
    for n, names in enumerate([["a", "b", "known", "A"], ["b", "c"], ["c", "d", "bad/path"]]):
        lines = [json.dumps({"pos": n * 10 + i, "url": address + x}) for i, x in enumerate(names)]
        (inbox / f"{n}.json").write_text("\n".join(lines))
    catalog = spark.createDataFrame(
        [(0, "https://github.com/O/Known", None, None, None, None, False)],
        "row_index int, url string, author string, repo_name string, category string, local_path string, needs_review boolean",
    )
    stream = candidate_files(spark, str(inbox), schema, files_per_batch=1)
    admitted = admit_stream(stream, catalog, str(tmp_path / "out"))
    assert sorted(r["norm"] for r in admitted.collect()) == ["o/a", "o/b", "o/c", "o/d"]

    # The stream goes on where it ended: what came before is known, the catalog is not read again.
    late = [json.dumps({"pos": 50, "url": address + "E"}), json.dumps({"pos": 49, "url": address + "e"}), json.dumps({"pos": 51, "url": address + "a"})]
    (inbox / "3.json").write_text("\n".join(late * 3))
    again = admit_stream(candidate_files(spark, str(inbox), schema, files_per_batch=1), catalog.limit(0), str(tmp_path / "out"))
    rows = sorted((r["norm"], r["pos"]) for r in again.collect())
    assert [n for n, _ in rows] == ["o/a", "o/b", "o/c", "o/d", "o/e"] and ("o/e", 49) in rows


def test_stream_of_nothing(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "0.json").write_text('{"pos": null, "url": "https://github.com/o/a"}\n{"pos": 1, "url": null}\n')
    catalog = spark.createDataFrame([], "row_index int, url string, author string, repo_name string, category string, local_path string, needs_review boolean")
    assert admit_stream(candidate_files(spark, str(inbox), "pos bigint, url string"), catalog).count() == 0


def test_manifest_rows_are_dealt_over_tasks(spark):
    """One task parsed and normalised the rows of the whole table, which is one small file."""
    from factgraph.plans.intake_queries import manifest_rows

    assert manifest_rows(spark, "/root/testdata/sf0.01").rdd.getNumPartitions() > 1


def test_stream_keeps_names_without_python(spark, tmp_path):
    """Every name cost calls between Spark and a Python worker."""
    from factgraph.streaming.admission import admitted_stream

    (tmp_path / "0.json").write_text('{"pos": 1, "url": "https://github.com/o/a"}\n')
    known = spark.readStream.schema("norm string").parquet(str(tmp_path))
    rows = admitted_stream(candidate_files(spark, str(tmp_path), "pos bigint, url string"), known)
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert "Python" not in plan and "MapInPandas" not in plan and "Aggregate" in plan


def test_stream_goes_on_after_a_batch_that_ran_twice(spark, tmp_path):
    """A batch whose commit was lost runs again and writes what it wrote before; the first row of a name stays whole."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "0.json").write_text('{"pos": 2, "url": "https://github.com/O/a", "note": "late"}\n{"pos": 1, "url": "https://github.com/o/A", "note": null}\n')
    catalog = spark.createDataFrame([], "row_index int, url string, author string, repo_name string, category string, local_path string, needs_review boolean")

    def run():
        return admit_stream(candidate_files(spark, str(inbox), "pos bigint, url string, note string"), catalog, str(tmp_path / "out"))

    first = [tuple(r) for r in run().collect()]
    assert first == [(1, "https://github.com/o/A", None, "o/A", "o/a")]
    for name in ("0", ".0.crc"):
        (tmp_path / "out" / "progress" / "commits" / name).unlink()
    assert [tuple(r) for r in run().collect()] == first
