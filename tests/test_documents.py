"""Scans of odd files: empty ones, bad bytes, values JSON lacks, roots with odd names."""

from __future__ import annotations

from factgraph.operators import identity, profile, setdiff
from factgraph.sources import documents, filescan
from pyspark.sql import functions as F


def test_trees_keep_every_file(spark, tmp_path):
    root = tmp_path / "re+po.s x" / "deep" / "repos"
    files = {
        "a/pkg/__init__.py": b"", "a/m.py": b"x\xff\xe9y", "a/repos/\xe9 b%20.py": b"z", "a/.hidden": b"h", "a/_under": b"u",
        "b/node_modules/q.js": b"1", "b/.terraform.d/x.tf": b"1", "b/k.txt": "é".encode(),
    }
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    rows = documents.repo_files(spark, str(root)).collect()
    assert {(r.repo, r.path): (r.size, r.content) for r in rows} == {
        ("a", "pkg/__init__.py"): (0, ""), ("a", "m.py"): (4, "xy"), ("a", "repos/\xe9 b%20.py"): (1, "z"), ("a", ".hidden"): (1, "h"),
        ("a", "_under"): (1, "u"), ("b", "k.txt"): (2, "é"),
    }
    bare = documents.repo_files(spark, f"file://{root.parent}", 2, with_content=False).collect()
    assert {(r.repo, r.path) for r in bare} == {(f"repos/{r.repo}", r.path) for r in rows}


def test_yaml_faults_are_rows(spark, tmp_path):
    files = {
        "empty": b"", "odd": b"x: .nan\ny: {2020-01-01: 1, 3: [2021-02-03, -.inf]}", "loop": b"a: &a [*a]", "list": b"[1]",
        "bytes": b"a: \xff", "fine": b"a: 1", "twice": b"a: &x [1]\nb: [*x, *x]",
    }
    for name, data in files.items():
        (tmp_path / f"{name}.yaml").write_bytes(data)
    rows = documents.yaml_documents(spark, str(tmp_path)).selectExpr("file", "body::string AS body", "error").collect()
    got = {r.file.removesuffix(".yaml"): (r.body, r.error) for r in rows}
    assert set(got) == set(files)
    assert got["empty"] == ("{}", None) and got["fine"] == ('{"a":1}', None)
    assert got["odd"] == ('{"x":"nan","y":{"2020-01-01":1,"3":[{"date":"2021-02-03"},"-inf"]}}', None)
    assert got["twice"] == ('{"a":[1],"b":[[1],[1]]}', None)
    assert got["loop"][1] == "parse_error: an anchor contains itself"
    assert got["list"] == (None, "invalid_payload_shape")
    assert got["bytes"][0] is None and got["bytes"][1].startswith("parse_error")


def test_imports_of_all_files_count(spark):
    rows = [("r", f"own/f{i:04d}.py", "from own.core import x") for i in range(450)] + [("r", "own/big.py", "from own.core import x\n" * 9000)]
    files = spark.createDataFrame([(r, p, len(c), c) for r, p, c in rows], "repo string, path string, size long, content string")
    roots = spark.createDataFrame([("r", "own")], "repo string, path string")

    def counted(**limits):
        return {r.module: r.imports for r in profile.internal_imports(files, roots, **limits).collect()}

    assert counted() == {"own.core": 9450}
    assert counted(max_bytes=128_000) == {"own.core": 450}
    assert counted(max_files=400, max_bytes=128_000) == {"own.core": 400}


def test_links_and_contracts(spark):
    shallow = spark.createDataFrame([("s", "A-b", "x/A-b.yaml"), ("s", "a_B", "x/a_B.yaml"), ("t", "c", "c.yaml")], "shard string, stem string, file string")
    deep = spark.createDataFrame([("s", "ab", "d1"), ("t", "ab", "d2"), ("t", "C", "d3")], "shard string, stem string, file string")
    got = {r.deep_file: (r.shallow_file, r.problem) for r in identity.link_stems(deep, shallow).collect()}
    assert got == {"d1": ("x/a_B.yaml", None), "d2": (None, "unlinked"), "d3": ("c.yaml", None)}

    artifacts = spark.createDataFrame([("a", True, " 1 "), ("b", True, "1"), ("c", False, "2"), ("d", True, None)], "artifact string, is_mapping boolean, version string")

    def findings(*names):
        return {(r.artifact, r.finding) for r in setdiff.contract_findings(artifacts, names).collect()}

    assert findings("a", "b") == set()
    assert findings("a", "c", "d", "e") == {("c", "no_mapping"), ("d", "no_version"), ("e", "missing")}
    other = artifacts.unionByName(spark.createDataFrame([("z", True, "2")], artifacts.schema))
    assert [tuple(r) for r in setdiff.contract_findings(other, ["a", "z"]).collect()] == [("*", "version_mismatch")]


def test_required_contracts_come_as_a_table(spark):
    artifacts = spark.createDataFrame([("a", True, "1"), ("b", False, "1")], "artifact string, is_mapping boolean, version string")
    required = spark.createDataFrame([("a",), ("b",), ("c",)], "artifact string")
    assert {tuple(r) for r in setdiff.contract_findings(artifacts, required).collect()} == {("b", "no_mapping"), ("c", "missing")}


def test_scans_split_one_tree_by_bytes(spark, tmp_path):
    for i in range(40):
        at = tmp_path / "t" / "big" / f"d{i % 3}"
        at.mkdir(parents=True, exist_ok=True)
        (at / f"f{i}.bin").write_bytes(bytes([i]) * (3000 if i == 7 else 100))
    listed = filescan.list_files(spark, str(tmp_path / "t"), ["*"])
    assert listed.count() == 40
    rows = filescan.read_files(spark, str(tmp_path / "t"), listed, target=500, opening=10)
    parts = rows.select("path", "size", F.spark_partition_id().alias("part"), F.length("content").alias("n")).collect()
    assert len(parts) == 40 and all(r["size"] == r["n"] for r in parts)
    by_part = {}
    for r in parts:
        by_part.setdefault(r.part, []).append(r)
    assert len(by_part) >= 10  # one repository, many partitions
    assert all(sum(r["size"] for r in part) <= 1100 or len(part) <= 5 for part in by_part.values())
    spans = sorted((min(r.path for r in p), max(r.path for r in p)) for p in by_part.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))  # runs of paths
    assert rows.filter("path IS NULL").count() == 0
    few = documents.repo_files(spark, str(tmp_path / "t"), target=500, opening=10)
    assert few.select("repo").distinct().collect()[0][0] == "big" and few.count() == 40


def test_scans_of_nothing_and_of_patterns(spark, tmp_path):
    for name in ("a1/x/p.yaml", "a2/x/q.yaml", "b1/x/r.yaml", "a1/y/s.yaml", "a1/x/deep/t.yaml", "a2/x/_no.yaml", "a2/.x/n.yaml", "a2/x/u.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("k: 1")

    def names(folder, pattern="*.yaml"):
        return sorted(r.path.rsplit("/", 1)[1] for r in documents.binary_files(spark, folder, pattern).collect())

    assert names(f"{tmp_path}/a*/x") == ["p.yaml", "q.yaml"]
    assert names(f"file:{tmp_path}/{{a1,b?}}/*") == ["p.yaml", "r.yaml", "s.yaml"]
    assert names(f"{tmp_path}/a2/x", "[pu]*") == ["u.txt"]
    assert names(f"{tmp_path}/nowhere") == [] and documents.repo_files(spark, str(tmp_path / "none")).count() == 0
    assert filescan.split_pattern("hdfs://n/a/b*/c") == ("hdfs://n/a", ["b*", "c"])


def test_entries_that_are_no_mapping_are_reported(spark):
    rows = spark.sql("""SELECT * FROM VALUES ('a', parse_json('{"edges": [{"src_id": "x"}, "no", 3]}')), ('b', parse_json('{"edges": "text"}')),
        ('c', parse_json('{"edges": null}')), ('d', parse_json('{}')) AS t(path, body)""")
    assert {tuple(r) for r in documents.entry_findings(rows, "edges").collect()} == {("a", 1, "entry_no_mapping"), ("a", 2, "entry_no_mapping"), ("b", None, "no_list")}


def test_edge_documents_are_parsed_once(spark, sf):
    """Edges and both kinds of findings each opened and parsed all files."""
    from factgraph.plans import source_queries

    plan = source_queries.edge_scan(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    # The one that is left parses the contract document.
    assert plan.count("MapInPandas") == 1


def test_files_of_a_small_table_are_written_by_many_tasks(spark, tmp_path):
    from factgraph.plans import source_queries

    cols = "id AS p_partkey", "concat('n', id) AS p_name", "'B' AS p_brand", "'T' AS p_type", "CAST(id % 50 AS INT) AS p_size"
    spark.range(9000).selectExpr(*cols).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for made, copies in ((source_queries.manifest_files, 2), (source_queries.yaml_files, 1), (source_queries.keyed_documents, 1)):
        files = made(spark, str(tmp_path))
        sizes = files.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(sizes) >= 8 * copies and files.select("path").distinct().count() == 9000 * copies


def test_many_small_files_take_few_tasks(spark):
    files = spark.range(100_000).select(F.concat(F.lit("/t/f"), "id").alias("path"), F.lit(900).cast("long").alias("size"))
    _, parts = filescan.plan_scan(files)
    assert spark.sparkContext.defaultParallelism <= parts < 100
    _, few = filescan.plan_scan(files.limit(300))
    assert 1 < few <= 5  # a small scan is dealt over the cores as well


def test_flat_folder_is_listed_in_parts_and_left_clean(spark, tmp_path, monkeypatch):
    content = F.encode(F.concat(F.lit("a: "), "id"), "UTF-8")
    filescan.write_files(spark.range(40).repartition(3).select(F.concat(F.lit("d/f"), "id").alias("path"), content.alias("content")), str(tmp_path / "t"))
    assert sorted(p.name for p in (tmp_path / "t").rglob("*")) == sorted(["d", *(f"f{i}" for i in range(40))])
    (tmp_path / "t" / "d" / "below").mkdir()
    (tmp_path / "t" / "d" / "gone").symlink_to(tmp_path / "nowhere")
    monkeypatch.setattr(filescan, "LISTED", 7)
    store, at = filescan.open_store(str(tmp_path / "t" / "d"))
    parts = list(filescan.entries(store, at))
    assert len(parts) == 6 and all(len(p) <= 7 for p in parts)
    rows = [e for p in parts for e in p]
    assert sorted(e[0] for e in rows if e[3]) == sorted(f"{at}/f{i}" for i in range(40))
    assert {e[1]: e[4] for e in rows if e[3]}["f12"] == 5 and [e[1] for e in rows if e[2]] == ["below"]
    assert list(filescan.entries(store, f"{at}/none")) == []


def test_yaml_read_off_nodes_equals_yaml_built(monkeypatch):
    import yaml

    texts = [
        "", "~", "a", "[1, a]", "a: 1\na: 2\nb: 0x1F", "a: yes\nb: 'yes'\nc: 1_0\nd: 1e3\ne: 1.5e+3\nf: null", "1: a\n'1': b", "? [a]\n: b", "<<: {a: 1}\nb: 2",
        "x: &b {k: 1}\ny:\n  <<: *b\n  z: 3", "a: &a [*a]", "&a [*a]", "a: !!set {x, y}", "a: !!binary aGk=", "a: !odd b", "a: =", "a: 2024-01-05\nb: 2024-01-05 10:00:00",
        "a: .nan\nb: -.inf", "a: [1", "a: 1\n---\nb: 2", "a: *none", "a: !!str 5\nb: !!int '7'", "a: |\n  two\n  lines\n" + "l" * 90 + ": " + "9" * 90, "a: &x [1]\nb: [*x, *x]",
        "true: 1\nnull: 2", "a: !!map [1]", "a: !!seq b", "a: \"\\u00e9 \U0001d400\"",
    ]
    plain = documents.Plain()

    def told(read):
        try:
            return read()
        except Exception as exc:
            return f"{type(exc).__name__}: {exc}"

    def whole(text):
        value = yaml.load(text, Loader=yaml.CSafeLoader)  # noqa: S506 (a safe loader)
        return documents.plain_value(value) if isinstance(value, dict) else value

    for text in texts * 2:  # the second time scalars are remembered
        got, want = told(lambda t=text: plain.load(t)), told(lambda t=text: whole(t))
        if isinstance(want, (dict, str, type(None))):
            assert repr(got) == repr(want), text
        else:
            assert type(got) is type(want) or not isinstance(got, dict), text
    # Documents of plain mappings, lists and scalars never build PyYAML's own values.
    monkeypatch.setattr(yaml, "load", None)
    assert documents.Plain().load("edges:\n- {src_id: 'a', n: 5}\n- see 3\n- d: 2024-01-05\n") == {
        "edges": [{"src_id": "a", "n": 5}, "see 3", {"d": {"date": "2024-01-05"}}]
    }
