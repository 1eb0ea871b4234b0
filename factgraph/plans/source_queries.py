"""Scans of files that Spark writes from the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factgraph.operators import keypaths
from factgraph.plans import bindings as b
from factgraph.plans.registry import query
from factgraph.session import shared_dir, spread, staged
from factgraph.sources import documents, filescan


def written(spark, files):
    """A new folder in the shared one that holds ``files(path, content)``."""
    folder = f"{shared_dir(spark).rstrip('/')}/factgraph-files/{uuid.uuid4().hex}"
    filescan.write_files(files, folder)
    return folder


# --- trees ------------------------------------------------------------------------


def tree_files(spark, sf):
    """Documents as files of source trees, a third of them in one tree; every seventh below an
    ignored folder, some empty, some with a byte that is no UTF-8."""
    key = F.col("doc_id")
    above = (
        F.when(key % 7 == 0, "node_modules/").when(key % 7 == 1, "_under/").when(key % 7 == 2, ".hid/den/").when(key % 7 == 3, "src/vendor/x/")
        .otherwise(F.concat(F.lit("src/"), F.coalesce("lang", F.lit("none")), F.lit("/")))
    )
    repo = F.when(key % 3 == 0, "hot").otherwise(F.coalesce("source", F.lit("none")))
    bad = F.when(key % 11 == 0, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit("")))
    content = F.when(key % 17 == 0, F.unhex(F.lit(""))).otherwise(F.concat(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), bad))
    path = F.concat(repo, F.lit("/"), above, F.lit("d"), key, F.lit(".txt"))
    return b.table(spark, sf, "documents").filter("doc_id IS NOT NULL").select(path.alias("path"), content.alias("content"))


@query(
    "tree_scan",
    """
WITH d AS (
  SELECT doc_id, CASE WHEN doc_id % 17 = 0 THEN '' ELSE coalesce(text, '') END AS t, CASE WHEN doc_id % 11 = 0 AND doc_id % 17 <> 0 THEN 1 ELSE 0 END AS bad,
    CASE WHEN doc_id % 3 = 0 THEN 'hot' ELSE coalesce(source, 'none') END AS repo,
    CASE doc_id % 7 WHEN 1 THEN '_under/' WHEN 2 THEN '.hid/den/' ELSE 'src/' || coalesce(lang, 'none') || '/' END AS above
  FROM documents WHERE doc_id IS NOT NULL AND doc_id % 7 NOT IN (0, 3))
SELECT repo, above || 'd' || doc_id || '.txt' AS path, strlen(t) + bad AS size, sha256(t) AS content_sha256 FROM d""",
)
def tree_scan(spark, sf):
    """Every file of the trees but those below ignored folders, read whole."""
    rows = documents.repo_files(spark, written(spark, tree_files(spark, sf)))
    return rows.select("repo", "path", "size", F.sha2("content", 256).alias("content_sha256"))


# --- documents --------------------------------------------------------------------

# YAML by remainder of the part's key: empty, plain, no mapping, broken, with a date, with bytes
# that are no text, with an anchor, hidden by its name.
_YAML = [
    "", "name: @name\nsize: @size\ntags: [@type, @brand]\n", "- @name\n", "name: [@name\n", "as_of: 2024-01-05\nname: @name\n",
    "name: ", "base: &b {k: @size}\ncopy: *b\n", "name: @name\n",
]


def yaml_files(spark, sf):
    way = (F.col("p_partkey") % 8).cast("int")
    text = F.get(F.array(*[F.lit(t) for t in _YAML]), way)
    for mark, value in (("@name", "p_name"), ("@size", "p_size"), ("@type", "p_type"), ("@brand", "p_brand")):
        text = F.replace(text, F.lit(mark), F.col(value).cast("string"))
    content = F.concat(F.encode(text, "UTF-8"), F.when(way == 5, F.unhex(F.lit("FF"))).otherwise(F.unhex(F.lit(""))))
    name = F.concat(F.when(way == 7, "_p").otherwise("p"), F.col("p_partkey"), F.lit(".yaml"))
    folder = F.when(F.col("p_size") % 2 == 0, "deep").otherwise("drafts")
    return spread(b.table(spark, sf, "part")).select(F.concat_ws("/", folder, name).alias("path"), content.alias("content"))


@query(
    "document_scan",
    """
WITH p AS (SELECT *, p_partkey % 8 AS way FROM part)
SELECT CASE WHEN p_size % 2 = 0 THEN 'narrative' ELSE 'draft' END AS kind, 'p' || p_partkey || '.yaml' AS file,
  CASE way WHEN 0 THEN '{}' WHEN 1 THEN '{"name":"' || p_name || '","size":' || p_size || ',"tags":["' || p_type || '","' || p_brand || '"]}'
    WHEN 4 THEN '{"as_of":{"date":"2024-01-05"},"name":"' || p_name || '"}'
    WHEN 6 THEN '{"base":{"k":' || p_size || '},"copy":{"k":' || p_size || '}}' END AS body,
  CASE WHEN way = 2 THEN 'invalid_payload_shape' WHEN way IN (3, 5) THEN 'parse_error' END AS error,
  CASE way WHEN 0 THEN sha256('') WHEN 5 THEN sha256('name: '::BLOB || '\\xFF'::BLOB) WHEN 2 THEN sha256('- ' || p_name || chr(10))
    WHEN 4 THEN sha256('as_of: 2024-01-05' || chr(10) || 'name: ' || p_name || chr(10)) WHEN 3 THEN sha256('name: [' || p_name || chr(10))
    WHEN 1 THEN sha256('name: ' || p_name || chr(10) || 'size: ' || p_size || chr(10) || 'tags: [' || p_type || ', ' || p_brand || ']' || chr(10))
    WHEN 6 THEN sha256('base: &b {k: ' || p_size || '}' || chr(10) || 'copy: *b' || chr(10)) END AS sha256
FROM p WHERE way <> 7""",
)
def document_scan(spark, sf):
    """Narrative and draft documents of two folders, faults as rows."""
    folder = written(spark, yaml_files(spark, sf))
    rows = documents.narrative_and_drafts(spark, f"{folder}/deep", f"{folder}/drafts")
    return rows.select("kind", "file", F.col("body").cast("string").alias("body"), F.split_part("error", F.lit(":"), F.lit(1)).alias("error"), "sha256")


# --- contract documents -------------------------------------------------------------


def edge_files(spark, sf):
    """One document per part with an edge per order line; every seventh entry is no mapping."""
    line = F.when(
        F.col("l_linenumber") == 7, F.concat(F.lit("- see order "), "l_orderkey")
    ).otherwise(
        F.concat(
            F.lit("- {src_id: 'part::"), "l_partkey", F.lit("', dst_id: 'supplier::"), "l_suppkey", F.lit("', relation: '"),
            F.lower("l_returnflag"), F.lit("'"),
            F.when(F.col("l_linenumber") == 6, F.concat(F.lit(", provenance: {source_edge_index: "), F.col("l_orderkey") % 1000 + 5000, F.lit(", shard: other}"))).otherwise(""),
            F.lit("}"),
        )
    )
    # The order lines of one part are few at any scale.
    lists = b.table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", line.alias("line")))).alias("ls"))
    text = F.concat(F.lit("edges:\n"), F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), F.lit("\n"))
    return lists.select(F.concat(F.lit("edges/e"), "l_partkey", F.lit(".yaml")).alias("path"), F.encode(text, "UTF-8").alias("content"))


MAPPING = "enums_note: fixed\nrelation_enums: [returns, accepts, open]\nkind_enums: [part, supplier]\nmappings:\n" + "".join(
    f"- {{shard: {s}, observed_label: {o}, canonical_relation: {c}}}\n" for s in ("parts", "other") for o, c in (("r", "returns"), ("a", "accepts"))
)


@query(
    "edge_scan",
    """
WITH l AS (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_returnflag) - 1 AS idx FROM lineitem)
SELECT 'e' || l_partkey || '.yaml' AS file, CASE WHEN l_linenumber = 6 THEN l_orderkey % 1000 + 5000 ELSE idx END AS source_edge_index,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 'other' ELSE 'parts' END AS shard,
  CASE WHEN l_linenumber < 7 THEN 'part::' || l_partkey END AS src_id, CASE WHEN l_linenumber < 7 THEN 'supplier::' || l_suppkey END AS dst_id,
  CASE WHEN l_linenumber = 7 THEN NULL WHEN l_returnflag = 'R' THEN 'returns' WHEN l_returnflag = 'A' THEN 'accepts' END AS relation,
  CASE WHEN l_linenumber = 7 THEN 'entry_no_mapping' END AS finding
FROM l""",
)
def edge_scan(spark, sf):
    """Edges of document lists with their place and mapped relation, and entries that are none."""
    folder = written(spark, edge_files(spark, sf))
    rules = spark.createDataFrame([("contract/map.yaml", bytearray(MAPPING.encode()))], "path string, content binary")
    filescan.write_files(rules, folder)
    # Edges and both kinds of findings read the parsed documents; files are opened and parsed once.
    docs = staged(documents.yaml_documents(spark, f"{folder}/edges").select("path", "body"))
    mapping = documents.relation_mapping(documents.yaml_documents(spark, f"{folder}/contract"))
    edges = documents.edge_entries(docs, F.lit("parts"))
    file = F.element_at(F.split("path", "/"), -1)
    # The mapping is one contract document.
    named = edges.join(F.broadcast(mapping), (edges["shard"] == mapping["shard"]) & (edges["relation"] == mapping["observed_label"]), "left")
    rows = named.select(file.alias("file"), "source_edge_index", edges["shard"], "src_id", "dst_id", F.col("canonical_relation").alias("relation"), F.lit(None).cast("string").alias("finding"))
    odd = documents.entry_findings(docs, "edges")
    none = [F.lit(None).cast("string").alias(c) for c in ("shard", "src_id", "dst_id", "relation")]
    return rows.unionByName(odd.select(file.alias("file"), F.col("idx").alias("source_edge_index"), *none, F.col("reason").alias("finding")))


# --- keys of documents ----------------------------------------------------------------


def keyed_documents(spark, sf):
    """One document per part: older names at the top and below, sections by the part's size."""
    text = F.concat(
        F.lit('{"name": "'), "p_name", F.lit('", "size": '), F.col("p_size").cast("string"),
        F.when(F.col("p_size") % 4 == 0, F.concat(F.lit(', "repo_id": "'), "p_brand", F.lit('"'))).otherwise(""),
        F.when(F.col("p_size") % 5 == 0, F.lit(', "troubleshooting": [{"repo": {"full_name": null}}, "x"]')).otherwise(""),
        F.when(F.col("p_size") % 7 == 0, F.lit(', "nested": {"failure_modes": {"a": [[{"b": true}]]}}')).otherwise(""),
        F.lit("}"),
    )
    return spread(b.table(spark, sf, "part")).select(F.concat(F.lit("p"), "p_partkey").alias("path"), F.parse_json(text).alias("body"))


_KEYED_SQL = """
k AS (
  SELECT 'p' || p_partkey AS path, p_size, 'name' AS key_path, 'name' AS key, 1 AS depth, 'STRING' AS kind FROM part
  UNION ALL SELECT 'p' || p_partkey, p_size, 'size', 'size', 1, 'BIGINT' FROM part
  UNION ALL SELECT 'p' || p_partkey, p_size, 'repo_id', 'repo_id', 1, 'STRING' FROM part WHERE p_size % 4 = 0
  UNION ALL SELECT 'p' || p_partkey, p_size, x[1], x[2], x[3]::INT, x[4] FROM part,
    (SELECT unnest([['troubleshooting', 'troubleshooting', '1', 'ARRAY'], ['troubleshooting[].repo', 'repo', '2', 'OBJECT'],
      ['troubleshooting[].repo.full_name', 'full_name', '3', 'VOID']]) AS x) WHERE p_size % 5 = 0
  UNION ALL SELECT 'p' || p_partkey, p_size, x[1], x[2], x[3]::INT, x[4] FROM part,
    (SELECT unnest([['nested', 'nested', '1', 'OBJECT'], ['nested.failure_modes', 'failure_modes', '2', 'OBJECT'],
      ['nested.failure_modes.a', 'a', '3', 'ARRAY'], ['nested.failure_modes.a[][].b', 'b', '4', 'BOOLEAN']]) AS x) WHERE p_size % 7 = 0)"""


@query("document_keys", "WITH " + _KEYED_SQL + " SELECT path, key_path, key, depth, kind FROM k")
def document_keys(spark, sf):
    """Every key of every document with its path and type."""
    return keypaths.key_paths(keyed_documents(spark, sf))


@query(
    "key_rule_findings",
    "WITH "
    + _KEYED_SQL
    + """
SELECT path, 'legacy_key' AS rule, key_path, 'blocking' AS severity FROM k WHERE key IN ('full_name', 'repo', 'repo_id') AND depth = 1
UNION ALL SELECT path, 'forbidden_section', key_path, 'blocking' FROM k
  WHERE key IN ('common_tasks', 'failure_modes', 'implementation_patterns', 'risk_assessment', 'troubleshooting') AND depth = 1
UNION ALL SELECT path, 'anywhere', key_path, 'warning' FROM k WHERE key IN ('full_name', 'failure_modes')""",
)
def key_rule_findings(spark, sf):
    """Older names and forbidden sections at the top, and two keys forbidden at any depth."""
    own = spark.createDataFrame([("anywhere", "full_name", None, "warning"), ("anywhere", "failure_modes", None, "warning")], "rule string, key string, deepest int, severity string")
    keys = keypaths.key_paths(keyed_documents(spark, sf))
    return keypaths.key_findings(keys, keypaths.key_rules(spark).unionByName(own))


# --- manifests and vocabularies -----------------------------------------------------


def manifest_files(spark, sf):
    """A manifest and a contract per part."""
    part = spread(b.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    entry = lambda name: F.to_json(F.struct(F.col(name).alias("name")))
    head = F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit('"defaults": {"target_shard": "'), F.lower("p_type"), F.lit('", "as_of": "2025-01-01"}, '))).otherwise("")
    body = F.concat(F.lit("{"), head, F.lit('"repos": ['), entry("p_name"), F.lit(", "), entry("p_brand"), F.lit(', "text"]}'))
    enums = F.concat(F.lit('{"tone_enums": ["'), F.lower("p_type"), F.lit('"], "size_enums": ["s'), F.col("p_size"), F.lit('"], "enums_of": ["x"], "tone": "y"}'))
    key = F.col("p_partkey").cast("string")
    return part.select(F.concat(F.lit("manifests/m"), key, F.lit(".yaml")).alias("path"), F.encode(body, "UTF-8").alias("content")).unionByName(
        part.select(F.concat(F.lit("contracts/c"), key, F.lit(".yaml")).alias("path"), F.encode(enums, "UTF-8").alias("content"))
    )


@query(
    "manifest_scan",
    """
SELECT 'm' || p_partkey || '.yaml' AS file, 'manifest' AS what, i AS idx, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE lower(p_type) END AS default_shard,
  CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE '2025-01-01' END AS default_as_of, i < 2 AS is_mapping, CASE i WHEN 0 THEN p_name WHEN 1 THEN p_brand END AS name
FROM part, (SELECT unnest([0, 1, 2]) AS i)
UNION ALL SELECT NULL, 'enum ' || e, NULL, NULL, NULL, NULL, v FROM (SELECT 'tone' AS e, lower(p_type) AS v FROM part UNION SELECT 'size', 's' || p_size FROM part)""",
)
def manifest_scan(spark, sf):
    """Manifest entries with the defaults of their document, and the values of contract enums."""
    folder = written(spark, manifest_files(spark, sf))
    rows = documents.manifest(documents.yaml_documents(spark, f"{folder}/manifests"))
    listed = rows.select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.lit("manifest").alias("what"), "idx", "default_shard", "default_as_of", "is_mapping",
        documents.field("entry", "$.name").alias("name"),
    )
    none = [F.lit(None).cast(t).alias(c) for c, t in (("idx", "int"), ("default_shard", "string"), ("default_as_of", "string"), ("is_mapping", "boolean"))]
    values = documents.contract_enums(documents.yaml_documents(spark, f"{folder}/contracts"))
    return listed.unionByName(values.select(F.lit(None).cast("string").alias("file"), F.concat(F.lit("enum "), "enum").alias("what"), *none, F.col("value").alias("name")))
