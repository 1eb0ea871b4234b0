"""Intake, ingestion, identity and the admission stream over the bindings."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factgraph.operators import identity, intake, setdiff
from factgraph.plans import bindings as b
from factgraph.plans.document_queries import fill
from factgraph.plans.read_queries import joined
from factgraph.plans.registry import query
from factgraph.session import shared_dir, spread
from factgraph.streaming.admission import admit_stream, candidate_files

# --- catalog and queue ------------------------------------------------------------


def catalog(spark, sf):
    """One catalog row per order: named, by address, without an address, or unusable."""
    way, key = F.col("o_orderkey") % 4, F.col("o_custkey")
    owner = F.concat(F.lit("Owner"), "c_nationkey")
    people = b.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    url = (
        F.when(way == 1, F.concat(F.lit(" https://github.com/"), owner, F.lit("/c"), key, F.lit(".git")))
        .when(way == 2, F.lit("https://example.org/x")).when(way == 3, F.lit("https://github.com/alone"))
    )
    return (
        b.table(spark, sf, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("row_index"), url.alias("url"),
            F.when(way == 2, owner).alias("author"),
            F.when(way == 2, F.concat(F.lit("c"), key)).alias("repo_name"),
            F.col("o_orderpriority").alias("category"),
            F.concat(F.lit("path"), key % 7).alias("local_path"),
            (F.col("o_orderstatus") == "P").alias("needs_review"),
        )
    )


CATALOG_SQL = b.with_views(b.REPOS_SQL) + """,
rows AS (
  SELECT o_orderkey AS row_index, o_orderkey % 4 AS way, 'Owner' || c_nationkey || '/c' || o_custkey AS full_name,
         o_orderpriority AS category, 'path' || (o_custkey % 7) AS local_path, o_orderstatus = 'P' AS needs_review,
         CASE o_orderkey % 4 WHEN 1 THEN 'https://github.com/Owner' || c_nationkey || '/c' || o_custkey || '.git'
              WHEN 2 THEN 'https://example.org/x' END AS url
  FROM orders JOIN customer ON o_custkey = c_custkey),
good AS (SELECT *, lower(full_name) AS norm FROM rows WHERE way IN (1, 2)),
known AS (SELECT lower(full_name) AS norm, full_name AS canonical FROM repos WHERE full_name IS NOT NULL),
queue AS (
  SELECT norm, arg_min(full_name, row_index) AS shown, arg_min(url, row_index) AS html_url,
         count(*) FILTER (WHERE needs_review) AS needs_review_count, count(*) AS source_rows
  FROM good GROUP BY 1)"""


@query(
    "queue_build",
    CATALOG_SQL
    + """
SELECT 'intake::' || coalesce(canonical, shown) AS queue_id, coalesce(canonical, shown) AS full_name, html_url,
       CASE WHEN canonical IS NULL THEN 'queued' ELSE 'already_canonical' END AS canonical_status,
       CASE WHEN canonical IS NULL THEN 'pending' ELSE 'hold' END AS intake_status,
       CASE WHEN canonical IS NULL THEN 'candidate_shallow_scan' ELSE 'skip_existing_canonical' END AS recommended_action,
       needs_review_count, source_rows, norm
FROM queue LEFT JOIN known USING (norm)""",
)
def queue_build(spark, sf):
    return intake.build_queue(catalog(spark, sf), b.repos(spark, sf))


@query(
    "queue_sources",
    CATALOG_SQL
    + """
SELECT DISTINCT norm, 'category' AS kind, category AS value FROM good
UNION SELECT norm, 'local_path', local_path FROM good UNION SELECT norm, 'row_index', row_index::VARCHAR FROM good""",
)
def queue_sources(spark, sf):
    return intake.queue_sources(catalog(spark, sf))


@query(
    "queue_summary",
    CATALOG_SQL
    + """
SELECT count(*) AS source_rows_total, count(*) FILTER (WHERE way = 0) AS source_rows_missing_url,
       count(*) FILTER (WHERE way = 3) AS source_rows_invalid_full_name,
       (SELECT count(*) FROM queue) AS deduped_entries_total,
       (SELECT count(*) FROM queue JOIN known USING (norm)) AS already_canonical_count,
       (SELECT count(*) FROM queue WHERE norm NOT IN (SELECT norm FROM known)) AS queued_count FROM rows""",
)
def queue_summary(spark, sf):
    rows = catalog(spark, sf)
    return intake.queue_summary(rows, intake.build_queue(rows, b.repos(spark, sf)))


@query(
    "queue_difference",
    CATALOG_SQL
    + """,
stored AS (SELECT norm, CASE WHEN needs_review_count > 2 THEN 0 ELSE needs_review_count END AS needs_review_count FROM queue)
SELECT norm, q.needs_review_count, 1 AS surplus, 'left' AS side FROM queue q
WHERE needs_review_count > 2
UNION ALL SELECT norm, 0, -1, 'right' FROM queue WHERE needs_review_count > 2""",
)
def queue_difference(spark, sf):
    queue = intake.build_queue(catalog(spark, sf), b.repos(spark, sf)).select("norm", "needs_review_count", "source_rows")
    count = F.col("needs_review_count")
    stored = queue.withColumn("needs_review_count", F.when(count > 2, F.lit(0).cast("bigint")).otherwise(count))
    return setdiff.multiset_diff(queue, stored, ignore=["source_rows"])


@query(
    "catalog_metadata",
    CATALOG_SQL
    + """
SELECT count(*) AS total_repos, count(*) FILTER (WHERE way = 2) AS identified,
       count(*) FILTER (WHERE way <> 2) AS unidentified FROM rows""",
)
def catalog_metadata(spark, sf):
    return intake.catalog_metadata(catalog(spark, sf))


CANDIDATES_SQL = CATALOG_SQL + """,
cand AS (
  SELECT l_orderkey AS pos, l_suppkey, CASE WHEN l_linenumber = 7 THEN 'https://github.com/nobody' ELSE
         'https://github.com/owner' || c_nationkey || '/C' || c_custkey END AS url, c_custkey, c_nationkey, l_linenumber
  FROM lineitem JOIN customer ON l_partkey = c_custkey),
fresh AS (
  SELECT min(pos) AS pos, lower('owner' || c_nationkey || '/C' || c_custkey) AS norm FROM cand WHERE l_linenumber <> 7 GROUP BY 2)
SELECT pos, norm FROM fresh WHERE norm NOT IN (SELECT norm FROM good)"""


def _candidates(spark, sf):
    lines = b.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    people = b.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    rows = lines.join(people, F.col("l_partkey") == F.col("c_custkey"))
    name = F.concat(F.lit("https://github.com/owner"), "c_nationkey", F.lit("/C"), "c_custkey")
    return rows.select(
        F.col("l_orderkey").alias("pos"),
        F.when(F.col("l_linenumber") == 7, F.lit("https://github.com/nobody")).otherwise(name).alias("url"),
    )


@query("candidate_admission", CANDIDATES_SQL)
def candidate_admission(spark, sf):
    return intake.admit_candidates(_candidates(spark, sf), catalog(spark, sf)).select("pos", "norm")


@query(
    "candidate_stream",
    """
WITH named AS (SELECT min(event_id) AS pos, 'user' || user_id || '/' || event_type AS norm FROM events GROUP BY 2)
SELECT pos, norm FROM named WHERE norm NOT IN (SELECT 'user' || c_custkey || '/click' FROM customer)""",
)
def candidate_stream(spark, sf):
    """Events as a stream of candidates, admitted against a catalog made of the customers."""
    schema = b.table(spark, sf, "events").schema
    # A pattern, because the table may be one file or a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    candidates = events.select(
        F.col("event_id").alias("pos"),
        F.concat(F.lit("https://github.com/user"), "user_id", F.lit("/"), "event_type").alias("url"),
    )
    known = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_index"),
        F.concat(F.lit("https://github.com/USER"), "c_custkey", F.lit("/click")).alias("url"),
        *[F.lit(None).cast("string").alias(c) for c in ("author", "repo_name", "category", "local_path")],
        F.lit(False).alias("needs_review"),
    )
    return admit_stream(candidates, known).select("pos", "norm")


@query(
    "candidate_batches",
    """
WITH named AS (
  SELECT min(event_id) AS pos, CASE WHEN event_id % 3 = 0 THEN 'team/hot' ELSE 'user' || user_id % 1000 || '/' || event_type END AS norm
  FROM events GROUP BY 2)
SELECT pos, norm FROM named WHERE norm NOT IN (SELECT 'user' || c_custkey || '/view' FROM customer)""",
)
def candidate_batches(spark, sf):
    """The same admission over six batches and a repeated one; a third of all rows name one repository."""
    events = b.table(spark, sf, "events")
    name = F.when(F.col("event_id") % 3 == 0, "Team/hot").otherwise(F.concat(F.lit("user"), F.col("user_id") % 1000, F.lit("/"), "event_type"))
    rows = events.select(F.col("event_id").alias("pos"), F.concat(F.lit("https://github.com/"), name).alias("url"))
    most = rows.agg(F.coalesce(F.max("pos"), F.lit(0)).alias("m")).head()["m"]
    folder = f"{shared_dir(spark).rstrip('/')}/factgraph-inbox/{uuid.uuid4().hex}"
    for k in [0, 1, 2, 3, 4, 5, 2]:
        place = F.floor(F.col("pos") * 6 / (most + 1))
        rows.filter(place == k).repartition(4).write.mode("append").json(folder)
    stream = candidate_files(spark, folder, "pos long, url string", files_per_batch=4)
    known = b.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("row_index"),
        F.concat(F.lit("https://github.com/USER"), "c_custkey", F.lit("/view")).alias("url"),
        *[F.lit(None).cast("string").alias(c) for c in ("author", "repo_name", "category", "local_path")],
        F.lit(False).alias("needs_review"),
    )
    return admit_stream(stream, known).select("pos", "norm")


# --- manifest ---------------------------------------------------------------------

_ENTRY = """{"repo": "Owner@size/P@key", "name": "", "summary": "@odd", "core_concepts": ["@name", " "], "key_entry_points": [],
 "build_run": {}, "color": "@brand", "source": "remote_api",
 "readme_fallback": {"summary": "from readme", "key_entry_points": ["@type"], "build_run": {"language": "@lowtype"},
                     "category": "@brand"}}"""


def manifest_rows(spark, sf):
    late = F.col("p_partkey") % 10 == 0
    parts = spread(b.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    return intake.prepared_manifest(
        parts.select(
            F.col("p_partkey").alias("idx"),
            F.parse_json(fill(_ENTRY)).alias("entry"),
            (F.col("p_partkey") % 11 != 0).alias("is_mapping"),
            F.lit("repos").alias("default_shard"),
            F.when(late, "soon").otherwise("2024-01-01").alias("default_as_of"),
        )
    )


MANIFEST_SQL = """
WITH rows AS (
  SELECT p_partkey AS idx, 'owner' || p_size || '/p' || p_partkey AS full_name, 'p' || p_partkey AS name,
         'remote_api' AS source, p_brand AS category,
         CASE WHEN p_size % 5 = 0 THEN 'from readme' ELSE p_name END AS summary, p_name AS core_concepts,
         p_type AS key_entry_points, 'language="' || lower(p_type) || '"' AS build_run, 'color="' || p_brand || '"' AS extras,
         CASE WHEN p_partkey % 10 = 0 THEN 'soon' ELSE '2024-01-01' END AS as_of,
         'build_run; category; key_entry_points' || CASE WHEN p_size % 5 = 0 THEN '; summary' ELSE '' END AS fallback_fields,
         concat_ws('; ', CASE WHEN p_partkey % 11 = 0 THEN 'entry must be a mapping' END,
                   CASE WHEN p_partkey % 10 = 0 THEN 'as_of must be a date or datetime' END) AS errors,
         3 + (p_size % 5 = 0)::INT AS used FROM part)"""


@query(
    "manifest_normalized",
    MANIFEST_SQL
    + """SELECT idx, full_name, name, source, category, summary, core_concepts, key_entry_points, build_run, extras, as_of,
fallback_fields, errors, 'repos/knowledge/repos/' || name || '.yaml' AS source_file FROM rows""",
)
def manifest_normalized(spark, sf):
    def shown(name):
        return F.array_join(F.transform(F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")

    rows = joined(manifest_rows(spark, sf), "core_concepts", "key_entry_points", "fallback_fields", "errors")
    return rows.select(
        "idx", "full_name", "name", "source", "category", "summary", "core_concepts", "key_entry_points",
        shown("build_run").alias("build_run"), shown("extras").alias("extras"), "as_of", "fallback_fields", "errors", "source_file",
    )


@query(
    "ingestion_blockers",
    MANIFEST_SQL + "SELECT 'invalid_row' AS reason, idx::VARCHAR AS key, errors AS detail FROM rows WHERE errors <> ''",
)
def ingestion_blockers(spark, sf):
    return intake.ingestion_blockers(manifest_rows(spark, sf))


@query(
    "ingestion_metrics",
    MANIFEST_SQL
    + """SELECT count(*) AS entries, count(*) FILTER (WHERE errors = '') AS valid_entries,
count(*) FILTER (WHERE errors = '') AS fallback_entries, sum(used) FILTER (WHERE errors = '') AS fallback_fields,
100.0 AS fallback_usage_pct FROM rows""",
)
def ingestion_metrics(spark, sf):
    return intake.ingestion_metrics(manifest_rows(spark, sf))


@query(
    "ingestion_gates",
    """SELECT unnest(['manifest_entries_present', 'manifest_entries_all_valid', 'source_values_allowed', 'shard_values_valid',
'required_field_coverage_100pct', 'duplicate_node_ids_zero', 'duplicate_files_zero', 'blocking_mismatches_zero']) AS gate,
unnest([count(*) > 0, count(*) FILTER (WHERE p_partkey % 10 = 0 OR p_partkey % 11 = 0) = 0, true, true, true, true, true,
count(*) FILTER (WHERE p_partkey % 10 = 0 OR p_partkey % 11 = 0) = 0]) AS passed FROM part""",
)
def ingestion_gates(spark, sf):
    return intake.ingestion_gates(manifest_rows(spark, sf))


@query(
    "ingestion_run",
    """
WITH bad AS (SELECT count(*) FILTER (WHERE p_partkey % 10 = 0 OR p_partkey % 11 = 0) AS n, count(*) AS whole FROM part)
SELECT run, gate, run = 'clean' OR n = 0 OR gate NOT IN ('manifest_entries_all_valid', 'blocking_mismatches_zero') AS passed,
  CASE WHEN run = 'clean' OR n = 0 THEN whole - n ELSE 0 END AS loaded
FROM bad, (SELECT unnest(['all', 'clean']) AS run), (SELECT unnest(['manifest_parseable', 'manifest_entries_present', 'manifest_entries_all_valid',
  'source_values_remote_only', 'source_values_within_enum', 'provenance_shard_values_valid', 'duplicate_node_ids_zero', 'duplicate_repo_file_paths_zero',
  'local_cache_dir_null_when_absent', 'repo_writes_succeeded', 'required_field_coverage_100pct', 'blocking_mismatches_zero']) AS gate)""",
)
def ingestion_run(spark, sf):
    """The twelve gates of a run over all rows, which is blocked, and over the sound ones."""
    rows = manifest_rows(spark, sf)
    out = None
    for run, some in (("all", rows), ("clean", rows.filter(F.size("errors") == 0))):
        loaded, gates = intake.ingest(some)
        one = gates.select(F.lit(run).alias("run"), "gate", "passed", F.lit(loaded.count()).cast("bigint").alias("loaded"))
        out = one if out is None else out.unionByName(one)
    return out


RECORDS_SQL = """
SELECT 'repo::' || full_name AS node_id, name, full_name, source, 'repos/knowledge/repos/' || name || '.yaml' AS source_file, as_of,
category, summary, core_concepts, key_entry_points, build_run, extras, fallback_fields FROM rows WHERE errors = ''"""


def record_columns(records):
    def shown(name):
        return F.array_join(F.transform(F.map_entries(name), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ").alias(name)

    return joined(records.withColumn("fallback_fields", F.col("refresh.fallback_fields")), "core_concepts", "key_entry_points", "fallback_fields").select(
        "node_id", "name", "full_name", "source", "source_file", "as_of", "category", "summary", "core_concepts", "key_entry_points",
        shown("build_run"), shown("extras"), "fallback_fields",
    )


@query("ingested_records", MANIFEST_SQL + RECORDS_SQL)
def ingested_records(spark, sf):
    """A load of the rows without a fault: nothing blocks, and all of them come in."""
    rows = manifest_rows(spark, sf).filter(F.size("errors") == 0)
    return record_columns(intake.load_all_or_nothing(rows))


@query("blocked_ingest", MANIFEST_SQL + RECORDS_SQL + " AND NOT EXISTS (SELECT * FROM rows WHERE errors <> '')")
def blocked_ingest(spark, sf):
    """A load of all rows: a single faulty one holds everything back."""
    return record_columns(intake.load_all_or_nothing(manifest_rows(spark, sf)))


@query(
    "record_changes",
    """
WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment, c_acctbal FROM customer)
SELECT k AS c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN 'added' WHEN c_mktsegment = 'BUILDING' THEN 'absent'
       WHEN c_acctbal < 0 THEN 'updated' ELSE 'unchanged' END AS change FROM c""",
)
def record_changes(spark, sf):
    people = b.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    before = people.filter("c_mktsegment <> 'FURNITURE'")
    name = F.when(F.col("c_acctbal") < 0, F.upper("c_name")).otherwise(F.col("c_name"))
    after = people.filter("c_mktsegment <> 'BUILDING'").withColumn("c_name", name)
    return intake.classify_changes(before, after, "c_custkey", ["c_name", "c_mktsegment"])


@query(
    "prior_run_merge",
    """
SELECT o_orderkey AS step, CASE WHEN o_orderkey % 5 = 0 THEN 'PASS' WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0
         THEN o_orderstatus ELSE 'PENDING' END AS status,
       CASE WHEN o_orderkey % 5 = 0 THEN 'now' ELSE o_orderpriority END AS command FROM orders""",
)
def prior_run_merge(spark, sf):
    key = F.col("o_orderkey")
    steps = b.table(spark, sf, "orders").select(key.alias("step"), "o_orderstatus", "o_orderpriority")
    step = F.col("step")
    template = steps.select("step", F.lit("PENDING").alias("status"), F.col("o_orderpriority").alias("command"))
    prior = steps.filter(step % 2 == 0).select(
        "step", F.when(step % 3 != 0, F.col("o_orderstatus")).alias("status"), F.lit("").alias("command")
    )
    managed = steps.filter(step % 5 == 0).select("step", F.lit("PASS").alias("status"), F.lit("now").alias("command"))
    return intake.merge_prior_run(prior, template, managed)


# --- identity ---------------------------------------------------------------------

_FILES = [
    (".git/config", '[core]\n\tbare = false\n[remote "origin"]\n\turl = git@github.com:Owner@size/@lowtype.git\n[branch "x"]\n\turl = no\n'),
    ("go.mod", "// a module\nmodule github.com/Owner@size/@lowtype\n\ngo 1.22\n"),
    ("pyproject.toml", '[project]\nname = "x"\n[project.urls]\nDocs = "https://github.com/owner@size/@lowtype"\n'),
    ("package.json", '{"repository": {"url": "git+https://github.com/owner@size/@lowtype.git"}, "bugs": "none"}'),
    ("setup.py", 'setup(\n    name="x",\n    url="https://github.com/owner@size/other",\n)\n# https://github.com/not/read\n'),
    ("docs/go.mod", "module github.com/not/root\n"),
]


def identity_files(spark, sf):
    """Two files per part's repository: one of six kinds, and a README that names it."""
    way = (F.col("p_partkey") % len(_FILES)).cast("int") + 1
    path = F.element_at(F.array(*[F.lit(p) for p, _ in _FILES]), way)
    content = F.element_at(F.array(*[F.lit(c) for _, c in _FILES]), way)
    readme = "# About\nSee https://github.com/Owner@size/@lowtype. Like https://github.com/else/where, too.\n"
    both = F.array(
        F.struct(path.alias("path"), fill(content).alias("content")),
        F.struct(F.lit("README.md").alias("path"), fill(readme).alias("content")),
    )
    return b.table(spark, sf, "part").select(F.concat(F.lit("r"), "p_partkey").alias("repo"), F.explode(both).alias("f")).select("repo", "f.*")


def identity_records(spark, sf):
    key = F.col("p_partkey")
    own = F.when(key % 7 == 0, F.lit("nothing like it")).otherwise(F.col("p_type"))
    return b.table(spark, sf, "part").select(
        F.concat(F.lit("r"), "p_partkey").alias("repo"),
        identity.expected_tokens(own, F.lit("?"), F.concat("p_brand", F.lit("-main"))).alias("tokens"),
        F.concat(F.lit("d"), "p_size").alias("directory"),
        F.when(key % 4 == 0, "remote_api").alias("declared_source"),
        F.concat(F.lit("Decl/P"), key).alias("declared_full_name"),
        F.concat(F.lit("repo::Decl/P"), key).alias("declared_node_id"),
        F.concat(F.lit("https://github.com/decl/p"), key).alias("declared_url"),
    )


IDENTITY_SQL = """
WITH f AS (
  SELECT 'r' || p_partkey AS repo, p_partkey AS k, p_size, 'owner' || p_size || '/' || lower(p_type) AS own,
         'owner' || p_size || '/other' AS other, p_partkey % 6 AS way, p_partkey % 7 <> 0 AS self,
         CASE p_partkey % 6 WHEN 0 THEN 'git_origin' WHEN 1 THEN 'go_mod_module' WHEN 2 THEN 'pyproject_meta'
           WHEN 3 THEN 'package_json_meta' WHEN 4 THEN 'setup_py_meta' END AS kind FROM part),
chosen AS (
  SELECT repo, k, p_size,
    CASE WHEN self THEN own WHEN way < 4 THEN own WHEN way = 4 THEN other END AS full_name,
    CASE WHEN self AND way < 4 THEN kind WHEN self THEN 'readme_self_match' WHEN way <= 4 THEN kind END AS source,
    CASE WHEN self OR way <= 4 THEN 'resolved' ELSE 'none' END AS status FROM f),
filled AS (
  SELECT repo, k, 'd' || p_size AS directory, status, full_name, source, p_size, 'd' || s_suppkey AS m,
         CASE WHEN p_size BETWEEN 20 AND 44 THEN 'cat/' || (p_size - 20) END AS cat,
         CASE WHEN s_suppkey IS NOT NULL THEN 'm/' || s_suppkey END AS mname
  FROM chosen LEFT JOIN supplier ON s_suppkey = p_size AND s_suppkey % 3 = 0),
resolved AS (
  SELECT repo, directory,
    CASE WHEN status = 'resolved' THEN full_name WHEN mname IS NOT NULL THEN mname
         WHEN k % 4 = 0 THEN 'decl/p' || k WHEN p_size % 2 = 1 THEN cat END AS full_name,
    CASE WHEN status = 'resolved' THEN source WHEN mname IS NOT NULL THEN 'llm_manifest'
         WHEN k % 4 = 0 THEN 'existing_remote_identity'
         WHEN p_size % 2 = 1 AND cat IS NOT NULL THEN 'assistive_master_repo_list' END AS source, cat, k FROM filled)"""


@query(
    "identity_candidates",
    IDENTITY_SQL
    + """
SELECT repo, full_name, min(source) AS source FROM (
  SELECT repo, own AS full_name, CASE WHEN way < 4 THEN kind ELSE 'readme_self_match' END AS source FROM f
  UNION ALL SELECT repo, other, kind FROM f WHERE way = 4
  UNION ALL SELECT repo, 'else/where', 'readme_self_match' FROM f) GROUP BY 1, 2""",
)
def identity_candidates(spark, sf):
    return identity.mine_candidates(identity_files(spark, sf)).select("repo", "full_name", "source")


@query("identity_choice", IDENTITY_SQL + "SELECT repo, full_name, source, status FROM chosen")
def identity_choice(spark, sf):
    return identity.choose_identity(identity_records(spark, sf), identity.mine_candidates(identity_files(spark, sf)))


def resolved_identity(spark, sf):
    records = identity_records(spark, sf)
    chosen = identity.choose_identity(records, identity.mine_candidates(identity_files(spark, sf)))
    manifest = b.table(spark, sf, "supplier").filter("s_suppkey % 3 = 0").select(
        F.concat(F.lit("d"), "s_suppkey").alias("directory"), F.concat(F.lit("m/"), "s_suppkey").alias("full_name")
    )
    listed = b.table(spark, sf, "nation").select(
        F.concat(F.lit("d"), F.col("n_nationkey") + 20).alias("directory"),
        F.concat(F.lit("cat/"), "n_nationkey").alias("full_name"),
    )
    allowed = b.table(spark, sf, "part").filter("p_size % 2 = 1").select(F.concat(F.lit("r"), "p_partkey").alias("repo"))
    return identity.resolve_with_fallbacks(records, chosen, manifest, listed, allowed)


@query(
    "identity_resolved",
    IDENTITY_SQL
    + """SELECT repo, directory, full_name, source, CASE WHEN full_name IS NULL THEN
CASE WHEN cat IS NOT NULL THEN 'fallback_not_allowed' ELSE 'unresolved' END END AS problem FROM resolved""",
)
def identity_resolved(spark, sf):
    return resolved_identity(spark, sf)


@query(
    "identity_conflicts",
    IDENTITY_SQL
    + """
SELECT repo, source AS source_used, 'node_id' AS field, 'repo::Decl/P' || k AS old_value, 'repo::' || full_name AS new_value
FROM resolved WHERE full_name IS NOT NULL
UNION ALL SELECT repo, source, 'full_name', 'Decl/P' || k, full_name FROM resolved WHERE full_name IS NOT NULL
UNION ALL SELECT repo, source, 'html_url', 'https://github.com/decl/p' || k, 'https://github.com/' || full_name FROM resolved
WHERE full_name IS NOT NULL AND full_name <> 'decl/p' || k""",
)
def identity_conflicts(spark, sf):
    records = identity_records(spark, sf).select(
        "repo", F.col("declared_node_id").alias("node_id"), F.col("declared_full_name").alias("full_name"),
        F.col("declared_url").alias("html_url"),
    )
    return identity.identity_conflicts(identity.stamp_identity(records, resolved_identity(spark, sf)))


@query(
    "malformed_identity",
    """
SELECT 'r' || p_partkey AS repo, concat_ws('; ', CASE WHEN p_size % 2 = 0 THEN 'full_name' END,
  CASE WHEN p_size % 2 = 0 THEN 'html_url' END, CASE WHEN p_size % 3 = 0 THEN 'source' END,
  CASE WHEN p_size % 5 = 0 THEN 'provenance.shard' END,
  CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN 'provenance.shard_mismatch' END) AS malformed FROM part
WHERE p_size % 2 = 0 OR p_size % 3 = 0 OR p_size % 5 = 0 OR p_size % 7 = 0""",
)
def malformed_identity(spark, sf):
    size = F.col("p_size")
    name = F.when(size % 2 == 0, F.col("p_brand")).otherwise(F.concat("p_brand", F.lit("/x")))
    path = F.concat(F.lit("repos/"), "p_partkey")
    records = b.table(spark, sf, "part").select(
        F.concat(F.lit("r"), "p_partkey").alias("repo"), path.alias("path"), name.alias("full_name"),
        F.concat(F.lit("https://github.com/"), name).alias("html_url"),
        F.when(size % 3 == 0, "elsewhere").otherwise("repos").alias("source"),
        F.concat(F.lit("repo::"), name).alias("node_id"),
        F.when(size % 5 == 0, "odd").when(size % 7 == 0, "merged").otherwise("repos").alias("shard"),
        path.alias("source_file"), F.lit("2024-01-01").alias("as_of"),
    )
    return joined(identity.malformed_identity(records), "malformed")


# --- links and contracts ----------------------------------------------------------


@query(
    "stem_links",
    """
WITH shallow AS (
  SELECT 's' || c_nationkey AS shard, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS token, max('shallow/' || c_name) AS shallow_file
  FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1, 2)
SELECT 's' || c_nationkey AS shard, 'deep/' || c_custkey AS deep_file, shallow_file, CASE WHEN shallow_file IS NULL THEN 'unlinked' END AS problem
FROM customer LEFT JOIN shallow ON shard = 's' || c_nationkey AND token = regexp_replace(lower(replace(c_name, '#', '_')), '[^a-z0-9]', '', 'g')""",
)
def stem_links(spark, sf):
    """Customers as documents; those of one segment have no shallow one."""
    people = b.table(spark, sf, "customer").withColumn("shard", F.concat(F.lit("s"), "c_nationkey"))
    shallow = people.filter("c_mktsegment <> 'BUILDING'").select(
        "shard", F.col("c_name").alias("stem"), F.concat(F.lit("shallow/"), "c_name").alias("file")
    )
    deep = people.select("shard", F.replace("c_name", F.lit("#"), F.lit("_")).alias("stem"), F.concat(F.lit("deep/"), "c_custkey").alias("file"))
    return identity.link_stems(deep, shallow)


@query(
    "profile_names",
    """
SELECT 'Own' || p_size || '/P' || p_partkey AS full_name,
  CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_partkey % 2 = 0 THEN p_type ELSE 'own' || p_size || '__p' || p_partkey END AS file_stem,
  CASE WHEN p_partkey % 4 = 0 THEN 'node' || p_partkey ELSE 'repo::Own' || p_size || '/P' || p_partkey END AS node_id FROM part""",
)
def profile_names(spark, sf):
    key = F.col("p_partkey")
    parts = b.table(spark, sf, "part").withColumn("full_name", F.concat(F.lit("Own"), "p_size", F.lit("/P"), "p_partkey"))
    manifest = parts.select("full_name", F.when(key % 3 == 0, F.col("p_brand")).otherwise("").alias("file_stem"))
    canonical = parts.filter(key % 2 == 0).select(
        "full_name", F.col("p_type").alias("file_stem"), F.when(key % 4 == 0, F.concat(F.lit("node"), "p_partkey")).alias("node_id")
    )
    return identity.profile_names(parts, manifest, canonical)


@query(
    "contract_findings",
    """
WITH a AS (SELECT r_name AS artifact, r_regionkey FROM region),
w AS (SELECT unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST', 'NOWHERE']) AS artifact)
SELECT w.artifact, CASE WHEN a.artifact IS NULL THEN 'missing' WHEN r_regionkey = 1 THEN 'no_mapping' ELSE 'no_version' END AS finding
FROM w LEFT JOIN a ON a.artifact = w.artifact WHERE a.artifact IS NULL OR r_regionkey IN (1, 2)""",
)
def contract_findings(spark, sf):
    """Regions as contract artefacts, each with a fault of its own or none."""
    key = F.col("r_regionkey")
    artifacts = b.table(spark, sf, "region").select(
        F.col("r_name").alias("artifact"), (key != 1).alias("is_mapping"), F.when(key == 2, " ").otherwise("1.0").alias("version")
    )
    return setdiff.contract_findings(artifacts, ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "NOWHERE"])


@query(
    "contract_versions",
    """SELECT '*' AS artifact, 'version_mismatch' AS finding FROM (SELECT count(DISTINCT n_regionkey) AS n FROM nation) WHERE n > 1""",
)
def contract_versions(spark, sf):
    """Nations as sound artefacts whose versions differ."""
    nations = b.table(spark, sf, "nation")
    artifacts = nations.select(F.col("n_name").alias("artifact"), F.lit(True).alias("is_mapping"), F.col("n_regionkey").cast("string").alias("version"))
    return setdiff.contract_findings(artifacts, artifacts)


@query(
    "part_contract_findings",
    """
WITH a AS (SELECT 'part' || p_partkey AS artifact, p_size FROM part),
w AS (SELECT 'part' || (2 * p_partkey) AS artifact FROM part)
SELECT w.artifact, CASE WHEN a.artifact IS NULL THEN 'missing' WHEN p_size % 10 = 1 THEN 'no_mapping' ELSE 'no_version' END AS finding
FROM w LEFT JOIN a ON a.artifact = w.artifact WHERE a.artifact IS NULL OR p_size % 10 IN (1, 2)""",
)
def part_contract_findings(spark, sf):
    """Parts as contract artefacts; those of every even number up to twice the count are required."""
    parts, kind = b.table(spark, sf, "part"), F.col("p_size") % 10
    artifacts = parts.select(
        F.concat(F.lit("part"), "p_partkey").alias("artifact"), (kind != 1).alias("is_mapping"), F.when(kind == 2, " ").otherwise("1.0").alias("version")
    )
    return setdiff.contract_findings(artifacts, parts.select(F.concat(F.lit("part"), F.col("p_partkey") * 2).alias("artifact")))


@query(
    "order_contract_versions",
    """SELECT '*' AS artifact, 'version_mismatch' AS finding FROM (SELECT count(DISTINCT o_orderstatus) AS n FROM orders) WHERE n > 1""",
)
def order_contract_versions(spark, sf):
    """Orders as sound artefacts whose versions differ."""
    artifacts = b.table(spark, sf, "orders").select(
        F.concat(F.lit("order"), "o_orderkey").alias("artifact"), F.lit(True).alias("is_mapping"), F.col("o_orderstatus").alias("version")
    )
    return setdiff.contract_findings(artifacts, artifacts)
