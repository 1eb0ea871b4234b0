"""Intake queue, candidate admission and manifest ingestion."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions import sqlexpr as S
from factgraph.functions.text import FULL_NAME, full_name_of_url, is_blank, parse_as_of, percentage, slug, trim_ws
from factgraph.functions.variants import objects, sorted_entries, sub, text, texts, unknown_fields
from factgraph.operators.aggregates import duplicate_keys
from factgraph.operators.gates import SOURCES
from factgraph.operators.observed import Watch, none_of
from factgraph.operators.setdiff import row_text
from factgraph.operators.shaping import first_row
from factgraph.session import cut_lineage

# --- catalog and queue ------------------------------------------------------------


def catalog_names(catalog: DataFrame) -> DataFrame:
    """Catalog rows with ``full_name`` and the reason when there is none.

    ``catalog(row_index, url, author, repo_name, category, local_path, needs_review)``.
    Author and name make the full name; a strict address is the fallback.
    """
    url, author, name = (F.coalesce(trim_ws(c), F.lit("")) for c in ("url", "author", "repo_name"))
    # One column per step, so that the patterns of an address run once per row.
    from_url = F.col("_from_url")
    given = F.when((author != "") & (name != ""), F.concat(author, F.lit("/"), name)).otherwise(from_url)
    full = F.col("full_name")
    problem = F.when(url == "", "missing_url").when(~F.coalesce(full.rlike(FULL_NAME), F.lit(False)), "invalid_full_name")
    rows = catalog.withColumn("_from_url", full_name_of_url(F.col("url"))).withColumn("_given", given)
    rows = rows.withColumn("full_name", F.when(F.col("_given").rlike(FULL_NAME), F.col("_given")).otherwise(from_url))
    return rows.withColumn("norm", F.lower(full)).withColumn("problem", problem).drop("_from_url", "_given")


def canonical_names(repos: DataFrame) -> DataFrame:
    """Normalised name and the spelling to show, the last record's on equal names."""
    known = repos.select(trim_ws("full_name").alias("canonical"), "ordinal").filter(F.col("canonical").rlike(FULL_NAME))
    return known.groupBy(F.lower("canonical").alias("norm")).agg(F.max_by("canonical", "ordinal").alias("canonical"))


def build_queue(catalog: DataFrame, repos: DataFrame) -> DataFrame:
    """One entry per repository of the catalog with its status.

    Categories, local paths and row indexes of an entry are rows of ``queue_sources``.
    """
    rows = catalog_names(catalog).filter("problem IS NULL")
    entries = rows.groupBy("norm").agg(
        F.min(F.struct("row_index", "full_name", trim_ws("url").alias("url"))).alias("first"),
        F.count_if(F.coalesce("needs_review", F.lit(False))).alias("needs_review_count"),
        F.count("*").alias("source_rows"),
    )
    known = F.col("canonical").isNotNull()
    full = F.coalesce("canonical", "first.full_name")
    return entries.join(canonical_names(repos), "norm", "left").select(
        F.concat(F.lit("intake::"), full).alias("queue_id"),
        full.alias("full_name"),
        F.col("first.url").alias("html_url"),
        F.when(known, "already_canonical").otherwise("queued").alias("canonical_status"),
        F.when(known, "hold").otherwise("pending").alias("intake_status"),
        F.when(known, "skip_existing_canonical").otherwise("candidate_shallow_scan").alias("recommended_action"),
        "needs_review_count",
        "source_rows",
        "norm",
    )


def queue_sources(catalog: DataFrame) -> DataFrame:
    """Distinct ``(norm, kind, value)`` with kind category, local_path or row_index."""
    rows = catalog_names(catalog).filter("problem IS NULL")
    kinds = {"category": trim_ws("category"), "local_path": trim_ws("local_path"), "row_index": F.col("row_index").cast("string")}
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in kinds.items()])
    return rows.select("norm", F.explode(pairs).alias("p")).select("norm", "p.*").filter("value <> ''").distinct()


def queue_summary(catalog: DataFrame, queue: DataFrame) -> DataFrame:
    known = F.col("canonical_status") == "already_canonical"
    sizes = queue.agg(F.count("*").alias("n"), F.count_if(known).alias("k"))
    named = catalog_names(catalog)
    return named.agg(
        F.count("*").alias("source_rows_total"),
        F.count_if(F.col("problem") == "missing_url").alias("source_rows_missing_url"),
        F.count_if(F.col("problem") == "invalid_full_name").alias("source_rows_invalid_full_name"),
    ).select(
        "*",
        sizes.select("n").scalar().alias("deduped_entries_total"),
        sizes.select("k").scalar().alias("already_canonical_count"),
        sizes.select(F.col("n") - F.col("k")).scalar().alias("queued_count"),
    )


def catalog_metadata(catalog: DataFrame) -> DataFrame:
    """Rows, and rows with address, author and name."""
    whole = F.lit(True)
    for c in ("url", "author", "repo_name"):
        whole = whole & (F.coalesce(trim_ws(c), F.lit("")) != "")
    return catalog.agg(F.count("*").alias("total_repos"), F.count_if(whole).alias("identified")).withColumn(
        "unidentified", F.col("total_repos") - F.col("identified")
    )


def admit_candidates(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Candidates with a strict address whose repository the catalog lacks, first per name.

    ``candidates(pos, url, ...)``.
    """
    named = candidates.withColumn("full_name", full_name_of_url(F.col("url"))).filter("full_name <> ''")
    named = named.withColumn("norm", F.lower("full_name"))
    known = catalog_names(catalog).filter("norm <> ''").select("norm").distinct()
    return first_row(named, ["norm"], ["pos"]).join(known, "norm", "left_anti")


# --- manifest ---------------------------------------------------------------------

# Sources a manifest row may name, target shards, and the keys it may hold.
MANIFEST_SOURCES = ["remote_metadata", "remote_api"]
OLD_SHARDS = ["", "llm_repos", "ssh_repos", "repos"]
MANIFEST_KEYS = [
    "target_shard", "source", "name", "github_full_name", "repo", "html_url", "category", "summary", "core_concepts",
    "key_entry_points", "build_run", "as_of", "local_cache_dir", "directory", "ecosystem_connections", "file_stem",
    "readme_fallback",
]
FALLBACK_FIELDS = ["build_run", "category", "core_concepts", "key_entry_points", "summary"]
TEXT_MAP = "map<string,string>"


def normalize_manifest(entries: DataFrame, default_source: str = "remote_metadata", default_category: str = "documentation") -> DataFrame:
    """Manifest rows with defaults and README fallbacks applied, and an error list each.

    ``entries(idx, entry VARIANT, is_mapping, default_shard, default_as_of)``. A
    fallback fills only a field that is blank; ``fallback_fields`` names the filled
    ones in order. Rows with errors keep their fields for the report.
    """
    e = S.col("entry")
    spare = sub(e, "readme_fallback")

    def mapping(v):
        pairs = S.transform(
            sorted_entries(v), lambda p: S.struct(p["key"].alias("key"), S.to_json(p["value"]).alias("value"))
        )
        return S.map_from_entries(pairs)

    raw = {
        "raw_shard": text(e, "target_shard"),
        "raw_source": text(e, "source"),
        "raw_full": S.lower(S.coalesce(S.nullif(text(e, "github_full_name"), ""), text(e, "repo"))),
        "raw_name": text(e, "name"),
        "raw_url": text(e, "html_url"),
        "raw_as_of": text(e, "as_of"),
        "raw_directory": text(e, "directory"),
        "raw_stem": text(e, "file_stem"),
        "local_cache_dir": S.when(
            S.schema_of_variant(sub(e, "local_cache_dir")) == "STRING", S.try_variant_get(e, "$.local_cache_dir", "string")
        ),
        "category0": text(e, "category"),
        "category1": text(spare, "category"),
        "summary0": text(e, "summary"),
        "summary1": text(spare, "summary"),
        "core_concepts0": texts(sub(e, "core_concepts")),
        "core_concepts1": texts(sub(spare, "core_concepts")),
        "key_entry_points0": texts(sub(e, "key_entry_points")),
        "key_entry_points1": texts(sub(spare, "key_entry_points")),
        "build_run0": mapping(sub(e, "build_run")),
        "build_run1": mapping(sub(spare, "build_run")),
        "ecosystem_connections": S.transform(objects(sub(e, "ecosystem_connections")), lambda o: S.to_json(o)),
        "extras": unknown_fields(e, MANIFEST_KEYS),
        "spare_kind": S.coalesce(S.regexp_extract(S.schema_of_variant(spare), "^[A-Z]+", 0), "VOID"),
    }
    rows = entries.select("*", *[x.column().alias(n) for n, x in raw.items()])

    def empty(c: Column, field: str) -> Column:
        return c == "" if field in ("category", "summary") else F.coalesce(F.size(c), F.lit(0)) <= 0

    chosen, filled = {}, []
    for field in FALLBACK_FIELDS:
        own, spare_value = F.col(field + "0"), F.col(field + "1")
        chosen[field] = F.when(empty(own, field), spare_value).otherwise(own)
        filled.append(F.when(empty(own, field) & ~empty(spare_value, field), F.lit(field)))
    chosen["category"] = F.coalesce(F.nullif(chosen["category"], F.lit("")), F.lit(default_category))

    def shard_of(c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit("")).isin(OLD_SHARDS), F.lit("repos")).otherwise(c)

    def filled_or(c: str, other: Column) -> Column:
        return F.coalesce(F.nullif(F.col(c), F.lit("")), other)

    full = F.col("raw_full")
    rows = rows.select(
        *entries.columns,
        shard_of(F.col("raw_shard")).alias("target_shard"),
        filled_or("raw_source", F.lit(default_source)).alias("source"),
        full.alias("full_name"),
        filled_or("raw_name", F.split_part(full, F.lit("/"), F.lit(2))).alias("name"),
        filled_or("raw_url", F.when(full != "", F.concat(F.lit("https://github.com/"), full)).otherwise(F.lit(""))).alias("html_url"),
        *[c.alias(n) for n, c in chosen.items()],
        filled_or("raw_as_of", F.coalesce(F.nullif("default_as_of", F.lit("")), F.lit("1970-01-01"))).alias("as_of"),
        filled_or("raw_directory", F.concat(F.lit("remote::"), full)).alias("directory"),
        "local_cache_dir", "ecosystem_connections", "extras", "raw_stem", "spare_kind",
        F.array_compact(F.array(*filled)).alias("fallback_fields"),
    )
    checks = [
        ("entry must be a mapping", ~F.col("is_mapping")),
        ("readme_fallback must be a mapping when provided", ~F.col("spare_kind").isin("OBJECT", "VOID")),
        ("target_shard is not allowed", F.col("target_shard") != "repos"),
        ("source is not allowed", ~F.col("source").isin(MANIFEST_SOURCES)),
        ("full name must match owner/name", ~F.col("full_name").rlike(FULL_NAME)),
        ("html_url must start with https://", ~F.startswith("html_url", F.lit("https://"))),
        ("name must be non-empty", F.col("name") == ""),
        ("summary must be non-empty", F.col("summary") == ""),
        ("core_concepts must be non-empty", F.size("core_concepts") <= 0),
        ("key_entry_points must be non-empty", F.size("key_entry_points") <= 0),
        ("build_run must be non-empty", F.size("build_run") <= 0),
        ("as_of must be a date or datetime", parse_as_of("as_of").isNull()),
    ]
    errors = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(m)) for m, c in checks]))
    stem = slug(filled_or("raw_stem", F.col("name")), slug(F.col("name"), F.lit("remote-repo")))
    return (
        rows.withColumn("errors", errors)
        .withColumn("file_stem", stem)
        .withColumn("source_file", F.concat("target_shard", F.lit("/knowledge/repos/"), "file_stem", F.lit(".yaml")))
        .drop("raw_stem", "spare_kind")
    )


def prepared_manifest(entries: DataFrame) -> DataFrame:
    """Normalised rows, checkpointed: gates, report and load all read them."""
    return cut_lineage(normalize_manifest(entries))


def manifest_records(rows: DataFrame) -> DataFrame:
    """Record rows of the valid manifest rows, with the refresh remark."""
    valid = rows.filter(F.size("errors") == 0)
    return valid.select(
        F.concat(F.lit("repo::"), "full_name").alias("node_id"), "name", "full_name", "html_url", "source",
        F.col("target_shard").alias("shard"), "source_file", "as_of", "directory", "category", "summary",
        "core_concepts", "key_entry_points", "build_run", "local_cache_dir", "ecosystem_connections", "extras",
        F.struct((F.size("fallback_fields") > 0).alias("fallback_used"), "fallback_fields").alias("refresh"),
    )


def ingestion_blockers(rows: DataFrame) -> DataFrame:
    """Rows with errors, node ids and files that occur twice; one row per problem."""
    bad = rows.filter(F.size("errors") > 0).select(
        F.lit("invalid_row").alias("reason"), F.col("idx").cast("string").alias("key"), F.array_join("errors", "; ").alias("detail")
    )
    records = manifest_records(rows)
    out = bad
    for reason, key in (("duplicate_node_id", "node_id"), ("duplicate_file", "source_file")):
        doubled = duplicate_keys(records, [key])
        out = out.unionByName(
            doubled.select(F.lit(reason).alias("reason"), F.col(key).alias("key"), F.col("occurrences").cast("string").alias("detail"))
        )
    return out


def load_all_or_nothing(rows: DataFrame) -> DataFrame:
    """The records when nothing blocks, no rows otherwise."""
    blockers = ingestion_blockers(rows).agg(F.count("*")).scalar()
    return manifest_records(rows).filter(blockers == 0)


def ingestion_metrics(rows: DataFrame) -> DataFrame:
    """Entries, valid ones, and how far README fallbacks were used."""
    good, used = F.size("errors") == 0, F.size("fallback_fields")
    out = rows.agg(
        F.count("*").alias("entries"),
        F.count_if(good).alias("valid_entries"),
        F.count_if(good & (used > 0)).alias("fallback_entries"),
        F.coalesce(F.sum(F.when(good, used)), F.lit(0).cast("bigint")).alias("fallback_fields"),
    )
    return out.withColumn("fallback_usage_pct", percentage(F.col("fallback_entries"), F.col("valid_entries")))


def ingestion_gates(rows: DataFrame) -> DataFrame:
    """Named gates of one ingestion run."""
    blockers = ingestion_blockers(rows).groupBy("reason").agg(F.count("*").alias("n"))
    twice = blockers.agg(F.count_if(F.col("reason") == "duplicate_node_id")).scalar()
    files = blockers.agg(F.count_if(F.col("reason") == "duplicate_file")).scalar()

    def faulty(message: str) -> Column:
        return F.count_if(F.array_contains("errors", message)) == 0

    good = F.size("errors") == 0
    texts = ["full_name", "name", "html_url", "source", "category", "summary"]
    lists = ["core_concepts", "key_entry_points", "build_run"]
    filled = reduce(and_, [*[~is_blank(c) for c in texts], *[F.coalesce(F.size(c), F.lit(0)) > 0 for c in lists]])
    wide = rows.agg(
        (F.count("*") > 0).alias("manifest_entries_present"),
        (F.count_if(F.size("errors") > 0) == 0).alias("manifest_entries_all_valid"),
        faulty("source is not allowed").alias("source_values_allowed"),
        faulty("target_shard is not allowed").alias("shard_values_valid"),
        (F.count_if(good & filled) == F.greatest(F.count_if(good), F.lit(1))).alias("required_field_coverage_100pct"),
    ).select("*", (twice == 0).alias("duplicate_node_ids_zero"), (files == 0).alias("duplicate_files_zero"))
    names = wide.columns
    whole = wide.withColumn("blocking_mismatches_zero", F.forall(F.array(*names), lambda x: x))
    return whole.unpivot([], [*names, "blocking_mismatches_zero"], "gate", "passed")


def ingest(rows: DataFrame, documents: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One run: the loaded records and its twelve gates (``gate, passed``).

    ``rows`` are normalised manifest rows (``normalize_manifest``), ``documents`` the parsed
    files they come from. Conditions over rows are observed while the rows, and then the
    records, are written; only duplicates are counted by queries. Nothing is loaded when a
    row is invalid or a key occurs twice.
    """
    watch = Watch()
    good = F.size("errors") == 0
    texts = ["full_name", "name", "html_url", "source", "category", "summary"]
    lists = ["core_concepts", "key_entry_points", "build_run"]
    filled = reduce(and_, [*[~is_blank(c) for c in texts], *[F.coalesce(F.size(c), F.lit(0)) > 0 for c in lists]])
    if documents is None:
        watch.holds("manifest_parseable", True)
    else:
        watch.staged(documents.select("path", "error"), manifest_parseable=none_of(F.col("error").isNotNull()))
    given = F.try_variant_get("entry", "$.local_cache_dir", "variant").isNotNull()
    rows = watch.staged(
        rows,
        {"entries": F.count("*"), "valid": F.count_if(good), "filled": F.count_if(good & filled)},
        manifest_entries_all_valid=none_of(~good),
        source_values_remote_only=none_of(F.array_contains("errors", "source is not allowed")),
        source_values_within_enum=none_of(~F.col("source").isin(SOURCES)),
        provenance_shard_values_valid=none_of(F.array_contains("errors", "target_shard is not allowed")),
        local_cache_dir_null_when_absent=none_of(F.col("local_cache_dir").isNotNull() & ~given),
    )
    watch.holds("manifest_entries_present", watch.values["entries"] > 0)
    watch.holds("required_field_coverage_100pct", watch.values["filled"] == max(watch.values["valid"], 1))
    blockers = {r["reason"] for r in ingestion_blockers(rows).select("reason").distinct().collect()}  # three reasons at most
    watch.holds("duplicate_node_ids_zero", "duplicate_node_id" not in blockers)
    watch.holds("duplicate_repo_file_paths_zero", "duplicate_file" not in blockers)
    watch.holds("blocking_mismatches_zero", not blockers)
    records = manifest_records(rows)
    loaded = watch.staged(records.limit(0) if blockers else records, {"written": F.count("*")})
    watch.holds("repo_writes_succeeded", watch.values["written"] == (0 if blockers else watch.values["valid"]) == loaded.count())
    return loaded, watch.results(rows.sparkSession)


# --- change tracking --------------------------------------------------------------


def classify_changes(previous: DataFrame, current: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``added``, ``updated``, ``unchanged`` or ``absent`` per key, by content hash."""

    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.sha2(row_text(list(columns)), 256).alias(name))

    both = hashed(previous, "old").join(hashed(current, "new"), key, "full_outer")
    change = (
        F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "absent")
        .when(F.col("old") == F.col("new"), "unchanged").otherwise("updated")
    )
    return both.select(key, change.alias("change"))


def merge_prior_run(prior: DataFrame, template: DataFrame, managed: DataFrame, key: str = "step") -> DataFrame:
    """Rows of a run ledger: managed rows are new, other rows keep what the prior run found.

    All three share the key and the same columns; the template fills blanks and steps
    that never ran, and prior steps outside it stay.
    """
    fields = [c for c in template.columns if c != key]

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(key, F.lit(True).alias("in_" + mark), *[F.col(f).alias(f"{mark}_{f}") for f in fields])

    rows = side(template, "t").join(side(prior, "p"), key, "full_outer").join(side(managed, "m"), key, "full_outer")
    merged = [
        F.when(F.col("in_m"), F.col("m_" + f))
        .when(F.col("in_p"), F.coalesce(F.nullif(F.col("p_" + f), F.lit("")), F.col("t_" + f)))
        .otherwise(F.col("t_" + f))
        .alias(f)
        for f in fields
    ]
    return rows.select(key, *merged)
