"""Record documents to record rows, and documents to records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions import sqlexpr as S
from factgraph.functions.text import is_blank
from factgraph.functions.variants import is_object, objects, sorted_entries, sub, text, text_list, unknown_fields, whole_text

# Fields to prefer when a list holds mappings, and the keys a record may hold.
CONCEPT_KEYS = ["name", "concept", "title", "description", "path", "location", "purpose"]
ENTRY_KEYS = ["path", "entry", "name", "purpose", "location", "description"]
RECORD_KEYS = [
    "node_id", "github_full_name", "html_url", "source", "name", "category", "summary", "core_concepts",
    "key_entry_points", "build_run", "provenance", "local_cache_dir", "ecosystem_connections", "extras",
]


def _json_map(v):
    pairs = S.transform(
        sorted_entries(v),
        lambda p: S.struct(p["key"].alias("key"), S.coalesce(S.try_variant_get(p["value"], "$", "string"), "").alias("value")),
    )
    return S.map_from_entries(pairs)


def compile_records(documents: DataFrame) -> DataFrame:
    """Canonical record rows with an error list each.

    ``documents(path, shard, body VARIANT)``. Lists of mappings keep one text per
    entry; the mappings themselves and unknown keys stay as JSON under ``extras``.
    """
    body, prov = S.col("body"), sub(S.col("body"), "provenance")
    concepts, entry_points = sub(body, "core_concepts"), sub(body, "key_entry_points")
    connections = sub(body, "ecosystem_connections")
    fields = {
        "node_id": whole_text(sub(body, "node_id")),
        "name": whole_text(sub(body, "name")),
        "full_name": whole_text(sub(body, "github_full_name")),
        "html_url": whole_text(sub(body, "html_url")),
        "category": whole_text(sub(body, "category")),
        "summary": whole_text(sub(body, "summary")),
        "core_concepts": text_list(concepts, CONCEPT_KEYS),
        "key_entry_points": text_list(entry_points, ENTRY_KEYS),
        "build_run": _json_map(sub(body, "build_run")),
        "source_file": S.coalesce(S.nullif(text(prov, "source_file"), ""), S.col("path")),
        "as_of": text(prov, "as_of"),
        "connections": S.transform(objects(connections), lambda o: S.to_json(o)),
        "structured": S.transform(S.concat(objects(concepts), objects(entry_points)), lambda o: S.to_json(o)),
        "extras": unknown_fields(body, RECORD_KEYS),
    }
    rows = documents.select("path", "shard", *[x.column().alias(n) for n, x in fields.items()])
    required = ["node_id", "full_name", "html_url", "name", "category", "summary", "as_of"]
    errors = [F.when(is_blank(c), F.lit("missing " + c)) for c in required]
    errors += [
        F.when(F.coalesce(F.size(c), F.lit(0)) <= 0, F.lit("empty " + c)) for c in ("core_concepts", "key_entry_points", "build_run")
    ]
    return rows.withColumn("errors", F.array_compact(F.array(*errors))).withColumn("source", F.lit("compiled_master"))


def has_mappings() -> Column:
    """Whether a document's lists hold mappings, which ``structured`` of its record must keep."""
    body = S.col("body")
    lists = S.concat(objects(sub(body, "core_concepts")), objects(sub(body, "key_entry_points")))
    return (S.size(lists) > 0).column()


def structured_fidelity(documents: DataFrame, records: DataFrame) -> DataFrame:
    """Documents with mappings in their lists against records that kept them."""
    given = documents.agg(F.count_if(has_mappings()).alias("n")).scalar()
    return records.agg(F.count_if(F.size("structured") > 0).alias("preserved")).select(
        given.alias("given"), "preserved", (given == F.col("preserved")).alias("passed")
    )


def resolve_documents(documents: DataFrame, records: DataFrame) -> DataFrame:
    """Documents with the record they belong to: by node id, else full name, else file stem.

    ``documents(path, file, shard, body)``; ``records(node_id, full_name, file_stem,
    shard, as_of)``. Three keyed joins instead of one with alternatives; a record of
    another shard does not count. Unresolved documents keep a null ``node_id``. The
    document's own ``as_of`` wins over the record's, then the epoch.
    """
    body = S.col("body")
    docs = documents.select(
        *[F.col(c) for c in documents.columns],
        text(body, "node_id").column().alias("claimed_id"),
        F.lower(text(body, "github_full_name").column()).alias("claimed_name"),
        F.lower(F.regexp_replace("file", r"\.[^.]+$", "")).alias("claimed_stem"),
        text(sub(body, "provenance"), "as_of").column().alias("doc_as_of"),
    )

    def keyed(key, name: str) -> DataFrame:
        identity = F.struct("node_id", F.col("shard").alias("shard"), F.col("as_of").alias("as_of"))
        return records.groupBy(key.alias(name)).agg(F.max(identity).alias("by_" + name)).filter(F.col(name) != "")

    out = docs
    for key, name in (
        (F.col("node_id"), "claimed_id"),
        (F.lower("full_name"), "claimed_name"),
        (F.lower("file_stem"), "claimed_stem"),
    ):
        out = out.join(keyed(key, name), name, "left")
    found = F.coalesce("by_claimed_id", "by_claimed_name", "by_claimed_stem")
    same = found["shard"] == F.col("shard")
    as_of = F.coalesce(F.nullif("doc_as_of", F.lit("")), F.nullif(found["as_of"], F.lit("")), F.lit("1970-01-01"))
    return out.select(*documents.columns, F.when(same, found["node_id"]).alias("node_id"), as_of.alias("as_of"))


def unresolved_findings(resolved: DataFrame) -> DataFrame:
    """Documents that do not parse or have no record."""
    reason = F.when(F.col("error").isNotNull(), F.split_part("error", F.lit(":"), F.lit(1))).otherwise("missing_shallow_match")
    return resolved.filter("error IS NOT NULL OR node_id IS NULL").select(
        F.lit("blocking").alias("severity"), reason.alias("reason"), F.col("path").alias("source_file"),
        F.coalesce("error", F.lit("no record for this document")).alias("detail"),
    )


def parity_findings(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Identity fields of documents that are missing or differ from the record."""
    body = S.col("body")
    names = {"name": "name", "node_id": "node_id", "full_name": "github_full_name", "html_url": "html_url"}
    claimed = resolved.filter("node_id IS NOT NULL").select(
        "path", F.col("node_id").alias("record_id"), *[text(body, k).column().alias("actual_" + n) for n, k in names.items()]
    )
    expected = records.select(F.col("node_id").alias("record_id"), *[F.col(n).alias("expected_" + n) for n in names])
    rows = F.array(
        *[F.struct(F.lit(n).alias("field"), F.col("expected_" + n).alias("expected"), F.col("actual_" + n).alias("actual")) for n in names]
    )
    out = claimed.join(expected, "record_id").select("path", "record_id", F.explode(rows).alias("c")).select("path", "record_id", "c.*")
    reason = F.when(F.col("actual") == "", "identity_missing_field").when(F.col("actual") != F.col("expected"), "identity_mismatch")
    return out.withColumn("reason", reason).filter("reason IS NOT NULL")


# Keys each kind of document needs, and sections of which one must be there.
SHALLOW_KEYS = ["name", "directory", "category", "summary", "core_concepts", "build_run"]
DEEP_KEYS = ["name", "directory", "category", "summary"]
DEEP_SECTIONS = ["architecture", "configuration"]


def required_key_issues(documents: DataFrame, deep: bool) -> DataFrame:
    """Parse errors (critical), missing keys (high), weak content (medium) per document."""
    body = S.col("body")
    has = {k: F.expr(S.isnotnull(sub(body, k)).text) for k in {*SHALLOW_KEYS, *DEEP_KEYS, *DEEP_SECTIONS}}
    run = sub(body, "build_run")
    parsed = F.col("error").isNull()
    issues = [F.when(~parsed, F.struct(F.lit("critical").alias("severity"), F.col("error").alias("message")))]

    def issue(condition, severity: str, message: str):
        return F.when(parsed & condition, F.struct(F.lit(severity).alias("severity"), F.lit(message).alias("message")))

    for key in DEEP_KEYS if deep else SHALLOW_KEYS:
        issues.append(issue(~has[key], "high", f"missing required key: {key}"))
    if deep:
        any_section = F.lit(False)
        for key in DEEP_SECTIONS:
            any_section = any_section | has[key]
        issues.append(issue(~any_section, "medium", "missing major content sections"))
    else:
        mapping = is_object(run).column()
        spoken = F.expr(S.isnotnull(sub(run, "language")).text)
        other = F.coalesce(text(body, "category").column(), F.lit("")) != "documentation"
        issues.append(issue(has["build_run"] & ~mapping, "high", "build_run must be a mapping"))
        issues.append(issue(has["build_run"] & mapping & ~spoken & other, "medium", "build_run missing language"))
    return documents.select("path", F.explode(F.array_compact(F.array(*issues))).alias("i")).select("path", "i.*")
