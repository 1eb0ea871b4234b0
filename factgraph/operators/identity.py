"""Identity resolution from the files of a source tree."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factgraph.functions.text import full_name_of_url, mentioned_full_names, norm_token, strip_branch_suffix, trim_ws

# Evidence source → rank, lower is better.
SOURCE_RANK = {
    "git_origin": 10,
    "go_mod_module": 20,
    "pyproject_meta": 30,
    "package_json_meta": 40,
    "cargo_repository": 45,
    "setup_py_meta": 50,
    "setup_cfg_meta": 55,
    "pom_xml_scm": 60,
    "mkdocs_repo_url": 70,
    "pubspec_meta": 75,
    "goreleaser_meta": 80,
    "llm_manifest": 85,
    "readme_self_match": 90,
}
README = "readme_self_match"

# Root file → evidence source, in reading order.
FILES = {
    ".git/config": "git_origin",
    "go.mod": "go_mod_module",
    "pyproject.toml": "pyproject_meta",
    "package.json": "package_json_meta",
    "Cargo.toml": "cargo_repository",
    "setup.py": "setup_py_meta",
    "setup.cfg": "setup_cfg_meta",
    "pom.xml": "pom_xml_scm",
    "mkdocs.yml": "mkdocs_repo_url",
    "pubspec.yaml": "pubspec_meta",
    ".goreleaser.yml": "goreleaser_meta",
    ".goreleaser.yaml": "goreleaser_meta",
    "README.md": README,
    "README.MD": README,
    "README.rst": README,
    "CHANGELOG.md": README,
    "CHANGELOG.MD": README,
    "CHANGES.rst": README,
}

# Fixed patterns: lines of a file that may hold the repository's address.
LINE_PATTERNS = {
    "pyproject_meta": r"(?i)^(?=.*=).*(repository|homepage|source|url)",
    "cargo_repository": r'^\s*repository\s*=\s*"',
    "setup_py_meta": r"(?i)^(?=.*github\.com/).*(url ?=|project_urls|repository|source|homepage|scm)",
    "setup_cfg_meta": r"(?i)^(?=.*github\.com/).*(home-page|homepage|url|project_urls|repository|source)",
    "pom_xml_scm": r"(?i)^(?=.*github\.com/).*(<url>|<connection>|<developerconnection>|<scm>)",
    "mkdocs_repo_url": r"^\s*repo_url:",
    "pubspec_meta": r"^\s*(repository|homepage):",
    "goreleaser_meta": r"(?i)github\.com/",
}


def toml_json(content: Column) -> Column:
    """TOML text as JSON text, null when it does not parse (the library reads one text at a time)."""

    def convert(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import json
        import tomllib

        import pandas

        def one(text):
            if text is None:
                return None
            try:
                return json.dumps(tomllib.loads(text), default=str, ensure_ascii=False)
            except Exception:
                return None

        for batch in texts:
            yield pandas.Series([one(t) for t in batch], dtype="object")

    # Spark picks the iterator form from the annotations, which must be real types here.
    convert.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(convert, "string")(content)


def _json_texts(body: Column, *paths: str) -> Column:
    """Texts at the paths of a JSON document, as one list; other values are passed over."""

    def one(path: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(body, path, "variant"))
        return F.when(kind == "STRING", F.try_variant_get(body, path, "string"))

    return F.array_compact(F.array(*[one(p) for p in paths]))


def mine_candidates(files: DataFrame) -> DataFrame:
    """Repository names that the known root files mention: ``repo, full_name, source``.

    ``files(repo, path, content)``. Only known files are read; each gives a list of
    texts to search, chosen per kind of file. The first file wins for equal names.
    """
    numbered = F.create_map(*[F.lit(x) for i, (path, source) in enumerate(FILES.items()) for x in (path, f"{i:02d}{source}")])
    known = files.filter(F.col("path").isin(list(FILES))).withColumn("kind", F.element_at(numbered, F.col("path")))
    known = known.withColumn("source", F.substring("kind", 3, 40))
    known = known.withColumn("toml", F.try_parse_json(toml_json(F.when(F.col("source") == "pyproject_meta", F.col("content")))))
    known = known.withColumn("json", F.try_parse_json(F.when(F.col("source") == "package_json_meta", F.col("content"))))

    lines = F.split("content", "\r\n|[\n\r]")
    source = F.col("source")
    origin = F.split(F.regexp_extract("content", r'(?s)(?:^|\n)\s*\[remote "origin"\]([^\[]*)', 1), "\r\n|[\n\r]")
    module = F.regexp_extract("content", r"(?m)^\s*module\s+(\S+)", 1)
    patterns = F.create_map(*[F.lit(x) for pair in LINE_PATTERNS.items() for x in pair])
    pattern = F.coalesce(F.element_at(patterns, source), F.lit("$^"))
    by_line = F.filter(lines, lambda s: F.rlike(s, pattern))
    urls = F.coalesce(
        F.map_values(F.try_variant_get("toml", "$.project.urls", "map<string,string>")), F.array().cast("array<string>")
    )
    toml_texts = F.concat(
        urls, _json_texts(F.col("toml"), "$.project.homepage", "$.project.repository", "$.tool.poetry.homepage", "$.tool.poetry.repository")
    )
    texts = (
        F.when(source == "git_origin", F.filter(F.transform(origin, trim_ws), lambda s: F.startswith(s, F.lit("url ="))))
        .when(source == "go_mod_module",
              F.array(F.when(F.startswith(module, F.lit("github.com/")), F.concat(F.lit("https://"), module)).otherwise(module)))
        .when(source == "package_json_meta",
              _json_texts(F.col("json"), "$.repository", "$.repository.url", "$.homepage", "$.bugs", "$.bugs.url"))
        .when(source == "pyproject_meta", F.concat(toml_texts, by_line))
        .when(source == README, F.array("content"))
        .otherwise(by_line)
    )
    found = known.select("repo", "kind", F.explode(F.flatten(F.transform(texts, mentioned_full_names))).alias("full_name"))
    firsts = found.groupBy("repo", "full_name", "kind").agg(F.count("*").alias("mentions"))
    return firsts.groupBy("repo", "full_name").agg(
        F.substring(F.min("kind"), 3, 40).alias("source"),
        # A README mention counts only for its own repository; other evidence is kept beside it.
        F.substring(F.min(F.when(F.substring("kind", 3, 40) != README, F.col("kind"))), 3, 40).alias("other_source"),
    )


def expected_tokens(name: Column, stem: Column, directory: Column) -> Column:
    """Normalised forms of the names a repository should go by."""
    forms = F.array(norm_token(name), norm_token(stem), norm_token(strip_branch_suffix(directory)))
    return F.array_distinct(F.filter(F.array_compact(forms), lambda t: t != ""))


def choose_identity(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """Best name per record: ``repo, full_name, source, status``.

    ``records(repo, tokens)``. Among names that match the record itself, the best rank
    decides and must name one repository. Without such a name, the only name of all
    high-confidence sources is taken. ``status`` is resolved, ambiguous or none.
    """
    ranks = F.create_map(*[F.lit(x) for pair in SOURCE_RANK.items() for x in pair])
    own = F.array_contains("tokens", norm_token(F.split_part("full_name", F.lit("/"), F.lit(2))))
    seen = candidates.join(records.select("repo", "tokens"), "repo").withColumn("own", own)
    seen = seen.withColumn("source", F.when(F.col("own"), F.col("source")).otherwise(F.col("other_source")))
    seen = seen.filter("source IS NOT NULL").withColumn("rank", F.element_at(ranks, F.col("source")))
    per_rank = seen.groupBy("repo", "own", "rank").agg(
        F.count("*").alias("n"), F.min(F.struct("full_name", "source")).alias("one")
    )
    best = per_rank.groupBy("repo").agg(
        F.min(F.when(F.col("own"), F.struct("rank", "n", "one"))).alias("self"),
        F.sum(F.when(~F.col("own"), F.col("n"))).alias("others"),
        F.min(F.when(~F.col("own"), F.col("one"))).alias("other"),
    )
    unclear = F.col("self.n") > 1
    return records.select("repo").join(best, "repo", "left").select(
        "repo",
        F.when(F.col("self").isNotNull(), F.when(~unclear, F.col("self.one.full_name")))
        .when(F.col("others") == 1, F.col("other.full_name")).alias("full_name"),
        F.when(F.col("self").isNotNull(), F.when(~unclear, F.col("self.one.source")))
        .when(F.col("others") == 1, F.col("other.source")).alias("source"),
        F.when(F.col("self").isNotNull(), F.when(unclear, "ambiguous_self").otherwise("resolved"))
        .when(F.col("others") == 1, "resolved").when(F.col("others") > 1, "ambiguous_other").otherwise("none").alias("status"),
    )


def resolve_with_fallbacks(
    records: DataFrame, chosen: DataFrame, manifest: DataFrame, catalog: DataFrame, allowed: DataFrame
) -> DataFrame:
    """Names left open filled from the manifest, a declared remote identity, or the catalog.

    ``records(repo, directory, declared_source, declared_full_name, declared_node_id,
    declared_url)``; ``manifest`` and ``catalog`` are ``(directory, full_name)``;
    catalog names count only for records listed in ``allowed(repo)``.
    """

    def per_directory(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("directory").agg(F.max("full_name").alias(name))

    rows = (
        records.join(chosen, "repo", "left")
        .join(per_directory(manifest, "manifest_name"), "directory", "left")
        .join(per_directory(catalog, "catalog_name"), "directory", "left")
        .join(allowed.select("repo", F.lit(True).alias("may_fall_back")), "repo", "left")
    )
    declared = F.col("declared_full_name")
    remote = F.col("declared_source").isin("remote_metadata", "remote_api") | F.startswith("directory", F.lit("remote::"))
    stated = (
        F.coalesce(remote, F.lit(False))
        & declared.rlike("^[^/]+/[^/]+$")
        & (F.col("declared_node_id") == F.concat(F.lit("repo::"), declared))
        & (F.lower(full_name_of_url(F.col("declared_url"))) == F.lower(declared))
    )
    open_ = F.col("status") == "none"
    name = (
        F.when(~open_, F.col("full_name")).when(F.col("manifest_name").isNotNull(), F.col("manifest_name"))
        .when(stated, F.lower(declared)).when(F.coalesce("may_fall_back", F.lit(False)), F.col("catalog_name"))
    )
    via = (
        F.when(~open_, F.col("source")).when(F.col("manifest_name").isNotNull(), "llm_manifest")
        .when(stated, "existing_remote_identity")
        .when(F.coalesce("may_fall_back", F.lit(False)) & F.col("catalog_name").isNotNull(), "assistive_master_repo_list")
    )
    problem = F.when(~open_ & (F.col("status") != "resolved"), F.col("status")).when(
        name.isNull(),
        F.when(F.col("catalog_name").isNotNull(), "fallback_not_allowed").otherwise("unresolved"),
    )
    return rows.select("repo", "directory", name.alias("full_name"), via.alias("source"), problem.alias("problem"))


def stamp_identity(records: DataFrame, resolved: DataFrame) -> DataFrame:
    """Records with the canonical identity fields beside the old ones (``old_*``)."""
    fields = {
        "node_id": F.concat(F.lit("repo::"), "resolved_name"),
        "full_name": F.col("resolved_name"),
        "html_url": F.concat(F.lit("https://github.com/"), "resolved_name"),
    }
    names = resolved.filter("problem IS NULL").select(
        "repo", F.col("full_name").alias("resolved_name"), F.col("source").alias("source_used")
    )
    kept = records.select("*", *[F.col(f).alias("old_" + f) for f in fields]).drop(*fields)
    return kept.join(names, "repo").withColumns(fields).drop("resolved_name")


def identity_conflicts(stamped: DataFrame, fields: Sequence[str] = ("node_id", "full_name", "html_url")) -> DataFrame:
    """One override event per field whose old value differs."""
    rows = F.array(
        *[F.struct(F.lit(f).alias("field"), F.col("old_" + f).alias("old_value"), F.col(f).alias("new_value")) for f in fields]
    )
    events = stamped.select("repo", "source_used", F.explode(rows).alias("c")).select("repo", "source_used", "c.*")
    return events.filter("old_value IS NOT NULL AND old_value <> new_value")


# Sources and shards a record may name.
RECORD_SOURCES = ["repos", "remote_metadata", "remote_api", "compiled_master"]
RECORD_SHARDS = ["repos", "merged"]


def malformed_identity(records: DataFrame, expected_shard: str = "repos") -> DataFrame:
    """Names of malformed identity and provenance fields per record that has any.

    ``records(repo, path, full_name, html_url, source, node_id, shard, source_file, as_of)``.
    """

    def bad(condition: Column, name: str) -> Column:
        return F.when(~F.coalesce(condition, F.lit(False)), F.lit(name))

    fields = F.array_compact(
        F.array(
            bad(F.col("full_name").rlike("^[^/]+/[^/]+$"), "full_name"),
            bad(F.col("html_url").rlike("^https://github\\.com/[^/]+/[^/]+$"), "html_url"),
            bad(F.startswith("node_id", F.lit("repo::")), "node_id"),
            bad(F.col("source").isin(RECORD_SOURCES) & ((F.col("source") != "repos") | F.lit(expected_shard == "repos")), "source"),
            bad(F.col("shard").isin(RECORD_SHARDS), "provenance.shard"),
            bad(F.col("shard") == expected_shard, "provenance.shard_mismatch"),
            bad(F.col("source_file") == F.col("path"), "provenance.source_file"),
            bad(F.col("as_of") != "", "provenance.as_of"),
        )
    )
    return records.select("repo", fields.alias("malformed")).filter(F.size("malformed") > 0)


# --- links between documents ------------------------------------------------------


def link_stems(deep: DataFrame, shallow: DataFrame) -> DataFrame:
    """Deep documents with the shallow one of the same shard and folded stem.

    Both hold ``shard, stem, file``; of shallow documents that fold alike the last file
    counts. ``problem`` says ``unlinked`` where there is none.
    """
    token = norm_token("stem").alias("token")
    last = shallow.groupBy("shard", token).agg(F.max("file").alias("shallow_file"))
    rows = deep.select("shard", token, F.col("file").alias("deep_file")).join(last, ["shard", "token"], "left")
    return rows.withColumn("problem", F.when(F.col("shallow_file").isNull(), "unlinked")).drop("token")


def profile_names(requests: DataFrame, manifest: DataFrame, canonical: DataFrame) -> DataFrame:
    """``full_name, file_stem, node_id`` of profiles to be written.

    The stem comes from the manifest (``full_name, file_stem``), else from the canonical
    record (``full_name, file_stem, node_id``), else from the name; the id from the
    record, else from the name. Of rows with one name the last in text order counts.
    """

    def last(df: DataFrame, **columns: str) -> DataFrame:
        return df.filter(F.col("full_name").isNotNull()).groupBy("full_name").agg(*[F.max(c).alias(n) for n, c in columns.items()])

    rows = requests.select("full_name").join(last(manifest, given="file_stem"), "full_name", "left")
    rows = rows.join(last(canonical, known="file_stem", known_id="node_id"), "full_name", "left")
    owner, name = (F.lower(F.split_part("full_name", F.lit("/"), F.lit(i))) for i in (1, 2))
    return rows.select(
        "full_name",
        F.coalesce(F.nullif("given", F.lit("")), F.nullif("known", F.lit("")), F.concat(owner, F.lit("__"), name)).alias("file_stem"),
        F.coalesce(F.nullif("known_id", F.lit("")), F.concat(F.lit("repo::"), "full_name")).alias("node_id"),
    )
