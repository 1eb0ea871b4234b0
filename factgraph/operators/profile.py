"""Structural profile of source trees.

Input is ``files(repo, path, size, content)``. Every operator is keyed by repository and
works on rows of files or directories, so one very large tree is spread like many small
ones. Lists of a profile are rows with a rank, never arrays of unknown length.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factgraph.operators.aggregates import subtree_counts
from factgraph.operators.identity import toml_json
from factgraph.operators.shaping import first_n, first_row
from factgraph.session import staged

# File name → manifest kind.
MANIFEST_KINDS = {
    "pyproject.toml": "python_manifest",
    "requirements.txt": "python_requirements",
    "requirements-dev.txt": "python_requirements",
    "setup.py": "python_manifest",
    "setup.cfg": "python_manifest",
    "package.json": "node_manifest",
    "pnpm-workspace.yaml": "node_workspace",
    "go.mod": "go_manifest",
    "Cargo.toml": "rust_manifest",
    "Chart.yaml": "helm_chart_manifest",
}

# File name or path → configuration kind.
CONFIG_KINDS = {
    "docker-compose.yml": "runtime_config",
    "docker-compose.yaml": "runtime_config",
    "compose.yml": "runtime_config",
    "compose.yaml": "runtime_config",
    ".env.example": "env_example",
    ".env.sample": "env_example",
    ".github/workflows": "ci_config",
    "tsconfig.json": "typescript_config",
    "vite.config.ts": "build_config",
    "vite.config.js": "build_config",
    "next.config.js": "framework_config",
    "next.config.mjs": "framework_config",
    "next.config.ts": "framework_config",
    "pytest.ini": "test_config",
    "tox.ini": "test_config",
    "mkdocs.yml": "docs_config",
    "wrangler.toml": "runtime_config",
    "turbo.json": "build_config",
    "mcp.json": "runtime_config",
}

# File ending → language.
LANGUAGES = {
    ".py": "python",
    ".ts": "typescript",
    ".tsx": "typescript",
    ".js": "javascript",
    ".jsx": "javascript",
    ".go": "go",
    ".rs": "rust",
    ".java": "java",
    ".kt": "kotlin",
    ".rb": "ruby",
    ".php": "php",
    ".cpp": "cpp",
    ".cc": "cpp",
    ".cxx": "cpp",
    ".c": "c",
    ".h": "c",
    ".hpp": "cpp",
}

# Words of paths and what they stand for.
NOISE = [
    "bench", "benchmark", "benchmarks", "demo", "demos", "dist", "doc", "docs", "example", "examples", "fixture",
    "fixtures", "generated", "preset", "presets", "sample", "samples", "site", "storybook", "template", "templates",
    "test", "testutils", "tests",
]
SUPPORT = [
    "blog", "cookbook", "coverage", "dev", "githooks", "helm", "hook", "hooks", "infra", "monitoring", "ops", "public",
    "script", "scripts", "static", "tool", "tools",
]
FRONTEND = ["console", "dashboard", "frontend", "portal", "site", "ui", "web"]
GENERIC = [
    "app", "apps", "client", "clients", "cmd", "feature", "features", "internal", "lib", "libs", "net", "package",
    "packages", "server", "src", "type", "types", "util", "utils",
]
RUNTIME = ["admin", "api", "app", "cli", "cmd", "daemon", "gateway", "mcp", "server", "service", "worker"]
BOUNDARY = [
    "all", "client", "clients", "control", "core", "embed", "engine", "integration", "integrations", "memory", "plane", "sdk",
]
WORKER_STEMS = ["celery_entrypoint", "worker_entrypoint", "queue_worker", "worker_app"]
DEV_HINTS = ["eslint", "jest", "mypy", "prettier", "pytest", "ruff", "storybook", "tsup", "typescript", "vitest"]
FRAMEWORK_CONFIGS = [
    "next.config.js", "next.config.mjs", "next.config.ts", "nuxt.config.js", "nuxt.config.ts", "remix.config.js",
    "remix.config.ts", "svelte.config.js", "svelte.config.ts", "vite.config.js", "vite.config.ts",
]

# Lengths of lists.
ENTRYPOINTS, MIN_LIST = 8, 8
EXTERNAL, INTERNAL = 20, 16


def _in(words: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _count(array: str, words: Sequence[str]) -> str:
    return f"size(filter({array}, w -> w IN {_in(words)}))"


# --- features of a path -----------------------------------------------------------


def path_features(df: DataFrame, path: str = "path") -> DataFrame:
    """Parts, name, ending, words and labels of a path; ``.`` has no parts."""
    clean = F.when(F.col(path) == ".", F.lit("")).otherwise(F.col(path))
    parts = F.array_remove(F.split(clean, "/"), "")
    out = df.withColumn("parts", parts)
    return out.selectExpr(
        "*",
        "size(parts) AS n_parts",
        "coalesce(get(parts, size(parts) - 1), '') AS name",
        "coalesce(lower(regexp_extract(get(parts, size(parts) - 1), '^.+([.][^.]+)$', 1)), '') AS suffix",
        "coalesce(regexp_replace(get(parts, size(parts) - 1), '^(.+)[.][^.]+$', '$1'), '') AS stem",
        "CASE WHEN size(parts) > 1 THEN array_join(slice(parts, 1, size(parts) - 1), '/') ELSE '.' END AS parent",
        # One pattern per path and none per part: words of all parts, and one label of joined words per part.
        "array_remove(split(regexp_replace(lower(array_join(parts, '/')), '[^a-z0-9]+', ' '), ' '), '') AS tokens",
        "array_remove(split(trim(BOTH '_' FROM replace(replace("
        "regexp_replace(lower(array_join(parts, '/')), '[^a-z0-9/]+', '_'), '_/', '/'), '/_', '/')), '/'), '') AS labels",
    )


def featured(files: DataFrame) -> DataFrame:
    """``repo, path`` and features of all files; ``files`` itself when it is a table of them."""
    return files if "parts" in files.columns else path_features(files.select("repo", "path"))


def file_paths(files: DataFrame) -> DataFrame:
    """What the paths of all files say, written once: the steps of a profile read it by column."""
    return staged(path_features(files.select("repo", "path")).select("repo", "path", "parts", "n_parts", "name", "suffix", "parent"))


def orientation_score(prefer_runtime: bool) -> Column:
    """How much a path says about the program's structure, from its words and depth."""
    runtime, boundary = (4, 2) if prefer_runtime else (3, 3)
    return F.expr(
        f"{runtime} * {_count('tokens', RUNTIME)} + {boundary} * {_count('tokens', BOUNDARY)}"
        f" - 6 * {_count('labels', NOISE)} - 3 * {_count('labels', SUPPORT)}"
        " + CASE WHEN n_parts <= 2 THEN 3 WHEN n_parts = 3 THEN 1 ELSE -least(n_parts - 1, 4) END"
        " + CASE WHEN startswith(lower(name), 'readme') THEN 2 ELSE 0 END"
    )


def is_noise() -> Column:
    """A noise or support label, or a compound label made of such words only."""
    return F.expr(f"exists(labels, w -> forall(split(w, '_'), t -> t IN {_in([*NOISE, *SUPPORT])}))")


def has_noise_label() -> Column:
    return F.expr(f"exists(labels, w -> w IN {_in(NOISE)})")


def is_source() -> Column:
    return F.col("suffix").isin(list(LANGUAGES))


def walk_key() -> Column:
    """Sorts paths like a walk: the files of a directory before its subdirectories, both by name."""
    return F.expr(
        "array_join(transform(parts, (p, i) -> concat(CASE WHEN i = size(parts) - 1 THEN '0' ELSE '1' END, p)), '\\u0001')"
    )


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key)


def manifest_signals(files: DataFrame) -> DataFrame:
    """Manifests: ``repo, path, kind``."""
    kind = F.coalesce(
        _lookup(MANIFEST_KINDS, F.col("name")),
        F.when(F.startswith("name", F.lit("requirements")) & (F.col("suffix") == ".txt"), F.lit("python_requirements")),
    )
    rows = featured(files).withColumn("kind", kind).filter("kind IS NOT NULL")
    return rows.select("repo", "path", "kind", walk_key().alias("walk"))


def config_signals(files: DataFrame) -> DataFrame:
    """Configuration files: ``repo, path, kind``."""
    path = F.col("path")
    kind = F.coalesce(
        _lookup(CONFIG_KINDS, path),
        _lookup(CONFIG_KINDS, F.col("name")),
        F.when(F.startswith(path, F.lit(".github/workflows/")), F.lit("ci_workflow")),
        F.when(F.endswith(path, F.lit(".env.example")) | F.endswith(path, F.lit(".env.sample")), F.lit("env_example")),
    )
    rows = featured(files).withColumn("kind", kind).filter("kind IS NOT NULL")
    return rows.select("repo", "path", "kind", walk_key().alias("walk"))


def languages(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """Languages by number of files, a manifest counting as one more; ``rank`` orders them."""
    counted = (
        featured(files)
        .select("repo", _lookup(LANGUAGES, F.col("suffix")).alias("language"))
        .filter("language IS NOT NULL")
        .groupBy("repo", "language")
        .agg(F.count("*").alias("n"))
    )
    bonus = F.expr(
        "CASE WHEN kind IN ('python_manifest', 'python_requirements') THEN 'python'"
        " WHEN kind IN ('node_manifest', 'node_workspace') THEN 'typescript'"
        " WHEN kind = 'go_manifest' THEN 'go' WHEN kind = 'rust_manifest' THEN 'rust' END"
    )
    extra = manifests.select("repo", bonus.alias("language")).filter("language IS NOT NULL").distinct()
    total = (
        counted.unionByName(extra.withColumn("n", F.lit(1).cast("bigint")))
        .groupBy("repo", "language")
        .agg(F.sum("n").alias("files"))
    )
    # At most one row per language and repository.
    order = Window.partitionBy("repo").orderBy(F.desc("files"), "language")
    return total.withColumn("rank", F.row_number().over(order))


def source_files(files: DataFrame) -> DataFrame:
    return featured(files).filter(is_source())


def source_dir_counts(files: DataFrame) -> DataFrame:
    """Source files below every directory: ``repo, dir, files``."""
    return subtree_counts(source_files(files).select("repo", "path"), ["repo"])


def group_dir_counts(files: DataFrame) -> DataFrame:
    """Source files per first directory, or per second one below the usual source roots."""
    second = F.expr("n_parts >= 2 AND get(parts, 0) IN ('src', 'app', 'server', 'cmd', 'pkg', 'internal')")
    place = F.when(second, F.expr("concat(get(parts, 0), '/', get(parts, 1))")).otherwise(F.expr("get(parts, 0)"))
    return source_files(files).groupBy("repo", place.alias("dir")).agg(F.count("*").alias("files"))


@dataclass(frozen=True)
class Signals:
    """What several steps of a profile read: the paths of all files with their features, and small
    tables next to them, each made once."""

    paths: DataFrame
    manifests: DataFrame
    configs: DataFrame
    dir_counts: DataFrame
    frontend: DataFrame


def tree_signals(files: DataFrame) -> Signals:
    paths = file_paths(files)
    manifests, configs = staged(manifest_signals(paths)), staged(config_signals(paths))
    counts = staged(source_dir_counts(paths))
    return Signals(paths, manifests, configs, counts, staged(frontend_facts(paths, manifests, configs)))


# --- frontend boost ---------------------------------------------------------------


def frontend_facts(files: DataFrame, manifests: DataFrame, configs: DataFrame) -> DataFrame:
    """Directories with a node manifest, a framework configuration below, or route files."""
    node = path_features(manifests.filter("kind IN ('node_manifest', 'node_workspace')").select("repo", "path"))
    node = node.select("repo", F.col("parent").alias("dir"), F.lit("manifest").alias("fact"))
    framework = path_features(configs.select("repo", "path")).filter(F.col("name").isin(FRAMEWORK_CONFIGS))
    framework = framework.select(
        "repo",
        F.expr("explode(transform(sequence(1, greatest(n_parts - 1, 1)), i -> array_join(slice(parts, 1, i), '/')))").alias("dir"),
        F.lit("framework").alias("fact"),
    )
    routes = featured(files).filter(
        "n_parts >= 3 AND suffix IN ('.js', '.jsx', '.ts', '.tsx', '.vue', '.svelte')"
    )
    route_dirs = F.expr(
        "explode(transform(filter(sequence(1, n_parts - 2), i -> parts[i] IN ('app', 'pages', 'routes', 'src')),"
        " i -> array_join(slice(parts, 1, i), '/')))"
    )
    routes = routes.select("repo", route_dirs.alias("dir"), F.lit("routes").alias("fact"))
    every = node.unionByName(framework).unionByName(routes)
    return every.groupBy("repo", "dir").agg(
        F.bool_or(F.col("fact") == "manifest").alias("has_manifest"),
        F.bool_or(F.col("fact") == "framework").alias("has_framework"),
        F.bool_or(F.col("fact") == "routes").alias("has_routes"),
    )


def with_frontend_boost(dirs: DataFrame, facts: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``boost`` to ``dirs(repo, path, features)``: only sizeable frontend directories get one."""
    sizeable = counts.filter("files >= 8").select("repo", "dir", F.col("files").alias("below"))
    known = facts.join(sizeable, ["repo", "dir"]).withColumnRenamed("dir", "path")
    rows = dirs.join(known, ["repo", "path"], "left")
    rows = rows.na.fill(False, ["has_manifest", "has_framework", "has_routes"]).na.fill(0, ["below"])
    wanted = F.expr(f"exists(labels, w -> w IN {_in(FRONTEND)})") & ~is_noise() & F.expr(
        "below >= 8 AND (has_manifest OR has_framework OR has_routes)"
    )
    worth = F.expr(
        "4 + CASE WHEN has_manifest THEN 2 ELSE 0 END + CASE WHEN has_framework THEN 4 ELSE 0 END"
        " + CASE WHEN has_routes THEN 3 ELSE 0 END + CASE WHEN n_parts = 1 THEN 2 ELSE 0 END"
        " + CASE WHEN below >= 100 THEN 4 WHEN below >= 30 THEN 2 ELSE 0 END"
    )
    return rows.withColumn("boost", F.when(wanted, worth).otherwise(F.lit(0))).drop(
        "has_manifest", "has_framework", "has_routes", "below"
    )


# --- ranking with a cap that depends on the repository ------------------------------


def top_by_score(rows: DataFrame, caps: DataFrame, tie: str) -> DataFrame:
    """Best ``cap`` rows per repository by score, then by ``tie``; adds ``rank``.

    ``caps(repo, cap)``. The score at which the cap falls is found from counts per score,
    so only rows at or above it are ranked; rows below never leave their task.
    """
    per_score = rows.groupBy("repo", "score").agg(F.count("*").alias("n"))
    higher = Window.partitionBy("repo").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        per_score.withColumn("above", F.coalesce(F.sum("n").over(higher), F.lit(0)))
        .join(caps, "repo")
        .filter("above < cap")
        .groupBy("repo", "cap")
        .agg(F.min("score").alias("lowest"))
    )
    order = Window.partitionBy("repo").orderBy(F.desc("score"), tie)
    kept = rows.join(cut, "repo").filter("score >= lowest").withColumn("rank", F.row_number().over(order))
    return kept.filter("rank <= cap").drop("cap", "lowest")


# --- package roots ----------------------------------------------------------------

ROOT_BONUS = {"manifest": 12, "init": 8, "structural": 6, "workspace_child": 7}


@dataclass(frozen=True)
class Roots:
    """``roots(repo, path, score, rank)`` and ``evidence(repo, path, kind, evidence_path, detail)``."""

    roots: DataFrame
    evidence: DataFrame


def package_root_candidates(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """Directories that may be roots, one row per reason."""
    found = path_features(manifests.select("repo", "path", "kind"))
    by_manifest = found.select(
        "repo", F.col("parent").alias("root"), F.lit("manifest").alias("source"), F.lit("manifest").alias("evidence_kind"),
        F.col("path").alias("evidence_path"), F.col("kind").alias("detail"),
    )
    manifest_dirs = by_manifest.select("repo", F.col("root").alias("above")).distinct()
    none = F.lit(None).cast("string")

    # Package directories, first directories and children; each choice reads its own columns.
    every = featured(files)
    first, second = F.get("parts", F.lit(0)), F.get("parts", F.lit(1))
    child = (F.col("n_parts") >= 2) & first.isin("packages", "libs") & ~second.rlike("^.+[.][^.]+$")
    hints = {
        "init": (F.col("name") == "__init__.py", F.col("parent")),
        "structural": (first.isin("src", "app", "server", "cmd", "pkg", "internal", "packages", "libs"), first),
        "workspace_child": (child, F.concat(first, F.lit("/"), second)),
    }
    found_in = [
        every.filter(c).select("repo", root.alias("root")).distinct().withColumn("source", F.lit(source))
        for source, (c, root) in hints.items()
    ]
    hinted = staged(reduce(DataFrame.unionByName, found_in))
    dirs = path_features(hinted, "root").filter(~is_noise())
    inits = dirs.filter("source = 'init'").withColumn(
        "above", F.when(F.col("n_parts") == 0, F.lit(".")).otherwise(F.col("parent"))
    )
    nested = inits.filter("n_parts <> 1").join(manifest_dirs, ["repo", "above"], "left_semi")
    packages = inits.filter("n_parts = 1").select("repo", "root").unionByName(nested.select("repo", "root"))
    at = F.when(F.col("root") == ".", F.lit("__init__.py")).otherwise(F.concat("root", F.lit("/__init__.py")))
    by_init = packages.select(
        "repo", "root", F.lit("init").alias("source"), F.lit("filepath").alias("evidence_kind"), at.alias("evidence_path"),
        none.alias("detail"),
    )
    by_place = dirs.filter("source <> 'init'").select(
        "repo", "root", "source", F.lit("directory").alias("evidence_kind"), F.col("root").alias("evidence_path"),
        none.alias("detail"),
    )
    return by_manifest.unionByName(by_init).unionByName(by_place).withColumnRenamed("root", "path")


def package_roots(files: DataFrame, signals: Signals) -> Roots:
    """Best roots per repository; at least eight, and eight more than it has workspace children."""
    candidates = staged(package_root_candidates(signals.paths, signals.manifests))
    bonus = F.max(F.element_at(F.create_map(*[F.lit(x) for p in ROOT_BONUS.items() for x in p]), F.col("source")))
    best = candidates.groupBy("repo", "path").agg(bonus.alias("bonus"))
    scored = with_frontend_boost(path_features(best), signals.frontend, signals.dir_counts)
    base = orientation_score(False) + F.col("boost") - F.when(is_noise(), 8).otherwise(0)
    roots = scored.select("repo", "path", F.when(F.col("path") == ".", F.lit(18)).otherwise(base + F.col("bonus")).alias("score"))
    children = (
        candidates.filter("source = 'workspace_child'").select("repo", "path").distinct()
        .groupBy("repo").agg(F.count("*").alias("n"))
    )
    repos = files.select("repo").distinct()
    caps = repos.join(children, "repo", "left").select(
        "repo", F.greatest(F.lit(MIN_LIST), F.coalesce("n", F.lit(0)) + 8).alias("cap")
    )
    roots = staged(roots)
    chosen = staged(top_by_score(roots, caps, "path"))
    bare = repos.join(roots.select("repo").distinct(), "repo", "left_anti").select(
        "repo", F.lit(".").alias("path"), F.lit(0).alias("score"), F.lit(1).alias("rank")
    )
    evidence = candidates.select("repo", "path", "evidence_kind", "evidence_path", "detail").distinct()
    shown = evidence.join(chosen.select("repo", "path"), ["repo", "path"], "left_semi").unionByName(
        bare.select("repo", "path", F.lit("directory").alias("evidence_kind"), F.lit(".").alias("evidence_path"),
                    F.lit("repo root fallback").alias("detail"))
    )
    return Roots(chosen.unionByName(bare), shown)


# --- entrypoints ------------------------------------------------------------------

_BASE_SCORE = f"""
CASE WHEN lname IN ('main.py', 'main.ts', 'main.js', 'main.go', 'main.rs') THEN 5 ELSE 0 END
+ CASE WHEN lname = 'main.go' AND n_parts = 1 THEN 8 ELSE 0 END
+ CASE WHEN lname IN ('app.py', 'server.py', 'manage.py', 'cli.py', 'wsgi.py', 'asgi.py', 'index.ts', 'index.js') THEN 4 ELSE 0 END
+ CASE WHEN lname = 'main.go' AND in_cmd THEN 5 ELSE 0 END
+ CASE WHEN own_dir THEN 6 ELSE 0 END
+ CASE WHEN startswith(lname, 'main.') THEN 2 ELSE 0 END
+ CASE WHEN startswith(lname, 'server.') THEN 2 ELSE 0 END
+ CASE WHEN startswith(path, 'src/main.') THEN 2 ELSE 0 END
+ CASE WHEN lower(stem) IN {_in(WORKER_STEMS)} THEN 5 ELSE 0 END
+ CASE WHEN array_contains(tokens, 'worker') THEN 2 ELSE 0 END"""

# The last rule that applies names the kind and the remark, so the tests run backwards.
_KIND = f"""
CASE WHEN lower(stem) IN {_in(WORKER_STEMS)} THEN 'worker_entry' WHEN lname IN ('wsgi.py', 'asgi.py') THEN 'server_entry'
 WHEN path = 'manage.py' THEN 'management_entry' WHEN startswith(lname, 'server.') THEN 'server_entry'
 WHEN own_dir AND in_cmd THEN 'cli_entry' WHEN lname = 'main.go' AND in_cmd THEN 'cli_entry' WHEN lname = 'cli.py' THEN 'cli_entry'
 ELSE 'app_entry' END"""
_NOTE = f"""
CASE WHEN lower(stem) IN {_in(WORKER_STEMS)} THEN 'celery/queue worker bootstrap stem'
 WHEN lname IN ('wsgi.py', 'asgi.py') THEN 'framework entry convention' WHEN path = 'manage.py' THEN 'framework manage convention'
 WHEN own_dir THEN 'directory-matched runtime file' WHEN lname = 'main.go' AND in_cmd THEN 'cmd main convention'
 WHEN lname = 'main.go' AND n_parts = 1 THEN 'root module bootstrap' ELSE 'filename heuristic' END"""


def entrypoint_scores(files: DataFrame, dir_counts: DataFrame) -> DataFrame:
    """Source files that look like an entrypoint: ``repo, path, kind, note, score``."""
    rows = source_files(files).selectExpr(
        "*",
        "lower(name) AS lname",
        "array_contains(parts, 'cmd') AS in_cmd",
        "n_parts >= 2 AND lower(get(parts, n_parts - 2)) = lower(stem) AS own_dir",
    )
    rows = rows.filter("lname <> '__init__.py' AND NOT endswith(lname, '_test.go')")
    rows = rows.withColumn("base", F.expr(_BASE_SCORE)).filter("base > 0").filter(~is_noise())
    rows = rows.withColumn("kind", F.expr(_KIND)).withColumn("note", F.expr(_NOTE)).withColumn("fit", orientation_score(True))
    below = dir_counts.select("repo", F.col("dir").alias("parent"), F.col("files").alias("below"))
    rows = rows.join(below, ["repo", "parent"], "left").na.fill(0, ["below"])
    score = F.expr(
        "base + fit + CASE WHEN below >= 3 THEN least(below, 18) DIV 2 ELSE 0 END"
        " + CASE WHEN kind = 'worker_entry' AND n_parts <= 3 THEN 3 ELSE 0 END"
        " + CASE WHEN n_parts >= 3 AND get(parts, 0) = 'cmd' AND lname = concat(lower(get(parts, 1)), suffix) THEN 6 ELSE 0 END"
        " - CASE WHEN n_parts >= 3 AND get(parts, 0) = 'cmd' AND lname = 'main.go' AND below <= 2 THEN 4 ELSE 0 END"
        " - CASE WHEN array_contains(tokens, 'admin') THEN 3 ELSE 0 END"
    )
    return rows.select("repo", "path", "kind", "note", score.cast("int").alias("score"))


def secondary_module_penalty(scored: DataFrame, manifests: DataFrame) -> DataFrame:
    """Ten points off below a nested module, where the root is a module itself."""
    modules = path_features(manifests.filter("kind = 'go_manifest'").select("repo", "path"))
    main = modules.filter("path = 'go.mod'").select("repo")
    nested = modules.filter("parent <> '.'").join(main, "repo", "left_semi").select("repo", F.col("parent").alias("dir"))
    rows = path_features(scored.select("repo", "path")).filter("n_parts >= 2")
    above = F.expr("explode(transform(sequence(1, n_parts - 1), i -> array_join(slice(parts, 1, i), '/')))")
    hit = rows.select("repo", "path", above.alias("dir")).join(nested, ["repo", "dir"], "left_semi")
    flagged = hit.select("repo", "path").distinct().withColumn("nested", F.lit(True))
    off = F.when(F.col("nested") & (F.col("score") >= 4), 10).otherwise(0)
    return scored.join(flagged, ["repo", "path"], "left").withColumn("score", F.col("score") - F.coalesce(off, F.lit(0))).drop("nested")


def _joined_path(parent: Column, inner: Column) -> Column:
    """Path below a directory with ``./`` steps removed."""
    flat = F.regexp_replace(F.regexp_replace(inner, r"^(\./)+", ""), r"/(\./)+", "/")
    return F.when(parent == ".", flat).otherwise(F.concat(parent, F.lit("/"), flat))


def package_json_entries(files: DataFrame) -> DataFrame:
    """``main`` and ``bin`` of package files: ``repo, manifest, path, kind, detail, seq``."""
    rows = path_features(files.filter(F.endswith("path", F.lit("package.json"))).select("repo", "path", "content"))
    rows = rows.filter("name = 'package.json'").withColumn("json", F.try_parse_json("content"))

    def texts_of(path: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get("json", path, "variant"))
        return F.when(kind == "STRING", F.nullif(F.try_variant_get("json", path, "string"), F.lit("")))

    bins = F.map_entries(F.try_variant_get("json", "$.bin", "map<string,string>"))
    listed = F.transform(F.array_sort(bins), lambda e: F.struct(e["value"].alias("target"), F.concat(F.lit("package.json bin:"), e["key"]).alias("detail")))
    single = F.array(F.struct(texts_of("$.bin").alias("target"), F.lit("package.json bin").alias("detail")))
    main = F.array(F.struct(texts_of("$.main").alias("target"), F.lit("package.json main").alias("detail")))
    entries = F.concat(main, F.when(texts_of("$.bin").isNotNull(), single).otherwise(F.coalesce(listed, F.array().cast("array<struct<target:string,detail:string>>"))))
    out = rows.select("repo", F.col("path").alias("manifest"), "parent", F.posexplode(entries).alias("seq", "e"))
    out = out.filter("e.target <> ''")
    kind = F.when(F.col("e.detail") == "package.json main", "app_entry").otherwise("cli_entry")
    return out.select("repo", "manifest", _joined_path(F.col("parent"), F.col("e.target")).alias("path"), kind.alias("kind"), F.col("e.detail").alias("detail"), "seq")


# Folders of built files, the folders their sources stand in, and source endings.
BUILT_DIRS, SOURCE_DIRS, SOURCE_ENDINGS = ["dist", "build", "out"], ["src", "app", "server"], [".ts", ".tsx", ".js", ".jsx", ".py"]


def source_equivalents(paths: DataFrame, files: DataFrame) -> DataFrame:
    """Existing source file for each path into a built folder: ``repo, path, source_path``."""
    rows = path_features(paths.select("repo", "path").distinct()).filter(F.arrays_overlap("parts", F.array(*[F.lit(d) for d in BUILT_DIRS])))
    options = F.expr(
        "flatten(transform(array('src', 'app', 'server'), (d, i) -> transform(array('.ts', '.tsx', '.js', '.jsx', '.py'), (x, j) ->"
        " named_struct('n', i * 5 + j, 'p', concat(regexp_replace(array_join(transform(parts, p ->"
        " CASE WHEN p IN ('dist', 'build', 'out') THEN d ELSE p END), '/'), '[.][^./]+$', ''), x)))))"
    )
    tried = rows.select("repo", "path", F.explode(options).alias("o")).select("repo", "path", "o.n", F.col("o.p").alias("source_path"))
    known = files.select("repo", F.col("path").alias("source_path"))
    hits = tried.join(known, ["repo", "source_path"], "left_semi")
    return hits.groupBy("repo", "path").agg(F.min_by("source_path", "n").alias("source_path"))


def pyproject_entries(files: DataFrame) -> DataFrame:
    """Scripts whose module exists: ``repo, manifest, path, kind, detail, seq``."""
    rows = path_features(files.filter(F.endswith("path", F.lit("pyproject.toml"))).select("repo", "path", "content"))
    rows = rows.filter("name = 'pyproject.toml'").withColumn("toml", F.try_parse_json(toml_json(F.col("content"))))

    def scripts(path: str, label: str) -> Column:
        pairs = F.array_sort(F.map_entries(F.try_variant_get("toml", path, "map<string,string>")))
        made = F.transform(pairs, lambda e: F.struct(e["key"].alias("command"), e["value"].alias("target"), F.concat(F.lit(label + ":"), e["key"]).alias("detail")))
        return F.coalesce(made, F.array().cast("array<struct<command:string,target:string,detail:string>>"))

    both = F.concat(scripts("$.project.scripts", "project.scripts"), scripts("$.tool.poetry.scripts", "tool.poetry.scripts"))
    out = rows.select("repo", F.col("path").alias("manifest"), "parent", F.posexplode(both).alias("seq", "e"))
    out = out.select("repo", "manifest", "parent", "seq", "e.command", "e.target", "e.detail").filter("contains(target, ':')")
    module = F.replace(F.trim(F.split_part("target", F.lit(":"), F.lit(1))), F.lit("."), F.lit("/"))
    out = out.withColumn("module", _joined_path(F.col("parent"), module)).filter("module <> ''")
    options = F.array(F.concat("module", F.lit(".py")), F.concat("module", F.lit("/__init__.py")))
    tried = out.select("repo", "manifest", "seq", "command", "detail", F.posexplode(options).alias("n", "path"))
    hits = tried.join(files.select("repo", "path"), ["repo", "path"], "left_semi")
    best = hits.groupBy("repo", "manifest", "seq").agg(F.min(F.struct("n", "path", "command", "detail")).alias("b"))
    kind = F.when(F.col("b.command").rlike("cli|admin"), "cli_entry").otherwise("app_entry")
    return best.select("repo", "manifest", F.col("b.path").alias("path"), kind.alias("kind"), F.col("b.detail").alias("detail"), "seq")


def manifest_entry_scores(files: DataFrame) -> DataFrame:
    """Entrypoints that manifests name, built paths turned into source paths, with scores."""
    node = package_json_entries(files)
    mains = node.filter("detail = 'package.json main'")
    node = node.join(source_equivalents(mains, files), ["repo", "path"], "left")
    swapped = F.col("source_path").isNotNull() & (F.col("detail") == "package.json main")
    node = node.select(
        "repo", "manifest", "seq", "kind", F.when(swapped, F.col("source_path")).otherwise(F.col("path")).alias("path"),
        F.when(swapped, F.lit("package.json main mapped to authored source")).otherwise(F.col("detail")).alias("detail"),
        F.lit(5).alias("base"),
    )
    python = pyproject_entries(files).select("repo", "manifest", "seq", "kind", "path", "detail", F.lit(4).alias("base"))
    rows = path_features(node.unionByName(python))
    off = F.expr(
        "CASE WHEN base = 4 THEN CASE WHEN array_contains(tokens, 'admin') THEN 3 ELSE 0 END"
        " + CASE WHEN array_contains(tokens, 'local') THEN 1 ELSE 0 END ELSE 0 END"
    )
    return rows.select("repo", "path", "kind", F.col("detail").alias("note"), (F.col("base") + orientation_score(True) - off).alias("score"), F.concat("manifest", F.lit("|"), F.lpad(F.col("seq").cast("string"), 6, "0")).alias("origin"))


def entrypoints(files: DataFrame, signals: Signals) -> DataFrame:
    """Eight best entrypoints per repository: ``repo, rank, path, kind, note, confidence``."""
    by_path = staged(entrypoint_scores(files, signals.dir_counts))
    by_path = secondary_module_penalty(by_path, signals.manifests).filter("score >= 4")
    confidence = F.when(F.col("score") >= 6, "high").otherwise("medium")
    by_path = by_path.withColumn("confidence", confidence).withColumn("origin", F.lit(""))
    by_manifest = manifest_entry_scores(files).withColumn("confidence", F.lit("medium"))
    best = first_row(by_path.unionByName(by_manifest), ["repo", "path"], [F.desc("score"), "origin"])
    return staged(first_n(best, ["repo"], [F.desc("score"), "path"], ENTRYPOINTS, "rank").drop("origin"))


# --- module groups ----------------------------------------------------------------


@dataclass(frozen=True)
class Groups:
    """``groups(repo, rank, name, first_path, path_count, rationale, confidence, score)`` and
    ``paths(repo, name, path)``."""

    groups: DataFrame
    paths: DataFrame


MERGED = "merged related package roots with the same module label"


def module_groups(files: DataFrame, roots: Roots, signals: Signals) -> Groups:
    """Roots and repeated source directories merged by label."""
    name = F.translate(F.col("name"), "-.", "__")
    counts = staged(group_dir_counts(signals.paths))
    helm = roots.evidence.filter("detail = 'helm_chart_manifest'").select("repo", "path").distinct().withColumn("helm", F.lit(True))
    dirs = path_features(roots.roots.filter("path <> '.'").select("repo", "path")).filter(~is_noise())
    boosted = with_frontend_boost(dirs, signals.frontend, counts).join(helm, ["repo", "path"], "left")
    chart = F.coalesce("helm", F.lit(False))
    from_roots = boosted.select(
        "repo", name.alias("name"), "path", F.lit(0).alias("origin"),
        F.when(chart, "helm chart deployment artifact root").otherwise("package root or workspace module boundary").alias("rationale"),
        (F.when(chart, 30).otherwise(10) + orientation_score(False) + F.col("boost")).alias("score"),
    )
    repeated = path_features(counts.filter("files >= 2").select("repo", F.col("dir").alias("path"), "files")).filter(~is_noise())
    from_dirs = repeated.select(
        "repo", name.alias("name"), "path", F.lit(1).alias("origin"),
        F.lit("directory grouping with repeated source files").alias("rationale"),
        (F.col("files") + orientation_score(False)).alias("score"),
    )
    members = staged(from_roots.unionByName(from_dirs))
    reason = F.min(F.struct("origin", "rationale"))
    by_path = members.groupBy("repo", "name", "path").agg(F.max("score").alias("score"), reason.alias("r"))
    several = F.col("path_count") > 1
    merged = (
        by_path.groupBy("repo", "name")
        .agg(F.max("score").cast("int").alias("score"), F.min("r").alias("r"), F.count("*").alias("path_count"), F.min("path").alias("first_path"))
        .select(
            "repo", "name", "score", "first_path", "path_count",
            F.when(several, MERGED).otherwise(F.col("r.rationale")).alias("rationale"),
            F.when(several, "high").otherwise("medium").alias("confidence"),
        )
    )
    caps = roots.roots.groupBy("repo").agg(F.greatest(F.lit(MIN_LIST), F.count("*")).alias("cap"))
    merged = staged(merged)
    chosen = staged(top_by_score(merged, caps, "name"))
    top_root = roots.roots.groupBy("repo").agg(F.min_by("path", "rank").alias("first_path"))
    bare = path_features(top_root.join(merged.select("repo").distinct(), "repo", "left_anti"), "first_path").select(
        "repo", F.when(F.col("name") == "", "repo_root").otherwise(F.col("name")).alias("name"), F.lit(0).alias("score"),
        "first_path", F.lit(1).cast("bigint").alias("path_count"),
        F.lit("fallback structural grouping from package root").alias("rationale"), F.lit("medium").alias("confidence"),
        F.lit(1).alias("rank"),
    )
    paths = members.select("repo", "name", "path").distinct().join(chosen.select("repo", "name"), ["repo", "name"], "left_semi")
    return Groups(chosen.unionByName(bare), paths.unionByName(bare.select("repo", "name", F.col("first_path").alias("path"))))


# --- dependencies -----------------------------------------------------------------


def requirement_names(text: Column) -> Column:
    """Package names of requirement lines: no comments or options, cut at the version mark."""
    lines = F.transform(F.split(text, "\r\n|[\n\r]"), lambda s: F.trim(s))
    named = F.transform(F.filter(lines, lambda s: s.rlike("^[^#-]")), lambda s: F.trim(F.regexp_replace(s, r"[<>=!~\[].*$", "")))
    return F.filter(named, lambda s: s != "")


def go_requires(text: Column) -> Column:
    """Module paths of ``require`` lines and blocks."""
    blocks = F.regexp_extract_all(text, F.lit(r"(?m)^\s*require \(\s*$([^)]*)"), F.lit(1))
    inside = F.flatten(F.transform(blocks, lambda b: F.split(b, "\n")))
    single = F.regexp_extract_all(text, F.lit(r"(?m)^\s*require ([^\s(]\S*)"), F.lit(1))
    first = F.transform(inside, lambda s: F.regexp_extract(s, r"^\s*(\S+)", 1))
    return F.concat(F.filter(first, lambda s: s != ""), single)


def _keys(body: str, path: str) -> Column:
    return F.coalesce(F.map_keys(F.try_variant_get(body, path, "map<string,variant>")), F.array().cast("array<string>"))


def is_dev_dependency(name: Column) -> Column:
    return F.lower(name).rlike("|".join(DEV_HINTS))


def external_packages(files: DataFrame, manifests: DataFrame, entries: DataFrame, groups: Groups, most: int | None = EXTERNAL) -> DataFrame:
    """Packages named by manifests, weighted by their order: ``repo, package, weight, rank``.

    Every manifest is read; the most telling one weighs 8, the eighth and all after it
    weigh 1. ``most`` is the length of the list (``None`` lists all).
    """
    first = F.split_part("path", F.lit("/"), F.lit(1))
    entry_roots = entries.groupBy("repo", first.alias("head")).agg(F.count("*").alias("entry_hits"))
    leading = groups.groups.filter("rank <= 4").select("repo", "name")
    group_roots = (
        groups.paths.join(leading, ["repo", "name"], "left_semi").groupBy("repo", first.alias("head")).agg(F.count("*").alias("group_hits"))
    )
    rows = path_features(manifests.select("repo", F.col("path").alias("manifest"), "kind"), "manifest")
    placed = path_features(rows.select("repo", "manifest", "kind", F.col("parent").alias("dir")), "dir")
    placed = placed.withColumn("head", F.when(F.col("n_parts") > 0, F.expr("get(parts, 0)")))
    placed = placed.join(entry_roots, ["repo", "head"], "left").join(group_roots, ["repo", "head"], "left")
    main = F.col("kind").isin("python_manifest", "node_manifest", "go_manifest", "rust_manifest")
    worth = (
        F.lit(12) + orientation_score(False) + 5 * F.coalesce("entry_hits", F.lit(0)) + 2 * F.coalesce("group_hits", F.lit(0))
        + F.when(main, 2).otherwise(0)
    )
    # The first eight are told apart; the others need no order among themselves.
    named = placed.select("repo", F.col("manifest").alias("path"), worth.alias("worth"))
    leading = first_n(named, ["repo"], [F.desc("worth"), "path"], 8, "place").select("repo", "path", "place")
    used = named.join(leading, ["repo", "path"], "left").select("repo", "path", F.expr("greatest(9 - coalesce(place, 9), 1)").alias("weight"))
    read = used.join(files.select("repo", "path", "content"), ["repo", "path"])
    read = path_features(read).withColumn("json", F.try_parse_json(F.when(F.col("name") == "package.json", F.col("content"))))
    is_toml = F.col("name").isin("pyproject.toml", "Cargo.toml")
    read = read.withColumn("toml", F.try_parse_json(toml_json(F.when(is_toml, F.col("content")))))
    listed = F.coalesce(F.try_variant_get("toml", "$.project.dependencies", "array<string>"), F.array().cast("array<string>"))
    poetry = F.filter(_keys("toml", "$.tool.poetry.dependencies"), lambda n: n != "python")
    names = (
        F.when(F.col("name") == "package.json", F.concat(_keys("json", "$.dependencies"), _keys("json", "$.peerDependencies")))
        .when(F.col("name") == "pyproject.toml", F.concat(requirement_names(F.array_join(listed, "\n")), poetry))
        .when(F.startswith("name", F.lit("requirements")), requirement_names(F.col("content")))
        .when(F.col("name") == "go.mod", go_requires(F.col("content")))
        .when(F.col("name") == "Cargo.toml", _keys("toml", "$.dependencies"))
    )
    packages = read.select("repo", "weight", F.explode(names).alias("package")).filter(~is_dev_dependency(F.col("package")))
    weighted = packages.groupBy("repo", "package").agg(F.sum("weight").alias("weight"))
    return _ranked(weighted, "weight", "package", most)


def _ranked(rows: DataFrame, by: str, name: str, most: int | None) -> DataFrame:
    order = [F.desc(by), name]
    if most is None:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("repo").orderBy(*order)))
    return first_n(rows, ["repo"], order, most, "rank")


# Fixed patterns: import statements per language.
PY_IMPORT = r"(?m)^\s*(?:from|import)\s+([A-Za-z_][\w\.]*)"
JS_IMPORT = r"""(?m)(?:import\s+.+?\s+from\s+|import\s*['"]|require\()\s*['"]([^'"]+)['"]"""
GO_IMPORT = r'"([^"\n]+)"'


def internal_imports(files: DataFrame, roots: DataFrame, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """How often source files import modules below the package roots: ``repo, module, imports``.

    All files are scanned whole, unless ``max_files`` (in walk order, per repository) or
    ``max_bytes`` (per file) say less.
    """
    rows = path_features(files if max_bytes is None else files.filter(F.col("size") <= max_bytes)).filter(is_source())
    if max_files is not None:
        rows = first_n(rows.withColumn("walk", walk_key()), ["repo"], ["walk"], max_files)
    found = (
        F.when(F.col("suffix") == ".py", F.regexp_extract_all("content", F.lit(PY_IMPORT), F.lit(1)))
        .when(F.col("suffix").isin(".js", ".jsx", ".ts", ".tsx"), F.regexp_extract_all("content", F.lit(JS_IMPORT), F.lit(1)))
        .when((F.col("suffix") == ".go") & F.contains("content", F.lit("import")), F.regexp_extract_all("content", F.lit(GO_IMPORT), F.lit(1)))
    )
    lang = F.when(F.col("suffix") == ".py", "python").when(F.col("suffix") == ".go", "go").otherwise("javascript")
    named = rows.select("repo", lang.alias("lang"), F.explode(found).alias("import"))
    named = named.filter("NOT (lang = 'javascript' AND import RLIKE '^[.][.]?/')")
    prefix = F.expr(
        "CASE lang WHEN 'python' THEN split_part(import, '.', 1) WHEN 'go' THEN split_part(import, '/', -1)"
        " ELSE replace(split_part(import, '/', 1), '@', '') END"
    )
    counted = named.groupBy("repo", prefix.alias("prefix"), collapsed_module("import", "lang").alias("module")).agg(F.count("*").alias("n"))
    prefixes = path_features(roots.filter("path <> '.'").select("repo", "path")).select("repo", F.translate("name", "-", "_").alias("prefix")).distinct()
    own = counted.join(prefixes, ["repo", "prefix"], "left_semi")
    return own.groupBy("repo", "module").agg(F.sum("n").alias("imports"))


def collapsed_module(name: str, lang: str) -> Column:
    """First two parts of a module, for Go the last two."""
    return F.expr(
        f"CASE {lang} WHEN 'python' THEN CASE WHEN size(filter(split({name}, '[.]'), p -> p <> '')) >= 2"
        f" THEN array_join(slice(filter(split({name}, '[.]'), p -> p <> ''), 1, 2), '.') ELSE {name} END"
        f" ELSE CASE WHEN size(filter(split({name}, '/'), p -> p <> '')) < 2 THEN {name}"
        f" WHEN {lang} = 'go' THEN array_join(slice(filter(split({name}, '/'), p -> p <> ''), -2, 2), '/')"
        f" ELSE array_join(slice(filter(split({name}, '/'), p -> p <> ''), 1, 2), '/') END END"
    )


def internal_modules(imports: DataFrame, most: int | None = INTERNAL) -> DataFrame:
    """Most imported own modules (``None`` lists all)."""
    return _ranked(imports, "imports", "module", most)


# --- orientation hints ------------------------------------------------------------


def _take(rows: DataFrame, n: int) -> DataFrame:
    """First ``n`` distinct paths per repository by (stage, turn, sub)."""
    firsts = rows.groupBy("repo", "path").agg(F.min(F.struct("stage", "turn", "sub")).alias("o"))
    return first_n(firsts, ["repo"], ["o", "path"], n, "rank").select("repo", "path", "rank")


def _first_paths(groups: Groups, n: int) -> DataFrame:
    """Up to ``n`` paths of each chosen group, in order."""
    listed = first_n(groups.paths, ["repo", "name"], ["path"], n, "sub")
    return listed.join(groups.groups.select("repo", "name", F.col("rank").alias("g"), "confidence"), ["repo", "name"])


def first_reads(
    entries: DataFrame, groups: Groups, signals: Signals, most: int = 6, broad_entries: int = 6, broad_groups: int = 5
) -> DataFrame:
    """``most`` paths to read first: entrypoints, charts, then leading groups.

    The order of this report depends on the shape of a repository: a broad one
    (``broad_entries`` entrypoints and ``broad_groups`` groups) ranks its groups anew,
    leaves the last place to them and fills up with further entrypoints.
    """
    sizes = entries.groupBy("repo").agg(F.count("*").alias("e")).join(
        groups.groups.groupBy("repo").agg(F.count("*").alias("g")), "repo", "full_outer"
    ).select("repo", (F.coalesce("e", F.lit(0)) >= broad_entries).alias("many"), (F.coalesce("g", F.lit(0)) >= broad_groups).alias("wide"))
    broad = sizes.select("repo", (F.col("many") & F.col("wide")).alias("broad"))

    firsts = path_features(groups.groups.select("repo", F.col("name").alias("group"), "first_path", "rank", "confidence"), "first_path")
    firsts = firsts.withColumnRenamed("first_path", "path")
    boosted = with_frontend_boost(firsts, signals.frontend, signals.dir_counts)
    generic = _count("labels", GENERIC)
    fit = orientation_score(False) + F.col("boost") + F.expr(
        f"CASE WHEN n_parts >= 2 THEN 4 ELSE 0 END + CASE WHEN {generic} = 0 THEN 5 ELSE 0 END - 4 * {generic}"
        " + CASE WHEN confidence = 'high' THEN 1 ELSE 0 END"
    )
    leading = first_n(boosted.withColumn("fit", fit), ["repo"], [F.desc("fit"), "path"], 3, "turn").select("repo", F.col("group").alias("name"), F.col("turn").alias("broad_turn"))

    place = F.col("rank")
    by_entry = entries.join(broad, "repo").select(
        "repo", "path", "broad", F.when(place <= F.when(F.col("broad"), 2).otherwise(3), 0).when(F.col("broad"), 3).alias("stage"),
        place.alias("turn"), F.lit(0).alias("sub"),
    )
    by_chart = chart_roots(signals.manifests).join(broad, "repo").select("repo", "path", "broad", F.lit(1).alias("stage"), F.col("rank").alias("turn"), F.lit(0).alias("sub"))
    members = _first_paths(groups, most).join(broad, "repo").join(leading, ["repo", "name"], "left")
    turn = F.when(F.col("broad"), F.col("broad_turn")).otherwise(F.when(F.col("g") <= 3, F.col("g")))
    by_group = members.select("repo", "path", "broad", F.lit(2).alias("stage"), turn.alias("turn"), "sub").filter("turn IS NOT NULL")
    rows = staged(by_entry.filter("stage IS NOT NULL").unionByName(by_chart).unionByName(by_group))
    # The groups of a broad repository stop one path early.
    early = _take(rows.filter("broad AND stage < 3"), most - 1).join(broad.filter("broad"), "repo").select("repo", "path", F.lit(0).alias("stage"), F.col("rank").alias("turn"), F.lit(0).alias("sub"))
    late = rows.filter("broad AND stage = 3").select("repo", "path", "stage", "turn", "sub")
    plain = rows.filter("NOT broad").select("repo", "path", "stage", "turn", "sub")
    return _take(early.unionByName(late).unionByName(plain), most)


def chart_roots(manifests: DataFrame, most: int = 2) -> DataFrame:
    """First ``most`` chart directories in walk order."""
    charts = path_features(manifests.filter("kind = 'helm_chart_manifest'").select("repo", "path", "walk"))
    return first_n(charts, ["repo"], ["walk"], most, "rank").select("repo", F.col("parent").alias("path"), "rank")


def runtime_surfaces(files: DataFrame, entries: DataFrame, groups: Groups, signals: Signals, most: int = 6, per_kind: int = 4) -> DataFrame:
    """``most`` runtime surfaces: entrypoints, charts, large runtime groups, then
    configuration, ``per_kind`` of the first and the last."""
    started = entries.select("repo").distinct().withColumn("started", F.lit(True))
    charts = chart_roots(signals.manifests)
    charted = charts.select("repo").distinct().withColumn("charted", F.lit(True))
    state = files.select("repo").distinct().join(started, "repo", "left").join(charted, "repo", "left").na.fill(False)
    state = state.select("repo", "started", (~F.col("started") & F.col("charted")).alias("charts_only"))

    by_entry = entries.filter(F.col("rank") <= per_kind).select("repo", "path", F.lit(0).alias("stage"), F.col("rank").alias("turn"), F.lit(0).alias("sub"))
    by_chart = charts.select("repo", "path", F.lit(1).alias("stage"), F.col("rank").alias("turn"), F.lit(0).alias("sub"))
    of_charts = _first_paths(groups, most).filter(F.col("g") <= most).join(state.filter("charts_only"), "repo", "left_semi").select(
        "repo", "path", F.lit(2).alias("stage"), F.col("g").alias("turn"), "sub"
    )
    leading = path_features(groups.groups.filter("rank <= 3").select("repo", F.col("first_path").alias("path"), "rank"))
    large = signals.dir_counts.filter("files >= 20").select("repo", F.col("dir").alias("path"))
    by_group = (
        leading.filter(F.expr(f"exists(tokens, w -> w IN {_in(RUNTIME)})")).join(large, ["repo", "path"], "left_semi")
        .join(state.filter("NOT charts_only"), "repo", "left_semi")
        .select("repo", "path", F.lit(2).alias("stage"), F.col("rank").alias("turn"), F.lit(0).alias("sub"))
    )
    rows = path_features(signals.configs).join(state.filter("NOT charts_only"), "repo")
    wanted = F.col("kind").isin("runtime_config", "env_example") | (~F.col("started") & F.col("kind").isin("framework_config", "typescript_config"))
    preferred = first_n(rows.filter(wanted).withColumn("fit", orientation_score(True)), ["repo"], [F.desc("fit"), "path"], per_kind, "turn")
    spare = rows.filter("kind NOT IN ('ci_workflow', 'docs_config')").join(preferred.select("repo").distinct(), "repo", "left_anti")
    fallback = first_n(spare, ["repo"], ["walk"], per_kind, "turn")
    by_config = preferred.select("repo", "path", "turn").unionByName(fallback.select("repo", "path", "turn"))
    by_config = by_config.select("repo", "path", F.lit(3).alias("stage"), "turn", F.lit(0).alias("sub"))
    every = by_entry.unionByName(by_chart).unionByName(of_charts).unionByName(by_group).unionByName(by_config)
    return _take(every, most)


def limitations(files: DataFrame, entries: DataFrame, dependencies: DataFrame, max_files: int | None = None) -> DataFrame:
    """Remarks on what a profile leaves open: ``repo, limitation, rank``."""
    scanned = source_files(files).groupBy("repo").agg(F.count("*").alias("sources"))
    weak = entries.groupBy("repo").agg(F.bool_or(F.col("confidence") == "medium").alias("weak"))
    known = dependencies.select("repo").distinct().withColumn("known", F.lit(True))
    state = files.select("repo").distinct().join(scanned, "repo", "left").join(weak, "repo", "left").join(known, "repo", "left")
    remarks = F.array_compact(
        F.array(
            F.lit("module groups are heuristic directory-level clusters"),
            F.lit("no behavioral, failure-mode, or cross-repo claims are emitted"),
            F.when(F.col("weak"), "some entrypoints come from filename or manifest heuristics"),
            F.when(F.col("known").isNull(), "dependency and import hints were omitted where cheap signals were weak"),
            F.when(F.col("sources") > max_files, "import scanning was capped to keep the pre-pass cheap and deterministic")
            if max_files is not None
            else F.lit(None).cast("string"),
        )
    )
    return state.select("repo", F.posexplode(remarks).alias("rank", "limitation"))


# --- assembly ---------------------------------------------------------------------


class Profile:
    """All tables of a profile, each keyed by ``repo``.

    A table is made when it is first asked for, and then once; others read it. A caller who
    wants one table does not pay for what that table does not rest on.
    """

    def __init__(self, files: DataFrame, max_files: int | None = None):
        self.files, self.max_files = staged(files), max_files

    @cached_property
    def signals(self) -> Signals:
        return tree_signals(self.files)

    @property
    def manifests(self) -> DataFrame:
        return self.signals.manifests

    @property
    def configs(self) -> DataFrame:
        return self.signals.configs

    @cached_property
    def languages(self) -> DataFrame:
        return staged(languages(self.files, self.manifests))

    @cached_property
    def roots(self) -> Roots:
        return package_roots(self.files, self.signals)

    @cached_property
    def entrypoints(self) -> DataFrame:
        return entrypoints(self.files, self.signals)

    @cached_property
    def groups(self) -> Groups:
        return module_groups(self.files, self.roots, self.signals)

    @cached_property
    def external(self) -> DataFrame:
        return staged(external_packages(self.files, self.manifests, self.entrypoints, self.groups))

    @cached_property
    def internal(self) -> DataFrame:
        return staged(internal_modules(internal_imports(self.files, self.roots.roots, self.max_files)))

    @cached_property
    def first_reads(self) -> DataFrame:
        return first_reads(self.entrypoints, self.groups, self.signals)

    @cached_property
    def surfaces(self) -> DataFrame:
        return runtime_surfaces(self.files, self.entrypoints, self.groups, self.signals)

    @cached_property
    def limitations(self) -> DataFrame:
        known = self.external.select("repo").unionByName(self.internal.select("repo"))
        return limitations(self.files, self.entrypoints, known, self.max_files)


def profile_trees(files: DataFrame, max_files: int | None = None) -> Profile:
    """Profile of every repository in ``files``, which is staged once and read by column."""
    return Profile(files, max_files)


def batch_summary(files: DataFrame, roots: DataFrame, groups: DataFrame) -> DataFrame:
    """Per repository: files, source files, and whether roots and groups were found."""
    seen = featured(files).groupBy("repo").agg(
        F.count("*").alias("total_files_seen"), F.count_if(is_source()).alias("source_files_seen")
    )
    r = roots.groupBy("repo").agg(F.count("*").alias("roots"))
    g = groups.groupBy("repo").agg(F.count("*").alias("groups"))
    out = seen.join(r, "repo", "left").join(g, "repo", "left").na.fill(0)
    return out.withColumn("valid", (F.col("roots") > 0) & (F.col("groups") > 0))


def claim_findings(claims: DataFrame, evidence: DataFrame, required: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Claims with an empty required field or without evidence."""
    gaps = F.array_compact(
        F.array(*[F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) == "", F.lit("missing " + c)) for c in required])
    )
    empty = claims.select(*key, F.explode(gaps).alias("reason"))
    bare = claims.join(evidence.select(*key).distinct(), list(key), "left_anti").select(*key, F.lit("missing evidence").alias("reason"))
    return empty.unionByName(bare)


# --- dangling references ----------------------------------------------------------


def dangling_references(references: DataFrame, files: DataFrame) -> DataFrame:
    """References that name neither a file nor a directory of their repository.

    ``references(doc, repo, reference)``; a line suffix (``:41-45``) and trailing slashes
    do not count. Distinct references are checked once.
    """
    clean = F.regexp_replace(F.split_part("reference", F.lit(":"), F.lit(1)), "/+$", "")
    asked = references.withColumn("target", clean)
    paths = path_features(files.select("repo", "path"))
    every = F.expr("explode(transform(sequence(1, n_parts), i -> array_join(slice(parts, 1, i), '/')))")
    known = paths.select("repo", every.alias("target")).distinct()
    lost = asked.select("repo", "target").distinct().join(known, ["repo", "target"], "left_anti")
    return asked.join(lost, ["repo", "target"]).select("doc", "repo", "reference")


def dangling_severity(missing: DataFrame) -> DataFrame:
    """One row: missing references, and medium below ten, else high."""
    n = F.col("missing")
    return missing.agg(F.count("*").alias("missing")).withColumn(
        "severity", F.when(n == 0, F.lit(None).cast("string")).when(n < 10, "medium").otherwise("high")
    )
