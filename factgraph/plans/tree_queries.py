"""Structural profiling and path analytics over trees that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from factgraph.operators import aggregates, gates, profile
from factgraph.operators.profile import (
    BOUNDARY,
    CONFIG_KINDS,
    EXTERNAL,
    GENERIC,
    LANGUAGES,
    MANIFEST_KINDS,
    NOISE,
    RUNTIME,
    SUPPORT,
)
from factgraph.plans import bindings as b
from factgraph.plans.registry import query
from factgraph.session import staged

# --- trees ------------------------------------------------------------------------

# Path and content of a file by line number; marks as in the document templates.
_TREE = [
    ("src/{type}/main.py", "import os\nfrom src.{type} import core\nimport {type}.extra\n"),
    ("cmd/tool{size}/main.go", 'package main\nimport (\n "fmt"\n "example.org/x/cmd"\n)\n'),
    ("packages/{slug}/package.json", '{{"main": "dist/index.js", "bin": {{"{slug}": "bin/cli.ts"}}, "dependencies": {{"{type}": "1", "jest": "2"}}}}'),
    ("web/app/page{size}.tsx", "import x from '@web/lib/{type}'\nimport y from './near'\n"),
    ("tests/{type}/test_{size}.py", "import pytest\n"),
    ("internal/service/{type}{size}.go", 'package s\nimport "example.org/x/internal"\n'),
    ("requirements-{type}.txt", "# pins\n{type}>=1\npytest==2\n-r other.txt\n{slug}[extra]~=3\n"),
]


def trees(spark, sf):
    """One repository per supplier; each order line gives one of seven kinds of file."""
    parts = b.table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size")
    lines = b.table(spark, sf, "lineitem").select("l_suppkey", "l_partkey", "l_linenumber")
    rows = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    marks = {"{type}": F.lower("p_type"), "{slug}": F.replace("p_name", F.lit(" "), F.lit("-")), "{size}": F.col("p_size").cast("string")}

    def filled(texts):
        out = F.get(F.array(*[F.lit(t) for t in texts]), F.col("l_linenumber") - 1)
        for mark, value in marks.items():
            out = F.replace(out, F.lit(mark), value)
        return out

    content = filled([c.replace("{{", "{").replace("}}", "}") for _, c in _TREE])
    files = rows.select(F.concat(F.lit("r"), "l_suppkey").alias("repo"), filled([p for p, _ in _TREE]).alias("path"), content.alias("content"))
    return files.groupBy("repo", "path").agg(F.min("content").alias("content")).withColumn("size", F.length("content").cast("bigint"))


TREE_SQL = """
files AS (
  SELECT DISTINCT 'r' || l_suppkey AS repo, l_linenumber AS n, CASE l_linenumber
    WHEN 1 THEN 'src/' || lower(p_type) || '/main.py' WHEN 2 THEN 'cmd/tool' || p_size || '/main.go'
    WHEN 3 THEN 'packages/' || replace(p_name, ' ', '-') || '/package.json' WHEN 4 THEN 'web/app/page' || p_size || '.tsx'
    WHEN 5 THEN 'tests/' || lower(p_type) || '/test_' || p_size || '.py'
    WHEN 6 THEN 'internal/service/' || lower(p_type) || p_size || '.go'
    WHEN 7 THEN 'requirements-' || lower(p_type) || '.txt' END AS path
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def _values(table):
    return "(VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in table.items()) + ")"


def _listed(words):
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def features_sql(source: str, path: str = "path") -> str:
    """Parts, tokens and labels of a path column."""
    return f"""
feat0 AS (SELECT *, list_filter(string_split({path}, '/'), lambda p: p <> '') AS parts FROM {source}),
feat AS (
  SELECT *, len(parts) AS n_parts, parts[len(parts)] AS name,
    list_filter(flatten(list_transform(parts, lambda p: regexp_split_to_array(lower(p), '[^a-z0-9]+'))), lambda w: w <> '') AS tokens,
    list_filter(list_transform(parts, lambda p: trim(regexp_replace(lower(p), '[^a-z0-9]+', '_', 'g'), '_')), lambda w: w <> '') AS labels
  FROM feat0)"""


def orientation_sql(prefer_runtime: bool) -> str:
    r, c = (4, 2) if prefer_runtime else (3, 3)

    def count(column, words):
        return f"len(list_filter({column}, lambda w: w IN {_listed(words)}))"

    return (
        f"{r} * {count('tokens', RUNTIME)} + {c} * {count('tokens', BOUNDARY)} - 6 * {count('labels', NOISE)}"
        f" - 3 * {count('labels', SUPPORT)} + CASE WHEN n_parts <= 2 THEN 3 WHEN n_parts = 3 THEN 1 ELSE -least(n_parts - 1, 4) END"
        " + CASE WHEN lower(name) LIKE 'readme%' THEN 2 ELSE 0 END"
    )


# --- signals and scores -----------------------------------------------------------


@query(
    "manifest_signals",
    "WITH " + TREE_SQL + ", " + features_sql("files")
    + f"""
SELECT repo, path, coalesce(k.kind, CASE WHEN name LIKE 'requirements%.txt' THEN 'python_requirements' END) AS kind
FROM feat LEFT JOIN {_values(MANIFEST_KINDS)} k(fname, kind) ON name = fname
WHERE k.kind IS NOT NULL OR name LIKE 'requirements%.txt'""",
)
def manifest_signals(spark, sf):
    return profile.manifest_signals(trees(spark, sf)).drop("walk")


@query(
    "config_signals",
    f"""
WITH paths AS (
  SELECT 'r' || s_suppkey AS repo, CASE s_suppkey % 4 WHEN 0 THEN 'deploy/' || n_name || '/compose.yml'
    WHEN 1 THEN '.github/workflows/' || n_name || '.yml' WHEN 2 THEN n_name || '/prod.env.sample' ELSE n_name || '.md' END AS path
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT repo, path, CASE WHEN path LIKE '.github/workflows/%' THEN 'ci_workflow' WHEN path LIKE '%.env.sample' THEN 'env_example'
       ELSE (SELECT kind FROM {_values(CONFIG_KINDS)} k(f, kind) WHERE f = string_split(path, '/')[-1]) END AS kind
FROM paths WHERE path NOT LIKE '%.md'""",
)
def config_signals(spark, sf):
    way, nation = F.col("s_suppkey") % 4, F.col("n_name")
    path = (
        F.when(way == 0, F.concat(F.lit("deploy/"), nation, F.lit("/compose.yml")))
        .when(way == 1, F.concat(F.lit(".github/workflows/"), nation, F.lit(".yml")))
        .when(way == 2, F.concat(nation, F.lit("/prod.env.sample"))).otherwise(F.concat(nation, F.lit(".md")))
    )
    rows = b.table(spark, sf, "supplier").join(b.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return profile.config_signals(rows.select(F.concat(F.lit("r"), "s_suppkey").alias("repo"), path.alias("path"))).drop("walk")


@query(
    "tree_languages",
    "WITH " + TREE_SQL
    + f""",
lang AS (
  SELECT repo, language, count(*) AS n FROM files JOIN {_values(LANGUAGES)} l(ext, language)
    ON ext = regexp_extract(path, '(\\.[^./]+)$', 1) GROUP BY 1, 2
  UNION ALL SELECT DISTINCT repo, 'python', 1 FROM files WHERE n = 7
  UNION ALL SELECT DISTINCT repo, 'typescript', 1 FROM files WHERE n = 3),
total AS (SELECT repo, language, sum(n)::BIGINT AS files FROM lang GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY repo ORDER BY files DESC, language) AS rank FROM total""",
)
def tree_languages(spark, sf):
    files = trees(spark, sf)
    return profile.languages(files, profile.manifest_signals(files))


@query(
    "subtree_counts",
    "WITH " + TREE_SQL
    + """,
src AS (SELECT repo, string_split(path, '/') AS parts FROM files WHERE n NOT IN (3, 7))
SELECT repo, array_to_string(parts[1:i], '/') AS dir, count(*) AS files
FROM (SELECT repo, parts, unnest(range(1, len(parts))) AS i FROM src) GROUP BY 1, 2""",
)
def subtree_counts(spark, sf):
    return profile.source_dir_counts(trees(spark, sf))


def url_paths(spark, sf):
    """Host and path of every page address, without query and fragment."""
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    path = F.regexp_replace(F.regexp_extract("url", r"^https?://[^/?#]+([^?#]*)", 1), "^/+|/+$", "")
    return b.table(spark, sf, "pages").select("page_id", host.alias("repo"), path.alias("path"))


URLS_SQL = r"""
urls AS (
  SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS repo,
         regexp_replace(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '^/+|/+$', '', 'g') AS path FROM pages)"""


@query(
    "url_subtree_counts",
    "WITH " + URLS_SQL
    + """
SELECT repo, array_to_string(parts[1:i], '/') AS dir, count(*) AS files FROM (
  SELECT repo, string_split(path, '/') AS parts, unnest(range(1, len(string_split(path, '/')))) AS i FROM urls) GROUP BY 1, 2""",
)
def url_subtree_counts(spark, sf):
    return aggregates.subtree_counts(url_paths(spark, sf), ["repo"])


@query(
    "path_scores",
    "WITH " + TREE_SQL + ", " + features_sql("files")
    + f"""
SELECT repo, path, {orientation_sql(False)} AS structure_score, {orientation_sql(True)} AS runtime_score,
       len(list_filter(labels, lambda w: w IN {_listed(NOISE)})) > 0 AS noisy FROM feat""",
)
def path_scores(spark, sf):
    rows = profile.path_features(trees(spark, sf).select("repo", "path"))
    return rows.select(
        "repo", "path", profile.orientation_score(False).alias("structure_score"),
        profile.orientation_score(True).alias("runtime_score"), profile.has_noise_label().alias("noisy"),
    )


@query(
    "entrypoint_scores",
    "WITH " + TREE_SQL
    + """,
sizes AS (SELECT repo, array_to_string(string_split(path, '/')[:-2], '/') AS dir, count(*) AS below FROM files
          WHERE n NOT IN (3, 7) GROUP BY 1, 2)
SELECT repo, path, CASE n WHEN 1 THEN 'app_entry' ELSE 'cli_entry' END AS kind,
  CASE n WHEN 1 THEN 'filename heuristic' ELSE 'cmd main convention' END AS note,
  CASE n WHEN 1 THEN 7 + 1 ELSE 12 + 4 + 1 - (CASE WHEN below <= 2 THEN 4 ELSE 0 END) END
    + CASE WHEN below >= 3 THEN least(below, 18) // 2 ELSE 0 END AS score
FROM files JOIN sizes USING (repo)
WHERE n IN (1, 2) AND dir = array_to_string(string_split(path, '/')[:-2], '/')""",
)
def entrypoint_scores(spark, sf):
    files = trees(spark, sf)
    return profile.entrypoint_scores(files, profile.source_dir_counts(files))


@query(
    "requirement_packages",
    """
SELECT 'r' || l_suppkey AS repo, 'requirements-' || lower(p_type) || '.txt' AS path,
  lower(p_type) || '; pytest; ' || min(replace(p_name, ' ', '-')) AS packages
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber = 7
GROUP BY l_suppkey, p_type""",
)
def requirement_packages(spark, sf):
    files = trees(spark, sf).filter("path LIKE 'requirements%'")
    return files.select("repo", "path", F.array_join(profile.requirement_names(F.col("content")), "; ").alias("packages"))


@query(
    "import_counts",
    "WITH " + TREE_SQL
    + """,
imports AS (
  SELECT repo, 'src.' || regexp_extract(path, '^src/([a-z]+)/', 1) AS module FROM files WHERE n = 1
  UNION ALL SELECT repo, 'x/cmd' FROM files WHERE n = 2 UNION ALL SELECT repo, 'x/internal' FROM files WHERE n = 6)
SELECT repo, module, count(*) AS imports FROM imports GROUP BY 1, 2""",
)
def import_counts(spark, sf):
    files = staged(trees(spark, sf))
    roots = profile.package_roots(files, profile.tree_signals(files)).roots
    return profile.internal_imports(files, roots, max_files=None)


# --- whole profiles ---------------------------------------------------------------


# The folders of the seven kinds of file that may be roots, each with its best reason.
ROOTS_SQL = (
    "WITH "
    + TREE_SQL
    + """,
cand AS (
  SELECT repo, 'packages/' || string_split(path, '/')[2] AS path, 12 AS bonus FROM files WHERE n = 3
  UNION ALL SELECT repo, '.', 12 FROM files WHERE n = 7
  UNION ALL SELECT repo, string_split(path, '/')[1], 6 FROM files WHERE n IN (1, 2, 3, 6)),
best AS (SELECT repo, path, max(bonus) AS bonus FROM cand GROUP BY 1, 2),
"""
    + features_sql("best")
    + f""",
scored AS (SELECT repo, path, CASE WHEN path = '.' THEN 18 ELSE bonus + {orientation_sql(False)} END AS score FROM feat),
caps AS (SELECT repo, greatest(8, 8 + count(*) FILTER (WHERE path LIKE 'packages/%')) AS cap FROM best GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY score DESC, path) AS rank FROM scored),
bare AS (SELECT DISTINCT repo FROM files WHERE repo NOT IN (SELECT repo FROM best)),
roots AS (
  SELECT repo, path, score, rank FROM ranked JOIN caps USING (repo) WHERE rank <= cap UNION ALL SELECT repo, '.', 0, 1 FROM bare)"""
)


@query("package_roots", ROOTS_SQL + " SELECT repo, path, score, rank FROM roots")
def package_roots(spark, sf):
    files = staged(trees(spark, sf))
    return profile.package_roots(files, profile.tree_signals(files)).roots


@query(
    "tree_entrypoints",
    "WITH " + TREE_SQL
    + """,
sizes AS (SELECT repo, array_to_string(string_split(path, '/')[:-2], '/') AS dir, count(*) AS below FROM files
          WHERE n NOT IN (3, 7) GROUP BY 1, 2),
scored AS (
  SELECT repo, path, CASE n WHEN 1 THEN 'app_entry' ELSE 'cli_entry' END AS kind,
    CASE n WHEN 1 THEN 'filename heuristic' ELSE 'cmd main convention' END AS note,
    CASE n WHEN 1 THEN 7 + 1 ELSE 12 + 4 + 1 - (CASE WHEN below <= 2 THEN 4 ELSE 0 END) END
      + CASE WHEN below >= 3 THEN least(below, 18) // 2 ELSE 0 END AS score
  FROM files JOIN sizes USING (repo) WHERE n IN (1, 2) AND dir = array_to_string(string_split(path, '/')[:-2], '/'))
SELECT repo, path, kind, note, score, CASE WHEN score >= 6 THEN 'high' ELSE 'medium' END AS confidence,
  row_number() OVER (PARTITION BY repo ORDER BY score DESC, path) AS rank
FROM scored WHERE score >= 4 QUALIFY rank <= 8""",
)
def tree_entrypoints(spark, sf):
    files = staged(trees(spark, sf))
    return profile.entrypoints(files, profile.tree_signals(files))


def _named(sql, mark):
    """The same tables under names of their own."""
    return sql.replace("feat0", mark + "0").replace("feat ", mark + " ")


GROUPS_SQL = (
    ROOTS_SQL
    + """,
dirs AS (
  SELECT repo, CASE WHEN n IN (1, 2, 6) THEN array_to_string(string_split(path, '/')[1:2], '/') ELSE string_split(path, '/')[1] END AS path, count(*) AS files
  FROM files WHERE n NOT IN (3, 7) GROUP BY 1, 2),
places AS (
  SELECT repo, path, 0 AS origin, 10 AS worth FROM roots WHERE path <> '.'
  UNION ALL SELECT repo, path, 1, files FROM dirs WHERE files >= 2 AND path <> 'tests'),
"""
    + _named(features_sql("places"), "placed")
    + f""",
members AS (SELECT repo, path, origin, translate(name, '-.', '__') AS name, worth + {orientation_sql(False)} AS score FROM placed),
merged AS (
  SELECT repo, name, max(score) AS score, min(path) AS first_path, count(DISTINCT path) AS path_count, min(origin) AS origin FROM members GROUP BY 1, 2),
room AS (SELECT repo, greatest(8, count(*)) AS cap FROM roots GROUP BY 1),
chosen AS (
  SELECT repo, name, score, first_path, path_count,
    CASE WHEN path_count > 1 THEN 'merged related package roots with the same module label'
      WHEN origin = 0 THEN 'package root or workspace module boundary' ELSE 'directory grouping with repeated source files' END AS rationale,
    CASE WHEN path_count > 1 THEN 'high' ELSE 'medium' END AS confidence,
    row_number() OVER (PARTITION BY repo ORDER BY score DESC, name) AS rank
  FROM merged),
groups AS (SELECT chosen.* FROM chosen JOIN room USING (repo) WHERE rank <= cap
  UNION ALL SELECT repo, 'repo_root', 0, '.', 1, 'fallback structural grouping from package root', 'medium', 1 FROM roots
  WHERE rank = 1 AND repo NOT IN (SELECT repo FROM merged))"""
)


@query("module_groups", GROUPS_SQL + " SELECT repo, name, score, first_path, path_count, rationale, confidence, rank FROM groups")
def module_groups(spark, sf):
    files = staged(trees(spark, sf))
    signals = profile.tree_signals(files)
    return profile.module_groups(files, profile.package_roots(files, signals), signals).groups


@query(
    "tree_external_packages",
    GROUPS_SQL
    + """,
texts AS (
  SELECT 'r' || l_suppkey AS repo, l_linenumber AS n, min(lower(p_type)) AS kind, min(replace(p_name, ' ', '-')) AS slug,
    CASE l_linenumber WHEN 3 THEN 'packages/' || replace(p_name, ' ', '-') || '/package.json' ELSE 'requirements-' || lower(p_type) || '.txt' END AS path
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber IN (3, 7) GROUP BY 1, 2, path),
lists AS (SELECT *, CASE n WHEN 3 THEN 'packages/' || string_split(path, '/')[2] ELSE '.' END AS dir FROM texts),
"""
    + _named(features_sql("lists", "dir"), "listed")
    + f""",
hits AS (
  SELECT repo, count(*) AS hits FROM groups JOIN (SELECT DISTINCT repo, name, path FROM members) USING (repo, name)
  WHERE rank <= 4 AND string_split(path, '/')[1] = 'packages' GROUP BY 1),
worth AS (
  SELECT listed.*, 12 + {orientation_sql(False)} + CASE n WHEN 3 THEN 2 + 2 * coalesce(hits, 0) ELSE 0 END AS worth FROM listed LEFT JOIN hits USING (repo)),
weighed AS (SELECT repo, n, kind, slug, greatest(9 - row_number() OVER (PARTITION BY repo ORDER BY worth DESC, path), 1) AS weight FROM worth),
packs AS (SELECT repo, kind AS package, weight FROM weighed UNION ALL SELECT repo, slug, weight FROM weighed WHERE n = 7)
SELECT repo, package, sum(weight)::BIGINT AS weight, row_number() OVER (PARTITION BY repo ORDER BY sum(weight) DESC, package) AS rank
FROM packs GROUP BY repo, package QUALIFY rank <= {EXTERNAL}""",
)
def tree_external_packages(spark, sf):
    return profile.profile_trees(trees(spark, sf)).external


@query(
    "tree_first_reads",
    GROUPS_SQL
    + """,
sizes AS (SELECT repo, array_to_string(string_split(path, '/')[:-2], '/') AS dir, count(*) AS below FROM files
          WHERE n NOT IN (3, 7) GROUP BY 1, 2),
starts AS (
  SELECT repo, path, row_number() OVER (PARTITION BY repo ORDER BY
    CASE n WHEN 1 THEN 7 + 1 ELSE 12 + 4 + 1 - (CASE WHEN below <= 2 THEN 4 ELSE 0 END) END
    + CASE WHEN below >= 3 THEN least(below, 18) // 2 ELSE 0 END DESC, path) AS turn
  FROM files JOIN sizes USING (repo) WHERE n IN (1, 2) AND dir = array_to_string(string_split(path, '/')[:-2], '/') QUALIFY turn <= 8),
shape AS (
  SELECT repo, coalesce(e, 0) >= 6 AND coalesce(g, 0) >= 5 AS broad
  FROM (SELECT repo, count(*) AS e FROM starts GROUP BY 1) FULL JOIN (SELECT repo, count(*) AS g FROM groups GROUP BY 1) USING (repo)),
pages AS (SELECT repo, count(*) AS pages FROM files WHERE n = 4 GROUP BY 1),
heads AS (SELECT repo, name AS grp, first_path AS path, confidence, pages FROM groups LEFT JOIN pages USING (repo)),
"""
    + _named(features_sql("heads"), "headed")
    + f""",
fits AS (
  SELECT repo, grp, path, {orientation_sql(False)}
    + CASE WHEN path = 'web' AND pages >= 8 THEN 9 + CASE WHEN pages >= 100 THEN 4 WHEN pages >= 30 THEN 2 ELSE 0 END ELSE 0 END
    + CASE WHEN n_parts >= 2 THEN 4 ELSE 0 END + CASE WHEN len(list_filter(labels, lambda w: w IN {_listed(GENERIC)})) = 0 THEN 5 ELSE 0 END
    - 4 * len(list_filter(labels, lambda w: w IN {_listed(GENERIC)})) + CASE WHEN confidence = 'high' THEN 1 ELSE 0 END AS fit FROM headed),
heading AS (SELECT repo, grp, row_number() OVER (PARTITION BY repo ORDER BY fit DESC, path) AS turn FROM fits QUALIFY turn <= 3),
inside AS (
  SELECT repo, name AS grp, path, row_number() OVER (PARTITION BY repo, name ORDER BY path) AS sub FROM (SELECT DISTINCT repo, name, path FROM members) QUALIFY sub <= 6),
reads AS (
  SELECT repo, path, broad, CASE WHEN turn <= CASE WHEN broad THEN 2 ELSE 3 END THEN 0 WHEN broad THEN 3 END AS stage, turn, 0 AS sub FROM starts JOIN shape USING (repo)
  UNION ALL SELECT repo, inside.path, broad, 2, CASE WHEN broad THEN heading.turn WHEN g.rank <= 3 THEN g.rank END, sub
    FROM inside JOIN (SELECT repo, name AS grp, rank FROM groups) g USING (repo, grp) JOIN shape USING (repo) LEFT JOIN heading USING (repo, grp)),
early AS (
  SELECT repo, path, 0 AS stage, row_number() OVER (PARTITION BY repo ORDER BY o, path) AS turn, 0 AS sub
  FROM (SELECT repo, path, min(struct_pack(stage := stage, turn := turn, sub := sub)) AS o FROM reads WHERE broad AND stage < 3 AND turn IS NOT NULL GROUP BY 1, 2)
  QUALIFY turn <= 5),
every AS (
  SELECT repo, path, min(struct_pack(stage := stage, turn := turn, sub := sub)) AS o
  FROM (SELECT * FROM early UNION ALL SELECT repo, path, stage, turn, sub FROM reads WHERE stage IS NOT NULL AND turn IS NOT NULL AND (NOT broad OR stage = 3))
  GROUP BY 1, 2)
SELECT repo, path, row_number() OVER (PARTITION BY repo ORDER BY o, path) AS rank FROM every QUALIFY rank <= 6""",
)
def tree_first_reads(spark, sf):
    return profile.profile_trees(trees(spark, sf)).first_reads


@query(
    "tree_runtime_surfaces",
    GROUPS_SQL
    + """,
sizes AS (SELECT repo, array_to_string(string_split(path, '/')[:-2], '/') AS dir, count(*) AS below FROM files
          WHERE n NOT IN (3, 7) GROUP BY 1, 2),
starts AS (
  SELECT repo, path, row_number() OVER (PARTITION BY repo ORDER BY
    CASE n WHEN 1 THEN 7 + 1 ELSE 12 + 4 + 1 - (CASE WHEN below <= 2 THEN 4 ELSE 0 END) END
    + CASE WHEN below >= 3 THEN least(below, 18) // 2 ELSE 0 END DESC, path) AS turn
  FROM files JOIN sizes USING (repo) WHERE n IN (1, 2) AND dir = array_to_string(string_split(path, '/')[:-2], '/')),
below AS (
  SELECT repo, array_to_string(string_split(path, '/')[1:i], '/') AS path, count(*) AS files
  FROM files, (SELECT unnest(range(1, 6)) AS i) WHERE n NOT IN (3, 7) AND i < len(string_split(path, '/')) GROUP BY 1, 2),
heads AS (SELECT repo, first_path AS path, rank FROM groups WHERE rank <= 3),
"""
    + _named(features_sql("heads"), "headed")
    + f""",
surfaces AS (
  SELECT repo, path, 0 AS stage, turn FROM starts WHERE turn <= 4
  UNION ALL SELECT repo, path, 2, rank FROM headed JOIN below USING (repo, path)
    WHERE below.files >= 20 AND len(list_filter(tokens, lambda w: w IN {_listed(RUNTIME)})) > 0),
firsts AS (SELECT repo, path, min(struct_pack(stage := stage, turn := turn)) AS o FROM surfaces GROUP BY 1, 2)
SELECT repo, path, row_number() OVER (PARTITION BY repo ORDER BY o, path) AS rank FROM firsts QUALIFY rank <= 6""",
)
def tree_runtime_surfaces(spark, sf):
    return profile.profile_trees(trees(spark, sf)).surfaces


@query(
    "tree_summary",
    "WITH " + TREE_SQL
    + """
SELECT repo, count(*) AS total_files_seen, count(*) FILTER (WHERE n NOT IN (3, 7)) AS source_files_seen FROM files GROUP BY 1""",
)
def tree_summary(spark, sf):
    files = staged(trees(spark, sf))
    signals = profile.tree_signals(files)
    roots = profile.package_roots(files, signals)
    groups = profile.module_groups(files, roots, signals)
    return profile.batch_summary(signals.paths, roots.roots, groups.groups).select("repo", "total_files_seen", "source_files_seen")


@query(
    "profile_summary",
    GROUPS_SQL
    + """
SELECT repo, total_files_seen, source_files_seen, r.n AS roots, coalesce(g.n, 0) AS groups, r.n > 0 AND coalesce(g.n, 0) > 0 AS valid
FROM (SELECT repo, count(*) AS total_files_seen, count(*) FILTER (WHERE files.n NOT IN (3, 7)) AS source_files_seen FROM files GROUP BY 1)
JOIN (SELECT repo, count(*) AS n FROM roots GROUP BY 1) r USING (repo) LEFT JOIN (SELECT repo, count(*) AS n FROM groups GROUP BY 1) g USING (repo)""",
)
def profile_summary(spark, sf):
    """All columns of the summary: files, source files, roots, groups, and whether the profile is whole."""
    files = staged(trees(spark, sf))
    signals = profile.tree_signals(files)
    roots = profile.package_roots(files, signals)
    groups = profile.module_groups(files, roots, signals)
    return profile.batch_summary(signals.paths, roots.roots, groups.groups)


# --- references -------------------------------------------------------------------


@query(
    "href_dangling",
    "WITH " + URLS_SQL
    + r""",
refs AS (
  SELECT DISTINCT page_id AS doc, 'site' AS repo, unnest(regexp_extract_all(html, 'href="/([^"]+)"', 1)) AS reference FROM pages),
known AS (
  SELECT DISTINCT array_to_string(parts[1:i], '/') AS target FROM (
    SELECT string_split(path, '/') AS parts, unnest(range(1, len(string_split(path, '/')) + 1)) AS i FROM urls WHERE path <> ''))
SELECT doc, repo, reference FROM refs
WHERE regexp_replace(string_split(reference, ':')[1], '/+$', '') NOT IN (SELECT target FROM known)""",
)
def href_dangling(spark, sf):
    """Links of all pages that name no path any page has."""
    pages = b.table(spark, sf, "pages")
    refs = pages.select(
        F.col("page_id").alias("doc"), F.lit("site").alias("repo"),
        F.explode(F.regexp_extract_all("html", F.lit('href="/([^"]+)"'), F.lit(1))).alias("reference"),
    ).distinct()
    known = url_paths(spark, sf).filter("path <> ''").select(F.lit("site").alias("repo"), "path")
    return profile.dangling_references(refs, known)


@query(
    "type_default_sample",
    """
WITH docs AS (SELECT DISTINCT l_suppkey FROM lineitem ORDER BY 1 LIMIT 5),
opts AS (
  SELECT DISTINCT l_suppkey AS doc, l_linenumber - 1 AS idx, CASE l_linenumber WHEN 1 THEN 'int' WHEN 2 THEN '' ELSE 'str' END AS type
  FROM lineitem JOIN docs USING (l_suppkey) WHERE l_linenumber <= 3)
SELECT doc, idx, type, type <> '' AS agrees FROM opts""",
)
def type_default_sample(spark, sf):
    number = F.col("l_linenumber")
    options = b.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("doc"), (number - 1).alias("idx"), F.lit("opt").alias("name"),
        F.when(number == 1, "int").when(number == 2, "").otherwise("str").alias("type"),
        F.lit("string").alias("default_kind"), F.lit("x").alias("default_value"),
    ).distinct()
    return gates.type_default_sample(options).select("doc", "idx", "type", "agrees")
