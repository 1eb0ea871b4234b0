"""Keys of documents at any depth, and rules over them.

The index is made of rows: each level of all documents is exploded by a lateral
``variant_explode`` and written, and the next level starts from what is not a leaf. The walk
ends when no document has a further level, so depth has no limit and no document is held in
one cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factgraph.session import broadcast_if_small, staged

# Keys that older documents hold instead of today's, and sections that a
# structural profile must not hold.
LEGACY_KEYS = ["full_name", "repo", "repo_id"]
FORBIDDEN_SECTIONS = ["common_tasks", "failure_modes", "implementation_patterns", "risk_assessment", "troubleshooting"]


def key_paths(documents: DataFrame, name: str = "path", body: str = "body") -> DataFrame:
    """``name, key_path, key, depth, kind`` of every key of every mapping.

    ``key_path`` joins keys by points, with ``[]`` for the elements of a list; ``depth`` counts
    keys from 1; ``kind`` is ``OBJECT``, ``ARRAY``, ``STRING``, ``VOID`` or another type. Null bodies
    have no keys.
    """
    spark = documents.sparkSession
    level = documents.select(
        F.col(name).alias("name"), F.lit("").alias("key_path"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("depth"),
        F.regexp_extract(F.schema_of_variant(body), "^[A-Z]+", 0).alias("kind"), F.col(body).alias("value"),
    )
    found = []
    while True:
        below = spark.sql(
            """SELECT l.name, concat(l.key_path, CASE WHEN c.key IS NULL THEN '[]' WHEN l.key_path = '' THEN c.key ELSE concat('.', c.key) END) AS key_path,
            c.key, l.depth + CASE WHEN c.key IS NULL THEN 0 ELSE 1 END AS depth, regexp_extract(schema_of_variant(c.value), '^[A-Z]+', 0) AS kind, c.value
            FROM {level} AS l, LATERAL variant_explode(l.value) AS c""",
            level=level.filter(F.col("kind").isin("OBJECT", "ARRAY")),
        )
        step = staged(below)
        if step.isEmpty():
            break
        found.append(step)
        level = step
    rows = reduce(DataFrame.unionByName, found) if found else level.limit(0)
    return rows.filter("key IS NOT NULL").select(F.col("name").alias(name), "key_path", "key", "depth", "kind")


def key_findings(keys: DataFrame, rules: DataFrame, name: str = "path") -> DataFrame:
    """``name, rule, key_path, severity`` of keys that a rule forbids.

    ``rules(rule, key, deepest, severity)``; ``deepest`` null forbids the key at any depth.
    """
    table = broadcast_if_small(rules.select("rule", F.col("key").alias("bad_key"), "deepest", "severity"))
    hit = keys.join(table, (F.col("key") == F.col("bad_key")) & (F.col("deepest").isNull() | (F.col("depth") <= F.col("deepest"))))
    return hit.select(name, "rule", "key_path", "severity").distinct()


def key_rules(spark, legacy: Sequence[str] = LEGACY_KEYS, forbidden: Sequence[str] = FORBIDDEN_SECTIONS) -> DataFrame:
    """The rules of the contract: older names and forbidden sections, at the top of a document."""
    rows = [("legacy_key", k, 1, "blocking") for k in legacy] + [("forbidden_section", k, 1, "blocking") for k in forbidden]
    return spark.createDataFrame(rows, "rule string, key string, deepest int, severity string")
