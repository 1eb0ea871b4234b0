"""Text functions for SQL users, as Spark SQL functions (S3)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from factgraph.functions import sqlexpr as S
from factgraph.functions.variants import compact_ws, is_cli_line, is_path, is_route, trim_ws


def register_sql_functions(spark: SparkSession) -> None:
    """Create temporary functions; Spark inlines their bodies into the query plan."""
    word = S.col("t")
    folded = S.replace(S.lower(word), "ß", "ss")
    bodies = {
        "ascii_fold": ("STRING", S.translate(word, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")),
        "fold_text": ("STRING", folded),
        "norm_term": ("STRING", S.trim(S.regexp_replace(folded, "[^0-9a-z]+", " "))),
        "compact_text": ("STRING", compact_ws(word)),
        "is_path_text": ("BOOLEAN", is_path(trim_ws(word))),
        "is_cli_text": ("BOOLEAN", is_cli_line(trim_ws(word))),
        "is_route_text": ("BOOLEAN", is_route(trim_ws(word))),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS {kind} RETURN {body.text}")
