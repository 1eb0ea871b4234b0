"""Text and time expressions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from factgraph.functions import text


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "t string").select(column("t")).head()[0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize(
    ("value", "want"),
    [
        ("2024-03-05", "2024-03-05T00:00:00Z"),
        (" 2024-03-05T10:20:30Z ", "2024-03-05T10:20:30Z"),
        ("2024-03-05T10:20", "2024-03-05T10:20:00Z"),
        ("2024-03-05 10:20:30.5", "2024-03-05T10:20:30Z"),
        ("2024-03-05T10:20:30+02:00", "2024-03-05T08:20:30Z"),
        ("2024-03-05T10:20:30-0130", "2024-03-05T11:50:30Z"),
        ("2024-13-05", None),
        ("2024", None),
        ("soon", None),
        ("", None),
    ],
)
def test_times_do_not_depend_on_the_session_zone(spark, zone, value, want):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, lambda c: text.iso_seconds(text.parse_as_of(c)), value) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_trimming_and_terms(spark):
    assert one(spark, text.trim_ws, " \t a b \n") == "a b"
    assert one(spark, text.norm_term, "  Große--Straße 1 ") == text.py_norm_term("  Große--Straße 1 ") == "grosse strasse 1"
    assert one(spark, text.text_lines, "a  b\r\n```bash\n| x | y |\n|--:|\n\n| open c") == ["a b", "| open", "c"]
    assert one(spark, text.label_of, "external_tool::a::b") == "a::b" and one(spark, text.label_of, "plain") == "plain"


@pytest.mark.parametrize(("part", "whole", "want"), [(1, 32, 0.0312), (3, 32, 0.0938), (0, 0, 0.0)])
def test_fractions_round_half_to_even(spark, part, whole, want):
    assert spark.range(1).select(text.fraction(F.lit(part), F.lit(whole))).head()[0] == want


def test_small_files_of_many_rows_are_dealt(spark, tmp_path):
    """One small file made one task of all extraction, however many documents came of it."""
    from factgraph.plans import document_queries
    from factgraph.session import spread

    cols = "id AS p_partkey", "concat('n', id) AS p_name", "'B' AS p_brand", "'T' AS p_type", "CAST(id % 50 AS INT) AS p_size"
    spark.range(9000).selectExpr(*cols).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    docs = document_queries.documents(spark, str(tmp_path))
    sizes = docs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) >= 8 and max(r["count"] for r in sizes) <= 2 * 9000 / len(sizes)
    assert docs.select("node_id").distinct().count() == 9000
    assert spread(spark.range(0)).count() == 0
    assert spread(spark.range(9000), 1000).rdd.getNumPartitions() >= 9


def test_texts_are_written_once():
    """Nested first texts doubled the expression at every level."""
    from factgraph.functions import sqlexpr as S
    from factgraph.functions.variants import first_text
    from factgraph.operators.extract import either, labelled

    v = S.col("mark")
    assert either(either(first_text(v, "a", "b"), S.lit("x")), S.lit("y")).text.count("mark") == 2
    assert labelled("l", first_text(v, "a")).text.count("mark") == 1
