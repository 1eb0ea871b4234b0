"""Small shared steps: bounded per-group lists and per-key choices that stand skew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rn") -> DataFrame:
    """First ``n`` rows per key in ``order``.

    The filter on the row number lets Spark cut every group to ``n`` rows before the
    shuffle, so a hot key sends ``n`` rows per task and not the whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return first_n(df, keys, order, 1, "_rn").drop("_rn")


def listed(df: DataFrame, keys: Sequence[str], value: str, name: str, rank: str = "rn") -> DataFrame:
    """Ordered list per key of rows that ``first_n`` already bounded."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("o"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.transform(pairs, lambda p: p["v"]).alias(name))


def digest_number(col: Column) -> Column:
    """First 60 bits of a SHA-256 as a number, to be summed over a set of rows."""
    return F.conv(F.substring(F.sha2(col, 256), 1, 15), 16, 10).cast("decimal(38,0)")


# A key with more rows than this is joined apart from the others.
HOT_ROWS = 1_000_000


def join_hot_apart(
    rows: DataFrame, keyed: DataFrame, on: Sequence[str], weight: str, threshold: int = HOT_ROWS
) -> DataFrame:
    """Inner join of many rows to one row per key, where some keys hold very many rows.

    ``weight`` is the number of ``rows`` behind a key of ``keyed``. Keys above the
    threshold number at most ``count(rows) / threshold`` and are broadcast, so their
    rows never meet in one task; all other keys take the shuffled join.
    """
    hot = F.broadcast(keyed.filter(F.col(weight) > threshold))
    cold = rows.join(hot.select(*on), list(on), "left_anti").join(keyed.filter(F.col(weight) <= threshold), list(on))
    return rows.join(hot, list(on)).unionByName(cold)
