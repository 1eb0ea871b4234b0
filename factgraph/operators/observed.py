"""Gates that Spark observes while a table is written.

A gate over the rows of one table needs no scan of its own: its condition is an aggregate
that the write computes as the rows pass. Gates that compare keys across rows or tables
stay queries; counts of several tables are compared here, on the driver, as single values.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from factgraph.operators.gates import Rule
from factgraph.session import staged


def none_of(condition: Column) -> Column:
    """Holds when no row meets the condition."""
    return F.count_if(F.coalesce(condition, F.lit(False))) == 0


def none_broken(rules: list[Rule]) -> Column:
    """Holds when no row breaks a rule."""
    return none_of(reduce(Column.__or__, [F.coalesce(condition, F.lit(False)) for _, _, condition, _ in rules]))


class Watch:
    """Named gates and counts, each observed in the write of one table."""

    def __init__(self) -> None:
        self.values: dict[str, object] = {}
        self.gates: dict[str, bool] = {}

    def staged(self, df: DataFrame, counts: dict[str, Column] | None = None, **gates: Column) -> DataFrame:
        """``df`` written to the shared folder and read again. ``gates`` are boolean aggregates
        over its rows; on a table without rows they hold. ``counts`` are numbers kept for later."""
        seen = Observation(f"watch-{uuid.uuid4().hex}")
        counts = counts or {}
        out = staged(df.observe(seen, *[c.alias(n) for n, c in {**gates, **counts}.items()]))
        found = seen.get
        self.gates |= {n: found.get(n) is not False for n in gates}
        self.values |= {n: found.get(n) or 0 for n in counts}
        return out

    def holds(self, gate: str, passed: bool) -> None:
        self.gates[gate] = bool(passed)

    def results(self, spark: SparkSession, others: DataFrame | None = None) -> DataFrame:
        """``gate, passed`` of all gates, and of ``others``."""
        rows = spark.createDataFrame(list(self.gates.items()), "gate string, passed boolean")
        return rows if others is None else rows.unionByName(others)
