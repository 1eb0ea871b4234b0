"""Column expressions kept as SQL text.

Extraction needs thousands of nested calls per section. Built with the column API each
call is a round trip to the JVM; written as text, one ``expr`` parses a whole section.
Function names are Spark SQL's own; plain Python values become literals.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

_names = itertools.count()


class Sql:
    """An expression as text with the usual operators."""

    __slots__ = ("text", "name")

    def __init__(self, text: str, name: str | None = None):
        self.text, self.name = text, name

    def column(self) -> Column:
        return F.expr(self.text)

    def alias(self, name: str) -> Sql:
        return Sql(self.text, name)

    def __getitem__(self, field: str) -> Sql:
        return Sql(f"{self.text}.{field}")

    def _op(self, sign: str, other) -> Sql:
        # Operators are written as calls: nested parentheses make the parser look far ahead.
        return Sql(f"`{sign}`({self.text}, {_text(other)})")

    def __eq__(self, other) -> Sql:
        return self._op("=", other)

    def __ne__(self, other) -> Sql:
        return ~self._op("=", other)

    def __lt__(self, other) -> Sql:
        return self._op("<", other)

    def __le__(self, other) -> Sql:
        return self._op("<=", other)

    def __gt__(self, other) -> Sql:
        return self._op(">", other)

    def __and__(self, other) -> Sql:
        return self._op("and", other)

    def __or__(self, other) -> Sql:
        return self._op("or", other)

    def __add__(self, other) -> Sql:
        return self._op("+", other)

    def __sub__(self, other) -> Sql:
        return self._op("-", other)

    def __invert__(self) -> Sql:
        return Sql(f"`not`({self.text})")

    __hash__ = None

    def isNull(self) -> Sql:
        return Sql(f"isnull({self.text})")

    def isNotNull(self) -> Sql:
        return Sql(f"isnotnull({self.text})")

    def isin(self, *values) -> Sql:
        listed = values[0] if len(values) == 1 and isinstance(values[0], list) else values
        return Sql(f"`in`({self.text}, {', '.join(_text(v) for v in listed)})")

    def between(self, low, high) -> Sql:
        return self._op(">=", low) & self._op("<=", high)

    def rlike(self, pattern: str) -> Sql:
        return self._op("rlike", pattern)

    def cast(self, kind: str) -> Sql:
        return Sql(f"CAST({self.text} AS {kind})")

    def try_cast(self, kind: str) -> Sql:
        return Sql(f"TRY_CAST({self.text} AS {kind})")


class Case(Sql):
    """``CASE`` under construction."""

    __slots__ = ("arms",)

    def __init__(self, arms: list[str]):
        self.arms = arms
        super().__init__("CASE " + " ".join(arms) + " END")

    def when(self, condition: Sql, value) -> Case:
        return Case([*self.arms, f"WHEN {_text(condition)} THEN {_text(value)}"])

    def otherwise(self, value) -> Sql:
        return Sql(f"CASE {' '.join(self.arms)} ELSE {_text(value)} END")


def _text(value) -> str:
    if isinstance(value, Sql):
        return value.text
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return repr(value)


def literal(value) -> str:
    """A Python value as SQL literal text."""
    return _text(value)


def col(name: str) -> Sql:
    return Sql(name)


def lit(value) -> Sql:
    return Sql(_text(value))


def when(condition: Sql, value) -> Case:
    return Case([f"WHEN {_text(condition)} THEN {_text(value)}"])


def struct(*fields: Sql) -> Sql:
    return Sql("named_struct(" + ", ".join(f"'{f.name}', {f.text}" for f in fields) + ")")


def _lambda(fn) -> str:
    """``x -> …`` or ``(x, i) -> …`` with names of their own."""
    names = [f"x{next(_names)}" for _ in range(fn.__code__.co_argcount)]
    head = names[0] if len(names) == 1 else f"({', '.join(names)})"
    return f"{head} -> {_text(fn(*[Sql(n) for n in names]))}"


def transform(values: Sql, fn) -> Sql:
    return Sql(f"transform({_text(values)}, {_lambda(fn)})")


def filter(values: Sql, fn) -> Sql:  # noqa: A001 (Spark's name)
    return Sql(f"filter({_text(values)}, {_lambda(fn)})")


def __getattr__(name: str):
    if name.startswith("__"):
        raise AttributeError(name)
    return lambda *args: Sql(f"{name}({', '.join(_text(a) for a in args)})")
