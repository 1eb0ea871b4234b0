"""Shape-tolerant reads of VARIANT values, and the walk over nested documents.

The readers take and give SQL text expressions, see ``sqlexpr``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from factgraph.functions import sqlexpr as S
from factgraph.functions.classify import CLI_FIRST_WORD_RE, COMMAND_RE, PATH_RE, ROUTE_RE, VERB_RE
from factgraph.functions.sqlexpr import Sql
from factgraph.functions.text import FENCES, LINE_BREAKS, WS


def trim_ws(value: Sql) -> Sql:
    return S.regexp_replace(value, f"^{WS}+|{WS}+$", "")


def compact_ws(value: Sql) -> Sql:
    return S.trim(S.regexp_replace(value, f"{WS}+", " "))


def text_lines(value: Sql) -> Sql:
    lines = S.transform(S.split(value, LINE_BREAKS), compact_ws)
    return S.filter(lines, lambda s: ~(s.isin(FENCES) | s.rlike(r"^\|(.*\|)?$") | s.rlike("^[-|: ]*$")))


def inline_terms(value: Sql) -> Sql:
    return S.filter(S.transform(S.split(value, ","), compact_ws), lambda t: t != "")


# The tests below take trimmed text, which is what the readers and line splitters give.


def is_path(value: Sql) -> Sql:
    return value.rlike(PATH_RE)


def is_command(value: Sql) -> Sql:
    return value.rlike(COMMAND_RE)


def is_cli_line(value: Sql) -> Sql:
    return value.rlike(COMMAND_RE) | (~value.rlike(VERB_RE) & value.rlike(CLI_FIRST_WORD_RE))


def is_route(value: Sql) -> Sql:
    return value.rlike(ROUTE_RE)


def path_or_concept(value: Sql) -> Sql:
    return S.when(is_path(value), "path").otherwise("concept")


def command_or(value: Sql, other: str) -> Sql:
    return S.when(is_command(value), "command").otherwise(other)


def let(value: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return S.get(S.transform(S.array(value), body), S.lit(0))


def _path(key: str) -> str:
    return f"$['{key}']"


def kind_of(v: Sql) -> Sql:
    """``OBJECT``, ``ARRAY``, ``STRING``, ``VOID`` or the number and flag types."""
    return S.regexp_extract(S.schema_of_variant(v), "^[A-Z]+", 0)


def is_object(v: Sql) -> Sql:
    return S.coalesce(S.startswith(S.schema_of_variant(v), S.lit("OBJECT")), S.lit(False))


def is_array(v: Sql) -> Sql:
    return S.coalesce(S.startswith(S.schema_of_variant(v), S.lit("ARRAY")), S.lit(False))


def is_text(v: Sql) -> Sql:
    return S.coalesce(S.schema_of_variant(v) == "STRING", S.lit(False))


def whole_text(v: Sql) -> Sql:
    """The value itself when it is text, trimmed; else the empty string."""
    return S.when(is_text(v), trim_ws(S.try_variant_get(v, "$", "string"))).otherwise(S.lit(""))


def sub(v: Sql, key: str) -> Sql:
    return S.try_variant_get(v, _path(key), "variant")


def text(v: Sql, key: str) -> Sql:
    """Trimmed text of a field; anything but text gives the empty string."""
    return let(sub(v, key), whole_text)


def first_filled(*options: Sql) -> Sql:
    """First non-empty text, else the empty string.

    Every option is written and computed once; ``nullif`` would do it twice, and nested ones
    twice at every level.
    """
    return S.coalesce(S.get(S.filter(S.array(*options), lambda t: t != ""), S.lit(0)), S.lit(""))


def first_text(v: Sql, *keys: str) -> Sql:
    """First non-blank text among the fields."""
    return text(v, keys[0]) if len(keys) == 1 else first_filled(*[text(v, k) for k in keys])


def scalar_text(v: Sql) -> Sql:
    """Text, number or flag as text; flags are written with a capital."""
    raw = trim_ws(S.try_variant_get(v, "$", "string"))
    return let(
        kind_of(v),
        lambda kind: S.when(S.coalesce(kind, "").isin("OBJECT", "ARRAY", "VOID", ""), "")
        .when(kind == "BOOLEAN", S.initcap(raw))
        .otherwise(raw),
    )


def elements(v: Sql) -> Sql:
    """Elements of a list, an empty list otherwise."""
    empty = S.array().cast("array<variant>")
    return S.when(is_array(v), S.try_variant_get(v, "$", "array<variant>")).otherwise(empty)


def objects(v: Sql) -> Sql:
    """Mapping elements of a list."""
    return S.filter(elements(v), is_object)


def list_or_single(v: Sql) -> Sql:
    """The list, or the value as its only element."""
    return S.when(is_array(v), S.try_variant_get(v, "$", "array<variant>")).otherwise(S.array(v))


def texts(v: Sql) -> Sql:
    """Non-blank texts of a list, trimmed."""
    return S.filter(S.transform(elements(v), whole_text), lambda t: t != "")


def sorted_entries(v: Sql) -> Sql:
    """``array<struct<key, value>>`` of a mapping in key order, empty otherwise."""
    pairs = S.when(is_object(v), S.try_variant_get(v, "$", "map<string,variant>"))
    ordered = let(
        pairs,
        lambda m: S.transform(
            S.array_sort(S.map_keys(m)), lambda k: S.struct(k.alias("key"), S.element_at(m, k).alias("value"))
        ),
    )
    return S.coalesce(ordered, S.array().cast("array<struct<key:string,value:variant>>"))


def text_list(v: Sql, preferred: Sequence[str]) -> Sql:
    """Texts, and of objects the first non-blank preferred field, else the first text field."""

    def one(e: Sql) -> Sql:
        any_text = S.get(
            S.filter(S.transform(sorted_entries(e), lambda p: whole_text(p["value"])), lambda t: t != ""), S.lit(0)
        )
        return S.coalesce(S.nullif(whole_text(e), S.lit("")), S.nullif(first_text(e, *preferred), S.lit("")), any_text)

    return S.array_compact(S.transform(elements(v), one))


def unknown_fields(v: Sql, known: Sequence[str]) -> Sql:
    """Fields outside ``known`` as a key-sorted map of JSON texts."""
    odd = S.filter(sorted_entries(v), lambda p: ~p["key"].isin(list(known)))
    return S.map_from_entries(
        S.transform(odd, lambda p: S.struct(p["key"].alias("key"), S.to_json(p["value"]).alias("value")))
    )


NODE = (
    "array<struct<ref:string,keys:array<string>,lists:int,at_index:boolean,named_above:boolean,"
    "text:string,fields:map<string,string>,rest:variant>>"
)


def _node(ref, keys, lists, at_index, named_above, text=None, fields=None, rest=None) -> Sql:
    parts = {
        "ref": ref, "keys": keys, "lists": lists, "at_index": at_index, "named_above": named_above,
        "text": S.lit(None).cast("string") if text is None else text,
        "fields": S.lit(None).cast("map<string,string>") if fields is None else fields,
        "rest": S.lit(None).cast("variant") if rest is None else rest,
    }
    return S.struct(*[S.lit(v).alias(k) if not isinstance(v, Sql) else v.alias(k) for k, v in parts.items()])


def opened(nodes: Sql) -> Sql:
    """One level further down: every node with a ``rest`` gives way to what the rest says, a
    mapping and the values below it in key order, the elements of a list, or a text."""

    def mapping(n: Sql) -> Sql:
        def at_entries(entries: Sql) -> Sql:
            told = S.filter(
                S.transform(entries, lambda p: S.struct(p["key"].alias("key"), whole_text(p["value"]).alias("value"))),
                lambda p: p["value"] != "",
            )
            named = n["named_above"] | (S.size(S.filter(told, lambda p: p["key"] == "name")) > 0)

            def child(p: Sql) -> Sql:
                ref = S.concat(n["ref"], S.lit("."), p["key"])
                return _node(ref, S.concat(n["keys"], S.array(p["key"])), n["lists"], False, named, rest=p["value"])

            own = _node(n["ref"], n["keys"], n["lists"], n["at_index"], n["named_above"], fields=S.map_from_entries(told))
            return S.concat(S.array(own), S.transform(entries, child))

        return let(sorted_entries(n["rest"]), at_entries)

    def listed(n: Sql) -> Sql:
        def child(e: Sql, i: Sql) -> Sql:
            ref = S.concat(n["ref"], S.lit("["), i.cast("string"), S.lit("]"))
            return _node(ref, n["keys"], n["lists"] + 1, True, n["named_above"], rest=e)

        return S.transform(elements(n["rest"]), child)

    def said(n: Sql) -> Sql:
        node = _node(n["ref"], n["keys"], n["lists"], n["at_index"], n["named_above"], text=whole_text(n["rest"]))
        return S.filter(S.array(node), lambda t: t["text"] != "")

    def one(n: Sql) -> Sql:
        return (
            S.when(n["rest"].isNull(), S.array(n)).when(is_object(n["rest"]), mapping(n)).when(is_array(n["rest"]), listed(n))
            .otherwise(said(n)).cast(NODE)
        )

    return S.flatten(S.transform(nodes, one))


def depth_of(value: Column) -> Column:
    """How deep mappings and lists nest in a VARIANT; 0 for a text."""
    bare = F.regexp_replace(F.regexp_replace(F.to_json(value), r"\\.", ""), '"[^"]*"', "")
    marks = F.regexp_extract_all(bare, F.lit(r"[\[\]{}]"), F.lit(0))
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(acc: Column, mark: Column) -> Column:
        now = acc["now"] + F.when(mark.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(acc["most"], now).alias("most"))

    return F.aggregate(marks, start, step, lambda acc: acc["most"])


def walked(value: Sql, base: Sql, depth: int) -> list[Callable[[Sql], Sql]]:
    """Steps from a VARIANT to its text and mapping nodes, depth first, with their paths.

    The first takes nothing, each further one the result of the one before; after them all,
    values that nest ``depth`` deep are opened. JVM expressions only: a walk of any depth is
    a number of equal steps, and ``depth_of`` tells how many.
    """
    root = S.array(_node(base, S.array().cast("array<string>"), 0, False, False, rest=value)).cast(NODE)
    start = S.filter(root, lambda n: n["rest"].isNotNull())
    return [lambda _: start, *[opened] * (depth + 1)]
