"""SQL spellings of the text functions, for the checks."""

from __future__ import annotations

from factgraph.functions.text import py_casefold, py_norm_term, term_variants


def fold(col: str) -> str:
    return f"replace(lower({col}), 'ß', 'ss')"


def ascii_fold(col: str) -> str:
    return f"translate({col}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def norm(col: str) -> str:
    return f"trim(regexp_replace({fold(col)}, '[^0-9a-z]+', ' ', 'g'))"


def term_test(term: str, cols: list[str], aliases: tuple[str, ...] = ()) -> str:
    if not term:
        return "true"
    tests = [
        f"contains({fold(c)}, '{raw}') OR contains({norm(c)}, '{normal}')"
        for raw, normal in term_variants(term, aliases)
        for c in cols
    ]
    return "coalesce(" + " OR ".join(tests or ["false"]) + ", false)"


__all__ = ["ascii_fold", "fold", "norm", "py_casefold", "py_norm_term", "term_test"]
