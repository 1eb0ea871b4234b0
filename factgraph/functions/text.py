"""Text folding, cleaning and classification as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from factgraph.functions.sqlexpr import literal

# Every character Python's str.strip() and \s treat as whitespace.
WS = r"[\s\x0B\x{1C}-\x{1F}\x{85}\p{Z}]"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ascii_fold(col: Column | str) -> Column:
    """Lower-case A-Z only, the folding of NOCASE comparisons and LIKE."""
    return F.translate(_c(col), _UPPER, _LOWER)


def casefold(col: Column | str) -> Column:
    """Unicode folding; ``lower`` plus sharp s, which covers the practical cases."""
    return F.replace(F.lower(_c(col)), F.lit("ß"), F.lit("ss"))


def py_casefold(text: str) -> str:
    """The same folding for call arguments."""
    return text.lower().replace("ß", "ss")


def trim_ws(col: Column | str) -> Column:
    """Strip all whitespace, not only blanks."""
    return F.regexp_replace(_c(col), f"^{WS}+|{WS}+$", "")


def is_blank(col: Column | str) -> Column:
    return F.coalesce(trim_ws(col), F.lit("")) == ""


def non_blank(col: Column | str) -> Column:
    """The trimmed text, or null when nothing is left."""
    return F.nullif(trim_ws(col), F.lit(""))


def norm_term(col: Column | str) -> Column:
    """Folded text with every run of other characters turned into one space."""
    return F.trim(F.regexp_replace(casefold(col), "[^0-9a-z]+", " "))


def py_norm_term(text: str) -> str:
    out = "".join(ch if ch in "0123456789" + _LOWER else " " for ch in py_casefold(text))
    return " ".join(out.split())


def contains_like(col: Column | str, term: str) -> Column:
    """``LIKE '%term%'`` without case; ``%`` and ``_`` in the term stay wildcards."""
    pattern = "".join(ch.lower() if ch in _UPPER else ch for ch in term)
    return ascii_fold(col).like("%" + pattern.replace("\\", "\\\\") + "%")


def term_variants(term: str, aliases: Sequence[str] = ()) -> list[tuple[str, str]]:
    """Distinct (folded, normalised) forms; a form that normalises to nothing is dropped."""
    out: list[tuple[str, str]] = []
    for raw in (term, *aliases):
        pair = (py_casefold(raw), py_norm_term(raw))
        if pair[1] and pair not in out:
            out.append(pair)
    return out


def matches_term(term: str, texts: Sequence[tuple[str, str]], aliases: Sequence[str] = ()) -> str:
    """SQL condition: any text holds any variant of ``term`` literally or normalised.

    ``texts`` are names of folded and normalised columns, so that many terms share the
    work on a text. An empty term matches everything, one of punctuation only nothing.
    """
    if not term:
        return "true"
    tests = [
        f"contains({column}, {literal(form)})"
        for variant in term_variants(term, aliases)
        for pair in texts
        for column, form in zip(pair, variant, strict=True)
    ]
    return "(" + (" OR ".join(tests) or "false") + ")"


def compact_ws(col: Column | str) -> Column:
    """Whitespace runs become one blank, ends are cut."""
    return F.trim(F.regexp_replace(_c(col), f"{WS}+", " "))


def rtrim_ws(col: Column | str) -> Column:
    return F.regexp_replace(_c(col), f"{WS}+$", "")


def join_notes(*parts: Column) -> Column:
    """``; `` between the non-blank parts, each trimmed."""
    return F.array_join(F.array_compact(F.array(*[non_blank(p) for p in parts])), "; ")


def inline_terms(col: Column | str) -> Column:
    """Comma-separated terms, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(_c(col), ","), compact_ws), lambda t: t != "")


# Line ends, and fence lines that carry no content.
LINE_BREAKS = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}]"
FENCES = ["```", "```bash", "```sh", "```shell", "```zsh"]


def text_lines(col: Column | str) -> Column:
    """Compacted lines without blanks, fences, table rows and rule-only lines."""
    lines = F.transform(F.split(_c(col), LINE_BREAKS), compact_ws)
    return F.filter(lines, lambda s: ~(s.isin(FENCES) | s.rlike(r"^\|(.*\|)?$") | s.rlike("^[-|: ]*$")))


# --- time -------------------------------------------------------------------------

# Fixed pattern: the ISO forms accepted as a date or a date with time.
AS_OF_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)?)?$"
)


def parse_as_of(col: Column | str) -> Column:
    """Date or datetime text to an instant, read as UTC without a zone; bad text gives null."""
    text = trim_ws(col)
    timed = F.regexp_replace(text, r"([T ]\d{2}:\d{2})(Z|[+-].*)?$", "$1:00$2")
    zoned = F.regexp_replace(F.regexp_replace(timed, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"([T ][0-9:.]+)$", "$1Z")
    whole = F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z"))).otherwise(zoned)
    return F.when(text.rlike(AS_OF_PATTERN), F.try_to_timestamp(whole))


def iso_seconds(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` in UTC, whatever zone the session shows times in."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


# --- numbers ----------------------------------------------------------------------


def fraction(part: Column, whole: Column) -> Column:
    """Four digits, half to even; 0.0 on an empty scope."""
    return F.when(whole > 0, F.bround(part / whole, 4)).otherwise(F.lit(0.0))


def percentage(part: Column, whole: Column, empty: float = 0.0, digits: int = 3) -> Column:
    return F.when(whole > 0, F.bround(part / whole * 100.0, digits)).otherwise(F.lit(empty))


def clamp_confidence(col: Column | str, default: float = 0.74) -> Column:
    """Numeric text or number inside [0, 1], else the default."""
    number = _c(col).try_cast("double")
    return F.when(number.between(0.0, 1.0), number).otherwise(F.lit(default))


def label_of(col: Column | str) -> Column:
    """Text after the first ``::``; the id itself when there is none."""
    c = _c(col)
    at = F.instr(c, "::")
    return F.when(at > 0, c.substr(at + 2, F.length(c))).otherwise(c)


# --- URLs and slugs ---------------------------------------------------------------

# Fixed patterns: repository addresses inside text, in https and in ssh form.
HTTPS_REPO = (
    r"(?i)(?:git\+)?https?://github\.com/([A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+?)"
    r"""(?:\.git)?(?:[/?#]|$|[\s"'(),])"""
)
SSH_REPO = r"""(?i)git@github\.com:([A-Za-z0-9_.-]+/[A-Za-z0-9_.-]+?)(?:\.git)?(?:\s|$|")"""
# Fixed pattern: a whole address naming exactly one repository.
STRICT_URL = r"^https?://github\.com/([^/]+)/([^/]+?)(?:\.git)?/?$"
FULL_NAME = r"^[^/]+/[^/]+$"


def mentioned_full_names(col: Column | str) -> Column:
    """Lower-cased ``owner/name`` of every repository address, https ones first."""
    found = F.concat(
        F.regexp_extract_all(_c(col), F.lit(HTTPS_REPO), 1),
        F.regexp_extract_all(_c(col), F.lit(SSH_REPO), 1),
    )
    names = F.transform(found, lambda m: F.regexp_replace(F.lower(m), r"(?<=/)[}>,.;:]+|[}>,.;:]+$", ""))
    return F.filter(names, lambda n: n.rlike("^[^/]+/[^/]+$"))


def full_name_of_url(col: Column | str) -> Column:
    """``owner/name`` of a strict address, else the empty string."""
    url = trim_ws(col)
    name = F.concat_ws("/", F.regexp_extract(url, STRICT_URL, 1), F.regexp_extract(url, STRICT_URL, 2))
    return F.when(name.rlike(FULL_NAME), name).otherwise(F.lit(""))


def slug(col: Column | str, fallback: Column | str) -> Column:
    """Letters, digits and ``-_.`` kept, blank and slash to ``-``, outer dashes cut."""
    text = F.regexp_replace(F.lower(_c(col)), "[ /]", "-")
    text = F.regexp_replace(F.regexp_replace(text, r"[^\p{L}\p{N}_.-]", ""), "^-+|-+$", "")
    return F.coalesce(F.nullif(text, F.lit("")), _c(fallback))


def strip_branch_suffix(col: Column | str) -> Column:
    """Directory name without one trailing branch suffix."""
    return F.regexp_replace(_c(col), "(?i)-(main|master|develop|dev)$", "")


def norm_token(col: Column | str) -> Column:
    return F.regexp_replace(F.lower(_c(col)), "[^a-z0-9]", "")


def path_tokens(col: Column | str) -> Column:
    return F.filter(F.split(F.lower(_c(col)), "[^a-z0-9]+"), lambda t: t != "")


def path_depth(col: Column | str) -> Column:
    return F.size(F.split(_c(col), "/")) - 1
