"""Text functions: blanks and newlines as Python sees them, escapes, and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space with Unicode's, and the four separators that Python's strip() also takes.
BLANK = r"[\s\x1c-\x1f]"


def lines_of(text: Column) -> Column:
    """A document with every line end as one line feed."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{BLANK}+|{BLANK}+\z", "")


def rstripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U){BLANK}+\z", "")


def _all(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def html_escaped(text: Column) -> Column:
    return _all(text, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")])


def dot_escaped(text: Column) -> Column:
    """A text for a quoted label: no carriage returns, line feeds and what cannot be printed as blanks, the label's special characters escaped."""
    plain = _all(F.coalesce(text, F.lit("")), [("\r", ""), ("\n", " "), *((c, "\\" + c) for c in '"{}<>|')])
    return F.regexp_replace(plain, r"[\p{C}\p{Z}&&[^ ]]", " ")


def unquoted(text: Column) -> Column:
    """Without double quotes at either end."""
    return F.regexp_replace(text, r'^"+|"+\z', "")


def path_parts(path: Column) -> Column:
    """The components of a path; ordering by them differs from ordering by text."""
    return F.split(path, "/")


def has_tail(path: Column, tail: str) -> Column:
    """Whether the last components of a path are those of tail."""
    parts = [x for x in tail.split("/") if x]
    own = F.filter(path_parts(path), lambda x: x != "")
    return (F.size(own) >= len(parts)) & (F.slice(own, F.greatest(F.size(own) - len(parts) + 1, F.lit(1)), F.lit(len(parts))) == F.array(*map(F.lit, parts)))
