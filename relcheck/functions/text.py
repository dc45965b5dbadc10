"""String and list helpers used by the operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the whitespace class used for normalising definitions. It is
# the ASCII class (space, tab, newline, carriage return, form feed,
# vertical tab) so that Java regex, RE2 and Python agree.
ASCII_WS = "[ \\t\\n\\r\\f\\x0B]+"
# Unicode-aware variant (Python's str.split() also eats these).
UNICODE_WS = "(?U)\\s+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c, unicode_spaces: bool = False) -> Column:
    """Collapse whitespace runs to one space and trim; null -> ''."""
    pattern = UNICODE_WS if unicode_spaces else ASCII_WS
    return F.trim(F.regexp_replace(F.coalesce(_c(c), F.lit("")), pattern, " "))


def definition_hash(c, normalize: bool = True) -> Column:
    """SHA-256 hex of the (normalised) UTF-8 text."""
    return F.sha2(normalize_text(c) if normalize else _c(c), 256)


def trim_ws(c) -> Column:
    """Strip leading and trailing whitespace (not only spaces)."""
    return F.regexp_replace(_c(c), "^\\s+|\\s+$", "")


#: A glob's parts: a run of stars, a question mark, a class that is closed, or
#: one plain character.
_GLOB_PART = re.compile(r"\*+|\?|\[(?P<no>!?+)(?P<body>\][^\]]*|[^\]]+)\]|.", re.DOTALL)
_RANGE = re.compile(r"(.)-(.)", re.DOTALL)


def _glob_class(body: str, negated: bool) -> str:
    """A class for Java: every character by its code, so that none acts as an
    operator; ranges stay, and a range that runs backwards holds nothing."""
    out, at = [], 0
    while at < len(body):
        m = _RANGE.match(body, at)
        if m:
            if m[1] <= m[2]:
                out.append("-".join("\\x{%x}" % ord(x) for x in m.groups()))
            at = m.end()
        else:
            out.append("\\x{%x}" % ord(body[at]))
            at += 1
    if not out:
        return "." if negated else "(?!)"
    return "[" + "^" * negated + "".join(out) + "]"


def glob_to_regex(pattern: str) -> str:
    """S3: shell glob -> regex for the whole text (Java): ``*`` any run (dots
    and line breaks included), ``?`` one character, ``[abc]``, ``[a-z]`` and
    ``[!abc]`` classes; a bracket that is never closed is itself."""
    out = []
    for m in _GLOB_PART.finditer(pattern):
        part = m[0]
        if part[0] == "*":
            out.append(".*")
        elif part == "?":
            out.append(".")
        elif m["body"] is not None:
            out.append(_glob_class(m["body"], bool(m["no"])))
        else:
            out.append("\\x{%x}" % ord(part))
    return "(?s)\\A" + "".join(out) + "\\z"


def glob_match(c, patterns) -> Column:
    """True when the value matches any of the glob patterns (case-sensitive)."""
    if isinstance(patterns, str):
        patterns = [patterns]
    cond = F.lit(False)
    for p in patterns:
        cond = cond | _c(c).rlike(glob_to_regex(p))
    return F.coalesce(cond, F.lit(False))


def session_key(customer, session) -> Column:
    """Display form CustomerID || SessionID. Group by the pair, never by
    this text: ('1','23') and ('12','3') give the same string."""
    return F.concat(_c(customer), _c(session))


def lenient(c, kind: str) -> Column:
    """Lenient equality domain: null, '' and 0 collapse
    to null before comparing, per attribute type."""
    if kind == "string":
        return F.nullif(_c(c), F.lit(""))
    if kind == "boolean":
        return F.when(_c(c), F.lit(True))
    return F.nullif(_c(c), F.lit(0))


def as_list(df: DataFrame, name: str) -> Column:
    """A column of lists as it is, of scalars as lists of one; null is the
    empty list."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.ArrayType):
        return F.coalesce(c, F.array().cast(kind))
    return F.when(c.isNull(), F.array().cast(T.ArrayType(kind))).otherwise(F.array(c))
