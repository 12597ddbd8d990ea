"""Whitespace rules.

The reference strips and collapses whitespace with Python's ``str.strip()``
and ``re.sub(r"\\s+", " ", ...)``, i.e. every character for which
``str.isspace()`` is true.  SQL ``trim`` removes only spaces and Java's
``\\s`` is ASCII-only, so the character set is derived here from the same
rule and used explicitly: ``btrim``/``rtrim`` with that set (linear, no
regex backtracking) and a character class for collapsing runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Derived by rule: every code point Python treats as whitespace (all lie
# below U+3001).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())
WS_CLASS_JAVA = "[" + "".join(f"\\u{ord(c):04x}" for c in PY_WHITESPACE) + "]"
WS_CLASS_RE2 = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in PY_WHITESPACE) + "]"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(PY_WHITESPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(PY_WHITESPACE))


#: The same characters by Java's own classes, which match faster than a list.
_RUNS = r"[\s\p{Z}\x1c-\x1f\x85]+"


def collapse_ws(c: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(c, _RUNS, " ")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row: a column that an
    expression names several times is computed for each of them, one bound
    through a one-element array is not."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def label_text(c: Column) -> Column:
    """Label file body: stripped text plus one newline."""
    return F.concat(strip(c), F.lit("\n"))
