"""DuckDB spellings of the whitespace rules in ``functions/text.py``."""

from __future__ import annotations

from ..functions.text import PY_WHITESPACE, WS_CLASS_RE2

WS_SQL = "(" + " || ".join(f"chr({ord(c)})" for c in PY_WHITESPACE) + ")"


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def rstrip_sql(x: str) -> str:
    return f"rtrim({x}, {WS_SQL})"


def collapse_sql(x: str, repl: str = "' '") -> str:
    return f"regexp_replace({x}, '{WS_CLASS_RE2}+', {repl}, 'g')"
