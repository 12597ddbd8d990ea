"""URL helpers (F4, F6, F8, G4 joins).  Regex based, so malformed URLs give
'' / NULL instead of failing the task (ANSI ``parse_url`` would raise)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_URL_RE = r"^([A-Za-z][A-Za-z0-9+.-]*):(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"

# Media suffixes tried in order on the URL path, then
# content-type substrings, as in the reference; default ".mp3".
PATH_EXTENSIONS = (".mp3", ".m4a", ".mp4", ".ogg", ".opus", ".wav", ".flac")
CONTENT_TYPE_RULES = (
    (("mpeg", "mp3"), ".mp3"),
    (("mp4", "m4a", "aac"), ".m4a"),
    (("ogg",), ".ogg"),
    (("opus",), ".opus"),
    (("wav",), ".wav"),
)


def url_scheme(url: Column) -> Column:
    return F.regexp_extract(url, _URL_RE, 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, _URL_RE, 3)


def url_path(url: Column) -> Column:
    """Path component; for scheme-less input the part before ? / #."""
    has_scheme = F.regexp_extract(url, _URL_RE, 1) != ""
    return F.when(has_scheme, F.regexp_extract(url, _URL_RE, 4)).otherwise(
        F.regexp_extract(url, r"^([^?#]*)", 1)
    )


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, _URL_RE, 6)


def url_origin(url: Column) -> Column:
    return F.concat(url_scheme(url), F.lit("://"), url_host(url))


def guess_extension(url: Column, content_type: Column) -> Column:
    """URL path suffix, else content-type, else '.mp3' (F4)."""
    path = F.lower(url_path(url))
    expr = None
    for ext in PATH_EXTENSIONS:
        cond = path.endswith(ext)
        expr = F.when(cond, F.lit(ext)) if expr is None else expr.when(cond, F.lit(ext))
    ct = F.lower(F.coalesce(content_type, F.lit("")))
    for needles, ext in CONTENT_TYPE_RULES:
        cond = None
        for n in needles:
            c = F.instr(ct, n) > 0
            cond = c if cond is None else (cond | c)
        expr = expr.when(cond, F.lit(ext))
    return expr.otherwise(F.lit(".mp3"))


def resource_id(text: Column, kind: str, host_re: str = r"[A-Za-z0-9.-]+") -> Column:
    """22-character id after ``<host>/[intl-xx/]<kind>/`` or ``<scheme>:<kind>:``
    (F6); NULL when absent."""
    pattern = rf"(?:{host_re}/(?:intl-[a-z-]+/)?{kind}/|[a-z]+:{kind}:)([A-Za-z0-9]{{22}})"
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def with_query(url: Column, query: Column) -> Column:
    """Rebuild ``scheme://host/path?query[#fragment]`` with a new query (F8)."""
    frag = F.regexp_extract(url, _URL_RE, 8)
    base = F.concat(url_scheme(url), F.lit("://"), url_host(url), F.regexp_extract(url, _URL_RE, 4))
    return F.concat(base, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
                    F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(F.lit("")))


def query_param(url: Column, name: str) -> Column:
    """First value of a query parameter (NULL when absent)."""
    return F.nullif(F.regexp_extract(url_query(url), rf"(?:^|&){name}=([^&]*)", 1), F.lit(""))


_RELATIVE_RE = r"(?s)^([^?#]*)(\?[^#]*)?(#.*)?$"


def _without_dots(path: Column) -> Column:
    """An absolute path with its ``.`` and ``..`` segments resolved."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.expr("CAST(array() AS array<string>)"),
        lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, x)),
    )
    ends_in_dots = path.rlike(r"/\.{1,2}$")
    return F.concat(F.lit("/"), F.array_join(F.when(ends_in_dots, F.array_append(kept, F.lit(""))).otherwise(kept), "/"))


def join_url(base: Column, ref: Column) -> Column:
    """Resolve ``ref`` against an absolute ``base`` by RFC 3986: references with
    a scheme, ``//host``, ``/x``, ``x``, ``./x``, ``../x``, ``?q`` and ``#f``."""
    path, query, fragment = (F.regexp_extract(ref, _RELATIVE_RE, k) for k in (1, 2, 3))
    base_path = F.regexp_extract(base, _URL_RE, 4)
    base_dir = F.regexp_extract(base_path, r"^(.*/)", 1)
    merged = (
        F.when(path == "", base_path).when(path.startswith("/"), _without_dots(path))
        .otherwise(_without_dots(F.concat(F.when(base_dir == "", F.lit("/")).otherwise(base_dir), path)))
    )
    asked = F.when((path == "") & (query == ""), F.regexp_extract(base, _URL_RE, 5)).otherwise(query)
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(url_scheme(base), F.lit(":"), ref))
        .when(ref == "", base)
        .when(ref.startswith("/") & ~ref.contains("/."), F.concat(url_origin(base), ref))  # nothing to resolve
        .otherwise(F.concat(url_origin(base), merged, asked, fragment))
    )


def percent_decode(c: Column) -> Column:
    """``%41`` as ``A``; a plus sign stays; text that is no valid escape is kept."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def strip_fullwidth_parens(c: Column) -> Column:
    """Drop ``（…）`` groups (non-greedy) and strip (F8)."""
    from .text import strip

    return strip(F.regexp_replace(c, "（.*?）", ""))
