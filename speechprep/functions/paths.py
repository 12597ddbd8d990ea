"""Path and stem rules (F7).  All built-in string expressions.

Four stem rules are used by different pipeline stages and are kept apart:
``stem_first_dot`` (name up to its first dot), ``stem_last_dot`` (name
without its last suffix, pathlib rule: a dot at position 0 or at the end
is not a suffix), ``file_name`` (last component after ``/`` or ``\\``) and
``with_suffix`` (swap the last suffix).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def file_name(path: Column) -> Column:
    """Last component after '/', else after '\\', else the whole key."""
    return F.when(F.instr(path, "/") > 0, F.substring_index(path, "/", -1)).when(
        F.instr(path, "\\") > 0, F.substring_index(path, "\\", -1)
    ).otherwise(path)


def parent_dir(path: Column) -> Column:
    """Directory part ('' when there is none)."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def stem_first_dot(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def _last_dot(name: Column) -> Column:
    """1-based position of the last dot (length + 1 when there is none)."""
    return F.length(name) - F.instr(F.reverse(name), ".") + 1


def suffix(name: Column) -> Column:
    """pathlib suffix: last '.xxx' unless the dot is first or last (string
    functions only: linear in the name length)."""
    dot = _last_dot(name)
    ok = (F.instr(name, ".") > 0) & (dot > 1) & (dot < F.length(name))
    return F.when(ok, name.substr(dot, F.length(name))).otherwise(F.lit(""))


def stem_last_dot(name: Column) -> Column:
    sfx = suffix(name)
    return F.when(sfx == "", name).otherwise(name.substr(F.lit(1), F.length(name) - F.length(sfx)))


def with_suffix(path: Column, new_suffix: str) -> Column:
    """Replace the file name's suffix (or append one) — pathlib ``with_suffix``."""
    name = file_name(path)
    d = parent_dir(path)
    new_name = F.concat(stem_last_dot(name), F.lit(new_suffix))
    return F.when(F.instr(path, "/") > 0, F.concat(d, F.lit("/"), new_name)).otherwise(new_name)


def without_last_extension(path: Column) -> Column:
    """Shell ``${file%.*}``: drop the shortest trailing '.xxx' (anywhere)."""
    return F.regexp_replace(path, r"\.[^.]*$", "")
