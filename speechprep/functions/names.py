"""File-name cleaners, truncation and language tags.

Pure column expressions: no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_ws, let, rstrip, strip

# Characters illegal in file names on common filesystems.
ILLEGAL_CHARS = r'[\\/*?:"<>|]'


def splitext(c: Column) -> tuple[Column, Column]:
    """``os.path.splitext`` of a file name: the suffix from the last dot,
    provided some non-dot character precedes that dot.  Built from
    ``instr``/``substring`` (linear; a backtracking regex would be quadratic
    in the name length)."""
    from_end = F.instr(F.reverse(c), ".")               # 1-based position of the last dot, from the end
    dot = F.length(c) - from_end + 1                     # 1-based position of the last dot
    head = c.substr(F.lit(1), dot - 1)
    has_ext = (from_end > 0) & (F.length(F.regexp_replace(head, r"\.", "")) > 0)
    ext = F.when(has_ext, c.substr(dot, F.length(c))).otherwise(F.lit(""))
    root = F.when(has_ext, head).otherwise(c)
    return root, ext


_splitext = splitext


def clean_replace(c: Column) -> Column:
    """Illegal → '_', whitespace runs → one space, strip."""
    return strip(collapse_ws(F.regexp_replace(c, ILLEGAL_CHARS, "_")))


def clean_capped(c: Column, max_len: int = 50) -> Column:
    """Illegal removed, whitespace collapsed, capped at ``max_len`` keeping the
    extension, then stripped."""

    def capped(s: Column) -> Column:
        # the suffix from the last dot, if a character other than a dot precedes it
        after = F.when(F.instr(s, ".") > 0, F.concat(F.lit("."), F.substring_index(s, ".", -1))).otherwise("")
        return let(after, lambda e: let(
            F.struct(e.alias("ext"), (F.length(s) - F.length(e)).alias("n")),
            lambda x: let(F.when((x["ext"] != "") & ~s.substr(F.lit(1), x["n"]).rlike(r"^\.*+$"), x).otherwise(
                F.struct(F.lit("").alias("ext"), F.length(s).alias("n"))), kept(s))))

    def kept(s: Column):
        def body(x: Column) -> Column:  # Python's root[:max_len - len(ext)], also where that is negative
            room = F.lit(max_len) - F.length(x["ext"])
            return F.concat(s.substr(F.lit(1), F.when(room >= 0, F.least(room, x["n"])).otherwise(F.greatest(x["n"] + room, F.lit(0)))), x["ext"])

        return body

    cleaned = collapse_ws(F.regexp_replace(c, ILLEGAL_CHARS, ""))
    return strip(let(cleaned, lambda s: F.when(F.length(s) > max_len, capped(s)).otherwise(s)))


def _left(c: Column, n: Column) -> Column:
    """Python ``c[:n]``; a negative n counts from the end."""
    keep = F.when(n >= 0, n).otherwise(F.greatest(F.length(c) + n, F.lit(0)))
    return c.substr(F.lit(1), keep)


def clean_remove(c: Column) -> Column:
    """Illegal removed, strip."""
    return strip(F.regexp_replace(c, ILLEGAL_CHARS, ""))


def clean_slashes(c: Column, do_strip: bool = True) -> Column:
    """'/' and '\\' → '_' (then strip; the program-page variant does not)."""
    s = F.regexp_replace(c, r"[/\\]", "_")
    return strip(s) if do_strip else s


def clean_alnum(c: Column) -> Column:
    """Keep letters, digits, space, '-' and '_'; strip the right end."""
    return rstrip(F.regexp_replace(c, r"[^\p{L}\p{N} _-]", ""))


def clean_slashes_nul(c: Column, max_len: int = 200) -> Column:
    """'/' and '\\' → '_', NUL removed, first ``max_len`` characters."""
    s = F.regexp_replace(F.regexp_replace(c, r"[/\\]", "_"), "\u0000", "")
    return s.substr(1, max_len)


def truncate_words(c: Column, max_len: int) -> Column:
    """Cut to ``max_len`` characters without breaking a word (F2): back up to
    the last space at index >= int(0.6 * max_len), then strip the right."""
    cut = c.substr(1, max_len)
    start = int(max_len * 0.6)
    rpos = F.instr(F.reverse(cut), " ")  # 1-based from the end, 0 = none
    last_space = F.when(rpos > 0, F.length(cut) - rpos).otherwise(F.lit(-1))  # 0-based
    backed = F.when((last_space >= start) & (last_space > 0), cut.substr(F.lit(1), last_space)).otherwise(cut)
    return F.when(F.length(c) <= max_len, c).otherwise(rstrip(backed))


def cap_album_dir(lang_dir: Column, safe_title: Column, slug: Column, max_dir: int = 200, title_cap: int = 100) -> Column:
    """Album directory ``<lang_dir>/<title[:100]>``; if longer than ``max_dir``
    the title is cut further by the excess (F3).  An empty title falls back
    to the slug."""
    title = F.when(safe_title == "", slug).otherwise(safe_title)
    prefix = F.concat(lang_dir, F.lit("/"))
    first = F.concat(prefix, title.substr(F.lit(1), F.lit(title_cap)))
    excess = F.length(first) - F.lit(max_dir)
    return F.when(F.length(first) > max_dir,
                  F.concat(prefix, _left(title, F.lit(title_cap) - excess))).otherwise(first)


def cap_episode_file(album_dir: Column, file_name: Column, seq: Column, max_path: int = 250,
                     min_keep: int = 10, default_ext: str = ".mp3") -> Column:
    """Episode file name so that ``album_dir/name`` stays within ``max_path``;
    when fewer than ``min_keep`` characters remain, ``episode_<seq>.mp3`` (F3)."""
    full_len = F.length(album_dir) + F.lit(1) + F.length(file_name)
    available = F.lit(max_path) - F.length(album_dir) - F.lit(1)
    root, ext = _splitext(file_name)
    truncated = F.concat(_left(root, available - F.length(ext)), ext)
    fallback = F.concat(F.lit("episode_"), seq.cast("string"), F.lit(default_ext))
    return F.when(full_len <= max_path, file_name).when(available > min_keep, truncated).otherwise(fallback)


def cap_title(c: Column, max_len: int = 100) -> Column:
    return c.substr(1, max_len)


def normalize_language(c: Column, unknown: str = "unknown") -> Column:
    """NULL/'' → ``unknown``; else lower(strip), main subtag before - _ or .,
    alias mapped to ISO 639-1 (F5).  The alias map is a literal map
    expression, so no join is needed."""
    from ..operators.joins import LANG_ALIASES

    s = F.lower(strip(c))
    main = F.split(s, r"[-_.]").getItem(0)
    amap = F.create_map(*[F.lit(x) for kv in sorted(LANG_ALIASES.items()) for x in kv])
    return F.when(c.isNull() | (c == ""), F.lit(unknown)).otherwise(F.coalesce(amap[main], main))


def volume_name(bucket: Column, ts: Column, seq: Column) -> Column:
    """``{bucket}_{yyyymmdd_HHMMSS}_{seq:03d}.tar``."""
    return F.format_string("%s_%s_%03d.tar", bucket, F.date_format(ts, "yyyyMMdd_HHmmss"), seq)


def piece_name(stem: Column, idx: Column, ext: Column) -> Column:
    """``{stem}_{i:03d}{ext}`` (slicer output, F13)."""
    return F.format_string("%s_%03d%s", stem, idx, ext)


def chunk_name(stem: Column, idx: Column) -> Column:
    """``{stem}_{i}.wav``."""
    return F.format_string("%s_%d.wav", stem, idx)


def transcript_file_name(album: Column) -> Column:
    """``transcription_{album}.json``."""
    return F.concat(F.lit("transcription_"), album, F.lit(".json"))
