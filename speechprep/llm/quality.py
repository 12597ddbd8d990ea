"""Operator 1: quality rules as a short-circuit cascade.

Base statistics are computed for every row.  The rules of the cascade are
ordered by what a sample says: each rule's cost (seconds on the sample) and
selectivity (share of sample rows it rejects) give rejections per second, and
the rule with most comes first.  The cascade is one ``CASE``: a row rejected by
one rule never evaluates the later ones.  Which rows are kept does not depend
on the order, so the sample and its timing only affect speed.

Defined cases: null text has no words (all statistics 0, base fails); an empty
text likewise; texts of any length are read whole; repeated rows and rows with
a null doc_id each get their own result; an empty table gives an empty result;
extra columns are ignored.  Two windows count as equal when a 64-bit hash
proposes it and their words confirm it.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, boxed, let, pick, table, total, unboxed, written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def lines_of(text: Column) -> Column:
    """Lines (split at ``\\n``) that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")


def repeated_words(words: Column, width: int = 5) -> Column:
    """How many words lie in a window of ``width`` words found twice or more."""

    def same(a: Column, b: Column) -> Column:
        return (a["h"] == b["h"]) & (F.slice(words, a["i"] + 1, width) == F.slice(words, b["i"] + 1, width))

    def covered(win: Column) -> Column:
        ordered = F.array_sort(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = lambda s: F.sort_array(
            F.transform(
                F.filter(s, lambda x, k: F.coalesce(same(x, F.get(s, k - 1)), F.lit(False))
                         | F.coalesce(same(x, F.get(s, k + 1)), F.lit(False))),
                lambda x: x["i"],
            )
        )
        spans = lambda p: total(
            F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))).cast("long"))
        )
        return let(let(ordered, repeated), spans)

    hashes = F.transform(words, lambda x: F.xxhash64(x))
    windows = lambda h: F.transform(
        F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])
    )
    counted = let(
        let(hashes, windows),
        lambda win: F.when(F.size(F.array_distinct(win)) == F.size(win), F.lit(0).cast("long")).otherwise(covered(win)),
    )
    return F.when(F.size(words) < width, F.lit(0).cast("long")).otherwise(counted)


def base_columns() -> dict[str, Column]:
    """Base statistics over columns ``text``, ``_words`` and ``_lines``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return {
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": repeated_words(F.col("_words")),
    }


@dataclass(frozen=True)
class Rule:
    """``rejects``: SQL condition over text, _words, _lines and the base statistics."""

    name: str
    rejects: str


#: Each condition reads as "reject when".  Thresholds are far from clean prose.
RULES = (
    Rule("symbol_heavy", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 40 * n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > size(_lines)"),
    Rule("digit_heavy", "2 * (length(text) - length(regexp_replace(text, '[0-9]+', ''))) > length(text)"),
    Rule("few_letter_words", "5 * size(filter(_words, x -> x rlike '[A-Za-z\\\\x80-\\\\x{10FFFF}]')) < 2 * n_words"),
    Rule("bullet_lines", "size(_lines) >= 5 AND 10 * size(filter(_lines, x -> ltrim(x) rlike '^[•*-]')) > 9 * size(_lines)"),
    Rule("ellipsis_lines", "size(_lines) >= 5 AND 2 * size(filter(_lines, x -> rtrim(x) rlike '(…|[.][.][.])$')) > size(_lines)"),
    # distinct words of each stretch of 1,000, so that the length of a text does not count
    Rule("few_distinct_words", "n_words >= 50 AND 20 * aggregate(transform(sequence(0L, (n_words - 1) div 1000), "
         "i -> size(array_distinct(slice(_words, int(i * 1000 + 1), 1000)))), 0L, (a, x) -> a + x) < n_words"),
    Rule("shouting", "n_words >= 20 AND 10 * size(filter(_words, x -> x rlike '^[A-Z]{2,}[.,;:!?]*$')) > 8 * n_words"),
)


def prepared(docs: DataFrame) -> DataFrame:
    """``docs`` (with a text column) plus words, lines and base statistics.

    ``_row_id`` keeps a later filter above these columns: pushed below them,
    its copy of their expressions would split the text again for every use."""
    cut = docs.withColumns({"_words": words_of(F.col("text")), "_lines": lines_of(F.col("text"))})
    base = cut.withColumns(base_columns() | {"_row_id": F.monotonically_increasing_id()})
    return base.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


def rule_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 1000, seed: int = 7) -> list[dict]:
    """Cost and selectivity of each rule on a random sample of about
    ``sample_rows`` rows, best rejection per cost first.

    The sample is written to the shared folder as one small table; each rule
    is timed alone over it, less the time of an empty pass."""
    n = docs.count()
    share = min(1.0, sample_rows / max(1, n))
    base = prepared(pick(docs, "text").sample(False, share, seed)).where("NOT base_failed AND _row_id >= 0")
    sample = written(base.drop("_row_id").coalesce(1), "quality-sample")

    def seconds(df: DataFrame) -> float:
        best = float("inf")
        for _ in range(2):
            began = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - began)
        return best

    rejected = sample.agg(
        F.count("*").alias("n"), *[F.count_if(F.expr(r.rejects)).alias(f"r{i}") for i, r in enumerate(rules)]
    ).first()
    empty = seconds(sample.select("n_words"))
    stats = []
    for i, r in enumerate(rules):
        cost = max(seconds(sample.select(F.expr(r.rejects).alias("x"))) - empty, 1e-4)
        chance = (rejected[f"r{i}"] + 0.5) / (rejected["n"] + 1)
        stats.append({"rule": r, "cost": cost, "selectivity": chance, "rank": chance / cost})
    return sorted(stats, key=lambda s: (-s["rank"], s["rule"].name))


def cascade(order: list[Rule]) -> Column:
    """Name of the first rule in ``order`` that rejects the row, else null; one
    CASE, so later rules are not evaluated for a rejected row."""
    out = F.when(F.col("base_failed"), F.lit("base"))
    for r in order:
        out = out.when(F.expr(r.rejects), F.lit(r.name))
    return out


def score(docs: DataFrame, order: list[Rule] | None = None) -> DataFrame:
    """doc_id, base statistics, base_failed, rejected_by (first rule of the
    cascade in the chosen order) and kept, one row per input row."""
    order = order or [s["rule"] for s in rule_order(docs)]
    out = prepared(pick(docs, "doc_id", "text")).withColumn("rejected_by", cascade(order))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "rejected_by", F.col("rejected_by").isNull().alias("kept"),
    )


def filter_docs(docs: DataFrame, order: list[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with their columns."""
    order = order or [s["rule"] for s in rule_order(docs)]
    kept = prepared(boxed(docs, "text")).where(cascade(order).isNull() & (F.col("_row_id") >= 0))
    return unboxed(kept, docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents")).drop("rejected_by")


#: The rules again for DuckDB, written from their meaning.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), pos AS (
  SELECT r, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) >= 5
), win AS (
  SELECT r, i, concat_ws(' ', x, lead(x, 1) OVER o, lead(x, 2) OVER o, lead(x, 3) OVER o, lead(x, 4) OVER o) AS g,
         lead(x, 4) OVER o AS last
  FROM pos WINDOW o AS (PARTITION BY r ORDER BY i)
), often AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win WHERE last IS NOT NULL) WHERE c > 1
), cov AS (
  SELECT r, count(DISTINCT i + k) AS n FROM often, (SELECT unnest(range(5)) AS k) GROUP BY r
), s AS (
  SELECT w.r, doc_id, t, ws, ls, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov ON w.r = cov.r
), b AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    n_symbols / n_words > 0.1
    OR word_chars / n_words < 2 OR word_chars / n_words > 40
    OR n_dup_lines > 0.5 * len(ls)
    OR length(regexp_replace(t, '[^0-9]', '', 'g')) > 0.5 * length(t)
    OR len(regexp_extract_all(t, '[^\x20\x09-\x0D]*[A-Za-z\x{80}-\x{10FFFF}][^\x20\x09-\x0D]*')) < 0.4 * n_words
    OR (len(ls) >= 5 AND len(list_filter(ls, lambda x: regexp_matches(x, '^ *[•*-]'))) > 0.9 * len(ls))
    OR (len(ls) >= 5 AND len(list_filter(ls, lambda x: regexp_matches(x, '(…|[.][.][.]) *$'))) > 0.5 * len(ls))
    OR (n_words >= 50 AND list_sum(list_transform(range(0, n_words, 1000), lambda i: len(list_distinct(ws[i + 1:i + 1000])))) < 0.05 * n_words)
    OR (n_words >= 20 AND len(regexp_extract_all(' ' || regexp_replace(t, '[\x20\x09-\x0D]+', '  ', 'g') || ' ',
        ' [A-Z][A-Z]+[.,;:!?]* ')) > 0.8 * n_words)
  ) AS kept
FROM b
"""
