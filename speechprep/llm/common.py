"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Java/RE2 class of the white space that separates words in all contracts.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: it cuts lineage and
    survives lost executors, and later uses do not compute it again."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables made by :func:`written` that nothing reads any more."""
    for df in tables:
        jvm, path = df.sparkSession._jvm, df.written_to
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Columns by exact name and nothing else, whatever other columns exist
    (also names that differ only in case, or a name given twice: the first
    one counts)."""
    have = df.columns
    return df.toDF(*[f"c{i}" for i in range(len(have))]).select(
        *[F.col(f"c{have.index(n)}").alias(n) for n in names]
    )


def boxed(df: DataFrame, *names: str) -> DataFrame:
    """``names`` by exact name, and every column of ``df`` in order inside one
    struct column ``_row`` (fields ``c0, c1, ...``), so that an operator's own
    columns never clash with extra input columns.  :func:`unboxed` undoes it."""
    have = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(have))])
    return plain.select(
        F.struct(*[F.col(f"c{i}") for i in range(len(have))]).alias("_row"),
        *[F.col(f"c{have.index(n)}").alias(n) for n in names],
    )


def unboxed(df: DataFrame, columns: list[str], **replace: Column) -> DataFrame:
    """The original ``columns`` of a :func:`boxed` frame; ``replace`` gives new
    values for the first column of a name."""
    done: set[str] = set()
    out = []
    for i, c in enumerate(columns):
        fresh = c in replace and c not in done
        done.add(c)
        out.append((replace[c] if fresh else F.col(f"_row.c{i}")).alias(c))
    return df.select(*out)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a lambda is computed again for every array element;
    bound through a one-element array it is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(array: Column) -> Column:
    """Sum of an array of longs."""
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: At most this many keys can each hold ``1 / HOT_SHARE`` of all rows, so the
#: collected list of hot keys has a proven bound, whatever the data.
HOT_SHARE = 256


def hot_keys(counts: DataFrame, key: str, n: str, rows: int) -> list:
    """Keys that hold at least ``rows / HOT_SHARE`` rows (``HOT_SHARE`` keys at most)."""
    least = max(2, -(-rows // HOT_SHARE))
    return [r[0] for r in counts.where(F.col(n) >= least).select(key).collect()]


def lookup(rows: DataFrame, values: DataFrame, key: str, hot: list, by: Column) -> DataFrame:
    """Left join of many ``rows`` to ``values`` (one row a key); the rows of a
    hot key are dealt over salts by ``by`` and its one value row is repeated
    for each salt, so no task gets a hot key whole."""
    if not hot:
        return rows.join(values, key, "left")
    salts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    left = rows.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")).otherwise(0))
    right = values.withColumn(
        "_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    )
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def running(pairs: Column, chunk: int = 512) -> Column:
    """Spans of consecutive (gap, len) pairs: an array of (start, end) structs.

    Offsets are summed per chunk first and then inside each chunk, so the work
    grows with the number of pairs (times the fixed chunk), not its square."""
    long0 = F.lit(0).cast("long")
    sums = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / chunk).cast("int")),
        lambda c: total(F.transform(F.slice(pairs, c * chunk + 1, chunk), lambda x: x["gap"] + x["len"])),
    )
    offsets = F.aggregate(
        sums, F.struct(long0.alias("at"), F.expr("CAST(array() AS array<bigint>)").alias("out")),
        lambda a, x: F.struct((a["at"] + x).alias("at"), F.array_append(a["out"], a["at"]).alias("out")),
    )["out"]
    empty = F.expr("CAST(array() AS array<struct<start:bigint,end:bigint>>)")
    inside = lambda at, c: F.aggregate(
        F.slice(pairs, c * chunk + 1, chunk),
        F.struct(at.alias("at"), empty.alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["gap"] + x["len"]).alias("at"),
            F.array_append(
                a["out"],
                F.struct((a["at"] + x["gap"]).alias("start"), (a["at"] + x["gap"] + x["len"]).alias("end")),
            ).alias("out"),
        ),
    )["out"]
    return F.flatten(F.transform(offsets, inside))


def running_max(values: Column, chunk: int = 256) -> Column:
    """For each long of an array the greatest so far, chunk by chunk like
    :func:`running`."""
    least = F.lit(-(1 << 63)).cast("long")
    fold = lambda xs, first, step: F.aggregate(
        xs, F.struct(first.alias("far"), F.expr("CAST(array() AS array<bigint>)").alias("out")), step)["out"]
    ahead = lambda cs: fold(
        cs, least, lambda a, c: F.struct(F.greatest(a["far"], F.array_max(c)).alias("far"), F.array_append(a["out"], a["far"]).alias("out")))
    inside = lambda c, first: fold(
        c, first, lambda a, x: F.struct(F.greatest(a["far"], x).alias("far"), F.array_append(a["out"], F.greatest(a["far"], x)).alias("out")))

    def scanned(v: Column) -> Column:
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(v) - 1) / chunk).cast("int")), lambda c: F.slice(v, c * chunk + 1, chunk))
        some = let(chunks, lambda cs: let(ahead(cs), lambda starts: F.flatten(F.transform(cs, lambda c, k: inside(c, F.get(starts, k))))))
        return F.when(F.size(v) == 0, F.expr("CAST(array() AS array<bigint>)")).otherwise(some)

    return let(values, scanned)


MATCHES = "array<struct<start:bigint,end:bigint,match:string,left:string>>"


def matches(text: Column, pattern: Column, left: int = 48) -> Column:
    """All matches of ``pattern`` in order: code-point start and end, the match
    and up to ``left`` characters before it.  ``pattern`` must not match the
    empty string.  Built from the matches and the text between them, so the
    cost grows with the text."""

    def located(found: Column) -> Column:
        def spans(gaps: Column) -> Column:
            pairs = F.transform(
                found, lambda m, k: F.struct(
                    F.length(F.get(gaps, k)).cast("long").alias("gap"), F.length(m).cast("long").alias("len")
                )
            )
            return let(
                let(pairs, lambda p: running(p)),
                lambda at: F.transform(
                    at, lambda s, k: F.struct(
                        s["start"].alias("start"), s["end"].alias("end"),
                        F.get(found, k).alias("match"), F.right(F.get(gaps, k), F.lit(left)).alias("left"),
                    )
                ),
            )

        return F.when(F.size(found) == 0, F.expr(f"CAST(array() AS {MATCHES})")).otherwise(
            let(F.split(text, pattern, -1), spans)
        )

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), located)
