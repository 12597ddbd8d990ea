"""File trees as Spark data sources.

``file_catalog`` lists a tree: directories are planned as partitions, so that
tasks, not the driver, walk them, and filters on extension, size and time are
applied while listing.  ``member_files`` writes files in two phases: a task
attempt puts its members into a directory of its own, and one small commit file
names the attempts that count.  Members of killed, repeated or aborted attempts
are in no commit, so no reader sees them, and nothing is renamed.  Trees lie on
whatever ``pyarrow.fs`` opens by URI: local paths, ``s3://``, ``gs://``,
``hdfs://``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage)

from ..session import ship_package

SCHEMA = "path string, name string, ext string, bytes long, mtime timestamp"
MEMBERS, COMMITS = "members", "commits"


def _opened(uri: str):
    """(filesystem, path) of a folder given as path or URI."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.rstrip("/")
    if uri.startswith("file:") and "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    found, path = fs.FileSystem.from_uri(uri)
    return found, path.rstrip("/")


def _listed(fs_, path: str) -> tuple[list, list]:
    """Files and directories right below ``path`` (none if it is absent)."""
    from pyarrow import fs

    found = fs_.get_file_info(fs.FileSelector(path, recursive=False, allow_not_found=True))
    files = [x for x in found if x.type == fs.FileType.File]
    return files, [x.path for x in found if x.type == fs.FileType.Directory]


@dataclass
class _Part(InputPartition):
    """Directories to list: each with or without what lies below it."""

    dirs: list

    def __init__(self, dirs):
        self.dirs = dirs


_ORDERED = {GreaterThan: lambda x, y: x > y, GreaterThanOrEqual: lambda x, y: x >= y, LessThan: lambda x, y: x < y, LessThanOrEqual: lambda x, y: x <= y}


class CatalogReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.parts = int(options.get("partitions", "64"))
        self.depth = int(options.get("depth", "3"))
        self.tests: list[tuple] = []  # (column, filter class, value)

    def pushFilters(self, filters):
        """Keep what a file's name, size and time can answer; give back the rest."""
        for f in filters:
            column = ".".join(f.attribute) if hasattr(f, "attribute") else ""
            if isinstance(f, IsNotNull):
                continue  # no column is ever null
            if isinstance(f, (EqualTo, In)) and column in ("ext", "name") or type(f) in _ORDERED and column in ("bytes", "mtime"):
                self.tests.append((column, type(f), f.value))
            else:
                yield f

    def partitions(self):
        """Whole directories, or the files right in one that was opened to find
        more; only the upper ``depth`` levels are listed here."""
        fs_, root = _opened(self.root)
        own, whole = [], [root]
        for _ in range(self.depth):
            if len(whole) >= self.parts:
                break
            below = []
            for d in whole:
                own.append((d, False))
                below += _listed(fs_, d)[1]
            whole = below
        found = own + [(d, True) for d in sorted(whole)]
        n = max(1, min(self.parts, len(found)))
        return [_Part(found[k::n]) for k in range(n)]

    def _keeps(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            x = row[column]
            ok = x == value if kind is EqualTo else x in value if kind is In else _ORDERED[kind](x, value)
            if not ok:
                return False
        return True

    def read(self, partition) -> Iterator[tuple]:
        from datetime import datetime, timezone

        fs_, root = _opened(self.root)
        todo = list(partition.dirs)
        while todo:
            d, deep = todo.pop()
            files, below = _listed(fs_, d)
            todo += [(x, True) for x in below] if deep else []
            for info in files:
                name = info.base_name
                mtime = datetime.fromtimestamp((info.mtime_ns or 0) / 1e9, timezone.utc)
                row = {"path": info.path[len(root) + 1:], "name": name, "ext": name.rsplit(".", 1)[1] if "." in name else "",
                       "bytes": info.size, "mtime": mtime}
                if self._keeps(row):
                    yield tuple(row.values())


class FileCatalog(DataSource):
    """``spark.read.format("file_catalog").load(root)``: one row a file; ``path``
    is relative to the root.  Options: ``partitions`` (tasks at most), ``depth``
    (levels listed while planning)."""

    @classmethod
    def name(cls):
        return "file_catalog"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return CatalogReader(self.options)


@dataclass
class _Written(WriterCommitMessage):
    attempt: str
    members: int
    bytes: int


class MemberWriter(DataSourceArrowWriter):
    def __init__(self, root: str, job: str):
        self.root, self.job = root, job

    def write(self, iterator):
        """Members of this attempt, in a directory that no other attempt uses."""
        fs_, root = _opened(self.root)
        attempt, n, size = f"{self.job}-{uuid.uuid4().hex}", 0, 0
        made = set()
        for batch in iterator:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                full = f"{root}/{MEMBERS}/{attempt}/{path}"
                folder = full.rsplit("/", 1)[0]
                if folder not in made:
                    fs_.create_dir(folder, recursive=True)
                    made.add(folder)
                with fs_.open_output_stream(full, compression=None) as out:
                    out.write(content if isinstance(content, bytes) else (content or "").encode("utf-8", "surrogatepass"))
                n += 1
                size += fs_.get_file_info(full).size
        return _Written(attempt, n, size)

    def commit(self, messages):
        """One file makes all members visible: it is written under another name
        and moved, so no reader sees half of it."""
        fs_, root = _opened(self.root)
        done = [m for m in messages if m and m.members]
        fs_.create_dir(f"{root}/{COMMITS}", recursive=True)
        text = "".join(json.dumps({"version": time.time_ns(), "job": self.job, "attempt": m.attempt, "members": m.members, "bytes": m.bytes}) + "\n"
                       for m in done)
        part, final = f"{root}/{COMMITS}/.{self.job}", f"{root}/{COMMITS}/{self.job}.json"
        with fs_.open_output_stream(part, compression=None) as out:
            out.write(text.encode())
        fs_.move(part, final)

    def abort(self, messages):
        fs_, root = _opened(self.root)
        for m in messages:
            if m:
                fs_.delete_dir(f"{root}/{MEMBERS}/{m.attempt}")


class MemberFiles(DataSource):
    """Sink for rows (path, content); see :func:`write_members`."""

    @classmethod
    def name(cls):
        return "member_files"

    def writer(self, schema, overwrite):
        return MemberWriter(self.options["path"], self.options["job"])


def _register(spark: SparkSession) -> None:
    ship_package(spark)
    for source in (FileCatalog, MemberFiles):
        spark.dataSource.register(source)


def list_files(spark: SparkSession, root: str, **options) -> DataFrame:
    """The files under ``root``; filters on ext, name, bytes and mtime are
    applied while listing."""
    _register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("file_catalog").options(**options).load(root)


def write_members(rows: DataFrame, root: str) -> str:
    """Write rows (path, content) as files and publish them with one commit;
    returns the commit's job name.  A path written again replaces the earlier
    one for readers."""
    _register(rows.sparkSession)
    job = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows.select("path", "content").write.format("member_files").mode("append").option("job", job).save(root)
    return job


def members(spark: SparkSession, root: str) -> DataFrame:
    """(path, file, ext, bytes, mtime, job): the published members, of each path
    the one committed last.  ``file`` is relative to ``root``."""
    fs_, path = _opened(root)
    if not any(x.base_name.endswith(".json") for x in _listed(fs_, f"{path}/{COMMITS}")[0]):
        return spark.createDataFrame([], "path string, file string, ext string, bytes long, mtime timestamp, job string")
    kind = "version long, job string, attempt string, members long, bytes long"
    commits = spark.read.schema(kind).json(f"{root}/{COMMITS}/*.json").select("attempt", "version", "job")
    files = list_files(spark, f"{root}/{MEMBERS}")
    split = files.select(F.substring_index("path", "/", 1).alias("attempt"), F.expr("substring(path, instr(path, '/') + 1)").alias("path"),
                         F.concat(F.lit(f"{MEMBERS}/"), "path").alias("file"), "ext", "bytes", "mtime")
    known = split.join(commits, "attempt")
    last = Window.partitionBy("path").orderBy(F.desc("version"), F.desc("file"))
    return known.withColumn("_k", F.row_number().over(last)).where("_k = 1").select("path", "file", "ext", "bytes", "mtime", "job")


def vacuum(spark: SparkSession, root: str, older_than_seconds: float = 86_400) -> int:
    """Delete attempt directories that no commit names and that are older than a
    running job can be; returns how many."""
    fs_, path = _opened(root)
    kept = set()
    for x in _listed(fs_, f"{path}/{COMMITS}")[0]:
        with fs_.open_input_stream(x.path) as f:
            kept |= {json.loads(line)["attempt"] for line in f.read().decode().splitlines()}
    gone = 0
    for d in _listed(fs_, f"{path}/{MEMBERS}")[1]:
        name = d.rsplit("/", 1)[1]
        if name not in kept and time.time_ns() - int(name.split("-")[0]) > older_than_seconds * 1e9:
            fs_.delete_dir(d)
            gone += 1
    return gone
