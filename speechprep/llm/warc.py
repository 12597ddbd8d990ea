"""Operator 2: WARC archives as a chunked record table.

A payload never exists whole in Python.  Spark cuts it into rows (record,
chunk number, data); the writer streams them into WARC/1.1 files, one gzip
member a record, with a digest that grows chunk by chunk and must end at the
announced one; the reader turns the files back into the same kind of rows,
each with the digest of its payload so far.  The digest of a record's last
chunk is the digest of its payload.

Of records with equal payloads of at least 100 bytes the one with the smallest
page_id is a ``response``; the others are ``revisit`` records that refer to it
and carry its digest and length in their header.

Files are written by tasks through the file system of the shared folder; each
task attempt writes files of its own, and only files in the committed manifest
count, so lost executors and repeated attempts leave no trace in the result.

Defined cases: null html is an empty payload; a null url has no target header;
page_ids that repeat with the smallest id of a group are all responses; null
page_ids sort last; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import hot_keys, lookup, pick, shared_dir, table, written

CHUNK = 64 << 10
LEAST_REVISIT = 100
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_DATE = "2000-01-01T00:00:00Z"


def records(pages: DataFrame) -> DataFrame:
    """One row a page: payload, its length and digest, record type, refers_to."""
    d = pick(pages, "page_id", "url", "html").withColumn("payload", F.coalesce(F.col("html"), F.lit("")).cast("binary")).drop("html")
    d = d.withColumns({"n": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    sizes = d.where(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("k"))
    groups = written(sizes.where("k > 1"), "warc-groups")
    hot = hot_keys(groups, "digest", "k", pages.count())
    d = lookup(d, groups.select("digest", "first"), "digest", hot, F.struct("page_id", "url"))
    refers = F.when(F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return d.withColumn("refers_to", refers).drop("first")


def chunks(recs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (record, chunk_no, data); a revisit or empty payload has one empty chunk."""
    last = F.when(F.col("refers_to").isNull(), F.greatest(F.ceil(F.col("n") / chunk) - 1, F.lit(0))).otherwise(0)
    cut = recs.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    data = F.when(F.col("refers_to").isNull(), F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)))
    return cut.select("page_id", "url", "n", "digest", "refers_to", "chunk_no",
                      F.coalesce(data, F.lit(b"")).alias("data"))


def _files(uri: str):
    """File system and path of a folder: any store that pyarrow can open."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def _urn(page) -> str:
    """A page id as a record id; text is escaped, so it can't be taken for null."""
    if page is None:
        return "<urn:x-page:null>"
    return f"<urn:x-page:{page if isinstance(page, int) else '%' + ''.join(f'{b:02x}' for b in str(page).encode())}>"


def _header(page, url, n: int, digest: str, refers) -> bytes:
    kind = "response" if refers is None else "revisit"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_urn(page)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        clean = re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), url)
        lines.append(f"WARC-Target-URI: {clean}")
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response"]
    length = len(_HTTP)
    if refers is None:
        length += n
    else:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_urn(refers)}", f"X-Payload-Length: {n}"]
    lines.append(f"Content-Length: {length}")
    return "\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + _HTTP


class ArchiveWriter:
    """Streams chunk rows into gzip members of one file at a time."""

    def __init__(self, folder: str, task: str, level: int, max_bytes: int):
        self.fs, self.folder = _files(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.uri, self.task, self.level, self.max_bytes = folder, task, level, max_bytes
        self.done: list[tuple] = []
        self.out = None

    def _begin(self) -> None:
        self.name = f"{self.task}-{len(self.done):05d}.warc.gz"
        self.out, self.size, self.n = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0, 0
        self.zip = None

    def _write(self, data: bytes) -> None:
        self.size += len(data)
        self.out.write(data)

    def chunk(self, page, url, n, digest, refers, no: int, data: bytes) -> None:
        if no == 0:
            if self.out is not None and self.size >= self.max_bytes:
                self.close()
            if self.out is None:
                self._begin()
            self.zip, self.sum, self.left = zlib.compressobj(self.level, zlib.DEFLATED, 31), hashlib.sha256(), 0 if refers is not None else n
            self._write(self.zip.compress(_header(page, url, n, digest, refers)))
        self.sum.update(data)
        self.left -= len(data)
        self._write(self.zip.compress(data))
        if self.left == 0:
            if refers is None and self.sum.hexdigest() != digest:
                raise ValueError(f"payload of page {page} does not have its digest")
            self._write(self.zip.compress(b"\r\n\r\n") + self.zip.flush())
            self.n += 1

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.uri}/{self.name}", self.n, self.size))
            self.out = None


def write_archives(pages: DataFrame, folder: str, chunk: int = CHUNK, level: int = 1, max_bytes: int = 1 << 30) -> DataFrame:
    """Write ``pages`` as WARC files under ``folder``; returns the committed
    manifest (file, records, bytes)."""
    spark = pages.sparkSession
    ship_package(spark)

    def run(batches) -> Iterator:
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        c = TaskContext.get()
        w = ArchiveWriter(folder, f"part-{c.partitionId():06d}-{c.attemptNumber()}-{uuid.uuid4().hex[:12]}", level, max_bytes)
        for b in batches:
            cols = [b.column(k) for k in range(7)]
            for k in range(b.num_rows):
                w.chunk(*(x[k].as_py() for x in cols))
        w.close()
        if w.done:
            cols = list(zip(*w.done))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0]), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())],
                                             ["file", "records", "bytes"])

    return written(chunks(records(pages), chunk).mapInArrow(run, "file string, records long, bytes long"), "warc-manifest")


class _Stream:
    """Decompressed bytes of a file of gzip members, read forward in blocks."""

    def __init__(self, raw, block: int = 1 << 16):
        self.raw, self.block, self.buf, self.zip = raw, block, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        data = self.zip.unused_data if self.zip.eof else b""
        if self.zip.eof:
            self.zip = zlib.decompressobj(31)
        data = data or self.zip.unconsumed_tail or self.raw.read(self.block)
        if not data:
            return False
        self.buf += self.zip.decompress(data, 1 << 20)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Bytes up to and including ``mark``; None at the end of the file."""
        seen = 0
        while (at := self.buf.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buf)
            if not self._more():
                return None
        out = bytes(self.buf[: at + len(mark)])
        del self.buf[: at + len(mark)]
        return out

    def some(self, n: int) -> bytes:
        """Exactly ``n`` bytes."""
        while len(self.buf) < n:
            if not self._more():
                raise EOFError("archive ends inside a record")
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


def _page(urn: str | None):
    value = urn.removeprefix("<urn:x-page:").removesuffix(">") if urn else "null"
    if value == "null":
        return None
    return bytes.fromhex(value[1:]).decode() if value.startswith("%") else int(value)


def parse(raw, chunk: int) -> Iterator[tuple]:
    """(page_id, type, refers_to, chunk_no, data, digest so far, bytes so far, last)."""
    s = _Stream(raw)
    while (head := s.until(b"\r\n\r\n")) is not None:
        h = dict(x.split(": ", 1) for x in head.decode("ascii").strip().split("\r\n")[1:])
        http = s.until(b"\r\n\r\n")
        left, no, total, kind = int(h["Content-Length"]) - len(http), 0, 0, h["WARC-Type"]
        page, refers, digest = _page(h["WARC-Record-ID"]), _page(h.get("WARC-Refers-To")), hashlib.sha256()
        if kind == "revisit":
            yield page, kind, refers, 0, b"", h["WARC-Payload-Digest"].split(":")[1], int(h["X-Payload-Length"]), True
        else:
            while True:
                data = s.some(min(chunk, left))
                left, total = left - len(data), total + len(data)
                digest.update(data)
                yield page, kind, None, no, data, digest.hexdigest(), total, left == 0
                no += 1
                if left == 0:
                    break
            if h["WARC-Payload-Digest"] != "sha256:" + digest.hexdigest():
                raise ValueError(f"payload of page {page} does not have its digest")
        s.some(4)


def read_chunks(manifest: DataFrame, chunk: int = CHUNK, batch_bytes: int = 4 << 20, key: str = "long") -> DataFrame:
    """The chunk rows of all archives in a manifest, one task a file at most.
    ``key`` is the type of the page ids: ``long`` or ``string``."""
    spark = manifest.sparkSession
    ship_package(spark)
    text_ids = key == "string"

    def run(batches) -> Iterator:
        import pyarrow as pa

        ids = pa.string() if text_ids else pa.int64()
        types = [ids, pa.string(), ids, pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.bool_()]
        names = ["page_id", "record_type", "refers_to", "chunk_no", "data", "digest_so_far", "bytes_so_far", "last"]
        rows: list[tuple] = []
        size = 0
        for b in batches:
            for file in b.column(0).to_pylist():
                fs, path = _files(file)
                with fs.open_input_stream(path, compression=None) as raw:
                    for r in parse(raw, chunk):
                        rows.append(r)
                        size += len(r[4]) + 200
                        if size >= batch_bytes:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = manifest.select("file")
    return files.repartition(max(1, files.count())).mapInArrow(
        run, f"page_id {key}, record_type string, refers_to {key}, chunk_no int, data binary, digest_so_far string, "
             "bytes_so_far long, last boolean")


def query(spark, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(spark, sf_dir, "pages"), shared_dir(spark, "warc"))
    return read_chunks(manifest).where("last").select(
        "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"),
        "record_type", "refers_to",
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), q AS (
  SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to
FROM q
"""
