"""File trees: listed catalogs and published members."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..session import checkpoint_dir
from ..sources import files
from .registry import query


def _root(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


def _clips(t: Tables):
    texts = t.documents.select("doc_id", "text")
    return t.v_audio.select("doc_id", "path").join(texts, "doc_id").select("doc_id", "path", F.col("text").alias("content"))


@query("list_catalog", ["v_audio"], """
SELECT a.path, a.album, a.ext, strlen(d.text) AS bytes FROM v_audio a JOIN documents d ON a.doc_id = d.doc_id
WHERE a.ext IN ('wav', 'mp3', 'flac') AND strlen(d.text) >= 500
""")
def list_catalog(t: Tables):
    """Every document becomes a file; the tree is listed with pushed filters."""
    root = _root(t, "catalog")
    files.write_members(_clips(t), root)
    tree = files.list_files(t.spark, f"{root}/{files.MEMBERS}").where("ext IN ('wav', 'mp3', 'flac') AND bytes >= 500")
    path = F.expr("substring(path, instr(path, '/') + 1)")
    return tree.select(path.alias("path"), F.split(path, "/")[1].alias("album"), "ext", "bytes")


@query("publish_members", ["v_audio"], """
SELECT a.path, a.ext, CASE WHEN a.doc_id % 3 = 0 THEN 2 ELSE 1 END * strlen(d.text) AS bytes, a.doc_id % 3 = 0 AS replaced
FROM v_audio a JOIN documents d ON a.doc_id = d.doc_id
""")
def publish_members(t: Tables):
    """Two commits: all clips, then every third one again with other content."""
    root, clips = _root(t, "members"), _clips(t)
    files.write_members(clips, root)
    again = clips.where("doc_id % 3 = 0").withColumn("content", F.concat("content", "content"))
    job = files.write_members(again, root)
    return files.members(t.spark, root).select("path", "ext", "bytes", (F.col("job") == job).alias("replaced"))
