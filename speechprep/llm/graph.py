"""Connected components of an edge list, as Spark jobs.

Edges are dealt to tasks of at most ``per_task`` edges; each task replaces its
edges by a spanning forest of stars (a small union-find).  Once all edges fit
one task the stars are the answer; until then every node hooks to its least
neighbour, paths are halved by joins, and the edges between the resulting
roots, without repeats, go into the next round.  Edges and labels stay in
tables in the shared folder; nothing is collected but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import hot_keys, lookup, written


def _stars(batches) -> Iterator:
    import numpy as np
    import pyarrow as pa

    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    if parent:
        nodes = np.fromiter(parent, dtype=np.int64, count=len(parent))
        roots = np.fromiter(map(root, list(parent)), dtype=np.int64, count=len(parent))
        keep = nodes != roots
        yield pa.RecordBatch.from_arrays([pa.array(nodes[keep]), pa.array(roots[keep])], ["u", "v"])


def components(edges: DataFrame, per_task: int = 1 << 18) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long); the component
    is its least node."""
    ship_package(edges.sparkSession)
    e = written(edges.select("u", "v").where("u <> v"), "edges")
    m, maps = e.count(), []
    while True:
        parts = max(1, -(-m // per_task))
        stars = written(e.repartition(parts).mapInArrow(_stars, "u long, v long"), "stars")
        if parts == 1:
            maps.append(stars.select(F.col("u").alias("node"), F.col("v").alias("root")))
            break
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooked = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("p")), "hooked")
        while True:  # every node ends at its root
            n = hooked.count()
            hot = hot_keys(hooked.groupBy("p").agg(F.count("*").alias("n")), "p", "n", n)
            up = hooked.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            jumped = written(lookup(hooked, up, "p", hot, F.col("u")).select("u", "p", F.coalesce("pp", "p").alias("pp")), "jumped")
            moved = jumped.where("p <> pp").limit(1).count()
            hooked = jumped.select("u", F.col("pp").alias("p"))
            if not moved:
                break
        maps.append(hooked.where("u <> p").select(F.col("u").alias("node"), F.col("p").alias("root")))
        to = hooked.select("u", "p")
        left = stars.join(to, "u").select(F.col("p").alias("a"), F.col("v").alias("u"))
        right = left.join(to, "u").select("a", F.col("p").alias("b")).where("a <> b")
        e = written(right.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
        m = e.count()
        if m == 0:
            break
    nodes = edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct()
    out = nodes.withColumn("component", F.col("node"))
    for k in maps:
        n = out.count()
        hot = hot_keys(out.groupBy("component").agg(F.count("*").alias("n")), "component", "n", n)
        step = k.select(F.col("node").alias("component"), "root")
        out = written(lookup(out, step, "component", hot, F.col("node")).select(
            "node", F.coalesce("root", "component").alias("component")), "components")
    return out
