"""Tolerant markup trees (G1-G3): pages as node tables, selectors as joins.

:func:`page_nodes` turns pages into one flat table of elements and texts in
document order, with an open-element stack over the tokens of the standard
library's tolerant tokenizer; each page is parsed inside one task and nothing
else happens there.  Everything after that is Spark: an element's subtree is the
range of node numbers ``node .. last``, so "inside" is a join of points and
ranges.  Ranges are cut into dyadic blocks (a range has two a level at most, a
point lies in one a level), so the join is on equal blocks and makes true pairs
only, however many elements a page has.

Tags are closed as a reader expects: void elements at once, an end tag closes
the nearest open element of its name and all inside it, stray end tags are
ignored, open elements end with the page.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import strip
from ..operators.ordered import materialize
from ..session import ship_package

TEXT = "#text"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Tree(HTMLParser):
    """Rows (node, parent, last, depth, tag, attrs, text) of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[tuple[str, int]] = []  # (tag, node)

    def _add(self, tag: str, attrs, text: str | None) -> int:
        node = len(self.rows)
        self.rows.append([node, self.open[-1][1] if self.open else None, node, len(self.open), tag, attrs, text])
        return node

    def handle_starttag(self, tag, attrs):
        found = {}
        for k, v in attrs:
            found.setdefault(k, v or "")  # of an attribute given twice the first counts
        node = self._add(tag, list(found.items()), None)
        if tag not in VOID:
            self.open.append((tag, node))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.open):
            while self._pop() != tag:
                pass

    def _pop(self) -> str:
        tag, node = self.open.pop()
        self.rows[node][2] = len(self.rows) - 1
        return tag

    def handle_data(self, data):
        self._add(TEXT, None, data)

    def finish(self) -> list[list]:
        self.close()
        while self.open:
            self._pop()
        return self.rows


def page_nodes(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, node, parent, last, depth, tag, attrs, text): every element and text
    of every page in document order; ``node .. last`` is an element's subtree.
    Tags and attribute names are lower case; null pages have no nodes."""
    ship_package(pages.sparkSession)

    def run(batches) -> Iterator:
        import pyarrow as pa

        names = ["key", "node", "parent", "last", "depth", "tag", "attrs", "text"]
        types = [None, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]

        def out(cols):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        for b in batches:
            types[0] = b.schema.field(0).type
            cols: list[list] = [[] for _ in names]
            for k, page in zip(b.column(0).to_pylist(), b.column(1)):
                tree = _Tree()
                tree.feed(page.as_py() or "")
                for row in tree.finish():
                    for c, x in zip(cols, (k, *row)):
                        c.append(x)
                if len(cols[0]) > 20_000:
                    yield out(cols)
                    cols = [[] for _ in names]
            if cols[0]:
                yield out(cols)

    kind = pages.schema[key].dataType.simpleString()
    flat = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(
        run, f"key {kind}, node long, parent long, last long, depth long, tag string, attrs map<string,string>, text string")
    return flat.withColumnRenamed("key", key)


def attr(name: str) -> Column:
    """An attribute of a node (null if it has none)."""
    return F.try_element_at(F.col("attrs"), F.lit(name))


def has_class(name: str) -> Column:
    return F.coalesce(F.array_contains(F.split(attr("class"), r"\s+"), name), F.lit(False))


def _blocks_of_range(a: Column, b: Column, levels: int = 31) -> Column:
    """The dyadic blocks (level, number) that make up ``a .. b``."""

    def at(k: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        left, right = F.floor((a + step - 1) / step), F.floor((b + 1) / step)
        none = F.lit(None).cast("struct<level:int,block:bigint>")
        one = lambda n: F.struct(k.alias("level"), n.cast("long").alias("block"))
        return F.array(F.when((left < right) & (left % 2 == 1), one(left)).otherwise(none),
                       F.when((left + left % 2 < right) & (right % 2 == 1), one(right - 1)).otherwise(none))

    every = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), at))
    return F.filter(every, lambda x: x.isNotNull())


def _blocks_of_point(p: Column, levels: int) -> Column:
    """The block of each level that holds ``p``."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(
        k.alias("level"), F.floor(p / F.call_function("shiftleft", F.lit(1).cast("long"), k)).cast("long").alias("block")))


def inside(inner: DataFrame, outer: DataFrame, key: str = "page_id", outer_node: str = "outer") -> DataFrame:
    """``inner`` nodes with each node of ``outer`` that they lie in (its number
    as ``outer_node``).  One small job first finds the longest range, above
    whose level no block occurs."""
    longest = outer.agg(F.max(F.col("last") - F.col("node"))).first()[0] or 0
    levels = int(longest).bit_length()
    ranges = outer.where(F.col("last") > F.col("node")).select(
        key, F.col("node").alias(outer_node), F.explode(_blocks_of_range(F.col("node") + 1, F.col("last"), levels)).alias("_b"))
    points = inner.withColumn("_b", F.explode(_blocks_of_point(F.col("node"), levels)))
    return points.join(ranges, [key, "_b"]).drop("_b")


def nearest(inner: DataFrame, outer: DataFrame, key: str = "page_id", outer_node: str = "outer") -> DataFrame:
    """(key, node, outer_node): of each ``inner`` node the innermost ``outer``
    node around it."""
    return inside(inner.select(key, "node"), outer, key, outer_node).groupBy(key, "node").agg(F.max(outer_node).alias(outer_node))


def first_inside(inner: DataFrame, outer: DataFrame, key: str = "page_id", outer_node: str = "outer") -> DataFrame:
    """Of each ``outer`` node the first ``inner`` node in it, with its columns."""
    found = inside(inner, outer, key, outer_node)
    rest = [c for c in inner.columns if c != key]
    return found.groupBy(key, outer_node).agg(F.min_by(F.struct(*rest), "node").alias("_f")).select(key, outer_node, "_f.*")


def texts_of(elements: DataFrame, nodes: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, node, content): all text inside each element, in order, stripped.
    One element's text is one value."""
    texts = nodes.where(F.col("tag") == TEXT).select(key, "node", "text")
    pieces = inside(texts, elements, key, "element").groupBy(key, "element").agg(
        F.sort_array(F.collect_list(F.struct("node", "text"))).alias("_t"))
    content = strip(F.array_join(F.transform("_t", lambda x: x["text"]), ""))
    out = pieces.select(key, F.col("element").alias("node"), content.alias("content"))
    return elements.select(key, "node").join(out, [key, "node"], "left").select(key, "node", F.coalesce("content", F.lit("")).alias("content"))


def links(pages: DataFrame, nodes: DataFrame, prefix: str = "/", min_slashes: int = 1, key: str = "page_id", url: str = "url") -> DataFrame:
    """Distinct absolute links per page whose href starts with ``prefix`` and
    holds ``min_slashes`` slashes or more, with the least of their texts (G1):
    any attribute order, quotes and nested markup."""
    href = attr("href")
    found = nodes.where((F.col("tag") == "a") & href.startswith(prefix)).withColumn("href", href)
    found = found.where(F.length("href") - F.length(F.replace("href", F.lit("/"), F.lit(""))) >= min_slashes)
    named = found.join(texts_of(found, nodes, key), [key, "node"]).select(key, "href", "content")
    named = named.join(pages.select(key, url), key)
    return named.groupBy(key, urls.join_url(F.col(url), F.col("href")).alias("link")).agg(F.min("content").alias("link_text"))


def audio_entries(pages: DataFrame, nodes: DataFrame, key: str = "page_id", url: str = "url", player: str = "downloadable-audio",
                  box: str = "table", link_class: str = "internal", link_end: str = ".ogg", lang: str = "zh-Hans-CN",
                  title_id: str = "cosmos-title-text", id_re: str = r"([A-F0-9]{8})\.0B2",
                  default_title: str = "unknown title", default_text: str = "no text") -> DataFrame:
    """One row per audio entry of a page (G2): for each player element the
    nearest ``box`` around it, in that box the first link of the class whose
    address ends with ``link_end``, and the first span in ``lang``.

    Columns: title (text of the element with ``title_id``, or the default),
    entry_idx (in page order, over the entries found), entry_id (by ``id_re``
    from the file name, else the address' last part), filename, audio_url, text.
    Players without a box or link give no entry, as there is nothing to load."""
    wanted = nodes.where(F.col("tag") != TEXT)
    players = wanted.where((F.col("tag") == "div") & has_class(player))
    boxes = wanted.where(F.col("tag") == box)
    around = materialize(nearest(players, boxes, key, "box").withColumnRenamed("node", "player"))
    used = materialize(boxes.join(around.select(key, F.col("box").alias("node")).distinct(), [key, "node"], "left_semi").select(key, "node", "last"))
    anchors = wanted.where((F.col("tag") == "a") & has_class(link_class) & attr("href").endswith(link_end)).select(
        key, "node", "last", attr("href").alias("href"), F.coalesce(attr("title"), F.lit("")).alias("link_title"))
    spans = wanted.where((F.col("tag") == "span") & (attr("lang") == lang)).select(key, "node", "last")
    link = first_inside(anchors, used, key, "box").select(key, "box", "href", "link_title")
    span = materialize(first_inside(spans, used, key, "box").select(key, "box", "node", "last"))
    heads = wanted.where((F.col("tag") == "span") & (attr("id") == title_id))
    heads = heads.groupBy(key).agg(F.min_by(F.struct("node", "last"), "node").alias("h")).select(key, "h.*")
    # the texts of titles and entries at once
    content = texts_of(span.select(key, "node", "last").unionByName(heads).distinct(), nodes, key)
    text = span.join(content, [key, "node"]).select(key, "box", "content")
    title = heads.join(content, [key, "node"]).select(key, F.col("content").alias("title"))
    found = around.join(link, [key, "box"]).join(text, [key, "box"], "left").join(pages.select(key, url), key).join(title, key, "left")
    address, name = urls.join_url(F.col(url), F.col("href")), urls.percent_decode(F.col("link_title"))
    found = found.select(key, "player", F.coalesce("title", F.lit(default_title)).alias("title"), name.alias("filename"),
                         address.alias("audio_url"), F.coalesce("content", F.lit(default_text)).alias("text"))
    by_name = F.regexp_extract("filename", id_re, 1)
    by_address = F.regexp_extract(urls.percent_decode(F.col("audio_url")), r"/([^/]+?)\.ogg", 1)
    # entries of one page: a page is one row of the input, so this window is bounded by it
    idx = F.row_number().over(Window.partitionBy(key).orderBy("player")) - 1
    return found.withColumn("entry_idx", idx.cast("bigint")).select(
        key, "title", "entry_idx",
        F.when(by_name != "", by_name).when(by_address != "", by_address).otherwise(
            F.concat(F.lit("unknown_"), F.col("entry_idx").cast("string"))).alias("entry_id"),
        "filename", "audio_url", "text")
