"""Markup trees against a DOM of linked objects on broken markup."""

import collections
import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from speechprep.sources import markup


class Node:
    def __init__(self, tag, attrs, up, text=None):
        self.tag, self.attrs, self.up, self.text, self.kids = tag, attrs, up, text, []

    def walk(self):
        for k in self.kids:
            yield k
            yield from k.walk()

    def content(self):
        return "".join(k.text for k in self.walk() if k.tag == "#text").strip()

    def ancestors(self):
        x = self.up
        while x is not None:
            yield x
            x = x.up


class Dom(HTMLParser):
    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node(None, {}, None)
        self.feed(page or "")
        self.close()

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.kids.append(node)
        if tag not in markup.VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        for x in [self.at, *self.at.ancestors()]:
            if x.tag == tag:
                self.at = x.up
                return

    def handle_data(self, data):
        self.at.kids.append(Node("#text", {}, self.at, data))


BITS = ["<div class='a  b'>", "<DIV class=a id=x>", "</div>", "<p>", "</p>", "<p class=\"b\" class='a'>", "<table>", "</table>", "<td>", "</td>", "<br>", "<br/>",
        "<img src=x>", "<a href='/x/1'>", "<a class=internal href=\"/y/z.ogg\" title='t%41'>", "</a>", "text ", " &amp; more", "</span>", "<span lang=zh-Hans-CN>",
        "</nothing>", "<!-- <p> no -->", "<script>if (a < b) '<p>'</script>", "<unclosed attr='", "< not a tag", "日本 𝄞", "\n", "<a href=/q?x=1&amp;y>", "</td", "<>"]


def broken(seed, n=60):
    rnd = random.Random(seed)
    pages = ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]
    return [(i, f"http://h.example/d/{i}", p) for i, p in enumerate([*pages, None, "", "<b>" * 300 + "deep", "plain"])]


def test_nodes_are_the_tree_of_broken_markup(spark):
    rows = broken(1)
    got = collections.defaultdict(list)
    for r in markup.page_nodes(spark.createDataFrame(rows, "page_id int, url string, html string")).collect():
        got[r.page_id].append(r)
    for i, _, page in rows:
        nodes = list(Dom(page).root.walk())
        number = {id(x): k for k, x in enumerate(nodes)}
        want = [(k, number.get(id(x.up)), k + sum(1 for _ in x.walk()), sum(1 for _ in x.ancestors()) - 1, x.tag,
                 None if x.tag == "#text" else x.attrs, x.text) for k, x in enumerate(nodes)]
        assert [tuple(r)[1:] for r in sorted(got[i], key=lambda r: r.node)] == want


def test_selectors_are_joins_of_points_and_ranges(spark):
    rows = broken(2, 120)
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    nodes = markup.page_nodes(pages).cache()
    outer, inner = nodes.where((F.col("tag") == "div") & markup.has_class("a")), nodes.where("tag IN ('a', 'p')")
    pairs = collections.Counter((r.page_id, r.node, r.outer) for r in markup.inside(inner, outer).collect())
    near = {(r.page_id, r.node): r.outer for r in markup.nearest(inner, outer).collect()}
    first = {(r.page_id, r.outer): r.node for r in markup.first_inside(inner.select("page_id", "node", "tag"), outer).collect()}
    content = {(r.page_id, r.node): r.content for r in markup.texts_of(outer, nodes).collect()}
    want, want_near, want_first, want_content = collections.Counter(), {}, {}, {}
    for i, _, page in rows:
        all_ = list(Dom(page).root.walk())
        number = {id(x): k for k, x in enumerate(all_)}
        is_outer = lambda x: x.tag == "div" and "a" in x.attrs.get("class", "").split()
        for k, x in enumerate(all_):
            if x.tag in ("a", "p"):
                above = [number[id(y)] for y in x.ancestors() if y.tag and is_outer(y)]
                want.update((i, k, y) for y in above)
                if above:
                    want_near[i, k] = max(above)
                for y in above:
                    want_first[i, y] = min(k, want_first.get((i, y), k))
            if is_outer(x):
                want_content[i, k] = x.content()
    assert pairs == want and near == want_near and first == want_first and content == want_content and len(want) > 50


def test_ranges_fall_into_blocks(spark):
    cases = [(a, b) for a in (0, 1, 5, 8, 1000) for b in (a, a + 1, a + 6, a + 977, 1 << 20)]
    df = spark.createDataFrame(cases, "a long, b long")
    for r in df.select("a", "b", markup._blocks_of_range(F.col("a"), F.col("b")).alias("x")).collect():
        spans = sorted((y.block << y.level, (y.block + 1) << y.level) for y in r.x)
        assert spans[0][0] == r.a and spans[-1][1] == r.b + 1 and all(p[1] == q[0] for p, q in zip(spans, spans[1:]))
        assert len(spans) <= 2 * 21


def test_links_of_any_attribute_order_and_quotes(spark):
    html = """<a class=x href='/a/b'>one <b>two</b></a><A HREF="/a/b" >zero</A><a title="<a href='/no'>" href=/c/d/e>three</a>
    <a href="http://x.example/">far</a><a name=y>none</a><a href="/f">&lt;four&gt;</a><script>'<a href="/s/t">s</a>'</script>"""
    pages = spark.createDataFrame([(1, "http://h.example/p/q", html)], "page_id int, url string, html string")
    nodes = markup.page_nodes(pages)
    got = {r.link: r.link_text for r in markup.links(pages, nodes).collect()}
    assert got == {"http://h.example/a/b": "one two", "http://h.example/c/d/e": "three", "http://h.example/f": "<four>"}
    assert {r.link for r in markup.links(pages, nodes, min_slashes=2).collect()} == {"http://h.example/a/b", "http://h.example/c/d/e"}


def test_audio_entries_by_player_box_link_and_text(spark):
    page = """<span id=cosmos-title-text> Voice &amp; more </span>
    <table><tr><td><div class="x downloadable-audio"></div><td><a href="/w/A1.ogg" class="internal" title="%E9%9F%B3 0123ABCD.0B2.ogg">f</a>
    <a class=internal href="/w/second.ogg" title=s>s</a><td><span lang='zh-Hans-CN'> a<br>b <i>c</i></span></table>
    <table><tr><td><table><tr><td><div class=downloadable-audio></div></table><a class=internal href=/w/outer.ogg title=o></a></table>
    <div class=downloadable-audio>no table</div>
    <table><div class=downloadable-audio></div><a class=internal href="r/s.ogg?x" title=q></a><a class=other href="t.ogg"></a></table>
    <table><div class=downloadable-audio></div><a class=internal href="r/s.ogg"></a></table>"""
    pages = spark.createDataFrame([(1, "http://h.example/d/e", page), (2, "http://h.example/x", "<p>nothing"), (3, "http://h.example/x", None)],
                                  "page_id int, url string, html string")
    got = [tuple(r) for r in markup.audio_entries(pages, markup.page_nodes(pages)).orderBy("page_id", "entry_idx").collect()]
    assert got == [
        (1, "Voice & more", 0, "0123ABCD", "音 0123ABCD.0B2.ogg", "http://h.example/w/A1.ogg", "ab c"),
        (1, "Voice & more", 1, "s", "", "http://h.example/d/r/s.ogg", "no text"),
    ]
