"""Page operators: archives and main text."""

import collections
import hashlib
import html
import io
import re

import pytest
from pyspark.sql import functions as F

from speechprep.llm import extract, warc
from speechprep.llm.common import shared_dir

from .conftest import SF

SCHEMA = "page_id long, url string, html string"
PAGES = [
    (1, "http://a.example/x", None), (2, None, ""), (3, "http://a.example/\né y", "short"), (4, "odd", "z" * 300_000),
    (5, "http://a.example/5", "same body " * 20), (6, "http://b.example/6", "same body " * 20), (None, "u", "same body " * 20),
    (7, "u", "WARC/1.1\r\n\r\nfake\r\n\r\n" * 20), (3, "http://a.example/again", "short"), (8, "u", "日本語 𝄞 " * 50),
]


def written_back(spark, pages, **options):
    manifest = warc.write_archives(spark.createDataFrame(pages, SCHEMA).repartition(3), shared_dir(spark, "warc-test"), **options)
    return manifest, warc.read_chunks(manifest, chunk=options.get("chunk", warc.CHUNK))


@pytest.mark.parametrize("chunk", [1 << 16, 1000])
def test_archives_round_trip(spark, chunk):
    manifest, rows = written_back(spark, PAGES, chunk=chunk, max_bytes=200)
    assert manifest.count() > 3  # files roll over
    got = collections.defaultdict(list)
    for r in rows.collect():
        assert len(r.data) <= chunk
        got[r.page_id, r.record_type].append(r)
    payloads = collections.Counter()
    for (page, kind), parts in got.items():
        parts.sort(key=lambda r: r.chunk_no)
        if kind == "response" and sum(r.last for r in parts) == 1:
            body, digest = b"", hashlib.sha256()
            for k, r in enumerate(parts):
                body += r.data
                digest.update(r.data)
                assert (r.chunk_no, r.digest_so_far, r.bytes_so_far, r.last) == (k, digest.hexdigest(), len(body), k == len(parts) - 1)
            payloads[page, body.decode()] += 1
    want = {(p, h or "") for p, _, h in PAGES if p in (1, 2, 4, 5, 7, 8)}
    assert want <= set(payloads)
    revisits = {(r.page_id, r.refers_to) for r in rows.where("record_type = 'revisit'").collect()}
    assert revisits == {(6, 5), (None, 5)}


def test_archive_file_is_warc(spark):
    manifest, _ = written_back(spark, [(1, "http://a.example/", "hello")])
    import zlib

    raw = open(manifest.first().file.removeprefix("file:"), "rb").read() if manifest.first().file.startswith("file:") else open(manifest.first().file, "rb").read()
    text = zlib.decompressobj(31).decompress(raw).decode()
    head, http, body = text.split("\r\n\r\n", 2)
    assert head.startswith("WARC/1.1\r\nWARC-Type: response\r\n") and "WARC-Target-URI: http://a.example/" in head
    length = int(re.search(r"Content-Length: (\d+)", head)[1])
    assert len(http) + 4 + length - len(http) - 4 == length and body == "hello\r\n\r\n"
    assert [r[4] for r in warc.parse(io.BytesIO(raw), 3)] == [b"hel", b"lo"]


def test_archives_of_pages_with_text_ids(spark):
    ids = ["a/b <1>", "null", "é\r\n日本", "", "7", None]
    pages = spark.createDataFrame([(p, f"http://h/{k}", ("body " * 30) if k % 2 else f"own {k}") for k, p in enumerate(ids)], "page_id string, url string, html string")
    manifest = warc.write_archives(pages.withColumn("digest", F.lit("x")).withColumn("n", F.lit(1)), shared_dir(spark, "warc-text"))
    got = {(r.page_id, r.record_type, r.refers_to) for r in warc.read_chunks(manifest, key="string").where("last").collect()}
    first = min(p for k, p in enumerate(ids) if k % 2 and p is not None)
    assert {p for p, _, _ in got} == set(ids)
    assert {(p, r) for p, kind, r in got if kind == "revisit"} == {(p, first) for k, p in enumerate(ids) if k % 2 and p != first}


def test_archive_query_and_empty_table(spark, con):
    got = sorted(map(tuple, warc.query(spark, SF).collect()))
    assert got == sorted(con.execute(warc.ORACLE).fetchall())
    assert written_back(spark, [])[1].count() == 0


def test_damaged_payload_is_noticed(spark):
    import zlib

    good = zlib.compress(b"", wbits=31)
    head = warc._header(1, "u", 5, hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(good + zlib.compress(head + b"hello\r\n\r\n", wbits=31)), 10))


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">menu</a></ul></nav><!-- <p>no</p> --><div class="ad banner"><p>buy</div><header>head</header>
<div class='cookie-notice'>cookies</div><main><article><h1>Title &amp; more</h1><p class="lead" data-x="a>b">One<b>two</b>&nbsp;three
  four<p>Five &lt;tag&gt;<br>six</p><ul><li>item</li></ul><form><input value="q"><p>mail</p></form><aside>side</aside>
<blockquote>quote</blockquote></article></main><section id="comments"><article class="comment">bad</article></section>
<footer>&copy; foot</footer></body></html>"""


def test_article_text():
    assert extract.main_texts([ARTICLE]) == ["Title & more\nOnetwo three four\nFive <tag> six\nitem\nquote"]


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a<p>b", "a\nb"), ("a < b & c", "a < b & c"),
    ("<p>x</p><!-- open", "x"), ("<script>never closed", ""), ("<div><p>a</div>b", "a\nb"), ("<p title='x>y'>a</p>", "a"),
    ("<p title=\"open>a</p><p>b</p>", "a\nb"), ("<b>" * 3000 + "deep", "deep"), ("</article></div>a", "a"),
    ("<div class=ad>open ad<article>text</article>", "text"), ("&#8364;&eacute;&unknown;", "€é&unknown;"),
    ("<div hidden>a</div><div style='display: none'>b</div>c", "c"), ("<ARTICLE><P>A</P></ARTICLE>", "A"),
])
def test_markup_cases(page, text):
    assert extract.main_texts([page]) == [text]


def test_host_repeats_are_cut_where_markup_is_silent():
    boiler = "all of this text stands on each and every page of the host"
    pages = [f"<div>{boiler}</div><div>page {k} has its own words number {k * 7} here</div><p>{boiler} but this run {k} is new</p>" for k in range(4)]
    got = extract.main_texts(pages)
    assert got == [f"page {k} has its own words number {k * 7} here\n{k} is new" for k in range(4)]
    assert extract.main_texts([pages[0]] * 3) == [extract.main_texts([pages[0]])[0]] * 3  # one page three times
    inside = [f"<article><p>{boiler}</p><p>{k}</p></article>" for k in range(3)]
    assert extract.main_texts(inside) == [f"{boiler}\n{k}" for k in range(3)]


def test_repeated_matches_a_brute_force_search():
    import random

    rnd = random.Random(3)
    for _ in range(40):
        streams = [[rnd.randrange(3) for _ in range(rnd.randint(0, 25))] for _ in range(4)]
        owner, least = [0, 1, 1, 2], rnd.randint(2, 6)
        covered = extract.repeated(streams, owner, least).tolist()
        at = 0
        for s, o in zip(streams, owner):
            want = [False] * len(s)
            for i in range(len(s) - least + 1):
                if any(p != o and s[i:i + least] == t[j:j + least] for t, p in zip(streams, owner) for j in range(len(t) - least + 1)):
                    want[i:i + least] = [True] * least
            assert covered[at:at + len(s)] == want
            at += len(s) + 1


def test_extract_query(spark, con):
    rows = extract.query(spark, SF).collect()
    pages = {p: (u, h) for p, u, h in con.execute("SELECT page_id, url, html FROM pages").fetchall()}
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search(r"<article>(.*)</article>", pages[r.page_id][1], re.S)[1].replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert (r.url, r.text) == (pages[r.page_id][0], "\n".join(x for x in parts if x)) and r.n_chars == len(r.text)


def test_host_repeats_do_not_depend_on_the_split(spark):
    notice = "this notice was put into every article of the site by its owners"
    quote = "a passage that only some few of the pages of this host quote"
    own = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    html_of = {
        "a": [f"<div>{notice}</div><p>{own(k)}</p>" for k in range(30)],  # no article
        "b": [f"<article><p>{own(k)}</p><p>{notice}</p>{f'<p>{quote}</p>' if k < 104 else ''}</article>" for k in range(100, 140)],
        "c": [f"<article><p>{notice} {quote}</p><p>copy {k}</p></article>" for k in range(20)],  # copies stay whole
        "d": [f"<div>{notice}</div><p>{own(999)}</p>"] * 40,  # one page many times
    }
    rows = [(k, f"http://{h}.example/{k}", p) for h, ps in html_of.items() for k, p in enumerate(ps)]
    want = {f"http://{h}.example/{k}": t for h, ps in html_of.items() for k, t in enumerate(extract.main_texts(ps))}
    assert want["http://a.example/7"] == own(7) and want["http://b.example/9"] == own(109)
    assert want["http://b.example/2"] == f"{own(102)}\n{quote}" and notice in want["http://c.example/3"] and notice in want["http://d.example/3"]
    for parts, group_bytes in ((1, 8 << 20), (9, 500)):
        pages = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        got = {r.url: r.text for r in extract.extract(pages, group_bytes=group_bytes).collect()}
        assert got == want


def test_equal_hashes_of_different_windows_are_told_apart(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(extract, "_mixed", lambda x: x % np.uint64(5))
    notice = "this notice was put into every article of the site by its owners"
    pages = [f"<div>{notice if k % 2 else 'some other words that are on no more than one'}</div><p>{k} " + " ".join(f"w{k}x{i}" for i in range(30)) + "</p>"
             for k in range(12)]
    n = len(pages)
    batch = pa.record_batch({
        "page_id": pa.array(range(n), pa.int64()), "url": pa.array([f"u{k}" for k in range(n)]), "key": pa.array(range(n), pa.int64()),
        "counts": pa.array([1] * n, pa.int64()), "host": pa.array(["h"] * n), "chunk": pa.array([0] * n, pa.int32()),
        "first": pa.array([0] * n, pa.int32()), "pages": pa.array([0] * n, pa.int64()), "bits": pa.array([0] * n, pa.int32()),
        "splits": pa.array([0] * n, pa.int32()), "html": pa.array(pages)})
    t = pa.Table.from_batches(list(extract._dealt()(iter([batch]))))
    none = pa.table({"chunk": pa.array([], pa.int32()), "suffixes": pa.array([], pa.binary()), "n": pa.array([], pa.binary())})
    got = extract._finish(8)(t, none)
    assert got.column("text").to_pylist() == extract.main_texts(pages)


def test_extract_edge_rows(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).withColumns({"host": F.lit(1), "h": F.lit("x"), "text": F.lit(0)})
    got = collections.Counter((r.page_id, r.url) for r in extract.extract(pages, group_bytes=1000).collect())
    assert got == collections.Counter((p, u) for p, u, _ in PAGES)
    assert extract.extract(spark.createDataFrame([], SCHEMA)).count() == 0
