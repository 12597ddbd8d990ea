"""Operator 9: main text of web pages with a host suffix array.

A page is turned into blocks of text, its token stream.  A repeated substring
is a run of ``least`` tokens or more that stands on distinct pages of a host;
overlapping runs add up.  The token streams of a chunk of pages are
concatenated and their suffixes sorted, first into buckets named by a hash of
their first ``least`` tokens, then by these tokens; neighbours are compared
token by token, which gives for each suffix the number of pages that share it.

A host lies in one chunk, and nothing more is needed, unless it has more than
``group_bytes``.  The chunks of such a host first exchange short hashes of their
windows, a byte or two each; only what two chunks may share is exchanged as
text: those suffixes are sorted by their tokens, equal neighbours add up their
pages, and the sums go back to the chunks.  Neither the number of tasks nor the
size of the input changes a text.  :func:`main_texts` does the same for the
pages of one host.

Markup decides first: scripts, styles, forms, menus and the like are no text
at all, and if a page has an article (or main) element its text comes from
the article.  Repeats decide the rest.  Pages without an article keep the
blocks (or unique runs of blocks) that no other page of their host repeats.
Inside an article a block is cut if half or more of it stands on many pages
of the host (``MANY`` and one in ``SHARE`` of its pages); what fewer pages
share is quoted and stays, and an article that is mostly such text is a copy
and stays whole.

Defined cases: null or empty html gives the empty text; a null or odd url
belongs to the host ''; unclosed tags, comments and quotes end where HTML ends
them or at the end of the page; repeated rows are judged as one page (equal
pages do not make one another boilerplate); an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import collections
import hashlib
import html as _html
import itertools
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import hot_keys, pick, table, written

#: Inside an article only what stands on at least MANY distinct pages of the
#: host, and on one in SHARE of them, is boilerplate.
MANY, SHARE = 8, 20

#: Elements whose content is never text.
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_SKIP = frozenset("head nav aside footer form button select option menu dialog template noscript svg math object canvas "
                  "audio video map datalist".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
                   "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td "
                   "tfoot th thead tr ul caption".split())
_CLOSES_P = _BLOCK - {"body", "html", "head"}
#: Words of class and id attributes (and roles) that name boilerplate.
_NAMED = re.compile(
    r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|notification|popup|modal|overlay|"
    r"newsletter|subscri\w+|sidebar|widget|menu|nav|navbar|navigation|breadcrumbs?|masthead|footer|comments?|commentlist|"
    r"disqus|repl(?:y|ies)|social|share|sharing|related|recommend\w*|login|signup|toolbar|pagination|pager|skip-link|"
    r"contentinfo|complementary|search|alert)(?:$|[\s_-])")
_STAYS = re.compile(r"(?i)comment|repl|disqus|related|recommend|sidebar|nav|menu|footer")
_ATTR = re.compile(r"""(?i)\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>"']*+(?:(?:"[^"]*"|'[^']*')[^>"']*+)*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)


def _boilerplate(attrs: str) -> str:
    """The naming attribute that marks an element as boilerplate, or ''."""
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id", "role") and _NAMED.search(value):
            return value
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return "hidden"
    return ""


def blocks(page: str | None) -> list[tuple[str, bool]]:
    """(text, inside an article) of each block of a page, in page order,
    without what the markup excludes."""
    page = page or ""
    out: list[tuple[str, bool]] = []
    text: list[str] = []
    # open elements: (tag, excluded by ('' if not), inside an article)
    stack: list[tuple[str, str, bool]] = [("", "", False)]

    def flush() -> None:
        if text:
            joined = " ".join(_html.unescape("".join(text)).split())
            if joined:
                out.append((joined, stack[-1][2]))
            text.clear()

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        stop = m.start() if m else end
        if stop > at and not stack[-1][1]:
            text.append(page[at:stop])
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = (m[1] if m[2] else m[4]) == "/"
        if tag == "br":
            text.append(" ")
            continue
        if tag in _VOID:
            if tag in _BLOCK:
                flush()
            continue
        if closing:
            if tag in _BLOCK:
                flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main") and tag not in ("body", "html", "article", "main"):
                    break  # a stray end tag does not end the article
            continue
        attrs = (m[3] if m[2] else m[6]) or ""
        if tag in _RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag in _CLOSES_P:
            flush()
            for k in range(len(stack) - 1, 0, -1):  # an open paragraph ends here
                if stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in _BLOCK:
                    break
        _, why, inside = stack[-1]
        named = _boilerplate(attrs)
        if tag in ("article", "main"):
            if named or why and _STAYS.search(why):
                why = named or why
            else:
                why, inside = "", True
        elif not why:
            if tag in _SKIP:
                why = tag
            elif tag == "header":
                why = "" if inside else tag
            elif named and tag not in ("html", "body"):
                why = named
        if tag in _BLOCK or why != stack[-1][1]:
            stack.append((tag, why, inside))
    flush()
    return out


def _suffix_ranks(tokens, least: int):
    """The rank of each suffix among all, sorted by their first ``least`` tokens
    (equal ones share a rank), by doubling the sorted width."""
    import numpy as np

    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < least:
        step = min(width, least - width)
        later = np.zeros(n, dtype=np.int64)
        later[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.append(0, np.cumsum(ordered[1:] != ordered[:-1]))[:n]
        width += step
    return rank


def repeated(streams: list[list[int]], owner: list[int], least: int, many: int = 2):
    """For token streams of pages, a boolean array over their concatenation:
    the tokens covered by substrings of ``least`` tokens or more that occur on
    ``many`` distinct pages (``owner`` gives the page; equal pages share one)."""
    import numpy as np

    sizes = np.array([len(s) for s in streams])
    n = int(sizes.sum()) + len(streams)
    tokens = np.empty(n, dtype=np.int64)
    page = np.repeat(np.array(owner), sizes + 1)
    at = 0
    for k, s in enumerate(streams):
        tokens[at : at + len(s)] = s
        tokens[at + len(s)] = -1 - k  # a different end mark for each stream
        at += len(s) + 1
    rank = _suffix_ranks(tokens, least)
    # distinct pages of each run of equal prefixes
    pairs = np.unique(rank * (len(streams) + 1) + page)
    on = np.bincount(pairs // (len(streams) + 1), minlength=int(rank.max(initial=0)) + 1)
    return _covered(on[rank] >= many, least)


def _covered(hit, least: int):
    """The tokens covered by windows of ``least`` tokens that start at ``hit``."""
    import numpy as np

    n = len(hit)
    edge = np.zeros(n + least + 1, dtype=np.int64)
    places = np.flatnonzero(hit)
    edge[places] += 1
    edge[places + least] -= 1
    return np.cumsum(edge)[:n] > 0


def _text(found: list[tuple[str, bool]], covered, common) -> str:
    """Main text of a page from its blocks; ``covered`` marks the tokens that
    other pages repeat, ``common`` those that many pages of the host share."""
    has_article = any(inside for _, inside in found)
    sizes = [t.count(" ") + 1 for t, _ in found]
    starts = [0]
    for n in sizes:
        starts.append(starts[-1] + n)
    shared = [int(common[x : x + n].sum()) for x, n in zip(starts, sizes)]
    # an article that is mostly common text is a copy, not a text with notices
    copy = 2 * sum(c for c, (_, i) in zip(shared, found) if i) >= sum(n for n, (_, i) in zip(sizes, found) if i)
    kept = []
    for (text, inside), at, n, c in zip(found, starts, sizes, shared):
        if has_article:
            if inside and (copy or 2 * c < n):
                kept.append(text)
        elif 2 * int(covered[at : at + n].sum()) < n:
            kept.append(text)  # a unique block that only begins or ends like others
        else:
            unique = " ".join(w for w, c in zip(text.split(" "), covered[at : at + n]) if not c)
            if unique:
                kept.append(unique)
    return "\n".join(kept)


def _many(pages: int) -> int:
    """Pages of a host with so many that make a text common."""
    return max(MANY, -(-pages // SHARE))


def main_texts(pages: list[str | None], least: int = 8) -> list[str]:
    """Main texts of pages of one host."""
    ids: dict[str, int] = {}
    first: dict[str, int] = {}
    parsed = [blocks(p) for p in pages]
    streams, owner = [], []
    for k, (page, found) in enumerate(zip(pages, parsed)):
        owner.append(first.setdefault(page or "", k))
        streams.append([ids.setdefault(w, len(ids)) for t, _ in found for w in t.split(" ")])
    if not pages:
        return []
    covered, common = repeated(streams, owner, least), repeated(streams, owner, least, _many(len(first)))
    out, at = [], 0
    for found, stream in zip(parsed, streams):
        out.append(_text(found, covered[at : at + len(stream)], common[at : at + len(stream)]))
        at += len(stream) + 1
    return out


_WORDS: dict[str, int] = {}


def _hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def _tokens(words: list[str]):
    """64-bit hashes of words, the same in every process."""
    import numpy as np

    if len(_WORDS) > 1 << 19:
        _WORDS.clear()
    for w in set(words):
        if w not in _WORDS:
            _WORDS[w] = _hash(w)
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


def _mixed(x):
    """A one-to-one scrambling of 64 bits (splitmix64)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _windows(streams: list, hosts, least: int):
    """(hash, page, place in the concatenation) of each window of ``least``
    tokens in the streams; ``hosts`` has a hash for each stream's host."""
    import numpy as np

    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    page = np.repeat(np.arange(len(streams)), sizes)
    tokens = np.concatenate([*streams, np.zeros(0, np.uint64)])
    n = len(tokens) - least + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(least):
        h = h * np.uint64(0x9E3779B97F4A7C15) + tokens[j : j + n]
    at = np.flatnonzero(page[:n] == page[least - 1 :])
    return _mixed(h[at] ^ hosts[page[at]]), page[at], at


def _pack(w) -> bytes:
    """Sorted hashes as differences, byte plane by byte plane: close ones
    leave planes of zeros that shuffles compress away."""
    import numpy as np

    return np.diff(w, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(b: bytes):
    import numpy as np

    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _dealt(most: int = 32 << 20):
    """Pages as blocks, put together by chunk: lists of their columns, and their
    texts (a line a block) as one compressed body."""

    def run(batches) -> Iterator:
        import pyarrow as pa
        import zstandard

        held: dict[int, list] = {}
        size = 0

        def out():
            pack = zstandard.ZstdCompressor(level=3).compress
            rows = []
            for chunk, pages in held.items():
                cols = [list(c) for c in zip(*pages)]
                first, pages_, bits, splits = cols[5][0], cols[6][0], cols[7][0], cols[8][0]
                rows.append((chunk, first, pages_, bits, splits, *cols[:5], [len(x) for x in cols[9]], cols[10], pack(b"".join(cols[9]))))
            held.clear()
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

        ids = None
        for b in batches:
            ids = b.schema.field("page_id").type
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(ids), pa.list_(pa.string()), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.binary()), pa.binary()]
            names = ["chunk", "first", "pages", "bits", "splits", "page_id", "url", "key", "counts", "host", "size", "inside", "body"]
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                for *row, chunk, first, pages, bits, splits, html in zip(*(part.column(k).to_pylist() for k in range(part.num_columns))):
                    found = blocks(html)
                    text = "\n".join(t for t, _ in found).encode("utf-8", "surrogatepass")
                    size += len(text) + 100
                    held.setdefault(chunk, []).append((*row, first, pages, bits, splits, text, bytes(i for _, i in found)))
                if size > most:
                    yield out()
                    size = 0
        if held:
            yield out()

    return run


class _Chunk:
    """The distinct pages of a chunk: their blocks, their token streams end to
    end (``ids`` into ``vocabulary``) and the windows of these."""

    def __init__(self, t, least: int):
        import numpy as np
        import zstandard

        col = {c: t.column(c).to_pylist() for c in ("key", "counts", "host", "inside", "size", "body")}
        flat = lambda c: [x for row in col[c] for x in row]
        index: dict[int, int] = {}
        self.of = [index.setdefault(k, len(index)) for k in flat("key")]
        self.own = np.zeros(len(index), np.int64)
        self.found: list = [None] * len(index)
        self.least = least
        ids: dict[str, int] = collections.defaultdict(itertools.count().__next__)
        streams, host = [np.zeros(0, np.int64)] * len(index), [""] * len(index)
        rows = zip(self.of, flat("host"), flat("inside"), flat("counts"))
        for sizes, body in zip(col["size"], col["body"]):
            raw, at = zstandard.ZstdDecompressor().decompress(body), 0
            for n in sizes:
                k, h, mark, counts = next(rows)
                self.own[k] |= counts
                if self.found[k] is None:
                    text = raw[at : at + n].decode("utf-8", "surrogatepass")
                    host[k] = h
                    self.found[k] = list(zip(text.split("\n"), map(bool, mark))) if mark else []
                    if mark:
                        words = text.replace("\n", " ").split(" ")
                        streams[k] = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
                at += n
        self.sizes = np.array([len(x) for x in streams], np.int64)
        names: dict[str, int] = {}
        self.host = np.array([names.setdefault(h, len(names)) for h in host], np.int64)
        self.hosts, self.vocabulary, self.number = list(names), list(ids), ids
        self.ids = np.concatenate([*streams, np.zeros(least, np.int64)])
        self.hashes = _tokens(self.vocabulary) if ids else np.zeros(1, np.uint64)
        seed = np.array([_hash(h) for h in host], np.uint64)
        self.w, self.page, self.at = _windows([self.hashes[x] for x in streams], seed, least)

    def sort(self) -> None:
        """Windows in the order of their buckets, equal ones side by side:
        ``order``, ``bucket`` (sorted), ``group`` of each, ``start`` and ``pages``
        of each group."""
        import numpy as np

        self.order = np.argsort(self.w, kind="stable")
        at, page, self.bucket = self.at[self.order], self.page[self.order], self.w[self.order]

        def same():
            out = (self.bucket[1:] == self.bucket[:-1]) & (self.host[page[1:]] == self.host[page[:-1]])
            for j in range(self.least):
                k = np.flatnonzero(out)
                out[k] = self.ids[at[k + 1] + j] == self.ids[at[k] + j]
            return out

        equal = same()
        clash = np.unique(self.bucket[1:][(self.bucket[1:] == self.bucket[:-1]) & ~equal])
        if len(clash):  # two texts in one bucket: sort it by its tokens
            k = np.flatnonzero(np.isin(self.bucket, clash))
            keys = [self.ids[at[k] + j] for j in range(self.least)]
            self.order[k] = self.order[k][np.lexsort([page[k], *keys, self.host[page[k]], self.bucket[k]])]
            at, page = self.at[self.order], self.page[self.order]
            equal = same()
        new = np.append(True, ~equal) if len(at) else np.zeros(0, bool)
        self.group, self.start = np.cumsum(new) - 1, np.flatnonzero(new)
        # equal windows come in page order, so those of one page are neighbours
        own = np.where(new | np.append(True, page[1:] != page[:-1])[: len(page)], self.own[page], 0)
        self.pages = np.add.reduceat(own, self.start) if len(self.start) else own

    def text(self, at: int) -> str:
        return " ".join([self.vocabulary[i] for i in self.ids[at : at + self.least].tolist()])


def _top(w, bits: int):
    import numpy as np

    return w >> np.uint64(64 - bits)


def _dealt_over(w, bits: int, splits: int, first: int):
    """Stretches of the sorted short hashes ``w`` by bucket: (bucket, from, to)."""
    import numpy as np

    bucket = (w * np.uint64(splits) >> np.uint64(bits)).astype(np.int64) + first
    cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(w)]
    return [(int(bucket[x]), x, y) for x, y in zip(cuts, cuts[1:]) if y > x]


def _squeezed(texts: list[str]) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress("\n".join(texts).encode("utf-8", "surrogatepass"))


def _loose(b: bytes) -> list[str]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(b).decode("utf-8", "surrogatepass").split("\n")


def _send(least: int):
    """Short hashes of a chunk's windows, dealt over buckets by their value;
    nothing if its hosts lie in it whole."""

    def run(t):
        import numpy as np
        import pyarrow as pa

        kind = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("w", pa.binary())])
        first, bits, splits = (t.column(c)[0].as_py() for c in ("first", "bits", "splits"))
        if splits < 2:
            return kind.empty_table()
        w = np.sort(_top(_Chunk(t, least).w, bits))
        w = w[np.append(True, w[1:] != w[:-1])[: len(w)]]
        spans = _dealt_over(w, bits, splits, first)
        return pa.table([pa.array([t.column("chunk")[0].as_py()] * len(spans), pa.int32()), pa.array([b for b, _, _ in spans], pa.int32()),
                         pa.array([_pack(w[x:y]) for _, x, y in spans], pa.binary())], schema=kind)

    return run


def _by_bucket(batches, columns: int, done) -> Iterator:
    """``done`` of the rows of each bucket (column 1), which come together."""
    held: list[tuple] = []
    for b in batches:
        for row in zip(*(b.column(k).to_pylist() for k in range(columns))):
            if held and held[-1][1] != row[1]:
                yield done(held)
                held = []
            held.append(row)
    if held:
        yield done(held)


def _several(batches) -> Iterator:
    """Of rows (chunk, bucket, w) sorted by bucket: for each chunk the short
    hashes that other chunks have too."""
    import numpy as np
    import pyarrow as pa

    def out(rows):
        ws = [_unpack(r[2]) for r in rows]
        values = np.sort(np.concatenate(ws))
        values = values[1:][values[1:] == values[:-1]]  # a chunk has each but once
        got = [(r[0], w[np.isin(w, values)]) for r, w in zip(rows, ws)]
        got = [(c, _pack(w)) for c, w in got if len(w)]
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in got], pa.int32()), pa.array([w for _, w in got], pa.binary())], ["chunk", "w"])

    yield from _by_bucket(batches, 3, out)


def _suffixes(least: int):
    """The suffixes (their first ``least`` tokens) of a chunk that other chunks
    may have, with the number of its pages that hold them."""

    def run(t, marks):
        import numpy as np
        import pyarrow as pa

        kind = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("suffixes", pa.binary()), ("n", pa.binary())])
        if not t.num_rows or not marks.num_rows:
            return kind.empty_table()
        c = _Chunk(t, least)
        c.sort()
        first, bits, splits, chunk = (t.column(x)[0].as_py() for x in ("first", "bits", "splits", "chunk"))
        want = np.sort(np.concatenate([_unpack(x) for x in marks.column("w").to_pylist()]))
        top = _top(c.bucket[c.start], bits)
        hit = np.flatnonzero(want[np.minimum(np.searchsorted(want, top), len(want) - 1)] == top)
        rows = []
        for bucket, x, y in _dealt_over(top[hit], bits, splits, first):
            groups = hit[x:y]
            texts = [c.text(k) for k in c.at[c.order[c.start[groups]]].tolist()]
            order = sorted(range(len(texts)), key=texts.__getitem__)
            rows.append((chunk, bucket, _squeezed([texts[k] for k in order]), c.pages[groups][order].astype(np.int64).tobytes()))
        return pa.table([pa.array(list(x), f.type) for x, f in zip(zip(*rows), kind)], schema=kind) if rows else kind.empty_table()

    return run


def _neighbours(batches) -> Iterator:
    """Of rows (chunk, bucket, suffixes, n) sorted by bucket: the suffixes of
    all chunks in one order, where equal neighbours add up their pages; each
    chunk gets those that another chunk has."""
    import numpy as np
    import pyarrow as pa

    def out(rows):
        all_ = []
        for k, r in enumerate(rows):
            all_ += ((x, k, n) for x, n in zip(_loose(r[2]), np.frombuffer(r[3], np.int64).tolist()))
        all_.sort()
        got: list[tuple[list, list]] = [([], []) for _ in rows]
        at = 0
        while at < len(all_):
            stop = at + 1
            while stop < len(all_) and all_[stop][0] == all_[at][0]:
                stop += 1
            if stop - at > 1:
                total = sum(x[2] for x in all_[at:stop])
                for suffix, k, _ in all_[at:stop]:
                    got[k][0].append(suffix)
                    got[k][1].append(total)
            at = stop
        some = [(r[0], _squeezed(x), np.array(n, np.int64).tobytes()) for r, (x, n) in zip(rows, got) if x]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in some], pa.int32()), *(pa.array([x[k] for x in some], pa.binary()) for k in (1, 2))],
                                          ["chunk", "suffixes", "n"])

    yield from _by_bucket(batches, 4, out)


def _finish(least: int):
    """Texts of a chunk's pages, from its own suffixes and what other chunks
    of its host have of them."""

    def run(t, others):
        import numpy as np
        import pyarrow as pa

        c = _Chunk(t, least)
        c.sort()
        for suffixes, n in zip(*(others.column(x).to_pylist() for x in ("suffixes", "n"))):
            words = [w for x in _loose(suffixes) for w in x.split(" ")]
            ids = np.array([c.number[w] for w in words], np.int64).reshape(-1, least)
            w = _windows(list(c.hashes[ids]), np.full(len(ids), _hash(c.hosts[0]), np.uint64), least)[0]
            total = np.frombuffer(n, np.int64)
            k = np.searchsorted(c.bucket, w)
            todo = np.arange(len(k))
            while len(todo):  # past other texts of the bucket, if any
                here = c.at[c.order[k[todo]]]
                fits = (c.ids[here[:, None] + np.arange(least)] == ids[todo]).all(1)
                c.pages[c.group[k[todo[fits]]]] = total[todo[fits]]
                todo = todo[~fits]
                k[todo] += 1
        many = np.bincount(c.host, weights=c.own).astype(np.int64)  # pages of each host
        if t.column("splits")[0].as_py() > 1:
            many[:] = t.column("pages")[0].as_py()
        times = np.empty(len(c.w), np.int64)
        times[c.order] = c.pages[c.group]
        size = int(c.sizes.sum())
        hit, often = np.zeros(size, bool), np.zeros(size, bool)
        hit[c.at], often[c.at] = times > 1, times >= np.array([_many(int(n)) for n in many])[c.host[c.page]]
        covered, common = _covered(hit, least), _covered(often, least)
        texts, at = [], 0
        for found, n in zip(c.found, c.sizes.tolist()):
            texts.append(_text(found, covered[at : at + n], common[at : at + n]))
            at += n
        texts = [texts[k] for k in c.of]
        flat = lambda name: pa.chunked_array([x.values[x.offsets[0].as_py() : x.offsets[-1].as_py()] for x in t.column(name).chunks])
        return pa.table({"page_id": flat("page_id"), "url": flat("url"), "text": pa.array(texts, pa.string()),
                         "n_chars": pa.array([len(x) for x in texts], pa.int64())})

    return run


def extract(pages: DataFrame, least: int = 8, group_bytes: int = 8 << 20) -> DataFrame:
    """page_id, url, text, n_chars; one row per input row.  A chunk of pages
    has about ``group_bytes`` of HTML; it bounds memory only.  The hosts that
    have more are broadcast (some 40 bytes each ``group_bytes`` of input at most)."""
    spark = pages.sparkSession
    ship_package(spark)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    html, row = F.coalesce("html", F.lit("")), F.xxhash64("page_id", "url")
    d = pick(pages, "page_id", "url", "html").select("page_id", "url", host.alias("host"), F.xxhash64(host, html).alias("key"), row.alias("row"), html.alias("html"))
    keys = written(d.groupBy("key").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("html") + 64).alias("size"), F.min("row").alias("row"), F.first("host").alias("host")), "extract-keys")
    sizes = keys.groupBy("host").agg(F.sum("size").alias("size"), F.count("*").alias("pages"), F.sum("n").alias("n"))
    sizes = written(sizes, "extract-hosts")
    rows = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rest = sizes.where(F.col("size") <= group_bytes).agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(parts, -(-2 * rest // group_bytes))  # for the hosts that lie in one
    big = []
    for r in sizes.where(F.col("size") > group_bytes).orderBy("host").collect():
        splits = -(-r["size"] // group_bytes)
        big.append((r.host, chunks, splits, r.pages, min(60, r["size"].bit_length() + 6)))
        chunks += splits
    known = F.broadcast(spark.createDataFrame(big, "host string, first int, splits int, pages long, bits int"))
    d = d.join(known, "host", "left")
    # copies of a hot page lie in many chunks, and only those of its least row count as the page
    hot = hot_keys(keys, "key", "n", rows)
    spread, counts = F.lit(0), F.lit(1)
    if hot:
        d = d.join(F.broadcast(keys.where(F.col("key").isin(hot)).select("key", F.col("row").alias("least"))), "key", "left")
        spread = F.when(F.col("row") != F.col("least"), F.pmod(F.col("row"), F.lit(chunks))).otherwise(0)
        counts = F.when(F.col("row") != F.col("least"), 0).otherwise(1)
    whole = max(1, big[0][1] if big else chunks)
    chunk = F.coalesce(F.col("first") + F.pmod(F.xxhash64("key", spread.cast("long")), F.col("splits")), F.pmod(F.xxhash64("host"), F.lit(whole)))
    none = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    d = d.select("page_id", "url", "key", counts.cast("long").alias("counts"), "host", chunk.cast("int").alias("chunk"),
                 *map(none, ("first", "pages", "bits", "splits")), "html")
    kind = d.schema["page_id"].dataType.simpleString()
    put = d.mapInArrow(_dealt(), (
        f"chunk int, first int, pages long, bits int, splits int, page_id array<{kind}>, url array<string>, key array<long>, counts array<long>, "
        "host array<string>, size array<int>, inside array<binary>, body binary"))
    put = put.repartition(max(1, chunks), "chunk")
    each = put.groupBy("chunk")
    others = spark.createDataFrame([], "chunk int, suffixes binary, n binary")
    if big:
        sent = each.applyInArrow(_send(least), "chunk int, bucket int, w binary")
        many = max(parts, chunks - whole)
        marks = sent.repartition(many, "bucket").sortWithinPartitions("bucket").mapInArrow(_several, "chunk int, w binary")
        named = each.cogroup(marks.groupBy("chunk")).applyInArrow(_suffixes(least), "chunk int, bucket int, suffixes binary, n binary")
        others = named.repartition(many, "bucket").sortWithinPartitions("bucket").mapInArrow(
            _neighbours, "chunk int, suffixes binary, n binary")
    return each.cogroup(others.groupBy("chunk")).applyInArrow(
        _finish(least), f"page_id {kind}, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
