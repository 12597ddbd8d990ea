"""Operator 3: sampled SentencePiece segmentation and lossless decoding.

All ways to cut a text into pieces form a lattice.  Forward filtering sums the
weight of all paths up to each character; backward sampling walks from the end
and draws each piece with its share of that sum, so a segmentation is drawn
exactly in proportion to its weight.  No piece of the vocabulary crosses
certain pairs of characters (the start of a new word, a line break), so the
lattice falls apart there into small ones: each different small lattice is
filtered once and kept in a bounded cache, and all occurrences in a batch are
sampled together with numpy.

The random number of a draw depends on the seed, the row key and the character
position alone, so a row gets the same pieces in any partitioning.

Weights: a unigram model's own scores; for a BPE model, whose scores are merge
ranks, the logarithm of the rank (a Zipf prior).  ``alpha`` sharpens (> 1) or
flattens (< 1) them.

Decoding joins pieces.  A space is the piece character U+2581; a literal U+2581
and any character without a piece are spelt in byte pieces, so decoding gives
back every text exactly.

Defined cases: null and empty texts have no pieces (null decodes to the empty
text); null keys use one fixed stream, keys that
are no whole numbers the stream of their hash; repeated rows draw the same pieces; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import pick, table

SPACE = "▁"
LETTER = "A-Za-zÀ-ɏ"  # a character range
_LITERAL = "\n" + SPACE  # stands for a literal U+2581; no segment looks like this
_P, _M = 0x9E3779B97F4A7C15, (1 << 64) - 1


class Model:
    """Pieces and weights of a SentencePiece model file."""

    def __init__(self, path: str, alpha: float = 1.0):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.bytes_of: list[bytes] = []  # text of each id, spaces restored
        self.byte_id = [0] * 256
        plain = {}
        for i in range(n):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(p[3:5], 16)
                self.byte_id[b] = i
                self.bytes_of.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.bytes_of.append(p.replace(SPACE, " ").encode("utf-8"))
                plain[p] = (i, sp.get_score(i))
        is_bpe = all(s == int(s) for _, s in plain.values())  # merge ranks are whole numbers
        self.weight = {p: (i, alpha * (-math.log(2 - s) if is_bpe else s)) for p, (i, s) in plain.items()}
        self.byte_weight = min(w for _, w in self.weight.values()) - alpha
        self.longest = max(map(len, self.weight))
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.weight):
            raise ValueError("a piece crosses the start of a word: the lattice can't be cut there")
        # where no piece holds a Latin letter beside another character, it can be cut there too
        other = rf"[^{LETTER}{SPACE}\n]"
        mixed = any(re.search(rf"[{LETTER}]{other}|{other}[{LETTER}]", p) for p in self.weight)
        word = rf"{SPACE}*[^{SPACE}\n]+" if mixed else rf"{SPACE}*(?:[{LETTER}]+|{other}+)"
        self.cut = re.compile(rf"\n|{word}|{SPACE}+").findall


class Lattices:
    """Filtered lattices of different segments, end to end in flat arrays.

    State ``base + k`` is the boundary before character ``k`` of a segment; its
    edges are the pieces that end there.  ``chance`` holds, for each edge, the
    state number plus the cumulative share of the edge, so one sorted search
    over all of it draws an edge for any state.  New segments are filtered
    together: substrings are looked up by rolling hash among the prefixes of
    all pieces, and the forward sums advance one character in all of them."""

    def __init__(self, model: Model, most_states: int = 1_500_000):
        import numpy as np

        self.model, self.most = model, most_states
        by_length: dict[int, dict[int, tuple]] = {}
        for piece, (i, w) in model.weight.items():
            h = 0
            for n, c in enumerate(piece, 1):
                h = (h * _P + ord(c) + 1) & _M
                level = by_length.setdefault(n, {})
                if n == len(piece):
                    level[h] = (i, w)
                else:
                    level.setdefault(h, (-1, 0.0))
        self.levels = []
        for n in range(1, model.longest + 1):
            hs = np.array(sorted(by_length[n]), dtype=np.uint64)
            got = [by_length[n][int(h)] for h in hs]
            self.levels.append((hs, np.array([g[0] for g in got], np.int32), np.array([g[1] for g in got])))
        self.spelt: list[tuple] = []  # byte spellings; unit -1 - k stands for the k-th
        self.spelling: dict[int, int] = {}
        self.clear()

    def clear(self) -> None:
        import numpy as np

        self.number: dict[str, int] = {}  # segment -> its number
        self.n_states = self.n_edges = self.n_segs = 0
        self.columns = {"entry": np.empty(1 << 16, np.int32), "chance": np.empty(1 << 16), "back": np.empty(1 << 16, np.int32), "unit": np.empty(1 << 16, np.int32),
                        "log": np.empty(1 << 16, np.float32), "last": np.empty(1 << 16, np.int32), "length": np.empty(1 << 16, np.int32)}

    def _append(self, at: int, **values) -> None:
        import numpy as np

        for k, v in values.items():
            a = self.columns[k]
            if at + len(v) > len(a):
                a = self.columns[k] = np.concatenate([a[:at], np.empty(max(len(a), len(v)), a.dtype)])
            a[at : at + len(v)] = v

    def _unit(self, code: int) -> int:
        if code not in self.spelling:
            self.spelt.append(tuple(self.model.byte_id[b] for b in chr(code).encode("utf-8")))
            self.spelling[code] = -len(self.spelt)
        return self.spelling[code]

    def add(self, segs: list[str], literal: bool = False) -> None:
        """Filter new segments.  ``literal``: spell every character in bytes."""
        import numpy as np

        if not segs:
            return
        code = np.frombuffer("".join(segs).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        size = np.array([len(x) for x in segs])
        first = self.n_states + np.cumsum(size + 1) - (size + 1)  # first state of each segment
        offset = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
        state = np.repeat(first, size) + offset  # state before each character
        left = np.repeat(size, size) - offset  # characters from here to the segment's end
        hashed = (code + 1).astype(np.uint64)
        active, h = (np.arange(0) if literal else np.arange(len(code))), hashed[: 0 if literal else len(code)]
        ends, backs, units, logs = [], [], [], []
        single = np.zeros(len(code), bool)
        for n, (hs, ids, ws) in enumerate(self.levels, 1):
            if n > 1:
                fits = left[active] >= n
                active, h = active[fits], h[fits] * np.uint64(_P) + hashed[active[fits] + n - 1]
            if not len(active):
                break
            k = np.minimum(np.searchsorted(hs, h), len(hs) - 1)
            hit = hs[k] == h
            active, h, k = active[hit], h[hit], k[hit]
            whole = ids[k] >= 0
            at = active[whole]
            if n == 1:
                single[at] = True
            ends.append(state[at] + n)
            backs.append(state[at])
            units.append(ids[k[whole]])
            logs.append(ws[k[whole]])
        bare = np.flatnonzero(~single)  # characters without a piece: bytes
        if len(bare):
            kinds, which = np.unique(code[bare], return_inverse=True)
            unit = np.array([self._unit(int(c)) for c in kinds])
            width = np.array([len(self.spelt[-1 - u]) for u in unit])
            ends.append(state[bare] + 1)
            backs.append(state[bare])
            units.append(unit[which])
            logs.append(self.model.byte_weight * width[which])
        # by end, then by start: each run is in order, and longer pieces (earlier starts) go first
        end = np.concatenate(ends[::-1])
        order = np.argsort(end, kind="stable")
        end, back, unit, log = (np.concatenate(x[::-1])[order] for x in (ends, backs, units, logs))
        # forward sums, character by character in all segments at once
        low = self.n_states
        total_states = int(size.sum()) + len(size)
        forward = np.zeros(total_states)
        n_edges = np.bincount(end - low, minlength=total_states)
        where = np.cumsum(n_edges) - n_edges  # first edge of each state
        longest_first = np.argsort(-size, kind="stable")
        sizes = size[longest_first]
        for k in range(1, int(size.max()) + 1):
            live = longest_first[: np.searchsorted(-sizes, -k, side="right")]
            s = first[live] - low + k
            cnt = n_edges[s]
            group = np.cumsum(cnt) - cnt
            e = np.repeat(where[s] - group, cnt) + np.arange(int(cnt.sum()))
            x = forward[back[e] - low] + log[e]
            top = np.maximum.reduceat(x, group)
            forward[s] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, cnt)), group))
        share = np.exp(forward[back - low] + log - forward[end - low])
        run = np.cumsum(share)
        begin = where[end - low]
        cumulative = run - (run[begin] - share[begin])
        last_edge = np.append(end[1:] != end[:-1], True)
        cumulative[last_edge] = 1.0
        self._append(self.n_edges, chance=end + np.minimum(cumulative, 1.0), back=back, unit=unit, log=log)
        self._append(self.n_states, entry=self.n_edges + where)
        self._append(self.n_segs, last=first + size, length=size)
        self.number.update(zip(segs if not literal else [_LITERAL], range(self.n_segs, self.n_segs + len(segs))))
        self.n_edges += len(end)
        self.n_segs += len(segs)
        self.n_states += total_states


def _mix(x):
    """splitmix64 finaliser on an array of uint64."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _number(key) -> int | None:
    """A row key as a number: whole numbers stand for themselves, any other
    key for the hash of its text."""
    import xxhash

    return key if key is None or isinstance(key, int) else xxhash.xxh64_intdigest(str(key).encode("utf-8", "surrogatepass"))


def sample(texts: list[str], keys: list[int | None], model: Model, lattices: Lattices, seed: int):
    """Piece ids of each text (one flat int32 array and offsets) and the log
    weight of each drawn segmentation."""
    import numpy as np

    if lattices.n_states > lattices.most:
        lattices.clear()
    segs: list[str] = []
    n_segs = []
    for text in texts:
        before = len(segs)
        for k, part in enumerate(text.split(SPACE)):
            if k:  # a literal U+2581: its own segment, always spelt in bytes
                segs.append(_LITERAL)
            segs += model.cut(part.replace(" ", SPACE))
        n_segs.append(len(segs) - before)
    known = lattices.number
    if any(SPACE in t for t in texts) and _LITERAL not in known:
        lattices.add([SPACE], literal=True)
    numbers = list(map(known.get, segs))
    if None in numbers:
        lattices.add(list(dict.fromkeys(x for x, k in zip(segs, numbers) if k is None)))
        numbers = [known[x] if k is None else k for x, k in zip(segs, numbers)]
    c = lattices.columns
    chance, back, unit, logs = (c[k][: lattices.n_edges] for k in ("chance", "back", "unit", "log"))
    entry = c["entry"][: lattices.n_states].astype(np.int64)
    last, length = c["last"].astype(np.int64), c["length"].astype(np.int64)
    seg = np.array(numbers, dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), n_segs)
    stream = _mix(np.array([((k if k is not None else -1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 + 1) & 0xFFFFFFFFFFFFFFFF
                            for k in keys], dtype=np.uint64))
    order = np.argsort(seg, kind="stable")  # equal segments together: searches stay local
    who = order
    state = last[seg[order]]
    size = length[seg]
    ends_at = np.cumsum(size)
    row_chars = np.concatenate([[0], ends_at])[np.cumsum(n_segs) - n_segs] if len(texts) else ends_at
    starts = ends_at - size - row_chars[row] if len(seg) else size  # character position in the text
    first = state - size[order]  # start state of each segment
    position = starts[order] - first  # plus state: character position
    rng = stream[row[order]] if len(texts) else np.zeros(0, np.uint64)
    counts = np.zeros(len(seg), dtype=np.int64)
    score = np.zeros(len(texts))
    steps = []
    while len(who):
        with np.errstate(over="ignore"):
            u = _mix(rng + (position + state).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        draw = (u >> np.uint64(11)) * (1.0 / (1 << 53))
        # the edge whose cumulative share is the first one above the draw
        aim = state + np.minimum(draw, 1 - 1e-8)
        edge = entry[state]
        late = np.flatnonzero(chance[edge] <= aim)
        while len(late):
            edge[late] += 1
            late = late[chance[edge[late]] <= aim[late]]
        steps.append((who, unit[edge]))
        counts[who] += 1
        score += np.bincount(row[who], weights=logs[edge], minlength=len(texts))
        state = back[edge].astype(np.int64)
        more = state > first
        who, state, first, position, rng = who[more], state[more], first[more], position[more], rng[more]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.int32)
    seen = np.zeros(len(seg), dtype=np.int64)
    for w, p in steps:  # pieces come last first
        seen[w] += 1
        out[ends[w] - seen[w]] = p
    per_row = np.bincount(np.repeat(row, counts), minlength=len(texts)) if len(seg) else np.zeros(len(texts), int)
    if (out < 0).any():
        sizes = np.array([len(x) for x in lattices.spelt])
        flat = np.array([i for x in lattices.spelt for i in x], dtype=np.int32)
        begins = np.cumsum(sizes) - sizes
        widths = np.ones(len(out), dtype=np.int64)
        neg = np.flatnonzero(out < 0)
        which = -1 - out[neg]
        widths[neg] = sizes[which]
        row_of = np.repeat(np.arange(len(texts)), per_row)
        per_row = np.bincount(row_of, weights=widths, minlength=len(texts)).astype(np.int64)
        at = np.cumsum(widths) - widths
        wide = np.repeat(out, widths)
        for k in range(int(sizes.max())):  # the k-th byte of each spelling
            has = sizes[which] > k
            wide[at[neg[has]] + k] = flat[begins[which[has]] + k]
        out = wide
    return out, np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32), score


_MODELS: dict[str, Model] = {}  # for decoding
_LATTICES: dict[tuple, Lattices] = {}  # of this Python worker, which runs many tasks


def lattices_of(path: str, alpha: float) -> Lattices:
    if (path, alpha) not in _LATTICES:
        _LATTICES[path, alpha] = Lattices(Model(path, alpha))
    return _LATTICES[path, alpha]


def model_of(path: str) -> Model:
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def _model_path(path: str | None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return path


def _joined(lists, pieces):
    """The texts of lists of ids; ``pieces`` has the bytes of each id."""
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = pa.LargeListArray.from_arrays(
        lists.offsets.cast(pa.int64()), pieces.take(lists.values), mask=lists.is_null() if lists.null_count else None)
    joined = pc.binary_join(parts, pa.scalar(b"", pa.large_binary()))
    try:
        return joined.cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        return pa.array([None if x is None else x.decode("utf-8", "replace") for x in joined.to_pylist()], pa.string())


def _slices(batch, sizes, most: int) -> Iterator:
    """Cuts a batch before ``sizes`` (one a row) sum up to more than ``most``;
    a larger row stands alone."""
    import numpy as np

    ends, at = np.cumsum(sizes), 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        k = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, k - at)
        at = k


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, seed: int = 1,
           alpha: float = 1.0, batch_bytes: int = 1 << 18, decoded: bool = False) -> DataFrame:
    """``key``, ids (a sampled segmentation) and log_weight of the draw.
    ``decoded`` adds what :func:`decode` makes of the ids, without sending them
    to a second Python worker."""
    path = _model_path(path)
    ship_package(docs.sparkSession)
    d = pick(docs, key, text)
    kind = d.schema[key].dataType.simpleString()

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        lattices = lattices_of(path, alpha)
        model = lattices.model
        pieces = pa.array(model.bytes_of, pa.large_binary())
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False)
            for part in _slices(b, sizes, batch_bytes):
                keys, texts = part.column(0), [t or "" for t in part.column(1).to_pylist()]
                flat, offsets, score = sample(texts, list(map(_number, keys.to_pylist())), model, lattices, seed)
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                more = {"decoded": _joined(ids, pieces)} if decoded else {}
                yield pa.RecordBatch.from_pydict({key: keys, "ids": ids, "log_weight": pa.array(score), **more})

    return d.mapInArrow(run, f"`{key}` {kind}, ids array<int>, log_weight double" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", batch_ids: int = 1 << 18) -> DataFrame:
    """Adds ``decoded``, the text of each row's ids (invalid UTF-8, which no
    encoded text has, is replaced)."""
    path = _model_path(path)
    ship_package(encoded.sparkSession)
    where = encoded.columns.index(ids)

    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        pieces = pa.array(model_of(path).bytes_of, pa.large_binary())
        for b in batches:
            sizes = pc.fill_null(pc.list_value_length(b.column(where)), 0).to_numpy(zero_copy_only=False)
            for part in _slices(b, sizes, batch_ids):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, _joined(part.column(where), pieces)], [*b.schema.names, "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, schema + ", decoded string")


def query(spark, sf_dir: str) -> DataFrame:
    """Sampled ids of every document, and the digest of what they decode to
    (that of the text itself, as decoding is lossless)."""
    out = encode(table(spark, sf_dir, "documents"), decoded=True)
    return out.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.round("log_weight", 4).alias("log_weight"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("text_sha256"),
    )
