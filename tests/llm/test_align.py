"""Operator 13 against an alignment token by token in one process."""

import collections

import numpy as np
import public_tokenizers as P
import pytest

from speechprep.llm import align
from speechprep.llm.queries import QUERIES

from .conftest import SCHEMA, SF, TRICKY

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
HARD = [
    (20, "a  b c <|endoftext|> <s> x</s> <unk> <0x41>"), (21, " lead and trail "), (22, "日本語のテキスト 中文 한국어 " * 50),
    (23, "x᠎ y​ z　 w\x85 v\x1c u"), (24, "🙂 " * 100 + "é é "), (25, "don't we're \n\n  new   lines\t\ttabs " * 20),
    (26, "▁ is not a space"), (27, " "), (28, "\n"), (29, "end of word 12345 6789.00 "),
]


@pytest.fixture(scope="module")
def spell():
    """The vocabularies, with both files' own libraries as encoders."""
    from tokenizers import Tokenizer

    s, own = align.Spelling(*PATHS), Tokenizer.from_file(PATHS[0])
    own.encode_special_tokens = True
    s.encode = lambda texts: ([own.encode(" " + t, add_special_tokens=False).ids for t in texts], [s.b.encode(t) for t in texts])
    return s


def brute(spell, rows):
    """Whole texts, every pair of tokens that overlap."""
    done, counts = [], collections.Counter()
    for i, text in rows:
        a, b = (x[0] for x in spell.encode([text])) if text else ([], [])
        ta, tb = [spell.a_bytes[x] for x in a], [spell.b_bytes[x] for x in b]
        if not b"".join(ta) == b"".join(tb) == (" " + (text or "")).encode():
            a, b, ta, tb = [], [], [], []
        ea, eb = (np.cumsum([len(x) for x in t]).tolist() for t in (ta, tb))
        links, j = [], 0
        for x, e, t in zip(a, ea, ta):
            while j and eb[j - 1] > e - len(t):
                j -= 1
            while eb[j] <= e - len(t):
                j += 1
            k = j
            while k < len(b) and eb[k] - len(tb[k]) < e:
                links.append((x, b[k]))
                k += 1
        groups, at = [], (0, 0)
        for e in sorted(set(ea) & set(eb)):
            to = (ea.index(e) + 1, eb.index(e) + 1) if len(ea) < 5000 else (int(np.searchsorted(ea, e)) + 1, int(np.searchsorted(eb, e)) + 1)
            groups.append(",".join(map(str, a[at[0]:to[0]])) + "|" + ",".join(map(str, b[at[1]:to[1]])))
            at = to
        counts.update(links)
        done.append((i, len(a), len(b), groups, links))
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return collections.Counter(
        (i, ";".join(g), a, b, len(g), len(l), sum(counts[x] == best[x[1]] for x in l), sum(counts[x] for x in l))
        for i, a, b, g, l in done)


@pytest.mark.parametrize("most", [2_000_000, 5])
def test_alignment_equals_brute_force(spark, spell, clashing, most):
    rows = TRICKY + HARD
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert collections.Counter(map(tuple, align.align(df, *PATHS, most_pairs=most).collect())) == brute(spell, rows)
    got = collections.Counter(map(tuple, align.align(clashing, *PATHS, most_pairs=most).collect()))
    assert got == brute(spell, TRICKY)


def test_both_ways_to_look_up_counts_agree_on_the_documents(spark, spell, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute(spell, texts)
    for most in (2_000_000, 100):
        assert collections.Counter(map(tuple, align.align(docs, *PATHS, most_pairs=most).collect())) == want
    rows = QUERIES["op13_tokenizer_alignment"](spark, SF).collect()
    assert {(r.doc_id, r.n_groups, r.count_sum) for r in rows} == {(x[0], x[4], x[7]) for x in want}
    assert all(len(r.groups_sha256) == (64 if r.n_a else 0) for r in rows)


def test_shared_cuts_by_divide_and_conquer():
    rnd = np.random.default_rng(3)
    for trial in range(200):
        n = int(rnd.integers(1, 400))
        sides = []
        for share in rnd.random(2):
            inner = np.flatnonzero(rnd.random(n) < share) + 1
            sides.append(np.unique(np.append(inner, n)))
        a, b = sides
        cut = align.shared_cuts(a, b, np.array([0, len(a)]), near=int(rnd.integers(1, 9)))
        assert a[cut].tolist() == np.intersect1d(a, b).tolist()
    a = np.arange(2, 200_001, 2)  # a long stretch with one inner cut far from the middle, and one with none
    assert align.shared_cuts(a, np.array([10, 200_000]), np.array([0, len(a)])).sum() == 2
    assert align.shared_cuts(a, np.array([199_999, 200_000]), np.array([0, len(a)])).sum() == 1


def test_units_add_up_to_whole_texts(spell, texts):
    """Cutting at single spaces changes no token."""
    for _, text in [*texts, *HARD]:
        if text:
            parts = align.units_of(text)
            assert parts == align.UNITS(text)
            whole, cut = spell.encode([text]), spell.encode(parts)
            assert [sum(x, []) for x in cut] == [x[0] for x in whole]


def test_empty_table(spark, empty):
    assert align.align(empty, *PATHS).count() == 0
    none = align.align(spark.createDataFrame([(1, None), (2, "")], SCHEMA), *PATHS).collect()
    assert [tuple(r)[1:] for r in none] == [("", 0, 0, 0, 0, 0, 0)] * 2


def test_units_forgotten_and_learnt_again(spell, texts):
    few, many = align.Units(align.Spelling(*PATHS), most=50, most_chars=400), align.Units(align.Spelling(*PATHS))
    rows = [t for _, t in [*texts[:40], *HARD, *texts[:40]]]

    def results(units):
        for k in range(0, len(rows), 7):
            for numbers, size in units.of(rows[k:k + 7]):
                for ids in np.split(numbers, np.cumsum(size)[:-1]):
                    links = [units.links[units.start[i]:units.start[i] + units.counts["n_links"][i]].tolist() for i in ids]
                    yield "".join(units.groups[i] for i in ids), sum(links, []), [int(v[ids].sum()) for v in units.counts.values()]

    assert list(results(few)) == list(results(many)) and len(few.number) < len(many.number) / 5
