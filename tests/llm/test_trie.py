"""Operator 11 against a trie built turn by turn in one process."""

import collections
import hashlib
import random
import zlib

import pytest

from speechprep.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = (abs(c) - abs(c) % 100) * (1 if c >= 0 else -1)
        turns = [(x[2], x[4]) for x in sorted(own[c])]
        first = [(x[2], x[4]) for x in sorted(own.get(base, []))]
        built[c] = tuple(first[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    kids = collections.defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
    out = collections.Counter()
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(built[c]) == len(p))))
        out[(min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids[p]), leaves[p], saved[p],
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def nodes(df, **k):
    return collections.Counter(tuple(r) for r in trie.trie(df, **k).collect())


def chats(seed, n=60, hot=0):
    rnd = random.Random(seed)
    ids = rnd.sample(range(-150, 420), n)
    rows = []
    for c in ids:
        for t in range(rnd.choice([0, 1, 2, 3, 5, 8, 12])):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["user", "assistant", None]), rnd.choice(["", None, "a", "bb", "日本"])))
        rows.append((c, 0, "user", "hello"))
    for c in ids[:2]:  # two long conversations with the same turns
        rows += [(c, 100 + t, "user", f"x{t % 7}") for t in range(hot)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 0), (2, 0), (3, 300), (4, 900)])
def test_trie_equals_brute_force(spark, seed, hot):
    rows = chats(seed, hot=hot)
    want = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert nodes(df) == want
    assert nodes(df, cells=1 << 16) == want


def test_a_conversation_in_several_slices(spark):
    """Ranges cut long conversations, among them the first of a block."""
    rows = [(200, t, "user", f"x{t % 5}") for t in range(500)] + [(203, t, "user", f"x{t % 5}") for t in range(700)]
    rows += [(205, t, "user", f"x{t % 5}") for t in range(499)] + [(7, 0, "user", "alone"), (8, None, None, None)]
    rows += [(None, 0, "user", "nobody's")] * 5
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    same = [(11, 1, "user", "again")] * 400 + [(12, 1, "user", "again")] * 400  # equal rows in any slice
    assert nodes(spark.createDataFrame(same, SCHEMA)) == brute(same)


def test_a_sketch_that_proves_nothing_changes_nothing(spark):
    rows = chats(5, hot=50)
    df = spark.createDataFrame(rows, SCHEMA)
    prefixes, before = trie.rebuilt(df)
    planes = trie.sketch(prefixes, before, prefixes.count())
    full = planes.copy()
    full[:] = 255
    few = trie.screened(prefixes, before, planes).where("tail").count()
    assert few > 0 and trie.screened(prefixes, before, full).where("tail").count() == 0
    # what is proven single is single
    marked = trie.screened(prefixes, before, planes)
    assert marked.where("tail").join(marked.groupBy("key").count().where("count > 1"), "key").count() == 0


def test_a_common_first_turn_and_many_copies(spark):
    rows = [(c, t, "user", "common" if t == 0 else f"t{c % 3}") for c in range(1000, 1900) for t in range(3)]
    assert nodes(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_and_extra_columns(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = chats(6)
    extra = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA + ", depth int, key string, slice int")
    assert nodes(extra) == brute(rows)
    lone = [(3, 0, "user", "x" * 200_000)]
    assert nodes(spark.createDataFrame(lone, SCHEMA)) == brute(lone)
