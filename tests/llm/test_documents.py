"""Document operators against brute force and against their stated edge cases."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from speechprep.llm import exact_dedup, graph, jaccard, licenses, packing, pieces, pii, quality, sharding

from .conftest import SCHEMA, SF, TRICKY

SPACES = " \t\n\x0b\f\r"


def blank_split(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# ------------------------------------------------------------------ quality
def test_quality_base_on_tricky_rows(tricky, clashing):
    def expected(text):
        text = text or ""
        w = blank_split(text)
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        often = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
        hit = {i + k for i in range(len(w) - 4) if often[tuple(w[i:i + 5])] > 1 for k in range(5)}
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)

    order = list(quality.RULES)
    want = collections.Counter((d, *expected(t)) for d, t in TRICKY)
    for docs in (tricky, clashing):
        rows = quality.score(docs, order).collect()
        assert collections.Counter(tuple(r)[:6] for r in rows) == want
        for r in rows:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_distinct_words_are_judged_by_stretches(spark):
    rnd = random.Random(6)
    long = " ".join(f"word{rnd.randrange(12_000)}" for _ in range(300_000))
    few = " ".join(f"word{rnd.randrange(12)}x{k // 900}" for k in range(30_000))
    rows = [(1, long), (2, few), (3, " ".join(f"w{k % 40}" for k in range(1000)))]
    got = {r.doc_id: r.rejected_by for r in quality.score(spark.createDataFrame(rows, SCHEMA), [r for r in quality.RULES if r.name == "few_distinct_words"]).collect()}
    assert got[1] is None and got[2] in ("base", "few_distinct_words") and got[3] in ("base", "few_distinct_words")
    rule = next(r.rejects for r in quality.RULES if r.name == "few_distinct_words")
    from pyspark.sql import functions as F

    for n, k, want in ((50, 2, True), (50, 3, False), (2000, 99, True), (2000, 101, False), (49, 1, False)):
        words = [f"w{i % k}" if n <= 1000 else f"{i // 1000}w{i % 1000 % k}" for i in range(n)]
        share = sum(len(set(words[x:x + 1000])) for x in range(0, n, 1000))
        got = spark.createDataFrame([(words, n)], "_words array<string>, n_words long").select(F.expr(rule).alias("x")).first().x
        assert got == (n >= 50 and 20 * share < n)


def test_quality_verdict_does_not_depend_on_the_order(spark, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    order = [s["rule"] for s in quality.rule_order(docs, sample_rows=100)]
    assert sorted(r.name for r in order) == sorted(r.name for r in quality.RULES)
    a = quality.filter_docs(docs, order).collect()
    b = quality.filter_docs(docs, order[::-1]).collect()
    assert sorted(a, key=str) == sorted(b, key=str) and 0 < len(a) < docs.count()
    assert quality.filter_docs(docs, order).columns == docs.columns
    assert quality.score(empty).count() == 0


def test_quality_order_prefers_rejections_per_cost(spark):
    rows = [(i, "a b c d e f g h i j k # # # # #") for i in range(50)]
    stats = quality.rule_order(spark.createDataFrame(rows, SCHEMA), sample_rows=50)
    top = [s for s in stats if s["selectivity"] > 0.9]
    assert {s["rule"].name for s in top} >= {"symbol_heavy"} and stats[0] in top


# ------------------------------------------------------------------ exact dedup
@pytest.mark.parametrize("digest", [exact_dedup.sha, lambda c: exact_dedup.F.substring(exact_dedup.sha(c), 1, 1)])
def test_exact_dedup_even_with_colliding_digests(tricky, digest):
    rows = exact_dedup.groups(tricky, digest).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    members = collections.defaultdict(list)
    for d, t in TRICKY:
        members[norm(t)].append(d)
    want = collections.Counter()
    for d, t in TRICKY:
        ids = members[norm(t)]
        want[d, min((x for x in ids if x is not None), default=None), len(ids)] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size) for r in rows) == want
    assert sum(r.kept for r in rows) == len(members)


def test_exact_dedup_keeps_one_row_of_each_content(spark, clashing, empty):
    kept = exact_dedup.filter_docs(clashing)
    assert kept.columns == clashing.columns
    rows = kept.collect()
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in rows]
    assert len(norm) == len(set(norm)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in TRICKY})
    assert exact_dedup.groups(empty).count() == 0 and exact_dedup.filter_docs(empty).count() == 0


def test_exact_dedup_hot_group_is_salted(spark):
    rows = [(i, "the same text") for i in range(400)] + [(1000 + i, f"text {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(16)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.groups(docs).collect()}
    assert all(got[i] == (0, 400, i == 0) for i in range(400)) and all(got[1000 + i] == (1000 + i, 1, True) for i in range(400))


# ------------------------------------------------------------------ licences
def test_licence_rules_are_hundreds_and_compile():
    rules = licenses.rules()
    assert len(rules) > 300 and len({r["regex"] for r in rules}) == len(rules)
    for r in rules:
        assert r["anchor"] in licenses.ANCHORS
        re.compile(r["regex"])


def test_licence_prefilter_never_hides_a_match(texts):
    """Every rule alone, without its keyword gate, finds nothing more."""
    lines = [x for _, t in texts for x in (t or "").lower().split("\n") if "licen" in x]
    lines += ["spdx-license-identifier: gpl-3.0-or-later", "see https://www.apache.org/licenses/license-2.0",
              "under the gnu lesser general public license, version 2.1", "this is in the public domain"]
    for r in licenses.rules():
        for x in lines:
            if re.search(r["regex"], x):
                assert r["anchor"] in x and any(k in x for k in r["keyword"].split("|")), (r, x)


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "   "])
def test_licence_notices_are_found_wrapped_and_commented(spark, mark):
    isc = "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted"
    gpl = "it under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 2"
    every = "Permission\nto\nuse,\ncopy,\nmodify,\nand/or\ndistribute\nthis\nsoftware\nfor\nany\npurpose"
    rows = [(i, mark + t.replace("\n", "\n" + mark)) for i, t in enumerate((isc, gpl, every, "under the mit.\nLicense fees"))]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert "isc" in got[0].labels and "isc" in got[2].labels and got[3].detections == []
    assert [d.confidence for d in got[1].detections if d.label == "gpl"][:1] == [0.95]


def test_licence_base_and_suppression(spark, tricky, empty):
    rows = [(1, "Released under the MIT License."), (2, "mit, LICENSE. The General-Public license; apache license"),
            (3, "SPDX-License-Identifier: Apache-2.0\n"), (4, "permit license, licenses"), (5, None)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].base_labels, got[1].labels) == (5, 1, 3, "mit", "mit")
    assert [d.label for d in got[1].detections] == ["mit"] and got[1].detections[0].start == 0
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (3, 0, 6, "apache,gpl,mit")
    assert got[3].labels == "apache" and got[3].score == 1.0 and got[3].n_base == 0
    assert got[4].n_base == 0 and got[5].n_words == 0 and got[5].score == 0.0 and got[5].first_word is None
    assert licenses.scan(tricky).count() == len(TRICKY) and licenses.scan(empty).count() == 0


# ------------------------------------------------------------------ personal data
def base_spans(text):
    def luhn(digits):
        return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0

    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if max(map(int, m[0].split("."))) <= 255]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_pii_base_on_generated_texts(spark):
    rnd = random.Random(5)
    bits = ["a@b.c", "x.y@z-w.org", "@", "..", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+1 (212) 555-0100", "+123", "+1234567890123456", " ", " ", "_", "-", "7", "é", "", "a@b.c_d@e.f", "a@b..c", "1 2 3"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 14)))) for i in range(400)]
    rows = [(i, t) for i, t in rows if len(re.findall("[0-9]", t)) < 4000]
    model = {"weights": {}, "bias": -1.0}
    got = {r.doc_id: r for r in pii.detect(spark.createDataFrame(rows, SCHEMA), model).collect()}
    for i, t in rows:
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in base_spans(t))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), (t, want, got[i].spans)
        assert [got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone] == [
            sum(k == x for k, _, _ in base_spans(t)) for x in pii.BASE_KINDS]


def test_pii_em_finds_the_reliable_labeler():
    rnd = random.Random(1)
    counts = collections.Counter()
    for _ in range(4000):
        z = rnd.random() < 0.6
        vote = lambda right: "+" if (rnd.random() < right) == z else "-"
        counts["0" + vote(0.95) + vote(0.55) + vote(0.9) + vote(0.8) + "0"] += 1
    p, model = pii.em(dict(counts))
    rel = model["labelers"]
    assert rel["gazetteer"]["yes_if_true"] > 0.9 and abs(rel["context"]["yes_if_true"] - 0.55) < 0.08
    assert abs(model["prior"] - 0.6) < 0.06 and p["0++++0"] > 0.95 > 0.05 > p["0----0"]
    assert pii.em({})[0] == {}


def test_pii_learns_to_add_spans(spark):
    good = [(i, f"Call me: ({200 + i % 700}) {300 + i % 600}-{1000 + 7 * i % 9000} today") for i in range(200)]
    good += [(500 + i, f"phone: +1 (212) 555-{1000 + i} ok") for i in range(100)]
    docs = spark.createDataFrame(good, SCHEMA)
    found = pii.detect(docs).where("spans like 'phone:%'").count()
    assert found > 250


def test_pii_adds_obfuscated_mails_and_short_cards(spark):
    def with_check(start, n):
        body = (start + "".join(rnd.choice("0123456789") for _ in range(n)))[:n - 1]
        return next(body + c for c in "0123456789" if sum(sum(divmod(int(x) * (1 + k % 2), 10)) for k, x in enumerate(reversed(body + c))) % 10 == 0)

    rnd = random.Random(11)
    docs = [(i, f"contact: ann{i}@example{i % 7}.com or card: {with_check('4', 16)} soon") for i in range(100)]
    docs += [(200 + i, f"contact: bob{i} [at] example{i % 7} [dot] com today") for i in range(60)]
    docs += [(400 + i, f"card: {with_check('37', 15)} soon") for i in range(60)]
    wrong = [c[:-1] + str((int(c[-1]) + 1) % 10) for c in (with_check("37", 15) for _ in range(60))]
    docs += [(600 + i, f"order {c} and 300.{i}.1.1 here") for i, c in enumerate(wrong)]
    rows = spark.createDataFrame(docs, SCHEMA)
    got = {r.doc_id: r for r in pii.detect(rows).collect()}
    assert all(got[200 + i].spans.startswith("email:9:") and got[200 + i].n_email == 0 for i in range(60))
    assert all(got[400 + i].spans == "card:6:21" and got[400 + i].n_card == 0 for i in range(60))
    assert all(got[600 + i].spans == "" for i in range(60))
    clean = {r.doc_id: r.text for r in pii.redact(rows).collect()}
    assert clean[200] == "contact: [EMAIL] today" and clean[400] == "card: [CARD] soon"


def test_pii_features_are_closed_and_all_weighted(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"{chr(0x4e00 + i)}{chr(0x2190 + i % 100)}{i % 10}00-12-{1000 + i} {chr(0x2500 + i % 120)} +1{'-' * (i % 40)}212555010{i % 10}") for i in range(2600)]
    docs = spark.createDataFrame(rows, SCHEMA)
    text = F.col("text")
    got = docs.select(F.explode(pii.candidates(text)).alias("x")).select(F.explode(pii.features(F.col("x"))).alias("f")).distinct()
    values = {r.f for r in got.collect()}
    assert sum(f.startswith("left=") for f in values) <= 37 * 37 and sum(f.startswith("shape=") for f in values) <= len(pii.KINDS) * pii.SHAPES
    assert values == set(pii.fit(docs)["weights"])


def test_pii_redaction(spark, tricky, clashing, empty):
    out = pii.redact(clashing, {"weights": {}, "bias": -1.0})
    assert out.columns == clashing.columns and out.count() == len(TRICKY)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[9] == "Mail [EMAIL] or [PHONE], card [CARD]." and texts[1] is None and texts[2] == ""
    assert texts[4] == "one two three" and texts[14] == "[EMAIL]"
    n = pii.redact(spark.createDataFrame([(1, "at a@b.cd now", 13)], SCHEMA + ", n_chars long"), {"weights": {}, "bias": 0.0}).first()
    assert (n.text, n.n_chars) == ("at [EMAIL] now", 14)
    assert pii.detect(empty).count() == 0 and pii.redact(empty).count() == 0
    assert pii.detect(tricky).count() == len(TRICKY)


# ------------------------------------------------------------------ pieces
def test_pieces_are_lossless_and_reproducible(spark, tricky, empty):
    rows = pieces.decode(pieces.encode(tricky)).collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in rows) == collections.Counter((d, t or "") for d, t in TRICKY)
    once = {(r.doc_id, r.decoded): r.ids for r in rows}
    for r in pieces.decode(pieces.encode(tricky.repartition(5))).collect():
        assert once[r.doc_id, r.decoded] == r.ids
    other = pieces.decode(pieces.encode(tricky, seed=2)).collect()
    assert any(once[r.doc_id, r.decoded] != r.ids for r in other)
    assert pieces.decode(pieces.encode(empty)).count() == 0


def test_pieces_with_keys_of_any_type(spark, clashing):
    rows = [("a", "the same text here"), ("b", "the same text here"), (None, "the same text here"), ("a", "the same text here")]
    got = [tuple(r.ids) for r in pieces.encode(spark.createDataFrame(rows, "doc_id string, text string").coalesce(1)).collect()]
    assert got[0] == got[3]
    for kind, keys in (("double", [1.5, 2.5]), ("date", [__import__("datetime").date(2020, 1, 1), None]), ("decimal(9,2)", [__import__("decimal").Decimal("1.25"), None])):
        df = spark.createDataFrame([(k, "some text") for k in keys], f"doc_id {kind}, text string")
        assert [r.decoded for r in pieces.decode(pieces.encode(df)).collect()] == ["some text"] * 2
    assert collections.Counter((r.doc_id, r.decoded) for r in pieces.decode(pieces.encode(clashing)).collect()) == collections.Counter((d, t or "") for d, t in TRICKY)


def test_pieces_follow_the_lattice_distribution():
    model = pieces.Model(pieces._model_path(None))
    lattices, text = pieces.Lattices(model), "the cat"
    paths = {}

    def walk(at, ids, weight, s=text.replace(" ", "▁")):
        if at == len(s):
            paths[tuple(ids)] = np.exp(weight)
        for end in range(at + 1, len(s) + 1):
            if s[at:end] in model.weight:
                i, w = model.weight[s[at:end]]
                walk(end, [*ids, i], weight + w)

    walk(0, [], 0.0)
    whole = sum(paths.values())
    n = 6000
    flat, offsets, score = pieces.sample([text] * n, list(range(n)), model, lattices, 3)
    drawn = collections.Counter(tuple(flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:]))
    assert set(drawn) <= set(paths)
    for p, w in paths.items():
        assert abs(drawn[p] / n - w / whole) < 4 * (w / whole / n) ** 0.5 + 2e-3
    assert abs(np.exp(score[0]) - paths[tuple(flat[: offsets[1]].tolist())]) < 1e-6


# ------------------------------------------------------------------ packing
def check_packing(docs, rows, window=2048):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = collections.Counter()
    for d, text in docs:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        want[d] += len(ids)
        for r in rows:
            if r.doc_id == d and r.doc_tokens == len(ids) and docs.count((d, text)) == sum(x[0] == d for x in docs):
                assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    got = collections.Counter()
    sequences = collections.defaultdict(list)
    for r in rows:
        got[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for s in sequences.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= window
    return len(sequences), sum(want.values())


def test_packing_tricky_rows(tricky, empty):
    n, tokens = check_packing(TRICKY, packing.pack(tricky.coalesce(1)).collect())
    assert n == -(-tokens // 2048)
    assert packing.pack(empty).count() == 0


def test_packing_with_clashing_columns(clashing):
    check_packing(TRICKY, packing.pack(clashing.coalesce(1)).collect())


def test_packing_cached_words_equal_the_tokenizer():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    cache = packing.WordCache(path, size=20)
    rnd = random.Random(2)
    bits = ["Hello", "don't", "we'll", "A.", "ÀB,", "x1", "é.", "…", "<|endoftext|>", "日本", "İx", "ΣΑΣ", "ſ", "é", " ", "\x1c", "\x0b", "10", "!!", "'s"]
    for _ in range(300):
        text = "".join(rnd.choice(bits) + rnd.choice(["", " ", "\n", "\t", "  ", "\r\n"]) for _ in range(rnd.randint(0, 12)))
        want = np.array(cache.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert cache.ids(text) == want, text


def test_packing_rule_is_least_sum_of_squares():
    rnd = random.Random(4)
    packer = packing.Packer(0, window=20, max_open=10**6)
    for k in range(400):
        size = rnd.randint(1, 19)
        before = packer.counts.copy()
        best = min(
            ((((before + change) ** 2)[1:20].sum(), -level) for level in range(0, 21 - size)
             for change in [_change(level, size)] if level == 0 or before[level] > 0))
        level = packer.best_level(size)
        assert (best[0], -best[1]) == (((before + _change(level, size)) ** 2)[1:20].sum(), level)
        packer.add(k, b"\0\0\0\0" * size)
    packer.pour()
    assert sum(1 for _ in {r[5] for r in packer.done}) == -(-sum(r[2] for r in packer.done) // 20)


def _change(level, size, window=20):
    c = np.zeros(window + 1, dtype=np.int64)
    c[level] -= level > 0
    c[level + size] += 1
    return c


def test_packing_bounds_open_windows():
    packer = packing.Packer(0, window=10, max_open=5)
    for k in range(200):
        packer.add(k, b"\0\0\0\0" * 6)
        assert packer.n_open <= 6
    packer.pour()
    assert sum(r[2] for r in packer.done) == 1200


# ------------------------------------------------------------------ sharding
def test_shards_are_even_seeded_and_whole(spark, tricky, clashing, empty):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(1000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    shuffled = lambda d, **k: sorted((r.shard, r.slot, r.row.doc_id) for r in sharding.shuffle(d, bucket_bytes=5000, **k).collect())
    a = shuffled(docs)
    assert a == shuffled(docs.repartition(9)) and a != shuffled(docs, seed=18)
    slots = collections.defaultdict(list)
    for s, k, _ in a:
        slots[s].append(k)
    assert all(v == list(range(len(v))) for v in slots.values())
    assert sorted(map(len, slots.values())) == [62] * 8 + [63] * 8
    order = [d for _, _, d in a]
    assert sorted(order) == list(range(1000)) and abs(np.corrcoef(order, range(1000))[0, 1]) < 0.12
    for d in (tricky, clashing):
        out = sharding.shuffle(d)
        assert collections.Counter((r.row.doc_id, r.row.text) for r in out.collect()) == collections.Counter(TRICKY)
    assert sharding.shuffle(empty).count() == 0


def test_shards_scatter_repeated_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "same")] * 600 + [(i, "other") for i in range(2, 600)], SCHEMA)
    out = sharding.shuffle(docs, bucket_bytes=500)
    per = [r["count"] for r in out.where("row.doc_id = 1").groupBy("shard").count().collect()]
    assert sum(per) == 600 and max(per) < 80
    sharding.write_shards(out, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 1198


# ------------------------------------------------------------------ Jaccard
def word_sets(docs):
    out = []
    for _, t in docs:
        w = [x.lower() if x.isascii() else "".join(c.lower() if c.isascii() else c for c in x) for x in blank_split(t)]
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute_components(docs):
    sets = word_sets(docs)
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    named = collections.defaultdict(list)
    for i, (d, _) in enumerate(docs):
        named[root(i)].append(d)
    return collections.Counter(
        (d, len(sets[i]), d if not sets[i] else min((x for x in named[root(i)] if x is not None), default=None))
        for i, (d, _) in enumerate(docs))


def near_copies(seed, n=260):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)]
    shared = [rnd.choice(vocab) for _ in range(30)]
    bases = [[rnd.choice(vocab) for _ in range(rnd.choice([3, 5, 6, 12, 40, 120, 400]))] for _ in range(25)]
    docs = []
    for i in range(n):
        w = list(rnd.choice(bases))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 6])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        if rnd.random() < 0.2:
            w += shared
        docs.append((i, " ".join(x.upper() if rnd.random() < 0.1 else x for x in w)))
    return docs


@pytest.mark.parametrize("block,per_task", [(20_000, 1 << 18), (7, 8)])
def test_jaccard_components_are_complete(spark, block, per_task):
    docs = near_copies(block) + [(10_000 + i, t) for i, (_, t) in enumerate(TRICKY) if t is None or len(t) < 9000]
    got = jaccard.join(spark.createDataFrame(docs, SCHEMA).repartition(6), block, per_task).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(docs)


def test_jaccard_of_a_neighbourhood_split_by_shingle(spark):
    docs = near_copies(3)
    got = jaccard.join(spark.createDataFrame(docs, SCHEMA).repartition(6), 7, 8, spread=3, wide=1, block_shingles=300).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(docs)


def test_jaccard_of_a_large_group_just_below_the_threshold(spark):
    """Texts of one source, each with words of its own: most pairs are a little
    under 80 per cent, some above."""
    rnd = random.Random(12)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(700):
        w = list(base)
        for k in rnd.sample(range(200), rnd.choice([1, 2, 3, 3, 3, 4])):
            w[k] = f"own{i}x{k}"
        docs.append((i, " ".join(w)))
    sets = word_sets(docs)
    below = sum(70 * len(a | b) <= 100 * len(a & b) < 80 * len(a | b) for i, a in enumerate(sets[:60]) for b in sets[:i])
    assert below > 300
    got = jaccard.join(spark.createDataFrame(docs, SCHEMA).repartition(6), 64).collect()
    assert collections.Counter(tuple(r) for r in got) == brute_components(docs)


def test_jaccard_copies_leave_a_task_once(spark):
    docs = spark.createDataFrame([(i, f"text {i} of its own with words") for i in range(20)] + [(99, "a hot text of copies " * 3)] * 400, SCHEMA)
    rows = jaccard._docs(docs.coalesce(1)).select("mix", "text").mapInArrow(jaccard._once, "mix long, text string")
    assert rows.count() == 21 == rows.distinct().count()
    sets = jaccard.sets_of(docs)
    got = jaccard.contents(docs.repartition(5), sets, sets.where("c IS NOT NULL").select("c").distinct()).collect()
    assert len(got) == 21 == len({r.c for r in got})


def test_jaccard_edges(spark, clashing, empty):
    assert jaccard.join(empty).count() == 0
    kept = jaccard.filter_docs(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {1, 2, 3, 4, 6, 7} <= set(ids) and 10 not in ids and 5 not in ids


def test_rtree_join_loses_no_pair():
    rnd = np.random.default_rng(3)
    sets = [set(rnd.integers(0, 400, size=rnd.integers(20, 60)).tolist()) for _ in range(150)]
    sets += [set(list(s)[: len(s) - 2]) | {1000 + k} for k, s in enumerate(sets[:80])]
    points = np.zeros((len(sets), 16), dtype=np.int32)
    for k, s in enumerate(sets):
        np.add.at(points[k], [x % 16 for x in s], 1)
    sizes = np.array([len(s) for s in sets])
    comps = np.arange(len(sets)) // 2
    tree = jaccard.RTree(points, sizes, comps, fan=4)
    found = {(min(a, b), max(a, b)) for x, y in tree.join(tree) for a, b in zip(x.tolist(), y.tolist())}
    linked = {(i, j) for j in range(len(sets)) for i in range(j)
              if comps[i] != comps[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])}
    assert linked <= found and len(found) < len(sets) ** 2 / 8


@pytest.mark.parametrize("per_task", [1 << 18, 16])
def test_components(spark, per_task):
    rnd = random.Random(8)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u long, v long").repartition(4), per_task).collect()))
    import itertools

    reach = {x: {x} for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.chain(edges, ((b, a) for a, b in edges)):
            if not reach[b] <= reach[a]:
                reach[a] |= reach[b]
                changed = True
    assert got == {x: min(r) for x, r in reach.items() if x in got} and set(reach) >= set(got)
    assert all(x in got for a, b in edges if a != b for x in (a, b))
