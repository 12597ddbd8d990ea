"""Names, paths, lyrics, routing and pruning rules (fixed cases)."""

from pyspark.sql import functions as F

from speechprep.functions import lyrics, names, paths, tts, urls
from speechprep.operators import filters


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr(F.col("v")).alias("o")).first().o


def test_lyric_words(spark):
    df = spark.createDataFrame([(1, "[00:04.260]遠[00:04.94]い[00:05.150]")], "song_id long, yrc string")
    got = [(r.line_no, r.word_no, r.time_ms, r.text) for r in lyrics.explode_word_lyrics(df, "song_id", "yrc").collect()]
    assert got == [(0, 0, 4260, "遠"), (0, 1, 4940, "い")]


def test_lyric_line_numbers_after_dropping(spark):
    text = "[00:01.00]\n[00:02.00]a[00:03.00]\n\n[00:04.00]b"
    df = spark.createDataFrame([(1, text)], "song_id long, yrc string")
    got = [(r.line_no, r.text) for r in lyrics.explode_word_lyrics(df, "song_id", "yrc").collect()]
    assert got == [(0, "a"), (1, "b")]


def test_lyric_tags(spark):
    lrc = "[ti: One]\n[ar: A]\n[ti:Two ]\nx"
    assert _one(spark, lambda c: lyrics.lyric_tag(c, "ti"), lrc) == "Two"
    assert _one(spark, lambda c: lyrics.lyric_tag(c, "ar"), lrc) == "A"
    assert _one(spark, lambda c: lyrics.lyric_tag(c, "ar"), "none") == "unknown"


def test_stems(spark):
    assert _one(spark, lambda c: paths.stem_first_dot(paths.file_name(c)), "d/a.b.wav") == "a"
    assert _one(spark, lambda c: paths.stem_last_dot(paths.file_name(c)), "d/a.b.wav") == "a.b"
    assert _one(spark, lambda c: paths.with_suffix(c, ".txt"), "d/a.b.wav") == "d/a.b.txt"


def test_cleaners(spark):
    t = ' a/b:  "c"? '
    assert _one(spark, names.clean_replace, t) == "a_b_ _c__"
    assert _one(spark, names.clean_remove, t) == "ab  c"
    assert _one(spark, names.clean_capped, t) == "ab c"
    assert _one(spark, names.clean_slashes, t) == 'a_b:  "c"?'
    assert _one(spark, names.clean_alnum, "héllo, wörld!_1 ") == "héllo wörld_1"
    long = "x" * 60 + ".mp3"
    assert _one(spark, names.clean_capped, long) == "x" * 46 + ".mp3"


def test_truncate_words(spark):
    s = "alpha beta gamma delta epsilon"
    assert _one(spark, lambda c: names.truncate_words(c, 20), s) == "alpha beta gamma"
    assert _one(spark, lambda c: names.truncate_words(c, 100), s) == s
    assert _one(spark, lambda c: names.truncate_words(c, 7), "abcdefghij") == "abcdefg"


def test_language(spark):
    cases = {"hi-IN": "hi", " English ": "en", "spa_ES": "es", "": "unknown", "pt.BR": "pt", "xx": "xx"}
    for raw, want in cases.items():
        assert _one(spark, names.normalize_language, raw) == want
    assert spark.createDataFrame([(None,)], "v string").select(names.normalize_language(F.col("v"))).first()[0] == "unknown"


def test_guess_extension(spark):
    df = spark.createDataFrame([("https://h/x/a.MP3?x=1", None), ("https://h/a", "audio/ogg; codecs=opus"),
                                ("https://h/a", None), ("https://h/a.flac#t", "audio/mpeg")], "u string, ct string")
    got = [r[0] for r in df.select(urls.guess_extension(F.col("u"), F.col("ct"))).collect()]
    assert got == [".mp3", ".ogg", ".mp3", ".flac"]


def test_resource_ids(spark):
    i = "A" * 22
    df = spark.createDataFrame([(f"https://open.example.org/intl-es/episode/{i}?si=1",), (f"x:show:{i}",)], "u string")
    got = df.select(urls.resource_id(F.col("u"), "episode").alias("e"), urls.resource_id(F.col("u"), "show").alias("s")).collect()
    assert (got[0].e, got[0].s, got[1].e, got[1].s) == (i, None, None, i)


def test_join_url(spark):
    base = "http://h.org/a/b?q=1"
    df = spark.createDataFrame([("/x",), ("y.ts",), ("//c.org/z",), ("https://d/e",)], "r string")
    got = [r[0] for r in df.select(urls.join_url(F.lit(base), F.col("r"))).collect()]
    assert got == ["http://h.org/x", "http://h.org/a/y.ts", "http://c.org/z", "https://d/e"]


def test_routing_and_prune(spark):
    df = spark.createDataFrame([("a", 30000), ("b", None), ("c", 30001), ("d", 0)], "path string, duration_ms long")
    got = {r.path: r.route for r in filters.route_by_duration(df).collect()}
    assert got == {"a": "short", "b": "unreadable", "c": "long", "d": "short"}
    failed = spark.createDataFrame([("a",)], "path string")
    got = {r.path: r.route for r in filters.route_by_duration(df, failed_short=failed).collect()}
    assert got["a"] == "long"
    p = spark.createDataFrame([(x,) for x in (4999, 5000, 45000, 45001, None)], "duration_ms long")
    assert [r.keep for r in filters.prune_clips(p).collect()] == [False, True, True, False, True]
    assert filters.filter_duration_range(p, 5000, 45000).count() == 2


def test_tts_params(spark):
    df = spark.createDataFrame([("bad", "99", "fast"), ("150", "64", "normal"), (None, None, None), ("301", "192", "balanced")],
                               "c string, b string, l string")
    got = [tuple(r) for r in df.select(tts.chunk_length(F.col("c")), tts.mp3_bitrate(F.col("b")), tts.latency(F.col("l"))).collect()]
    assert got == [(200, 128, "balanced"), (150, 64, "normal"), (200, 128, "balanced"), (200, 192, "balanced")]
    assert _one(spark, lambda c: tts.voice_cluster(c), "S_abc") == "volcano_icl"


def test_python_whitespace_rules(spark):
    from speechprep.functions.text import collapse_ws, rstrip, strip

    raw = " \x1c a  \t b 　\n"
    assert _one(spark, strip, raw) == raw.strip()
    assert _one(spark, rstrip, raw) == raw.rstrip()
    import re
    assert _one(spark, collapse_ws, raw) == re.sub(r"\s+", " ", raw)


def test_media_plans(spark):
    from speechprep.functions import media

    df = spark.createDataFrame([("a/x.wav", "wav"), ("a/y.OPUS", "OPUS"), ("a/z.v1.mp3", "mp3")], "path string, ext string")
    sep = {r.path: (r.fmt, r.out_path, r.replace_original) for r in media.output_format_plan(df).collect()}
    assert sep == {"a/x.wav": ("wav", "a/x.wav", False), "a/y.OPUS": ("opus", "a/y.OPUS", False),
                   "a/z.v1.mp3": ("other", "a/z.v1.opus", True)}
    tr = {r.path: (r.target_path, r.codec, r.skip) for r in media.transcode_plan(df, "wav").collect()}
    assert tr["a/x.wav"] == ("a/x.wav", "pcm_s16le", True) and tr["a/z.v1.mp3"] == ("a/z.v1.wav", "pcm_s16le", False)
    op = {r.path: (r.target_path, r.bitrate) for r in media.transcode_plan(df, "opus").collect()}
    assert op["a/x.wav"] == ("a/x.opus", "128k")
    rep = media.unit_report(spark.createDataFrame([("p", 1572864, 5400000)], "path string, bytes long, duration_ms long")).first()
    assert (rep.mib, rep.hours, rep.seconds) == (1.5, 1.5, 5400.0)


def test_path_caps_and_artifact_names(spark):
    import datetime as dt

    df = spark.createDataFrame([("L" * 150, "t" * 120 + ".mp3", 7)], "lang string, f string, seq long")
    row = df.select(names.cap_album_dir(F.col("lang"), F.lit("T" * 120), F.lit("slug")).alias("d")).first()
    assert row.d == "L" * 150 + "/" + "T" * 49  # 100-char title cut by the 51-char excess over 200
    long_dir = "D" * 200
    got = df.select(names.cap_episode_file(F.lit(long_dir), F.col("f"), F.col("seq")).alias("e")).first().e
    assert got == "t" * 45 + ".mp3" and len(long_dir) + 1 + len(got) == 250
    got = df.select(names.cap_episode_file(F.lit("D" * 245), F.col("f"), F.col("seq")).alias("e")).first().e
    assert got == "episode_7.mp3"
    ts = spark.createDataFrame([(dt.datetime(2024, 5, 6, 7, 8, 9),)], "t timestamp_ntz")
    r = ts.select(names.volume_name(F.lit("en"), F.col("t"), F.lit(3)).alias("v"),
                  names.piece_name(F.lit("a"), F.lit(1234), F.lit(".wav")).alias("p"),
                  names.chunk_name(F.lit("a"), F.lit(2)).alias("c"),
                  names.transcript_file_name(F.lit("al")).alias("j")).first()
    assert (r.v, r.p, r.c, r.j) == ("en_20240506_070809_003.tar", "a_1234.wav", "a_2.wav", "transcription_al.json")


def test_urls_and_tts_paths(spark):
    u = "https://h.org/p/q?count=5&offset=0&id=x#frag"
    df = spark.createDataFrame([(u, "a.b.txt")], "u string, n string")
    r = df.select(urls.query_param(F.col("u"), "id").alias("id"),
                  urls.with_query(F.col("u"), F.lit("count=100&offset=200")).alias("w"),
                  urls.strip_fullwidth_parens(F.lit(" 名字（注）x ")).alias("s"),
                  tts.output_path("out", F.col("n"), F.lit("mp3")).alias("o"),
                  tts.stem_output_path("out", F.col("n"), F.lit("wav")).alias("t")).first()
    assert (r.id, r.w, r.s) == ("x", "https://h.org/p/q?count=100&offset=200#frag", "名字x")
    assert (r.o, r.t) == ("out/a.b.mp3", "out/a.b.wav")


def test_filter_lyrics_sources(spark):
    df = spark.createDataFrame([(1, "[00:01.00]a", "x"), (2, "", "[00:01.00]line"), (3, "", "plain"), (4, None, None)],
                               "song_id long, yrc string, lrc string")
    got = {r.song_id: (r.source, r.lrc_kept) for r in lyrics.filter_lyrics(df).collect()}
    assert got == {1: ("yrc", ""), 2: ("lrc", "[00:01.00]line")}


def test_join_url_by_rfc3986(spark):
    from urllib.parse import urljoin

    from pyspark.sql import functions as F

    from speechprep.functions import urls

    bases = ["http://h", "http://h/", "http://h/a/b/c?x=1#f", "https://h:8080/a/b/", "http://h/a"]
    refs = ["x", "./x", "../x", "../../x", "../../../../x", "/x", "/a/./b/../c", "//other/y", "?q=1", "#z", "", "x?y=1#z", "https://o/p",
            "a/b/../c", "..", ".", "./", "../", "x/.", "x/.."]
    rows = [(b, r) for b in bases for r in refs]
    df = spark.createDataFrame(rows, "b string, r string").select("b", "r", urls.join_url(F.col("b"), F.col("r")).alias("u"))
    for x in df.collect():
        assert x.u == urljoin(x.b, x.r), (x.b, x.r, x.u, urljoin(x.b, x.r))


def test_collapse_knows_every_white_space(spark):
    import re

    from speechprep.functions.text import collapse_ws

    texts = [f"a{chr(k)}b{chr(k)}{chr(k)}c" for k in range(1, 0x3100) if not 0xD800 <= k < 0xE000]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    for r in df.select("x", collapse_ws(df.x).alias("y")).collect():
        assert r.y == re.sub(r"\s+", " ", r.x)
