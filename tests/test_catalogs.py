"""Landed catalog pages and URL lists."""

from pyspark.sql import functions as F

from speechprep.sources import catalogs


def test_paginate_rules(spark):
    rows = [("a", 1, 2), ("a", 2, 2), ("a", 3, 1), ("a", 4, 2),      # short page 3 is the last
            ("b", 1, 2), ("b", 2, 0), ("b", 3, 2),                    # empty page 2 stops before it
            ("c", 1, 2), ("c", 2, 2), ("c", 3, 2)]                    # total count 4 reached on page 2
    df = spark.createDataFrame(rows, "src string, page_no long, n long")
    total = F.when(F.col("src") == "c", F.lit(4))
    got = catalogs.paginate_until_last(df, F.col("n"), 2, source="src", total_count=total)
    assert sorted((r.src, r.page_no) for r in got.collect()) == [("a", 1), ("a", 2), ("a", 3), ("b", 1), ("c", 1), ("c", 2)]


def test_read_url_list(spark):
    df = spark.createDataFrame([(1, " http://a \n# note\n\nhttp://b\nhttp://a"), (2, "http://b\nhttp://c ")],
                               "doc_id long, text string")
    got = {(r.doc_id, r.url): (r.first_line, r.n_seen) for r in catalogs.read_url_list(df).collect()}
    assert got == {(1, "http://a"): (0, 2), (1, "http://b"): (3, 1), (2, "http://b"): (0, 1), (2, "http://c"): (1, 1)}


def test_flatten_and_first_title(spark):
    pages = spark.createDataFrame(
        [(7, 1, '{"data":{"programs":[{"id":1,"title":" x/y "},{"id":2}]}}'), (7, 2, '{"data":{}}'), (8, 1, "oops")],
        "source_id long, page_no long, payload string")
    flat = catalogs.flatten_program_pages(pages)
    assert sorted((r.track_id, r.title) for r in flat.collect()) == [(1, " x/y "), (2, "2")]
    first = catalogs.prefer_first_title(flat, "source_id", ["page_no", "track_pos"], "title",
                                        F.concat(F.lit("src"), F.col("source_id").cast("string")))
    assert [tuple(r) for r in first.collect()] == [(7, "x_y")]


def test_availability(spark):
    df = spark.createDataFrame([(None, '{"playable": false}', False), ("u", "bad", True), (None, "bad", True),
                                (None, '{"is_playable": "false"}', False)],
                               "ext string, meta string, present boolean")
    got = [(r.free_status, r.paid_status) for r in catalogs.classify_availability(df, "ext", "meta", "present").collect()]
    assert got == [("skipped_vip", "skipped_paywall"), ("exists", "skipped_free"), ("skipped_vip", "exists"),
                   ("skipped_vip", "skipped_paywall")]


def test_show_manifest_sink(spark, tmp_path):
    eps = spark.createDataFrame([("s1", 2, "e2"), ("s1", 1, "e1"), ("s2", 1, "e9")], "show_id string, pos long, episode_id string")
    m = catalogs.show_manifest(eps, "show_id", ["pos"], "episode_id", {"show_name": F.upper(F.col("show_id"))})
    out = str(tmp_path / "shows")
    catalogs.write_show_manifests(m, out)
    back = spark.read.json(out)
    got = sorted((r.show_id, r.ordinal, r.episode_id, r.episode_count, r.show_name) for r in back.collect())
    assert got == [("s1", 0, "e1", 2, "S1"), ("s1", 1, "e2", 2, "S1"), ("s2", 0, "e9", 1, "S2")]
