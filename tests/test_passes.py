"""Two passes as one resumable run, against a plain loop."""

import pytest
from pyspark.sql import functions as F

from speechprep.operators import infer, passes

CLIPS = "path string, duration_ms long, text string"
ROWS = [(f"c{k}", [10_000, 30_000, 30_000, 45_000, None][k % 5], ["one two", "bad", "", "x bad y", None][k // 5 % 5]) for k in range(75)]


class Reader:
    def __init__(self, bad):
        self.bad = bad

    def __call__(self, texts):
        if any(self.bad and self.bad in (x or "") for x in texts):
            raise RuntimeError("can't read")
        return [" ".join((x or "").split()) or "silence" for x in texts]


def model(bad):
    return lambda df: infer.batch_infer(df, "path", ["text"], loader=lambda: Reader(bad), predict=lambda m, b: m(b["text"]), batch_size=7)


def plain(first, second):
    out = {}
    for path, d, text in ROWS:
        for number, takes, bad in ((1, d is not None and d <= 30_000, first), (2, d is not None and d >= 30_000, second)):
            if takes and out.get(path, (None,))[0] is None:
                failed = bool(bad) and bad in (text or "")
                out[path] = (None if failed else " ".join((text or "").split()) or "silence", "RuntimeError: can't read" if failed else None, number)
    return out


@pytest.mark.parametrize("second", [None, "y"])
def test_failures_of_the_first_pass_go_to_the_second(spark, tmp_path, second):
    root, clips = str(tmp_path / "r"), spark.createDataFrame(ROWS, CLIPS)
    steps = passes.two_passes("duration_ms", model("bad"), model(second))
    assert passes.run(clips, root, steps, chunks=3, buckets=4)
    got = {r.path: (r.text, r.error, r["pass"]) for r in passes.results(spark, root).collect()}
    assert got == plain("bad", second)
    assert passes.run(clips, root, steps, chunks=3, buckets=4) == []  # complete
    more = spark.createDataFrame([*ROWS, ("new", 5_000, "late")], CLIPS)
    assert [(r["pass"], r["changed"]) for r in passes.run(more, root, steps, chunks=3, buckets=4)] == [(1, 1)]


def test_a_run_that_died_goes_on_where_it_stopped(spark, tmp_path):
    root, clips = str(tmp_path / "r"), spark.createDataFrame(ROWS, CLIPS)
    calls = []

    def dying(df):
        calls.append(df.count())
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        return model("bad")(df)

    steps = passes.two_passes("duration_ms", dying, model(None))
    with pytest.raises(RuntimeError):
        passes.run(clips, root, steps, chunks=4, buckets=4)
    kept = passes.results(spark, root).count()
    assert kept == calls[0] + calls[1] > 0
    first = list(calls)
    passes.run(clips, root, steps, chunks=4, buckets=4)
    assert calls[len(first):] [:2] == [0, 0]  # the committed chunks are not taken again
    assert {r.path: (r.text, r.error, r["pass"]) for r in passes.results(spark, root).collect()} == plain("bad", None)


def test_a_path_given_twice_is_taken_once(spark, tmp_path):
    root = str(tmp_path / "r")
    clips = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", 2, "y")], CLIPS)
    passes.run(clips, root, [passes.Pass(1, F.lit(True), model(None))], chunks=1, buckets=2)
    assert sorted(r.path for r in passes.results(spark, root).collect()) == ["a", "b"]


def test_the_clips_are_read_once_a_run(spark, tmp_path):
    root, read = str(tmp_path / "r"), spark.sparkContext.accumulator(0)

    def counted(chunks):
        for chunk in chunks:
            read.add(len(chunk))
            yield chunk

    texts = spark.createDataFrame([(p, t) for p, _, t in ROWS], "path string, text string").mapInPandas(counted, "path string, text string")
    clips = spark.createDataFrame([(p, d) for p, d, _ in ROWS], "path string, duration_ms long").join(texts, "path")
    steps = passes.two_passes("duration_ms", model("bad"), model("y"))
    passes.run(clips, root, steps, chunks=3, buckets=4)
    assert {r.path: (r.text, r.error, r["pass"]) for r in passes.results(spark, root).collect()} == plain("bad", "y")
    assert read.value == len(ROWS)  # not once a chunk of every pass
