"""Export ledger: each volume once, failures tried again, hopeless ones parked."""

import pytest
from pyspark.sql import functions as F

from speechprep.streaming import ledger

VOLUMES = "volume_name string, n_files long, bytes long"


class Sender:
    """Fails as often as ``fails`` says; remembers what was sent."""

    def __init__(self, fails, die_at=None):
        self.fails, self.sent, self.calls, self.die_at = fails, [], 0, die_at

    def __call__(self, todo):
        self.calls += 1
        if self.calls == self.die_at:
            raise RuntimeError("driver lost")
        rows = []
        for r in todo.collect():
            left = self.fails.get(r.volume_name, 0)
            self.fails[r.volume_name] = left - 1
            if left <= 0:
                self.sent.append(r.volume_name)
            if left != -99:
                rows.append((r.volume_name, "refused" if left > 0 else None))
        return todo.sparkSession.createDataFrame(rows, "volume_name string, error string")


def land(spark, path, *names):
    spark.createDataFrame([(n, 2, 10) for n in names], VOLUMES).coalesce(1).write.mode("append").parquet(path)


def test_each_volume_is_exported_once(spark, tmp_path):
    src, root, chk = (str(tmp_path / x) for x in ("src", "ledger", "chk"))
    send = Sender({"en_b": 1, "de_c": 2, "fr_d": 9})

    def run():
        q = ledger.start_ledger_export(spark, src, VOLUMES, root, chk, send, max_attempts=3, trigger={"availableNow": True}, max_files_per_trigger=1)
        q.awaitTermination()
        assert q.exception() is None

    land(spark, src, "en_a", "en_b", "de_c", "fr_d", "en_a")
    run()
    land(spark, src, "es_e", "en_a")  # announced again
    run()
    land(spark, src, "es_f")
    run()
    assert ledger.retry(spark, root, send) == 0
    rows = {r.volume_name: (r.status, r.attempts, r.error) for r in ledger.ledger(spark, root).collect()}
    assert rows == {"en_a": ("done", 1, None), "en_b": ("done", 2, None), "de_c": ("done", 3, None), "fr_d": ("parked", 3, "refused"),
                    "es_e": ("done", 1, None), "es_f": ("done", 1, None)}
    assert sorted(send.sent) == ["de_c", "en_a", "en_b", "es_e", "es_f"]
    got = {r.object_key for r in ledger.exported(spark, root, "v/").collect()}
    assert got == {"v/de/de_c", "v/en/en_a", "v/en/en_b", "v/es/es_e", "v/es/es_f"}


def test_a_batch_run_again_settles_nothing_twice(spark, tmp_path):
    root, send = str(tmp_path / "l"), Sender({"a": 1})
    batch = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], VOLUMES)
    ledger.settle(batch, 5, root, send)
    assert ledger.settle(batch, 5, root, send)["changed"] == 0  # the same batch: `a` waits for the next one
    assert ledger.settle(spark.createDataFrame([], VOLUMES), 6, root, send)["changed"] == 1
    assert sorted(send.sent) == ["a", "b"]


def test_a_crash_while_sending_loses_nothing(spark, tmp_path):
    src, root, chk = (str(tmp_path / x) for x in ("src", "ledger", "chk"))
    land(spark, src, "a_1", "a_2")
    send = Sender({}, die_at=1)
    with pytest.raises(Exception):
        q = ledger.start_ledger_export(spark, src, VOLUMES, root, chk, send, trigger={"availableNow": True})
        q.awaitTermination()
    assert ledger.ledger(spark, root).count() == 0
    ledger.start_ledger_export(spark, src, VOLUMES, root, chk, send, trigger={"availableNow": True}).awaitTermination()
    assert {r.volume_name for r in ledger.ledger(spark, root).where(F.col("status") == "done").collect()} == {"a_1", "a_2"}


def test_volumes_without_an_answer_fail(spark, tmp_path):
    root = str(tmp_path / "l")
    nothing = lambda todo: todo.sparkSession.createDataFrame([], "volume_name string, error string")
    ledger.settle(spark.createDataFrame([("a", 1, 1)], VOLUMES), 0, root, nothing)
    assert ledger.retry(spark, root, nothing) == 2
    assert [(r.status, r.attempts, r.error) for r in ledger.ledger(spark, root).collect()] == [("parked", 3, "no answer")]
