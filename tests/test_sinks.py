from __future__ import annotations

import pytest
from line_rows import rows

from pulseline.streaming import folds, runner, sinks
from pulseline.operators import decode, kpis
from pulseline.session import shared_folder
from line_rows import order_line


def kv(spark, *pairs):
    return spark.createDataFrame(list(pairs), "key string, value string")


def test_last_value_wins_over_batches(spark, tmp_path):
    path = str(tmp_path / "kv")
    sink = sinks.kv_set(path)
    sink(kv(spark, ("a", "1"), ("b", "1")), 0, "p")
    sink(kv(spark, ("a", "2")), 1, "p")
    assert rows(sinks.read_latest(spark, path, ["key"])) == [("a", "2"), ("b", "1")]


def test_products_of_one_table_keep_apart(spark, tmp_path):
    path = str(tmp_path / "kv")
    sinks.kv_set(path)(kv(spark, ("a", "1")), 0, "p")
    sinks.kv_set(path)(kv(spark, ("b", "1")), 0, "q")
    assert rows(sinks.read_latest(spark, path, ["key"])) == [("a", "1"), ("b", "1")]


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "kv")
    sink = sinks.kv_set(path)
    sink(kv(spark, ("a", "1")), 0, "p")
    sink(kv(spark, ("a", "2")), 1, "p")
    before = rows(sinks.read_latest(spark, path, ["key"]))
    sink(kv(spark, ("a", "2")), 1, "p")
    sink(kv(spark, ("a", "1")), 0, "p")
    assert rows(sinks.read_latest(spark, path, ["key"])) == before


def test_rows_of_a_batch_are_reduced_to_the_last(spark, tmp_path):
    path = str(tmp_path / "rows")
    batch = spark.createDataFrame([("r", 1, "x"), ("r", 2, "y"), ("q", 1, "z")], "row_key string, n int, cell string")
    sinks.row_upsert(path, order="n")(batch, 0, "p")
    assert rows(spark.read.parquet(path).drop(*sinks.PARTS, sinks.ORDER)) == [("q", "z"), ("r", "y")]


def test_a_late_row_stays_behind_the_last(spark, tmp_path):
    path, target = str(tmp_path / "rows"), str(tmp_path / "compact")

    def batch(n, cell):
        return spark.createDataFrame([("r", n, cell)], "row_key string, n int, cell string")

    sink = sinks.row_upsert(path, order="n")
    sink(batch(100, "last"), 0, "p")
    sink(batch(0, "late"), 1, "p")
    assert rows(sinks.read_latest(spark, path, ["row_key"])) == [("r", "last")]
    sinks.compact_latest(spark, path, target, ["row_key"])
    sinks.row_upsert(target, order="n")(batch(50, "late again"), 2, "p")
    assert rows(sinks.read_latest(spark, target, ["row_key"])) == [("r", "last")]


def test_compaction_keeps_the_content(spark, tmp_path):
    path, target = str(tmp_path / "kv"), str(tmp_path / "compact")
    sink = sinks.kv_set(path)
    for i in range(4):
        sink(kv(spark, ("a", str(i)), (f"k{i}", "1")), i, "p")
    sink(kv(spark, ("other", "1")), 0, "q")
    sinks.compact_latest(spark, path, target, ["key"])
    assert rows(sinks.read_latest(spark, target, ["key"])) == rows(sinks.read_latest(spark, path, ["key"]))
    sinks.kv_set(target)(kv(spark, ("a", "new")), 4, "p")
    sinks.kv_set(target)(kv(spark, ("other", "new")), 1, "q")
    assert {("a", "new"), ("other", "new")} <= set(rows(sinks.read_latest(spark, target, ["key"])))


def test_replay_after_compaction_loses_nothing(spark, tmp_path):
    path, target, again = (str(tmp_path / name) for name in ("kv", "compact", "again"))
    batches = [kv(spark, ("a", str(i)), (f"k{i}", "1")) for i in range(4)]
    for i, batch in enumerate(batches):
        sinks.kv_set(path)(batch, i, "p")
    before = rows(sinks.read_latest(spark, path, ["key"]))
    sinks.compact_latest(spark, path, target, ["key"])
    sinks.kv_set(target)(batches[3], 3, "p")
    assert rows(sinks.read_latest(spark, target, ["key"])) == before
    sinks.kv_set(target)(kv(spark, ("a", "new")), 4, "p")
    sinks.compact_latest(spark, target, again, ["key"])
    sinks.kv_set(again)(kv(spark, ("a", "new")), 4, "p")
    assert rows(sinks.read_latest(spark, again, ["key"])) == sorted([("a", "new")] + [r for r in before if r[0] != "a"])


def test_jdbc_rows_and_options(spark, monkeypatch):
    """No database here: the writer is replaced."""
    saved = {}

    def save(self):
        saved["columns"] = self._df.dtypes
        saved["rows"] = rows(self._df)

    def options(self, **settings):
        saved["options"] = settings
        return self

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.save", save)
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.options", options)
    batch = spark.createDataFrame([("m", 3)], "machine_id string, cnt bigint")
    sinks.jdbc_append("jdbc:x://h/db", "agg", user="u")(batch, 0, "p")
    assert saved["columns"] == [("machine_id", "string"), ("cnt", "string")]
    assert saved["rows"] == [("m", "3")]
    assert saved["options"] == {"url": "jdbc:x://h/db", "dbtable": "agg", "batchsize": "100", "user": "u"}


def test_figures_add_up_over_batches(lines, tmp_path):
    made = [order_line(id=i, status=s) for i, s in enumerate("1001 1003 1005 1001 1003 1002 1006 1001".split())]
    orders = decode.decode_orders(lines(made)).rows.persist()
    folder = str(tmp_path / "state")
    for i, (low, high) in enumerate([(0, 3), (3, 4), (4, 6), (6, 8)]):
        batch = orders.where(f"arrival >= {low} AND arrival < {high}")
        got = rows(folds.fold_kpis(batch, i, folder))
        again = rows(folds.fold_kpis(batch, i, folder))
        assert got == again == rows(kpis.order_kpis_latest(orders.where(f"arrival < {high}")))


def test_a_stream_needs_a_checkpoint(spark):
    flow = runner.Flow("f", spark.readStream.format("rate").load(), {})
    with pytest.raises(ValueError):
        runner.run_job([flow], {})


def test_products_without_a_sink_are_skipped(spark):
    flow = runner.Flow("f", kv(spark, ("a", "1")), {"x": lambda batch, _: 1 / 0, "y": lambda batch, _: batch})
    seen = []
    assert runner.run_job([flow], {"y": lambda batch, i, name: seen.append((rows(batch), i, name))}) == []
    assert seen == [([("a", "1")], 0, "y")]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
