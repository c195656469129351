"""The levelled log: few files however many batches, nothing lost when a batch is repeated, and pruning by day."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinara.sources import levels

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("t", T.TimestampType()), T.StructField("n", T.LongType())])


def log_at(spark, path, fanout=4):
    merge = lambda rows: rows.groupBy("k", "t", "_to", "day").agg(F.sum("n").alias("n"))
    return levels.LevelledLog(spark, str(path / "log"), SCHEMA, merge, fanout)


def rows(spark, *values):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, d) if d else None, n) for k, d, n in values], SCHEMA)


def sums(df):
    return {(r.k, r.t and r.t.day): r.n for r in df.groupBy("k", "t").agg(F.sum("n").alias("n")).collect()}


def test_two_hundred_batches_stay_in_few_files(spark, tmp_path, monkeypatch):
    """The plan of merges, counted without Spark: live segments per day and how often a row is written."""
    log = log_at(spark, tmp_path)
    state, written, most = {}, 0, 0
    monkeypatch.setattr(log, "segments", lambda before=None: state.get("s", []))
    monkeypatch.setattr(log, "_publish", lambda b, s: state.update(s=s))
    monkeypatch.setattr(log, "_write", lambda r: None)
    monkeypatch.setattr(log, "_days", lambda name: [dt.date(2024, 1, 1)])
    monkeypatch.setattr(log, "_forget", lambda b, s: None)
    merged = []
    monkeypatch.setattr(log, "_merge", lambda m: merged.extend((target, len(parts)) for parts, target in m))
    one = rows(spark, ("a", 1, 1)).cache()
    for b in range(200):
        log.add(one, b, "t")
        live = [s for s in state["s"] if s.live]
        assert [(s.first, s.last) for s in sorted(live, key=lambda s: s.first)][-1][1] == b
        covered = sorted(x for s in live for x in range(s.first, s.last + 1))
        assert covered == list(range(b + 1))  # every batch once
        most = max(most, len(live))
    assert most <= 3 * (math.floor(math.log(200, 4)) + 1)
    written = 200 + sum(t.last - t.first + 1 for t, _ in merged)
    assert written <= 200 * (math.log(200, 4) + 1)


@pytest.mark.parametrize("fanout", [2, 3])
def test_rows_and_files_over_real_batches(spark, tmp_path, fanout):
    log, rng, expected = log_at(spark, tmp_path, fanout), random.Random(fanout), {}
    for b in range(9):
        values = [(rng.choice("ab"), rng.choice([1, 1, 2, None]), rng.randint(1, 9)) for _ in range(4)] if b != 4 else []
        days = log.add(rows(spark, *values).coalesce(1), b, "t")
        assert {d and d.day for d in days} == {d for _, d, _ in values}
        before = dict(expected)
        for k, d, n in values:
            expected[k, d] = expected.get((k, d), 0) + n
        assert sums(log.read()) == expected and sums(log.read(before=b)) == before
        day_one = log.read([dt.date(2024, 1, 1)])
        assert sums(day_one) == {k: n for k, n in expected.items() if k[1] == 1}
        assert len(day_one.inputFiles()) <= (fanout - 1) * 4 and all("day=2024-01-01" in f for f in day_one.inputFiles())
    assert len(log._manifests()) <= 3
    held = sum(1 for _ in (tmp_path / "log").glob("_to=*/day=*"))
    assert held <= sum(s.live for s in log.segments()) + 4 * fanout  # what was replaced goes with the next batch


@pytest.mark.parametrize("step", ["_merge", "_publish"])
def test_a_batch_that_breaks_off_is_repeated(spark, tmp_path, monkeypatch, step):
    log = log_at(spark, tmp_path, 2)
    for b in range(3):
        log.add(rows(spark, ("a", 1, 10 ** b)), b, "t")
    real = getattr(levels.LevelledLog, step)

    def breaks(self, *args):
        if step == "_merge":
            real(self, *args)  # merged, but not yet published
        raise RuntimeError("lost")

    monkeypatch.setattr(levels.LevelledLog, step, breaks)
    with pytest.raises(RuntimeError, match="lost"):
        log.add(rows(spark, ("a", 1, 1000)), 3, "t")
    monkeypatch.undo()
    assert sums(log.read()) == {("a", 1): 111}
    for _ in range(2):
        log.add(rows(spark, ("a", 1, 1000)), 3, "t")
        assert sums(log.read()) == {("a", 1): 1111}
    log.add(rows(spark, ("a", 1, 10_000)), 4, "t")
    assert sums(log.read()) == {("a", 1): 11_111}


def test_a_manifest_that_was_not_finished_does_not_count(spark, tmp_path):
    log = log_at(spark, tmp_path)
    log.add(rows(spark, ("a", 1, 1)), 0, "t")
    (tmp_path / "log" / "_manifest-1").write_text("2024-01-01,0,1,1,live")
    assert sums(log.read()) == {("a", 1): 1}
    log.add(rows(spark, ("a", 1, 1)), 1, "t")
    assert sums(log.read()) == {("a", 1): 2}
    assert sums(log_at(spark, tmp_path / "other").read()) == {}
