import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opinara.operators import alerts
from opinara.schemas import WINDOW_AGG
from tests.conftest import at

BASE = dt.datetime(2024, 1, 1)


def windows(spark, rows):
    return spark.createDataFrame([(p, at(t), a, 0, 1, False) for p, t, a in rows], WINDOW_AGG)


def test_rules_are_independent(spark):
    got = alerts.anomalies(windows(spark, [
        ("low", "2024-01-01 10:00", 2.0), ("low", "2024-01-01 10:01", 3.5),        # mean 2.75, 50 % negative
        ("mixed", "2024-01-01 10:00", 2.9), ("mixed", "2024-01-01 10:01", 5.0),    # only the share
        ("fine", "2024-01-01 10:00", 3.0), ("old", "2024-01-01 09:00", 1.0),
        ("", "2024-01-01 10:00", 1.0), (None, "2024-01-01 10:00", 1.0)]), "2024-01-01 10:05")
    assert {(r.product_id, r.rule) for r in got.collect()} == {
        ("low", "low_rating"), ("low", "negative_share"), ("mixed", "negative_share")}


def test_boundaries(spark):
    edge = [("p", f"2024-01-01 10:0{i}", 3.0 if i < 7 else 2.9) for i in range(10)]  # 3 of 10 negative
    got = alerts.anomalies(windows(spark, edge), "2024-01-01 10:10").collect()
    assert [r.rule for r in got] == ["low_rating"]
    on_edge = alerts.anomaly_scores(windows(spark, [("p", "2024-01-01 10:00", 1.0)]), "2024-01-01 10:10")
    assert on_edge.count() == 1  # exactly 600 s old still counts


def test_missing_rating_is_negative(spark):
    got = alerts.anomalies(windows(spark, [("p", "2024-01-01 10:00", None)]), "2024-01-01 10:05").collect()
    assert {r.message for r in got} == {
        "Mean rating of p fell to 0.00 (threshold 3.0)", "Negative share of p is 100% (threshold 30%, 1/1 windows)"}


@pytest.mark.parametrize("every", [60, 120, 600])
def test_history_equals_single_checks(spark, every):
    rng = random.Random(2)
    rows = [(f"p{rng.randrange(3)}", str(BASE + dt.timedelta(minutes=m)), round(rng.uniform(1, 5), 2))
            for m in range(40)]
    df = windows(spark, rows)
    got = {(str(r.check_at), r.product_id, r.rule, r.message) for r in
           alerts.anomaly_history(df, 600, every).withColumn("check_at", F.col("check_at").cast("string")).collect()}
    expected = set()
    for step in range(0, 3600 + 600, every):
        moment = BASE + dt.timedelta(seconds=step)
        before = df.filter(F.col("window_start") < F.lit(str(moment)).cast("timestamp"))
        for r in alerts.anomalies(before, str(moment), 600).collect():
            expected.add((str(moment), r.product_id, r.rule, r.message))
    assert got == expected


def test_checks_may_not_skip_windows(spark):
    with pytest.raises(ValueError):
        alerts.anomaly_history(windows(spark, []), 60, 120)


def greedy(steps, every, cooldown):
    sent, last = [], None
    for s in sorted(steps):
        if last is None or (s - last) * every >= cooldown:
            sent.append(s)
            last = s
    return sent


@pytest.mark.parametrize("every, cooldown, block", [(60, 300, 7), (60, 300, 1440), (60, 90, 3), (60, 60, 2), (60, 0, 4)])
def test_cooldown_equals_greedy(spark, every, cooldown, block):
    rng = random.Random(block)
    steps = {p: sorted(rng.sample(range(300), n)) for p, n in (("busy", 250), ("rare", 9), ("mid", 80))}
    rows = [(p, BASE + dt.timedelta(seconds=s * every), rule) for p, ss in steps.items() for s in ss
            for rule in ("low_rating", "negative_share")]
    history = spark.createDataFrame(rows, "product_id string, check_at timestamp, rule string")
    got = alerts.alert_cooldown(history, every, cooldown, block)
    assert got.columns == history.columns
    sent = {(r.product_id, r.check_at, r.rule) for r in got.collect()}
    expected = {(p, BASE + dt.timedelta(seconds=s * every), rule) for p, ss in steps.items()
                for s in greedy(ss, every, cooldown) for rule in ("low_rating", "negative_share")}
    assert sent == expected


@pytest.mark.parametrize("fanout", [6, 64])
def test_cooldown_over_many_levels_and_gaps(spark, fanout):
    """Blocks of five checks, stretches without alerts, times before 1970; groups of blocks of every size."""
    rng = random.Random(fanout)
    steps = {"dense": list(range(-400, 400)), "gaps": sorted(rng.sample(range(-5000, 5000), 900)), "one": [-7]}
    rows = [(p, s, "low_rating") for p, ss in steps.items() for s in ss]
    history = (spark.createDataFrame(rows, "product_id string, s long, rule string")
               .select("product_id", F.timestamp_seconds(F.col("s") * 60).alias("check_at"), "rule", "s"))
    got = {(r.product_id, r.s) for r in alerts.alert_cooldown(history, 60, 300, 5, fanout).collect()}
    assert got == {(p, s) for p, ss in steps.items() for s in greedy(ss, 60, 300)}


def test_cooldown_over_ten_thousand_blocks(spark):
    """A product that could alert at every check: no list grows with the history."""
    checks = 50_000
    history = spark.range(checks).select(F.lit("a").alias("product_id"), F.timestamp_seconds(F.col("id") * 60).alias("check_at"),
                                         F.lit("low_rating").alias("rule"))
    got = alerts.alert_cooldown(history, 60, 300, 5)
    assert got.agg(F.count("*"), F.max(F.unix_seconds("check_at"))).first() == (checks // 5, (checks - 5) * 60)


def test_cooldown_of_no_alerts(spark):
    history = spark.createDataFrame([], "product_id string, check_at timestamp, rule string")
    assert alerts.alert_cooldown(history).collect() == []
