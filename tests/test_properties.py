"""Properties on random panels, against plain Python where that is simplest."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quotepanel.operators import detail, overview, period, risk
from quotepanel.operators.mart import mart_daily, mart_incremental, recompute
from quotepanel.operators.upsert import upsert, upsert_once

SCHEMA = "result_date date, cur_unit string, rate double"


def random_rows(seed, codes=12, days=90, density=0.4):
    rng = random.Random(seed)
    start = date(2025, 1, 1)
    return [
        (start + timedelta(days=d), f"C{c}", float(rng.randint(0, 6)))
        for c in range(codes)
        for d in range(days)
        if rng.random() < (density if c else 0.03)  # C0 is very sparse
    ]


def walked_streak(rates):
    streak = 0
    for old, new in reversed(list(zip(rates, rates[1:]))):
        sign = (new > old) - (new < old)
        if streak == 0:
            streak = sign
        elif sign == 0 or (streak > 0) != (sign > 0):
            break
        else:
            streak += sign
    return streak


@pytest.mark.parametrize("seed", [1, 2])
def test_streak_equals_the_literal_walk(spark, seed):
    rows = random_rows(seed, codes=40)
    got = {r["cur_unit"]: r["streak"] for r in detail.streak_of(spark.createDataFrame(rows, SCHEMA)).collect()}
    series = {}
    for day, code, rate in sorted(rows):
        series.setdefault(code, []).append(rate)
    assert got == {code: walked_streak(rates) for code, rates in series.items()}


@pytest.mark.parametrize("seed, lookback", [(3, 31), (4, 2)])
def test_incremental_equals_full(spark, seed, lookback):
    rng = random.Random(seed)
    before = random_rows(seed)
    touched = rng.sample(before, 7)
    added = [(date(2025, 1, 1) + timedelta(days=rng.randint(0, 120)), "NEW", 3.0), (date(2025, 6, 1), "C0", 2.0)]
    source = spark.createDataFrame([(d, c, r + 1) for d, c, r in touched] + added, SCHEMA)
    old = spark.createDataFrame(before, SCHEMA)
    after = upsert(old, source)
    full = sorted(mart_daily(after).drop("updated_at").collect(), key=repr)
    incremental = mart_incremental(after, source, mart_daily(old))
    assert sorted(incremental.drop("updated_at").collect(), key=repr) == full
    narrow = upsert(mart_daily(old), recompute(after, source, lookback_days=lookback))
    assert sorted(narrow.drop("updated_at").collect(), key=repr) == full


def test_input_order_and_partitioning_do_not_matter(spark):
    rows = random_rows(5)
    shuffled = rows[:]
    random.Random(6).shuffle(shuffled)
    one = mart_daily(spark.createDataFrame(rows, SCHEMA)).drop("updated_at")
    two = mart_daily(spark.createDataFrame(shuffled, SCHEMA).repartition(5)).drop("updated_at")
    for operator in (lambda m: m, risk.alerts, overview.summarise, lambda m: overview.top_bottom(overview.returns(m))):
        assert sorted(operator(one).collect(), key=repr) == sorted(operator(two).collect(), key=repr)


def test_period_equals_the_date_list(spark):
    panel = spark.createDataFrame(random_rows(7), SCHEMA)
    for n in (1, 5, 66, 1000):
        listed = panel.join(period.recent_dates(panel, n), "result_date", "left_semi")
        assert sorted(period.period(panel, n).collect()) == sorted(listed.select(*panel.columns).collect())


def test_alerts_are_sorted_and_bounded(spark):
    mart = mart_daily(spark.createDataFrame(random_rows(8), SCHEMA))
    rows = risk.alerts(mart, limit=10).collect()
    keys = [(-r["result_date"].toordinal(), -abs(r["change_pct"]), r["cur_unit"]) for r in rows]
    assert len(rows) == 10 and keys == sorted(keys)


def test_hot_key_leaves_one_row_per_key(spark):
    """A third of all landed rows are loads of one quote."""
    from quotepanel.operators.staging import staging

    rows = spark.range(30000).select(
        F.when(F.col("id") < 10000, "HOT").otherwise(F.concat(F.lit("C"), (F.col("id") / 20).cast("int"))).alias("cur_unit"),
        F.col("id"),
    )
    raw = rows.select(
        F.to_variant_object(
            F.struct(F.lit(1).alias("result"), "cur_unit", F.lit("n").alias("cur_nm"), F.col("id").cast("string").alias("deal_bas_r"))
        ).alias("raw_data"),
        F.col("id").cast("int").alias("pos"),
        F.lit("exchange_rate_20260814.json").alias("file_name"),
        F.lit("2026-08-14 00:00:00").cast("timestamp_ntz").alias("loaded_at"),
    )
    out = staging(raw, "2026-08-14 00:00:00")
    assert out.count() == 1 + 1000
    assert out.filter("cur_unit = 'HOT'").first()["rate"] == 9999.0


def test_one_pass_upsert_equals_the_join(spark):
    def rows(seed, n):
        value = F.when(F.hash("id", F.lit(seed)) % 5 == 0, None).otherwise(F.rand(seed))
        key = F.pmod(F.hash("id", F.lit(seed + 1)), F.lit(200))
        frame = spark.range(n).select(F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int")).alias("result_date"), (key % 10).cast("string").alias("cur_unit"), value.alias("rate"), F.lit(seed).cast("long").alias("load"))
        return frame.dropDuplicates(["result_date", "cur_unit"])

    target, source = rows(1, 300).cache(), rows(2, 90).cache()
    expected = sorted(upsert(target, source).collect(), key=repr)
    assert sorted(upsert_once(target, source).collect(), key=repr) == expected
    assert sorted(upsert_once(target, source.limit(0)).collect(), key=repr) == sorted(target.collect(), key=repr)
    assert sorted(upsert_once(target.limit(0), source).collect(), key=repr) == sorted(source.collect(), key=repr)
    plan = upsert_once(target, source)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan
