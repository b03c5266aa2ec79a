"""Landing files, the load job, its failure modes and the stream."""

import gzip
import json
import os
import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quotepanel.operators import period
from quotepanel.operators.mart import mart_daily
from quotepanel.operators.quality import QualityError
from quotepanel.operators.state import code_states, date_states
from quotepanel.plans.daily import apply_load, rebuild, run_load
from quotepanel.plans.stored import StoredPanel
from quotepanel.session import shared_folder
from quotepanel.sources.landing import list_files, new_files, read_landing, read_landing_split, read_landing_variant
from quotepanel.sources.layers import ConcurrentRun, create_layers, scan_mart
from quotepanel.streaming.ingest import stream_ingest

DAY_1 = date(2026, 8, 10)


def quote(code, rate, result=1):
    return {"result": result, "cur_unit": code, "cur_nm": code.lower(), "deal_bas_r": f"{rate:,.2f}", "extra": {"k": 1}}


def land(folder, day, quotes, compress=False, indent=None):
    os.makedirs(folder, exist_ok=True)
    name = f"{folder}/exchange_rate_{day:%Y%m%d}.json"
    text = json.dumps(quotes, ensure_ascii=False, indent=indent)
    if compress:
        with gzip.open(name + ".gz", "wt", encoding="utf-8") as out:
            out.write(text)
    else:
        with open(name, "w", encoding="utf-8") as out:
            out.write(text)


def days(n, start=DAY_1):
    return [start + timedelta(days=i) for i in range(n)]


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def layers(spark, root):
    # Fixed dates of the past: only the test of it checks their age.
    return create_layers(spark, root, stale_days=None)


def mart_rows(layers):
    return sorted((r["result_date"], r["cur_unit"], r["rate"], r["prev_rate"], r["ma_5"]) for r in layers.read("mart").collect())


def test_scan_splits_arrays(spark, landing):
    land(landing, DAY_1, [quote("USD", 1400.5), quote("EUR", 1500, "1")], indent=2)
    land(landing, DAY_1 + timedelta(days=1), [])
    land(landing, DAY_1 + timedelta(days=2), [quote("USD", 3)], compress=True)
    rows = read_landing(spark, landing, "2026-08-14 01:00:00").collect()
    assert sorted((r["result"], r["cur_unit"], r["deal_bas_r"], r["file_name"]) for r in rows) == [
        ("1", "EUR", "1,500.00", "exchange_rate_20260810.json"),
        ("1", "USD", "1,400.50", "exchange_rate_20260810.json"),
        ("1", "USD", "3.00", "exchange_rate_20260812.json.gz"),
    ]
    assert {r["loaded_at"] for r in rows} == {datetime(2026, 8, 14, 1)}
    assert all(r["file_size"] > 0 and r["file_mtime"] for r in rows)
    raw = read_landing_variant(spark, landing, "2026-08-14 01:00:00")
    kept = raw.select("pos", F.variant_get("raw_data", "$.extra.k", "int").alias("k")).collect()
    assert sorted(map(tuple, kept)) == [(0, 1), (0, 1), (1, 1)]


def test_malformed_file_aborts_the_whole_load(spark, landing, layers):
    land(landing, DAY_1, [quote("USD", 1)])
    with open(f"{landing}/exchange_rate_20260811.json", "w") as out:
        out.write('[{"result": 1, "cur_unit": "USD"')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        run_load(layers, landing)
    assert layers.raw().count() == 0
    assert layers.ledger().count() == 0
    with pytest.raises(Exception):
        read_landing(spark, landing).collect()


def test_daily_runs_equal_one_full_recompute(spark, landing, layers):
    for i, day in enumerate(days(8)):
        land(landing, day, [quote("USD", 1400 + i * i), quote("EUR", 1500 - i)])
        assert run_load(layers, landing).status == "loaded"
    full = mart_daily(layers.read("staging")).drop("updated_at")
    assert sorted(full.collect()) == sorted(layers.read("mart").drop("updated_at", "bucket").collect())
    assert layers.read("mart").count() == 16
    assert layers.raw().count() == 16


@pytest.mark.parametrize("grain", ["yyyy", "yyyyMMdd"])
def test_any_grain_of_folders(spark, landing, root, grain):
    layers = create_layers(spark, root, grain, stale_days=None)
    for i, day in enumerate(days(5, date(2025, 12, 29))):
        land(landing, day, [quote("USD", 100 + i)])
        run_load(layers, landing)
    assert [r[4] for r in mart_rows(layers)] == [100.0, 100.5, 101.0, 101.5, 102.0]
    buckets = {r["bucket"] for r in layers.read("mart").collect()}
    assert len(buckets) == (2 if grain == "yyyy" else 5)
    # Date bounds drop folders as well as rows.
    for bounded, rows in ((period.period(layers.read("mart"), 2), 2), (period.snapshot(layers.read("mart")), 1)):
        plan = bounded._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(bucket" in plan
        assert bounded.count() == rows
    # One snapshot per day replaced the one before it, in year folders only.
    assert layers.superseded().filter("layer = 'mart'").count() == (3 if grain == "yyyy" else 0)


def test_rerun_changes_nothing_and_correction_replaces(landing, layers):
    for day in days(3):
        land(landing, day, [quote("USD", 10)])
    run_load(layers, landing)
    before = mart_rows(layers)
    assert run_load(layers, landing).status == "skipped"
    assert mart_rows(layers) == before
    # The rewritten file has another size, so it is new to the ledger.
    land(landing, DAY_1, [quote("USD", 2000), quote("EUR", 7)])
    assert run_load(layers, landing).status == "loaded"
    assert [r[2:] for r in mart_rows(layers) if r[1] == "USD"] == [
        (2000.0, None, 2000.0),
        (10.0, 2000.0, 1005.0),
        (10.0, 10.0, 673.3333),
    ]
    assert layers.raw().count() == 5


def test_failed_reload_keeps_the_good_value(landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing)
    land(landing, DAY_1, [quote("USD", 99999, result=2)])
    assert run_load(layers, landing).status == "skipped"
    assert [r[2] for r in mart_rows(layers)] == [10.0]


def test_empty_day_is_skipped(landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing)
    land(landing, DAY_1 + timedelta(days=1), [])
    assert run_load(layers, landing).status == "skipped"
    assert layers.ledger().count() == 2
    assert len(mart_rows(layers)) == 1


def test_gate_stops_the_run_before_anything_is_visible(landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing)
    before = mart_rows(layers)
    broken = quote("EUR", 1)
    broken["deal_bas_r"] = None
    land(landing, DAY_1 + timedelta(days=1), [quote("USD", 11), broken])
    with pytest.raises(QualityError) as error:
        run_load(layers, landing)
    assert error.value.failures == {"staging_not_null": 1}
    assert mart_rows(layers) == before
    # The corrected file passes.
    land(landing, DAY_1 + timedelta(days=1), [quote("USD", 11), quote("EUR", 12345)])
    assert run_load(layers, landing).status == "loaded"
    assert len(mart_rows(layers)) == 3


def test_stale_mart_stops_the_run(landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    with pytest.raises(QualityError):
        run_load(layers, landing, as_of=DAY_1 + timedelta(days=5))
    assert run_load(layers, landing, as_of=DAY_1 + timedelta(days=4)).status == "loaded"


def test_file_without_date_is_stopped_by_the_check(landing, layers):
    os.makedirs(landing)
    with open(f"{landing}/rates.json", "w") as out:
        json.dump([quote("USD", 1)], out)
    with pytest.raises(QualityError):
        run_load(layers, landing)


def test_replayed_run_is_recognised(spark, landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    landed = read_landing_variant(spark, landing, "2026-08-14 01:00:00")
    assert apply_load(layers, landed, "batch-1").status == "loaded"
    assert apply_load(layers, landed, "batch-1").status == "repeated"
    assert layers.raw().count() == 1


def test_run_that_died_before_its_commit_is_repeated_cleanly(spark, landing, layers, monkeypatch):
    for day in days(3):
        land(landing, day, [quote("USD", 10)])
    landed = read_landing_variant(spark, landing, "2026-08-14 01:00:00")

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(type(layers), "commit", die)
        with pytest.raises(RuntimeError):
            apply_load(layers, landed, "batch-1")
    assert mart_rows(layers) == []
    assert apply_load(layers, landed, "batch-1").status == "loaded"
    assert len(mart_rows(layers)) == 3
    assert layers.raw().count() == 3


def test_backfill_range_and_order(landing, layers):
    for i, day in enumerate(days(10)):
        land(landing, day, [quote("USD", 100 + i)])
    run_load(layers, landing, start=days(10)[6], end=days(10)[9])
    run_load(layers, landing, start=days(10)[2], end=days(10)[3])
    assert [r[0] for r in mart_rows(layers)] == days(10)[2:4] + days(10)[6:]
    run_load(layers, landing)
    assert [r[4] for r in mart_rows(layers)] == [100.0, 100.5, 101.0, 101.5, 102.0, 103.0, 104.0, 105.0, 106.0, 107.0]


def test_sparse_code_reads_rows_from_before_the_lookback(landing, layers):
    early = [date(2025, m, 3) for m in (1, 2, 3, 4, 5)]
    for i, day in enumerate(early):
        land(landing, day, [quote("USD", 100 + i)])
    run_load(layers, landing)
    land(landing, DAY_1, [quote("USD", 200)])
    run_load(layers, landing)
    assert mart_rows(layers)[-1][2:] == (200.0, 104.0, 122.0)


def test_rebuild_equals_the_daily_runs(landing, layers):
    for i, day in enumerate(days(6, date(2026, 7, 29))):
        land(landing, day, [quote("USD", 100 + i), quote("EUR", 50 - i)])
        run_load(layers, landing)
    before = mart_rows(layers)
    assert rebuild(layers).status == "loaded"
    assert mart_rows(layers) == before


def test_column_scan_reads_those_columns_only(landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing)
    scan = scan_mart(layers, ["cur_unit", "ma_5"])
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<cur_unit:string,ma_5:double>" in plan


def test_catalog_follows_the_current_snapshot(spark, landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing)
    tables = layers.publish("catalog_test_")
    assert [spark.table(t).count() for t in tables.values()] == [1, 1, 1]
    land(landing, DAY_1, [quote("USD", 2000)])
    run_load(layers, landing)
    layers.publish("catalog_test_")
    assert [r["rate"] for r in spark.table(tables["mart"]).collect()] == [2000.0]
    assert spark.table(tables["raw"]).count() == 2


def test_ledger_knows_files_by_path_time_and_size(spark, landing):
    land(landing, DAY_1, [quote("USD", 10)])
    listing = list_files(spark, landing)
    first = spark.createDataFrame(listing.collect(), listing.schema)
    assert new_files(list_files(spark, landing), first).count() == 0
    land(landing, DAY_1, [quote("USD", 1000)])
    assert new_files(list_files(spark, landing), first).count() == 1


def test_stream_loads_new_files_once(landing, layers):
    checkpoint = layers.path("checkpoint")
    for i, day in enumerate(days(4)):
        land(landing, day, [quote("USD", 100 + i)])
    stream_ingest(layers, landing, checkpoint, max_files=2).awaitTermination()
    assert [r[4] for r in mart_rows(layers)] == [100.0, 100.5, 101.0, 101.5]
    stream_ingest(layers, landing, checkpoint).awaitTermination()
    land(landing, days(5)[4], [quote("USD", 104)])
    stream_ingest(layers, landing, checkpoint).awaitTermination()
    assert len(mart_rows(layers)) == 5
    assert layers.raw().count() == 5


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark, "x").startswith(configured.rstrip("/"))
    assert shared_folder(spark, "x") != shared_folder(spark, "x")


def test_second_stream_and_fresh_checkpoint_lose_nothing(spark, tmp_path, layers):
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    land(first, days(2)[0], [quote("USD", 100)])
    land(second, days(2)[1], [quote("EUR", 200)])
    stream_ingest(layers, first, layers.path("checkpoint-1")).awaitTermination()
    stream_ingest(layers, second, layers.path("checkpoint-2")).awaitTermination()
    assert [r[1] for r in mart_rows(layers)] == ["USD", "EUR"]
    land(first, days(3)[2], [quote("USD", 101)])
    stream_ingest(layers, first, layers.path("checkpoint-3")).awaitTermination()
    assert [r[1:3] for r in mart_rows(layers)] == [("USD", 100.0), ("EUR", 200.0), ("USD", 101.0)]


def test_part_files_of_equal_size_and_time_are_both_new(spark, landing, layers):
    folder = f"{landing}/search_date=20260810"
    os.makedirs(folder)
    for part, code in enumerate(("USD", "EUR")):
        path = f"{folder}/part-{part}.json"
        with open(path, "w") as out:
            out.write(json.dumps(quote(code, 10)) + "\n")
        os.utime(path, (1_700_000_000, 1_700_000_000))
        assert run_load(layers, landing, multi_line=False).status == "loaded"
    assert [r[1] for r in mart_rows(layers)] == ["EUR", "USD"]
    assert layers.raw().count() == 2


def test_last_line_of_one_load_wins(landing, layers):
    folder = f"{landing}/search_date=20260810"
    os.makedirs(folder)
    with open(f"{folder}/part-0.json", "w") as out:
        for rate in (99, 1000, 5):
            out.write(json.dumps(quote("USD", rate)) + "\n")
    run_load(layers, landing, multi_line=False)
    assert [r[2] for r in mart_rows(layers)] == [5.0]


def test_earlier_load_time_does_not_replace_a_later_one(landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing, "2026-08-12 00:00:00")
    land(landing, DAY_1, [quote("USD", 2000)])
    run_load(layers, landing, "2026-08-11 00:00:00")
    assert [r[2] for r in mart_rows(layers)] == [10.0]
    rebuild(layers)
    assert [r[2] for r in mart_rows(layers)] == [10.0]


def test_correction_in_a_long_history_opens_the_folders_around_it(landing, layers, monkeypatch):
    for i, day in enumerate(days(200, date(2025, 9, 1))):
        land(landing, day, [quote("USD", 100 + i), *([quote("EUR", i + 1)] if i % 50 == 0 else [])])
    run_load(layers, landing)
    land(landing, date(2025, 12, 15), [quote("USD", 5)])
    opened = []
    read = type(layers).read

    def watch(self, layer, *args, **kwargs):
        frame = read(self, layer, *args, **kwargs)
        if layer == "staging":
            opened.extend(path.split("bucket=")[1][:6] for path in frame.inputFiles())
        return frame

    with monkeypatch.context() as patch:
        patch.setattr(type(layers), "read", watch)
        # USD has rows all around; EUR is not in this load.
        run_load(layers, landing)
    assert set(opened) <= {"202512"}
    full = mart_daily(layers.read("staging")).drop("updated_at")
    assert sorted(full.collect()) == sorted(layers.read("mart").drop("updated_at", "bucket").collect())


def test_gate_asks_for_a_fresh_mart(spark, landing, root):
    land(landing, DAY_1, [quote("USD", 10)])
    with pytest.raises(QualityError) as error:
        run_load(create_layers(spark, root), landing)
    assert error.value.failures == {"mart_stale": 1}
    assert run_load(create_layers(spark, root), landing, f"{DAY_1:%Y-%m-%d} 12:00:00").status == "loaded"


def test_second_writer_is_refused(spark, landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    state = layers.state()
    run_load(layers, landing)
    before = mart_rows(layers)
    with pytest.raises(ConcurrentRun):
        layers.commit("late", "late-1", {"mart": ["202608"]}, state)
    assert mart_rows(layers) == before


def test_compaction_keeps_state_runs_and_ledger(spark, landing, layers):
    for day in days(3):
        land(landing, day, [quote("USD", 10)])
        run_load(layers, landing, run_id=f"run-{day:%d}")
    before, runs = mart_rows(layers), layers.commits().count()
    layers.compact()
    assert mart_rows(layers) == before and layers.commits().count() <= runs
    assert layers.state("run-10").committed
    assert run_load(layers, landing).status == "skipped"
    land(landing, days(4)[3], [quote("USD", 11)])
    assert run_load(layers, landing).status == "loaded"
    layers.compact()
    assert len(mart_rows(layers)) == 4


def same_as_recomputed(layers):
    staging, mart = layers.read("staging").drop("bucket"), layers.read("mart")
    assert sorted(mart_daily(staging).drop("updated_at").collect()) == sorted(mart.drop("updated_at", "bucket").collect())
    # What is kept beside the buckets is what they hold.
    kept = sorted((r.bucket, r.cur_unit, r.cur_nm, r.rows, r.quotes) for r in layers.read("codes").collect())
    assert kept == sorted((r.bucket, r.cur_unit, r.cur_nm, r.rows, r.quotes) for r in code_states(staging, layers.bucket()).collect())
    kept = sorted(map(tuple, layers.read("dates").drop("bucket").collect()))
    assert kept == sorted(map(tuple, date_states(mart.drop("bucket")).collect()))


@pytest.mark.parametrize("grain", ["yyyyMM", "yyyyMMdd"])
def test_changes_anywhere_read_the_kept_quotes(spark, landing, root, grain):
    """Dense and sparse codes, a late file in an old gap, a correction and several buckets at once."""
    layers = create_layers(spark, root, grain, stale_days=None)
    rng = random.Random(7)
    span = days(130, date(2025, 11, 3))

    def quotes(i):
        sparse = [quote("EUR", 50 + i)] if i % 23 == 0 else []
        return [quote("USD", 100 + i), *([quote("JPY", i + 1)] if rng.random() < 0.4 else []), *sparse]

    held_back = {17, 64, 65, 99}
    for i, day in enumerate(span):
        if i not in held_back:
            land(landing, day, quotes(i))
    run_load(layers, landing, "2026-06-01 00:00:00")
    land(landing, span[17], [quote("USD", 5), quote("EUR", 6)])
    land(landing, span[99], [quote("JPY", 7)])
    land(landing, span[46], [quote("USD", 1), quote("EUR", 2), quote("NEW", 3)])
    # The same load time as before: older rows with it must come out as they were.
    run_load(layers, landing, "2026-06-01 00:00:00")
    same_as_recomputed(layers)
    land(landing, span[0] - timedelta(days=400), [quote("EUR", 9)])
    land(landing, span[64], [quote("EUR", 10)])
    run_load(layers, landing, "2026-06-02 00:00:00")
    same_as_recomputed(layers)


def test_age_of_the_mart_is_read_from_its_newest_bucket(landing, layers):
    for day in (date(2026, 6, 1), date(2026, 7, 1), DAY_1):
        land(landing, day, [quote("USD", 10)])
    run_load(layers, landing)
    assert {path.split("bucket=")[1][:6] for path in layers.newest("dates").inputFiles()} == {"202608"}


def test_snapshots_are_not_read_again_for_counts(landing, layers, monkeypatch):
    """One read of keys per snapshot, and one of STAGING to build the mart."""
    land(landing, DAY_1, [quote("USD", 10)])
    reads = []
    read = type(layers).read_snapshot
    monkeypatch.setattr(type(layers), "read_snapshot", lambda self, layer, name: reads.append(layer) or read(self, layer, name))
    run_load(layers, landing)
    assert sorted(reads) == ["mart", "staging", "staging"]


def test_stored_lookups_open_no_panel_file(landing, layers):
    for i, day in enumerate(days(40)):
        if day.weekday() < 5 and i != 9:
            land(landing, day, [quote("USD", 100 + i), *([quote("EUR", 1 + i)] if i % 2 else [])])
    run_load(layers, landing, "2026-10-01 08:00:00")
    panel = StoredPanel(layers)
    for frame in (panel.history(), panel.completeness(), panel.missing_weekdays(), panel.recent_dates(5), panel.latest(), panel.ops(), panel.freshness("2026-10-01 10:00:00"), panel.names):
        plan = frame._jdf.queryExecution().toString()
        assert "/mart/" not in plan and "/staging/" not in plan
    mart = layers.read("mart")
    from quotepanel.operators import ops

    assert sorted(panel.history().collect()) == sorted(ops.history(mart).collect())
    assert panel.completeness().collect() == ops.completeness(mart).collect()
    assert [r[0] for r in panel.missing_weekdays().collect()] == [days(40)[9]]
    assert panel.ops().collect() == ops.ops(mart).collect()
    assert sorted(panel.period(5).collect()) == sorted(period.period(mart, 5).collect())
    assert panel.snapshot().collect() == period.snapshot(mart).collect()
    assert panel.selected(["EUR"], 5).count() == period.period(mart, 5).filter("cur_unit = 'EUR'").count()
    # Names come with the panel, and STAGING is not opened for them.
    enriched = panel.enriched()
    assert "/staging/" not in enriched._jdf.queryExecution().toString()
    assert {(r["cur_unit"], r["cur_nm"]) for r in enriched.collect()} == {("USD", "usd"), ("EUR", "eur")}
    # Only the bucket of the period is opened for its rows.
    assert "PartitionFilters: [isnotnull(bucket" in panel.period(5)._jdf.queryExecution().executedPlan().toString()


def test_a_state_stays_what_it_was(landing, layers):
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing)
    before = StoredPanel(layers)
    land(landing, DAY_1, [quote("USD", 2000)])
    run_load(layers, landing)
    assert [r["rate"] for r in before.enriched().collect()] == [10.0]
    assert [r["rate"] for r in StoredPanel(layers).enriched().collect()] == [2000.0]


def test_expiry_leaves_a_reader_its_snapshot(landing, layers):
    hour, now = timedelta(hours=1), datetime(2026, 9, 1, tzinfo=timezone.utc)
    land(landing, DAY_1, [quote("USD", 10)])
    run_load(layers, landing)
    assert layers.expire(hour, now) == []
    reader = layers.read("mart")
    land(landing, DAY_1, [quote("USD", 2000)])
    run_load(layers, landing)
    current = mart_rows(layers)
    # Superseded since: noted now, kept for the grace time, then gone.
    assert not any("/mart/" in path for path in layers.expire(hour, now + 2 * hour))
    assert [r["rate"] for r in reader.collect()] == [10.0]
    layers.compact()
    gone = layers.expire(hour, now + 4 * hour)
    assert sum("/mart/" in path for path in gone) == sum("/staging/" in path for path in gone) == 1
    assert mart_rows(layers) == current
    with pytest.raises(Exception):
        reader.collect()
    # Old generations of the logs go as well, and loads go on.
    assert any("/commits/gen=0" in path for path in layers.expire(hour, now + 6 * hour))
    assert run_load(layers, landing).status == "skipped"
    land(landing, days(2)[1], [quote("USD", 11)])
    assert run_load(layers, landing).status == "loaded" and len(mart_rows(layers)) == 2


def test_expiry_removes_attempts_that_never_committed(spark, landing, layers, monkeypatch):
    hour, now = timedelta(hours=1), datetime(2026, 9, 1, tzinfo=timezone.utc)
    land(landing, DAY_1, [quote("USD", 10)])

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(type(layers), "commit", die)
        with pytest.raises(RuntimeError):
            run_load(layers, landing)
    layers.expire(hour, now)
    assert run_load(layers, landing).status == "loaded"
    gone = layers.expire(hour, now + 2 * hour)
    assert sum("/mart/" in path for path in gone) == 1 and any("/work/" in path for path in gone)
    assert len(mart_rows(layers)) == 1 and layers.raw().count() == 2


def test_stream_loads_a_file_rewritten_in_place(landing, layers):
    checkpoint = layers.path("checkpoint")
    for i, day in enumerate(days(3)):
        land(landing, day, [quote("USD", 100 + i)])
    stream_ingest(layers, landing, checkpoint).awaitTermination()
    assert layers.ledger().count() == 3
    land(landing, DAY_1, [quote("USD", 2000.5)])
    stream_ingest(layers, landing, checkpoint).awaitTermination()
    assert [r[2] for r in mart_rows(layers)] == [2000.5, 101.0, 102.0]
    assert layers.raw().count() == 4
    # A rewritten and a new file at once; what the stream loaded is known to the batch load.
    land(landing, days(2)[1], [quote("USD", 3000.25)])
    land(landing, days(4)[3], [quote("USD", 7)])
    stream_ingest(layers, landing, checkpoint).awaitTermination()
    assert [r[2] for r in mart_rows(layers)] == [2000.5, 3000.25, 102.0, 7.0]
    assert run_load(layers, landing).status == "skipped"


def test_stream_and_rebuild_take_the_day_their_mart_is_judged_by(spark, landing, root):
    layers = create_layers(spark, root)
    land(landing, DAY_1, [quote("USD", 10)])
    with pytest.raises(Exception, match="mart_stale"):
        stream_ingest(layers, landing, layers.path("one"), as_of=DAY_1 + timedelta(days=5)).awaitTermination()
    stream_ingest(layers, landing, layers.path("two"), as_of=DAY_1 + timedelta(days=4)).awaitTermination()
    with pytest.raises(QualityError):
        rebuild(layers, as_of=DAY_1 + timedelta(days=5))
    assert rebuild(layers, as_of=DAY_1).status == "loaded"


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "32k", "spark.sql.files.openCostInBytes": "1k"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def in_order(raw):
    rows = raw.select("file_name", "block", "line", "pos", F.to_json("raw_data").alias("j")).collect()
    return [(r[0], r[4]) for r in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3]))]


def test_large_array_is_read_by_many_tasks(spark, landing, small_splits):
    os.makedirs(landing)
    flat = [{"result": 1, "cur_unit": f"C{i}", "cur_nm": "a [b], \\ \"c\", é", "deal_bas_r": f"{i:,}.50"} for i in range(4000)]
    shapes = {
        "20260810": json.dumps(flat, indent=2, ensure_ascii=False),
        "20260811": json.dumps(flat[:5]),
        "20260812": "[]",
        "20260813": json.dumps([quote("USD", 1), quote("EUR", 2)], indent=1),  # an object inside
        "20260814": json.dumps([{"result": 1, "cur_unit": "U}, {V", "deal_bas_r": "1"}]),  # braces in a text
        "20260815": json.dumps({"result": 1, "cur_unit": "ONE", "deal_bas_r": "1"}),  # no array
    }
    for name, text in shapes.items():
        with open(f"{landing}/exchange_rate_{name}.json", "w") as out:
            out.write(text)
    split = read_landing_split(spark, landing, "2026-08-16 00:00:00")
    blocks = split.filter("file_name LIKE '%20260810%'").select("block").distinct().count()
    assert blocks > 5
    assert in_order(split) == in_order(read_landing_variant(spark, landing, "2026-08-16 00:00:00"))


@pytest.mark.parametrize("text", ['[{"cur_unit": "A"}, {"cur_unit": "B"', '[{"cur_unit": "A"}, {"cur_unit": "B"}', '[{"cur_unit": "A"} {"cur_unit": "B"}]'])
def test_malformed_large_array_fails_the_load(spark, landing, layers, text):
    os.makedirs(landing)
    with open(f"{landing}/exchange_rate_20260810.json", "w") as out:
        out.write(text)
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILFAST"):
        run_load(layers, landing, split_bytes=1)
    assert layers.raw().count() == 0


def test_load_cuts_files_above_the_size(landing, layers, small_splits):
    quotes = [{"result": 1, "cur_unit": f"C{i:04d}", "cur_nm": "n", "deal_bas_r": str(i)} for i in range(1500)]
    # The same code twice: the later place in the file wins, whichever task reads it.
    land(landing, DAY_1, [*quotes, {"result": 1, "cur_unit": "C0000", "cur_nm": "n", "deal_bas_r": "9999"}], indent=2)
    land(landing, days(2)[1], [quote("C0000", 5)])
    assert run_load(layers, landing, split_bytes=50_000).status == "loaded"
    rows = {(r[0], r[1]): r[2] for r in mart_rows(layers)}
    assert len(rows) == 1501 and rows[DAY_1, "C0000"] == 9999.0 and rows[days(2)[1], "C0000"] == 5.0
