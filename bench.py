"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, one JSON line.

Queries by name start from the raw tables; ``stored_*`` start from a mart that
is stored once, as between two daily runs, and ``build_mart`` is that build.
``incremental_*`` correct one date: they read its bucket and the quotes kept
beside the neighbouring buckets, and write the buckets of the mart that change.
Each query runs once to warm up and then ``$BENCH_RUNS`` times (default 3);
the median counts. Results go to a sink that reads every row and column.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time
from datetime import date
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, functions as F  # noqa: E402

from quotepanel.operators import detail, ops, overview, period, risk  # noqa: E402
from quotepanel.functions.dates import BUCKET  # noqa: E402
from quotepanel.operators.mart import affected_near, mart_daily  # noqa: E402
from quotepanel.operators.state import code_states, edges  # noqa: E402
from quotepanel.operators.upsert import upsert_once  # noqa: E402
from quotepanel.plans import panels  # noqa: E402
from quotepanel.plans.catalog import QUERIES  # noqa: E402
from quotepanel.session import local_session, shared_folder, stored  # noqa: E402

HEADLINE = [
    "ingest_to_mart",
    "dedupe_latest",
    "mart_daily",
    "enrich_names",
    "period_filter",
    "return_ranking",
    "period_summary",
    "direction_streak",
    "disparity_signal",
    "annualised_volatility",
    "move_alerts",
    "cross_rates_history",
    "change_correlation",
    "latest_completeness",
    "dq_report",
    "upsert_rows",
]


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(run, runs: int) -> float:
    run()
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def by_bucket(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table with a folder per year, as the layers keep it."""
    path = shared_folder(frame.sparkSession, f"bench-{name}")
    bucketed = frame if BUCKET in frame.columns else frame.withColumn(BUCKET, F.date_format("result_date", "yyyy"))
    bucketed.repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)
    schema = bucketed.drop(BUCKET).schema.add(BUCKET, "string")
    return frame.sparkSession.read.schema(schema).parquet(path)


def correction(tables: dict[str, DataFrame], states: DataFrame, changed: DataFrame, day: date, years: list[int]) -> DataFrame:
    """The mart buckets that a correction of all quotes of ``day`` changes, from its bucket and the states around it.

    A change reaches four rows on, so into the next year at most.
    """
    own, near = str(day.year), [str(y) for y in years if abs(y - day.year) == 1]
    at = F.col("result_date") == F.lit(day)
    whole = tables["staging"].filter(F.col(BUCKET) == own).withColumn("rate", F.when(at, F.col("rate") * 2).otherwise(F.col("rate")))
    kept = edges(states.filter(F.col(BUCKET).isin(near)))
    affected = affected_near(whole, kept, changed, at).drop("updated_at")
    reached = tables["mart"].filter(F.col(BUCKET).isin(own, str(day.year + 1))).drop(BUCKET, "updated_at")
    return upsert_once(reached, affected)


def corrections(times: dict[str, float], suffix: str, panel: DataFrame, runs: int) -> None:
    """Times of correcting one date in the middle of the history and its last one."""
    mart = mart_daily(panel)
    tables = {name: by_bucket(frame, name) for name, frame in (("staging", panel), ("mart", mart))}
    year = F.date_format("result_date", "yyyy")
    named = panel.select("*", F.lit(None).cast("string").alias("cur_nm"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    states = by_bucket(code_states(named, year), "codes")
    years = [int(row[0]) for row in panel.select(year).distinct().collect()]
    latest = panel.agg(F.max("result_date")).first()[0]
    for name, day in (("incremental_mid_history", date(1998, 3, 2)), ("incremental_latest_day", latest)):
        # The correction has arrived and is a table, as in a load.
        changed = stored(panel.filter(F.col("result_date") == day).select("result_date", "cur_unit"), "bench-changed")
        times[name + suffix] = seconds(lambda day=day, changed=changed: consume(correction(tables, states, changed, day, years)), runs)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, "quotepanel-bench")
    spark.sparkContext.setLogLevel("ERROR")

    times = {name: seconds(lambda: consume(QUERIES[name](spark, sf_dir)), runs) for name in HEADLINE}

    # Between two daily runs STAGING and mart are tables; one date is corrected.
    panel = stored(panels.suppliers_panel(spark, sf_dir), "bench-staging")
    mart = stored(mart_daily(panel), "bench-mart")
    times["build_mart"] = seconds(lambda: consume(mart_daily(panel)), runs)
    codes = [row["cur_unit"] for row in mart.select("cur_unit").distinct().orderBy("cur_unit").limit(7).collect()]
    on_mart = {
        "period_filter": lambda: period.period(mart, 250),
        "return_ranking": lambda: overview.returns(mart, 250),
        "period_summary": lambda: overview.summarise(period.period(mart, 250)),
        "annualised_volatility": lambda: risk.volatility_of(period.period(mart, 250)),
        "move_alerts": lambda: risk.alerts(mart, 250),
        "disparity_signal": lambda: detail.signals_of(period.snapshot(mart)),
        "change_correlation": lambda: risk.correlation(mart, codes, None),
        "latest_completeness": lambda: ops.completeness(mart),
    }
    for name, frame in on_mart.items():
        times[f"stored_{name}"] = seconds(lambda frame=frame: consume(frame()), runs)
    corrections(times, "", panel, runs)
    # The same with eight times the codes: where a load starts to pay.
    copies = F.explode(F.sequence(F.lit(1), F.lit(8))).alias("copy")
    wide = panel.select("result_date", "cur_unit", "rate", copies).withColumn("cur_unit", F.concat_ws("-", "cur_unit", "copy")).drop("copy")
    wide = stored(wide, "bench-wide")
    times["build_mart_x8"] = seconds(lambda: consume(mart_daily(wide)), runs)
    corrections(times, "_x8", wide, runs)

    rows = panel.count()
    print(
        json.dumps(
            {
                "metric": "quote panel headline queries, total of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "panel_rows": rows,
                "hardware": f"local[{cpus}], {platform.machine()}, {os.cpu_count()} cores",
            }
        )
    )


if __name__ == "__main__":
    main()
