"""The daily load and the backfill: landing -> RAW -> STAGING -> MART."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from quotepanel.functions.dates import BUCKET
from quotepanel.functions.numeric import file_stamp
from quotepanel.operators.mart import affected_near, mart_daily, mart_incremental, nearest_rows, reach
from quotepanel.operators.quality import STALE_DAYS, gate_counts, not_null, stale, unique_key
from quotepanel.operators.staging import staging as staging_model, utc_now
from quotepanel.operators.state import edges
from quotepanel.operators.upsert import upsert, upsert_newest
from quotepanel.schemas import KEYS
from quotepanel.sources.landing import folders_of, list_files, new_files, read_landing_split, read_landing_variant
from quotepanel.sources.layers import CHECKED, Layers, State

# Buckets on either side of a change whose kept quotes are read at once: most
# codes have four quotes there.
NEIGHBOURS = {"yyyy": 1, "yyyyMM": 2, "yyyyMMdd": 8}


# Bytes from which a file of one multi-line array is cut; a file below is one task.
SPLIT_BYTES = 256 << 20


@dataclass(frozen=True)
class LoadResult:
    status: str  # loaded, skipped or repeated
    run_id: str


def table_checks(rows: DataFrame, layer: str) -> dict[str, DataFrame]:
    """The not-null and unique-key checks of one layer."""
    return {
        f"{layer}_not_null": not_null(rows, CHECKED[layer]),
        f"{layer}_unique_key": unique_key(rows),
    }


def _failures(layer: str, seen: dict[str, int], repeated: int) -> dict[str, int]:
    """The same checks from what was counted while the rows were written."""
    return {f"{layer}_not_null": seen["nulls"], f"{layer}_unique_key": repeated}


def _stale(layers: Layers, pending: dict[str, str], state: State, run_ts, as_of: date | None) -> dict[str, int]:
    """The age of the mart from its newest bucket; it counts from ``as_of``, else from the run's own day."""
    if layers.stale_days is None and as_of is None:
        return {}
    day = as_of or (F.to_date(utc_now()) if run_ts is None else F.lit(run_ts).cast("date"))
    days = STALE_DAYS if layers.stale_days is None else layers.stale_days
    return {"mart_stale": stale(layers.newest("dates", pending, state), day, days).count()}


def new_attempt(run_id: str) -> str:
    """Folder name of one try of a run: none is ever written twice."""
    return f"{run_id}-{uuid.uuid4().hex[:8]}"


def _build(layers: Layers, state: State, raw: DataFrame, run_id: str, run_ts, as_of: date | None) -> LoadResult:
    """STAGING and MART as wholes from RAW rows, each written once."""
    attempt = new_attempt(run_id)
    seen = layers.write_snapshot("staging", staging_model(raw, run_ts), attempt)
    if not seen["rows"]:
        return LoadResult("skipped", run_id)
    gate_counts(_failures("staging", seen, layers.keep_codes(attempt)))
    seen = layers.write_snapshot("mart", mart_daily(layers.read_snapshot("staging", attempt), run_ts), attempt)
    repeated = layers.keep_dates(attempt)
    buckets = layers.buckets_of("mart", attempt)
    gate_counts(_failures("mart", seen, repeated) | _stale(layers, dict.fromkeys(buckets, attempt), state, run_ts, as_of))
    layers.commit(run_id, attempt, dict.fromkeys(("staging", "codes", "mart", "dates"), buckets), state)
    return LoadResult("loaded", run_id)


def _kept_edges(layers: Layers, buckets: list[str], state: State) -> DataFrame:
    return edges(layers.read("codes", buckets, state=state))


def _mart_delta(
    layers: Layers, state: State, pending: dict[str, str], delta: DataFrame, first: date, last: date, run_ts
) -> DataFrame:
    """Affected mart rows, from the changed staging buckets and the kept quotes of others."""
    whole = layers.read("staging", pending, pending=pending, state=state).select(*KEYS, "rate", "updated_at")
    others = sorted(set(layers.folders("codes", state=state)) - set(pending))
    low, high = min(pending), max(pending)
    older, newer = [b for b in others if b < low], [b for b in others if b > high]
    n = NEIGHBOURS[layers.grain]
    near = [b for b in others if low < b < high] + older[-n:] + newer[:n]
    kept = _kept_edges(layers, near, state)
    if older[:-n] or newer[n:]:
        # Most loads find four rows for every code on either side and read nothing more.
        short = layers.stage("short", reach(whole.unionByName(kept), delta, first, last), run_attempt(pending))
        for buckets, side, onward in ((older[:-n], "short_older", False), (newer[n:], "short_newer", True)):
            codes = short.filter(side)
            if buckets and not codes.isEmpty():
                kept = kept.unionByName(nearest_rows(_kept_edges(layers, buckets, state), codes, onward).select(kept.columns))
    # The rows of this load carry its time. An older row with an equal time
    # comes out as it was, provided its frame is whole: not before `first`.
    ours = F.col("updated_at") == delta.agg(F.max("updated_at")).scalar()
    return affected_near(whole, kept, delta, ours & (F.col("result_date") >= F.lit(first)), run_ts)


def run_attempt(pending: dict[str, str]) -> str:
    """The attempt that all pending snapshots belong to."""
    return next(iter(pending.values()))


def apply_load(
    layers: Layers, landed: DataFrame, run_id: str, run_ts=None, as_of: date | None = None
) -> LoadResult:
    """Carry landed RAW rows through to a committed mart.

    RAW keeps what was landed even if a check fails. STAGING is checked
    before the mart is computed, the mart before both become visible. A row
    of an earlier load time does not replace one of a later.
    """
    state = layers.state(run_id)
    if state.committed:
        return LoadResult("repeated", run_id)
    raw = layers.append_raw(landed, run_id)
    # Layers without kept codes and dates are of an older form: made anew as wholes.
    if not state.current["staging"] or state.current["staging"].keys() != state.current["codes"].keys():
        return _build(layers, state, layers.raw() if state.current["staging"] else raw, run_id, run_ts, as_of)

    attempt = new_attempt(run_id)
    delta = layers.stage("staging", staging_model(raw, run_ts), attempt)
    facts = layers.bucket_facts(delta)
    if not facts:
        return LoadResult("skipped", run_id)
    repeated = sum(n for _, _, n in facts.values())
    gate_counts({"staging_not_null": not_null(delta, CHECKED["staging"]).count(), "staging_unique_key": repeated})

    known = layers.read("staging", facts, state=state).drop(BUCKET)
    layers.write_snapshot("staging", upsert_newest(known, delta, "loaded_at"), attempt)
    gate_counts({"staging_unique_key": layers.keep_codes(attempt)})

    pending = dict.fromkeys(facts, attempt)
    first, last = min(a for a, _, _ in facts.values()), max(b for _, b, _ in facts.values())
    rows = _mart_delta(layers, state, pending, delta, first, last, run_ts)
    mart_delta = layers.stage("mart", rows, attempt)
    altered = layers.bucket_ranges(mart_delta)
    known = layers.read("mart", altered, state=state).drop(BUCKET)
    seen = layers.write_snapshot("mart", upsert(known, mart_delta), attempt)
    repeated = layers.keep_dates(attempt)

    gate_counts(_failures("mart", seen, repeated) | _stale(layers, dict.fromkeys(altered, attempt), state, run_ts, as_of))
    layers.commit(run_id, attempt, {"staging": facts, "codes": facts, "mart": altered, "dates": altered}, state)
    return LoadResult("loaded", run_id)


def _in_range(files: DataFrame, start: date | None, end: date | None) -> DataFrame:
    # The date in the folder or file name; unnamed files belong to no range.
    name = F.regexp_extract("path", "(search_date=[0-9]{8}/[^/]+|[^/]+)$", 1)
    stamp = file_stamp(name)
    if start is not None:
        files = files.filter(stamp >= f"{start:%Y%m%d}")
    if end is not None:
        files = files.filter(stamp <= f"{end:%Y%m%d}")
    return files


def landed_rows(
    layers: Layers, found: DataFrame, run_ts=None, multi_line: bool = True, split_bytes: int = SPLIT_BYTES
) -> DataFrame | None:
    """RAW rows of the listed files, large arrays cut; None without files."""
    # The driver sees the folders, one per date; which of their files are new is a join.
    folders = folders_of(found)
    if not folders:
        return None
    if not multi_line:
        return read_landing_variant(layers.spark, folders, run_ts, multi_line=False, files=found)
    large = F.col("size") >= split_bytes
    cut = folders_of(found.filter(large))
    if not cut:
        return read_landing_variant(layers.spark, folders, run_ts, files=found)
    split = read_landing_split(layers.spark, cut, run_ts, found.filter(large))
    return split.unionByName(read_landing_variant(layers.spark, folders, run_ts, files=found.filter(~large)))


def run_load(
    layers: Layers,
    landing: str,
    run_ts=None,
    start: date | None = None,
    end: date | None = None,
    as_of: date | None = None,
    run_id: str | None = None,
    multi_line: bool = True,
    split_bytes: int = SPLIT_BYTES,
) -> LoadResult:
    """Load the landed files not in the ledger, optionally of a date range.

    A backfill is the same call with a range: all its days in one job. Files
    enter the ledger only after their run is committed or found empty, so a
    run that fails is retried with the same files.
    """
    run_id = run_id or f"run-{uuid.uuid4().hex[:12]}"
    listing = new_files(list_files(layers.spark, landing), layers.ledger())
    found = layers.stage("files", _in_range(listing, start, end), new_attempt(run_id))
    landed = landed_rows(layers, found, run_ts, multi_line, split_bytes)
    if landed is None:
        return LoadResult("skipped", run_id)
    result = apply_load(layers, landed, run_id, run_ts, as_of)
    layers.append_ledger(found, run_id)
    return result


def rebuild(layers: Layers, run_ts=None, run_id: str | None = None, as_of: date | None = None) -> LoadResult:
    """Full recompute of STAGING and MART from all of RAW."""
    run_id = run_id or f"rebuild-{uuid.uuid4().hex[:12]}"
    return _build(layers, layers.state(), layers.raw(), run_id, run_ts, as_of)


def backfill(
    raw: DataFrame,
    staging: DataFrame,
    mart: DataFrame,
    start: date,
    end: date,
    run_ts=None,
    store: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> tuple[DataFrame, DataFrame]:
    """New STAGING and MART after re-running the days ``start`` to ``end``.

    The form of ``run_load`` over frames; ``store`` as in ``mart_incremental``.
    """
    stamp = file_stamp(F.col("file_name"))
    chosen = raw.filter((stamp >= f"{start:%Y%m%d}") & (stamp <= f"{end:%Y%m%d}"))
    delta = store(staging_model(chosen, run_ts))
    after = upsert(staging, delta.select(*staging.columns))
    return after, mart_incremental(after, delta.select(*KEYS), mart, run_ts, store)
