"""Hand-written rows with results worked out by hand."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quotepanel.functions import numeric, text
from quotepanel.operators import detail, ops, overview, period, quality, risk
from quotepanel.operators.mart import mart_daily, mart_incremental
from quotepanel.operators.names import display, enrich, labelled
from quotepanel.operators.staging import staging, staging_quarantine
from quotepanel.operators.upsert import DuplicateKeys, guarded_upsert, upsert

START = date(2026, 8, 3)  # a Monday


def panel(spark, series, start=START):
    """``{code: [rate, ...]}`` on consecutive days; None leaves a day out."""
    rows = [
        (start + timedelta(days=i), code, None if rate is None else float(rate))
        for code, rates in series.items()
        for i, rate in enumerate(rates)
        if rate != "absent"
    ]
    return spark.createDataFrame(rows, "result_date date, cur_unit string, rate double")


def mart(spark, series):
    return mart_daily(panel(spark, series), "2026-08-14 00:00:00")


def column(df, name, order="result_date"):
    return [row[name] for row in df.orderBy(order).collect()]


def raw(spark, rows):
    """(json text, file name, load hour) rows."""
    data = [(j, i, f, datetime(2026, 8, 14, h)) for i, (j, f, h) in enumerate(rows)]
    frame = spark.createDataFrame(data, "json string, pos int, file_name string, loaded_at timestamp_ntz")
    return frame.select(F.parse_json("json").alias("raw_data"), "pos", "file_name", "loaded_at")


def quote(code="USD", rate="1,400.5", result="1", name="Dollar"):
    return f'{{"result": {result}, "cur_unit": "{code}", "cur_nm": "{name}", "deal_bas_r": "{rate}"}}'


def staged(spark, rows):
    out = staging(raw(spark, rows), "2026-08-14 00:00:00")
    return [(str(r["result_date"]), r["cur_unit"], r["rate"]) for r in out.collect()]


DAY = "exchange_rate_20260814.json"


class TestStaging:
    def test_commas_and_compressed_name(self, spark):
        assert staged(spark, [(quote(), DAY + ".gz", 1)]) == [("2026-08-14", "USD", 1400.5)]

    def test_result_as_number_or_text(self, spark):
        rows = [(quote("USD", result="1"), DAY, 1), (quote("EUR", result='"1"'), DAY, 1)]
        assert len(staged(spark, rows)) == 2

    def test_failed_or_missing_result_is_dropped(self, spark):
        rows = [('{"result": 2, "cur_unit": null}', DAY, 1), ('{"cur_unit": "USD"}', DAY, 1), ('{"result": null}', DAY, 1)]
        assert staged(spark, rows) == []

    def test_later_load_wins(self, spark):
        rows = [(quote(rate="2"), DAY, 2), (quote(rate="1"), DAY, 1)]
        assert staged(spark, rows) == [("2026-08-14", "USD", 2.0)]

    def test_later_failed_load_does_not_replace_a_good_one(self, spark):
        rows = [(quote(rate="1"), DAY, 1), (quote(rate="9", result="2"), DAY, 2)]
        assert staged(spark, rows) == [("2026-08-14", "USD", 1.0)]

    def test_plain_and_compressed_file_of_a_day_compete(self, spark):
        rows = [(quote(rate="1"), DAY, 1), (quote(rate="2"), DAY + ".gz", 2)]
        assert staged(spark, rows) == [("2026-08-14", "USD", 2.0)]

    def test_name_without_date_gives_null_date_that_the_check_reports(self, spark):
        out = staging(raw(spark, [(quote(), "rates.json", 1)]), "2026-08-14 00:00:00")
        assert [r["rule"] for r in quality.not_null(out, ["result_date", "rate"]).collect()] == ["not_null_result_date"]

    @pytest.mark.parametrize("row", [(quote(), "exchange_rate_20261340.json", 1), (quote(rate="n/a"), DAY, 1)])
    def test_bad_values_fail_or_are_quarantined(self, spark, row):
        with pytest.raises(PySparkException):
            staging(raw(spark, [row])).collect()
        good, rejected = staging_quarantine(raw(spark, [row, (quote("EUR"), DAY, 1)]), "2026-08-14 00:00:00")
        assert [r["cur_unit"] for r in good.collect()] == ["EUR"]
        assert [r["cur_unit"] for r in rejected.collect()] == ["USD"]


class TestMart:
    def test_first_row_and_short_frames(self, spark):
        m = mart(spark, {"USD": [1, 2, 3]})
        assert column(m, "prev_rate") == [None, 1.0, 2.0]
        assert column(m, "change_pct") == [None, 100.0, 50.0]
        assert column(m, "ma_5") == [1.0, 1.5, 2.0]

    def test_frame_is_five_rows(self, spark):
        assert column(mart(spark, {"USD": range(1, 7)}), "ma_5")[-1] == 4.0

    def test_five_available_rows_whatever_the_gap(self, spark):
        m = mart(spark, {"USD": [1, "absent", "absent", 2, 3, "absent", 4, 5, 6]})
        assert column(m, "ma_5")[-1] == 4.0
        assert column(m, "prev_rate") == [None, 1.0, 2.0, 3.0, 4.0, 5.0]

    def test_zero_previous_value(self, spark):
        assert column(mart(spark, {"USD": [0, 5]}), "change_pct") == [None, None]

    def test_a_correction_repairs_five_rows_only(self, spark):
        before = panel(spark, {"USD": range(1, 13), "EUR": range(2, 14)})
        changed = F.when((F.col("cur_unit") == "USD") & (F.col("rate") == 4), 40.0).otherwise(F.col("rate"))
        after = before.withColumn("rate", changed)
        keys = after.filter("rate = 40")
        old = mart_daily(before, "2026-08-14 00:00:00")
        new = mart_incremental(after, keys, old, "2026-08-15 00:00:00")
        stamp = datetime(2026, 8, 15)
        assert sorted(r["result_date"].day for r in new.filter(F.col("updated_at") == stamp).collect()) == [6, 7, 8, 9, 10]
        drop = ["updated_at"]
        assert sorted(new.drop(*drop).collect()) == sorted(mart_daily(after).drop(*drop).collect())


class TestStreak:
    @pytest.mark.parametrize(
        "rates, expected",
        [
            ([1, 2, 3, 3], 2),
            ([1, 2, 2, 3], 1),
            ([2, 2, 2], 0),
            ([3, 2, 1], -2),
            ([1], 0),
            ([1, 2, 1, 1, 1], -1),
        ],
    )
    def test_streak(self, spark, rates, expected):
        assert column(detail.streak_of(panel(spark, {"USD": rates})), "streak", "cur_unit") == [expected]

    def test_moves_are_taken_inside_the_period(self, spark):
        m = mart(spark, {"USD": [1, 2, 3, 4]})
        assert column(detail.streak(m, ["USD"], 2), "streak", "cur_unit") == [1]


class TestOverview:
    def test_flat_range_sits_in_the_middle(self, spark):
        row = overview.summarise(panel(spark, {"USD": [5, 5]})).first()
        assert (row["position"], row["range_pct"], row["stddev"]) == (50.0, 0.0, 0.0)

    def test_one_value(self, spark):
        row = overview.summarise(panel(spark, {"USD": [5]})).first()
        assert (row["last"], row["stddev"], row["position"]) == (5.0, None, 50.0)

    def test_low_of_zero_has_no_range(self, spark):
        assert overview.summarise(panel(spark, {"USD": [0, 5]})).first()["range_pct"] is None

    def test_fewer_than_eight_codes_are_ranked_once(self, spark):
        ranked = overview.returns(panel(spark, {c: [1, i + 1] for i, c in enumerate("ABCDE")}), None)
        assert overview.top_bottom(ranked).count() == 5

    def test_ranking_skips_a_first_rate_of_zero_and_may_be_empty(self, spark):
        ranked = overview.returns(panel(spark, {"USD": [0, 5]}), None)
        assert overview.top_bottom(ranked).collect() == []

    def test_series_starting_at_zero_is_not_scaled(self, spark):
        out = overview.series(mart(spark, {"USD": [0, 5]}), ["USD"], None, normalise=True)
        assert column(out, "y") == [0.0, 5.0]

    def test_normalised_on_the_first_row_of_the_period(self, spark):
        out = overview.series(mart(spark, {"USD": [1, 2, 4]}), ["USD"], 2, normalise=True)
        assert column(out, "y") == [100.0, 200.0]
        assert column(out, "y_ma") == pytest.approx([75.0, 116.665])

    def test_kpi_follows_the_selection_and_drops_unquoted_codes(self, spark):
        m = mart(spark, {"USD": [1, 2], "EUR": [4, "absent"], "CNH": [5, 6]})
        assert {r["cur_unit"] for r in overview.kpi(m, ["CNH", "EUR", "USD"], k=2).collect()} == {"CNH"}


class TestPeriod:
    def test_dates_count_over_all_codes(self, spark):
        p = panel(spark, {"USD": [1, 2, 3, 4], "EUR": [1, 2, "absent", "absent"]})
        assert period.period(p, 2).count() == 2
        assert period.period(p, 3).count() == 4
        assert period.period(p, None).count() == 6

    def test_default_selection(self, spark):
        p = panel(spark, {c: [1] for c in ["CNH", "USD", "AUD"]})
        assert period.code_list(p) == ["USD", "CNH"]
        assert period.code_list(p, None, ["XXX"]) == ["AUD", "CNH", "USD"]
        assert period.code_list(p, ["AUD", "CNH"], first=1) == ["AUD"]

    def test_empty_panel(self, spark):
        p = panel(spark, {"USD": [1]}).filter("false")
        assert quality.is_empty(p)
        assert period.period(p, 3).collect() == []
        assert period.snapshot(p).collect() == []
        assert period.code_list(p) == []


class TestDetail:
    def test_cross_rate_per_unit(self, spark):
        m = mart(spark, {"USD": [1400, 1400], "JPY(100)": [1000, 1000]})
        row = detail.cross(m).first()
        assert (row["base"], row["quote"], row["cross"], row["change_pct"]) == ("USD", "JPY(100)", 140.0, 0.0)
        shown = detail.cross_text(detail.cross(m)).first()
        assert (shown["text"], shown["change_text"]) == ("1 USD = 140.0000 JPY", "+0.00%")

    def test_quote_of_zero_is_skipped(self, spark):
        assert detail.cross(mart(spark, {"USD": [1], "EUR": [0]})).collect() == []

    def test_pairs_meet_on_the_same_date_only(self, spark):
        m = mart(spark, {"USD": [2, 2], "EUR": [4, "absent"], "CNH": [1, 1]})
        out = detail.cross_pairs(m, [("USD", "EUR"), ("EUR", "USD"), ("USD", "USD")])
        assert sorted((r["base"], r["quote"], r["cross"]) for r in out.collect()) == [("EUR", "USD", 2.0), ("USD", "EUR", 0.5)]

    def test_many_bases_go_without_broadcast(self, spark):
        codes = [f"C{i:03d}" for i in range(80)]
        m = mart(spark, {c: [i + 1] for i, c in enumerate(codes)})
        out = detail.cross_pairs(m, [(c, "C000") for c in codes])
        assert out.count() == 79

    @pytest.mark.parametrize(
        "disparity, signal", [(0.35, "neutral"), (-0.35, "neutral"), (0.36, "hot"), (-0.36, "cold"), (None, "insufficient")]
    )
    def test_signal_edges(self, spark, disparity, signal):
        got = spark.range(1).select(detail._signal(F.lit(disparity).cast("double"), 0.35, -0.35).alias("s")).first()["s"]
        assert got == signal

    def test_heatmap_keeps_selected_codes_without_data(self, spark):
        wide = detail.heatmap_wide(mart(spark, {"USD": [1, 2]}), ["EUR", "USD"])
        assert wide.columns == ["cur_unit", "2026-08-03", "2026-08-04"]
        assert sorted(tuple(r) for r in wide.collect()) == [("EUR", None, None), ("USD", None, 100.0)]
        assert detail.heatmap_labels(wide).columns == ["cur_unit", "08/03", "08/04"]


class TestRisk:
    def test_alert_grades(self, spark):
        rows = [(START, c, 1.0, v) for c, v in [("A", 0.5), ("B", 0.7), ("C", 1.0), ("D", -1.0), ("E", 0.49), ("F", None)]]
        m = spark.createDataFrame(rows, "result_date date, cur_unit string, rate double, change_pct double")
        graded = [(r["cur_unit"], r["grade"]) for r in risk.alerts(m).collect()]
        assert graded == [("C", "severe"), ("D", "severe"), ("B", "warning"), ("A", "caution")]
        assert risk.alerts(m, limit=2).count() == 2

    def test_alerts_compare_with_the_day_before_the_period(self, spark):
        assert risk.alerts(mart(spark, {"USD": [1, 2]}), 1).count() == 1

    def test_volatility_needs_two_changes(self, spark):
        assert risk.volatility(mart(spark, {"USD": [1, 2]}), ["USD"], None).collect() == []
        row = risk.volatility(mart(spark, {"USD": [1, 2, 4, 12]}), ["USD"], None).first()
        assert (row["vol"], row["band"]) == (912.9, "high")

    def test_correlation_of_a_constant_series_is_null(self, spark):
        m = mart(spark, {"USD": [1, 2, 3, 5], "EUR": [1, 1, 1, 1], "JPY(100)": [2, 4, 6, 10]})
        got = {(r["code_a"], r["code_b"]): r["corr"] for r in risk.correlation(m, ["USD", "EUR", "JPY(100)"], None).collect()}
        assert got["EUR", "USD"] is None and got["EUR", "EUR"] is None
        assert got["JPY(100)", "USD"] == pytest.approx(1.0)
        matrix = risk.correlation_matrix(m, ["USD", "JPY(100)"], None)
        assert matrix.columns == ["cur_unit", "USD", "JPY(100)"]
        assert matrix.count() == 2

    def test_correlation_uses_common_dates(self, spark):
        m = mart(spark, {"USD": [1, 2, 3, 5, 4], "EUR": [1, 2, 4, "absent", "absent"]})
        got = {(r["code_a"], r["code_b"]): r["n"] for r in risk.correlation(m, ["USD", "EUR"], None).collect()}
        assert got == {("USD", "USD"): 4, ("EUR", "EUR"): 2, ("EUR", "USD"): 2}

    def test_two_hundred_codes_over_a_thousand_dates(self, spark):
        day, code = F.expr("date_add(date'2020-01-01', cast(id div 200 as int))"), F.format_string("C%03d", F.col("id") % 200)
        change = F.when(F.hash("id") % 10 == 0, None).otherwise(F.randn(3))
        m = spark.range(200_000).select(day.alias("result_date"), code.alias("cur_unit"), change.alias("change_pct")).cache()
        codes = [f"C{i:03d}" for i in range(200)]
        got = risk.correlation(m, codes, None)
        small = risk.correlation(m, codes[:3], None)
        plans = [frame._jdf.queryExecution().optimizedPlan().toString() for frame in (got, small)]
        assert len(plans[0].splitlines()) == len(plans[1].splitlines())
        rows = got.toPandas()
        assert len(rows) == 200 * 201 // 2
        expected = m.toPandas().pivot(index="result_date", columns="cur_unit", values="change_pct")
        value, common = expected.corr(), expected.notna().astype(int)
        common = common.T @ common
        for a, b, n, corr in rows.sample(500, random_state=1)[["code_a", "code_b", "n", "corr"]].itertuples(index=False):
            assert a <= b and n == common.loc[a, b] and corr == pytest.approx(value.loc[a, b], abs=1e-12)
        m.unpersist()

    def test_codes_without_rows_keep_their_pairs(self, spark):
        m = mart(spark, {"USD": [1, 2, 5]})
        got = sorted(tuple(r) for r in risk.correlation(m, ["USD", "GONE"], None).collect())
        assert [(a, b, n) for a, b, n, _ in got] == [("GONE", "GONE", 0), ("GONE", "USD", 0), ("USD", "USD", 2)]
        assert [c is None for *_, c in got] == [True, True, False]

    def test_no_codes(self, spark):
        m = mart(spark, {"USD": [1]}).filter("false")
        assert risk.correlation(m).collect() == []


class TestOps:
    def test_missing_weekday(self, spark):
        p = spark.createDataFrame(
            [(date(2026, 8, 13), "USD", 1.0), (date(2026, 8, 17), "USD", 1.0)],
            "result_date date, cur_unit string, rate double",
        )
        assert [r["result_date"] for r in ops.missing_weekdays(p).collect()] == [date(2026, 8, 14)]

    def test_retired_code_is_a_shortfall(self, spark):
        p = panel(spark, {"USD": [1, 2], "EUR": [1, "absent"]})
        assert tuple(ops.completeness(p).first()) == (date(2026, 8, 4), 1, 2, 1)
        assert [r["status"] for r in ops.history(p).orderBy("result_date").collect()] == ["complete", "partial"]

    def test_latest_rows_are_renamed(self, spark):
        m = enrich(mart(spark, {"USD": [1, 2]}), panel(spark, {"USD": [1]}).withColumn("cur_nm", F.lit("Dollar")))
        rows = ops.latest_rows(m, 1)
        assert rows.columns == ["quote_date", "instrument", "base_rate", "previous_rate", "change_pct", "moving_average_5"]
        assert rows.first()["instrument"] == "USD(Dollar)"

    def test_status_without_updates(self, spark):
        m = mart(spark, {"USD": [1]}).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
        assert ops.ops(m).first()["status"] == "unknown"


class TestQuality:
    @pytest.mark.parametrize("days, failures", [(4, 0), (5, 1)])
    def test_stale_edge(self, spark, days, failures):
        p = panel(spark, {"USD": [1]})
        assert quality.stale(p, START + timedelta(days=days)).count() == failures

    def test_empty_table_is_stale(self, spark):
        assert quality.stale(panel(spark, {"USD": [1]}).filter("false"), START).count() == 1

    def test_gate_names_the_rules(self, spark):
        p = panel(spark, {"USD": [1, None]})
        with pytest.raises(quality.QualityError) as error:
            quality.gate({"not_null": quality.not_null(p, ["rate"]), "unique": quality.unique_key(p)})
        assert error.value.failures == {"not_null": 1}


class TestUpsert:
    def test_twice_is_once(self, spark):
        target, source = panel(spark, {"USD": [1, 2, 3]}), panel(spark, {"USD": [7], "EUR": [8]})
        once = upsert(target, source)
        assert sorted(once.collect()) == sorted(upsert(once, source).collect())
        assert sorted(r["rate"] for r in once.collect()) == [2.0, 3.0, 7.0, 8.0]

    def test_duplicate_source_is_refused(self, spark):
        p = panel(spark, {"USD": [1]})
        with pytest.raises(DuplicateKeys):
            guarded_upsert(p, p.union(p))


class TestText:
    def show(self, spark, *columns):
        return tuple(spark.range(1).select(*columns).first())

    def test_digits(self, spark):
        values = [9.99, 10.0, 99.9, 100.0, None, float("nan")]
        got = self.show(spark, *[text.digits(F.lit(v).cast("double")).alias(f"c{i}") for i, v in enumerate(values)])
        assert got == (4, 3, 3, 2, 2, 2)

    @pytest.mark.parametrize("value", [1234.5, 0.125, 2.675, -0.001, 0.0, 1005.005, 99999999.995, -1234567.891])
    @pytest.mark.parametrize("dec", [2, 3, 4])
    def test_numbers_format_as_python_does(self, spark, value, dec):
        got = self.show(spark, text.fmt_num(F.lit(value), F.lit(dec)), text.fmt_pct(F.lit(value)))
        assert got == (f"{value:,.{dec}f}", f"{value:+.2f}%")

    def test_absent_numbers(self, spark):
        none, nan = F.lit(None).cast("double"), F.lit(float("nan"))
        assert self.show(spark, text.fmt_num(none), text.fmt_pct(none), text.fmt_num(nan), text.fmt_pct(nan)) == ("-",) * 4

    def test_delta(self, spark):
        got = self.show(
            spark,
            text.delta_text(F.lit(1401.5), F.lit(1400.0), F.lit(0.1071), 2).alias("a"),
            text.delta_text(F.lit(1401.5), F.lit(None).cast("double"), F.lit(None).cast("double"), 2).alias("b"),
        )
        assert got == ("+1.50 (+0.11%)", None)

    @pytest.mark.parametrize(
        "age, expected",
        [
            (timedelta(seconds=-5), "0 minutes ago"),
            (timedelta(minutes=59, seconds=59), "59 minutes ago"),
            (timedelta(hours=1), "1 hours ago"),
            (timedelta(hours=23, minutes=59), "23 hours ago"),
            (timedelta(days=3, hours=5), "3 days ago"),
        ],
    )
    def test_age(self, spark, age, expected):
        as_of = datetime(2026, 8, 14, 12)
        since = F.lit(as_of - age).cast("timestamp_ntz")
        assert self.show(spark, text.age_text(since, F.lit(as_of).cast("timestamp_ntz"))) == (expected,)

    def test_unknown_age(self, spark):
        m = mart(spark, {"USD": [1]}).filter("false")
        assert ops.freshness(m, "2026-08-14 00:00:00").first()["age_text"] == "unknown"

    def test_labels(self, spark):
        got = self.show(
            spark,
            text.label(F.lit("USD"), F.lit("Dollar")),
            text.label(F.lit("USD"), F.lit("")),
            text.label(F.lit("USD"), F.lit(None).cast("string")),
        )
        assert got == ("USD(Dollar)", "USD", "USD")

    def test_quote_units(self, spark):
        jpy = F.lit("JPY(100)")
        assert self.show(spark, numeric.quote_unit(jpy), numeric.plain_code(jpy), numeric.quote_unit(F.lit("USD"))) == (100, "JPY", 1)

    def test_labelled_panel(self, spark):
        p = panel(spark, {"USD": [1]}).withColumn("cur_nm", F.lit("Dollar"))
        assert labelled(p).first()["cur_unit"] == "USD(Dollar)"


class TestWholeSelections:
    CODES = [f"C{i}" for i in range(10)]

    def test_ten_codes_give_ten_cards_and_all_pairs(self, spark):
        m = mart(spark, {c: [1 + i, 2 + i * i, 3, 5 - i % 3] for i, c in enumerate(self.CODES)})
        assert {r["cur_unit"] for r in overview.kpi(m, self.CODES).collect()} == set(self.CODES)
        assert risk.correlation(m, self.CODES, None).count() == 55
        assert len(risk.correlation_matrix(m, self.CODES, None).columns) == 11
        assert risk.correlation(m, self.CODES, None, k=7).count() == 28
        named = m.withColumn("cur_nm", F.lower("cur_unit"))
        assert overview.kpi_cards(named, self.CODES).count() == 10
        assert detail.cross_pairs(m, [(a, b) for a in self.CODES for b in self.CODES], True).count() == 90

    def test_alerts_history_and_rows_without_a_limit(self, spark):
        m = mart(spark, {c: [1 + j % 2 for j in range(50)] for c in self.CODES}).withColumn("cur_nm", F.lower("cur_unit"))
        assert risk.alert_table(m, None, limit=None).count() == risk.alerts(m, None, limit=None).count() == 490
        assert ops.history(m, None).count() == 50
        assert ops.latest_rows(m, None).count() == 500

    def test_results_for_people_are_named_and_sorted(self, spark):
        m = mart(spark, {"USD": [1, 2], "EUR": [1, 3], "CNH": [1, 2]}).withColumn("cur_nm", F.lower("cur_unit"))
        shown = display(overview.returns(m), m, F.desc("return_pct")).collect()
        assert [(r["cur_unit"], r["return_pct"]) for r in shown] == [("EUR(eur)", 200.0), ("CNH(cnh)", 100.0), ("USD(usd)", 100.0)]


class TestNearRows:
    def test_correction_reads_the_next_four_rows_of_a_sparse_code(self, spark):
        days = [START + timedelta(days=i) for i in (0, 40, 80, 120, 160, 200, 240)]
        rows = [(d, "USD", float(i + 1)) for i, d in enumerate(days)]
        before = spark.createDataFrame(rows, "result_date date, cur_unit string, rate double")
        after = before.withColumn("rate", F.when(F.col("result_date") == days[2], 50.0).otherwise(F.col("rate")))
        changed = after.filter(F.col("result_date") == days[2])
        stamp = "2026-08-14 00:00:00"
        assert sorted(mart_incremental(after, changed, mart_daily(before, stamp), stamp).collect()) == sorted(mart_daily(after, stamp).collect())
