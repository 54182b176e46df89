"""Day gate, duplicates, slot order, weather alignment."""

import datetime

from pyspark.sql import functions as F

from flowmosaic.operators import align, quality
from flowmosaic.plans.days import day_others, raw_days
from flowmosaic.schema import GridSpec


def day(date, slots, copies=1):
    return [(date, s, 0, 0, 1.0, 2.0) for s in slots for _ in range(copies)]


def dates(frame):
    return {r["date"].strftime("%Y%m%d") for r in frame.select("date").distinct().collect()}


def gate_rows():
    return (
        day("20240101", range(1, 49))
        + day("20240102", range(1, 48))  # 47 slots
        + day("20240103", range(0, 49))  # slot 0 on top
        + day("20240104", range(1, 50))  # slot 49 on top
        + day("20240105", [*range(1, 49), 7])  # a slot twice
        + day("20240106", [1] * 48)  # 48 rows, one slot
    )


def test_gate_keeps_exactly_full_days(flow_rows):
    flow = flow_rows(gate_rows())
    assert dates(quality.complete_days(flow)) == {"20240101", "20240105"}
    assert dates(quality.complete_day_rows(flow)) == {"20240101", "20240105"}
    assert dates(quality.incomplete_day_rows(flow)) == {"20240102", "20240103", "20240104", "20240106"}
    assert quality.complete_day_rows(flow).count() == 48 + 49
    assert quality.complete_day_rows(flow).count() + quality.incomplete_day_rows(flow).count() == flow.count()
    report = {r["date"].day: (r["n_slots"], r["bad_rows"]) for r in quality.day_quality(flow).collect()}
    assert report == {1: (48, 0), 2: (47, 0), 3: (48, 1), 4: (48, 1), 5: (48, 0), 6: (1, 0)}


def test_gate_uses_as_many_bitmap_words_as_it_needs(flow_rows):
    rows = day("20240101", range(1, 97)) + day("20240102", [*range(1, 63), *range(64, 97)])
    assert dates(quality.complete_days(flow_rows(rows), slots=96)) == {"20240101"}


def test_null_slot_is_a_bad_row(flow_rows):
    rows = day("20240101", range(1, 49)) + [("20240101", None, 0, 0, 1.0, 1.0)]
    assert dates(quality.complete_days(flow_rows(rows))) == set()


def test_gate_can_read_cheaper_observations(flow_rows):
    flow = flow_rows(day("20240101", range(1, 49)) + day("20240102", range(1, 48)))
    assert dates(quality.complete_day_rows(flow, 48, flow.select("date", "slot"))) == {"20240101"}


def test_duplicates_are_reported_and_merged(flow_rows):
    rows = [("20240101", 1, 0, 0, 3.0, 1.0), ("20240101", 1, 0, 0, 2.0, 9.0), ("20240101", 1, 0, 1, 5.0, 5.0)]
    flow = flow_rows(rows)
    report = quality.duplicate_cells(flow).collect()
    assert [(r["grid_col"], r["copies"]) for r in report] == [(0, 2)]
    kept = {(r["grid_col"], r["inflow"], r["outflow"]) for r in quality.deduplicate_cells(flow).collect()}
    assert kept == {(0, 2.0, 9.0), (1, 5.0, 5.0)}


def test_slot_sequence(flow_rows):
    rows = quality.slot_sequence(flow_rows(day("20240101", [5, 2, 9, 2]))).collect()
    assert sorted((r["position"], r["slot"], r["next_slot"]) for r in rows) == [(1, 2, 5), (2, 5, 9), (3, 9, -1)]


def weather_of(spark, rows):
    raw = spark.createDataFrame(rows, "d STRING, slot INT, temperature DOUBLE, windspeed DOUBLE, weather_code INT")
    return raw.withColumn("date", F.to_date("d", "yyyyMMdd")).drop("d")


def test_weather_joins_by_key_not_by_position(spark, flow_rows):
    flow = flow_rows(day("20240101", [1, 2, 3]))
    weather = weather_of(spark, [("20240101", 3, 30.0, 3.0, 3), ("20240101", 1, 10.0, 1.0, 1), ("20240102", 2, 0.0, 0.0, 0)])
    got = {r["slot"]: (r["temperature"], r["has_weather"]) for r in align.align_weather(flow, weather).collect()}
    assert got == {1: (10.0, 1), 2: (None, 0), 3: (30.0, 1)}
    assert [r["slot"] for r in align.unmatched_slots(flow, weather).collect()] == [2]


def test_first_slot_attributes_with_missing_weather(spark, flow_rows):
    flow = flow_rows(day("20240101", [1, 2, 3]) + day("20240102", [4, 5]) + day("20240103", [1]))
    weather = weather_of(spark, [("20240101", 2, 20.0, 2.0, 2), ("20240101", 3, 30.0, 3.0, 3), ("20240102", 4, 40.0, 4.0, 4)])
    null = {r["date"].day: (r["first_slot"], r["temperature"]) for r in align.first_slot_attributes(flow, weather).collect()}
    assert null == {1: (1, None), 2: (4, 40.0), 3: (1, None)}
    later = {r["date"].day: (r["first_slot"], r["temperature"]) for r in align.first_slot_attributes(flow, weather, "next").collect()}
    assert later == {1: (2, 20.0), 2: (4, 40.0), 3: (1, None)}


def test_day_others_policies(spark):
    weather = weather_of(spark, [("20240101", 2, 20.0, 5.0, 16), ("20240102", 1, -30.0, 7.0, 0), ("20240103", 99, 1.0, 1.0, 1)])
    strict = {r["date"].day: r["others"] for r in day_others(weather, GridSpec()).collect()}
    assert set(strict) == {2} and strict[2] == [-3.0, 0.7, 1.0] + [0.0] * 16
    later = {r["date"].day: r["others"] for r in day_others(weather, GridSpec(), "next").collect()}
    assert set(later) == {1, 2} and later[1][:2] == [2.0, 0.5] and later[1][18] == 1.0


def test_null_and_repeated_readings_follow_one_rule(spark, flow_rows):
    flow = flow_rows(day("20240101", [1, 2, 3]))
    weather = weather_of(spark, [("20240101", 1, None, 2.0, 2), ("20240101", 2, 30.0, 3.0, 3), ("20240101", 2, 20.0, 9.0, 4)])
    for missing, slot, temperature in (("null", 1, None), ("next", 2, 20.0)):
        row = align.first_slot_attributes(flow, weather, missing).collect()
        assert [(r["first_slot"], r["temperature"]) for r in row] == [(slot, temperature)]
        others = [r["others"][0] for r in day_others(weather, GridSpec(), missing).collect()]
        assert others == ([] if temperature is None else [temperature / 10])


def test_raw_days_by_day_and_by_cell(spark, flow_rows):
    """Every day keeps its own values and every cell too."""
    spec = GridSpec(2, 2, 720)
    rows = [
        (d, s, r, c, 100.0 * (s + 10 * r + 100 * c) * w, 50.0)
        for d, w in (("20240105", 1), ("20240106", 2)) for s in (1, 2) for r in (0, 1) for c in (0, 1)
        if (r, c) != (1, 1)
    ]
    days = {r["date"]: r for r in raw_days(flow_rows(rows), weather_of(spark, [("20240105", 1, 10.0, 20.0, 4)]), spec).collect()}
    friday, saturday = days[datetime.date(2024, 1, 5)], days[datetime.date(2024, 1, 6)]
    assert (friday["label"], saturday["label"]) == (0, 1)
    assert friday["flow"] == [1.0, 0.5, 2.0, 0.5, 101.0, 0.5, 102.0, 0.5, 11.0, 0.5, 12.0, 0.5, 0.0, 0.0, 0.0, 0.0]
    assert saturday["flow"][0::2] == [2 * x for x in friday["flow"][0::2]]
    assert friday["others"][:2] == [1.0, 2.0] and saturday["others"] is None


def test_repeated_readings_do_not_multiply_flow(spark):
    flow = spark.sql("SELECT DATE'2024-03-01' AS date, s AS slot, s * 1.0 AS inflow FROM (SELECT explode(sequence(1, 5)) AS s)")
    weather = spark.sql("SELECT DATE'2024-03-01' AS date, s AS slot, t AS temperature FROM (SELECT explode(array(1, 1, 2)) AS s, 7.0 AS t) UNION ALL SELECT DATE'2024-03-01', 1, 3.0")
    got = align.align_weather(flow, weather).collect()
    assert len(got) == 5 and {r["slot"]: r["temperature"] for r in got if r["has_weather"]} == {1: 3, 2: 7}
