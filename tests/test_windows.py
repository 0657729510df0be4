"""Windowed aggregates and the reports over them."""

import datetime

import pytest
from pyspark.sql import functions as F

from ontime_spark.functions import classify
from ontime_spark.functions.numeric import exact_tenths, round_half_up, rounded_mean
from ontime_spark.operators import sampling, windows
from ontime_spark.plans import catalog, dashboard, history
from ontime_spark.sources import testdata

SCHEMA = """eventTime timestamp_ntz, carrier string, origin string, arrDelay double, depDelay double,
 cancelled boolean, weatherDelay double, carrierDelay double, nasDelay double, securityDelay double,
 lateAircraftDelay double"""


def at(minute, second=0):
    return datetime.datetime(2024, 12, 2, 10, minute, second)


@pytest.fixture(scope="module")
def flights(spark):
    data = [
        (at(1), "AA", "JFK", 10.0, 1.0, False, 1.0, 2.0, 3.0, 4.0, 5.0),
        (at(4, 59), "AA", "JFK", 20.0, 2.0, None, None, None, None, None, None),
        (at(5), "AA", "JFK", None, None, True, None, None, None, None, None),
        (at(7), "DL", "ORD", -5.0, 0.0, False, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_tumbling_windows(flights):
    rows = windows.carrier_delays(flights, "eventTime").orderBy("window_start", "carrier").collect()
    assert [tuple(r) for r in rows] == [
        (at(0), at(5), "AA", 15.0, 1.5, 2, 0, 1.0, 2.0),
        (at(5), at(10), "AA", None, None, 1, 1, None, None),
        (at(5), at(10), "DL", -5.0, 0.0, 1, 0, 0.0, 0.0),
    ]


def test_cause_windows(flights):
    rows = windows.cause_delays(flights, "eventTime").orderBy("window_start").collect()
    assert [tuple(r) for r in rows] == [
        (at(0), at(5), 2.0, 1.0, 3.0, 4.0, 5.0),
        (at(5), at(10), 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_sliding_windows_by_brute_force(flights):
    rows = windows.airport_delays(flights, "eventTime").collect()
    got = {(r["window_start"], r["origin"]): tuple(r)[3:] for r in rows}
    source = flights.collect()
    want = {}
    for minute in range(-10, 10, 5):
        start = at(0) + datetime.timedelta(minutes=minute)
        end = start + datetime.timedelta(minutes=15)
        for origin in ("JFK", "ORD"):
            mine = [r for r in source if r["origin"] == origin and start <= r["eventTime"] < end]
            if mine:
                delays = [r["arrDelay"] for r in mine if r["arrDelay"] is not None]
                mean = sum(delays) / len(delays) if delays else None
                want[start, origin] = (mean, len(mine), sum(bool(r["cancelled"]) for r in mine))
    assert got == want


def test_every_flight_is_counted(spark, sf_dir):
    flights = testdata.flights(spark, sf_dir)
    total = flights.count()
    carriers = windows.carrier_delays(flights, "eventTime")
    airports = windows.airport_delays(flights, "eventTime")
    assert carriers.agg(F.sum("total_flights")).first()[0] == total
    assert airports.agg(F.sum("total_flights")).first()[0] == 3 * total
    assert carriers.agg(F.sum("cancellations")).first()[0] == flights.where("cancelled").count()
    by_route = history.delay_summary(flights, "origin", "dest")
    assert by_route.agg(F.sum("total_flights")).first()[0] == total


def test_flights_are_summed_before_they_are_copied_into_windows(spark, sf_dir):
    plan = windows.airport_delays(testdata.flights(spark, sf_dir), "eventTime")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Expand") < text.rindex("HashAggregate")  # printed from the top: later runs first
    assert text[text.index("Expand"):].count("Exchange") == 1


def test_reports_on_no_rows(flights):
    none = windows.carrier_delays(flights.where("false"), "eventTime")
    assert tuple(dashboard.kpi_stats(none).first()) == (0.0, 0, 0, 0)
    causes = dashboard.delay_causes(windows.cause_delays(flights.where("false"), "eventTime"))
    assert [tuple(r) for r in causes.collect()] == [
        ("Carrier", 0.0),
        ("Weather", 0.0),
        ("NAS", 0.0),
        ("Late Aircraft", 0.0),
    ]


def test_unknown_means_come_first_and_ties_go_by_name(spark):
    data = [("A", 1.0, 1), ("C", 5.0, 1), ("B", 5.0, 1), ("D", None, 1), ("E", -1.0, 1)]
    mart = spark.createDataFrame(data, "origin string, avg_arr_delay decimal(8,2), total_flights long"
                                 .replace("decimal(8,2)", "double"))
    assert [r["origin"] for r in dashboard.top_airports(mart, k=4).collect()] == ["D", "B", "C", "A"]
    board = dashboard.airport_leaderboard(mart).collect()
    assert [(r["rank"], r["medal"], r["origin"], r["bar_share"]) for r in board] == [
        (1, "gold", "D", 0.0),
        (2, "silver", "B", 100.0),
        (3, "bronze", "C", 100.0),
        (4, "", "A", 20.0),
        (5, "", "E", 0.0),
    ]


def test_weighted_means(spark):
    mart = spark.createDataFrame(
        [("A", 10.0, 1, 0), ("A", 20.0, 3, 1), ("A", None, 6, 0)],
        "carrier string, avg_arr_delay double, total_flights long, cancellations long",
    )
    assert tuple(dashboard.kpi_stats(mart).first()) == (15.0, 10, 1, 1)
    assert tuple(dashboard.kpi_stats(mart, weighted=True).first()) == (17.5, 10, 1, 1)


@pytest.mark.parametrize(
    "x, tenths",
    [(12.35, 12.3), (12.25, 12.3), (12.45, 12.4), (12.55, 12.6), (-12.25, -12.3), (0.04, 0.0), (0.0, 0.0),
     (99.95, 100.0), (1234567.85, 1234567.9)],
)
def test_tenths_of_the_binary_value(spark, x, tenths):
    frame = spark.createDataFrame([(x,)], "x double")
    assert frame.select(exact_tenths(F.col("x"))).first()[0] == tenths


def test_tenths_by_exact_arithmetic(spark):
    from decimal import ROUND_HALF_UP, Decimal

    values = [n / 100 for n in range(-3000, 3000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for x, got in frame.select("x", exact_tenths(F.col("x"))).collect():
        assert got == float(Decimal(x).quantize(Decimal("0.1"), ROUND_HALF_UP)), x


def test_rounding(spark):
    frame = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (float("nan"),)], "x double")
    found = [r[0] for r in frame.select(round_half_up(F.col("x"))).collect()]
    assert found == [1.01, 2.68, -1.01, None]
    assert frame.where("x is null").select(rounded_mean("x")).first()[0] is None


@pytest.mark.parametrize(
    "x, plain, tenths",
    [(12.5, "+12.5 min", "+12.5 min"), (10.0, "+10 min", "+10.0 min"), (-7.25, "-7.25 min", "-7.3 min"),
     (0.0, "0 min", "0.0 min"), (-0.04, "-0.04 min", "-0.0 min"), (100.0, "+100 min", "+100.0 min")],
)
def test_minutes_labels(spark, x, plain, tenths):
    frame = spark.createDataFrame([(x,)], "x double").select(F.col("x").cast("decimal(8,2)").alias("x"))
    labels = frame.select(
        classify.minutes_label(F.col("x")), classify.minutes_label_tenths(F.col("x"))
    ).first()
    assert tuple(labels) == (plain, tenths)


@pytest.mark.parametrize(
    "x, tag", [(20.01, "SEVERE"), (20.0, "MODERATE"), (10.0, "MINOR"), (0.0, "ON TIME"), (-1.0, "ON TIME"),
               (None, "ON TIME")]
)
def test_severity_tag(spark, x, tag):
    frame = spark.createDataFrame([(x,)], "x double")
    assert frame.select(classify.severity_tag(F.col("x"))).first()[0] == tag


@pytest.mark.parametrize(
    "actual, predicted, tag",
    [(0.0, 5.0, "ACCURATE"), (0.0, -5.01, "CLOSE"), (15.0, 0.0, "CLOSE"), (30.0, 0.0, "FAIR"),
     (30.5, 0.0, "OFF"), (None, 3.0, "ACCURATE")],
)
def test_accuracy_tag(spark, actual, predicted, tag):
    frame = spark.createDataFrame([(actual, predicted)], "a double, p double")
    assert frame.select(classify.accuracy_tag(F.col("a"), F.col("p"))).first()[0] == tag


def test_hash_choices_do_not_depend_on_partitions(spark):
    frame = spark.range(5000).withColumnRenamed("id", "event_id")
    first = {r[0] for r in sampling.hash_sample(frame.repartition(3), "event_id").collect()}
    again = {r[0] for r in sampling.hash_sample(frame.repartition(7), "event_id").collect()}
    assert first == again and 900 < len(first) < 1100
    split = sampling.hash_split(sampling.hash_sample(frame, "event_id"), "event_id")
    assert 0.75 < split.where("split = 'train'").count() / len(first) < 0.85


def test_random_split_is_a_partition(spark):
    train, test = sampling.random_split(spark.range(1000))
    assert sorted(r[0] for r in train.union(test).collect()) == list(range(1000))


def test_top_lists_need_no_full_sort(spark, sf_dir):
    plan = catalog.top_airports(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Sort " not in plan
