"""Lines to records, and what is derived from a record."""

import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import rows
from ontime_spark.functions import parsing
from ontime_spark.functions.messages import decode_events, encode_events
from ontime_spark.operators import records, sampling
from ontime_spark.schemas import CAUSE_DELAYS, RAW_COLUMNS
from ontime_spark.sources.raw_csv import drop_header, read_by_name, read_raw, stream_raw

LINES = {
    "valid": rows.line(rows.VALID),
    "cancelled": rows.line(rows.CANCELLED),
    "severe": rows.line(rows.SEVERE),
    "whitespace": rows.line(rows.WHITESPACE),
    "no_causes": rows.line(rows.NO_CAUSES),
    "malformed": "bad,data",
    "empty": "",
    "26 columns": rows.line(rows.VALID[:26]),
    "28 columns": rows.line([*rows.VALID, "more"]),
    "trailing comma": rows.line(rows.VALID) + ",",
    "bad month": rows.line(rows.VALID, flightDate="13/2/2024 12:00:00 AM"),
    "day 30 of February": rows.line(rows.VALID, flightDate="2/30/2024 12:00:00 AM"),
    "day 32": rows.line(rows.VALID, flightDate="1/32/2024 12:00:00 AM"),
    "date only": rows.line(rows.VALID, flightDate="12/2/2024"),
    "lower case am": rows.line(rows.VALID, flightDate="12/2/2024 12:00:00 am"),
    "doubled quotes": rows.line(rows.VALID).replace('"New York', '"New ""York""'),
    "backslash": rows.line(rows.VALID, originCity="New\\York, NY"),
    "backslash at the end": rows.line(rows.VALID, originCity="New York, NY\\"),
    "open quote": rows.line(rows.VALID) + '"',
    "tab padded": rows.line(rows.VALID, carrier="\tAA ", arrDelay="\t25.00"),
    "all quoted": ",".join(f'"{f}"' for f in rows.VALID),
    "empty carrier": rows.line(rows.VALID, carrier=""),
    "no distance": rows.line(rows.VALID, distance=""),
    "bad optional": rows.line(rows.VALID, depDelay="n/a", depTime="8:15"),
    "odd numbers": rows.line(rows.VALID, depDelay="1.5e1", arrDelay="NaN", weatherDelay="nan"),
    "infinite": rows.line(rows.VALID, depDelay="Infinity", arrDelay="inf"),
    "decimal month": rows.line(rows.VALID, month="12.00"),
}


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(list(LINES.items()), "name string, value string")


@pytest.fixture(scope="module")
def typed(lines):
    found = records.type_records(lines, keep=("name",)).collect()
    return {row["name"]: row for row in found}


GOOD = {
    "valid",
    "cancelled",
    "severe",
    "whitespace",
    "no_causes",
    "28 columns",
    "trailing comma",
    "day 30 of February",
    "doubled quotes",
    "backslash",
    "backslash at the end",
    "tab padded",
    "all quoted",
    "empty carrier",
    "bad optional",
    "odd numbers",
    "infinite",
}


@pytest.mark.parametrize("name", LINES)
def test_which_lines_are_records(typed, name):
    assert (typed[name]["fault"] is None) == (name in GOOD)


@pytest.mark.parametrize(
    "name, fault",
    [
        ("malformed", "columns"),
        ("empty", "columns"),
        ("26 columns", "columns"),
        ("open quote", "columns"),
        ("bad month", "flightDate"),
        ("day 32", "flightDate"),
        ("date only", "flightDate"),
        ("lower case am", "flightDate"),
        ("no distance", "distance"),
        ("decimal month", "month"),
    ],
)
def test_what_is_wrong(typed, name, fault):
    assert typed[name]["fault"] == fault


@pytest.mark.parametrize(
    "field, value",
    [
        ("carrier", "AA"),
        ("origin", "JFK"),
        ("dest", "LAX"),
        ("arrDelay", 25.0),
        ("depDelay", 15.0),
        ("cancelled", False),
        ("cancellationCode", None),
        ("distance", 2475.0),
        ("weatherDelay", 25.0),
        ("month", 12),
        ("dayOfWeek", 1),
        ("flightDate", datetime.date(2024, 12, 2)),
        ("originCity", "New York, NY"),
        ("crsDepTime", 800),
        ("depTime", 815),
        ("depDel15", 1),
        ("arrDel15", 1),
    ],
)
@pytest.mark.parametrize("name", ["valid", "all quoted", "tab padded", "28 columns", "trailing comma"])
def test_valid_row(typed, name, field, value):
    assert typed[name][field] == value


def test_cancelled_row(typed):
    row = typed["cancelled"]
    assert (row["cancelled"], row["cancellationCode"], row["depTime"]) == (True, "B", None)
    assert (row["depDelay"], row["arrDelay"], row["arrDel15"]) == (None, None, None)


def test_row_without_causes(typed):
    row = typed["no_causes"]
    assert [row[c] for c in CAUSE_DELAYS] == [None] * 5
    assert (row["depDelay"], row["arrDelay"]) == (-5.0, -10.0)


def test_padding_is_taken_off(typed):
    row = typed["whitespace"]
    assert (row["carrier"], row["originCity"], row["cancellationCode"]) == ("UA", "Boston, MA", None)
    assert (row["crsDepTime"], row["arrDelay"]) == (600, 10.0)


def test_odd_fields(typed):
    assert typed["doubled quotes"]["originCity"] == "New York, NY"
    assert typed["backslash"]["originCity"] == "New\\York, NY"
    assert typed["backslash at the end"]["originCity"] == "New York, NY\\"
    assert typed["day 30 of February"]["flightDate"] == datetime.date(2024, 2, 29)
    assert typed["empty carrier"]["carrier"] == ""
    assert (typed["bad optional"]["depDelay"], typed["bad optional"]["depTime"]) == (None, None)
    odd = typed["odd numbers"]
    assert odd["depDelay"] == 15.0
    assert odd["arrDelay"] != odd["arrDelay"]
    assert odd["weatherDelay"] is None
    assert (typed["infinite"]["depDelay"], typed["infinite"]["arrDelay"]) == (float("inf"), None)


def test_strict_whole_numbers_lose_the_flags(lines):
    row = records.parse_records(lines.where("name = 'valid'"), strict_int=True)[0].first()
    assert (row["depDel15"], row["arrDel15"], row["depTime"]) == (None, None, 815)


def test_good_and_quarantine_make_up_the_input(lines):
    seen = Observation()
    good, quarantine = records.parse_records(lines, observation=seen, keep=("name",))
    assert {r["name"] for r in good.collect()} == GOOD
    assert {r["name"] for r in quarantine.collect()} == set(LINES) - GOOD
    assert seen.get == {"published": len(GOOD), "skipped": len(LINES) - len(GOOD)}
    assert tuple(records.record_counts(records.type_records(lines)).first()) == (
        len(GOOD),
        len(LINES) - len(GOOD),
    )


def test_two_inputs_in_one_query(lines):
    first, rest = (records.parse_records(lines.where(c))[0] for c in ("name = 'valid'", "name <> 'valid'"))
    assert first.union(rest).count() == len(GOOD)


def test_lines_that_keep_arriving(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(f"{','.join(RAW_COLUMNS)}\n{LINES['valid']}\nbad,data\n")
    good, _ = records.parse_records(stream_raw(spark, str(folder), 1))
    running = (
        good.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    running.awaitTermination()
    assert [r["carrier"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["AA"]


@pytest.mark.parametrize(
    "text, fields",
    [
        ("a,b,,", ["a", "b", "", ""]),
        ("", [""]),
        ('"a,b",c', ["a,b", "c"]),
        ('a"b,c"d,e', ["ab,cd", "e"]),
        ('a,b",c', ["a,b", "c"]),
        ('"a""b,""c",d', ["ab,c", "d"]),
    ],
)
def test_split_line(spark, text, fields):
    frame = spark.createDataFrame([(text,)], "value string")
    assert frame.select(parsing.split_line(F.col("value"))).first()[0] == fields


def test_files_by_position_and_by_name(spark, tmp_path):
    header = ",".join(f'"{c}"' for c in RAW_COLUMNS)
    for name in ("valid", "cancelled"):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n{LINES[name]}\n")
    good, quarantine = records.parse_records(read_raw(spark, str(tmp_path)))
    assert sorted(r["carrier"] for r in good.collect()) == ["AA", "DL"]
    assert quarantine.isEmpty()
    by_name = read_by_name(spark, str(tmp_path))
    cleaned = records.clean_for_training(by_name).collect()
    assert [(r["carrier"], r["arrDelay"], r["dayOfWeek"]) for r in cleaned] == [("AA", 25.0, 1.0)]
    filled = records.fill_missing_delays(records.training_columns(by_name)).collect()
    assert sorted((r["carrier"], r["depDelay"], r["arrDelay"]) for r in filled if r["arrDelay"] is None) == [
        ("DL", 0.0, None)
    ]


def test_header_only_where_it_is_one(spark):
    texts = [",".join(RAW_COLUMNS), ",".join(RAW_COLUMNS) + ",", "LATE_AIRCRAFT_DELAY", LINES["valid"]]
    frame = drop_header(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert [r[0] for r in frame.collect()] == texts[2:]


def test_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, str(tmp_path / "none.csv"))


@pytest.mark.parametrize(
    "delay, category",
    [
        (-5.0, "OnTime"),
        (0.0, "OnTime"),
        (0.5, "Minor"),
        (1.0, "Minor"),
        (25.0, "Minor"),
        (29.0, "Minor"),
        (29.5, "Minor"),
        (30.0, "Major"),
        (45.0, "Major"),
        (120.0, "Major"),
        (121.0, "Severe"),
        (170.0, "Severe"),
        (None, "OnTime"),
        (float("nan"), "Severe"),
    ],
)
def test_delay_category(spark, delay, category):
    frame = spark.createDataFrame([(delay,)], "arrDelay double")
    assert records.add_delay_category(frame).first()["delayCategory"] == category


@pytest.mark.parametrize("flag, late", [(1, True), (0, False), (None, False)])
def test_is_delayed(spark, flag, late):
    frame = spark.createDataFrame([(flag,)], "arrDel15 int")
    assert records.add_is_delayed(frame).first()["isDelayed"] is late


@pytest.mark.parametrize(
    "causes, total",
    [
        ((10.0, 15.0, 5.0, 0.0, 0.0), 30.0),
        ((None,) * 5, 0.0),
        ((20.0, None, 10.0, None, None), 30.0),
        ((0.0, 170.0, 0.0, 0.0, 0.0), 170.0),
    ],
)
def test_total_cause_delay(spark, causes, total):
    schema = ", ".join(f"{c} double" for c in CAUSE_DELAYS)
    frame = spark.createDataFrame([causes], schema)
    assert records.add_total_cause_delay(frame).first()["totalCauseDelay"] == total


def test_messages(lines):
    good, _ = records.parse_records(lines, keep=("name",))
    messages = {r["name"]: r for r in encode_events(good, keep=("name",)).collect()}
    assert messages["valid"]["key"] == "AA-1234-2024-12-02"
    assert '"carrier":"AA"' in messages["valid"]["value"]
    assert '"origin":"JFK"' in messages["valid"]["value"]
    assert '"carrierDelay":0.0' in messages["cancelled"]["value"]
    kept = {r["name"]: r for r in encode_events(good, "keep", keep=("name",)).collect()}
    assert "carrierDelay" not in kept["cancelled"]["value"]


def test_messages_come_back(lines):
    good, _ = records.parse_records(lines, keep=("name",))
    back = decode_events(encode_events(good, keep=("name",)), keep=("name",)).collect()
    rows_by_name = {r["name"]: r for r in back}
    assert rows_by_name["backslash"]["originCity"] == "New\\York, NY"
    assert rows_by_name["valid"]["flightDate"] == "2024-12-02"
    assert rows_by_name["cancelled"]["arrDelay"] == 0.0
    assert rows_by_name["cancelled"]["cancelled"] is True


def test_unreadable_messages(spark):
    texts = ["not json", '{"carrier": "AA", "month": "x", "arrDelay": 5.0}', None]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    found = decode_events(frame).select("carrier", "month", "arrDelay").collect()
    assert [tuple(r) for r in found] == [(None, None, None), ("AA", None, 5.0), (None, None, None)]


def test_unknown_null_policy(spark):
    with pytest.raises(ValueError):
        encode_events(spark.range(1), "maybe")


def test_samples_and_splits_do_not_depend_on_layout(spark):
    rows = [(i % 7, None if i % 3 else "x", float(i % 2)) for i in range(500)]
    frame = spark.createDataFrame(rows, "a int, b string, c double")
    layouts = [frame.coalesce(1), frame.repartition(50), frame.orderBy(F.desc("a")).repartition(3, "b")]
    drawn = [sorted(map(str, sampling.bernoulli_sample(f, 0.3).collect())) for f in layouts]
    assert drawn[0] == drawn[1] == drawn[2] and 100 < len(drawn[0]) < 200
    parts = [[sorted(map(str, p.collect())) for p in sampling.random_split(f, (2, 1, 1))] for f in layouts]
    assert parts[0] == parts[1] == parts[2]
    assert sorted(sum(parts[0], [])) == sorted(map(str, frame.collect()))
    monkey = sampling.draw_number(spark.range(3).select(F.lit(1).alias("a")).limit(0))
    assert monkey.isEmpty()


def test_frequent_rows_are_unfolded_in_runs(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RUN_LENGTH", 7)
    frame = spark.range(100).select(F.lit("same").alias("a"))
    drawn = sampling.draw_number(frame).collect()
    assert len(drawn) == 100 and len({r["draw"] for r in drawn}) == 100
    monkeypatch.setattr(sampling, "RUN_LENGTH", 1000)
    assert sorted(drawn) == sorted(sampling.draw_number(frame).collect())
