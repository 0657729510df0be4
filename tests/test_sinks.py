"""Mart tables: fitting, merging, appending, repeating, and the SQL for a database."""

import datetime
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from ontime_spark.schemas import MARTS
from ontime_spark.operators import windows
from ontime_spark.sinks import database, files, manifest, marts, publish
from ontime_spark.sinks.conform import conform
from ontime_spark.sources import events as event_source
from ontime_spark.sources.marts import newest_rows, predictions_or_none, read_mart

TABLE = "airport_delay_agg"
SCHEMA = """window_start timestamp, window_end timestamp, origin string, avg_arr_delay double,
 total_flights long, cancellations long"""


def row(day, origin, delay, flights=1):
    start = datetime.datetime(2024, 12, day, 10, 0)
    return (start, start + datetime.timedelta(minutes=15), origin, delay, flights, 0)


def stored(spark, root, *columns):
    return sorted(map(tuple, read_mart(spark, TABLE, root, with_batch=True).select(*columns).collect()))


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "marts")


def frame(spark, *rows_):
    return spark.createDataFrame(list(rows_), SCHEMA)


def test_upsert_replaces_by_key_and_keeps_the_rest(spark, root):
    marts.upsert(frame(spark, row(1, "A", 1.0), row(1, "B", 2.0), row(2, "A", 3.0)), root, TABLE, 0)
    marts.upsert(frame(spark, row(1, "B", 9.005), row(3, "C", None)), root, TABLE, 1)
    assert stored(spark, root, "origin", "avg_arr_delay", "batch_id") == [
        ("A", Decimal("1.00"), 0),
        ("A", Decimal("3.00"), 0),
        ("B", Decimal("9.01"), 1),
        ("C", None, 1),
    ]


def test_upsert_touches_only_the_dates_in_the_batch(spark, root):
    marts.upsert(frame(spark, row(1, "A", 1.0), row(2, "A", 3.0)), root, TABLE, 0)
    before = {p.day: p.version for p in manifest.current(spark, f"{root}/{TABLE}").parts}
    marts.upsert(frame(spark, row(2, "B", 1.0)), root, TABLE, 1)
    after = {p.day: p.version for p in manifest.current(spark, f"{root}/{TABLE}").parts}
    assert after["2024-12-01"] == before["2024-12-01"] and after["2024-12-02"] != before["2024-12-02"]
    # Each date is written once: one folder a merge.
    assert len(files.names(spark, f"{root}/{TABLE}/data")) == 2


def test_repeated_batches_change_nothing(spark, root):
    batches = [frame(spark, row(1, "A", 1.0), row(2, "A", 3.0)), frame(spark, row(1, "A", 4.0))]
    for batch_id, batch in enumerate(batches):
        marts.upsert(batch, root, TABLE, batch_id)
    once = stored(spark, root, "window_start", "origin", "avg_arr_delay", "batch_id")
    marts.upsert(batches[1], root, TABLE, 1)
    assert stored(spark, root, "window_start", "origin", "avg_arr_delay", "batch_id") == once


def test_a_batch_that_died_is_not_there_and_can_be_repeated(spark, root, monkeypatch):
    marts.upsert(frame(spark, row(1, "A", 1.0), row(1, "B", 2.0)), root, TABLE, 0, run="r")
    before = stored(spark, root, "origin", "avg_arr_delay")

    def die(*_):
        raise RuntimeError("lost")

    whole = manifest.commit
    monkeypatch.setattr(manifest, "commit", die)
    batch = frame(spark, row(1, "B", 9.0))
    with pytest.raises(RuntimeError):
        marts.upsert(batch, root, TABLE, 1, run="r")
    assert stored(spark, root, "origin", "avg_arr_delay") == before
    monkeypatch.setattr(manifest, "commit", whole)
    for _ in range(2):
        marts.upsert(batch, root, TABLE, 1, run="r")
    assert stored(spark, root, "origin", "avg_arr_delay") == [("A", Decimal("1.00")), ("B", Decimal("9.00"))]
    # Nor does an older batch of the run come back.
    marts.upsert(frame(spark, row(1, "B", 2.0)), root, TABLE, 0, run="r")
    assert stored(spark, root, "origin", "avg_arr_delay")[1] == ("B", Decimal("9.00"))


def test_two_writers_at_once_both_count(spark, root, monkeypatch):
    marts.upsert(frame(spark, row(1, "A", 1.0)), root, TABLE, 0)
    whole, calls = manifest.commit, []

    def commit(spark_, path, entry):
        if not calls:
            calls.append(entry)
            marts.upsert(frame(spark, row(1, "C", 3.0)), root, TABLE, 7)  # another writer is faster
        return whole(spark_, path, entry)

    monkeypatch.setattr(manifest, "commit", commit)
    marts.upsert(frame(spark, row(1, "B", 2.0)), root, TABLE, 1)
    assert stored(spark, root, "origin") == [("A",), ("B",), ("C",)]


def test_a_reader_keeps_its_version(spark, root):
    marts.upsert(frame(spark, row(1, "A", 1.0)), root, TABLE, 0)
    reader = read_mart(spark, TABLE, root)
    marts.upsert(frame(spark, row(1, "A", 5.0)), root, TABLE, 1)
    assert reader.first()["avg_arr_delay"] == Decimal("1.00")
    assert read_mart(spark, TABLE, root, version=1).first()["avg_arr_delay"] == Decimal("1.00")
    assert read_mart(spark, TABLE, root).first()["avg_arr_delay"] == Decimal("5.00")
    with pytest.raises(FileNotFoundError):
        read_mart(spark, TABLE, root, version=9)


def test_the_log_and_its_folders_do_not_grow(spark, root, monkeypatch):
    monkeypatch.setattr(manifest, "KEPT_ENTRIES", 2)
    for batch_id in range(8):
        marts.upsert(frame(spark, row(1, "A", float(batch_id)), row(2 + batch_id % 2, "A", 0.0)), root, TABLE, batch_id)
    assert len(files.names(spark, f"{root}/{TABLE}/_log")) <= 4
    assert len(files.names(spark, f"{root}/{TABLE}/data")) <= 4
    assert stored(spark, root, "avg_arr_delay") == [(Decimal("0.00"),), (Decimal("0.00"),), (Decimal("7.00"),)]


def test_appended_folders_are_merged(spark, root, monkeypatch):
    monkeypatch.setattr(marts, "FAN_IN", 3)
    monkeypatch.setattr(manifest, "KEPT_ENTRIES", 1)
    for batch_id in range(14):
        marts.append_batch(predictions(spark, ("AA", str(batch_id), "A", "B", 1.0, 2.0, 3.0)), root, "flight_predictions", batch_id)
    path = f"{root}/flight_predictions"
    parts = manifest.current(spark, path).parts
    assert len(parts) <= 5 and sum(p.rows for p in parts) == 14
    assert len(files.names(spark, f"{path}/data")) <= 8
    kept = read_mart(spark, "flight_predictions", root, with_batch=True)
    assert sorted((int(r["flight_number"]), r["batch_id"]) for r in kept.collect()) == [(i, i) for i in range(14)]


def test_newest_rows_read_few_dates(spark, root):
    rows_ = [("AA", str(i), "A", "B", 1.0, 2.0, 3.0, datetime.datetime(2024, 1, 1 + i % 9, i)) for i in range(18)]
    schema = predictions(spark).schema.add("processed_at", "timestamp")
    marts.append_batch(spark.createDataFrame(rows_, schema), root, "flight_predictions")
    for k, days in ((1, 1), (2, 1), (3, 2), (100, 9)):
        found = newest_rows(spark, "flight_predictions", root, k)
        assert found.count() == 2 * days and len(found.inputFiles()) >= days
        assert {f.split("processed_at_date=")[1][:10] for f in found.inputFiles()} == {f"2024-01-{9 - i:02d}" for i in range(days)}
    marts.append_batch(spark.createDataFrame([("BB", "0", "A", "B", 1.0, 2.0, 3.0, None)], schema), root, "flight_predictions", 1)
    assert newest_rows(spark, "flight_predictions", root, 1).first()["carrier"] == "BB"  # no time sorts first


def test_sums_add_up_over_batches_and_ages(spark, root):
    start = datetime.datetime(2024, 12, 1, 10, 0)
    flights = [(start + datetime.timedelta(minutes=m), "AA" if m % 2 else None, float(m), m % 5 == 0) for m in range(40)]
    schema = "eventTime timestamp, carrier string, arrDelay double, cancelled boolean"
    zero = {d: F.lit(0.0) for d in ("depDelay", "weatherDelay", "carrierDelay")}
    whole = spark.createDataFrame(flights, schema).withColumns(zero)
    for batch_id, part in enumerate((3, 0, 2, 1)):
        rows_ = whole.where(F.minute("eventTime") % 4 == part)
        for _ in range(2):
            marts.add(windows.carrier_sums(rows_, "eventTime"), root, "carrier_delay_agg", windows.carrier_means, batch_id, "r")
    got = read_mart(spark, "carrier_delay_agg", root).drop("window_date")
    want = windows.carrier_delays(whole.where("carrier is not null"), "eventTime")
    assert sorted(map(tuple, got.collect())) == sorted(
        tuple(Decimal(f"{v:.2f}") if isinstance(v, float) else v for v in r) for r in want.collect()
    )
    marts.add(windows.carrier_sums(whole.limit(0), "eventTime"), root, "carrier_delay_agg", windows.carrier_means, 9, "r")


def test_dates_bound_what_is_read(spark, root):
    marts.upsert(frame(spark, *(row(d, "A", float(d)) for d in range(1, 9))), root, TABLE, 0)
    some = read_mart(spark, TABLE, root, since=datetime.date(2024, 12, 3), until=datetime.date(2024, 12, 5))
    assert sorted(float(r["avg_arr_delay"]) for r in some.collect()) == [3.0, 4.0]
    assert len(some.inputFiles()) == 2


def test_empty_batches_write_nothing(spark, root):
    assert marts.upsert(frame(spark), root, TABLE) is None
    assert marts.append_batch(predictions(spark), root, "flight_predictions") is None
    assert stored(spark, root, "origin") == []


def test_rows_a_mart_cannot_take(spark, root):
    batch = frame(
        spark,
        row(1, "A", 1.0),
        row(1, "A", 0.5),
        row(1, None, 2.0, 7),
        row(1, "ABCDEFGHIJK", 2.0),
        row(1, "B", 1e7),
        row(1, "C", float("nan")),
    )
    good, report = conform(batch, TABLE)
    assert [(r["origin"], r["avg_arr_delay"]) for r in good.collect()] == [("A", Decimal("0.50"))]
    found = sorted((r["fault"], r["rows"], r["total_flights"]) for r in report.collect())
    assert found == [
        ("duplicate key", 1, 1),
        ("null origin", 1, 7),
        ("value of avg_arr_delay", 1, 1),
        ("value of avg_arr_delay", 1, 1),
        ("value of origin", 1, 1),
    ]
    marts.write_report(report, root, TABLE, 0)
    marts.write_report(report, root, TABLE, 0)
    assert spark.read.parquet(f"{root}/{TABLE}_quarantine").count() == 5


@pytest.mark.parametrize("table", MARTS)
def test_marts_start_empty_with_their_types(spark, root, table):
    marts.create_mart(spark, root, table)
    marts.create_mart(spark, root, table)
    mart = read_mart(spark, table, root)
    assert mart.isEmpty()
    kinds = dict(mart.dtypes)
    for name, sql_type in MARTS[table].columns:
        expected = {"TIMESTAMP": "timestamp", "BIGINT": "bigint"}.get(
            sql_type, "string" if "CHAR" in sql_type else sql_type.lower().replace("numeric", "decimal")
        )
        assert kinds[name] == expected


def predictions(spark, *rows_):
    return spark.createDataFrame(
        list(rows_),
        """carrier string, flight_number string, origin string, dest string, dep_delay double,
        actual_delay double, predicted_delay double""",
    )


def test_appended_batches_are_there_once(spark, root):
    one, two = ("AA", "1", "A", "B", 1.0, 2.0, 3.0), ("DL", "2", "C", "D", 1.0, 2.0, 3.456)
    for batch_id, rows_ in ((0, [one]), (1, [one, two]), (1, [one, two])):
        marts.append_batch(predictions(spark, *rows_), root, "flight_predictions", batch_id)
    marts.append_batch(predictions(spark, two), root, "flight_predictions", 0, run="another")
    mart = read_mart(spark, "flight_predictions", root)
    assert sorted((r["carrier"], r["predicted_delay"]) for r in mart.collect()) == [
        ("AA", Decimal("3.00")),
        ("AA", Decimal("3.00")),
        ("DL", Decimal("3.46")),
        ("DL", Decimal("3.46")),
    ]
    assert mart.where("processed_at is null").isEmpty()


def test_no_predictions_yet(spark, root):
    assert predictions_or_none(spark, root=root).isEmpty()


def test_filter_by_date_prunes_partitions(spark, root):
    marts.upsert(frame(spark, row(1, "A", 1.0), row(2, "A", 3.0)), root, TABLE, 0)
    mart = read_mart(spark, TABLE, root).where("window_date = date '2024-12-02'")
    assert mart.count() == 1
    assert "PartitionFilters: [isnotnull(window_date" in (
        mart._jdf.queryExecution().executedPlan().toString()
    )


@pytest.fixture
def con():
    con = duckdb.connect()
    for table in MARTS:
        # DuckDB has no SERIAL; everything else is run as written.
        con.execute(database.create_table_statement(table).replace("id SERIAL PRIMARY KEY", "id INT"))
    return con


@pytest.mark.parametrize("table", [m.name for m in MARTS.values() if m.keys])
def test_upsert_statements_parse(con, table):
    con.execute(f"create table stage as select * from {table}")
    for statement in database.upsert_statements(table, "stage"):
        con.execute(statement)
    assert con.sql("select count(*) from information_schema.tables where table_name = 'stage'").fetchall() == [(0,)]


def test_upsert_statements_merge(con):
    table = "ml_feature_importance"
    con.execute(f"insert into {table} values ('a', 0.1), ('b', 0.2)")
    con.execute("create table stage as select * from (values ('b', 0.5), ('c', 0.3)) t(feature_name, importance)")
    for statement in database.upsert_statements(table, "stage"):
        con.execute(statement)
    found = con.sql(f"select * from {table} order by 1").fetchall()
    assert found == [("a", Decimal("0.100000")), ("b", Decimal("0.500000")), ("c", Decimal("0.300000"))]


def test_append_statements_add_a_batch_once(con):
    table = "flight_predictions"
    con.execute(database.batch_log_statement())
    for run, batch_id in (("x", 0), ("x", 0), ("x", 1), ("y", 0)):
        con.execute("create table stage as select 'AA' as carrier, 1.5 as predicted_delay")
        columns = ["carrier", "predicted_delay"]
        for statement in database.append_statements(table, "stage", columns, run, batch_id):
            con.execute(statement)
    assert con.sql(f"select count(*) from {table}").fetchall() == [(3,)]


def test_table_of_keys_alone_keeps_its_rows(monkeypatch):
    from ontime_spark.schemas import Mart

    monkeypatch.setitem(MARTS, "pairs", Mart("pairs", (("a", "BIGINT"), ("b", "BIGINT")), ("a", "b")))
    assert database.upsert_statements("pairs", "s")[0].endswith("ON CONFLICT (a, b) DO NOTHING")


def test_runs_that_are_no_names_are_refused():
    with pytest.raises(ValueError):
        database.staging_name(TABLE, "x; drop table y", 0)


def test_staging_tables_of_two_batches_differ():
    names = {database.staging_name(TABLE, run, batch) for run in ("x", "y") for batch in (1, 2)}
    assert len(names) == 4


def test_kafka_options():
    assert event_source.kafka_options("host:1", minPartitions="64") == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "flight-events",
        "startingOffsets": "earliest",
        "minPartitions": "64",
    }
    assert publish.kafka_options("host:1", "topic")["kafka.acks"] == "1"
    assert "topic" not in publish.kafka_options("host:1", None)


def test_file_topics_need_a_path(spark):
    with pytest.raises(ValueError):
        event_source.read_events(spark, "parquet")
    with pytest.raises(ValueError):
        publish.publish(spark.range(1), "parquet")
