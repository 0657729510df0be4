"""Streams against the same aggregates in batch, repeats, and scoring."""

import datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ontime_spark.functions.messages import decode_events, encode_events, judge_messages, stamp_processing_time
from ontime_spark.operators import windows
from ontime_spark.plans import catalog
from ontime_spark.schemas import MARTS
from ontime_spark.sinks import marts as mart_sink
from ontime_spark.sources import testdata
from ontime_spark.sources.events import read_events
from ontime_spark.sources.marts import read_mart
from ontime_spark.streaming import queries

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def topic(spark, sf_dir, tmp_path_factory):
    """Messages in four files, in time order, with some that are no JSON in the last."""
    path = str(tmp_path_factory.mktemp("topic") / "messages")
    flights = testdata.flights(spark, sf_dir)
    messages = encode_events(flights, keep=("eventTime",)).withColumn(
        "timestamp", F.col("eventTime").cast("timestamp")
    )
    for low, high in ((1, 8), (8, 16), (16, 24), (24, 32)):
        day = F.dayofmonth("timestamp")
        part = messages.where((day >= low) & (day < high)).drop("eventTime")
        if low == 24:
            part = part.withColumn(
                "value", F.when(F.dayofmonth("timestamp") == 29, "no json").otherwise(F.col("value"))
            )
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, topic, files_per_batch=1):
    messages = read_events(spark, "parquet", {"maxFilesPerTrigger": str(files_per_batch)}, topic)
    return decode_events(messages, keep=("timestamp",))


def finish(started):
    for query in started:
        query.awaitTermination()
        assert query.exception() is None
    return started


def rows(frame):
    return sorted(map(tuple, catalog.plain(frame).collect()), key=repr)


AGGREGATES = {
    "carrier_delay_agg": windows.carrier_delays,
    "airport_delay_agg": windows.airport_delays,
    "delay_cause_agg": windows.cause_delays,
}


@pytest.fixture(scope="module")
def finished(spark, topic, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    seen = []
    started = queries.start_aggregates(
        stream(spark, topic),
        root,
        f"{root}/checkpoints",
        time_col="timestamp",
        trigger=NOW,
        on_batch=lambda table, batch, n: seen.append((table, n)),
    )
    assert sorted(q.name for q in started) == ["airport_agg", "carrier_agg", "cause_agg"]
    finish(started)
    return root, seen


@pytest.mark.parametrize("table", AGGREGATES)
def test_stream_equals_batch(spark, topic, finished, table):
    root, seen = finished
    assert len({n for t, n in seen if t == table}) >= 4
    batch = decode_events(read_events(spark, "parquet", path=topic, stream=False), keep=("timestamp",))
    whole = AGGREGATES[table](batch, "timestamp")
    key = {"carrier_delay_agg": "carrier", "airport_delay_agg": "origin"}.get(table)
    if key:
        whole = whole.where(F.col(key).isNotNull())
    assert rows(read_mart(spark, table, root).select(*MARTS[table].names)) == rows(whole)


def test_unreadable_messages_are_counted_apart(spark, topic, finished):
    root, _ = finished
    bad = read_events(spark, "parquet", path=topic, stream=False).where("value = 'no json'").count()
    assert bad > 0
    report = spark.read.parquet(f"{root}/carrier_delay_agg_quarantine")
    last = report.groupBy("window_start").agg(F.max_by("total_flights", "batch_id").alias("n"))
    assert last.agg(F.sum("n")).first()[0] == bad
    assert {r[0] for r in report.select("fault").distinct().collect()} == {"null carrier"}


def test_a_stream_that_goes_on_starts_where_it_stopped(spark, topic, finished):
    root, seen = finished
    before, count = rows(read_mart(spark, "carrier_delay_agg", root)), len(seen)
    finish(
        queries.start_aggregates(
            stream(spark, topic),
            root,
            f"{root}/checkpoints",
            time_col="timestamp",
            trigger=NOW,
            on_batch=lambda table, batch, n: seen.append((table, n)),
        )
    )
    assert rows(read_mart(spark, "carrier_delay_agg", root)) == before
    assert len(seen) == count


def test_a_batch_that_fails_is_repeated_to_the_same_end(spark, topic, tmp_path, monkeypatch):
    root = str(tmp_path / "marts")
    table = "carrier_delay_agg"
    whole = mart_sink.manifest.commit
    calls = []

    def fail_once(spark_, path, entry):
        calls.append(path)
        if len(calls) == 3:
            raise RuntimeError("executor lost")
        return whole(spark_, path, entry)

    def run():
        return queries.start_aggregates(
            stream(spark, topic), root, f"{root}/checkpoints", time_col="timestamp", trigger=NOW, only=[table]
        )

    monkeypatch.setattr(mart_sink.manifest, "commit", fail_once)
    with pytest.raises(Exception, match="executor lost"):
        run()[0].awaitTermination()
    finish(run())
    batch = decode_events(read_events(spark, "parquet", path=topic, stream=False), keep=("timestamp",))
    expected = windows.carrier_delays(batch, "timestamp").where("carrier is not null")
    assert rows(read_mart(spark, table, root).drop("window_date")) == rows(expected)


def summed(spark, topic, root, files_per_batch=1):
    messages = read_events(spark, "parquet", {"maxFilesPerTrigger": str(files_per_batch)}, topic)
    return queries.start_marts(messages, root, f"{root}/checkpoints", "timestamp", NOW)


@pytest.mark.parametrize("fail_at", [None, 2, 6, 9])
def test_one_query_feeds_all_marts(spark, topic, tmp_path, monkeypatch, fail_at):
    """Also when it fails between two marts of a batch, and is started again by itself."""
    root = str(tmp_path / "marts")
    whole, calls, started = mart_sink.manifest.write, [], []

    def fail_once(*a):
        calls.append(a)
        if len(calls) == fail_at:
            raise RuntimeError("executor lost")
        whole(*a)

    monkeypatch.setattr(mart_sink.manifest, "write", fail_once)

    def start():
        started.append(summed(spark, topic, root))
        return [started[-1]]

    queries.run_queries(spark, start, restarts=1)
    assert len(started) == (1 if fail_at is None else 2)
    assert all("stateOperators" not in p or not p["stateOperators"] for p in started[-1].recentProgress)
    batch = decode_events(read_events(spark, "parquet", path=topic, stream=False), keep=("timestamp",))
    for table, aggregate in AGGREGATES.items():
        key = {"carrier_delay_agg": "carrier", "airport_delay_agg": "origin"}.get(table, "month")
        expected = aggregate(batch.where(F.col(key).isNotNull()), "timestamp")
        assert rows(read_mart(spark, table, root).drop("window_date")) == rows(expected)
    bad = read_events(spark, "parquet", path=topic, stream=False).where("value = 'no json'")
    aside = read_mart(spark, "message_quarantine", root)
    assert rows(aside.select("key", "value", "reason")) == rows(bad.select("key", "value", F.lit("no JSON")))


def test_a_failure_ends_the_others(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(mart_sink.manifest, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("disk full")))
    running = []

    def start():
        endless = spark.readStream.format("rate").load().writeStream.format("noop").queryName("endless").start()
        running.append(endless)
        return [endless, summed(spark, topic, str(tmp_path))]

    with pytest.raises(Exception, match="disk full"):
        queries.run_queries(spark, start, restarts=1)
    assert len(running) == 2 and not any(q.isActive for q in running)


def test_messages_are_judged(spark):
    rows_ = [("k", None), ("k", "no json"), ("k", "[1]"), ("k", '{"carrier": "AA", "origin": "X", "month": "May"}'),
             ("k", '{"origin": "X"}'), ("k", '{"carrier": "AA"}'), (None, '{"carrier": "AA", "origin": "X", "month": 5}')]
    frame = spark.createDataFrame(rows_, "key string, value string")
    got = [(r["fault"], r["message"]["value"], r["message"]["key"]) for r in judge_messages(frame).collect()]
    faults = ["no value", "no JSON", "no JSON", "field", "null carrier", "null origin", None]
    assert got == [(f, v, k) for f, (k, v) in zip(faults, rows_)]


def test_processing_time_state_is_dropped(spark, topic, tmp_path):
    """Windows of processing time leave the state by a watermark that is there by default."""
    events = stamp_processing_time(decode_events(read_events(spark, "parquet", path=topic)))
    running = queries.start_aggregates(events, str(tmp_path), f"{tmp_path}/c", trigger=NOW, only=["delay_cause_agg"])
    finish(running)
    assert "watermark" in running[0].lastProgress["eventTime"]


def test_processing_time_windows(spark, topic, tmp_path):
    root = str(tmp_path)
    messages = read_events(spark, "parquet", path=topic)
    events = stamp_processing_time(decode_events(messages))
    before = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    finish(queries.start_aggregates(events, root, f"{root}/checkpoints", trigger=NOW))
    for table, copies in (("carrier_delay_agg", 1), ("airport_delay_agg", 3)):
        mart = catalog.plain(read_mart(spark, table, root))
        total = mart.agg(F.sum("total_flights")).first()[0]
        good = read_events(spark, "parquet", path=topic, stream=False).where("value <> 'no json'").count()
        assert total == copies * good
        first = mart.agg(F.min("window_end")).first()[0]
        assert first > before


def test_watermark_keeps_what_is_in_order(spark, topic, tmp_path):
    root = str(tmp_path)
    finish(
        queries.start_aggregates(
            stream(spark, topic),
            root,
            f"{root}/checkpoints",
            time_col="timestamp",
            watermark="1 hour",
            trigger=NOW,
            only=["delay_cause_agg"],
        )
    )
    batch = decode_events(read_events(spark, "parquet", path=topic, stream=False), keep=("timestamp",))
    whole = windows.cause_delays(batch, "timestamp")
    assert rows(read_mart(spark, "delay_cause_agg", root).drop("window_date")) == rows(whole)


def test_scoring_keeps_the_first_rows_of_each_batch(spark, topic, tmp_path):
    root = str(tmp_path)
    running = queries.start_scoring(
        stream(spark, topic), catalog.fixed_model(), root, f"{root}/checkpoints", cap=5, trigger=NOW
    )
    finish([running])
    assert running.name == "ml_predictions"
    stored = read_mart(spark, "flight_predictions", root, with_batch=True)
    assert {r["count"] for r in stored.groupBy("batch_id").count().collect()} == {5}
    first = spark.read.parquet(topic).where(F.dayofmonth("timestamp") < 8)
    order = ("carrier", "flightNumber", "flightDate", "origin", "dest", "depDelay", "arrDelay")
    expected = decode_events(first).orderBy(*order).limit(5)
    got = stored.where("batch_id = 0")
    assert rows(got.select("carrier", "flight_number", "origin", "dest")) == rows(
        expected.select("carrier", F.col("flightNumber"), "origin", "dest")
    )
    wrong = got.where(F.abs(F.col("predicted_delay") - F.round(F.col("dep_delay") * 0.9 + 2, 2)) > 0.011)
    assert wrong.isEmpty()


def test_scoring_any_rows(spark, topic, tmp_path):
    root = str(tmp_path)
    finish(
        [
            queries.start_scoring(
                stream(spark, topic, 4), catalog.fixed_model(), root, f"{root}/c", cap=50, order=None, trigger=NOW
            )
        ]
    )
    assert read_mart(spark, "flight_predictions", root).count() == 50


def test_scored_rows_the_table_cannot_take_are_set_aside(spark, topic, tmp_path):
    root = str(tmp_path)
    long = stream(spark, topic, 4).withColumn(
        "flightNumber", F.when(F.col("carrier") == "CL", "much too long").otherwise(F.col("flightNumber"))
    )
    finish(
        [
            queries.start_scoring(
                long, catalog.fixed_model(), root, f"{root}/c", cap=None, trigger=NOW, quarantine=f"{root}/q"
            )
        ]
    )
    kept = read_mart(spark, "flight_predictions", root).count()
    apart = spark.read.parquet(f"{root}/q/flight_predictions_quarantine")
    assert {r[0] for r in apart.select("carrier").distinct().collect()} == {"CL"}
    assert kept + apart.count() == spark.read.parquet(topic).count()


def test_no_scoring_without_a_model(spark, topic, tmp_path):
    assert queries.start_scoring(stream(spark, topic), None, str(tmp_path), str(tmp_path)) is None


def test_runs_of_two_checkpoints_differ():
    assert queries.run_name("/a/c") == queries.run_name("/a/c") != queries.run_name("/b/c")


def test_fixed_model_is_a_pipeline():
    assert isinstance(catalog.fixed_model(), PipelineModel)


def test_a_large_span_of_days_is_several_files(spark, sf_dir, tmp_path, monkeypatch):
    """No task reads or writes a whole span; each span has the files that a batch takes."""
    monkeypatch.setattr(catalog, "MESSAGES_A_FILE", 10)
    messages, path = catalog.topic_messages(spark, sf_dir), str(tmp_path / "topic")
    files = catalog.files_needed(messages, [catalog.WEEKS])
    catalog.write_topic(messages, path, catalog.WEEKS[:2], files)
    written = spark.read.parquet(path)
    assert files > 1 and len(written.inputFiles()) == 2 * files
    assert written.count() == messages.where(catalog.of_days((1, 17))).count()
