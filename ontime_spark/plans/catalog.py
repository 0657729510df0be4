"""Every operator as a named query over the test tables.

Each takes a session and the tables' folder. :mod:`ontime_spark.plans.oracle` holds the same
queries in SQL.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.functions import classify, parsing
from ontime_spark.functions.messages import decode_events, encode_events, fill_delays
from ontime_spark.functions.numeric import round_half_up
from ontime_spark.ml import forest, training
from ontime_spark.operators import records, sampling, windows
from ontime_spark.plans import dashboard, history
from ontime_spark.schemas import MARTS, RAW_COLUMNS
from ontime_spark.session import scratch_path
from ontime_spark.sinks import manifest, marts
from ontime_spark.sinks.conform import conform
from ontime_spark.sources import raw_csv, testdata
from ontime_spark.sources.events import read_events
from ontime_spark.sources.marts import newest_rows, read_mart
from ontime_spark.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times without zone, as the checks compare them."""

    def column(name: str, kind: str) -> Column:
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        return F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else F.col(name)

    return df.select(*(column(name, kind) for name, kind in df.dtypes))


def published(spark: SparkSession, sf_dir: str, null_policy: str = "zero") -> DataFrame:
    """Records with their missing delays as a message carries them."""
    return fill_delays(testdata.flights(spark, sf_dir), null_policy)


# --- lines to records ---------------------------------------------------------------------------


@query
def parse_raw(spark, sf_dir):
    """All 27 fields back from lines of text."""
    lines = testdata.raw_lines(testdata.flights(spark, sf_dir), keep=("eventId",))
    return records.parse_records(lines, keep=("eventId",))[0]


@query
def parse_strict_int(spark, sf_dir):
    """The same by strict whole numbers: the 15-minute flags are lost."""
    lines = testdata.raw_lines(testdata.flights(spark, sf_dir), keep=("eventId",))
    good, _ = records.parse_records(lines, strict_int=True, keep=("eventId",))
    return records.add_is_delayed(good).select(
        "eventId", "depTime", "arrTime", "depDel15", "arrDel15", "isDelayed"
    )


def damaged_lines(flights: DataFrame) -> DataFrame:
    """Every line, one in several of them damaged, each kind in its own way."""
    lines = testdata.raw_lines(flights, keep=("eventId",))
    value, kind = F.col("value"), F.col("eventId") % 20
    date = r"\d+/\d+/\d{4} 12"
    return lines.select(
        F.when(kind == 1, F.regexp_replace(value, ",[^,]*$", ""))  # 26 fields
        .when(kind == 2, F.concat(value, F.lit(",more,")))  # 29 fields
        .when(kind == 3, F.regexp_replace(value, date, "13/1/2024 12"))  # no such month
        .when(kind == 4, F.regexp_replace(value, date, "2/30/2024 12"))  # last of February
        .when(kind == 5, "")
        .when(kind == 6, F.regexp_replace(value, ",0800,", ",08:00,"))
        .when(kind == 7, F.regexp_replace(value, '"City', '"The ""City""'))  # doubled quotes
        .when(kind == 8, F.concat(F.lit("\t "), F.regexp_replace(value, ",", " , ")))
        .when(kind == 9, F.regexp_replace(value, ",1100,", ',"1100",'))
        .when(kind == 10, F.concat(value, F.lit('"')))  # a quote that never closes
        .otherwise(value)
        .alias("value"),
        "eventId",
    )


@query
def parse_damaged(spark, sf_dir):
    """Good records among damaged lines."""
    lines = damaged_lines(testdata.flights(spark, sf_dir))
    good, _ = records.parse_records(lines, keep=("eventId",))
    return good.select("eventId", "flightDate", "originCity", "destCity", "crsArrTime", "arrDelay")


@query
def quarantine_rows(spark, sf_dir):
    """Lines set aside, with what is wrong with each."""
    lines = damaged_lines(testdata.flights(spark, sf_dir))
    _, quarantine = records.parse_records(lines, keep=("eventId",))
    return quarantine.select("eventId", "fault")


@query
def quarantine_counts(spark, sf_dir):
    lines = damaged_lines(testdata.flights(spark, sf_dir))
    return records.record_counts(records.type_records(lines))


@query
def field_parse(spark, sf_dir):
    """Doubles, whole numbers, flags and optional text from padded, empty and odd texts."""
    events = testdata.events(spark, sf_dir)
    number, kind = F.col("value").cast("decimal(18,2)").cast("string"), F.col("event_id") % 8
    text = (
        F.when(kind == 0, "")
        .when(kind == 1, F.concat(F.lit(" \t"), number, F.lit("  ")))
        .when(kind == 2, F.concat(number, F.lit("x")))
        .when(kind == 3, F.concat(F.lit("+"), F.col("user_id").cast("string")))
        .when(kind == 4, F.concat(F.lit(" 00"), F.col("user_id").cast("string"), F.lit(" ")))
        .when(kind == 5, "1.00")
        .when(kind == 6, F.concat(number, F.lit("e2")))
        .otherwise("1")
    )
    rows = events.select("event_id", text.alias("text"))
    return rows.select(
        "event_id",
        parsing.parse_double(F.col("text")).alias("as_double"),
        parsing.parse_int(F.col("text")).alias("as_int"),
        parsing.parse_int(F.col("text"), strict=False).alias("as_lenient_int"),
        parsing.parse_flag(F.col("text")).alias("as_flag"),
        parsing.optional_text(F.col("text")).alias("as_text"),
    )


@query
def date_parse(spark, sf_dir):
    """Dates, with days that their month lacks and days that no month has."""
    events = testdata.events(spark, sf_dir)
    month, day = F.col("event_id") % 13 + 1, F.dayofmonth("ts") + F.col("event_id") % 4
    text = F.format_string("%d/%d/2024 %02d:30:00 %s", month, day, F.col("user_id") % 12 + 1,
                           F.when(F.col("user_id") % 2 == 0, "AM").otherwise("PM"))
    return events.select("event_id", parsing.parse_flight_date(text).alias("flight_date"))


def written_file(spark: SparkSession, sf_dir: str) -> str:
    """The records as a folder of files with headers."""
    path = scratch_path(spark, "raw-csv")
    raw = testdata.raw_columns(testdata.flights(spark, sf_dir))
    raw.write.option("header", True).option("emptyValue", "").csv(path)
    return path


@query
def csv_by_position(spark, sf_dir):
    """Files read by position."""
    good, _ = records.parse_records(raw_csv.read_raw(spark, written_file(spark, sf_dir)))
    return good


@query
def csv_by_name(spark, sf_dir):
    """Files read by header name, as training rows."""
    return records.clean_for_training(raw_csv.read_by_name(spark, written_file(spark, sf_dir)))


@query
def csv_by_name_mixed(spark, sf_dir):
    """Files whose headers are in two orders, and some that lack columns nobody reads."""
    path = scratch_path(spark, "mixed-csv")
    raw = testdata.raw_columns(testdata.flights(spark, sf_dir), keep=("eventId",))
    unread = ("DEST_STATE_ABR", "TAXI")
    orders = [list(RAW_COLUMNS), list(RAW_COLUMNS)[::-1], [c for c in RAW_COLUMNS if c not in unread]]
    for i, names in enumerate(orders):
        part = raw.where(F.col("eventId") % len(orders) == i).select(*names)
        part.write.mode("append").option("header", True).option("emptyValue", "").csv(path)
    return records.clean_for_training(raw_csv.read_by_name(spark, path))


# --- rows derived from records ------------------------------------------------------------------


@query
def delay_category(spark, sf_dir):
    flights = records.add_delay_category(testdata.flights(spark, sf_dir))
    return flights.select("eventId", "delayCategory")


@query
def is_delayed(spark, sf_dir):
    return records.add_is_delayed(testdata.flights(spark, sf_dir)).select("eventId", "isDelayed")


@query
def total_cause_delay(spark, sf_dir):
    flights = records.add_total_cause_delay(testdata.flights(spark, sf_dir))
    return flights.select("eventId", "totalCauseDelay")


@query
def clean_for_ml(spark, sf_dir):
    return records.clean_for_training(testdata.flights(spark, sf_dir), keep=("eventId",))


@query
def json_props(spark, sf_dir):
    """A field out of JSON text, by schema."""
    events = testdata.events(spark, sf_dir)
    return events.select("event_id", F.from_json("props", "k int").alias("data")).select(
        "event_id", "data.*"
    )


@query
def message_key(spark, sf_dir):
    flights = testdata.flights(spark, sf_dir)
    return encode_events(flights, keep=("eventId",)).select("eventId", "key")


@query
def event_json_roundtrip(spark, sf_dir):
    """Records as messages and back; missing delays come back as zero."""
    messages = encode_events(testdata.flights(spark, sf_dir), keep=("eventId",))
    return decode_events(messages, keep=("eventId",))


@query
def event_json_nulls_kept(spark, sf_dir):
    messages = encode_events(testdata.flights(spark, sf_dir), "keep", keep=("eventId",))
    return decode_events(messages, keep=("eventId",))


@query
def severity_tag(spark, sf_dir):
    return testdata.flights(spark, sf_dir).select(
        "eventId",
        classify.severity_tag(F.col("arrDelay")).alias("severity"),
        classify.severity_colour(F.col("arrDelay")).alias("colour"),
    )


# --- windowed aggregates ------------------------------------------------------------------------


@query
def carrier_tumbling(spark, sf_dir):
    return windows.carrier_delays(published(spark, sf_dir), "eventTime")


@query
def airport_sliding(spark, sf_dir):
    return windows.airport_delays(published(spark, sf_dir), "eventTime")


@query
def airport_sliding_uneven(spark, sf_dir):
    """Windows that are no multiple of their slide."""
    return windows.airport_delays(published(spark, sf_dir), "eventTime", "15 minutes", "10 minutes")


@query
def cause_tumbling(spark, sf_dir):
    return windows.cause_delays(published(spark, sf_dir), "eventTime")


@query
def carrier_tumbling_nulls_kept(spark, sf_dir):
    return windows.carrier_delays(published(spark, sf_dir, "keep"), "eventTime")


@query
def airport_sliding_nulls_kept(spark, sf_dir):
    return windows.airport_delays(published(spark, sf_dir, "keep"), "eventTime")


@query
def cause_tumbling_nulls_kept(spark, sf_dir):
    return windows.cause_delays(published(spark, sf_dir, "keep"), "eventTime")


@query
def batch_delay_summary(spark, sf_dir):
    """Per carrier, over all time."""
    return history.delay_summary(testdata.flights(spark, sf_dir), "carrier")


@query
def batch_route_summary(spark, sf_dir):
    """Per route and day."""
    flights = testdata.flights(spark, sf_dir)
    return history.delay_summary(flights, "origin", "dest", "flightDate")


# --- marts and the dashboard --------------------------------------------------------------------


def carrier_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(carrier_tumbling(spark, sf_dir), "carrier_delay_agg", unique=True)[0]


def airport_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(airport_sliding(spark, sf_dir), "airport_delay_agg", unique=True)[0]


def cause_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(cause_tumbling(spark, sf_dir), "delay_cause_agg", unique=True)[0]


@query
def kpi_stats(spark, sf_dir):
    return dashboard.kpi_stats(carrier_mart(spark, sf_dir))


@query
def kpi_stats_weighted(spark, sf_dir):
    return dashboard.kpi_stats(carrier_mart(spark, sf_dir), weighted=True)


@query
def top_carriers(spark, sf_dir):
    return dashboard.top_carriers(carrier_mart(spark, sf_dir))


@query
def top_carriers_weighted(spark, sf_dir):
    return dashboard.top_carriers(carrier_mart(spark, sf_dir), weighted=True)


@query
def top_airports(spark, sf_dir):
    return dashboard.top_airports(airport_mart(spark, sf_dir))


@query
def top_airports_weighted(spark, sf_dir):
    return dashboard.top_airports(airport_mart(spark, sf_dir), weighted=True)


@query
def top_airports_corrected(spark, sf_dir):
    """Each flight counted once, though it is in three windows."""
    return dashboard.top_airports(airport_mart(spark, sf_dir), overlap=3)


@query
def delay_causes_long(spark, sf_dir):
    return dashboard.delay_causes(cause_mart(spark, sf_dir))


@query
def airport_leaderboard(spark, sf_dir):
    return dashboard.airport_leaderboard(airport_mart(spark, sf_dir))


@query
def airport_count(spark, sf_dir):
    return dashboard.airport_count(airport_mart(spark, sf_dir))


def fixed_prediction() -> Column:
    """Stands in for the forest where SQL has to give the same number."""
    return F.col("depDelay") * 0.9 + 2


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predictions table, each row written at its event's time."""
    scored = published(spark, sf_dir).withColumn("prediction", fixed_prediction())
    rows = forest.prediction_rows(scored, "eventTime").withColumnRenamed("eventTime", "processed_at")
    return conform(rows, "flight_predictions")[0]


@query
def accuracy_tag(spark, sf_dir):
    return testdata.flights(spark, sf_dir).select(
        "eventId", classify.accuracy_tag(F.col("arrDelay"), fixed_prediction()).alias("accuracy")
    )


@query
def latest_predictions(spark, sf_dir):
    return plain(dashboard.latest_predictions(predictions(spark, sf_dir)))


@query
def prediction_board(spark, sf_dir):
    return plain(dashboard.prediction_board(predictions(spark, sf_dir)))


@query
def prediction_labels(spark, sf_dir):
    """The board's texts for every prediction, not just the newest."""
    c = F.col
    return predictions(spark, sf_dir).select(
        classify.flight_label(c("carrier"), c("flight_number")).alias("flight"),
        classify.route_label(c("origin"), c("dest")).alias("route"),
        classify.minutes_label(c("actual_delay")).alias("actual"),
        classify.late_flag(c("actual_delay")).alias("actual_late"),
        classify.minutes_label_tenths(c("predicted_delay")).alias("predicted"),
    )


@query
def batch_cap(spark, sf_dir):
    """The first 50 rows of a batch in the scoring order."""
    scored = published(spark, sf_dir).withColumn("prediction", fixed_prediction())
    order = (*streams.SCORING_ORDER, "eventId")
    return forest.prediction_rows(sampling.cap_rows(scored, 50, order), "eventId")


def partly_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier aggregates of a topic in which the messages of cancelled flights are broken."""
    messages = encode_events(testdata.flights(spark, sf_dir), keep=("eventTime", "cancelled"))
    broken = F.when(F.col("cancelled"), F.concat(F.lit("#"), F.col("value")))
    messages = messages.withColumn("value", F.coalesce(broken, F.col("value"))).drop("cancelled")
    return windows.carrier_delays(decode_events(messages, keep=("eventTime",)), "eventTime")


@query
def mart_conform(spark, sf_dir):
    """Rows the carrier mart takes."""
    return plain(conform(partly_unreadable(spark, sf_dir), "carrier_delay_agg")[0])


@query
def mart_quarantine(spark, sf_dir):
    """Rows it does not take: messages that could not be read, counted per window."""
    report = conform(partly_unreadable(spark, sf_dir), "carrier_delay_agg")[1]
    return plain(report.select("window_start", "total_flights", "fault", "rows"))


@query
def mart_upsert(spark, sf_dir):
    """All windows, then a second batch with new figures for those from mid-month on."""
    root = scratch_path(spark, "mart-upsert")
    table = "carrier_delay_agg"
    later = F.col("eventTime") >= F.lit("2024-01-15").cast("timestamp_ntz")
    first = windows.carrier_delays(published(spark, sf_dir), "eventTime")
    second = windows.carrier_delays(published(spark, sf_dir, "keep").where(later), "eventTime")
    marts.upsert(first, root, table, batch_id=0)
    marts.upsert(second, root, table, batch_id=1)
    return plain(read_mart(spark, table, root, with_batch=True).drop("window_date"))


@query
def append_by_batch(spark, sf_dir):
    """Two batches appended, the second of them twice: it is there once."""
    root = scratch_path(spark, "append-by-batch")
    rows = predictions(spark, sf_dir)
    for batch_id in (0, 1, 1):
        marts.append_batch(rows, root, "flight_predictions", batch_id)
    stored = read_mart(spark, "flight_predictions", root, with_batch=True)
    return plain(stored.drop("run"))


@query
def upsert_after_crash(spark, sf_dir):
    """As mart_upsert, but a writer of the second batch died before its entry, and the batch is repeated."""
    root, table = scratch_path(spark, "upsert-after-crash"), "carrier_delay_agg"
    later = F.col("eventTime") >= F.lit("2024-01-15").cast("timestamp_ntz")
    first = windows.carrier_delays(published(spark, sf_dir), "eventTime")
    second = windows.carrier_delays(published(spark, sf_dir, "keep").where(later), "eventTime")
    marts.upsert(first, root, table, batch_id=0, run="night")
    lost = read_mart(spark, table, root, with_batch=True).withColumn("total_flights", F.lit(-1))
    manifest.write(lost, f"{root}/{table}", manifest.new_version(), "window_date")
    for batch_id in (1, 1, 0):
        marts.upsert(second, root, table, batch_id, run="night")
    return plain(read_mart(spark, table, root, with_batch=True).drop("window_date"))


@query
def append_new_checkpoint(spark, sf_dir):
    """Batches of two runs, whose numbers are alike, some of them repeated; and enough to merge their files."""
    root, table = scratch_path(spark, "append-new-checkpoint"), "flight_predictions"
    rows = predictions(spark, sf_dir)
    for run, batches in (("first", (0, 1, 1, 2, 3, 4)), ("second", (0, 0, 1, 2, 3))):
        for batch_id in batches:
            part = rows.where(F.col("flight_number").cast("int") % 5 == batch_id)
            marts.append_batch(part, root, table, batch_id, run)
    return plain(read_mart(spark, table, root, with_batch=True))


@query
def latest_predictions_pruned(spark, sf_dir):
    """The newest predictions out of a stored table, from the newest dates that hold enough of them."""
    root = scratch_path(spark, "latest-pruned")
    marts.append_batch(predictions(spark, sf_dir), root, "flight_predictions")
    return plain(dashboard.latest_predictions(newest_rows(spark, "flight_predictions", root, 20)))


def summed_mart(spark: SparkSession, sf_dir: str, table: str) -> str:
    """A mart added up from three batches that all hold rows of every date, one of them given twice."""
    root = scratch_path(spark, "summed-marts")
    flights = published(spark, sf_dir)
    sums, means = next((s, m) for name, s, m in streams.SUMMED if name == table)
    for batch_id in (0, 1, 1, 2):
        part = flights.where(F.col("eventId") % 3 == batch_id)
        marts.add(sums(part, "eventTime"), root, table, means, batch_id, "summed")
    return root


@query
def carrier_summed(spark, sf_dir):
    """Carrier windows whose flights came in three batches, one of them twice."""
    return plain(read_mart(spark, "carrier_delay_agg", summed_mart(spark, sf_dir, "carrier_delay_agg")).drop("window_date"))


@query
def airport_summed(spark, sf_dir):
    return plain(read_mart(spark, "airport_delay_agg", summed_mart(spark, sf_dir, "airport_delay_agg")).drop("window_date"))


SINCE, UNTIL = datetime.date(2024, 1, 10), datetime.date(2024, 1, 20)


@query
def kpi_stats_range(spark, sf_dir):
    """Exact totals of a range of dates, out of the sums of its windows; other dates are not read."""
    root = summed_mart(spark, sf_dir, "carrier_delay_agg")
    mart = read_mart(spark, "carrier_delay_agg", root, with_sums=True, since=SINCE, until=UNTIL)
    return dashboard.kpi_totals(mart)


@query
def top_carriers_range(spark, sf_dir):
    root = summed_mart(spark, sf_dir, "carrier_delay_agg")
    mart = read_mart(spark, "carrier_delay_agg", root, with_sums=True, since=SINCE, until=UNTIL)
    return dashboard.top_totals(mart, "carrier")


# --- samples and the model ----------------------------------------------------------------------


@query
def hash_sample(spark, sf_dir):
    return sampling.hash_sample(testdata.events(spark, sf_dir), "event_id", 20).select("event_id")


@query
def hash_split(spark, sf_dir):
    return sampling.hash_split(testdata.events(spark, sf_dir), "event_id").select(
        "event_id", "split"
    )


@query
def bernoulli_sample(spark, sf_dir):
    return sampling.bernoulli_sample(testdata.events(spark, sf_dir).select("event_id"))


@query
def sample_with_repeats(spark, sf_dir):
    """A sample of rows that are mostly there several times: each is drawn for itself."""
    rows = testdata.events(spark, sf_dir).select("event_type", (F.col("user_id") % 5).alias("who"))
    return sampling.bernoulli_sample(rows.withColumn("who", F.when(F.col("who") > 0, F.col("who"))))


@query
def random_split(spark, sf_dir):
    parts = sampling.random_split(testdata.events(spark, sf_dir).select("event_id"))
    train, test = (part.withColumn("split", F.lit(n)) for part, n in zip(parts, ("train", "test")))
    return train.unionByName(test)


@query
def training_counts(spark, sf_dir):
    """Rows cleaned, sampled, trained on and tested, drawn by the hash of the key."""
    counts = training.draw_sample(testdata.flights(spark, sf_dir), key="eventId").counts
    return spark.createDataFrame([counts], "cleaned long, sampled long, train long, test long")


@query
def string_index(spark, sf_dir):
    """Carrier, origin and destination numbered by frequency."""
    rows = clean_for_ml(spark, sf_dir)
    indexer = forest.feature_stages()[0]
    return indexer.fit(rows).transform(rows).select("eventId", *indexer.getOutputCols())


@query
def feature_vector(spark, sf_dir):
    rows = clean_for_ml(spark, sf_dir)
    features = Pipeline(stages=forest.feature_stages()).fit(rows)
    return forest.feature_columns(rows, features, "eventId")


@query
def regression_metrics(spark, sf_dir):
    rows = clean_for_ml(spark, sf_dir).withColumn("prediction", fixed_prediction())
    metrics = forest.regression_metrics(rows)
    return metrics.select("rows", *(round_half_up(F.col(c), 4).alias(c) for c in ("mae", "rmse", "r2")))


_TRAINED: dict[tuple[str, str], training.Training] = {}


def published_training(spark: SparkSession, sf_dir: str) -> training.Training:
    """The forest with its published settings, trained once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        flights = testdata.flights(spark, sf_dir)
        _TRAINED[key] = training.train(flights, forest.build_pipeline(), key="eventId")
    return _TRAINED[key]


@query
def rf_predictions(spark, sf_dir):
    done = published_training(spark, sf_dir)
    return done.predictions.select("eventId", "carrier", "origin", "dest", "arrDelay", "prediction")


@query
def rf_importance(spark, sf_dir):
    return published_training(spark, sf_dir).importance


@query
def rf_metrics(spark, sf_dir):
    return plain(training.result_row(published_training(spark, sf_dir)))


def carrier_tree(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PipelineModel, DataFrame]:
    """Training rows, a single tree over carrier and month that has seen them all, and its nodes."""
    rows = clean_for_ml(spark, sf_dir)
    pipeline = forest.build_pipeline(("carrier",), ("month",), trees=1, depth=8, bins=64, bootstrap=False)
    model = pipeline.fit(training.laid_out(rows, rows.count()))
    return rows, model, forest.node_table(spark, model, scratch_path(spark, "carrier-tree"))


def mean_of(column: Column | str) -> Column:
    return round_half_up(F.col(column) if isinstance(column, str) else column, 6)


@query
def tree_means(spark, sf_dir):
    """A tree's prediction for every row: the mean of the row's leaf."""
    rows, model, _ = carrier_tree(spark, sf_dir)
    return forest.score(rows, model).select("eventId", mean_of("prediction").alias("prediction"))


@query
def tree_by_nodes(spark, sf_dir):
    """The same from the tree's nodes, as conditions on columns."""
    rows, model, nodes = carrier_tree(spark, sf_dir)
    return forest.score_by_nodes(rows, model, nodes).select("eventId", mean_of("prediction").alias("prediction"))


@query
def tree_leaves(spark, sf_dir):
    """What each leaf predicts, and the mean and number of the rows that reach it."""
    rows, model, nodes = carrier_tree(spark, sf_dir)
    found = forest.node_means(rows, model, nodes)
    return found.select(mean_of("prediction").alias("prediction"), mean_of("mean").alias("mean"), "rows")


@query
def tree_importance(spark, sf_dir):
    """The carrier decides all; the month, which is the same everywhere, nothing."""
    return forest.feature_importance(spark, carrier_tree(spark, sf_dir)[1])


@query
def tree_saved_and_loaded(spark, sf_dir):
    """Predictions per carrier of a model that was saved and loaded again."""
    rows, model, _ = carrier_tree(spark, sf_dir)
    path = scratch_path(spark, "saved-model")
    forest.save_model(model, path)
    scored = forest.score(rows, forest.load_model(path))
    return scored.groupBy("carrier").agg(mean_of(F.min("prediction")).alias("low"), mean_of(F.max("prediction")).alias("high"))


def quality(rows: DataFrame) -> DataFrame:
    """A row of ml_results for the fixed formula."""
    metrics = forest.regression_metrics(rows.withColumn("prediction", fixed_prediction()))
    return metrics.select("r2", "mae", "rmse", F.col("rows").alias("total_records"), F.lit("depDelay").alias("top_feature"))


@query
def results_history(spark, sf_dir):
    """The metrics of two trainings, the second of them stored twice: each is there once."""
    root, rows = scratch_path(spark, "results"), clean_for_ml(spark, sf_dir)
    for run, part in (("one", rows), ("two", rows.where("carrier <> 'CL'")), ("two", rows)):
        marts.append_batch(quality(part), root, "ml_results", 0, run)
    stored = read_mart(spark, "ml_results", root, with_batch=True)
    return plain(stored.select("run", "r2", "mae", "rmse", "total_records", "top_feature"))


@query
def importance_upsert(spark, sf_dir):
    """Shares of the causes in all delays, then those of one carrier for some of them, merged by name."""
    root, flights = scratch_path(spark, "importance"), testdata.flights(spark, sf_dir)

    def shares(rows: DataFrame, causes: list[str]) -> DataFrame:
        total = sum((F.sum(c) for c in causes), F.lit(0.0))
        pairs = [F.struct(F.lit(c).alias("feature_name"), F.try_divide(F.sum(c), total).alias("importance")) for c in causes]
        return rows.agg(F.array(*pairs).alias("pairs")).select(F.inline("pairs"))

    causes = ["carrierDelay", "weatherDelay", "nasDelay"]
    marts.upsert(shares(flights, causes), root, "ml_feature_importance", unique=True)
    marts.upsert(shares(flights.where("carrier = 'CL'"), causes[:2]), root, "ml_feature_importance", 1, unique=True)
    return plain(read_mart(spark, "ml_feature_importance", root))


# --- streams ------------------------------------------------------------------------------------


def streamed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded messages of a stream over the event table, with the event's time."""
    flights = testdata.as_flights(testdata.stream_events(spark, sf_dir))
    return decode_events(encode_events(flights, keep=("eventTime",)), keep=("eventTime",))


def streamed_mart(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    root = scratch_path(spark, "stream")
    for running in streams.start_aggregates(
        streamed_messages(spark, sf_dir),
        f"{root}/marts",
        f"{root}/checkpoints",
        time_col="eventTime",
        trigger={"availableNow": True},
        only=[table],
    ):
        running.awaitTermination()
    return plain(read_mart(spark, table, f"{root}/marts").select(*MARTS[table].names))


@query
def stream_carrier_tumbling(spark, sf_dir):
    return streamed_mart(spark, sf_dir, "carrier_delay_agg")


@query
def stream_airport_sliding(spark, sf_dir):
    return streamed_mart(spark, sf_dir, "airport_delay_agg")


@query
def stream_cause_tumbling(spark, sf_dir):
    return streamed_mart(spark, sf_dir, "delay_cause_agg")


def streamed_predictions(
    spark: SparkSession, sf_dir: str, model: PipelineModel, cap: int | None
) -> DataFrame:
    root = scratch_path(spark, "scoring")
    running = streams.start_scoring(
        streamed_messages(spark, sf_dir),
        model,
        f"{root}/marts",
        f"{root}/checkpoints",
        cap=cap,
        trigger={"availableNow": True},
    )
    running.awaitTermination()
    stored = read_mart(spark, "flight_predictions", f"{root}/marts")
    return plain(stored.drop("processed_at"))


@query
def stream_scoring(spark, sf_dir):
    """The stream scored by a forest, every row kept."""
    return streamed_predictions(spark, sf_dir, published_training(spark, sf_dir).model, cap=None)


@query
def stream_scoring_tree(spark, sf_dir):
    """The stream scored by a tree that was saved and loaded, every row kept."""
    _, model, _ = carrier_tree(spark, sf_dir)
    return streamed_predictions(spark, sf_dir, model, cap=None)


def fixed_model() -> PipelineModel:
    return PipelineModel([
        SQLTransformer(statement="SELECT *, depDelay * 0.9D + 2 AS prediction FROM __THIS__")
    ])


@query
def stream_scoring_fixed(spark, sf_dir):
    """The stream scored by a fixed formula, every row kept."""
    return streamed_predictions(spark, sf_dir, fixed_model(), cap=None)


@query
def stream_scoring_capped(spark, sf_dir):
    """The first 50 rows of the batch in the scoring order."""
    return streamed_predictions(spark, sf_dir, fixed_model(), cap=50)


MESSAGES_A_FILE = 200_000


def of_days(days: tuple[int, int]) -> Column:
    day = F.dayofmonth("timestamp")
    return (day >= days[0]) & (day < days[1])


def files_needed(messages: DataFrame, feeds: list[list[tuple[int, int]]]) -> int:
    """Files for the fullest of the spans of days, so that no task reads or writes more than a bounded part of it."""
    rows = messages.agg(*(F.count_if(of_days(days)) for feed in feeds for days in feed)).first()
    return max(1, -(-max(rows) // MESSAGES_A_FILE))


def write_topic(messages: DataFrame, path: str, days: list[tuple[int, int]], files: int = 1) -> None:
    """Messages of some days of the month as files of a topic, so many files each, in this order."""
    for some in days:
        messages.where(of_days(some)).repartition(files).write.mode("append").parquet(path)


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encode_events(testdata.flights(spark, sf_dir), keep=("eventTime", "cancelled", "eventId"))
    return rows.withColumn("timestamp", F.col("eventTime").cast("timestamp")).drop("eventTime")


def fed_marts(spark: SparkSession, messages: DataFrame, feeds: list[list[tuple[int, int]]]) -> str:
    """Marts fed by one query that starts anew for each of ``feeds`` and takes a span of days a batch.

    All spans have as many files, which is what a batch takes. One of fewer rows than files has fewer of them
    and shares its batch with the next, for the same marts.
    """
    root, files = scratch_path(spark, "fed-marts"), files_needed(messages, feeds)
    for days in feeds:
        write_topic(messages.select("key", "value", "timestamp"), f"{root}/topic", days, files)

        def start():
            topic = read_events(spark, "parquet", {"maxFilesPerTrigger": str(files)}, f"{root}/topic")
            return [streams.start_marts(topic, f"{root}/marts", f"{root}/checkpoints", "timestamp", {"availableNow": True})]

        streams.run_queries(spark, start)
    return f"{root}/marts"


WEEKS = [(1, 9), (9, 17), (17, 25), (25, 32)]


@query
def stream_late_rows(spark, sf_dir):
    """Weeks that arrive out of order, a batch each: rows that are weeks late count in their windows."""
    root = fed_marts(spark, topic_messages(spark, sf_dir), [[WEEKS[2], WEEKS[0], WEEKS[3], WEEKS[1]]])
    return plain(read_mart(spark, "carrier_delay_agg", root).drop("window_date"))


@query
def stream_restarted(spark, sf_dir):
    """Several batches, then a new start from the checkpoint, then several more."""
    root = fed_marts(spark, topic_messages(spark, sf_dir), [WEEKS[:2], WEEKS[2:]])
    return plain(read_mart(spark, "airport_delay_agg", root).drop("window_date"))


@query
def stream_quarantine(spark, sf_dir):
    """Messages that could not be read, each once, with their text; several batches and a restart."""
    messages = topic_messages(spark, sf_dir)
    broken = F.concat(F.lit("#"), F.col("eventId").cast("string"))
    messages = messages.withColumn("value", F.when(F.col("cancelled"), broken).otherwise(F.col("value")))
    root = fed_marts(spark, messages, [WEEKS[:2], WEEKS[2:]])
    return plain(read_mart(spark, "message_quarantine", root).select("key", "value", "reason", "received"))
