"""Streams into mart tables: three windowed aggregates, and scoring.

Each query has its own name, checkpoint and reading of the source. A batch is written so that
repeating it leaves the mart as it was.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ontime_spark.functions.messages import judge_messages
from ontime_spark.ml.forest import prediction_rows, scorable, scorer
from ontime_spark.operators import windows
from ontime_spark.operators.sampling import cap_rows
from ontime_spark.sinks import database, marts
from ontime_spark.sinks.cached import cached

# Query name, mart table, aggregate.
AGGREGATES = (
    ("carrier_agg", "carrier_delay_agg", windows.carrier_delays),
    ("airport_agg", "airport_delay_agg", windows.airport_delays),
    ("cause_agg", "delay_cause_agg", windows.cause_delays),
)
SCORING = ("ml_predictions", "flight_predictions")

# Mart table, what its measures add up from, and how they are made of that.
SUMMED = (
    ("carrier_delay_agg", windows.carrier_sums, windows.carrier_means),
    ("airport_delay_agg", windows.airport_sums, windows.airport_means),
    ("delay_cause_agg", windows.cause_sums, windows.cause_means),
)
DEFAULT = "default"
# How far the clock of a restarted job may be behind the one before.
PROCESSING_WATERMARK = "1 hour"

# What to do with each batch beside storing it, e.g. print some rows: (table, rows, batch number).
OnBatch = Callable[[str, DataFrame, int], None]


def run_name(checkpoint: str) -> str:
    """Names the run of a checkpoint's path, where a query has no id of its own."""
    return hashlib.md5(checkpoint.encode()).hexdigest()[:12]


def run_of(batch: DataFrame, checkpoint: str) -> str:
    """Names the run a batch belongs to: the query's id, which its checkpoint stores.

    Batch numbers start at zero with a new checkpoint, also at the same path, and so does the id.
    """
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return run_name(query_id) if query_id else run_name(checkpoint)


def _set_aside(
    report: DataFrame | None, folder: str | None, table: str, batch_id: int, run: str
) -> None:
    """Keep the rows a table could not take, where there is a folder for them."""
    if report is not None and folder is not None and not report.isEmpty():
        marts.write_report(report, folder, table, batch_id, run)


def _start(
    df: DataFrame,
    name: str,
    mode: str,
    body: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(body)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_aggregates(
    events: DataFrame,
    root: str | None,
    checkpoints: str,
    time_col: str = "processingTime",
    watermark: str | None = DEFAULT,
    trigger: dict | None = None,
    jdbc: dict[str, str] | None = None,
    on_batch: OnBatch | None = None,
    quarantine: str | None = None,
    only: Sequence[str] | None = None,
) -> list[StreamingQuery]:
    """Start the windowed aggregates of decoded ``events`` into the marts below ``root``.

    With ``jdbc`` the marts are tables of a database instead. ``only`` picks mart tables. Windows of
    processing time leave the state an hour after they end, as nothing comes late to them. Windows of
    event time stay unless a ``watermark`` is given, which then drops later rows; :func:`start_marts` has
    neither state nor late rows.

    Rows without a key come from messages that could not be read; they are set aside, with their
    count, in ``<table>_quarantine`` below ``quarantine``, or else below ``root``.
    """

    def writer_of(table: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            run = run_of(batch, checkpoint)
            with cached(batch):
                if on_batch is not None:
                    on_batch(table, batch, batch_id)
                if jdbc is not None:
                    report = database.upsert(batch, jdbc, table, batch_id, run, unique=True)
                else:
                    report = marts.upsert(batch, root, table, batch_id, run, unique=True)
                _set_aside(report, quarantine or root, table, batch_id, run)

        return write

    if watermark == DEFAULT:
        watermark = PROCESSING_WATERMARK if time_col == "processingTime" else None
    started = []
    for name, table, aggregate in AGGREGATES:
        if only is not None and table not in only:
            continue
        checkpoint = f"{checkpoints}/{name}"
        frame = aggregate(events, time_col=time_col, watermark=watermark)
        body = writer_of(table, checkpoint)
        started.append(_start(frame, name, "update", body, checkpoint, trigger))
    return started


def start_marts(
    messages: DataFrame,
    root: str,
    checkpoints: str,
    time_col: str = "processingTime",
    trigger: dict | None = None,
    on_batch: OnBatch | None = None,
    name: str = "marts",
) -> StreamingQuery:
    """Start one query that feeds all three marts below ``root`` from undecoded ``messages``.

    A batch is read and decoded once. Its sums per window and key are added to those that the marts hold
    beside their means, so the query has no state, and a row that comes late, by however much, counts in its
    window. What is added and the batch's number become visible together: a batch that is repeated after a
    crash adds nothing twice.

    Messages with a fault go to ``message_quarantine`` below ``root``, once each, with their text and place in
    the topic. A message counts in every mart whose key it has. ``messages`` has ``value`` and ``time_col``.
    """
    checkpoint = f"{checkpoints}/{name}"

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch, checkpoint)
        judged = judge_messages(batch, keep=(time_col,))
        with cached(judged):
            sound = judged.where(F.col("fault").isNull() | ~F.col("fault").isin("no value", "no JSON"))
            for table, sums, means in SUMMED:
                added = sums(sound, time_col)
                if on_batch is not None:
                    on_batch(table, means(added), batch_id)
                marts.add(added, root, table, means, batch_id, run)
            faulty = judged.where(F.col("fault").isNotNull())
            aside = faulty.select(F.col(time_col).cast("timestamp").alias("received"), "message.*", F.col("fault").alias("reason"))
            marts.append_batch(aside, root, "message_quarantine", batch_id, run)

    return _start(messages, name, "append", write, checkpoint, trigger)


def run_queries(
    spark: SparkSession, start: Callable[[], list[StreamingQuery]], restarts: int = 0
) -> list[StreamingQuery]:
    """Run the queries that ``start`` starts until all have ended, and return them.

    The first failure ends the others, too. Then all start again from their checkpoints, up to ``restarts``
    times; the failure after that is raised.
    """
    while True:
        running = start()
        try:
            while any(query.isActive for query in running):
                spark.streams.resetTerminated()
                await_any(spark, 10)
                for query in running:
                    if query.exception() is not None:
                        raise query.exception()
            for query in running:
                query.awaitTermination()
            return running
        except StreamingQueryException:
            for query in running:
                query.stop()
            if restarts == 0:
                raise
            restarts -= 1


# Tasks a core for scoring a batch, so that none waits long for the last.
SCORING_TASKS = 4
# A batch is capped at its first rows in this order.
SCORING_ORDER = ("carrier", "flightNumber", "flightDate", "origin", "dest", "depDelay", "arrDelay")


def start_scoring(
    events: DataFrame,
    model: PipelineModel | None,
    root: str | None,
    checkpoints: str,
    cap: int | None = None,
    order: Sequence[Column | str] | None = SCORING_ORDER,
    trigger: dict | None = None,
    jdbc: dict[str, str] | None = None,
    on_batch: OnBatch | None = None,
    quarantine: str | None = None,
) -> StreamingQuery | None:
    """Start scoring decoded ``events``; None without a model.

    ``cap`` rows of each batch are kept, the first in ``order``, or any if that is None; ``cap``
    None keeps them all. Rows the table cannot take are set aside as by :func:`start_aggregates`.
    """
    if model is None:
        return None
    name, table = SCORING
    checkpoint = f"{checkpoints}/{name}"
    score = scorer(events.sparkSession, model)

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch, checkpoint)
        # Rows the model would skip must not use up the cap. Without them the batch can be cut
        # down before it is scored, for the same result.
        rows = scorable(batch, model)
        if cap is not None:
            rows = cap_rows(rows, cap, order)
        else:
            # Scoring costs far more than moving a row, and files may come in few or unlike splits.
            rows = rows.repartition(SCORING_TASKS * rows.sparkSession.sparkContext.defaultParallelism)
        scored = prediction_rows(score(rows))
        with cached(scored):
            if on_batch is not None:
                on_batch(table, scored, batch_id)
            if jdbc is not None:
                report = database.append(scored, jdbc, table, batch_id, run)
            else:
                report = marts.append_batch(scored, root, table, batch_id, run)
            _set_aside(report, quarantine or root, table, batch_id, run)

    return _start(events, name, "append", write, checkpoint, trigger)


def await_any(spark: SparkSession, timeout: int | None = None) -> bool | None:
    """Wait until one of the session's queries ends; its failure is raised here."""
    return spark.streams.awaitAnyTermination(timeout)
