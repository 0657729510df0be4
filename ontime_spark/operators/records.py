"""Raw lines to typed records, and records to training rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ontime_spark.functions import classify, parsing
from ontime_spark.schemas import RAW_FIELDS, RECORD_COLUMNS

REQUIRED = tuple(f for _, f, kind in RAW_FIELDS if kind in ("int", "double", "date"))

# The first 27 fields of a line whose quotes, if any, do nothing but enclose whole fields.
_FIELD = r'(?:"[^"]*+"|[^",]*+)'
PLAIN_RECORD = rf"^({_FIELD}(?:,{_FIELD}){{{len(RAW_FIELDS) - 1}}})(?:,{_FIELD})*+$"
CSV_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "misfit",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "nanValue": "NaN",
    "positiveInf": "Infinity",
    "negativeInf": "-Infinity",
}


def _from_text(text: Column, kind: str, strict_int: bool) -> Column:
    """One field from its text."""
    if kind == "text":
        return parsing.clean_text(text)
    if kind == "optional text":
        return parsing.optional_text(text)
    if kind == "date":
        return parsing.parse_flight_date(text)
    if kind == "flag":
        return parsing.parse_flag(text)
    if kind.endswith("double"):
        return parsing.parse_double(text)
    return parsing.parse_int(text, strict=strict_int or kind == "int")


def _csv_type(kind: str, strict_int: bool) -> str:
    if kind == "int" or kind.endswith("double"):
        return kind.removeprefix("optional ")
    return "double" if kind == "optional int" and not strict_int else "string"


def _from_csv(column: Column, kind: str, strict_int: bool) -> Column:
    """One field as the CSV expression read it, its text null where empty."""
    if kind == "int" or kind.endswith("double"):
        return column
    if kind == "optional int" and not strict_int:
        return column.try_cast("int")
    if kind == "date":
        return parsing.parse_calendar_date(column)
    return _from_text(F.coalesce(column, F.lit("")), kind, strict_int)


def _exact_record(line: Column, strict_int: bool) -> Column:
    """The 27 fields of any line, and ``fault``, by the letter."""
    kinds: dict[str, list[int]] = {}
    for position, (_, _, kind) in enumerate(RAW_FIELDS):
        kinds.setdefault(kind, []).append(position)

    def typed(fields: Column) -> Column:
        """One array per kind of field, so that each kind's reading is written out once."""

        def of_kind(kind: str) -> Column:
            return F.transform(
                F.lit(kinds[kind]), lambda i: _from_text(F.get(fields, i), kind, strict_int)
            ).alias(kind)

        complete = F.size(fields) >= len(RAW_FIELDS)
        return F.struct(complete.alias("complete"), *map(of_kind, kinds))

    def judged(record: Column) -> Column:
        values = {
            RECORD_COLUMNS[position]: F.get(record.getField(kind), F.lit(nth))
            for kind, positions in kinds.items()
            for nth, position in enumerate(positions)
        }
        fault = F.when(~record.getField("complete"), "columns")
        for field in REQUIRED:
            fault = fault.when(values[field].isNull(), field)
        return F.struct(*(values[f].alias(f) for f in RECORD_COLUMNS), fault.alias("fault"))

    return parsing.bind(parsing.bind(parsing.split_line(line), typed), judged)


def type_records(
    lines: DataFrame,
    strict_int: bool = False,
    observation: Observation | str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Lines (column ``value``) as the 27 record fields, the line, and ``fault``.

    ``fault`` is null for a good row: one that has all 27 positions and whose required fields
    all read. Otherwise it names the first thing that is wrong. Positions past the 27th are
    ignored. ``strict_int`` applies to the optional whole numbers: with it ``1.00`` is
    unreadable, so both 15-minute flags of a standard file come out null.

    Plain lines that read without trouble are taken as the CSV expression reads them. Every
    other line is split and read once more by the letter, in the same pass.

    The counts ``published`` and ``skipped`` of the rows passing through are observed, as
    ``observation`` if given. The observation also keeps a later filter on ``fault`` from being
    pushed below the parsing, where lines would be parsed once more to filter them.
    """
    schema = ", ".join(f"{f} {_csv_type(kind, strict_int)}" for _, f, kind in RAW_FIELDS)
    # Where lines are computed, they are computed once: expressions do not move past an observation.
    lines = lines.observe(f"lines-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("lines"))
    plain = lines.select("value", F.regexp_extract("value", PLAIN_RECORD, 1).alias("plain"), *keep)
    read = plain.select(
        "value", F.from_csv("plain", f"{schema}, misfit string", CSV_OPTIONS).alias("csv"), *keep
    )
    quick = read.select(
        "value",
        *(
            _from_csv(F.col(f"csv.{field}"), kind, strict_int).alias(field)
            for _, field, kind in RAW_FIELDS
        ),
        (F.col("csv").isNull() | F.col("csv.misfit").isNotNull()).alias("odd"),
        *keep,
    )
    odd = F.col("odd")
    for field in REQUIRED:
        odd = odd | F.col(field).isNull()
    # No element for a line that needs none, so nothing is worked out for it.
    oddities = F.when(odd, F.array("value")).otherwise(F.array().cast("array<string>"))
    exact = F.transform(oddities, lambda line: _exact_record(line, strict_int))
    both = quick.withColumn("exact", F.get(exact, F.lit(0)))
    is_odd = F.col("exact").isNotNull()
    return both.select(
        *(
            F.when(is_odd, F.col(f"exact.{field}")).otherwise(F.col(field)).alias(field)
            for field in RECORD_COLUMNS
        ),
        "value",
        F.col("exact.fault").alias("fault"),
        *keep,
    ).observe(
        # A name of its own, so that several inputs can meet in one query.
        observation or f"type_records-{uuid.uuid4().hex}",
        F.count_if(F.col("fault").isNull()).alias("published"),
        F.count_if(F.col("fault").isNotNull()).alias("skipped"),
    )


def parse_records(
    lines: DataFrame,
    strict_int: bool = False,
    observation: Observation | None = None,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Good records, and the quarantine of lines that are none, with what is wrong with them.

    The observation counts both kinds whichever of the two frames runs first.
    """
    typed = type_records(lines, strict_int, observation, keep)
    good = typed.where(F.col("fault").isNull()).select(*RECORD_COLUMNS, *keep)
    quarantine = typed.where(F.col("fault").isNotNull()).select("value", "fault", *keep)
    return good, quarantine


def record_counts(typed: DataFrame) -> DataFrame:
    """``published`` and ``skipped`` rows of :func:`type_records`, in one pass."""
    return typed.agg(
        F.count_if(F.col("fault").isNull()).alias("published"),
        F.count_if(F.col("fault").isNotNull()).alias("skipped"),
    )


def add_delay_category(df: DataFrame) -> DataFrame:
    return df.withColumn("delayCategory", classify.delay_category(F.col("arrDelay")))


def add_is_delayed(df: DataFrame) -> DataFrame:
    return df.withColumn("isDelayed", classify.is_delayed(F.col("arrDel15")))


def add_total_cause_delay(df: DataFrame) -> DataFrame:
    return df.withColumn("totalCauseDelay", classify.total_cause_delay())


# The columns a delay model is trained on, with their record fields. The numbers
# among them are doubles.
TRAINING_COLUMNS = (
    ("OP_UNIQUE_CARRIER", "carrier"),
    ("ORIGIN", "origin"),
    ("DEST", "dest"),
    ("DAY_OF_WEEK", "dayOfWeek"),
    ("MONTH", "month"),
    ("DEP_DELAY", "depDelay"),
    ("DISTANCE", "distance"),
    ("WEATHER_DELAY", "weatherDelay"),
    ("CARRIER_DELAY", "carrierDelay"),
    ("NAS_DELAY", "nasDelay"),
    ("ARR_DELAY", "arrDelay"),
)
TRAINING_TEXT = ("carrier", "origin", "dest")
# The delays that are zero where missing.
FILLED_DELAYS = ("depDelay", "weatherDelay", "carrierDelay", "nasDelay")


def training_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The model's columns, from records or from a file read by header name."""
    by_header = "OP_UNIQUE_CARRIER" in df.columns
    chosen = []
    for header, field in TRAINING_COLUMNS:
        column = F.col(header if by_header else field)
        if field not in TRAINING_TEXT:
            column = column.try_cast("double")
        chosen.append(column.alias(field))
    return df.select(*chosen, *keep)


def fill_missing_delays(df: DataFrame, fill: tuple[str, ...] = FILLED_DELAYS) -> DataFrame:
    return df.na.fill(0.0, list(fill))


def clean_for_training(
    df: DataFrame,
    fill: tuple[str, ...] = FILLED_DELAYS,
    label: str = "arrDelay",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Training rows: missing delays zero, rows without a label (or with NaN) left out."""
    return fill_missing_delays(training_columns(df, keep), fill).na.drop(subset=[label])
