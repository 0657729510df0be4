"""The four shapes of the domain: raw text, typed record, stream event, mart tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The on-time file's header, in file order, with the record field each column
# becomes and how its text is read.
RAW_FIELDS = (
    ("MONTH", "month", "int"),
    ("DAY_OF_WEEK", "dayOfWeek", "int"),
    ("FL_DATE", "flightDate", "date"),
    ("OP_UNIQUE_CARRIER", "carrier", "text"),
    ("OP_CARRIER_FL_NUM", "flightNumber", "text"),
    ("ORIGIN", "origin", "text"),
    ("ORIGIN_CITY_NAME", "originCity", "text"),
    ("ORIGIN_STATE_ABR", "originState", "text"),
    ("DEST", "dest", "text"),
    ("DEST_CITY_NAME", "destCity", "text"),
    ("DEST_STATE_ABR", "destState", "text"),
    ("CRS_DEP_TIME", "crsDepTime", "int"),
    ("DEP_TIME", "depTime", "optional int"),
    ("DEP_DELAY", "depDelay", "optional double"),
    ("DEP_DEL15", "depDel15", "optional int"),
    ("CRS_ARR_TIME", "crsArrTime", "int"),
    ("ARR_TIME", "arrTime", "optional int"),
    ("ARR_DELAY", "arrDelay", "optional double"),
    ("ARR_DEL15", "arrDel15", "optional int"),
    ("CANCELLED", "cancelled", "flag"),
    ("CANCELLATION_CODE", "cancellationCode", "optional text"),
    ("DISTANCE", "distance", "double"),
    ("CARRIER_DELAY", "carrierDelay", "optional double"),
    ("WEATHER_DELAY", "weatherDelay", "optional double"),
    ("NAS_DELAY", "nasDelay", "optional double"),
    ("SECURITY_DELAY", "securityDelay", "optional double"),
    ("LATE_AIRCRAFT_DELAY", "lateAircraftDelay", "optional double"),
)
RAW_COLUMNS = tuple(name for name, _, _ in RAW_FIELDS)
RECORD_COLUMNS = tuple(field for _, field, _ in RAW_FIELDS)

# The JSON message, field by field.
EVENT = T.StructType([
    T.StructField("flightDate", T.StringType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("dayOfWeek", T.IntegerType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("flightNumber", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("originCity", T.StringType()),
    T.StructField("originState", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("destCity", T.StringType()),
    T.StructField("destState", T.StringType()),
    T.StructField("depDelay", T.DoubleType()),
    T.StructField("arrDelay", T.DoubleType()),
    T.StructField("cancelled", T.BooleanType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("carrierDelay", T.DoubleType()),
    T.StructField("weatherDelay", T.DoubleType()),
    T.StructField("nasDelay", T.DoubleType()),
    T.StructField("securityDelay", T.DoubleType()),
    T.StructField("lateAircraftDelay", T.DoubleType()),
])

CAUSE_DELAYS = ("carrierDelay", "weatherDelay", "nasDelay", "securityDelay", "lateAircraftDelay")
# The delays a message carries as 0.0 where the record has none.
PUBLISHED_DELAYS = ("depDelay", "arrDelay", *CAUSE_DELAYS)


@dataclass(frozen=True)
class Mart:
    """A mart table: columns with their SQL types, key columns, and who fills in the rest.

    ``keys`` is empty for append-only tables. ``windowed`` tables are stored by the date of
    ``window_start``, so that a merge touches only the dates in its batch.
    """

    name: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...] = ()
    stamp: str | None = None  # column filled with the time of writing
    # What a table stored in files keeps beside its measures, so that batches and windows can be added up.
    sums: tuple[tuple[str, str], ...] = ()

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    @property
    def windowed(self) -> bool:
        return "window_start" in self.names




def _sums(*delays: str, flights: bool = True) -> tuple[tuple[str, str], ...]:
    """The sum and the number of each delay, and the flights where they are counted."""
    counted = (("flights", "bigint"), ("cancels", "bigint")) if flights else ()
    return tuple(c for d in delays for c in ((f"{d}_sum", "double"), (f"{d}_n", "bigint"))) + counted


# Table names, columns, types and keys of the marts.
MARTS = {
    m.name: m
    for m in (
        Mart(
            "carrier_delay_agg",
            (
                ("window_start", "TIMESTAMP"),
                ("window_end", "TIMESTAMP"),
                ("carrier", "VARCHAR(10)"),
                ("avg_arr_delay", "NUMERIC(8,2)"),
                ("avg_dep_delay", "NUMERIC(8,2)"),
                ("total_flights", "BIGINT"),
                ("cancellations", "BIGINT"),
                ("avg_weather_delay", "NUMERIC(8,2)"),
                ("avg_carrier_delay", "NUMERIC(8,2)"),
            ),
            keys=("window_start", "carrier"),
            sums=_sums("arrDelay", "depDelay", "weatherDelay", "carrierDelay"),
        ),
        Mart(
            "airport_delay_agg",
            (
                ("window_start", "TIMESTAMP"),
                ("window_end", "TIMESTAMP"),
                ("origin", "VARCHAR(10)"),
                ("avg_arr_delay", "NUMERIC(8,2)"),
                ("total_flights", "BIGINT"),
                ("cancellations", "BIGINT"),
            ),
            keys=("window_start", "origin"),
            sums=_sums("arrDelay"),
        ),
        Mart(
            "delay_cause_agg",
            (
                ("window_start", "TIMESTAMP"),
                ("window_end", "TIMESTAMP"),
                ("avg_carrier_delay", "NUMERIC(8,2)"),
                ("avg_weather_delay", "NUMERIC(8,2)"),
                ("avg_nas_delay", "NUMERIC(8,2)"),
                ("avg_security_delay", "NUMERIC(8,2)"),
                ("avg_late_aircraft_delay", "NUMERIC(8,2)"),
            ),
            keys=("window_start",),
            sums=_sums(*CAUSE_DELAYS, flights=False),
        ),
        Mart(
            "flight_predictions",
            (
                ("carrier", "VARCHAR(10)"),
                ("flight_number", "VARCHAR(10)"),
                ("origin", "VARCHAR(10)"),
                ("dest", "VARCHAR(10)"),
                ("dep_delay", "NUMERIC(8,2)"),
                ("actual_delay", "NUMERIC(8,2)"),
                ("predicted_delay", "NUMERIC(8,2)"),
                ("processed_at", "TIMESTAMP"),
            ),
            stamp="processed_at",
        ),
        Mart(
            "ml_results",
            (
                ("r2", "NUMERIC(6,4)"),
                ("mae", "NUMERIC(8,2)"),
                ("rmse", "NUMERIC(8,2)"),
                ("total_records", "BIGINT"),
                ("top_feature", "VARCHAR(50)"),
                ("created_at", "TIMESTAMP"),
            ),
            stamp="created_at",
        ),
        Mart(
            "ml_feature_importance",
            (
                ("feature_name", "VARCHAR(50)"),
                ("importance", "NUMERIC(10,6)"),
            ),
            keys=("feature_name",),
        ),
    )
}

# Tables of this library's own, stored like the marts.
TABLES = {
    **MARTS,
    "message_quarantine": Mart(
        "message_quarantine",
        (
            ("received", "TIMESTAMP"),
            ("key", "TEXT"),
            ("value", "TEXT"),
            ("topic", "TEXT"),
            ("partition", "BIGINT"),
            ("offset", "BIGINT"),
            ("reason", "TEXT"),
        ),
        stamp="received",
    ),
}
