"""Tables of immutable folders, and a log that says which of them make up the table.

A write puts its rows into a folder of its own and then names it in a new entry of the log, a small file
that appears at once or not at all. Readers take the newest entry and so see a write whole or not at all,
also while the next one is under way. The entry also names the last batch of each run, so that a batch
that is repeated after a crash is known to be there.

    <table>/data/version=<id>/<date column>=<date>/part-*.parquet
    <table>/_log/<number>.json

The log keeps its newest entries; what only older ones name is removed when a new one is made.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ontime_spark.sinks import files

KEPT_ENTRIES = 10
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Part:
    """One date of one folder. ``day`` is None in a table without dates, and :data:`NO_DATE` for null."""

    day: str | None
    version: str
    rows: int | None = None
    level: int = 0  # how often its rows were merged into larger files


@dataclass(frozen=True)
class Manifest:
    number: int
    parts: tuple[Part, ...] = ()
    done: dict[str, int] = field(default_factory=dict)  # the last batch of each run

    def of_days(self, days: Iterable[str | None]) -> list[Part]:
        wanted = set(days)
        return [p for p in self.parts if p.day in wanted]

    def has(self, run: str | None, batch_id: int) -> bool:
        return run is not None and self.done.get(run, -1) >= batch_id


def new_version() -> str:
    return uuid.uuid4().hex


def current(spark: SparkSession, table: str, number: int | None = None) -> Manifest | None:
    """The newest entry of the table's log, or the one of that ``number``; None without a log."""
    names = [n for n in files.names(spark, f"{table}/_log") if n[0].isdigit()]
    if number is not None:
        names = [n for n in names if int(n.removesuffix(".json")) == number]
    if not names:
        return None
    content = json.loads(files.read_text(spark, f"{table}/_log/{max(names)}"))
    return Manifest(content["number"], tuple(Part(*p) for p in content["parts"]), content["done"])


def commit(spark: SparkSession, table: str, entry: Manifest) -> bool:
    """Make ``entry`` the newest of the log; False if another writer has made one of its number."""
    parts = [[p.day, p.version, p.rows, p.level] for p in entry.parts]
    content = json.dumps({"number": entry.number, "parts": parts, "done": entry.done})
    if not files.create_text(spark, f"{table}/_log/{entry.number:020d}.json", content):
        return False
    _forget(spark, table, entry)
    return True


def _forget(spark: SparkSession, table: str, newest: Manifest) -> None:
    """Remove the entries that leave the log, and what no later entry names."""
    numbers = sorted(int(n.removesuffix(".json")) for n in files.names(spark, f"{table}/_log") if n[0].isdigit())
    for number, following in zip(numbers, numbers[1:]):
        if number > newest.number - KEPT_ENTRIES:
            return
        old, next_ = current(spark, table, number), current(spark, table, following)
        if old is None or next_ is None:  # another writer is at it
            return
        # What the next entry does not name never comes back.
        named = {(p.day, p.version) for p in next_.parts}
        alive = {version for _, version in named}
        for part in old.parts:
            if part.version not in alive:
                files.delete(spark, f"{table}/data/version={part.version}")
            elif (part.day, part.version) not in named:
                files.delete_below(spark, f"{table}/data/version={part.version}", f"={part.day}")
        files.delete(spark, f"{table}/_log/{number:020d}.json")


def write(rows: DataFrame, table: str, version: str, day_column: str | None) -> None:
    """``rows`` as the folder of ``version``."""
    writer = rows.write.mode("overwrite")
    if day_column is not None:
        writer = writer.partitionBy(day_column)
    writer.parquet(f"{table}/data/version={version}")


def read(
    spark: SparkSession, table: str, schema: T.StructType, parts: Iterable[Part], day_column: str | None
) -> DataFrame:
    """The rows of ``parts``, without looking at any other folder."""
    base = f"{table}/data"
    paths = [
        f"{base}/version={p.version}" + ("" if day_column is None else f"/{day_column}={p.day}") for p in parts
    ]
    if not paths:
        return spark.createDataFrame([], schema)
    whole = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    return spark.read.schema(whole).option("basePath", base).parquet(*paths).select(*schema.names)
