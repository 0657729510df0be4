"""The on-time file, by position or by header name."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.schemas import RAW_COLUMNS
from ontime_spark.sinks import files


def drop_header(lines: DataFrame) -> DataFrame:
    """Leaves out every line that starts with the 27 column names, once per file."""
    value = F.col("value")
    names = F.translate(value, '" \t\ufeff', "").startswith(",".join(RAW_COLUMNS))
    # The search for one name is cheap and settles almost every line.
    return lines.where(~(value.contains(RAW_COLUMNS[-1]) & names))


def read_raw(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of the file or files (column ``value``), to be parsed by position.

    Lines and not CSV columns, because a short line must be seen to be short. Uncompressed
    files are split among tasks.
    """
    return drop_header(spark.read.text(path))


def stream_raw(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """As :func:`read_raw`, for files that keep arriving in a folder."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return drop_header(reader.text(path))


READERS = 32  # files whose headers are read at once


def headers(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """The files at ``path`` by their first line, each of which is read alone; empty files are left out."""
    found = [unquote(f) for f in spark.read.text(path).inputFiles()]
    groups: dict[str, list[str]] = {}
    with ThreadPoolExecutor(READERS) as readers:
        for name, line in zip(found, readers.map(lambda f: files.first_line(spark, f), found)):
            if line:
                groups.setdefault(line.removeprefix("\ufeff"), []).append(name)
    return groups


def read_by_name(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text columns named by each file's own header. No pass over the data to guess types.

    Files may have their columns in different orders, or lack some, which are null there. Files with one
    header are read together, so there are as many scans as there are different headers.
    """
    groups = headers(spark, path)
    frames = [spark.read.option("header", True).option("enforceSchema", False).csv(group) for group in groups.values()]
    if not frames:
        return spark.read.option("header", True).csv(path)
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole
