"""What several operators share: kept tables, Arrow columns, and words as arrays."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime_spark.sinks import files

CHUNK_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
TIDY_SECONDS = 10.0
_tidied = 0.0
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; one is set only where none is and the master is local."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _remove(spark: SparkSession, path: str) -> None:
    try:
        files.delete(spark, path)
    except Exception:  # the session may have ended, or the folder may be gone
        return


def _tidy_driver(spark: SparkSession) -> None:
    """Let the driver forget plans, broadcasts and shuffles of steps that are done, now and then.

    Spark drops these when the driver collects garbage, which a small driver of many steps does too late.
    """
    global _tidied
    if time.monotonic() - _tidied > TIDY_SECONDS:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _give_back()
        _tidied = time.monotonic()


def keep(df: DataFrame, name: str, spent: Sequence[Broadcast] = ()) -> DataFrame:
    """``df`` as a table written to the shared folder and read again, which cuts its lineage.

    ``spent`` are broadcasts that nothing needs once it is written: the executors forget them.

    The table belongs to this program and is removed when it ends. What writing it shuffled is removed
    once it is written, so that the disk holds one step's shuffles and not those of all steps so far.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    for shared in spent:
        shared.unpersist()
    _tidy_driver(spark)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3))


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _give_back() -> None:
    """Let the system have what this worker no longer uses; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        return


def small(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes or of one row."""
    for batch in batches:
        todo = [batch]
        while todo:
            part = todo.pop()
            if part.nbytes > limit and part.num_rows > 1:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part


def thrifty(mapper: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``mapper`` on small batches, whose task leaves no memory behind."""

    def run(batches):
        try:
            yield from mapper(small(batches))
        finally:
            _give_back()

    return run


def with_arrow(
    df: DataFrame,
    inputs: list[str],
    fields: list[T.StructField],
    make: Callable[[], Callable[..., list]],
    keep_columns: list[str] | None = None,
) -> DataFrame:
    """``df`` with columns that Python computes from whole Arrow columns.

    ``make`` runs once per task and gives a function of the input columns to one array (or list)
    per new field. ``keep_columns`` names what comes back beside them; by default everything. A
    column that has a new field's name is replaced by it.
    """
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep_columns is None else keep_columns) if c.lower() not in new]
    sent = df.select(
        *[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(f"__in{i}") for i, c in enumerate(inputs)]
    )
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    n = len(kept)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in fields]
        compute = make()
        for batch in batches:
            got = compute(*[batch.column(n + i) for i in range(len(inputs))])
            arrays = [g if isinstance(g, pa.Array) else pa.array(g, type=t) for g, t in zip(got, types)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *arrays], names=[*kept, *[f.name for f in fields]]
            )

    return sent.mapInArrow(thrifty(apply), schema)


HEAVY = 256


def join_by_weight(rows: DataFrame, table: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` joined to ``table``, which has one row a key and in ``weight`` how many ``rows`` that key has.

    Keys with more than a 256th of all rows, of which there are fewer than 256, are broadcast; the others
    are small enough to be dealt by key.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    heavy, light = (table.filter(f"{weight} * {HEAVY} {sign} {total}") for sign in (">", "<="))
    at_once = rows.join(F.broadcast(heavy), keys)
    return at_once.unionByName(rows.join(F.broadcast(heavy.select(keys)), keys, "left_anti").join(light, keys))


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first row, UTF-8 bytes, and n + 1 offsets.

    A null text is empty. A text longer than ``size`` makes a run of its own, whole.
    """
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


PLACES = 64
_PLACED = mix64(mix64(np.arange(PLACES << 8, dtype=np.uint64)) + np.uint64(0x9E3779B97F4A7C15))


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, letter: np.ndarray, head: int | None = None
) -> tuple[np.ndarray, ...]:
    """64-bit hashes of the words of a run of texts, and where each text's words begin (n + 1).

    ``letter`` says for each of 256 bytes whether it belongs to a word; words end with their text.
    With ``head``, a third array has the hashes of the words' first so many bytes.
    """
    n = len(offsets) - 1
    if len(data) == 0:
        return (np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), np.zeros(0, np.uint64))[: 2 + (head is not None)]
    inside = letter[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] |= inside[edges]
    starts = np.flatnonzero(begins)
    if len(starts) == 0:
        return (np.zeros(0, np.uint64), np.zeros(n + 1, np.int64), np.zeros(0, np.uint64))[: 2 + (head is not None)]
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data)) - np.concatenate([np.zeros(starts[0], np.int64), np.repeat(starts, lengths)])
    # A number of its own for each byte at each place; their sum stands for the word.
    value = _PLACED[(np.minimum(place, PLACES - 1) << 8) | data]
    far = np.flatnonzero(inside & (place >= PLACES - 1))
    if len(far):
        value[far] = mix64(mix64((place[far].astype(np.uint64) << np.uint64(8)) | data[far]) + np.uint64(0x9E3779B97F4A7C15))
    value[~inside] = 0
    hashes, begin = mix64(np.add.reduceat(value, starts)), np.searchsorted(starts, offsets)
    if head is None:
        return hashes, begin
    value[place >= head] = 0
    return hashes, begin, mix64(np.add.reduceat(value, starts) + np.uint64(1))
