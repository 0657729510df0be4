"""Keeping a batch between its several uses."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` persisted for the block, unless its owner persisted it already."""
    if df.is_cached:
        yield df
        return
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()
