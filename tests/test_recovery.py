"""Faults that lose or change rows: merges that die, new checkpoints, uneven windows, mixed headers."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from ontime_spark.operators import windows
from ontime_spark.plans import catalog
from ontime_spark.sinks import marts
from ontime_spark.sinks.conform import fit
from ontime_spark.sources import marts as sources
from ontime_spark.sources.marts import read_mart
from ontime_spark.sources.raw_csv import read_by_name


def test_a_merge_that_died_leaves_the_table(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path), "ml_feature_importance"
    first = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "feature_name string, importance double")
    second = spark.createDataFrame([("b", 0.75), ("c", 0.1)], "feature_name string, importance double")
    found = lambda: {r["feature_name"]: float(r["importance"]) for r in read_mart(spark, table, root).collect()}
    marts.upsert(first, root, table)
    real = marts.manifest.write
    monkeypatch.setattr(marts.manifest, "write", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        marts.upsert(second, root, table)
    monkeypatch.setattr(marts.manifest, "write", real)
    assert found() == {"a": 0.5, "b": 0.25}
    marts.upsert(second, root, table)
    assert found() == {"a": 0.5, "b": 0.75, "c": 0.1}


@pytest.mark.parametrize("window,slide", [("15 minutes", "10 minutes"), ("10 minutes", "4 minutes"), ("10 minutes", "10 minutes"), ("15 minutes", "5 minutes")])
def test_sliding_windows_hold_their_flights(spark, window, slide):
    times = [dt.datetime(2024, 1, 1, 0, m, 7) for m in range(0, 60, 3)]
    flights = spark.createDataFrame([(t, "BOS", 1.0, False) for t in times], "processingTime timestamp, origin string, arrDelay double, cancelled boolean")
    got = {(r["window_start"], r["total_flights"]) for r in windows.airport_delays(flights, window=window, slide=slide).collect()}
    direct = flights.groupBy(F.window("processingTime", window, slide).alias("w")).count()
    assert got == {(r["w"]["start"], r["count"]) for r in direct.collect()}
    assert windows.seconds_of("1 hour 30 minutes") == 5400 and windows.seconds_of("1 month") is None


def test_headers_in_any_order(spark, tmp_path):
    for k, text in enumerate(("A,B\n1,2\n", "B,A\n2,1\n", "B,C\n2,3\n", "", "A,B\n")):
        (tmp_path / f"{k} x.csv").write_text(text)
    with gzip.open(tmp_path / "5.csv.gz", "wt") as packed:
        packed.write("B,A\n2,1\n")
    got = read_by_name(spark, str(tmp_path))
    assert sorted(got.columns) == ["A", "B", "C"]
    assert sorted(tuple(r[c] for c in "ABC") for r in got.fillna("-").collect()) == [("-", "2", "3")] + [("1", "2", "-")] * 3


def test_text_columns_take_other_types(spark):
    frame = spark.createDataFrame([(12, 0.5)], "feature_name int, importance double")
    assert fit(frame, "ml_feature_importance").first()["feature_name"] == "12"


def test_only_a_missing_table_reads_as_empty(spark, tmp_path):
    assert sources.predictions_or_none(spark, root=str(tmp_path)).isEmpty()
    with pytest.raises(Exception):
        sources.predictions_or_none(spark, root=None)


def test_forest_queries_share_one_training(spark, sf_dir):
    assert catalog.published_training(spark, sf_dir) is catalog.published_training(spark, sf_dir)
