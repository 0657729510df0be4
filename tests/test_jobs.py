"""The jobs one after another, as a user runs them: publish, train, stream, report."""

import pytest

import rows
from ontime_spark.jobs import publish, report, stream, train
from ontime_spark.session import scratch_path, shared_dir
from ontime_spark.sources import testdata
from ontime_spark.sources.marts import read_mart


@pytest.fixture(scope="module")
def folders(spark, sf_dir, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    raw = testdata.raw_columns(testdata.flights(spark, sf_dir))
    raw.write.option("header", True).option("emptyValue", "").csv(str(base / "raw"))
    (base / "more.csv").write_text(rows.line(rows.VALID) + "\nbad,data\n")
    return base


def test_publish_train_stream_report(spark, folders, capsys):
    base = str(folders)
    total = testdata_count = spark.read.option("header", True).csv(f"{base}/raw").count()
    counts = publish.main(
        [f"{base}/raw", f"{base}/more.csv", "--messages", f"{base}/topic"]
    )
    assert counts == {"published": total + 1, "skipped": 1}
    assert f"{total + 1} messages sent, 1 lines rejected" in capsys.readouterr().out
    rejected = spark.read.parquet(f"{base}/topic").where("topic = 'flight-events-rejected'").collect()
    assert [(r["key"], r["value"]) for r in rejected] == [("columns", "bad,data")]

    done = train.main(
        [f"{base}/raw", "--model", f"{base}/model", "--marts", f"{base}/marts", "--trees", "3", "--depth", "3"]
    )
    assert done.counts["cleaned"] < testdata_count

    stream.main(
        ["--messages", f"{base}/topic", "--marts", f"{base}/marts", "--checkpoints", f"{base}/checkpoints",
         "--model", f"{base}/model", "--available-now", "--max-per-batch", "100", "--preview", "2"]
    )
    assert "carrier_delay_agg, batch 0:" in capsys.readouterr().out
    carriers = read_mart(spark, "carrier_delay_agg", f"{base}/marts")
    assert carriers.groupBy().sum("total_flights").first()[0] == total + 1

    capsys.readouterr()
    report.main(["--marts", f"{base}/marts"])
    text = capsys.readouterr().out
    for name in ("stats", "carrier-delays", "airport-board", "prediction-board", "Late Aircraft", "gold"):
        assert name in text


@pytest.mark.parametrize("job", [publish, stream, report])
def test_a_job_needs_one_source(job, capsys):
    needed = {"publish": ["in.csv"], "stream": ["--checkpoints", "c"], "report": []}
    with pytest.raises(SystemExit):
        job.main(needed[job.__name__.rsplit(".", 1)[1]])
    assert "give one of" in capsys.readouterr().err


def test_scratch_lies_in_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
