import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridgale.plans import live
from gridgale.schema import MESSAGE
from gridgale.sources import sinks
from gridgale.streaming import feed
from gridgale.streaming import sinks as stream_sinks

GOOD = "2024-01-11 00:00:00, 24.0, 102.25, 0, 0 days 00:00:00, 0.0, 2024-01-11 00:00:00, 3.0, 4.0, 280.1, 290.2, 101300.5, nan, 99000.0, 0.5, 0.0, 0.25"


def write(path, name, *lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n")


def run(spark, source, out, checkpoint):
    stream = feed.parse_stream(feed.read_messages(spark, "text", str(source)))
    stream_sinks.to_files(stream, str(out), str(checkpoint), once=True).awaitTermination()
    return spark.read.parquet(str(out))


def test_bad_messages_give_nulls_and_the_stream_goes_on(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", tmp_path / "checkpoint"
    write(source, "a.txt", GOOD, "1, 2", GOOD.replace("3.0", "abc"), "", GOOD.replace("2024-01-11", "2024-01-01"))
    rows = run(spark, source, out, checkpoint).collect()
    assert len(rows) == 5
    good = [r for r in rows if r["time"] == dt.datetime(2024, 1, 11) and r["u10"] is not None]
    assert len(good) == 1 and good[0]["sst"] is None and good[0]["wind_speed"] == 5.0
    assert good[0]["tclw"] == 0.25 and good[0]["step"] == "0 days 00:00:00"
    short = [r for r in rows if r["latitude"] == 2.0][0]
    assert all(short[f.name] is None for f in MESSAGE.fields[2:]) and short["wind_speed"] is None
    assert sum(r["u10"] is None for r in rows) == 3
    assert sum(r["time"] == dt.datetime(2024, 1, 1) for r in rows) == 1

    write(source, "b.txt", GOOD, GOOD)
    assert run(spark, source, out, checkpoint).count() == 7


def test_only_streams_are_parsed_as_streams(spark):
    with pytest.raises(ValueError):
        feed.parse_stream(spark.range(1).select(F.lit(GOOD).alias("value")))


def test_checkpoint_must_lie_outside_the_data(spark, tmp_path):
    write(tmp_path / "in", "a.txt", GOOD)
    stream = feed.parse_stream(feed.read_messages(spark, "text", str(tmp_path / "in")))
    with pytest.raises(ValueError):
        stream_sinks.to_files(stream, str(tmp_path / "out"), str(tmp_path / "out/checkpoint"), once=True)


def test_a_new_checkpoint_adds_and_a_batch_run_again_does_not(spark, tmp_path):
    import shutil

    write(tmp_path / "in", "a.txt", GOOD, GOOD)
    table = f"again_{tmp_path.name.replace('-', '_')}"
    seen = []
    for checkpoint in ("c1", "c1", "c2"):  # the second run finds its batch not yet committed
        stream = feed.parse_stream(feed.read_messages(spark, "text", str(tmp_path / "in")))
        stream_sinks.to_files_and_table(
            stream, str(tmp_path / "out"), table, str(tmp_path / checkpoint),
            on_batch=lambda i, n: seen.append((i, n)), once=True, table_options={"path": str(tmp_path / "table")},
        ).awaitTermination()
        if len(seen) == 1:
            shutil.rmtree(tmp_path / "c1" / "commits")
    assert seen == [(0, 2), (0, 2), (0, 2)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
    assert spark.table(table).count() == 4
    assert spark.table(table).select("run", "batch").distinct().count() == 2


@pytest.mark.parametrize("lost", ["begun", "done"])
def test_a_batch_cut_off_between_files_and_table_comes_once(spark, tmp_path, monkeypatch, lost):
    """The job is lost at a note of the ledger: before the table is loaded, or just after it."""
    import shutil

    write(tmp_path / "in", "a.txt", GOOD, GOOD)
    table = f"cut_{lost}_{tmp_path.name.replace('-', '_')}"

    def run_once():
        stream = feed.parse_stream(feed.read_messages(spark, "text", str(tmp_path / "in")))
        stream_sinks.to_files_and_table(
            stream, str(tmp_path / "out"), table, str(tmp_path / "c"), once=True, table_options={"path": str(tmp_path / "table")}
        ).awaitTermination()

    note = stream_sinks.Ledger.note

    def breaks(self, run, batch, rows, state):
        if state == lost:
            raise RuntimeError("lost")
        note(self, run, batch, rows, state)

    monkeypatch.setattr(stream_sinks.Ledger, "note", breaks)
    with pytest.raises(Exception, match="lost"):
        run_once()
    monkeypatch.setattr(stream_sinks.Ledger, "note", note)
    run_once()
    shutil.rmtree(tmp_path / "c" / "commits")
    run_once()
    assert spark.table(table).count() == spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_the_live_job_runs_from_feed_to_table(spark, tmp_path):
    write(tmp_path / "in", "a.txt", GOOD, "1, 2")
    table = f"live_{tmp_path.name.replace('-', '_')}"
    live.stream_job(
        spark, str(tmp_path / "out"), table, str(tmp_path / "c"), fmt="text", source=str(tmp_path / "in"), once=True,
        table_options={"path": str(tmp_path / "table")},
    )
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.table(table).count() == 2


def test_messages_survive_the_round_trip(spark):
    values = {f.name: F.lit(1.5).cast(f.dataType) for f in MESSAGE.fields}
    values |= {n: F.lit("2024-01-11 05:00:00").cast("timestamp_ntz") for n in ("time", "valid_time")}
    values |= {"step": F.lit("0 days"), "sst": F.lit(None).cast("float"), "number": F.lit(7)}
    rows = spark.range(1).select(*[c.alias(n) for n, c in values.items()])
    message = sinks.to_messages(rows)
    assert message.first()["key"] == "2024-01-11 05:00:00_1.5_1.5"
    assert feed.parse_messages(message).select(*MESSAGE.names).first() == rows.first()
