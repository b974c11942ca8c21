import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from gridgale.operators import merge
from gridgale.plans import batch, storm_table
from gridgale.schema import RAW_RAIN, RAW_WEATHER
from gridgale.session import cut_lineage, shared_folder
from gridgale.sources import coverage, readers, sinks, versions
from registry import fixture as fx

SF = "/root/testdata/sf0.001"


def observations(spark, days=3):
    return spark.range(days * 24).select(
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.expr("TIMESTAMP_NTZ '2023-12-30 00:00:00'")).alias("time"),
        F.lit(24.0).alias("latitude"), F.lit(102.0).alias("longitude"), F.col("id").cast("double").alias("u10"),
    )


def test_landing_again_replaces_days(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.land(observations(spark), path)
    sinks.land(observations(spark).where("u10 >= 24").withColumn("time", F.col("time").cast("string")), path)
    back = readers.read_table_files(spark, path)
    assert back.count() == 72 and back.select("year", "month", "day").distinct().count() == 3
    sinks.land(observations(spark), path, append=True)
    assert readers.read_table_files(spark, path).count() == 144
    with pytest.raises(ValueError):
        sinks.land(None, path)


def test_a_time_range_prunes_folders_and_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_by_day(observations(spark), path, files_per_day=2)
    day = readers.between_times(readers.read_table_files(spark, path), "2023-12-31 05:00:00", "2023-12-31 23:00:00")
    picked = day.select("latitude")
    assert picked.count() == 19
    plan = plan_of(picked)
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThanOrEqual(time" in plan
    assert "ReadSchema: struct<time:timestamp_ntz,latitude:double>" in plan
    assert day.inputFiles() and all("day=31" in f for f in {r[0] for r in day.select(F.input_file_name()).collect()})
    year = readers.only_year(readers.read_table_files(spark, path), 2024)
    assert year.count() == 24


def test_missing_hours(spark):
    gone = observations(spark).where("u10 NOT IN (5, 30, 71)")
    want = [dt.datetime(2023, 12, 30) + dt.timedelta(hours=h) for h in (5, 30, 71)]
    assert [r["time"] for r in coverage.missing_hours(gone).orderBy("time").collect()] == want


def test_rain_meets_weather_by_its_valid_time_only(spark):
    joined = merge.merge_weather(fx.rain(spark, SF), fx.weather(spark, SF))
    assert joined.count() == fx.grid(spark, SF).where("tp IS NOT NULL").count()
    nan = fx.rain(spark, SF).withColumn("tp", F.lit(float("nan")))
    assert merge.join_rain(nan, fx.weather(spark, SF)).count() == 0


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "joined")
    fx.joined(spark, SF).write.parquet(path)
    result = merge.weather_result(readers.read_table_files(spark, path)).select("time", "wind_speed")
    plan = plan_of(result)
    assert "GreaterThanOrEqual(latitude,8.0)" in plan and "LessThanOrEqual(longitude,112.0)" in plan
    assert "ReadSchema: struct<latitude:double,longitude:double,time:timestamp_ntz,u10:double,v10:double>" in plan


def test_batch_jobs_from_landing_to_storms(spark, tmp_path):
    root = str(tmp_path)
    for name, frame, schema in (("weather", fx.weather, RAW_WEATHER), ("rain", fx.rain, RAW_RAIN)):
        df = frame(spark, SF)
        df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.parquet(f"{root}/{name}")
    batch.merge_job(spark, f"{root}/weather", f"{root}/rain", f"{root}/joined")
    batch.merge_job(spark, f"{root}/weather", f"{root}/rain", f"{root}/flat", partitions=7, by_day=False)
    batch.transform_job(spark, f"{root}/joined", f"{root}/result", f"{root}/daily")
    batch.split_job(spark, f"{root}/weather", f"{root}/star")
    rows = fx.grid(spark, SF).where("tp IS NOT NULL").count()
    for name in ("joined", "flat", "result"):
        assert spark.read.parquet(f"{root}/{name}").count() == rows
    assert spark.read.parquet(f"{root}/daily").count() == 1
    assert spark.read.parquet(f"{root}/star/dim_location").count() == 300
    span = "2024-01-01 00:00:00", "2024-01-01 03:00:00"
    batch.storm_job(spark, f"{root}/joined", *span, f"{root}/storms", fx.SPEC, emit_quiet_hours=True)
    table = f"storms_{tmp_path.name.replace('-', '_')}"
    for append in (False, True, False, True):
        batch.publish_storms(spark, f"{root}/storms", table, append=append, path=f"{root}/warehouse")
    assert spark.table(table).count() == 8
    assert spark.table(table).where("id LIKE '2024-%'").count() == 8


def storm_hours(spark, *hours):
    """(time, lon) as unnamed storm hours; without a longitude the hour is quiet."""
    rows = [(dt.datetime.fromisoformat(t), lon, None if lon is None else 10.0, 1.0, 2.0, 3.0, None) for t, lon in hours]
    return spark.createDataFrame(
        rows, "time timestamp_ntz, lon_storm double, lat_storm double, amp_storm double, max_wind_speed double, area_storm double, regions_storm string"
    )


def ids(spark, path, **how):
    return [(str(r["time"])[:13], r["id"]) for r in storm_table.read_storms(spark, path, **how).orderBy("time").collect()]


def test_storm_ids_do_not_depend_on_the_order_of_ranges(spark, tmp_path):
    hours = [
        ("2023-11-30 20:00:00", 100.0), ("2023-11-30 21:00:00", 105.0), ("2023-12-31 22:00:00", 105.5), ("2023-12-31 23:00:00", None),
        ("2024-01-01 00:00:00", 106.0), ("2024-01-20 05:00:00", 120.0), ("2024-03-02 00:00:00", 120.5), ("2024-03-03 00:00:00", 130.0),
    ]
    months = {"2023-11": "30", "2023-12": "31", "2024-01": "31", "2024-02": "29", "2024-03": "31"}
    for n, order in enumerate((sorted(months), sorted(months)[::-1], ["2024-01", "2023-12", "2024-03", "2023-11", "2024-02", "2024-01"])):
        path = str(tmp_path / str(n))
        for m in order:
            part = storm_hours(spark, *[h for h in hours if h[0].startswith(m)])
            storm_table.replace_range(part, path, f"{m}-01 00:00:00", f"{m}-{months[m]} 23:59:59", 1.5)
        by_year = ["2023-01", "2023-02", "2023-02", "2023-00", "2023-02", "2024-01", "2024-01", "2024-02"]
        assert ids(spark, path) == [(t[:13], i) for (t, _), i in zip(hours, by_year)]
        in_all = ["S-01", "S-02", "S-02", "S-00", "S-02", "S-03", "S-03", "S-04"]
        assert ids(spark, path, prefix="S") == [(t[:13], i) for (t, _), i in zip(hours, in_all)]
        for how in ({}, {"prefix": "S"}):
            cut = ids(spark, path, start="2024-01-01 00:00:00", end="2024-03-02 00:00:00", **how)
            assert cut == [x for x in ids(spark, path, **how) if "2024-01-01" <= x[0] <= "2024-03-02 00"]


def test_a_range_leaves_other_months_files_and_part_months_alone(spark, tmp_path):
    path = str(tmp_path / "storms")
    first = [("2024-01-10 00:00:00", 100.0), ("2024-01-20 00:00:00", 110.0), ("2024-02-05 00:00:00", 120.0), ("2024-02-06 00:00:00", 130.0)]
    storm_table.replace_range(storm_hours(spark, *first), path, "2024-01-01 00:00:00", "2024-02-29 23:00:00", 1.5)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "storms/rows").rglob("*.parquet")}
    storm_table.replace_range(storm_hours(spark, ("2024-02-06 00:00:00", 120.2)), path, "2024-02-06 00:00:00", "2024-02-07 00:00:00", 1.5)
    assert ids(spark, path) == [("2024-01-10 00", "2024-01"), ("2024-01-20 00", "2024-02"), ("2024-02-05 00", "2024-03"), ("2024-02-06 00", "2024-03")]
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "storms/rows").rglob("*.parquet")}
    assert {p: now[p] for p in files} == files and {p.parts[-3] for p in set(now) - set(files)} == {"month=2024-02"}
    storm_table.replace_range(storm_hours(spark), path, "2024-01-01 00:00:00", "2024-01-31 23:00:00", 1.5)
    assert ids(spark, path) == [("2024-02-05 00", "2024-01"), ("2024-02-06 00", "2024-01")]


def test_null_keys_land_once(spark, tmp_path):
    rows = observations(spark).withColumns({"latitude": F.lit(None).cast("double"), "u10": F.col("u10") * 2})
    for land, read in ((sinks.land, readers.read_table_files), (sinks.land_versions, readers.read_landed)):
        path = str(tmp_path / land.__name__)
        for part in (rows, rows.where("hour(time) < 6").withColumn("u10", F.lit(-1.0)), rows.limit(0)):
            land(part, path)
        got = read(spark, path)
        assert got.count() == 72 and got.where("u10 = -1").count() == 18


def test_landed_days_are_pruned_while_the_query_runs(spark, tmp_path):
    sinks.land(observations(spark), str(tmp_path / "plain"))
    sinks.land_versions(observations(spark), str(tmp_path / "kept"))
    spark.createDataFrame([(dt.date(2023, 12, 31),)], "day date").write.parquet(str(tmp_path / "days"))
    days = spark.read.parquet(str(tmp_path / "days"))
    schema = readers.read_table_files(spark, str(tmp_path / "plain")).drop("year", "month", "day").schema
    for got in (readers.read_landed_days(spark, str(tmp_path / "plain"), days, schema), readers.read_landed(spark, str(tmp_path / "kept"), days)):
        assert got.count() == 24 and "dynamicpruning" in plan_of(got)


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == configured.rstrip("/") if configured else shared_folder(spark)


def test_landing_sends_no_keys_to_all_tasks(spark):
    """However small the files of a batch are, its keys are as many as its rows."""
    rows = observations(spark)
    old, batch = cut_lineage(rows), cut_lineage(rows.where("u10 >= 24").withColumn("u10", F.lit(-1.0)))
    merged = sinks.upsert(old, batch, ["time", "latitude", "longitude"])
    assert merged.count() == rows.count() and "BroadcastExchange" not in plan_of(merged)


def test_many_light_days_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "FOLDERS", 4)
    dealt, was = [], versions.together
    monkeypatch.setattr(versions, "together", lambda df, parts, tasks=None: (dealt.append(tasks), was(df, parts, tasks))[1])
    rows = observations(spark, days=20)
    for land in (sinks.land, sinks.land_versions):
        for _ in range(2):
            land(rows, str(tmp_path / land.__name__))
    assert dealt == [5, 5, 5, 5]
    monkeypatch.setattr(versions, "HEAVY", 40)  # known rows of a day, 24 in each of two batches
    sinks.land_versions(rows.limit(1), str(tmp_path / "land_versions"))
    sinks.land(rows, str(tmp_path / "land"))
    assert dealt[4:] == [None, 5]
    assert readers.read_landed(spark, str(tmp_path / "land_versions")).count() == readers.read_table_files(spark, str(tmp_path / "land")).count() == 480


def test_light_days_of_a_month_share_a_file(spark, tmp_path):
    """Files of landed versions grow with months, not with days."""
    path, rows = tmp_path / "kept", observations(spark, days=60)  # 2 days in 2023, 58 in January and February
    for part in ("hour(time) < 12", "hour(time) >= 12"):
        sinks.land_versions(rows.where(part), str(path))
    written = [f for f in path.rglob("*.parquet") if "records" not in f.parts]
    assert len(written) == 2 * 3
    got = readers.read_landed(spark, str(path))
    assert got.count() == 60 * 24 and got.select("time").distinct().count() == 60 * 24
    assert got.where("day(time) <> day OR month(time) <> month OR year(time) <> year").count() == 0


def test_light_and_heavy_days_land_side_by_side(spark, tmp_path, monkeypatch):
    kept, plain = str(tmp_path / "kept"), str(tmp_path / "plain")
    rows = observations(spark, days=8).withColumn("latitude", F.when(F.col("u10") % 5 != 0, F.col("latitude")))
    even, other = "day(time) % 2 = 0", F.col("u10") * -1
    batches = (
        (0, rows.where("day(time) < 20")),  # a folder for each day, as all tables had
        (24, rows.where("hour(time) < 12")),  # with the rows before some days have more, others not
        (40, rows.where(even).withColumn("u10", other)),
        (10_000, rows.where("NOT " + even).where("hour(time) >= 6").withColumn("u10", other)),
    )
    days = spark.createDataFrame([(dt.date(2023, 12, 31),), (dt.date(2024, 1, 4),)], "day date")
    for light, batch in batches:
        monkeypatch.setattr(versions, "LIGHT", light)
        for land, path in ((sinks.land_versions, kept), (sinks.land, plain)):
            land(batch, path)
        got, want = readers.read_landed(spark, kept), readers.read_table_files(spark, plain).select("year", "month", "day", "time", "latitude", "longitude", "u10")
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
        some = readers.read_landed(spark, kept, days).select(want.columns)
        assert sorted(map(str, some.collect())) == sorted(map(str, want.where("to_date(time) IN ('2023-12-31', '2024-01-04')").collect()))
    both = [{p.parent.name for p in (tmp_path / "kept" / kind).rglob("*.parquet")} for kind in ("rows", "light")]
    assert both[0] & both[1] and len(both[0] | both[1]) == 4


def test_buckets_grow_with_the_table(spark):
    assert [sinks.buckets_for(spark.range(n), 8, rows=100) for n in (0, 800, 801, 5000)] == [8, 8, 9, 50]
