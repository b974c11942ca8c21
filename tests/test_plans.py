"""Plans must hold at scale: no all-pairs joins, no Python but the labels, one task only for tiny tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, plan_of
from gridgale.operators import links, merge, regions, reports, star, storms, terrain, windows
from gridgale.grid import GridSpec
from gridgale.sources import sinks
from registry import fixture as fx
from registry.report_queries import bucketed_join, written_star

SF = "/root/testdata/sf0.001"


def plans(spark):
    g = fx.grid(spark, SF)
    found = links.detections(storms.detect(g, fx.SPEC, regions.DetectParams(center="region_min")))
    return {
        "merge": merge.weather_result(fx.joined(spark, SF)),
        "star": star.read_back(written_star(spark, SF)),
        "detect": storms.detect(g, fx.SPEC),
        "links": links.candidate_links(found),
        "terrain": terrain.drop_over_high_ground(found, fx.terrain(spark, SF), 1000.0),
        "rain": reports.daily_precipitation(g),
        "regions of wind": windows.strong_wind_regions(g),
    }


def test_no_all_pairs_joins_and_little_python(spark):
    for name, df in plans(spark).items():
        text = plan_of(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in text, (name, bad)
        if name in ("merge", "star", "rain", "regions of wind"):
            assert "ArrowEvalPython" not in text, name
        if name != "regions of wind":
            assert "SinglePartition" not in text, name


def test_frames_are_shuffled_once_before_regions(spark):
    cells, _ = storms.smoothed_cells(fx.grid(spark, SF), fx.SPEC, regions.DetectParams())
    masked = regions.masked_cells(cells, fx.SPEC, "msl", regions.DetectParams(), wind="wind")
    assert plan_of(masked).count("Exchange hashpartitioning") == 1


def test_only_needed_columns_are_read(spark):
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of(storms.detect(fx.grid(spark, SF), fx.SPEC))


def test_tables_stored_alike_are_joined_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for large tables
    try:
        assert "Exchange" not in plan_of(bucketed_join(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows_scanned(df) -> int:
    """Rows that the scans of an executed query took out of their files."""
    df.collect()
    plan, total = df._jdf.queryExecution().executedPlan(), 0
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    for i in range(leaves.size()):
        total += leaves.apply(i).metrics().apply("numOutputRows").value()
    return total


def test_clustered_files_prune_space_and_time(spark, tmp_path):
    spec = GridSpec(64, 64, 24.0, 102.0)
    cells = spark.range(64 * 64 * 48).select(
        F.timestamp_add("HOUR", (F.col("id") / 4096).cast("int"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")).alias("time"),
        spec.latitude(F.floor(F.col("id") % 4096 / 64)).alias("latitude"), spec.longitude(F.col("id") % 64).alias("longitude"),
        F.hash("id").alias("v"),
    )
    clustered, plain = str(tmp_path / "clustered"), str(tmp_path / "plain")
    sinks.write_clustered(cells, clustered, spec, tile=8, group_bytes=8 << 10)
    cells.repartition(4).write.option("parquet.block.size", 8 << 10).parquet(plain)
    counts = {}
    for path in (clustered, plain):
        point = spark.read.parquet(path).where("latitude = 20.0 AND longitude = 104.0")
        assert point.count() == 48
        counts[path] = rows_scanned(point), rows_scanned(point.where("time < '2024-01-02 00:00:00'"))
    assert counts[clustered][0] <= counts[plain][0] / 8 and counts[clustered][1] <= counts[clustered][0] / 2 + 4096


LIBRARY = [p for p in Path(ROOT / "gridgale").rglob("*.py") if "llm" not in p.parts]


@pytest.mark.parametrize("word", ["localCheckpoint", "toPandas", "crossJoin", ".rdd", "broadcast("])
def test_words_that_do_not_scale_are_not_used(word):
    for path in LIBRARY:
        assert word not in path.read_text(), path


def test_nothing_is_collected_in_the_library():
    for path in LIBRARY:
        assert ".collect()" not in path.read_text(), path


def test_rain_is_not_sent_to_all_tasks(spark):
    assert "BroadcastExchange" not in plan_of(fx.joined(spark, SF)) + plan_of(bucketed_join(spark, SF))
