"""Dropping detections over high ground."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridgale.functions.geo import nearest_quarter
from gridgale.operators.links import node_id


def drop_over_high_ground(detections: DataFrame, terrain: DataFrame, above: float) -> DataFrame:
    """Detections whose nearest quarter-degree point is not higher than `above`.

    Those that are left are counted (`n`) and numbered (`idx`, `node`) anew in their step.
    The high points may be few or a whole globe; Spark broadcasts them only if their
    measured size allows it.
    """
    high = terrain.where(F.col("elevation") > F.lit(above)).select(
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")
    ).distinct()
    on = (nearest_quarter(F.col("lat")) == F.col("_lat")) & (nearest_quarter(F.col("lon")) == F.col("_lon"))
    left = detections.join(high, on, "left_anti")
    step = Window.partitionBy("step")
    left = left.withColumns({
        "n": F.count(F.lit(1)).over(step), "idx": (F.row_number().over(step.orderBy("idx")) - 1).cast("int"),
    })
    return left.withColumn("node", node_id(F.col("step"), F.col("idx"))).select(*detections.columns)
