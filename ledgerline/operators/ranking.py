"""Row numbers without a window over a whole group.

The rows are range-partitioned by group and order, sorted inside each task and
numbered there; where a group's rows run on from task to task, the counts of the
tasks before (one row per task and group) say where each goes on. A group of
any size is spread over the tasks, and only those counts meet in one window.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.settings import work_dir

_AT, _TASK, _FIRST, _ROWS, _BEFORE = "__at", "__task", "__first", "__rows", "__before"
_TASK_BITS = 33  # monotonically_increasing_id counts a task's rows below this bit


def numbered(df: DataFrame, by: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: the row's number (int, from 1) in ``order`` among the rows of its ``by``, NULL being a
    group of its own. ``order`` should be total: rows that tie are numbered in any order.

    The sorted rows are written to the shared work folder first, as a range exchange evaluated twice may draw its
    borders differently. An empty input gives an empty result.
    """
    spark = df.sparkSession
    path = work_dir(spark, f"numbered-{uuid.uuid4().hex[:12]}")
    keys = [F.col(by).asc_nulls_first(), *order]
    laid = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_AT, F.monotonically_increasing_id())
    schema = laid.schema
    laid.write.mode("overwrite").parquet(path)
    laid = spark.read.schema(schema).parquet(path).withColumn(_TASK, F.shiftright(_AT, _TASK_BITS))

    runs = laid.groupBy(F.col(by).alias("__by"), _TASK).agg(F.min(_AT).alias(_FIRST), F.count(F.lit(1)).alias(_ROWS))
    earlier = Window.partitionBy("__by").orderBy(_TASK).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("__by", F.col(_TASK).alias("__run"), _FIRST, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE))
    number = F.col(_AT) - F.col(_FIRST) + F.col(_BEFORE) + 1
    joined = laid.join(runs, (F.col(_TASK) == F.col("__run")) & F.col(by).eqNullSafe(F.col("__by")))
    return joined.select(*df.columns, number.cast("int").alias(name))
