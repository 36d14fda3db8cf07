"""Numbering by range partitions and prefix counts, against the window it replaces."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import gold as G
from ledgerline.operators.ranking import numbered


def _rows(n, years, seed):
    r = random.Random(seed)
    return [(r.choice(years), r.choice([1, 1, 1, r.randrange(5), None]), i) for i in range(n)]


def _agrees(spark, rows, parts):
    df = spark.createDataFrame(rows, "ano int, total int, id int").repartition(3)
    order = [F.col("total").desc_nulls_last(), F.col("id").asc()]
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("ano").orderBy(*order)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered(df, "ano", order, "rank")
        assert got.columns == ["ano", "total", "id", "rank"] and dict(got.dtypes)["rank"] == "int"
        got = sorted(got.collect(), key=lambda x: x["id"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted(want.collect(), key=lambda x: x["id"])


def test_equals_row_number_over_many_tasks(spark):
    for seed, parts in enumerate((1, 4, 13)):
        _agrees(spark, _rows(700, [2020, 2021, 2021, 2021, None], seed), parts)


def test_one_year_is_spread_and_empty_input_stays_empty(spark):
    _agrees(spark, _rows(500, [2023], 7), 9)
    _agrees(spark, [], 4)


def test_more_groups_than_tasks(spark):
    _agrees(spark, _rows(300, list(range(60)), 8), 5)


def test_no_window_over_a_year_of_municipalities(spark, silver_fixture):
    top = G.agg_top_municipios(silver_fixture)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan and "rangepartitioning" not in plan
    assert "sum(__rows" in plan  # the only window: over one row per task and year


def test_only_the_named_tables_are_built(silver_fixture):
    assert list(G.gold_tables(silver_fixture, ["serie_temporal_brasil"])) == ["serie_temporal_brasil"]
    assert list(G.gold_tables(silver_fixture)) == list(G.BUILDERS)
