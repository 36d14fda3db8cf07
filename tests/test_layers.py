"""Columns of stored months without file footers, and funnel counts of tasks that run twice."""

import glob
import os

from pyspark.sql import functions as F

from ledgerline.operators import silver as S
from ledgerline.plans import pipeline as P
from ledgerline.schemas import BRONZE_SCHEMA, RAW_COLUMNS
from ledgerline.settings import Layout
from ledgerline.sinks import tables as K

HEADER = ";".join(RAW_COLUMNS)


def land(root, period, text):
    d = root.removeprefix("file:") + f"/competencia={period}"
    os.makedirs(d, exist_ok=True)
    with open(f"{d}/a.csv", "w", encoding="latin-1") as f:
        f.write(text)


def test_months_show_their_noted_columns(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    row = ";SP;1;A;c;1;N;10,00"
    land(lay.landing, "202301", f"{HEADER}\n202301{row}\n")
    land(lay.landing, "202302", f"{HEADER};LOTE 1/2;Ç\n202302{row};l;m\n")
    first = P.ingest_bronze(spark, lay, [(2023, 1)])
    P.ingest_bronze(spark, lay, [(2023, 2)])
    assert "LOTE 1/2" not in first.columns
    assert K.noted_columns(spark, lay.bronze) == {202301: set(), 202302: {"LOTE 1/2", "Ç"}}
    both = P.scan_periods(spark, lay.bronze, [(2023, 1), (2023, 2)])
    assert sorted((r["mes"], r["LOTE 1/2"], r["Ç"]) for r in both.collect()) == [(1, None, None), (2, "l", "m")]
    assert sorted(P.scan_periods(spark, lay.bronze, [(2023, 1)]).columns) == sorted(BRONZE_SCHEMA.names)
    # a month that loses a column
    land(lay.landing, "202302", f"{HEADER};Ç\n202302{row};n\n")
    P.ingest_bronze(spark, lay, [(2023, 2)], overwrite=True)
    assert K.noted_columns(spark, lay.bronze) == {202301: set(), 202302: {"Ç"}}
    again = P.scan_periods(spark, lay.bronze, [(2023, 2)])
    assert [r["Ç"] for r in again.collect()] == ["n"] and "LOTE 1/2" not in again.columns


def test_no_footer_job_with_a_schema(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    land(lay.landing, "202301", f"{HEADER}\n202301;SP;1;A;c;1;N;10,00\n")
    P.ingest_bronze(spark, lay, [(2023, 1)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "reading without running")
    try:
        P.scan_periods(spark, lay.bronze, [(2023, 1)]).schema
        assert tracker.getJobIdsForGroup("plan-only") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_months_without_notes_are_merged(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    land(lay.landing, "202301", f"{HEADER};LOTE\n202301;SP;1;A;c;1;N;10,00;x\n")
    P.ingest_bronze(spark, lay, [(2023, 1)])
    K.delete_path(spark, f"{lay.bronze}/{K.COLUMNS_DIR}")
    assert [r["LOTE"] for r in P.scan_periods(spark, lay.bronze, [(2023, 1)]).collect()] == ["x"]


def test_funnel_counts_a_partition_once(spark, raw_fixture, tmp_path):
    """A finished map stage loses its output and runs again before its counts are read."""
    marks = str(tmp_path)

    def seen(batches):
        import uuid

        open(f"{marks}/run-{uuid.uuid4().hex}", "w").close()
        yield from batches

    def lose(batches):
        # the first reader deletes the shuffle files of the stage before; Spark then runs that again
        import os as o
        import glob as g

        if not o.path.exists(f"{marks}/lost"):
            open(f"{marks}/lost", "w").close()
            for d in dirs:
                for f in g.glob(f"{d}/*/shuffle_*"):
                    o.remove(f)
        yield from batches

    # of this session only
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    dirs = [d.getPath() for d in blocks.localDirs()]
    want = S.fates(raw_fixture, [(2021, 4)]).first()
    rows = raw_fixture.repartition(4).mapInArrow(seen, raw_fixture.schema)
    twice = rows.repartition(3).mapInArrow(lose, raw_fixture.schema).repartition(2)
    assert S.fates(twice, [(2021, 4)]).first() == want
    assert P.funnel_counts(raw_fixture, [(2021, 4)], 2).as_dict() == {
        "raw": want["raw"], "foreign_period": want["foreign_period"], "invalid": want["invalid"], "nulls": want["nulls"],
        "duplicates": want["ok"] - 2, "kept": 2, "skipped_periods": [], "absent_periods": [],
    }
    assert len(glob.glob(f"{marks}/run-*")) >= 4 and os.path.exists(f"{marks}/lost")
    assert raw_fixture.select(F.count("*")).first()[0] == want["raw"]
