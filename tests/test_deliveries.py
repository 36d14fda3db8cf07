"""Months are skipped by what their files hold."""

import os

import pytest

from ledgerline.plans import pipeline as P
from ledgerline.plans.deliveries import compare_deliveries, redelivered
from ledgerline.schemas import RAW_COLUMNS
from ledgerline.settings import Layout

MONTHS = [(2022, m) for m in range(1, 7)]


def _put(land, month, name, people, extra=None):
    folder = f"{land}/competencia={month[0] * 100 + month[1]}"
    os.makedirs(folder, exist_ok=True)
    rows = [f"{month[0] * 100 + month[1]};SP;1;A;c;{n};N;{n},00" + (f";{extra}" if extra else "") for n in people]
    with open(f"{folder}/{name}", "w", encoding="latin-1") as f:
        f.write("\n".join([";".join([*RAW_COLUMNS, *(["LOTE"] if extra else [])]), *rows]) + "\n")


@pytest.fixture()
def lay(tmp_lake):
    lay = Layout(root=tmp_lake)
    land = lay.landing.removeprefix("file:")
    for month in MONTHS[:5]:
        _put(land, month, "a.csv", range(1, 6))
        _put(land, month, "b.csv", range(6, 9), extra="x" if month[1] == 5 else None)
        _put(land, month, "header.csv", [])
    return lay


def _states(df):
    return {(r["mes"], r["_file_name"]): r["state"] for r in df.collect()}


def _runs(spark, lay):
    df = spark.read.parquet(lay.bronze)
    return {(r["mes"], r["_file_name"]): (r["_ingested_at"], r["count"]) for r in df.groupBy("mes", "_file_name", "_ingested_at").count().collect()}


@pytest.mark.parametrize("mode", ["rows", "tree", "md5"])
def test_changed_added_and_removed_files(spark, lay, mode):
    land = lay.landing.removeprefix("file:")
    P.ingest_bronze(spark, lay, MONTHS, file_hash=mode)
    assert set(_states(compare_deliveries(spark, lay, MONTHS, file_hash=mode)).values()) == {"same"}
    first = _runs(spark, lay)

    _put(land, (2022, 1), "b.csv", [6, 7, 9])  # as many rows as before
    _put(land, (2022, 2), "c.csv", [40])
    os.remove(f"{land}/competencia=202203/b.csv")
    _put(land, (2022, 6), "a.csv", [1])  # not stored yet
    states = _states(compare_deliveries(spark, lay, MONTHS[:5], file_hash=mode))
    odd = {(1, "b.csv"): "changed", (2, "c.csv"): "added", (3, "b.csv"): "removed"}
    assert {k: v for k, v in states.items() if v != "same"} == odd and len(states) == 11

    P.ingest_bronze(spark, lay, MONTHS, file_hash=mode, by_content=True)
    now = _runs(spark, lay)
    assert {m for m, _ in now if any(now[k] != first.get(k) for k in now if k[0] == m)} == {1, 2, 3, 6}
    assert now[(2, "c.csv")][1] == 1 and (3, "b.csv") not in now and now[(6, "a.csv")][1] == 1
    assert all(now[k] == first[k] for k in now if k[0] in (4, 5))
    assert redelivered(spark, lay, MONTHS, file_hash=mode) == set()


def test_nothing_is_written_for_untouched_months(spark, lay):
    P.ingest_bronze(spark, lay, MONTHS)
    root = lay.bronze.removeprefix("file:")
    listing = lambda: sorted((d, f, os.path.getmtime(os.path.join(d, f))) for d, _, fs in os.walk(root) for f in fs)
    before = listing()
    got = P.ingest_bronze(spark, lay, MONTHS, by_content=True)
    assert listing() == before and got.count() == 40


def test_the_months_read_along_do_not_matter(spark, lay):
    """Only May has another column; alone or together, its and the others' fingerprints are the same."""
    for part in (MONTHS[:2], MONTHS[2:]):
        P.ingest_bronze(spark, lay, part)
    for part in (MONTHS, MONTHS[1:3], MONTHS[4:5]):
        assert redelivered(spark, lay, part) == set()


def test_other_or_no_fingerprints_count_as_changed(spark, lay):
    P.ingest_bronze(spark, lay, MONTHS[:1], file_hash=None)
    P.ingest_bronze(spark, lay, MONTHS[1:2], file_hash="tree")
    assert redelivered(spark, lay, MONTHS) == set(MONTHS[:2])
    with pytest.raises(ValueError, match="by_content"):
        P.ingest_bronze(spark, lay, MONTHS, file_hash=None, by_content=True)


def test_months_not_landed_again_stay(spark, lay, tmp_lake):
    from dataclasses import replace

    P.ingest_bronze(spark, lay, MONTHS)
    other = replace(lay, landing_dir=tmp_lake + "/other")
    _put(other.landing.removeprefix("file:"), (2022, 2), "a.csv", range(1, 6))
    assert redelivered(spark, other, [(2022, 2)]) == {(2022, 2)}  # b.csv is gone
    P.run(spark, other, MONTHS, layers=("bronze",), by_content=True)
    assert {m for m, _ in _runs(spark, lay)} == {1, 2, 3, 4, 5}
