from ledgerline.settings import Layout
from ledgerline.streaming.landing import run_available

from test_sources_sinks import _land


def test_incremental_runs_process_new_files_once(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    _land(lay.landing, "202301", ["202301;SP;1;A;c;1;N;10,00", "202301;SP;1;A;c;2;N;20,00"])
    _land(lay.landing, "202302", ["202302;RJ;2;B;c;3;N;30,00"])
    ckpt = tmp_lake + "/ckpt"
    run_available(spark, lay, checkpoint=ckpt)
    bronze = spark.read.parquet(lay.bronze)
    assert bronze.count() == 3
    first_ts = {r["_ingested_at"] for r in bronze.filter("mes = 1").collect()}

    _land(lay.landing, "202403", ["202403;MG;3;C;c;4;N;40,00", "202403;MG;3;C;c;5;N;40,00"])
    run_available(spark, lay, checkpoint=ckpt)
    bronze = spark.read.parquet(lay.bronze)
    assert bronze.count() == 5
    # January was not landed again, so it was not rebuilt
    assert {r["_ingested_at"] for r in bronze.filter("mes = 1").collect()} == first_ts
    assert spark.read.parquet(lay.silver).count() == 5
    # Gold keeps 2023 while 2024 arrives; the change crosses the year boundary
    serie = {r["ano_mes"]: r for r in spark.read.parquet(lay.gold("serie_temporal_brasil")).collect()}
    assert sorted(serie) == ["2023-01", "2023-02", "2024-03"]
    assert serie["2024-03"]["variacao_pct"] == 100.0  # 2 vs 1 beneficiary in 2023-02
    uf = spark.read.parquet(lay.gold("transferencias_por_uf_mes"))
    assert sorted({r["ano"] for r in uf.collect()}) == [2023, 2024]


def test_second_file_for_a_month_rebuilds_the_whole_month(spark, tmp_lake):
    lay = Layout(root=tmp_lake)
    _land(lay.landing, "202301", ["202301;SP;1;A;c;1;N;10,00"], name="a.csv")
    ckpt = tmp_lake + "/ckpt"
    run_available(spark, lay, checkpoint=ckpt, layers=("bronze",))
    _land(lay.landing, "202301", ["202301;SP;1;A;c;2;N;20,00"], name="b.csv")
    run_available(spark, lay, checkpoint=ckpt, layers=("bronze",))
    assert spark.read.parquet(lay.bronze).count() == 2


def test_months_of_many_batches_are_rebuilt_once(spark, tmp_lake, monkeypatch):
    from ledgerline.plans import pipeline as P
    from ledgerline.streaming import landing as L

    lay = Layout(root=tmp_lake)
    for i in range(6):
        _land(lay.landing, "202301", [f"202301;SP;1;A;c;{i};N;10,00"], name=f"{i}.csv")
    calls, run = [], P.run
    monkeypatch.setattr(L.P, "run", lambda spark, layout, months, **k: calls.append(months) or run(spark, layout, months, **k))
    run_available(spark, lay, checkpoint=tmp_lake + "/ckpt", max_files_per_trigger=1)
    assert calls == [[(2023, 1)]] and spark.read.parquet(lay.silver).count() == 6
    assert run_available(spark, lay, checkpoint=tmp_lake + "/ckpt") is None


def test_a_run_that_died_is_made_up_for(spark, tmp_lake, monkeypatch):
    from ledgerline.streaming import landing as L

    lay = Layout(root=tmp_lake)
    _land(lay.landing, "202301", ["202301;SP;1;A;c;1;N;10,00"])
    with monkeypatch.context() as m:
        m.setattr(L.P, "run", lambda *a, **k: 1 / 0)
        try:
            run_available(spark, lay, checkpoint=tmp_lake + "/ckpt")
        except ZeroDivisionError:
            pass
    run_available(spark, lay, checkpoint=tmp_lake + "/ckpt")  # no new file, but the month is still noted
    assert spark.read.parquet(lay.bronze).count() == 1
