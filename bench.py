"""Benchmark on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Two groups are timed:

* the production flow as separate jobs over written tables: landing CSV ->
  Bronze (``bronze_ingest``), Bronze -> Silver (``silver_transform``),
  Silver -> three Gold tables (``gold_build``), reports and the quality
  gate over the stored tables;
* registered queries composed end to end from the test tables
  (``q_*``), executed in full into the ``noop`` sink.

Staging the landing files (the test feed written as monthly CSV files) is
done before timing starts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

COMPOSED = [
    "silver_dedup",
    "silver_funnel",
    "gold_por_uf_mes",
    "gold_top_municipios",
    "gold_serie_temporal",
    "report_q2",
    "report_q4",
    "dq_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ledgerline.operators import quality as Q
    from ledgerline.plans import catalog
    from ledgerline.plans import pipeline as P
    from ledgerline.plans import reports as RP
    from ledgerline.settings import Layout, work_dir
    from ledgerline.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="ledgerline-bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    landing = catalog.landed(spark, sf_dir)  # staging, not timed
    periods = catalog.all_periods(spark, landing)
    years = sorted({y for y, _ in periods})
    sink(catalog.queries()["gold_por_uf_mes"](spark, sf_dir))  # warm-up, not timed

    lay = Layout(root=work_dir(spark), landing_dir=landing)
    timed("bronze_ingest", lambda: P.ingest_bronze(spark, lay, periods, overwrite=True))
    timed("silver_transform", lambda: P.transform_silver(spark, lay, periods, overwrite=True))
    timed("gold_build", lambda: P.build_gold(spark, lay, years))
    gold = P.read_gold(spark, lay)
    uf, mun, serie = gold["transferencias_por_uf_mes"], gold["top_municipios_beneficios"], gold["serie_temporal_brasil"]
    reports = {
        "report_q1": lambda: RP.report_monthly(serie),
        "report_q2": lambda: RP.report_uf_latest(uf),
        "report_q3": lambda: RP.report_top_municipalities(mun),
        "report_q4": lambda: RP.report_regions(uf),
        "report_q5": lambda: RP.report_growth(serie),
        "report_q6": lambda: RP.report_ticket(uf),
    }
    for name, build in reports.items():
        timed(f"gold_{name}", lambda b=build: sink(b()))
    timed(
        "dq_on_tables",
        lambda: Q.assert_quality(
            Q.dq_report(spark.read.parquet(lay.bronze), spark.read.parquet(lay.silver), gold)
        ),
    )

    qs = catalog.queries()
    for name in COMPOSED:
        timed(f"q_{name}", lambda n=name: sink(qs[n](spark, sf_dir)))

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
