"""Benchmark: the warehouse jobs, layer by layer, on one scale factor.

Runs the warehouse the way it is deployed: every job reads the tables of the
previous layer and writes its own table (Parquet, checked schema), so each
job is timed from its input tables to its written output:

    C1 ods_load            headered CSV files (written beforehand) -> raw ods tables
    C2 poi_clean           ods -> dwd POI dimension
    C3 visits_clean        ods -> dwd visit fact (partitioned by year, month)
    C4 user_quarter        dwd -> dws user x quarter (partitioned by year, quarter)
    C5 attraction_quarter  dwd -> dws attraction x quarter
    C6 city_quarter        dwd -> dws city x quarter
    C7 user_portrait       dws -> ads portrait
    C8 top50_attractions   dws -> ads leaderboard
    C9 city_top10          dws -> ads leaderboard

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WARM_DIR (default the sibling sf0.01: the whole run is done there once
first, so JIT and generated code are warm), BENCH_REPEAT (default 2: the
layered run is repeated and each job reports its best time, which damps the
run-to-run noise of a shared machine). Tables go to a fresh scratch
warehouse under /tmp. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def jobs(spark, sf_dir, cfg, csv):
    """(name, run) of every job; the raw layer is loaded from CSV files, written beforehand under ``csv``."""
    from quartermart.plans import warehouse as W
    from quartermart.sources import binding

    for name, frame in (("poi", binding.raw_poi), ("trip", binding.raw_trip)):
        frame(spark, sf_dir).write.option("header", True).csv(f"{csv}/{name}")
    return [
        ("ods_load", lambda: W.load_ods_csv(spark, f"{csv}/poi", f"{csv}/trip", cfg)),
        ("poi_clean", lambda: W.job_poi(spark, cfg)),
        ("visits_clean", lambda: W.job_visits(spark, cfg)),
        ("user_quarter", lambda: W.job_user_quarter(spark, cfg)),
        ("attraction_quarter", lambda: W.job_attraction_quarter(spark, cfg)),
        ("city_quarter", lambda: W.job_city_quarter(spark, cfg)),
        ("user_portrait", lambda: W.job_portrait(spark, cfg)),
        ("top50_attractions", lambda: W.job_top_attractions(spark, cfg)),
        ("city_top10", lambda: W.job_top_cities(spark, cfg)),
    ]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    warm_dir = os.environ.get("BENCH_WARM_DIR", os.path.join(os.path.dirname(sf_dir), "sf0.01"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    scratch = tempfile.mkdtemp(prefix="qm-bench-")
    from quartermart.plans import warehouse as W
    from quartermart.session import build_session
    from quartermart.sources import binding

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    cfg = W.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE)
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for _, run in jobs(spark, warm_dir, cfg, os.path.join(scratch, "csv-warm")):
            run()
    took: dict[str, list[float]] = {}
    todo = jobs(spark, sf_dir, cfg, os.path.join(scratch, "csv"))
    for _ in range(repeat):
        for name, run in todo:
            t0 = time.perf_counter()
            run()
            took.setdefault(name, []).append(time.perf_counter() - t0)
    times = {name: round(median(x), 3) for name, x in took.items()}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "warehouse_jobs_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "spread": {name: [round(min(x), 3), round(max(x), 3)] for name, x in took.items()},
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
