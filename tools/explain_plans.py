"""Print the formatted physical plan of every warehouse job (no job is run).

Usage: python tools/explain_plans.py [sf_dir] [job ...]

Builds the layer tables once on ``sf_dir`` (default sf0.001) in a scratch
warehouse, then prints ``explain("formatted")`` of each job's output frame as
it would be planned against those tables, followed by a one-line summary
(exchanges, broadcasts, scans).
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from quartermart import catalog as C
    from quartermart.plans import warehouse as W
    from quartermart.plans.attraction_quarter import attraction_quarter
    from quartermart.plans.city_quarter import city_quarter
    from quartermart.plans.leaderboards import top_attractions, top_cities
    from quartermart.plans.poi import clean_poi
    from quartermart.plans.portrait import user_portrait
    from quartermart.plans.user_quarter import user_quarter
    from quartermart.plans.visits import clean_visits
    from quartermart.session import build_session
    from quartermart.sources import binding

    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.001"
    only = [a for a in args if not a.startswith("/")]
    scratch = tempfile.mkdtemp(prefix="qm-explain-")
    spark = build_session(extra={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")})
    cfg = W.Config(categories=binding.TEST_CATEGORY_RULES, years=binding.TEST_YEAR_RANGE)
    W.load_ods(spark, C.ods_poi(spark, sf_dir), C.ods_trip(spark, sf_dir), cfg)
    W.run(spark, cfg)
    t = cfg.tables
    visits, poi = spark.table(t.dwd_visit), spark.table(t.dwd_poi)
    frames = {
        "poi_clean": lambda: clean_poi(spark.table(t.ods_poi), cfg.regions, cfg.categories),
        "visits_clean": lambda: clean_visits(spark.table(t.ods_trip), years=cfg.years),
        "user_quarter": lambda: user_quarter(visits, poi),
        "attraction_quarter": lambda: attraction_quarter(visits, poi),
        "city_quarter": lambda: city_quarter(visits, poi),
        "user_portrait": lambda: user_portrait(spark.table(t.dws_user)),
        "top50_attractions": lambda: top_attractions(spark.table(t.dws_attraction)),
        "city_top10": lambda: top_cities(spark.table(t.dws_city)),
    }
    for name, build in frames.items():
        if only and name not in only:
            continue
        df = build()
        print(f"\n===== {name} =====")
        df.explain("formatted")
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"-- {name}: exchanges={len(re.findall(r'Exchange (hash|range|Single|Round)', plan))} "
              f"broadcasts={plan.count('BroadcastExchange')} scans={plan.count('FileScan')}")
    spark.stop()


if __name__ == "__main__":
    main()
