import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from quartermart.session import build_session

    wh = tmp_path_factory.mktemp("warehouse")
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": str(wh)})
    yield s
    s.stop()


VISIT_SCHEMA = ("blog_id string, trip_id string, travel_date date, travel_year int, travel_month int, "
                "travel_partners string, poi_id string")
POI_SCHEMA = ("poi_id string, name string, city string, latitude double, longitude double, "
              "label array<string>, category string, region string")


def visits_df(spark, rows):
    """rows: (blog_id, 'YYYY-MM-DD', partner, poi_id[, trip_suffix]) -> visit fact frame."""
    out = []
    for r in rows:
        blog, day, partner, poi = r[:4]
        d = dt.date.fromisoformat(day)
        trip = f"{blog}_{d.year}/{d.month}/{d.day}" + (r[4] if len(r) > 4 else "")
        out.append((blog, trip, d, d.year, d.month, partner, poi))
    return spark.createDataFrame(out, VISIT_SCHEMA)


def poi_df(spark, rows):
    """rows: (poi_id, city, category, region) -> POI dimension frame."""
    return spark.createDataFrame(
        [(p, f"name{p}", city, 30.0, 110.0, ["x"], cat, reg) for p, city, cat, reg in rows], POI_SCHEMA)
