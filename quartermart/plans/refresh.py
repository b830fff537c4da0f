"""Incremental refresh: arriving raw trips change only the partitions they reach.

State kept between loads, beside the layer tables: the deduplicated trips,
partitioned by (year, month). A trip's copies have one date, hence one month, and
the smallest partner of smallest partners is the smallest, so arriving trips are
merged with those of their months alone.

* Visits: the months of the arriving trips are rewritten.
* User mart: their quarters are rewritten, from those quarters' visits.
* Attraction and city marts: counts and ranks belong to one quarter, so theirs are
  rewritten from visits. Growth looks back to the entity's previous quarter
  present, so an arriving quarter changes it in the entity's next one, wherever
  that is. It is taken again over the mart's own rows (no visits), and quarters in
  which a rate or flag came out differently are rewritten too.
* Portraits: users with rows in a rewritten quarter, before or after, are computed
  from their mart rows; all other users' portraits are taken over.
* Leaderboards are filters on the mart and are written whole.

    python -m quartermart.plans.refresh --root DIR                       # once, after a full run
    python -m quartermart.plans.refresh --root DIR --trips ARRIVING.csv

Everything else keeps its files (``versions.publish(replace=...)``). A changed POI
dimension may change every quarter: it takes a full run.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartermart.functions import constants as K
from quartermart.operators import clean
from quartermart.operators.growth import growth
from quartermart.operators.join import persisted
from quartermart.plans import warehouse as W
from quartermart.plans.attraction_quarter import attraction_quarter
from quartermart.plans.city_quarter import CITY, city_quarter
from quartermart.plans.portrait import user_portrait
from quartermart.plans.user_quarter import user_quarter
from quartermart.plans.visits import VISIT_COLUMNS, add_trip_id, dedupe_trips, prepared_trips
from quartermart.sources import schemas, sinks, versions
from quartermart.sources.raw import scan_trip_csv

GROWTH = ["user_cnt_growth_rate", "is_hot_rising"]
TRIP_COLUMNS = ["blog_id", "departure_date", "visit_sequence", "travel_partners", "travel_date", "travel_year", "travel_month"]


def _keys(df: DataFrame, cols: Sequence[str]) -> list[tuple]:
    """Distinct partition values: at most a few hundred, by the length of the calendar."""
    return sorted(tuple(r) for r in df.select(*cols).distinct().collect())


def _in(cols: Sequence[str], keys: list[tuple]) -> Column:
    """Whether a row lies in one of the partitions ``keys``: a filter that prunes."""
    cond = F.lit(False)
    for key in keys:
        part = F.lit(True)
        for c, v in zip(cols, key, strict=True):
            part = part & (F.col(c) == v)
        cond = cond | part
    return cond


def merge_trips(spark: SparkSession, arriving: DataFrame, cfg: W.Config) -> list[tuple]:
    """Merge raw ``arriving`` trips into the kept ones; the (year, month) partitions that changed."""
    new = prepared_trips(arriving)
    new = clean.in_range(new, {"travel_year": cfg.years}, upper_inclusive=False).select(*TRIP_COLUMNS)
    months = _keys(new, W.MONTH_PARTITION)
    old = W._read(spark, cfg, cfg.tables.dwd_trip).where(_in(W.MONTH_PARTITION, months))
    merged = dedupe_trips(old.select(*TRIP_COLUMNS).unionByName(new))
    W._write(schemas.conform(merged, schemas.DWD_TRIP), cfg, cfg.tables.dwd_trip, schemas.DWD_TRIP, partition_by=W.MONTH_PARTITION, replace=months)
    return months


def visits_of(trips: DataFrame) -> DataFrame:
    """Visit rows of deduplicated trips."""
    rows = add_trip_id(trips).select(*VISIT_COLUMNS[:-1], "visit_sequence")
    return clean.explode_list(rows, "visit_sequence", "poi_id", K.LIST_SEPARATOR).select(*VISIT_COLUMNS)


def start(spark: SparkSession, cfg: W.Config) -> None:
    """Write the kept trips from the raw layer; once, after a full run."""
    trips = prepared_trips(W._read(spark, cfg, cfg.tables.ods_trip))
    trips = dedupe_trips(clean.in_range(trips, {"travel_year": cfg.years}, upper_inclusive=False))
    W._write(schemas.conform(trips, schemas.DWD_TRIP), cfg, cfg.tables.dwd_trip, schemas.DWD_TRIP, partition_by=W.MONTH_PARTITION)


def _refresh_mart(spark: SparkSession, cfg: W.Config, table: str, schema, fresh: DataFrame, quarters: list[tuple], entity: Sequence[str], metric: str) -> None:
    """Replace ``quarters`` of a mart by ``fresh``, and growth wherever it looks back on them."""
    by = W.QUARTER_PARTITION
    before = W._read(spark, cfg, table)
    # growth is null-free in a written mart, so a null old value marks a fresh row
    none = {f"_old_{f.name}": F.lit(None).cast(f.dataType) for f in schema.fields if f.name in GROWTH}
    kept = before.where(~_in(by, quarters)).withColumnsRenamed({c: f"_old_{c}" for c in GROWTH})
    with persisted(fresh.drop(*GROWTH)) as counted:  # read twice: for the quarters that change and for their rows
        grown = growth(kept.unionByName(counted.withColumns(none)), entity, metric)
        other = F.lit(False)
        for c in GROWTH:
            other = other | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
        changed = sorted(set(quarters) | set(_keys(grown.where(other), by)))
        out = grown.where(_in(by, changed))
        W._write(schemas.conform(out, schema), cfg, table, schema, partition_by=by, replace=changed)


def refresh(spark: SparkSession, arriving: DataFrame, cfg: W.Config = W.Config()) -> list[tuple]:
    """Bring every layer up to date with the raw trips ``arriving``; the quarters that were rewritten from visits.

    ``arriving`` has the columns of the raw trip table and is added to it first; what follows reads it from there, so it
    is computed once. A run that broke off is mended by running it again: trips that were merged already change nothing
    but the raw table.
    """
    t, by = cfg.tables, W.QUARTER_PARTITION
    commit = W._write(schemas.conform(arriving, schemas.ODS_TRIP), cfg, t.ods_trip, schemas.ODS_TRIP, append=True)
    arriving = versions.added(spark, sinks.location(t.ods_trip, cfg.root), commit)
    months = merge_trips(spark, arriving, cfg)
    if not months:
        return []
    trips = W._read(spark, cfg, t.dwd_trip).where(_in(W.MONTH_PARTITION, months))
    W._write(schemas.conform(visits_of(trips), schemas.DWD_VISIT), cfg, t.dwd_visit, schemas.DWD_VISIT, partition_by=W.MONTH_PARTITION, replace=months)
    quarters = sorted({(y, (m + 2) // 3) for y, m in months})
    in_quarters = [(y, m) for y, q in quarters for m in (3 * q - 2, 3 * q - 1, 3 * q)]
    visits = W._read(spark, cfg, t.dwd_visit).where(_in(W.MONTH_PARTITION, in_quarters))
    poi = W._read(spark, cfg, t.dwd_poi)
    _refresh_mart(spark, cfg, t.dws_attraction, schemas.DWS_ATTRACTION_QUARTER,
                  attraction_quarter(visits, poi, cfg.broadcast, rank_form=cfg.rank_form), quarters, ["poi_id"], "visit_user_cnt")
    _refresh_mart(spark, cfg, t.dws_city, schemas.DWS_CITY_QUARTER,
                  city_quarter(visits, poi, cfg.broadcast, rank_form=cfg.rank_form), quarters, CITY, "visit_trip_cnt")
    # users only gain rows: trips are merged, never taken out
    users = visits.select("blog_id").distinct()
    W._write(user_quarter(visits, poi, cfg.broadcast, cfg.categories.unclassified), cfg, t.dws_user, schemas.DWS_USER_QUARTER,
             partition_by=by, replace=quarters)
    mart = W._read(spark, cfg, t.dws_user).join(users, "blog_id", "left_semi")
    others = W._read(spark, cfg, t.ads_portrait).join(users, "blog_id", "left_anti")
    W._write(others.unionByName(user_portrait(mart)), cfg, t.ads_portrait, schemas.ADS_USER_PORTRAIT)
    W.job_top_attractions(spark, cfg)
    W.job_top_cities(spark, cfg)
    return quarters


def main(argv=None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--trips", help="CSV files of arriving trips (with header); without, the state for later refreshes is written")
    cfg, a, spark = W.configured(p, argv)
    if a.trips:
        good, bad = scan_trip_csv(spark, a.trips)
        refresh(spark, good, cfg)
        rejects = schemas.conform(bad.withColumn("source", F.lit("trip")), schemas.ODS_REJECT)
        W._write(rejects, cfg, cfg.tables.ods_reject, schemas.ODS_REJECT, append=True)
    else:
        start(spark, cfg)


if __name__ == "__main__":
    main()
