"""Sources and sinks: raw CSV load with renames, layer databases, checked overwrite, partitioned tables."""

import csv

import pytest

from quartermart.functions import constants as K
from quartermart.sources import schemas, sinks
from quartermart.sources.raw import read_poi_csv, read_trip_csv


def _write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)


def test_raw_csv_all_text_and_renamed(spark, tmp_path):
    poi = tmp_path / "POIs_V2.csv"
    _write_csv(poi, list(K.POI_HEADER_RENAMES), [
        ["e1", "故宫", "Palace", "北京", "Beijing", "39.91", "116.39", "博物馆;古建筑", "museum"],
        ["e2", "西湖", "Lake", "杭州", "Hangzhou", "30.24", "120.15", "", ""],
    ])
    df = read_poi_csv(spark, str(poi))
    assert df.columns == list(K.POI_HEADER_RENAMES.values())
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)
    rows = {r.poi_id: r for r in df.collect()}
    assert rows["e1"].latitude == "39.91" and rows["e1"].label_zh == "博物馆;古建筑"
    assert rows["e2"].label_zh is None                 # empty CSV field is null

    trips = tmp_path / "Visit_Sequences_V2.csv"
    _write_csv(trips, list(K.TRIP_HEADER_RENAMES), [["b1", "2021/1/2", "2020/12/3", "Solo", "e1;e2"]])
    t = read_trip_csv(spark, str(trips)).first()
    assert (t.blog_id, t.departure_date, t.visit_sequence) == ("b1", "2020/12/3", "e1;e2")


def test_layers_and_checked_overwrite(spark):
    sinks.create_layers(spark)
    names = {r.namespace for r in spark.sql("SHOW DATABASES").collect()}
    assert {"ods", "dwd", "dws", "ads"} <= names
    df = spark.createDataFrame([("a", 2020, 1, 1), ("b", 2020, 2, 2), ("c", 2021, 1, 3)],
                               "k string, travel_year int, travel_quarter int, v long")
    sinks.overwrite_table(df, "dws.t_part", partition_by=["travel_year", "travel_quarter"])
    back = spark.table("dws.t_part")
    assert back.count() == 3
    assert back.filter("travel_year = 2020 AND travel_quarter = 2").count() == 1
    parts = spark.sql("SHOW PARTITIONS dws.t_part").count()
    assert parts == 3
    sinks.overwrite_table(df.filter("k = 'a'"), "dws.t_part", partition_by=["travel_year", "travel_quarter"])
    assert spark.table("dws.t_part").count() == 1     # full overwrite
    with pytest.raises(schemas.SchemaMismatch):
        sinks.overwrite_table(df, "ads.t_bad", schema=schemas.ADS_CITY_TOP)


def test_csv_columns_are_found_by_header(spark, tmp_path):
    header = list(K.TRIP_HEADER_RENAMES)
    row = dict(zip(header, ["b1", "2021/1/2", "2020/12/3", "Solo", "e1;e2"]))
    mixed = ["Extra", *reversed(header), "More"]
    _write_csv(tmp_path / "t.csv", mixed, [[row.get(h, "x") for h in mixed]])
    df = read_trip_csv(spark, str(tmp_path / "t.csv"))
    assert df.columns == list(K.TRIP_HEADER_RENAMES.values())
    assert tuple(df.first()) == tuple(row[h] for h in header)
    _write_csv(tmp_path / "m.csv", header[1:], [[row[h] for h in header[1:]]])
    with pytest.raises(ValueError, match=header[0]):
        read_trip_csv(spark, str(tmp_path / "m.csv"))


def test_tables_under_a_root_path(spark, tmp_path):
    df = spark.createDataFrame([("a", 2020), ("b", 2021)], "k string, travel_year int")
    sinks.overwrite_table(df, "dws.t_root", partition_by=["travel_year"], root=str(tmp_path))
    assert sinks.read_table(spark, "dws.t_root", str(tmp_path)).count() == 2
    sinks.overwrite_table(df.limit(1), "dws.t_root", partition_by=["travel_year"], root=str(tmp_path))
    assert sinks.read_table(spark, "dws.t_root", str(tmp_path)).count() == 1


def test_checkpoint_folder_is_required_beyond_local_masters():
    from types import SimpleNamespace

    from quartermart.session import ensure_checkpoint_dir
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"),
                              conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


def test_tables_carry_column_comments(spark, tmp_path):
    df = spark.createDataFrame([tuple([None] * len(schemas.ADS_CITY_TOP))], schemas.ADS_CITY_TOP)
    sinks.overwrite_table(df, "ads.t_comment", schemas.ADS_CITY_TOP)
    sinks.overwrite_table(df, "ads.t_comment", schemas.ADS_CITY_TOP, root=str(tmp_path))
    for back in (spark.table("ads.t_comment"), sinks.read_table(spark, "ads.t_comment", str(tmp_path))):
        assert back.schema["avg_spot_per_user"].metadata == {"comment": schemas.COMMENTS["avg_spot_per_user"]}
