"""Raw CSV folders: differing headers, malformed rows, the reject table."""

import pytest

from quartermart.functions import constants as K
from quartermart.plans import warehouse as W
from quartermart.sources import raw, sinks

HEADER = list(K.TRIP_HEADER_RENAMES)


def put(path, header, *lines):
    path.write_text("\n".join([",".join(header), *lines]) + "\n", encoding="utf-8")


def test_two_header_orders_in_one_folder(spark, tmp_path):
    put(tmp_path / "a.csv", HEADER, "b1,2016/3/3,2016/3/4,Solo,e1;e2")
    put(tmp_path / "b.csv", ["Extra", *HEADER[::-1]], "x,e3,Family,2017/3/4,2017/3/3,b2")
    got = sorted(map(tuple, raw.read_trip_csv(spark, str(tmp_path)).collect()))
    assert got == [("b1", "2016/3/3", "2016/3/4", "Solo", "e1;e2"), ("b2", "2017/3/3", "2017/3/4", "Family", "e3")]


def test_malformed_rows_are_kept_with_reason_and_file(spark, tmp_path):
    good = '"b 1, ""x""",2016/3/3,2016/3/4,"So,lo",e1'
    bad = {"short": "b2,2016/3/3", "long": "b3,1,2,3,4,5", "quote": 'b4,"2016/3/3,2016/3/4,Solo,e1'}
    put(tmp_path / "a.csv", HEADER, good, *bad.values(), "")
    rows, rejects = raw.scan_trip_csv(spark, str(tmp_path))
    assert [(r.departure_date, r.travel_partners) for r in rows.collect()] == [("2016/3/4", "So,lo")]
    got = rejects.collect()
    assert {r.reason: r.line for r in got} == bad and all(r.file.endswith("a.csv") for r in got)
    assert rejects.count() == 3 and rejects.select("reason").distinct().count() == 3


@pytest.mark.parametrize(("header", "error"), [(HEADER[1:], HEADER[0]), ([*HEADER, HEADER[0]], "twice")])
def test_a_file_without_the_columns_raises(spark, tmp_path, header, error):
    put(tmp_path / "a.csv", HEADER, "b1,2016/3/3,2016/3/4,Solo,e1")
    put(tmp_path / "b.csv", header, "x")
    with pytest.raises(ValueError, match=error):
        raw.read_trip_csv(spark, str(tmp_path))


def test_files_without_headers_raise(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw, "MAX_HEADERS", 2)
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text(f"b{k},1,2,3,4\n", encoding="utf-8")
    with pytest.raises(ValueError, match="do the files have one"):
        raw.headers(spark, str(tmp_path))


def test_byte_order_mark_and_carriage_returns(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbf" + (",".join(HEADER) + "\r\nb1,2016/3/3,2016/3/4,Solo,e1\r\n").encode())
    assert list(raw.headers(spark, str(tmp_path))) == [",".join(HEADER)]
    assert tuple(raw.read_trip_csv(spark, str(tmp_path)).first()) == ("b1", "2016/3/3", "2016/3/4", "Solo", "e1")


def test_the_load_writes_a_reject_table(spark, tmp_path):
    put(tmp_path / "poi.csv", list(K.POI_HEADER_RENAMES), "e1,n,n,c,c,1,2,l,l", "e2,n")
    put(tmp_path / "trips.csv", HEADER, "b1,2016/3/3,2016/3/4,Solo,e1", "b2,1,2,3,4,5")
    cfg = W.Config(root=str(tmp_path / "layers"))
    W.load_ods_csv(spark, str(tmp_path / "poi.csv"), str(tmp_path / "trips.csv"), cfg)
    got = sorted((r.source, r.reason, r.line) for r in sinks.read_table(spark, cfg.tables.ods_reject, cfg.root).collect())
    assert got == [("poi", "short", "e2,n"), ("trip", "long", "b2,1,2,3,4,5")]
    assert sinks.read_table(spark, cfg.tables.ods_poi, cfg.root).count() == 1
