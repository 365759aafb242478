"""Raw CSV layouts (S1-S4, S11), read back through the production readers."""

import os

import pytest
from pyspark.sql import functions as F

from tripkpi.plans import layouts as L
from tripkpi.sources import csv_layouts as CSV
from tripkpi.sources.landing import landing_manifest, list_landing, month_spine, split_year_parts
from tripkpi.sources.stations import read_station_master

NEW_HEADER = ('"tripduration","starttime","stoptime","start station id","start station name",'
              '"start station latitude","start station longitude","end station id","end station name",'
              '"end station latitude","end station longitude","bikeid","usertype","birth year","gender"')


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def new_row(dur, start, stop, sid="1", eid="2", birth="1980", gender="1", bike="B1"):
    return (f'"{dur}","{start}","{stop}","{sid}","Stat {sid}","42.35","-71.06","{eid}","Stat {eid}",'
            f'"42.36","-71.09","{bike}","Subscriber","{birth}","{gender}"')


@pytest.fixture()
def new_base(tmp_path):
    base = str(tmp_path / "new")
    write(f"{base}/201601/data.csv", "\n".join([
        NEW_HEADER,
        new_row(600, "2016-01-01 08:00:00", "2016-01-01 08:10:00", birth="\\N", gender="\\N"),
        NEW_HEADER,                                           # header repeated mid-file (cat-merged)
        new_row(59, "2016-01-02 09:00:00", "2016-01-02 09:00:59"),   # 0.98 min -> dropped
    ]) + "\n")
    # same columns, another order: must be read by name, not by position
    cols = [c.strip('"') for c in NEW_HEADER.split(",")]
    order = list(reversed(cols))
    vals = dict(zip(cols, [c.strip('"') for c in new_row(1200, "2016-02-03 19:30:00", "2016-02-03 19:50:00",
                                                         sid="7", eid="8", birth="0", gender="2").split(",")]))
    write(f"{base}/201602/data.csv", ",".join(order) + "\n" + ",".join(vals[c] for c in order) + "\n")
    write(f"{base}/2016/data.csv", NEW_HEADER + "\n")          # not a yyyyMM folder
    write(f"{base}/201603/other.csv", NEW_HEADER + "\n" + new_row(600, "2016-03-01 08:00:00",
                                                                   "2016-03-01 08:10:00") + "\n")
    return base


def test_new_layout_scan_by_name(spark, new_base):
    raw = CSV.scan_new_layout(spark, new_base)
    data = raw.filter(F.col("dur_raw") != "tripduration").collect()
    assert {r.period for r in data} == {"201601", "201602"}   # other folder / file names ignored
    rows = {r.dur_raw: r for r in data}
    feb = rows["1200"]
    assert feb.period == "201602"
    assert feb.start_station_id == "7" and feb.end_station_id == "8" and feb.gender_raw == "2"
    assert rows["600"].birth_year_raw == "\\N"          # quoted \N arrives as \N


def test_new_layout_clean(spark, new_base):
    clean = L.read_and_clean_new(spark, new_base).orderBy("trip_start_ts").collect()
    assert len(clean) == 2                               # header row and 0.98-min trip dropped
    jan, feb = clean
    assert (jan.year, jan.month, jan.birth_year, jan.gender) == (2016, 1, None, None)
    assert (feb.year, feb.month, feb.birth_year, feb.gender) == (2016, 2, None, 2)
    assert jan.trip_duration_min == 10.0 and feb.time_slot == "18:00-24:00"
    assert 2600 < jan.trip_distance_m < 2800


def test_headers_known_mode_fails_loudly_on_reorder(spark, new_base):
    df = CSV.scan_new_layout(spark, new_base, headers_known=True)
    with pytest.raises(Exception):
        df.collect()            # a read that parses columns hits the reordered header


def test_no_folders_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        CSV.scan_new_layout(spark, str(tmp_path / "nothing"))


def test_missing_required_column(spark, tmp_path):
    base = str(tmp_path / "bad")
    write(f"{base}/201601/data.csv", "tripduration,starttime,stoptime\n1,2,3\n")
    with pytest.raises(ValueError, match="missing required columns"):
        CSV.scan_new_layout(spark, base)


def test_two_headers_in_one_file(spark, tmp_path):
    base = str(tmp_path / "two")
    cols = [c.strip('"') for c in NEW_HEADER.split(",")]
    write(f"{base}/201601/data.csv", ",".join(cols) + "\n" + ",".join(reversed(cols)) + "\n")
    with pytest.raises(ValueError, match="different header"):
        CSV.scan_new_layout(spark, base)


OLD_HEADER = ("Seq,Duration,Start date,Start station number,Start station name,End date,"
              "End station number,End station name,Bike number,Member type,Gender")


def test_old_layout_with_stations(spark, tmp_path):
    base = str(tmp_path / "old")
    write(f"{base}/2011/data.csv", "\n".join([
        OLD_HEADER,
        "1,600000,7/28/2011 10:12,1,A,7/28/2011 10:22,2,B,B00468,Registered,1",
        "2,600000,7/28/2011 10:12,1,A,7/28/2011 10:22,9,Z,B00469,Registered,\\N",   # unknown station
        "3,600000,12/31/2011 23:59,3,C,1/1/2012 0:09,2,B,B00470,Casual,",        # lat 95 station
    ]) + "\n")
    write(f"{base}/stations/s.csv", "Station ID,Station,Latitude,Longitude\n"
          "1,A,42.35,-71.06\n2,B,42.36,-71.09\n3,C,95,-71.0\n")
    stations = read_station_master(spark, f"{base}/stations")
    assert stations.count() == 2
    clean = L.clean_old(CSV.scan_old_layout(spark, base), stations).collect()
    assert len(clean) == 1
    t = clean[0]
    assert (t.year, t.month, t.birth_year, t.gender, t.bike_id) == (2011, 7, None, 1, "B00468")
    assert t.trip_duration_min == 10.0 and str(t.trip_start_ts) == "2011-07-28 10:12:00"


def test_split_year_parts(spark, tmp_path):
    land = str(tmp_path / "landing")
    rows = "1,600000,7/28/2011 10:12,1,A,7/28/2011 10:22,2,B,B1,Registered,1\n"
    write(f"{land}/hubway_Trips_2011_1.csv", OLD_HEADER + "\n" + rows)
    write(f"{land}/hubway_Trips_2011_2.csv", OLD_HEADER + "\n" + rows + rows)
    write(f"{land}/hubway_Trips_2012.csv", OLD_HEADER + "\n" + rows)
    raw = CSV.scan_split_years(spark, f"{land}/hubway_Trips_*_*.csv")
    got = {r.period: r.n for r in raw.groupBy("period").agg(F.count("*").alias("n")).collect()}
    assert got == {"2011": 3}                       # both parts, no header rows kept
    parts = split_year_parts(list_landing(spark, land)).collect()
    assert sorted(r.file_name for r in parts) == ["hubway_Trips_2011_1.csv", "hubway_Trips_2011_2.csv"]


def test_landing_manifest_and_spine(spark, tmp_path):
    land = str(tmp_path / "landing2")
    for name in ["201601-hubway-tripdata.csv", "2016011-hubway-tripdata.csv", "hubway_Trips_2011.csv",
                 "hubway_Trips_2011.csv.bak", "hubway_Trips_2012_1.csv", "notes.csv"]:
        write(f"{land}/{name}", "x\n")
    m = {r.file_name: r for r in landing_manifest(list_landing(spark, land, "*")).collect()}
    assert set(m) == {"201601-hubway-tripdata.csv", "hubway_Trips_2011.csv"}
    assert m["201601-hubway-tripdata.csv"].target == "/data/bikesharing/raw/201601/data.csv"
    assert (m["hubway_Trips_2011.csv"].layout, m["hubway_Trips_2011.csv"].period) == ("old", "2011")
    spine = month_spine(spark.createDataFrame([(2011,), (2011,)], "year int")).collect()
    assert [r.period for r in sorted(spine, key=lambda r: r.period)] == [f"2011{m:02d}" for m in range(1, 13)]


def test_file_without_header_is_an_error(spark, tmp_path):
    base = str(tmp_path / "nohdr")
    write(f"{base}/201601/data.csv", NEW_HEADER + "\n" + new_row(600, "2016-01-01 08:00:00",
                                                               "2016-01-01 08:10:00") + "\n")
    write(f"{base}/201602/data.csv", new_row(600, "2016-02-01 08:00:00", "2016-02-01 08:10:00") + "\n")
    with pytest.raises(ValueError, match="without a new-layout header"):
        CSV.scan_new_layout(spark, base)


def test_headers_known_single_pass_on_uniform_files(spark, tmp_path):
    base = str(tmp_path / "uniform")
    for m in ("201601", "201602"):
        write(f"{base}/{m}/data.csv", NEW_HEADER + "\n" + new_row(600, f"{m[:4]}-{m[4:]}-01 08:00:00",
                                                                   f"{m[:4]}-{m[4:]}-01 08:10:00") + "\n")
    fast = L.clean_new(CSV.scan_new_layout(spark, base, headers_known=True))
    slow = L.clean_new(CSV.scan_new_layout(spark, base))
    assert fast.count() == 2 and fast.exceptAll(slow).count() == 0


def test_folder_names_with_spaces(spark, tmp_path):
    base = str(tmp_path / "raw data dir")
    write(f"{base}/201601/data.csv", NEW_HEADER + "\n" + new_row(600, "2016-01-01 08:00:00",
                                                               "2016-01-01 08:10:00") + "\n")
    assert L.clean_new(CSV.scan_new_layout(spark, base)).count() == 1


def test_other_header_deep_in_a_file_fails_the_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(CSV, "FIRST_LINES", 3)
    base = str(tmp_path / "deep")
    row = new_row(600, "2016-01-01 08:00:00", "2016-01-01 08:10:00")
    other = ",".join(reversed(NEW_HEADER.split(",")))
    write(f"{base}/201601/data.csv", "\n".join([NEW_HEADER, *[row] * 9, other, row]) + "\n")
    with pytest.raises(Exception, match="different header line inside"):
        CSV.scan_new_layout(spark, base).collect()
    write(f"{base}/201601/data.csv", "\n".join([NEW_HEADER, *[row] * 9, NEW_HEADER, row]) + "\n")
    assert CSV.scan_new_layout(spark, base).count() == 10


def test_one_native_scan_per_header_and_no_copy(spark, new_base, tmp_path):
    import contextlib
    import io

    def scans(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        text = out.getvalue().split("\n\n")[0]
        return text.count("Scan csv"), text.count("Scan text") + text.count("Scan parquet")

    assert scans(CSV.scan_new_layout(spark, new_base)) == (2, 0)
    base = str(tmp_path / "one")
    for m in ("201601", "201602"):
        write(f"{base}/{m}/data.csv", NEW_HEADER + "\n" + new_row(600, "2016-01-01 08:00:00", "2016-01-01 08:10:00") + "\n")
    assert scans(CSV.scan_new_layout(spark, base)) == (1, 0)


def test_index_reads_first_lines_of_many_files(spark, tmp_path):
    base = str(tmp_path / "odd [names] {x}, 100%")
    cols = NEW_HEADER.split(",")
    row = new_row(600, "2016-01-01 08:00:00", "2016-01-01 08:10:00").split(",")
    for k in range(12):                                       # three column orders, blank first lines, long files
        turn = k % 3
        order = cols[turn:] + cols[:turn]
        vals = row[turn:] + row[:turn]
        write(f"{base}/2016{k + 1:02d}/data.csv", "\n" * (k % 2) + "\n".join([",".join(order), *[",".join(vals)] * 3000]) + "\n")
    escaped = base.replace("[", "\\[").replace("]", "\\]").replace("{", "\\{").replace("}", "\\}")
    raw = CSV.scan_new_layout(spark, escaped)
    got = raw.groupBy("dur_raw", "bike_id", "gender_raw").count().collect()
    assert [tuple(r) for r in got] == [("600", "B1", "1", 36_000)]
    assert raw.select("period").distinct().count() == 12
