"""End-to-end: the build-all job on literal CSV folders in both layouts."""

import os

from pyspark.sql import functions as F

from tripkpi.plans import jobs
from tripkpi.sinks.parquet import read_kpi_report
from tripkpi.sources.parquet import read_clean_trips

NEW_HEADER = ("tripduration,starttime,stoptime,start station id,start station name,start station latitude,"
              "start station longitude,end station id,end station name,end station latitude,"
              "end station longitude,bikeid,usertype,birth year,gender")
OLD_HEADER = ("Seq,Duration,Start date,Start station number,Start station name,End date,"
              "End station number,End station name,Bike number,Member type,Gender")


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_build_all(spark, tmp_path):
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    write(f"{new}/201601/data.csv", [
        NEW_HEADER,
        "600,2016-01-01 08:00:00,2016-01-01 08:10:00,1,A,42.35,-71.06,2,B,42.36,-71.09,b1,S,1980,1",
        "900,2016-01-31 23:50:00,2016-02-01 00:05:00,1,A,42.35,-71.06,2,B,42.36,-71.09,b2,S,\\N,2",
        "30,2016-01-02 08:00:00,2016-01-02 08:00:30,1,A,42.35,-71.06,2,B,42.36,-71.09,b3,S,1980,1",
    ])
    write(f"{old}/2015/data.csv", [
        OLD_HEADER,
        "1,600000,12/31/2015 23:00,1,A,12/31/2015 23:10,2,B,B9,Registered,0",
        "2,600000,7/1/2015 10:00,1,A,7/1/2015 10:10,1,A,B9,Registered,1",      # distance 0: valid
    ])
    write(f"{old}/Hubway_Stations_2011_2016.csv",
          ["Station ID,Station,Latitude,Longitude", "1,A,42.35,-71.06", "2,B,42.36,-71.09"])
    clean, kpi, quality, files = (str(tmp_path / n) for n in ("clean", "kpi", "quality", "files"))
    jobs.build_all(spark, new, old, clean, kpi, quality_path=quality, file_counts_path=files)

    trips = read_clean_trips(spark, clean)
    assert trips.count() == 4
    months = {(r.year, r.month) for r in trips.select("year", "month").distinct().collect()}
    assert months == {(2016, 1), (2015, 12), (2015, 7)}
    report = {(r.year, r.month): r for r in read_kpi_report(spark, kpi).collect()}
    assert set(report) == months
    jan = report[(2016, 1)]
    assert jan.n_trips == 2 and jan.gender_1_pct == 50.0 and jan.avg_trip_duration_min == 12.5
    assert [a.age_group for a in jan.age_distribution] == ["30-39"]
    assert [(g.code, g.pct) for g in jan.gender_distribution] == [(1, 50.0), (2, 50.0)]
    q = spark.read.parquet(f"{quality}/months")
    row = q.filter((F.col("year") == 2016) & (F.col("month") == 1)).first()
    assert (row.n_rows, row.n_bad_duration, row.n_valid, row.n_period_mismatch) == (3, 1, 2, 0)
    per_file = {r.source_file.split("/")[-2]: (r.n_rows, r.n_valid) for r in spark.read.parquet(files).collect()}
    assert per_file == {"201601": (3, 2), "2015": (2, 2)}
    assert tuple(spark.read.parquet(f"{quality}/stations").first()) == (2, 2, 0, 0)
    assert spark.read.parquet(f"{quality}/station_duplicates").count() == 0
    assert spark.read.parquet(f"{quality}/unmatched_stations").count() == 0


def test_cli_build_all_subprocess(spark, tmp_path):
    """The spark-submit entry point, run as its own process (local master, UI off)."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    write(f"{new}/201601/data.csv", [
        NEW_HEADER,
        "600,2016-01-01 08:00:00,2016-01-01 08:10:00,1,A,42.35,-71.06,2,B,42.36,-71.09,b1,S,1980,1",
    ])
    write(f"{old}/2015/data.csv", [OLD_HEADER, "1,600000,12/31/2015 23:00,1,A,12/31/2015 23:10,2,B,B9,R,0"])
    write(f"{old}/Hubway_Stations_2011_2016.csv",
          ["Station ID,Station,Latitude,Longitude", "1,A,42.35,-71.06", "2,B,42.36,-71.09"])
    clean, kpi = str(tmp_path / "clean"), str(tmp_path / "kpi")
    env = dict(os.environ, PYTHONPATH=root)
    proc = subprocess.run([sys.executable, "-m", "tripkpi.plans.jobs", "--master", "local[2]", "build-all",
                           "--new-base", new, "--old-base", old, "--clean-path", clean,
                           "--kpi-path", kpi, "--format", "json", "--headers", "known"],
                          cwd=root, env=env, capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    assert read_clean_trips(spark, clean).count() == 2
    assert read_kpi_report(spark, kpi, fmt="json").count() == 2


def test_reordered_columns_are_bound_by_name(spark, tmp_path):
    new = str(tmp_path / "new")
    cols = NEW_HEADER.split(",")
    row = "600,2016-01-01 08:00:00,2016-01-01 08:10:00,1,A,42.35,-71.06,2,B,42.36,-71.09,b1,S,1980,1"
    write(f"{new}/201601/data.csv", [NEW_HEADER, row])
    vals = dict(zip(cols, row.replace("2016-01-01", "2016-02-01").replace("b1", "b2").split(",")))
    write(f"{new}/201602/data.csv", [",".join(reversed(cols)), ",".join(vals[c] for c in reversed(cols))])
    out = str(tmp_path / "clean")
    jobs.clean_new_job(spark, new, out)
    got = {r.bike_id: r for r in read_clean_trips(spark, out).collect()}
    assert set(got) == {"b1", "b2"} and got["b2"].month == 2 and got["b2"].start_station_id == "1"
    import pytest
    with pytest.raises(Exception, match="header"):
        jobs.clean_new_job(spark, new, str(tmp_path / "clean2"), headers="known")
