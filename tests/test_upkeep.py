"""Incremental rebuild, mergeable state, counts of a write, reads that skip."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.operators import kpis as K
from tripkpi.operators import quality as Q
from tripkpi.plans import jobs
from tripkpi.plans.incremental import RawSource, rebuild
from tripkpi.sinks import kpi_state
from tripkpi.sinks.parquet import write_clean_trips, write_searchable_trips
from tripkpi.sources import driver_tables as D
from tripkpi.sources import landing
from tripkpi.sources import parquet as PQ

NEW_HEADER = ("tripduration,starttime,stoptime,start station id,start station name,start station latitude,"
              "start station longitude,end station id,end station name,end station latitude,"
              "end station longitude,bikeid,usertype,birth year,gender")
OLD_HEADER = ("Seq,Duration,Start date,Start station number,Start station name,End date,"
              "End station number,End station name,Bike number,Member type,Gender")


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def new_trip(day, bike, minutes=10):
    return f"{minutes * 60},{day} 08:00:00,{day} 08:{minutes:02d}:00,1,A,42.35,-71.06,2,B,42.36,-71.09,{bike},S,1980,1"


def old_trip(day, bike, start="1"):
    return f"1,600000,{day} 10:00,{start},A,{day} 10:10,2,B,{bike},R,0"


@pytest.fixture()
def raw(tmp_path):
    new, old = str(tmp_path / "new"), str(tmp_path / "old")
    for month, bikes in (("01", ["n1", "n2"]), ("02", ["n3"]), ("03", ["n4"])):
        write(f"{new}/2016{month}/data.csv", [NEW_HEADER, *[new_trip(f"2016-{month}-05", b) for b in bikes]])
    # a year file that also holds a trip of the next January, which the new layout has too
    write(f"{old}/2015/data.csv", [OLD_HEADER, old_trip("12/31/2015", "o1"), old_trip("1/1/2016", "o2")])
    write(f"{old}/2014/data.csv", [OLD_HEADER, old_trip("7/1/2014", "o3"), old_trip("7/2/2014", "o4", "3")])
    write(f"{old}/{S.STATIONS_FILE_NAME}", ["Station ID,Station,Latitude,Longitude", "1,A,42.35,-71.06", "2,B,42.36,-71.09"])
    return new, old


def sources(raw):
    new, old = raw
    return [RawSource(S.NEW_LAYOUT, new), RawSource(S.OLD_LAYOUT, old, stations_path=f"{old}/{S.STATIONS_FILE_NAME}")]


def bikes(spark, clean):
    return {r.bike_id: (r.year, r.month) for r in PQ.read_clean_trips(spark, clean, validate=False).collect()}


def files(clean):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{clean}/year=*/month=*/*.parquet")}


def test_rebuild_follows_the_raw_files(spark, raw, tmp_path):
    clean, state, kpi = (str(tmp_path / n) for n in ("clean", "state", "kpi"))
    new, old = raw

    def run():
        report = {(r.source, r.period): r.status for r in rebuild(spark, sources(raw), clean, state, kpi).collect()}
        table = PQ.read_clean_trips(spark, clean, validate=False)
        want = sorted(map(str, K.report_as_text(K.kpi_report_wide(table)).collect()))
        got = K.report_from_state(kpi_state.read_state(spark, kpi))
        assert sorted(map(str, K.report_as_text(got).collect())) == want
        return report

    first = run()
    assert first == {("new", "201601"): "added", ("new", "201602"): "added", ("new", "201603"): "added",
                     ("old", "2014"): "added", ("old", "2015"): "added", ("stations", "stations"): "added"}
    assert bikes(spark, clean) == {"n1": (2016, 1), "n2": (2016, 1), "n3": (2016, 2), "n4": (2016, 3), "o1": (2015, 12),
                                   "o2": (2016, 1), "o3": (2014, 7)}
    before = files(clean)
    assert run() == {} and files(clean) == before                        # nothing changed: nothing written

    # one month changed (it shares January with the old layout), one removed, one added
    write(f"{new}/201601/data.csv", [NEW_HEADER, new_trip("2016-01-07", "n5", 12)])
    shutil.rmtree(f"{new}/201603")
    write(f"{new}/201604/data.csv", [NEW_HEADER, new_trip("2016-04-05", "n6")])
    assert run() == {("new", "201601"): "changed", ("new", "201603"): "removed", ("new", "201604"): "added"}
    assert bikes(spark, clean) == {"n5": (2016, 1), "n3": (2016, 2), "n6": (2016, 4), "o1": (2015, 12), "o2": (2016, 1), "o3": (2014, 7)}
    after = files(clean)
    same = {p for p in before if "month=2" in p or "year=201" in p and ("2014" in p or "2015" in p)}
    assert same and all(after[p] == before[p] for p in same)             # other months' files are the same files
    assert not os.path.exists(f"{clean}/year=2016/month=3")

    # an old year goes: its months go, and the January that it shared keeps the new layout's trips
    shutil.rmtree(f"{old}/2015")
    assert run() == {("old", "2015"): "removed"}
    assert bikes(spark, clean) == {"n5": (2016, 1), "n3": (2016, 2), "n6": (2016, 4), "o3": (2014, 7)}

    # the station master decides on old-layout trips
    write(f"{old}/{S.STATIONS_FILE_NAME}", ["Station ID,Station,Latitude,Longitude", "1,A,42.35,-71.06", "2,B,42.36,-71.09",
                                            "3,C,42.37,-71.1"])
    assert run() == {("stations", "stations"): "changed"}
    assert bikes(spark, clean)["o4"] == (2014, 7)


def test_a_failed_rebuild_can_be_run_again(spark, raw, tmp_path, monkeypatch):
    from tripkpi.plans import incremental
    clean, state = str(tmp_path / "clean"), str(tmp_path / "state")
    rebuild(spark, sources(raw), clean, state)
    write(f"{raw[0]}/201602/data.csv", [NEW_HEADER, new_trip("2016-02-05", "n9")])
    keep = incremental._keep

    def lost(df, path, version):
        if path.endswith("snapshots"):
            raise RuntimeError("lost")
        keep(df, path, version)

    monkeypatch.setattr(incremental, "_keep", lost)
    with pytest.raises(RuntimeError):
        rebuild(spark, sources(raw), clean, state)
    monkeypatch.undo()
    assert [r.status for r in rebuild(spark, sources(raw), clean, state).collect()] == ["changed"]
    assert bikes(spark, clean)["n9"] == (2016, 2) and "n3" not in bikes(spark, clean)


def test_snapshot_difference(spark):
    def snap(rows):
        return spark.createDataFrame([("new", p, p[:6], p[:6], n, t) for p, n, t in rows],
                                     "source string, path string, folder string, period string, length long, modified long")
    a = snap([("201601/a", 1, 1), ("201601/b", 1, 1), ("201602/a", 5, 5), ("201603/a", 1, 1)])
    b = snap([("201601/a", 1, 1), ("201601/b", 1, 2), ("201602/a", 5, 5), ("201604/a", 1, 1), ("201602/b", 1, 1)])
    got = {r.path: r.status for r in landing.snapshot_changes(a, b).collect()}
    assert got == {"201601/a": "same", "201601/b": "changed", "201602/a": "same", "201602/b": "added", "201603/a": "removed",
                   "201604/a": "added"}
    periods = {r.period: r.status for r in landing.changed_periods(landing.snapshot_changes(a, b)).collect()}
    assert periods == {"201601": "changed", "201602": "changed", "201603": "removed", "201604": "added"}


def test_merged_state_equals_the_report(spark, sf_small, tmp_dir):
    clean = D.clean_trips(spark, sf_small)
    write_clean_trips(clean, f"{tmp_dir}/clean")
    clean = PQ.read_clean_trips(spark, f"{tmp_dir}/clean")
    path = f"{tmp_dir}/state"
    for part in range(3):
        kpi_state.merge_trips(spark, path, clean.where(F.pmod(F.xxhash64("bike_id"), F.lit(3)) == part))
    want = sorted(map(str, K.report_as_text(K.kpi_report_wide(clean)).collect()))
    assert sorted(map(str, K.report_as_text(K.report_from_state(kpi_state.read_state(spark, path))).collect())) == want
    # months cleaned anew replace theirs, months without trips leave
    months = [tuple(r) for r in clean.select("year", "month").distinct().orderBy("year", "month").limit(2).collect()]
    (y, m), (y2, m2) = months
    less = clean.where(((F.col("year") != y) | (F.col("month") != m)) & (F.minute("trip_start_ts") < 30))
    kpi_state.replace_months(spark, path, less, months)
    got = {(r.year, r.month): r.n_trips for r in K.report_from_state(kpi_state.read_state(spark, path)).collect()}
    assert (y, m) not in got and got[(y2, m2)] == less.where((F.col("year") == y2) & (F.col("month") == m2)).count()
    assert sum(got.values()) == clean.count() - clean.where(
        (F.col("year") == y) & (F.col("month") == m) | (F.col("year") == y2) & (F.col("month") == m2) & (F.minute("trip_start_ts") >= 30)).count()


def test_jobs_report_their_counts(spark, raw, tmp_path):
    new, old = raw
    write(f"{new}/201605/data.csv", [NEW_HEADER, new_trip("2016-05-05", "n7"), new_trip("2016-05-06", "n8", 0)])
    got = jobs.clean_new_job(spark, new, str(tmp_path / "c1"), file_counts_path=str(tmp_path / "f1"))
    assert (got["n_read"], got["n_before"], got["n_valid"], got["n_rejected"], got["n_bad_duration"]) == (6, 6, 5, 1, 1)
    assert got == jobs.clean_new_job(spark, new, str(tmp_path / "c2"))
    per_file = {r.source_file.split("/")[-2]: (r.n_rows, r.n_valid) for r in spark.read.parquet(str(tmp_path / "f1")).collect()}
    assert per_file == {"201601": (2, 2), "201602": (1, 1), "201603": (1, 1), "201605": (2, 1)}
    with open(f"{old}/{S.STATIONS_FILE_NAME}", "a") as f:
        f.write("2,B,42.36,-71.09\n")                       # a duplicate station: its trips double
    got = jobs.clean_old_job(spark, old, str(tmp_path / "c3"))
    assert (got["n_read"], got["n_before"], got["n_valid"], got["n_rejected"]) == (4, 8, 6, 2)


def test_counts_are_printed(spark, raw, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    jobs.main(["clean-new", "--base-path", raw[0], "--output-path", str(tmp_path / "c"), "--padded-months"])
    assert "n_valid: 4" in capsys.readouterr().out
    assert os.path.isdir(str(tmp_path / "c" / "year=2016" / "month=01"))
    assert {(r.year, r.month) for r in PQ.read_clean_trips(spark, str(tmp_path / "c")).collect()} == {(2016, 1), (2016, 2), (2016, 3)}


def test_scratch_is_gone_after_build_all(spark, raw, tmp_path):
    from tripkpi.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tripkpi"
    new, old = raw
    before = set(glob.glob(f"{root}/typed*"))
    jobs.build_all(spark, new, old, str(tmp_path / "c"), str(tmp_path / "k"))
    assert set(glob.glob(f"{root}/typed*")) == before


def test_periods_need_no_data_file(spark, sf_small, tmp_dir):
    path = f"{tmp_dir}/clean"
    write_clean_trips(D.clean_trips(spark, sf_small), path)
    want = {(r.year, r.month, r.year_month) for r in K.distinct_periods(PQ.read_clean_trips(spark, path)).collect()}
    for p in glob.glob(f"{path.removeprefix('file:')}/year=*/month=*/*.parquet"):
        with open(p, "wb") as f:
            f.write(b"not parquet")
    got = PQ.clean_periods(spark, path).collect()
    assert {(r.year, r.month, r.year_month) for r in got} == want and all(r.n_files > 0 and r.n_bytes == 11 * r.n_files for r in got)
    assert [(r.year, r.month) for r in got] == sorted((r.year, r.month) for r in got)


def scanned(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_bloom_filter_skips_row_groups(spark, sf_small, tmp_dir):
    trips = D.clean_trips(spark, sf_small).limit(1).withColumns({"year": F.lit(2016), "month": F.lit(1)})
    many = trips.crossJoin(spark.range(150_000)).withColumn("bike_id", F.sha2(F.col("id").cast("string"), 256)).drop("id").coalesce(1)
    write_searchable_trips(many, f"{tmp_dir}/with", bikes_per_row_group=200_000)
    write_clean_trips(many, f"{tmp_dir}/without")
    absent = "8" * 64
    there = many.agg(F.max("bike_id")).first()[0]
    assert scanned(PQ.bike_history(spark, f"{tmp_dir}/without", absent)) > 0
    assert scanned(PQ.bike_history(spark, f"{tmp_dir}/with", absent)) == 0
    assert PQ.bike_history(spark, f"{tmp_dir}/with", there).count() == 1


def test_months_without_the_bike_are_skipped(spark, sf_small, tmp_dir):
    clean = D.clean_trips(spark, sf_small)
    write_searchable_trips(clean, f"{tmp_dir}/clean")
    one = PQ.bike_history(spark, f"{tmp_dir}/clean", "7")
    n = clean.where("bike_id = '7'").count()
    assert one.count() == n and n <= scanned(one) < clean.count() / 4


def test_gaps_show_as_rows(spark):
    report = spark.createDataFrame([(2015, 1, 5, 1.0), (2015, 2, 6, 2.0), (2015, 6, 1, None), (2016, 12, 2, 3.0)],
                                   "year int, month int, n_trips long, avg_trip_duration_min double")
    spine = landing.month_spine(report.select("year"))
    got = {r.period: r for r in K.densify_months(report, spine, ["n_trips"]).collect()}
    assert len(got) == 24 and [p for p in sorted(got) if not got[p].is_gap] == ["201501", "201502", "201506", "201612"]
    assert got["201503"].gap_months == 3 and got["201505"].gap_months == 3 and got["201507"].gap_months == 17
    assert got["201502"].gap_months == 0 and got["201503"].n_trips == 0 and got["201503"].avg_trip_duration_min is None


def test_contract_report(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    got = {r["check"]: r["ok"] for r in Q.contract_report(df, ["a", "c"]).collect()}
    assert got == {"has a": True, "has c": False, "has rows": True}
    assert {r["check"]: r["ok"] for r in Q.contract_report(df.limit(0), ["a"]).collect()} == {"has a": True, "has rows": False}
