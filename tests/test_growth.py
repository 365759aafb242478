"""Steps whose cost per row decides whether a query still fits at a hundred times the size."""

import contextlib
import io
import os
import time

import pyarrow as pa
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi import session
from tripkpi.operators import cleaning
from tripkpi.plans import fixtures as X
from tripkpi.plans import jobs
from tripkpi.plans import layouts as L
from tripkpi.plans.incremental import RawSource
from tripkpi.sinks import parquet as P
from tripkpi.sources import csv_layouts as CSV
from tripkpi.sources import driver_tables as D
from tripkpi.sources import parquet as PQ
from tripkpi.sources import stations as ST
from tripkpi.sources.stations import station_master


def formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def conditions(df):
    return [line for line in formatted(df).splitlines() if line.startswith("Condition")]


def new_file(folder, rows):
    lay = S.NEW_LAYOUT
    names = [lay.duration, lay.start, lay.end, lay.start_id, lay.start_name, lay.start_lat, lay.start_lon, lay.end_id,
             lay.end_name, lay.end_lat, lay.end_lon, lay.bike, lay.birth_year, lay.gender]
    os.makedirs(folder)
    with open(f"{folder}/data.csv", "w") as f:
        f.write("\n".join([",".join(names), *rows]) + "\n")


def trip(dur="600", start="2016-01-01 08:00:00", end="2016-01-01 08:10:00", lat="42.35", sid="1"):
    return f"{dur},{start},{end},{sid},A,{lat},-71.06,2,B,42.36,-71.09,B1,1980,1"


def test_distance_and_timestamps_are_not_computed_in_filters(spark, tmp_path, sf_small):
    new_file(f"{tmp_path}/201601", [trip()])
    for df in (L.clean_new(CSV.scan_new_layout(spark, str(tmp_path))), D.clean_trips(spark, sf_small)):
        found = conditions(df)
        assert found and not any("ATAN2" in c for c in found)
    raw = CSV.scan_new_layout(spark, str(tmp_path))
    assert not any("as timestamp_ntz" in c for c in conditions(L.clean_new(raw)))


def test_computed_once_keeps_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 0.5, None), (2, 0.5, None)], "k int, x double, s string")
    out = cleaning.computed_once(df, "x")
    assert out.columns == ["k", "s", "x"]
    assert sorted(map(str, out.select("k", "x", "s").collect())) == sorted(map(str, df.collect()))


def test_clean_new_keeps_the_same_trips(spark, tmp_path):
    new_file(f"{tmp_path}/201601", [trip(), trip(), trip(dur="59"), trip(dur="junk"), trip(lat="junk"), trip(lat="-42"),
                                    trip(end="2016-01-01 07:00:00"), trip(start="junk"), trip(sid="")])
    rows = L.clean_new(CSV.scan_new_layout(spark, str(tmp_path))).collect()
    assert len(rows) == 2 and {r.trip_duration_min for r in rows} == {10.0}
    assert list(rows[0].asDict()) == list(S.CLEAN_TRIP_COLUMNS)


def test_header_index_reads_small_files_to_the_end():
    def batches(n):
        for i in range(n):
            yield pa.RecordBatch.from_pydict({"source_file": ["f"], "value": ["a,b" if i == 0 else "1,2"]})

    small = batches(5)
    assert [b.to_pylist() for b in CSV._first_lines(("a", "b"))(small)] == [[{"source_file": "f", "header": "a,b", "others": False}]]
    assert next(small, None) is None                      # else Spark doesn't use the worker again
    large = batches(CSV.DRAINED + 10)
    list(CSV._first_lines(("a", "b"))(large))
    assert next(large, None) is not None


def test_files_without_a_period_stay_out(spark, tmp_path):
    new_file(f"{tmp_path}/201601", [trip()])
    new_file(f"{tmp_path}/other6", ["x"])
    index = CSV._header_index(spark, f"{tmp_path}/*/data.csv", S.NEW_LAYOUT, CSV.period_regex(6))
    assert [r.source_file.split("/")[-2] for r in index.collect()] == ["201601"]


def test_keys_not_texts_are_shuffled_to_folders(spark, sf_small):
    keys = D.located_keys(spark, sf_small, station_master(D.station_raw(spark, sf_small)))
    assert "string" not in dict(X._per_folder(keys).dtypes).values()
    folders = {m: {r[0] for r in X._per_folder(keys, m).select("_folder").distinct().collect()} for m in (1, 6, 12)}
    assert all(f % m == 0 for m, found in folders.items() for f in found) and len(folders[1]) > len(folders[6]) > len(folders[12])


def test_raw_files_are_compressed(spark, sf_small):
    base = X.write_old_layout(spark, sf_small).removeprefix("file:")
    parts = [f for d, _, names in os.walk(base) for f in names if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)


def test_folder_of_a_trip_is_its_files_folder(spark, tmp_path):
    new_file(f"{tmp_path}/period=201601", [trip()])
    df = RawSource(S.NEW_LAYOUT, str(tmp_path), "period=" + "[0-9]" * 6, "*.csv").clean(spark, ["period=201601"])
    assert [(r.folder, r.period) for r in df.collect()] == [("period=201601", "201601")]
    assert formatted(df).count("([^/]+)/[^/]+$") == 0


def old_base(base):
    os.makedirs(f"{base}/2015")
    with open(f"{base}/2015/data.csv", "w") as f:
        f.write("Seq,Duration,Start date,Start station number,Start station name,End date,End station number,End station name,Bike number,Member type,Gender\n"
                "1,600000,12/31/2015 23:00,1,A,12/31/2015 23:10,2,B,B9,Registered,0\n2,600000,7/1/2015 10:00,1,A,7/1/2015 10:10,9,A,B9,Registered,1\n")
    with open(f"{base}/{S.STATIONS_FILE_NAME}", "w") as f:
        f.write("Station ID,Station,Latitude,Longitude\n1,A,42.35,-71.06\n2,B,42.36,-71.09\n2,B,42.37,-71.09\n")


def test_few_stations_are_broadcast_whatever_the_sessions_limit(spark, tmp_path, monkeypatch):
    old_base(str(tmp_path))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def typed():
            df = L.typed_old_layout(CSV.scan_old_layout(spark, str(tmp_path)), ST.read_station_master(spark, f"{tmp_path}/{S.STATIONS_FILE_NAME}"))
            return formatted(df).split("\n\n")[0], sorted(map(str, df.collect()))

        plan, rows = typed()
        assert plan.count("BroadcastHashJoin LeftOuter") == 2 and "SortMergeJoin" not in plan
        monkeypatch.setattr(ST, "BROADCAST_STATIONS", 2)             # three rows are many now
        sorted_plan, sorted_rows = typed()
        assert "Broadcast" not in sorted_plan and sorted_rows == rows and len(rows) == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_new_layout_is_written_without_a_shuffle(spark, sf_small, tmp_path, monkeypatch):
    for month in ("201601", "201602"):
        new_file(f"{tmp_path}/raw/{month}", [trip(), trip(dur="59")])
    given = []

    def written(df, path, **options):
        given.append(options)
        df = df.localCheckpoint()
        spark.sparkContext.setJobGroup(path, "")
        try:
            P.write_clean_trips(df, path, **options)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        tracker = spark.sparkContext.statusTracker()
        assert sum(len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup(path)) == 1

    monkeypatch.setattr(jobs, "write_clean_trips", written)
    counts = jobs.clean_new_job(spark, f"{tmp_path}/raw", str(tmp_path / "clean"))
    assert given == [{"clustered": True}] and (counts["n_read"], counts["n_valid"]) == (4, 2)
    files = [f"{d}/{f}" for d, _, names in os.walk(tmp_path / "clean") for f in names if f.endswith(".parquet")]
    assert sorted(f.split("/")[-2] for f in files) == ["month=1", "month=2"] and all(f.endswith(".zstd.parquet") for f in files)


def both_layouts(base):
    for month in ("201601", "201602"):
        new_file(f"{base}/new/{month}", [trip(start=f"2016-{month[4:]}-01 08:00:00", end=f"2016-{month[4:]}-01 08:10:00"), trip(dur="59")])
    old_base(f"{base}/old")
    return f"{base}/new", f"{base}/old"


def test_build_all_stages_typed_rows_only_for_reports(spark, tmp_path, monkeypatch):
    new, old = both_layouts(str(tmp_path))
    staged, keep = [], jobs._staged
    monkeypatch.setattr(jobs, "_staged", lambda df, path: staged.append(path) or keep(df, path))

    def built(name, **reports):
        jobs.build_all(spark, new, old, f"{tmp_path}/{name}/clean", f"{tmp_path}/{name}/kpi", **reports)
        return sorted(map(str, spark.read.parquet(f"{tmp_path}/{name}/clean").collect()))

    rows = built("alone")
    assert staged == [] and len(rows) == 4                # two of the new layout, one old trip doubled by its end station
    assert built("filed", file_counts_path=f"{tmp_path}/files") == rows and len(staged) == 2
    assert built("checked", quality_path=f"{tmp_path}/quality") == rows and len(staged) == 4


def test_build_all_shuffles_the_old_layout_alone(spark, tmp_path, monkeypatch):
    new, old = both_layouts(str(tmp_path))
    given = []
    monkeypatch.setattr(jobs, "write_clean_trips", lambda df, path, **options: given.append((formatted(df), options)) or P.write_clean_trips(df, path, **options))
    jobs.build_all(spark, new, old, f"{tmp_path}/clean", f"{tmp_path}/kpi")
    (text, options), = given
    assert options == {"clustered": True} and text.count("Arguments: hashpartitioning") == 1
    tree = text.split("\n\n")[0]
    above, below = tree.split(" Exchange (", 1)
    assert above.count("Scan csv") == 1 and below.count("Scan csv") >= 1 and "Union" in above
    files = [f"{d}/{f}" for d, _, names in os.walk(tmp_path / "clean") for f in names if f.endswith(".parquet")]
    assert sorted("/".join(f.split("/")[-3:-1]) for f in files) == ["year=2015/month=12", "year=2016/month=1", "year=2016/month=2"]


def shuffle_files(spark):
    places = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for p in places for _, _, names in os.walk(p.getPath()) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def settled(spark, before, seconds=20):
    """New shuffle files; they are deleted in the background, so this waits for that."""
    until = time.time() + seconds
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    before, set_to = shuffle_files(spark), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    df.write.parquet(f"{tmp_path}/kept")
    kept = shuffle_files(spark)
    assert kept - before
    with session.shuffles_deleted(spark):
        df.write.parquet(f"{tmp_path}/deleted")
        assert not settled(spark, kept)
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == set_to
    want = sorted(df.collect())
    assert all(sorted(spark.read.parquet(f"{tmp_path}/{n}").collect()) == want for n in ("kept", "deleted"))


def test_build_all_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    new, old = both_layouts(str(tmp_path))
    monkeypatch.setattr(jobs, "read_clean_trips", lambda spark, path: PQ.read_clean_trips(spark, path, validate=False))  # its check shuffles a row
    before = shuffle_files(spark)
    jobs.build_all(spark, new, old, f"{tmp_path}/clean", f"{tmp_path}/kpi")
    left = settled(spark, before)
    assert not left, sorted(left)


def test_raw_files_come_from_keys_without_a_shuffle(spark, sf_small):
    X.write_new_layout(spark, sf_small)
    keys, stations = X._staged_keys(spark, sf_small), station_master(D.station_raw(spark, sf_small))
    rows = X._new_layout_text(X._in_order(X._located_per_folder(keys, stations, True), X._month_number()))
    assert formatted(rows).split("\n\n")[0].count(" Exchange (") == 0


def test_staged_keys_go_when_both_layouts_are_there(spark, sf_small, monkeypatch):
    monkeypatch.setattr(X, "_cache", {})
    X.write_new_layout(spark, sf_small)
    keys = X._cache[X._key(spark, sf_small, "keys")].removeprefix("file:")
    assert os.listdir(keys)
    X.write_old_layout(spark, sf_small)
    assert not os.path.exists(keys) and X._key(spark, sf_small, "keys") not in X._cache


def test_trip_tables_are_joined_once_for_both_layouts(spark, sf_small):
    X.write_new_layout(spark, sf_small)
    keys = X._staged_keys(spark, sf_small)
    assert "Join" not in formatted(keys) and keys.columns == D.trip_keys(spark, sf_small).columns
    assert sorted(map(str, keys.collect())) == sorted(map(str, D.trip_keys(spark, sf_small).collect()))


def test_folders_are_the_same_for_few_and_many_stations(spark, sf_small):
    keys, stations = D.trip_keys(spark, sf_small), station_master(D.station_raw(spark, sf_small))
    few, many = (X._new_layout_text(X._in_order(X._located_per_folder(keys, stations, f), X._month_number())) for f in (True, False))
    plain = X.new_layout_rows(spark, sf_small)
    assert few.columns == plain.columns
    want = sorted(map(str, plain.withColumn("period", plain.period.cast("int")).collect()))
    assert sorted(map(str, few.collect())) == want == sorted(map(str, many.collect()))
