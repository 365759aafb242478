"""Named queries over the benchmark tables: one per operator of the inventory.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
work grows with the input tables. Queries that exercise file sources or sinks
render the derived trips into files under the shared checkpoint folder first
(see ``tripkpi.plans.fixtures``), then run the production reader / writer on them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.functions import columns as C
from tripkpi.operators import kpis as K
from tripkpi.operators import quality as Q
from tripkpi.operators import cleaning
from tripkpi.operators.joins import join_station_coordinates
from tripkpi.operators.topk import threshold_top_k
from tripkpi.plans import fixtures as X
from tripkpi.plans import layouts as L
from tripkpi.plans.incremental import RawSource, rebuild
from tripkpi.plans.jobs import build_all, clean_new_job, clean_old_job
from tripkpi.session import scratch_path
from tripkpi.sinks.kpi_state import merge_trips, read_state
from tripkpi.sinks.parquet import read_kpi_report, write_clean_trips, write_kpi_report
from tripkpi.sources import csv_layouts as CSV
from tripkpi.sources import driver_tables as D
from tripkpi.sources import landing as LD
from tripkpi.sources import parquet as PQ
from tripkpi.sources.stations import read_station_master, station_master

Query = Callable[[SparkSession, str], DataFrame]
TRIP_ID = ["trip_order", "trip_line"]


def _stations(spark, sf_dir):
    return station_master(D.station_raw(spark, sf_dir))


def _base(spark, sf_dir):
    return K.kpi_base(D.clean_trips(spark, sf_dir))


# --- scalars -------------------------------------------------------------------------

def q_time_slot(spark, sf_dir):
    ev = D.read_table(spark, sf_dir, "events").select("event_id", "ts")
    return ev.select("event_id", "ts", C.time_slot("ts").alias("time_slot"))


def q_station_join(spark, sf_dir):
    raw = D.trips_raw(spark, sf_dir)
    joined = join_station_coordinates(raw, _stations(spark, sf_dir))
    return joined.select(*TRIP_ID, "start_station_id", "end_station_id",
                         "start_latitude", "start_longitude", "end_latitude", "end_longitude")


def q_haversine_distance(spark, sf_dir):
    j = q_station_join(spark, sf_dir)
    return j.select(*TRIP_ID, "start_station_id", "end_station_id",
                    C.haversine_m("start_latitude", "start_longitude",
                                  "end_latitude", "end_longitude").alias("trip_distance_m"))


def q_trip_duration_new(spark, sf_dir):
    raw = D.trips_raw(spark, sf_dir)
    return raw.select(*TRIP_ID, "dur_s",
                      C.duration_minutes("dur_s", S.NEW_LAYOUT_DURATION_DIVISOR)
                      .alias("trip_duration_min"))


def q_trip_duration_old(spark, sf_dir):
    raw = D.trips_raw(spark, sf_dir).select(*TRIP_ID, (F.col("dur_s") * 1000).alias("dur_ms"))
    return raw.select(*TRIP_ID, "dur_ms",
                      C.duration_minutes("dur_ms", S.OLD_LAYOUT_DURATION_DIVISOR)
                      .alias("trip_duration_min"))


def q_normalize_birth_year(spark, sf_dir):
    raw = D.trips_raw(spark, sf_dir)
    return raw.select(*TRIP_ID, "birth_year_raw", C.birth_year("birth_year_raw").alias("birth_year"))


def q_normalize_gender(spark, sf_dir):
    raw = D.trips_raw(spark, sf_dir)
    return raw.select(*TRIP_ID, "gender_raw", C.gender("gender_raw").alias("gender"))


def q_rider_age(spark, sf_dir):
    clean = D.clean_trips(spark, sf_dir)
    return clean.select("year", "month", "birth_year",
                        C.rider_age("year", "birth_year").alias("age"))


def q_year_month_label(spark, sf_dir):
    clean = D.clean_trips(spark, sf_dir)
    return clean.select("year", "month", C.year_month_label("year", "month").alias("year_month"))


# --- cleaning ----------------------------------------------------------------------------

def q_station_master(spark, sf_dir):
    return _stations(spark, sf_dir)


def q_clean_trips(spark, sf_dir):
    return D.clean_trips(spark, sf_dir)


# --- quality -------------------------------------------------------------------------------

def q_reject_reasons(spark, sf_dir):
    return Q.reject_reasons(D.typed_trips(spark, sf_dir))


def q_trip_counts(spark, sf_dir):
    return Q.trip_counts(D.clean_trips(spark, sf_dir))


def q_station_duplicates(spark, sf_dir):
    return Q.station_duplicates(D.station_raw(spark, sf_dir))


def q_unmatched_stations(spark, sf_dir):
    return Q.unmatched_stations(D.trips_raw(spark, sf_dir), _stations(spark, sf_dir))


# --- KPIs ------------------------------------------------------------------------------------

def q_kpi_avg_duration(spark, sf_dir):
    return K.avg_duration(_base(spark, sf_dir))


def q_kpi_avg_distance(spark, sf_dir):
    return K.avg_distance(_base(spark, sf_dir))


def q_kpi_gender_share(spark, sf_dir):
    return K.gender_share(_base(spark, sf_dir))


def q_kpi_age_share(spark, sf_dir):
    return K.age_share(_base(spark, sf_dir))


def q_kpi_timeslot_share(spark, sf_dir):
    return K.timeslot_share(_base(spark, sf_dir))


def q_kpi_top_bikes(spark, sf_dir):
    return K.top_bikes(_base(spark, sf_dir))


def q_kpi_top_start_stations(spark, sf_dir):
    return K.top_start_stations(_base(spark, sf_dir))


def q_kpi_top_end_stations(spark, sf_dir):
    return K.top_end_stations(_base(spark, sf_dir))


def q_distinct_periods(spark, sf_dir):
    return K.distinct_periods(D.clean_trips(spark, sf_dir))


# --- reshape -----------------------------------------------------------------------------------

def q_kpi_gender_pivot(spark, sf_dir):
    return K.gender_pivot(_base(spark, sf_dir))


def q_kpi_timeslot_pivot(spark, sf_dir):
    return K.timeslot_pivot(_base(spark, sf_dir))


def q_kpi_report_long(spark, sf_dir):
    return K.kpi_report_long(D.clean_trips(spark, sf_dir))


def q_kpi_report_wide(spark, sf_dir):
    return K.kpi_report_wide_text(D.clean_trips(spark, sf_dir))


# --- sources: raw CSV layouts ---------------------------------------------------------------

LANDING_DIR = "/landing"


def _scan_new(spark, sf_dir):
    base = X.write_new_layout(spark, sf_dir)
    return CSV.scan_new_layout(spark, base, folder_glob=X.NEW_FOLDER_GLOB, file_glob=X.CSV_FILE_GLOB)


def _scan_old(spark, sf_dir):
    base = X.write_old_layout(spark, sf_dir)
    raw = CSV.scan_old_layout(spark, base, folder_glob=X.OLD_FOLDER_GLOB, file_glob=X.CSV_FILE_GLOB)
    return raw, read_station_master(spark, f"{base}/stations")


def q_scan_new_layout(spark, sf_dir):
    t = cleaning.add_temporal(_scan_new(spark, sf_dir), S.NEW_LAYOUT.duration_divisor,
                              S.NEW_LAYOUT.ts_format, period_from_folder=True)
    return t.select("period", "year", "month", "trip_duration_min", "trip_start_ts", "trip_end_ts",
                    "time_slot", "start_station_id", "start_station_name", "end_station_id",
                    "end_station_name", "bike_id", "birth_year_raw", "gender_raw",
                    *[F.col(c).try_cast("double").alias(c) for c in cleaning.COORDINATES])


def q_scan_old_layout(spark, sf_dir):
    raw, _ = _scan_old(spark, sf_dir)
    t = cleaning.add_temporal(raw, S.OLD_LAYOUT.duration_divisor, S.OLD_LAYOUT.ts_format,
                              period_from_folder=False)
    return t.select("period", "year", "month", "trip_duration_min", "trip_start_ts", "trip_end_ts",
                    "time_slot", "start_station_id", "start_station_name", "end_station_id",
                    "end_station_name", "bike_id", "gender_raw")


def q_clean_new_layout(spark, sf_dir):
    return L.clean_new(_scan_new(spark, sf_dir)).select(*S.CLEAN_TRIP_COLUMNS)


def q_clean_old_layout(spark, sf_dir):
    raw, stations = _scan_old(spark, sf_dir)
    return L.clean_old(raw, stations).select(*S.CLEAN_TRIP_COLUMNS)


def q_unify_layouts(spark, sf_dir):
    return L.unify(q_clean_new_layout(spark, sf_dir), q_clean_old_layout(spark, sf_dir))


def q_merge_split_years(spark, sf_dir):
    base = X.write_split_years(spark, sf_dir)
    raw = CSV.scan_split_years(spark, f"{base}/year=*/part=*/{X.CSV_FILE_GLOB}",
                               year_regex=r"/year=([0-9]{4})/")
    return (raw.groupBy(F.col("period").cast("int").alias("year"))
               .agg(F.count(F.lit(1)).alias("n_rows"),
                    F.sum(F.col("dur_raw").try_cast("bigint")).alias("sum_dur_ms")))


def _landing_paths(spark, sf_dir):
    od = D.read_table(spark, sf_dir, "orders").select("o_orderdate")
    months = od.select(F.date_format("o_orderdate", "yyyyMM").alias("p")).distinct()
    years = od.select(F.date_format("o_orderdate", "yyyy").alias("p")).distinct()
    prefix = F.lit(LANDING_DIR + "/")

    def named(df, template):
        head, tail = template.split("{period}")
        return df.select(F.concat(prefix, F.lit(head), F.col("p"), F.lit(tail)).alias("path"))

    return reduce(lambda a, b: a.unionByName(b), [
        named(months, S.LANDING_NEW_NAME),
        named(months, S.LANDING_NEW_NAME.replace("{period}", "{period}1")),      # 7 digits: no match
        named(years, S.LANDING_OLD_NAME),
        named(years, S.LANDING_OLD_NAME + ".bak"),                              # backup: no match
        named(years, S.LANDING_OLD_NAME.replace(".csv", "_1.csv")),             # split part
    ])


def q_landing_manifest(spark, sf_dir):
    return LD.landing_manifest(_landing_paths(spark, sf_dir))


def q_month_spine(spark, sf_dir):
    od = D.read_table(spark, sf_dir, "orders")
    return LD.month_spine(od.select(F.year("o_orderdate").alias("year")))


# --- sinks ------------------------------------------------------------------------------------------

def _first_month(df):
    """The smallest (year, month): of the table's partition values, no data file is read."""
    return tuple(df.select("year", "month").distinct().agg(F.min(F.struct("year", "month")).alias("m")).first().m)


def q_clean_roundtrip(spark, sf_dir):
    """Write the clean table (K1) and read it back."""
    path = scratch_path(spark, "roundtrip")
    write_clean_trips(D.clean_trips(spark, sf_dir), path)
    return PQ.read_clean_trips(spark, path)


def q_month_slice(spark, sf_dir):
    path = X.write_clean_table(spark, sf_dir)
    y, m = _first_month(PQ.read_clean_trips(spark, path, validate=False))
    return PQ.read_month(spark, path, y, m)


def q_dynamic_overwrite(spark, sf_dir):
    """Write every month, then overwrite the first month with the trips that
    started in the first half of an hour; all other months must survive."""
    path = scratch_path(spark, "dyn")
    write_clean_trips(D.clean_trips(spark, sf_dir), path)
    y, m = _first_month(PQ.read_clean_trips(spark, path, validate=False))
    staged = scratch_path(spark, "dyn-stage")
    half = PQ.read_month(spark, path, y, m).filter(F.minute("trip_start_ts") < 30)
    write_clean_trips(half, staged)
    write_clean_trips(PQ.read_clean_trips(spark, staged, validate=False), path)
    return PQ.read_clean_trips(spark, path)


def q_kpi_report_sink(spark, sf_dir):
    """Write the report (K2), then again without the first year, and read it back: the year is gone."""
    wide = K.kpi_report_wide(PQ.read_clean_trips(spark, X.write_clean_table(spark, sf_dir)))
    path = scratch_path(spark, "report")
    write_kpi_report(wide, path)
    first = read_kpi_report(spark, path).agg(F.min("year")).first()[0]
    write_kpi_report(wide.where(F.col("year") != first), path)
    return K.report_as_text(read_kpi_report(spark, path))


def q_build_all(spark, sf_dir):
    """Both layouts as CSV folders -> clean table -> report, read back."""
    new, old = X.write_new_layout(spark, sf_dir), X.write_old_layout(spark, sf_dir)
    out = scratch_path(spark, "build-all")
    build_all(spark, new, old, f"{out}/clean", f"{out}/report", stations_path=f"{old}/stations",
              new_files={"folder_glob": X.NEW_FOLDER_GLOB, "file_glob": X.CSV_FILE_GLOB},
              old_files={"folder_glob": X.OLD_FOLDER_GLOB, "file_glob": X.CSV_FILE_GLOB})
    return K.report_as_text(read_kpi_report(spark, f"{out}/report"))


# --- upkeep: incremental rebuild, merged state, counts of a write ------------------------------------------

def q_incremental_rebuild(spark, sf_dir):
    """Build from raw folders, change one month, remove one, add one, rebuild: the clean table."""
    base, change = X.write_changing_layout(spark, sf_dir)
    out = scratch_path(spark, "incremental")
    source = RawSource(S.NEW_LAYOUT, base, X.NEW_FOLDER_GLOB, X.CSV_FILE_GLOB)
    rebuild(spark, [source], f"{out}/clean", f"{out}/state")
    change()
    rebuild(spark, [source], f"{out}/clean", f"{out}/state")
    return PQ.read_clean_trips(spark, f"{out}/clean")


def q_kpi_report_merged(spark, sf_dir):
    """The report of a state into which the trips were merged in two batches that share all months."""
    clean = PQ.read_clean_trips(spark, X.write_clean_table(spark, sf_dir))
    path = scratch_path(spark, "kpi-state")
    for half in (0, 1):
        merge_trips(spark, path, clean.where(F.minute("trip_start_ts") % 2 == half))
    return K.report_as_text(K.report_from_state(read_state(spark, path)))


def q_clean_write_counts(spark, sf_dir):
    """What both layout jobs report of their write: rows read, before validation, valid, rejected, by reason."""
    new, old = X.write_new_layout(spark, sf_dir), X.write_old_layout(spark, sf_dir)
    out = scratch_path(spark, "counted")
    counts = [
        {"layout": "new"} | clean_new_job(spark, new, f"{out}/new", files={"folder_glob": X.NEW_FOLDER_GLOB, "file_glob": X.CSV_FILE_GLOB}),
        {"layout": "old"} | clean_old_job(spark, old, f"{out}/old", f"{old}/stations",
                                          files={"folder_glob": X.OLD_FOLDER_GLOB, "file_glob": X.CSV_FILE_GLOB})]
    names = [c for c in counts[0] if c != "layout"]
    return spark.createDataFrame([tuple(c.values()) for c in counts], "layout string, " + ", ".join(f"{n} bigint" for n in names))


def q_file_counts(spark, sf_dir):
    """Raw and valid rows of each new-layout file, added up by the files' folders (file names are Spark's own)."""
    typed = L.typed_new_layout(_scan_new(spark, sf_dir), passthrough=["source_file"])
    period = F.regexp_extract("source_file", CSV.period_regex(6), 1)
    return (Q.file_counts(typed).groupBy(period.alias("period"))
            .agg(F.sum("n_rows").alias("n_rows"), F.sum("n_valid").alias("n_valid")))


def q_contract_check(spark, sf_dir):
    """S7 on the whole clean table, on one that lacks two columns, and on one without rows."""
    whole = PQ.read_clean_trips(spark, X.write_clean_table(spark, sf_dir))
    inputs = {"whole": whole, "narrow": whole.drop("gender", "birth_year"), "empty": whole.where("trip_duration_min < 0")}
    return reduce(lambda a, b: a.unionByName(b), [Q.contract_report(df).withColumn("input", F.lit(n)) for n, df in inputs.items()])


def q_landing_listing(spark, sf_dir):
    """The manifest of a folder of real files (their paths are left out: they lie in scratch)."""
    return LD.landing_manifest(LD.list_landing(spark, X.write_landing(spark, sf_dir), "*")).drop("path")


def q_kpi_report_json(spark, sf_dir):
    """The report's text form (K2, JSON), written and read back."""
    wide = K.kpi_report_wide(PQ.read_clean_trips(spark, X.write_clean_table(spark, sf_dir)))
    path = scratch_path(spark, "report-json")
    write_kpi_report(wide, path, "json")
    return K.report_as_text(read_kpi_report(spark, path, "json", schema=wide.schema))


# --- reads that skip ----------------------------------------------------------------------------------------

def q_clean_periods(spark, sf_dir):
    return PQ.clean_periods(spark, X.write_clean_table(spark, sf_dir)).select("year", "month", "year_month")


def q_bike_history(spark, sf_dir):
    """All trips of the bike whose id sorts first."""
    path = X.write_searchable_table(spark, sf_dir)
    bike = PQ.read_clean_trips(spark, path, validate=False).agg(F.min("bike_id")).first()[0]
    return PQ.bike_history(spark, path, bike)


def q_kpi_top_bikes_threshold(spark, sf_dir):
    """The monthly top bikes by bounds and survivors, on the stored clean table."""
    return threshold_top_k(PQ.read_clean_trips(spark, X.write_clean_table(spark, sf_dir)), "bike_id")


def q_month_gaps(spark, sf_dir):
    """Month KPIs over all months of all years, on data in which July of the second year has no trips."""
    clean = PQ.read_clean_trips(spark, X.write_clean_table(spark, sf_dir))
    first = _first_month(clean)[0]
    clean = clean.where((F.col("year") != first + 1) | (F.col("month") != 7))
    report = K.kpi_report_wide(clean).select("year", "month", "n_trips", "avg_trip_duration_min", "avg_trip_distance_km")
    return K.densify_months(report, LD.month_spine(clean.select("year")), ["n_trips"])


def q_station_quality(spark, sf_dir):
    return Q.station_quality(D.station_raw(spark, sf_dir))


QUERIES: dict[str, Query] = {
    # scalars
    "time_slot": q_time_slot,
    "haversine_distance": q_haversine_distance,
    "trip_duration_new": q_trip_duration_new,
    "trip_duration_old": q_trip_duration_old,
    "normalize_birth_year": q_normalize_birth_year,
    "normalize_gender": q_normalize_gender,
    "rider_age": q_rider_age,
    "year_month_label": q_year_month_label,
    # cleaning
    "station_master": q_station_master,
    "station_join": q_station_join,
    "clean_trips": q_clean_trips,
    "clean_new_layout": q_clean_new_layout,
    "clean_old_layout": q_clean_old_layout,
    "unify_layouts": q_unify_layouts,
    # quality
    "reject_reasons": q_reject_reasons,
    "trip_counts": q_trip_counts,
    "station_duplicates": q_station_duplicates,
    "unmatched_stations": q_unmatched_stations,
    "station_quality": q_station_quality,
    # sources
    "scan_new_layout": q_scan_new_layout,
    "scan_old_layout": q_scan_old_layout,
    "merge_split_years": q_merge_split_years,
    "landing_manifest": q_landing_manifest,
    "month_spine": q_month_spine,
    # sinks
    "clean_roundtrip": q_clean_roundtrip,
    "dynamic_overwrite": q_dynamic_overwrite,
    "month_slice": q_month_slice,
    "kpi_report_sink": q_kpi_report_sink,
    "kpi_report_json": q_kpi_report_json,
    "bike_history": q_bike_history,
    "clean_periods": q_clean_periods,
    "landing_listing": q_landing_listing,
    "file_counts": q_file_counts,
    "contract_check": q_contract_check,
    # upkeep
    "incremental_rebuild": q_incremental_rebuild,
    "kpi_report_merged": q_kpi_report_merged,
    "clean_write_counts": q_clean_write_counts,
    # the whole flow
    "build_all": q_build_all,
    # KPIs
    "kpi_avg_duration": q_kpi_avg_duration,
    "kpi_avg_distance": q_kpi_avg_distance,
    "kpi_gender_share": q_kpi_gender_share,
    "kpi_age_share": q_kpi_age_share,
    "kpi_timeslot_share": q_kpi_timeslot_share,
    "kpi_top_bikes": q_kpi_top_bikes,
    "kpi_top_start_stations": q_kpi_top_start_stations,
    "kpi_top_end_stations": q_kpi_top_end_stations,
    "kpi_top_bikes_threshold": q_kpi_top_bikes_threshold,
    "distinct_periods": q_distinct_periods,
    "month_gaps": q_month_gaps,
    # reshape
    "kpi_gender_pivot": q_kpi_gender_pivot,
    "kpi_timeslot_pivot": q_kpi_timeslot_pivot,
    "kpi_report_long": q_kpi_report_long,
    "kpi_report_wide": q_kpi_report_wide,
}
