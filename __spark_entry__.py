"""

``entry(spark)`` runs the flagship query (the one-pass monthly KPI report) on
``(spark, sf_dir) -> DataFrame``. ``oracle_sql()`` gives, per query, DuckDB
SQL over the same parquet tables that derives the expected result
independently (plain SQL, no library code).
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole monthly KPI report, one row per month, on sf0.001."""
    from tripkpi.plans.queries import QUERIES
    return QUERIES["kpi_report_wide"](spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from tripkpi.plans.queries import QUERIES
    return {**QUERIES, **_llm()[0]}


def _llm() -> tuple[dict, dict]:
    """Queries and SQL of the llm subpackage and the pipeline; none where they are absent."""
    if not (importlib.util.find_spec("corpus_pipeline") and importlib.util.find_spec("tripkpi.llm")):
        return {}, {}
    import corpus_pipeline
    from tripkpi.llm import queries as llm
    found, sql = dict(llm.QUERIES), dict(llm.ORACLES)
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB). A shared WITH prefix derives stations and trips from the
# benchmark tables exactly like the library's driver-table view, then each
# query selects from it.
# ---------------------------------------------------------------------------

_STATIONS = """
station_raw as (
  select cast(s_suppkey as varchar) as station_id,
         case when s_suppkey % 25 = 7 then 95e0
              else 42.3e0 + (s_suppkey * 37 % 1000) / 10000e0 end as latitude,
         -71.2e0 + (s_suppkey * 53 % 1000) / 10000e0 as longitude
  from supplier
  union all
  select cast(s_suppkey as varchar), 42.31e0, -71.11e0 from supplier where s_suppkey % 50 = 3
),
station_master as (
  select * from station_raw
  where station_id is not null and latitude is not null and longitude is not null
    and latitude between -90 and 90 and longitude between -180 and 180
)"""

_TRIPS_RAW = """
trips_raw as (
  select trip_order, trip_line, dur_s, start_ts,
         case when trip_order % 97 = 0 then null else start_ts + to_seconds(dur_s) end as end_ts,
         start_station_id, 'Station ' || start_station_id as start_station_name,
         end_station_id, 'Station ' || end_station_id as end_station_name,
         bike_id, birth_year_raw, gender_raw
  from (
    select l_orderkey as trip_order, l_linenumber as trip_line,
           (l_orderkey * 31 + l_linenumber * 7919 + l_partkey * 17) % 90000 - 300 as dur_s,
           o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 104729) % 86400) as start_ts,
           case when l_partkey % 89 = 0 then null else cast(l_suppkey as varchar) end as start_station_id,
           cast(l_partkey % 110 as varchar) as end_station_id,
           cast(l_partkey as varchar) as bike_id,
           case when o_custkey % 11 = 0 then concat(chr(92), 'N')
                when o_custkey % 11 = 1 then '0'
                else cast(1890 + o_custkey % 140 as varchar) end as birth_year_raw,
           case when o_orderkey % 4 = 3 then concat(chr(92), 'N')
                when o_custkey % 13 = 4 then '3' when o_custkey % 13 = 5 then '7'
                else cast(o_orderkey % 4 as varchar) end as gender_raw
    from lineitem join orders on l_orderkey = o_orderkey
  ) x
)"""

_TRIPS_GEO = """
trips_geo as (
  select t.*, a.latitude as start_latitude, a.longitude as start_longitude,
         b.latitude as end_latitude, b.longitude as end_longitude
  from trips_raw t
  left join station_master a on t.start_station_id = a.station_id
  left join station_master b on t.end_station_id = b.station_id
)"""

_SLOT = """case when hour({ts}) < 6 then '00:00-06:00' when hour({ts}) < 12 then '06:00-12:00'
              when hour({ts}) < 18 then '12:00-18:00' when hour({ts}) < 24 then '18:00-24:00'
              else 'Unknown' end"""

_HAV = """round(2e0 * atan2(sqrt(h), sqrt(1e0 - h)) * 6371000e0, 2)"""

_H = """pow(sin((radians(end_latitude) - radians(start_latitude)) / 2e0), 2e0)
         + cos(radians(start_latitude)) * cos(radians(end_latitude))
         * pow(sin((radians(end_longitude) - radians(start_longitude)) / 2e0), 2e0)"""

_BIRTH = """case when try_cast(try_cast({c} as double) as int) between 1900 and 2020
              then try_cast(try_cast({c} as double) as int) end"""

_TRIPS_TYPED = f"""
trips_typed as (
  select round(dur_s / 60e0, 2) as trip_duration_min, start_ts as trip_start_ts, end_ts as trip_end_ts,
         start_station_id, start_station_name, end_station_id, end_station_name, bike_id,
         {_BIRTH.format(c='birth_year_raw')} as birth_year,
         try_cast(gender_raw as int) as gender,
         {_HAV} as trip_distance_m,
         {_SLOT.format(ts='start_ts')} as time_slot,
         cast(year(start_ts) as int) as year, cast(month(start_ts) as int) as month
  from (select *, {_H} as h from trips_geo) g
)"""

_TRIPS_CLEAN = """
trips_clean as (
  select * from trips_typed
  where trip_start_ts is not null and trip_end_ts is not null and trip_end_ts > trip_start_ts
    and time_slot is not null and trip_duration_min between 1 and 1440
    and trip_distance_m between 0 and 50000
    and start_station_id is not null and end_station_id is not null
)"""

_AGE_GROUP = """case when age between 10 and 100 then
                  case when age < 20 then '10-19' when age < 30 then '20-29' when age < 40 then '30-39'
                       when age < 50 then '40-49' when age < 60 then '50-59' when age < 70 then '60-69'
                       else '70+' end end"""

_KPI_BASE = f"""
kpi_base as (
  select year, month, trip_duration_min, round(trip_distance_m / 1000e0, 2) as trip_distance_km,
         gender, age, {_AGE_GROUP} as age_group,
         bike_id, start_station_name, end_station_name, time_slot
  from (select *, cast(year - birth_year as int) as age from trips_clean) c
)"""


def _mean2(col: str) -> str:
    """Mean of a 2-decimal column, summed exactly as decimals and rounded half-up once; 0 or empty -> null."""
    d = f"sum(cast({col} as decimal(18, 2)))"
    # the quotient as a 9-digit decimal, so that a tie at the third digit rounds up exactly
    mean = f"cast(cast({d} as double) / count({col}) as decimal(38, 9))"
    return f"case when {d} <> 0 then cast(round({mean}, 2) as double) end"


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"


_W_RAW = _with(_TRIPS_RAW)
_W_STATIONS = _with(_STATIONS)
_W_GEO = _with(_STATIONS, _TRIPS_RAW, _TRIPS_GEO)
_W_TYPED = _with(_STATIONS, _TRIPS_RAW, _TRIPS_GEO, _TRIPS_TYPED)
_W_CLEAN = _with(_STATIONS, _TRIPS_RAW, _TRIPS_GEO, _TRIPS_TYPED, _TRIPS_CLEAN)
_W_BASE = _with(_STATIONS, _TRIPS_RAW, _TRIPS_GEO, _TRIPS_TYPED, _TRIPS_CLEAN, _KPI_BASE)


def _share_sql(key: str, where: str) -> str:
    return (_W_BASE + f"""
select year, month, {key}, n,
       round((cast(n as double) / cast(sum(n) over (partition by year, month) as double)) * 100e0, 2) as pct
from (select year, month, {key}, count(*) as n from kpi_base {where} group by year, month, {key}) g""")


def _top_sql(key: str) -> str:
    return (_W_BASE + f"""
select year, month, {key}, n, cast(rk as int) as rk
from (select year, month, {key}, n,
             row_number() over (partition by year, month order by n desc, {key} asc nulls last) as rk
      from (select year, month, {key}, count(*) as n from kpi_base group by year, month, {key}) g) r
where rk <= 10""")


_LONG_BODY = """
shares as (
  select year, month, kpi, key, n,
         round((cast(n as double) / cast(sum(n) over (partition by year, month, kpi) as double)) * 100e0, 2) as pct,
         cast(null as int) as rk
  from (
    select year, month, 'gender' as kpi, cast(gender as varchar) as key, count(*) as n
    from kpi_base where gender is not null group by year, month, gender
    union all
    select year, month, 'age_group', age_group, count(*) from kpi_base
    where age_group is not null group by year, month, age_group
    union all
    select year, month, 'time_slot', time_slot, count(*) from kpi_base group by year, month, time_slot
  ) s
),
tops as (
  select year, month, kpi, key, n, cast(null as double) as pct, cast(rk as int) as rk
  from (
    select *, row_number() over (partition by year, month, kpi order by n desc, key asc nulls last) as rk
    from (
      select year, month, 'bike' as kpi, bike_id as key, count(*) as n from kpi_base group by year, month, bike_id
      union all
      select year, month, 'start_station', start_station_name, count(*) from kpi_base
      group by year, month, start_station_name
      union all
      select year, month, 'end_station', end_station_name, count(*) from kpi_base
      group by year, month, end_station_name
    ) c
  ) r where rk <= 10
),
long as (select * from shares union all select * from tops)
"""

_SLOTS = ["00:00-06:00", "06:00-12:00", "12:00-18:00", "18:00-24:00"]


def _slot_col(slot: str) -> str:
    a, b = slot.split("-")
    return f"timeslot_{a[:2]}_{b[:2]}_pct"


_GENDER_PIVOT = ", ".join(
    f"max(case when gender = {g} then pct end) as gender_{g}_pct" for g in (0, 1, 2, 3, 7))
_SLOT_PIVOT = ", ".join(
    f"max(case when time_slot = '{s}' then pct end) as {_slot_col(s)}" for s in _SLOTS)

_WIDE_BODY = """
select m.year, m.month, m.avg_trip_duration_min, m.avg_trip_distance_km, m.n_trips,
       """ + ", ".join(f"p.gender_{g}_pct" for g in (0, 1, 2)) + """,
       """ + ", ".join(f"p.{_slot_col(s)}" for s in _SLOTS) + """,
       coalesce(p.gender_distribution, '') as gender_distribution,
       coalesce(p.age_distribution, '') as age_distribution,
       p.top_bikes, p.top_start_stations, p.top_end_stations
from (
  select year, month, """ + _mean2("trip_duration_min") + """ as avg_trip_duration_min,
         """ + _mean2("trip_distance_km") + """ as avg_trip_distance_km, count(*) as n_trips
  from kpi_base group by year, month
) m left join (
  select year, month,
         """ + ", ".join(
    f"max(case when kpi = 'gender' and key = '{g}' then pct end) as gender_{g}_pct" for g in (0, 1, 2)) + """,
         """ + ", ".join(
    f"max(case when kpi = 'time_slot' and key = '{s}' then pct end) as {_slot_col(s)}" for s in _SLOTS) + """,
         string_agg(case when kpi = 'gender' then key || ':' || printf('%.2f', pct) end, ';'
                    order by try_cast(key as int)) as gender_distribution,
         string_agg(case when kpi = 'age_group' then key || ':' || printf('%.2f', pct) end, ';' order by key) as age_distribution,
         string_agg(case when kpi = 'bike' then coalesce(key, '') || ':' || cast(n as varchar) end, ';' order by rk) as top_bikes,
         string_agg(case when kpi = 'start_station' then coalesce(key, '') || ':' || cast(n as varchar) end, ';' order by rk) as top_start_stations,
         string_agg(case when kpi = 'end_station' then coalesce(key, '') || ':' || cast(n as varchar) end, ';' order by rk) as top_end_stations
  from long group by year, month
) p on m.year = p.year and m.month = p.month
"""
_WIDE = _W_BASE[:-1] + "," + _LONG_BODY + _WIDE_BODY

_REASONS = {
    "missing_start_ts": "trip_start_ts is not null",
    "missing_end_ts": "trip_end_ts is not null",
    "end_not_after_start": "trip_end_ts > trip_start_ts",
    "missing_time_slot": "time_slot is not null",
    "bad_duration": "trip_duration_min between 1 and 1440",
    "bad_distance": "trip_distance_m between 0 and 50000",
    "missing_start_station": "start_station_id is not null",
    "missing_end_station": "end_station_id is not null",
}


def _reject_sql() -> str:
    parts = [f"cast(count_if(not coalesce({c}, false)) as bigint) as n_{r}" for r, c in _REASONS.items()]
    valid = " and ".join(f"({c})" for c in _REASONS.values())
    return (_W_TYPED + "select year, month, count(*) as n_rows, " + ", ".join(parts)
            + f", cast(count_if(coalesce({valid}, false)) as bigint) as n_valid"
            + " from trips_typed group by year, month")


_VALID = "coalesce(" + " and ".join(f"({c})" for c in _REASONS.values()) + ", false)"


def _counts_sql() -> str:
    parts = [f"cast(count_if(not coalesce({c}, false)) as bigint) as n_{r}" for r, c in _REASONS.items()]
    return (f"count(*) as n_before, cast(count_if({_VALID}) as bigint) as n_valid, "
            f"cast(count_if(not {_VALID}) as bigint) as n_rejected, " + ", ".join(parts))


_OLD_CHAIN = """
trips_old_raw as (
  select dur_s * 1000 as dur_ms, date_trunc('minute', start_ts) as start_ts,
         date_trunc('minute', end_ts) as end_ts, start_station_id, start_station_name,
         end_station_id, end_station_name, bike_id, gender_raw
  from trips_raw
),
trips_old_geo as (
  select t.*, a.latitude as start_latitude, a.longitude as start_longitude,
         b.latitude as end_latitude, b.longitude as end_longitude
  from trips_old_raw t
  left join station_master a on t.start_station_id = a.station_id
  left join station_master b on t.end_station_id = b.station_id
),
trips_old_typed as (
  select round(dur_ms / 60000e0, 2) as trip_duration_min, start_ts as trip_start_ts, end_ts as trip_end_ts,
         start_station_id, start_station_name, end_station_id, end_station_name, bike_id,
         cast(null as int) as birth_year, try_cast(gender_raw as int) as gender,
         """ + _HAV + """ as trip_distance_m,
         """ + _SLOT.format(ts='start_ts') + """ as time_slot,
         cast(year(start_ts) as int) as year, cast(month(start_ts) as int) as month
  from (select *, """ + _H + """ as h from trips_old_geo) g
),
trips_old_clean as (
  select * from trips_old_typed
  where trip_start_ts is not null and trip_end_ts is not null and trip_end_ts > trip_start_ts
    and time_slot is not null and trip_duration_min between 1 and 1440
    and trip_distance_m between 0 and 50000
    and start_station_id is not null and end_station_id is not null
)"""

_W_OLD = _with(_STATIONS, _TRIPS_RAW, _OLD_CHAIN)
_W_BOTH = _with(_STATIONS, _TRIPS_RAW, _TRIPS_GEO, _TRIPS_TYPED, _TRIPS_CLEAN, _OLD_CHAIN)
_FIRST_MONTH = "(select min(year * 100 + month) from trips_clean)"

_LANDING = r"""
with months as (select distinct strftime(o_orderdate, '%Y%m') as p from orders),
years as (select distinct strftime(o_orderdate, '%Y') as p from orders),
paths as (
  select '/landing/' || p || '-hubway-tripdata.csv' as path from months
  union all select '/landing/' || p || '1-hubway-tripdata.csv' from months
  union all select '/landing/hubway_Trips_' || p || '.csv' from years
  union all select '/landing/hubway_Trips_' || p || '.csv.bak' from years
  union all select '/landing/hubway_Trips_' || p || '_1.csv' from years
),
named as (select path, regexp_extract(path, '[^/]*$', 0) as file_name from paths),
ext as (
  select *, regexp_extract(file_name, '^(\d{6})-hubway-tripdata\.csv$', 1) as np,
            regexp_extract(file_name, '^hubway_Trips_(\d{4})\.csv$', 1) as op
  from named
),
m as (
  select path, file_name, case when np <> '' then 'new' else 'old' end as layout,
         case when np <> '' then np else op end as period
  from ext where np <> '' or op <> ''
)
select path, file_name, layout, period, '/data/bikesharing/raw/' || period || '/data.csv' as target from m
"""

_ORACLES: dict[str, str] = {
    "scan_new_layout": _W_GEO + f"""
select strftime(start_ts, '%Y%m') as period, cast(year(start_ts) as int) as year,
       cast(month(start_ts) as int) as month, round(dur_s / 60e0, 2) as trip_duration_min,
       start_ts as trip_start_ts, end_ts as trip_end_ts, {_SLOT.format(ts='start_ts')} as time_slot,
       start_station_id, start_station_name, end_station_id, end_station_name, bike_id,
       birth_year_raw, gender_raw, start_latitude, start_longitude, end_latitude, end_longitude
from trips_geo""",
    "scan_old_layout": _W_RAW + f"""
select strftime(start_ts, '%Y') as period, cast(year(start_ts) as int) as year,
       cast(month(start_ts) as int) as month, round((dur_s * 1000) / 60000e0, 2) as trip_duration_min,
       date_trunc('minute', start_ts) as trip_start_ts, date_trunc('minute', end_ts) as trip_end_ts,
       {_SLOT.format(ts='start_ts')} as time_slot, start_station_id, start_station_name,
       end_station_id, end_station_name, bike_id, gender_raw
from trips_raw""",
    "clean_new_layout": _W_CLEAN + "select * from trips_clean",
    "clean_old_layout": _W_OLD + "select * from trips_old_clean",
    "unify_layouts": _W_BOTH + "select * from trips_clean union all select * from trips_old_clean",
    "merge_split_years": _W_RAW + """
select cast(year(start_ts) as int) as year, count(*) as n_rows, cast(sum(dur_s * 1000) as bigint) as sum_dur_ms
from trips_raw group by year(start_ts)""",
    "landing_manifest": _LANDING,
    "month_spine": """
select year, cast(m as int) as month, printf('%04d%02d', year, cast(m as int)) as period
from (select year, unnest(generate_series(1, 12)) as m
      from (select distinct cast(year(o_orderdate) as int) as year from orders) y) s""",
    "clean_roundtrip": _W_CLEAN + "select * from trips_clean",
    "month_slice": _W_CLEAN + f"select * from trips_clean where year * 100 + month = {_FIRST_MONTH}",
    "dynamic_overwrite": _W_CLEAN + f"""
select * from trips_clean
where not (year * 100 + month = {_FIRST_MONTH} and minute(trip_start_ts) >= 30)""",
    "time_slot": f"select event_id, ts, {_SLOT.format(ts='ts')} as time_slot from events",
    "station_join": _W_GEO + """
select trip_order, trip_line, start_station_id, end_station_id,
       start_latitude, start_longitude, end_latitude, end_longitude from trips_geo""",
    "haversine_distance": _W_GEO + f"""
select trip_order, trip_line, start_station_id, end_station_id, {_HAV} as trip_distance_m
from (select *, {_H} as h from trips_geo) g""",
    "trip_duration_new": _W_RAW + """
select trip_order, trip_line, dur_s, round(dur_s / 60e0, 2) as trip_duration_min from trips_raw""",
    "trip_duration_old": _W_RAW + """
select trip_order, trip_line, dur_s * 1000 as dur_ms, round((dur_s * 1000) / 60000e0, 2) as trip_duration_min
from trips_raw""",
    "normalize_birth_year": _W_RAW + f"""
select trip_order, trip_line, birth_year_raw, {_BIRTH.format(c='birth_year_raw')} as birth_year from trips_raw""",
    "normalize_gender": _W_RAW + """
select trip_order, trip_line, gender_raw, try_cast(gender_raw as int) as gender from trips_raw""",
    "rider_age": _W_CLEAN + """
select year, month, birth_year, cast(year - birth_year as int) as age from trips_clean""",
    "year_month_label": _W_CLEAN + """
select year, month, printf('%04d-%02d', year, month) as year_month from trips_clean""",
    "station_master": _W_STATIONS + "select station_id, latitude, longitude from station_master",
    "clean_trips": _W_CLEAN + "select * from trips_clean",
    "reject_reasons": _reject_sql(),
    "trip_counts": _W_CLEAN + "select year, month, count(*) as n_trips from trips_clean group by year, month",
    "station_duplicates": _W_STATIONS + """
select station_id, count(*) as n_rows from station_raw group by station_id having count(*) > 1""",
    "unmatched_stations": _with(_STATIONS, _TRIPS_RAW) + """
select distinct station_id from (
  select start_station_id as station_id from trips_raw union all select end_station_id from trips_raw) t
where station_id is not null
  and station_id not in (select station_id from station_master)""",
    "kpi_avg_duration": _W_BASE + """
select year, month, """ + _mean2("trip_duration_min") + """ as avg_trip_duration_min
from kpi_base group by year, month""",
    "kpi_avg_distance": _W_BASE + """
select year, month, """ + _mean2("trip_distance_km") + """ as avg_trip_distance_km
from kpi_base group by year, month""",
    "kpi_gender_share": _share_sql("gender", "where gender is not null"),
    "kpi_age_share": _share_sql("age_group", "where age_group is not null"),
    "kpi_timeslot_share": _share_sql("time_slot", ""),
    "kpi_top_bikes": _top_sql("bike_id"),
    "kpi_top_start_stations": _top_sql("start_station_name"),
    "kpi_top_end_stations": _top_sql("end_station_name"),
    "distinct_periods": _W_CLEAN + """
select distinct year, month, printf('%04d-%02d', year, month) as year_month from trips_clean""",
    "kpi_gender_pivot": "select year, month, " + _GENDER_PIVOT + " from ("
                        + _share_sql("gender", "where gender is not null") + ") s group by year, month",
    "kpi_timeslot_pivot": "select year, month, " + _SLOT_PIVOT + " from ("
                          + _share_sql("time_slot", "") + ") s group by year, month",
    "kpi_report_long": _W_BASE[:-1] + "," + _LONG_BODY + "select * from long",
    "kpi_report_wide": _WIDE,
    "kpi_report_sink": _WIDE + " where m.year > (select min(year) from kpi_base)",
    "build_all": _W_BOTH[:-1] + "," + _KPI_BASE.replace(
        "from trips_clean", "from (select * from trips_clean union all select * from trips_old_clean) b")
                 + "," + _LONG_BODY + _WIDE_BODY,
    "incremental_rebuild": _W_CLEAN[:-1] + """,
periods as (select p, row_number() over (order by p) as no from (select distinct strftime(start_ts, '%Y%m') as p from trips_raw) d)
select trips_clean.* from trips_clean join periods on p = printf('%04d%02d', year, month)
where no <> 2 and not (no = 1 and minute(trip_start_ts) >= 30)""",
    "kpi_report_merged": _WIDE,
    "kpi_report_json": _WIDE,
    "clean_write_counts": _W_BOTH + f"""
select 'new' as layout, (select count(*) from trips_geo) as n_read, {_counts_sql()} from trips_typed
union all
select 'old' as layout, (select count(*) from trips_raw) as n_read, {_counts_sql()} from trips_old_typed""",
    "file_counts": _W_TYPED + f"""
select printf('%04d%02d', year, month) as period, count(*) as n_rows, cast(count_if({_VALID}) as bigint) as n_valid
from trips_typed group by year, month""",
    "contract_check": _W_CLEAN[:-1] + """,
cols as (select unnest(['trip_duration_min', 'trip_start_ts', 'trip_end_ts', 'start_station_id', 'start_station_name',
                        'end_station_id', 'end_station_name', 'bike_id', 'birth_year', 'gender', 'trip_distance_m',
                        'time_slot', 'year', 'month']) as c)
select 'whole' as input, 'has ' || c as "check", true as ok from cols
union all select 'narrow', 'has ' || c, c not in ('gender', 'birth_year') from cols
union all select 'empty', 'has ' || c, true from cols
union all select 'whole', 'has rows', count(*) > 0 from trips_clean
union all select 'narrow', 'has rows', count(*) > 0 from trips_clean
union all select 'empty', 'has rows', count(*) > 0 from trips_clean where trip_duration_min < 0""",
    "landing_listing": _W_RAW + """
select p || '-hubway-tripdata.csv' as file_name, 'new' as layout, p as period, '/data/bikesharing/raw/' || p || '/data.csv' as target
from (select distinct strftime(start_ts, '%Y%m') as p from trips_raw) m
union all
select 'hubway_Trips_' || p || '.csv', 'old', p, '/data/bikesharing/raw/' || p || '/data.csv'
from (select distinct strftime(start_ts, '%Y') as p from trips_raw) y""",
    "clean_periods": _W_CLEAN + """
select distinct year, month, printf('%04d-%02d', year, month) as year_month from trips_clean""",
    "bike_history": _W_CLEAN + "select * from trips_clean where bike_id = (select min(bike_id) from trips_clean)",
    "kpi_top_bikes_threshold": _top_sql("bike_id"),
    "month_gaps": _W_BASE[:-1] + """,
here as (select * from kpi_base where not (year = (select min(year) + 1 from kpi_base) and month = 7)),
spine as (select year, cast(m as int) as month, year * 12 + m as no
          from (select year, unnest(generate_series(1, 12)) as m from (select distinct year from here) y) x),
full_months as (select year * 12 + month as no, count(*) as n_trips, """ + _mean2("trip_duration_min") + """ as avg_trip_duration_min,
                       """ + _mean2("trip_distance_km") + """ as avg_trip_distance_km
                from here group by year, month)
select s.year, s.month, printf('%04d%02d', s.year, s.month) as period, coalesce(n_trips, 0) as n_trips,
       avg_trip_duration_min, avg_trip_distance_km, n_trips is null as is_gap,
       case when n_trips is null then (
         select count(*) from spine g
         where g.no > coalesce((select max(no) from full_months f where f.no < s.no), -1)
           and g.no < coalesce((select min(no) from full_months f where f.no > s.no), 1000000)) else 0 end as gap_months
from spine s left join full_months m using (no)""",
    "station_quality": _W_STATIONS + """
select count(*) as n_rows, (select count(*) from station_master) as n_valid,
       count(*) - (select count(*) from station_master) as n_rejected,
       (select count(*) from (select station_id from station_raw group by station_id having count(*) > 1) d) as n_duplicated_ids
from station_raw""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per registered query (same column names and types)."""
    return {**_ORACLES, **_llm()[1]}
