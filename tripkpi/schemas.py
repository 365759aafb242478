"""Schemas, layout descriptions and fixed values of the trip pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay equal to the source pipeline's values for the
# results to match; they are listed plainly and together on purpose.
# ---------------------------------------------------------------------------
EARTH_RADIUS_M = 6371000.0

TIME_SLOTS = ["00:00-06:00", "06:00-12:00", "12:00-18:00", "18:00-24:00"]
UNKNOWN_SLOT = "Unknown"
SLOT_HOURS = 6  # each slot spans this many hours, starting at midnight

MIN_DURATION_MIN = 1
MAX_DURATION_MIN = 1440
MIN_DISTANCE_M = 0
MAX_DISTANCE_M = 50000

BIRTH_YEAR_MIN = 1900
BIRTH_YEAR_MAX = 2020
NULL_MARKER = "\\N"          # the two characters backslash, N
BIRTH_YEAR_MISSING = "0"

AGE_MIN = 10
AGE_MAX = 100
AGE_GROUPS = ["10-19", "20-29", "30-39", "40-49", "50-59", "60-69", "70+"]
AGE_GROUP_UPPER = [20, 30, 40, 50, 60, 70]  # exclusive upper edge of each bounded group

GENDER_CODES = [0, 1, 2]     # 0 unregistered, 1 male, 2 female
TOP_K = 10

STATION_LAT_RANGE = (-90, 90)
STATION_LON_RANGE = (-180, 180)

NEW_LAYOUT_TS_FORMAT = None            # ISO "yyyy-MM-dd HH:mm:ss"
OLD_LAYOUT_TS_FORMAT = "M/d/yyyy H:mm"
NEW_LAYOUT_DURATION_DIVISOR = 60.0     # seconds -> minutes
OLD_LAYOUT_DURATION_DIVISOR = 60000.0  # milliseconds -> minutes

# Landing file names and the raw folder they are moved to.
LANDING_NEW_PATTERN = r"(\d{6})-hubway-tripdata\.csv$"
LANDING_OLD_PATTERN = r"hubway_Trips_(\d{4})\.csv$"
LANDING_SPLIT_PATTERN = r"hubway_Trips_(\d{4})_.*\.csv$"
LANDING_NEW_NAME = "{period}-hubway-tripdata.csv"
LANDING_OLD_NAME = "hubway_Trips_{period}.csv"
RAW_ROOT = "/data/bikesharing/raw"
RAW_FILE_NAME = "data.csv"
STATIONS_FILE_NAME = "Hubway_Stations_2011_2016.csv"

# ---------------------------------------------------------------------------
# Raw CSV layouts: header names that are read, and what they become.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """How one raw CSV layout maps onto the clean trip contract."""

    name: str
    period_digits: int            # 6 -> yyyyMM folders, 4 -> yyyy folders
    duration: str
    duration_divisor: float
    start: str
    end: str
    ts_format: str | None
    start_id: str
    start_name: str
    end_id: str
    end_name: str
    bike: str
    gender: str
    birth_year: str | None = None
    start_lat: str | None = None
    start_lon: str | None = None
    end_lat: str | None = None
    end_lon: str | None = None

    @property
    def required(self) -> list[str]:
        names = [self.duration, self.start, self.end, self.start_id, self.start_name,
                 self.end_id, self.end_name, self.bike, self.gender, self.birth_year,
                 self.start_lat, self.start_lon, self.end_lat, self.end_lon]
        return [n for n in names if n is not None]

    @property
    def has_coordinates(self) -> bool:
        return self.start_lat is not None


NEW_LAYOUT = Layout(
    name="new", period_digits=6,
    duration="tripduration", duration_divisor=NEW_LAYOUT_DURATION_DIVISOR,
    start="starttime", end="stoptime", ts_format=NEW_LAYOUT_TS_FORMAT,
    start_id="start station id", start_name="start station name",
    end_id="end station id", end_name="end station name",
    bike="bikeid", gender="gender", birth_year="birth year",
    start_lat="start station latitude", start_lon="start station longitude",
    end_lat="end station latitude", end_lon="end station longitude",
)

OLD_LAYOUT = Layout(
    name="old", period_digits=4,
    duration="Duration", duration_divisor=OLD_LAYOUT_DURATION_DIVISOR,
    start="Start date", end="End date", ts_format=OLD_LAYOUT_TS_FORMAT,
    start_id="Start station number", start_name="Start station name",
    end_id="End station number", end_name="End station name",
    bike="Bike number", gender="Gender",
)

STATION_COLUMNS = {"id": "Station ID", "lat": "Latitude", "lon": "Longitude"}

# ---------------------------------------------------------------------------
# Clean trip contract (both layouts produce exactly this, in this order).
# ---------------------------------------------------------------------------
CLEAN_TRIP_SCHEMA = T.StructType([
    T.StructField("trip_duration_min", T.DoubleType()),
    T.StructField("trip_start_ts", T.TimestampNTZType()),
    T.StructField("trip_end_ts", T.TimestampNTZType()),
    T.StructField("start_station_id", T.StringType()),
    T.StructField("start_station_name", T.StringType()),
    T.StructField("end_station_id", T.StringType()),
    T.StructField("end_station_name", T.StringType()),
    T.StructField("bike_id", T.StringType()),
    T.StructField("birth_year", T.IntegerType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("trip_distance_m", T.DoubleType()),
    T.StructField("time_slot", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])
CLEAN_TRIP_COLUMNS = [f.name for f in CLEAN_TRIP_SCHEMA.fields]
PARTITION_COLUMNS = ["year", "month"]

# Columns the KPI job requires (all 14: birth_year and gender are used too).
KPI_REQUIRED_COLUMNS = list(CLEAN_TRIP_COLUMNS)

STATION_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])
