"""Monthly KPIs.

Single KPIs are plain ``groupBy(year, month, key)`` aggregations. The full
report (`month_counts` / `kpi_report_long` / `kpi_report_wide`) computes all
of them from ONE scan: a GROUPING SETS aggregation over the six KPI keys plus
the month itself, partial-aggregated map-side, then a rank window with a
partial group limit, a share-total window and one final
``groupBy(year, month)``. No per-month driver loop, no collect.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripkpi import schemas as S
from tripkpi.functions import columns as C

MONTH = ["year", "month"]

# KPI name -> source column of the key. Order fixes the grouping-set order.
KPI_KEYS = {
    "gender": "gender",
    "age_group": "age_group",
    "bike": "bike_id",
    "start_station": "start_station_name",
    "end_station": "end_station_name",
    "time_slot": "time_slot",
}
SHARE_KPIS = ["gender", "age_group", "time_slot"]      # percent of the month
TOPK_KPIS = ["bike", "start_station", "end_station"]   # top-k by trip count
NULL_DROPPED_KPIS = ["gender", "age_group"]            # null key is not a group


def kpi_base(clean: DataFrame) -> DataFrame:
    """P13-P16 on clean trips: km, age, age group; only the columns KPIs need.

    ``dur_cents`` / ``km_cents`` are the 2-decimal values as exact integers,
    computed once per trip (not per grouping set) for the exact means.
    """
    age = C.rider_age("year", "birth_year")
    km = C.distance_km("trip_distance_m")
    return clean.select(
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        "trip_duration_min",
        km.alias("trip_distance_km"),
        _cents(F.col("trip_duration_min")).alias("dur_cents"),
        _cents(km).alias("km_cents"),
        "gender",
        age.alias("age"),
        C.age_group(age).alias("age_group"),
        "bike_id", "start_station_name", "end_station_name", "time_slot",
    )


def _cents(value: Column) -> Column:
    """A value that carries 2 decimals as an exact integer count of hundredths."""
    return F.rint(value * 100).cast("bigint")


def _avg_or_null(cents_col: str) -> Column:
    """Mean of a non-negative 2-decimal column, rounded half-up to 2 decimals.

    Works on the column's integer hundredths, so the mean is exact:
    ``(2*sum + n) div (2*n)``. A double ``avg`` would depend on summation
    order (i.e. on partitioning) and could round a .xx5 tie either way from
    run to run. An empty month or a mean of 0 gives null.
    """
    c = f"`{cents_col}`"
    rounded = F.expr(f"(2 * sum({c}) + count({c})) div (2 * count({c}))")
    return F.when(F.sum(cents_col) != 0, rounded.cast("double") / F.lit(100.0))


# --- A1, A2 -----------------------------------------------------------------

def avg_duration(base: DataFrame) -> DataFrame:
    return base.groupBy(*MONTH).agg(_avg_or_null("dur_cents").alias("avg_trip_duration_min"))


def avg_distance(base: DataFrame) -> DataFrame:
    return base.groupBy(*MONTH).agg(_avg_or_null("km_cents").alias("avg_trip_distance_km"))


# --- A3, A4, A5: shares -------------------------------------------------------

def share_by(base: DataFrame, key: str, drop_null: bool, alias: str | None = None) -> DataFrame:
    """Count per (year, month, key) and its percent of the month's counted trips.

    The denominator is the sum over the month's groups (after the null filter),
    computed by a window over the already aggregated, tiny group rows.
    """
    df = base.filter(F.col(key).isNotNull()) if drop_null else base
    counts = df.groupBy(*MONTH, key).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*MONTH))
    out = counts.withColumn("pct", C.share_pct(F.col("n"), total))
    return out.withColumnRenamed(key, alias) if alias else out


def gender_share(base: DataFrame) -> DataFrame:
    return share_by(base, "gender", drop_null=True)


def age_share(base: DataFrame) -> DataFrame:
    return share_by(base, "age_group", drop_null=True)


def timeslot_share(base: DataFrame) -> DataFrame:
    return share_by(base, "time_slot", drop_null=False)


# --- A6, A7, A8 + T1: top-k ---------------------------------------------------

def top_k(base: DataFrame, key: str, k: int = S.TOP_K) -> DataFrame:
    """Top-k keys per month by trip count; ties broken by key ascending, nulls last.

    ``row_number() <= k`` over (year, month) lets Spark insert a partial
    WindowGroupLimit before the shuffle, so at most k rows per month leave
    each task even when one key holds a large share of the trips.
    """
    counts = base.groupBy(*MONTH, key).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*MONTH).orderBy(F.col("n").desc(), F.col(key).asc_nulls_last())
    return counts.withColumn("rk", F.row_number().over(w)).filter(F.col("rk") <= k)


def top_bikes(base: DataFrame, k: int = S.TOP_K) -> DataFrame:
    return top_k(base, "bike_id", k)


def top_start_stations(base: DataFrame, k: int = S.TOP_K) -> DataFrame:
    return top_k(base, "start_station_name", k)


def top_end_stations(base: DataFrame, k: int = S.TOP_K) -> DataFrame:
    return top_k(base, "end_station_name", k)


# --- S9: gaps ----------------------------------------------------------------------

def densify_months(report: DataFrame, spine: DataFrame, counts: list[str]) -> DataFrame:
    """A monthly report with a row for every month of the spine (``year, month, period``): gaps show as rows.

    ``counts`` are 0 in a month without trips, other measures null. ``is_gap``
    marks those months and ``gap_months`` says how many months in a row the gap
    lasts (0 where there is none). The window runs over calendar months only.
    """
    marked = report.withColumn("_here", F.lit(True))
    full = spine.join(marked, MONTH, "left").withColumn("is_gap", F.col("_here").isNull()).drop("_here")
    full = full.fillna(0, subset=counts)
    by_month = Window.orderBy(*MONTH)
    run = F.row_number().over(by_month) - F.row_number().over(Window.partitionBy("is_gap").orderBy(*MONTH))
    runs = full.withColumn("_run", run)
    length = F.count(F.lit(1)).over(Window.partitionBy("is_gap", "_run"))
    return runs.withColumn("gap_months", F.when(F.col("is_gap"), length).otherwise(0)).drop("_run")


# --- A9 -------------------------------------------------------------------------

def distinct_periods(clean: DataFrame) -> DataFrame:
    """Distinct (year, month) with its label, ascending."""
    return (clean.select(F.col("year").cast("int").alias("year"),
                         F.col("month").cast("int").alias("month")).distinct()
            .withColumn("year_month", C.year_month_label("year", "month"))
            .orderBy(*MONTH))


# --- R1, R2: pivots ---------------------------------------------------------------

def _slot_column(slot: str) -> str:
    start, end = slot.split("-")
    return f"timeslot_{start[:2]}_{end[:2]}_pct"


def gender_pivot(base: DataFrame, codes: list[int] | None = None) -> DataFrame:
    """One row per month with a ``gender_<code>_pct`` column per code present.

    Spark finds the codes (one small distinct job over the aggregated shares,
    limited by ``spark.sql.pivotMaxValues``), so every code gets its column,
    as in the source report. ``codes`` names the columns wanted instead. A
    month with no trip of a code gets null (blank), not 0.
    """
    pivot = gender_share(base).groupBy(*MONTH)
    wide = (pivot.pivot("gender", codes) if codes else pivot.pivot("gender")).agg(F.first("pct"))
    return wide.select(*MONTH, *[F.col(f"`{c}`").alias(f"gender_{c}_pct") for c in wide.columns if c not in MONTH])


def timeslot_pivot(base: DataFrame) -> DataFrame:
    shares = timeslot_share(base)
    wide = shares.groupBy(*MONTH).pivot("time_slot", S.TIME_SLOTS).agg(F.first("pct"))
    return wide.select(*MONTH, *[F.col(f"`{s}`").alias(_slot_column(s)) for s in S.TIME_SLOTS])


# --- A11: the one-pass report --------------------------------------------------------

def _grouping_id_of(keys: list[str], included: list[str]) -> int:
    """grouping_id() value for a set: bit set for every key NOT in the set."""
    n = len(keys)
    return sum(1 << (n - 1 - i) for i, k in enumerate(keys) if k not in included)


def month_counts(base: DataFrame, with_month_totals: bool = False) -> DataFrame:
    """One scan: GROUPING SETS over (year, month, <each KPI key>) [and (year, month)].

    Returns ``year, month, kpi, key, n`` (+ ``avg_trip_duration_min``,
    ``avg_trip_distance_km`` on the ``kpi = 'month'`` rows when requested).
    Sets are told apart by ``grouping_id()``, never by ``key IS NULL``: gender
    and age group are legitimately null.
    """
    keys = list(KPI_KEYS.values())
    sets = [[*MONTH, col] for col in keys]
    if with_month_totals:
        sets.append(list(MONTH))
    aggs = [F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")]
    if with_month_totals:
        aggs += [_avg_or_null("dur_cents").alias("avg_trip_duration_min"),
                 _avg_or_null("km_cents").alias("avg_trip_distance_km")]
    grouped = base.groupingSets(sets, *MONTH, *keys).agg(*aggs)
    kpi, key = _kpi_and_key(keys, with_month_totals)
    out = grouped.select(*MONTH, kpi.alias("kpi"), key.alias("key"), "n",
                         *(["avg_trip_duration_min", "avg_trip_distance_km"]
                           if with_month_totals else []))
    return out.filter(~(F.col("kpi").isin(NULL_DROPPED_KPIS) & F.col("key").isNull()))


def _kpi_and_key(keys: list[str], with_month_totals: bool) -> tuple[Column, Column]:
    """The KPI's name and its key as text, told from the grouping id ``gid``."""
    kpi = None
    key = None
    for name, col in KPI_KEYS.items():
        gid = _grouping_id_of(MONTH + keys, MONTH + [col])
        cond = F.col("gid") == gid
        kpi = F.when(cond, F.lit(name)) if kpi is None else kpi.when(cond, F.lit(name))
        key = (F.when(cond, F.col(col).cast("string")) if key is None
               else key.when(cond, F.col(col).cast("string")))
    if with_month_totals:
        kpi = kpi.when(F.col("gid") == _grouping_id_of(MONTH + keys, MONTH), F.lit("month"))
    return kpi, key


def month_state(clean: DataFrame) -> DataFrame:
    """The mergeable form of the report: ``year, month, kpi, key, n`` and sums for the means, one scan.

    Every column but the key columns is a sum, so the states of two sets of
    trips are merged by adding them up (`merge_states`). ``dur_*`` and ``km_*``
    (how many values, and their sum in hundredths) are set on the ``month`` rows.
    """
    keys = list(KPI_KEYS.values())
    sets = [[*MONTH, col] for col in keys] + [list(MONTH)]
    grouped = kpi_base(clean).groupingSets(sets, *MONTH, *keys).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"),
        F.count("dur_cents").alias("dur_n"), F.sum("dur_cents").alias("dur_cents"),
        F.count("km_cents").alias("km_n"), F.sum("km_cents").alias("km_cents"))
    kpi, key = _kpi_and_key(keys, True)
    is_month = F.col("gid") == _grouping_id_of(MONTH + keys, MONTH)
    out = grouped.select(*MONTH, kpi.alias("kpi"), key.alias("key"), "n",
                         *[F.when(is_month, F.coalesce(F.col(c), F.lit(0))).alias(c) for c in STATE_SUMS[1:]])
    return out.filter(~(F.col("kpi").isin(NULL_DROPPED_KPIS) & F.col("key").isNull()))


STATE_SUMS = ["n", "dur_n", "dur_cents", "km_n", "km_cents"]


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all trips together, from the states of parts of them."""
    both = reduce(DataFrame.unionByName, states)
    return both.groupBy(*MONTH, "kpi", "key").agg(*[F.sum(c).alias(c) for c in STATE_SUMS])


def report_from_state(state: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """The wide report of a state, equal to `kpi_report_wide` of the trips it sums up."""
    def mean(name: str) -> Column:
        rounded = F.expr(f"(2 * {name}_cents + {name}_n) div (2 * {name}_n)")
        return F.when(F.col(f"{name}_cents") != 0, rounded.cast("double") / F.lit(100.0))

    counts = state.select(*MONTH, "kpi", "key", "n", mean("dur").alias("avg_trip_duration_min"),
                          mean("km").alias("avg_trip_distance_km"))
    return _wide(counts, k)


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    """Top-k for the ranked KPIs and shares for the share KPIs; one branch, one scan.

    1. Rank window over (year, month, kpi[, key for share KPIs]): every share
       row sits alone in its partition (rank 1), so the plain ``rk <= k``
       filter keeps all of them and Spark inserts a partial WindowGroupLimit:
       at most k rows per (month, ranked KPI) leave each task.
    2. Share denominators: conditional window sums over (year, month) on the
       already limited rows. The (year, month) partitioning is reused by a
       following ``groupBy(year, month)`` without another shuffle.
    Output: the input columns plus ``pct`` and ``rk``.
    """
    kpi, n = F.col("kpi"), F.col("n")
    is_share = kpi.isin(SHARE_KPIS)
    is_top = kpi.isin(TOPK_KPIS)
    rank_w = (Window.partitionBy(*MONTH, "kpi", F.when(is_share, F.col("key")))
              .orderBy(n.desc(), F.col("key").asc_nulls_last()))
    kept = counts.withColumn("_rk", F.row_number().over(rank_w)).filter(F.col("_rk") <= k)
    month_w = Window.partitionBy(*MONTH)
    total = None
    for name in SHARE_KPIS:
        t = F.sum(F.when(kpi == name, n)).over(month_w)
        total = F.when(kpi == name, t) if total is None else total.when(kpi == name, t)
    return (kept.withColumn("pct", F.when(is_share, C.share_pct(n, total)))
                .withColumn("rk", F.when(is_top, F.col("_rk")))
                .drop("_rk"))


def kpi_report_long(clean: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """All KPIs of all months as rows ``year, month, kpi, key, n, pct, rk``."""
    return _ranked(month_counts(kpi_base(clean)), k).select(*MONTH, "kpi", "key", "n", "pct", "rk")


def kpi_report_wide(clean: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """One row per month: scalars, pivoted shares, ordered age and top-k lists.

    Plan: one scan -> GROUPING SETS aggregate (incl. the month itself) ->
    limited rank window -> share totals -> one ``groupBy(year, month)`` with
    conditional aggregates (pivot and list building in the same aggregation,
    no joins). Every month appears (its ``kpi = 'month'`` row is always
    present), even when one KPI has no rows for it. Lists are
    ``array<struct>`` in rank order (top-k) or key order (age groups, gender
    codes); an empty list is ``[]``, not null. ``gender_distribution`` holds
    the share of every code present; the columns of the codes 0, 1, 2 repeat
    the usual ones.
    """
    return _wide(month_counts(kpi_base(clean), with_month_totals=True), k)


def _wide(counts: DataFrame, k: int) -> DataFrame:
    """`month_counts` with month totals -> the wide report."""
    rows = _ranked(counts, k)

    is_ = lambda name: F.col("kpi") == name
    aggs = [
        F.max(F.when(is_("month"), F.col("avg_trip_duration_min"))).alias("avg_trip_duration_min"),
        F.max(F.when(is_("month"), F.col("avg_trip_distance_km"))).alias("avg_trip_distance_km"),
        F.max(F.when(is_("month"), F.col("n"))).alias("n_trips"),
    ]
    for code in S.GENDER_CODES:
        aggs.append(F.max(F.when(is_("gender") & (F.col("key") == str(code)), F.col("pct")))
                    .alias(f"gender_{code}_pct"))
    for slot in S.TIME_SLOTS:
        aggs.append(F.max(F.when(is_("time_slot") & (F.col("key") == slot), F.col("pct")))
                    .alias(_slot_column(slot)))
    aggs.append(F.collect_list(F.when(is_("age_group"), F.struct(
        F.col("key").alias("age_group"), F.col("pct")))).alias("_age"))
    aggs.append(F.collect_list(F.when(is_("gender"), F.struct(
        F.col("key").cast("int").alias("code"), F.col("pct")))).alias("_gender"))
    for name, out in [("bike", "top_bikes"), ("start_station", "top_start_stations"),
                      ("end_station", "top_end_stations")]:
        aggs.append(F.collect_list(F.when(is_(name), F.struct(
            "rk", F.col("key").alias("key"), "n"))).alias(f"_{out}"))
    wide = rows.groupBy(*MONTH).agg(*aggs)

    def by_rank(col: str) -> Column:
        return F.transform(F.array_sort(F.col(col)),
                           lambda x: F.struct(x["key"].alias("key"), x["n"].alias("n")))

    return wide.select(
        *MONTH, "avg_trip_duration_min", "avg_trip_distance_km", "n_trips",
        *[f"gender_{c}_pct" for c in S.GENDER_CODES],
        *[_slot_column(s) for s in S.TIME_SLOTS],
        F.array_sort("_gender").alias("gender_distribution"),
        F.array_sort("_age").alias("age_distribution"),
        by_rank("_top_bikes").alias("top_bikes"),
        by_rank("_top_start_stations").alias("top_start_stations"),
        by_rank("_top_end_stations").alias("top_end_stations"),
    )


def render_pairs(col: str, key_field: str, value_field: str, percent: bool = False) -> Column:
    """Render an ``array<struct>`` list as text ``key:value;key:value`` (for reports/hashes)."""
    def one(x):
        v = (F.format_string("%.2f", x[value_field]) if percent
             else x[value_field].cast("string"))
        return F.concat(F.coalesce(x[key_field].cast("string"), F.lit("")), F.lit(":"), v)
    return F.array_join(F.transform(F.col(col), one), ";")


LISTS = {"gender_distribution": ("code", "pct"), "age_distribution": ("age_group", "pct"), "top_bikes": ("key", "n"),
         "top_start_stations": ("key", "n"), "top_end_stations": ("key", "n")}


def report_as_text(wide: DataFrame) -> DataFrame:
    """A wide report with its lists rendered as text."""
    return wide.select(*[c for c in wide.columns if c not in LISTS],
                       *[render_pairs(c, k, v, percent=v == "pct").alias(c) for c, (k, v) in LISTS.items()])


def kpi_report_wide_text(clean: DataFrame, k: int = S.TOP_K) -> DataFrame:
    """The wide report with its lists rendered as text."""
    return report_as_text(kpi_report_wide(clean, k))
