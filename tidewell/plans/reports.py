"""Questions asked of the Gold tables: the analytics queries, the dashboard panels, the findings.

Short results come sorted.  Results with a row per user or user-day do not, because a stored table has
no order; a reader who wants one adds ``orderBy`` at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions import scoring as S
from tidewell.functions.bounds import ACTIVITY_BOUNDS, HRV_BOUNDS, SLEEP_BOUNDS
from tidewell.functions.numeric import band, half_up, position_in, ratio, settle
from tidewell.plans.gold import with_max_hr
from tidewell.plans.silver import USER_DAY

STRAIN_ORDER = ["Recovery", "Light", "Moderate", "Hard", "All Out"]
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
COMPONENTS = ["hrv_component", "rhr_component", "sleep_component", "spo2_component"]
COMPONENT_LABELS = ["HRV (40%)", "Resting HR (25%)", "Sleep (25%)", "SpO2 (10%)"]
SLEEP_STAGES = {
    "deep_sleep_minutes": "Deep Sleep",
    "rem_sleep_minutes": "REM",
    "light_sleep_minutes": "Light Sleep",
    "awake_minutes": "Awake",
}
SLEEP_BANDS = [(6, "under 6 h"), (7, "6 to 7 h")]
CYCLE_DAYS, TRAINING_DAYS = 28, 21


# ---- the analytics queries ---------------------------------------------------------------------


def recovery_last_days(recovery: DataFrame, days: int = 30, as_of: Column | None = None) -> DataFrame:
    """The last days up to ``as_of`` (the newest day of the table if not given)."""
    end = recovery.select(F.max("date")).scalar() if as_of is None else as_of
    return (
        recovery.filter(F.col("date") >= F.date_sub(end, days))
        .select(
            "user_id",
            "date",
            "recovery_score",
            "recovery_state",
            "hrv_component",
            "sleep_component",
            "rhr_component",
            F.expr(half_up("hrv_rmssd", 1)).alias("hrv_rmssd_ms"),
            F.expr(half_up("hrv_baseline", 1)).alias("hrv_7d_baseline_ms"),
        )
    )


def _next_day(strain: DataFrame, recovery: DataFrame) -> DataFrame:
    following = recovery.select(
        "user_id", F.date_sub("date", 1).alias("date"), "recovery_score", "recovery_state"
    )
    return strain.join(following, USER_DAY, "inner")


def strain_vs_next_day(strain: DataFrame, recovery: DataFrame) -> DataFrame:
    """Strain of a day beside the recovery of the next; the delta runs over the matched rows only."""
    matched = Window.partitionBy("user_id").orderBy("date")
    return (
        _next_day(strain, recovery)
        .select(
            "user_id",
            F.col("date").alias("strain_date"),
            "strain_score",
            "strain_category",
            F.col("recovery_score").alias("next_day_recovery"),
            F.col("recovery_state").alias("next_day_state"),
            (F.col("recovery_score") - F.lag("recovery_score", 1).over(matched)).alias("recovery_delta"),
        )
    )


def weekday_pattern(recovery: DataFrame) -> DataFrame:
    day = F.col("date")
    return (
        recovery.groupBy(
            F.date_format(day, "EEEE").alias("day_of_week"), (F.dayofweek(day) - 1).alias("dow_num")
        )
        .agg(
            F.expr(half_up("avg(recovery_score)", 1)).alias("avg_recovery"),
            F.expr(half_up("avg(hrv_rmssd)", 1)).alias("avg_hrv_ms"),
            F.count("*").alias("sample_days"),
            F.expr(half_up("avg(if(recovery_state = 'Green', 100D, 0D))", 1)).alias("pct_green_days"),
        )
        .orderBy("dow_num")
    )


def hrv_trend(recovery: DataFrame) -> DataFrame:
    """Seven against twenty-eight rows of HRV: both frames share one sort."""
    def mean(rows: int) -> str:
        return f"avg(hrv_rmssd) over (partition by user_id order by date rows between {rows - 1} preceding and current row)"

    rising = f"{settle('hrv_7d_avg')} > {settle('hrv_28d_avg')}"
    return recovery.selectExpr(
        "user_id", "date", "hrv_rmssd", f"{mean(7)} as hrv_7d_avg", f"{mean(28)} as hrv_28d_avg"
    ).selectExpr("*", f"if({rising}, 'Improving', 'Declining') as hrv_trend")


def sleep_vs_recovery(metrics: DataFrame, recovery: DataFrame) -> DataFrame:
    return (
        metrics.select(
            *USER_DAY, "total_sleep_hours", "sleep_efficiency_pct", "sleep_debt_hours", "sleep_quality_tier"
        )
        .join(recovery.select(*USER_DAY, "recovery_score", "recovery_state"), USER_DAY, "inner")
    )


def performance_tiers(benchmarks: DataFrame) -> DataFrame:
    return benchmarks.select(
        "user_id",
        F.expr(half_up("avg_recovery", 1)).alias("avg_recovery_score"),
        F.expr(half_up("avg_hrv", 1)).alias("avg_hrv_ms"),
        "days_tracked",
        F.expr(half_up("recovery_percentile", 1)).alias("recovery_percentile"),
        F.expr(S.performance_tier("recovery_percentile")).alias("performance_tier"),
    )


def recovery_then_vs_now(then: DataFrame, now: DataFrame) -> DataFrame:
    """Per-user averages of an earlier version beside the current ones."""
    before = then.groupBy("user_id").agg(F.avg("recovery_score").alias("historical_avg"))
    current = now.groupBy("user_id").agg(F.avg("recovery_score").alias("current_avg"))
    return before.join(current, "user_id", "full_outer").withColumn(
        "change", F.col("current_avg") - F.col("historical_avg")
    )


WEEK = "cast(date_trunc('week', try_cast(date as date)) as date) as week"


def quarantine_weekly_reasons(quarantine: DataFrame) -> DataFrame:
    """One row per table, week and distinct reason: the complete list, of any length."""
    return (
        quarantine.selectExpr("source_table", WEEK, "rejection_reason")
        .filter("rejection_reason != ''")
        .groupBy("source_table", "week", "rejection_reason")
        .agg(F.count("*").alias("records"))
    )


#: Rules by the text that their reasons begin with: one per limit, and those on the key and the date.
RULES = [*HRV_BOUNDS, *SLEEP_BOUNDS, *ACTIVITY_BOUNDS]
_RULE_TEXT = {name: f"{name} out of range" for name in RULES} | {
    "calendar_day": "date is not a calendar day",
    "user_id": "user_id is missing",
    "record_key": "record key is missing",
    "json": "record is malformed",
}


def quarantine_weekly(quarantine: DataFrame) -> DataFrame:
    """Quarantined records and affected users per table and week, with the rules that were broken.

    The cell names rules, of which there are a fixed number; the full texts, of any number, are in
    ``quarantine_weekly_reasons``.
    """
    broken = {rule: F.max(F.col("rejection_reason").contains(text)).alias(f"_{rule}") for rule, text in _RULE_TEXT.items()}
    named = F.array_compact(F.array(*(F.when(F.col(f"_{rule}"), F.lit(rule)) for rule in broken)))
    return (
        quarantine.selectExpr("source_table", WEEK, "user_id", "rejection_reason")
        .groupBy("source_table", "week")
        .agg(F.count("*").alias("quarantined_records"), F.count_distinct("user_id").alias("affected_users"), *broken.values())
        .select(
            "source_table",
            "week",
            "quarantined_records",
            "affected_users",
            F.nullif(F.array_join(F.array_sort(named), " | "), F.lit("")).alias("broken_rules"),
        )
        .orderBy(F.col("week").desc(), "source_table")
    )


# ---- the dashboard panels ----------------------------------------------------------------------


def user_slice(df: DataFrame, user: Column | None = None, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """One user's rows in a date range; by default the first user and all dates, as a page opens."""
    user = df.select(F.min("user_id")).scalar() if user is None else user
    kept = df.filter(F.col("user_id") == user)
    if start is not None:
        kept = kept.filter(F.col("date") >= start)
    if end is not None:
        kept = kept.filter(F.col("date") <= end)
    return kept.orderBy("date")


def kpi_per_user(recovery: DataFrame, strain: DataFrame, metrics: DataFrame) -> DataFrame:
    """The header figures of every user, with their distance to 50 points and 8 hours."""
    rec = recovery.groupBy("user_id").agg(
        F.avg("recovery_score").alias("avg_recovery"),
        F.count_if(F.col("recovery_state") == "Green").alias("green_days"),
        F.count("*").alias("days_tracked"),
        F.avg("hrv_rmssd").alias("avg_hrv"),
    )
    act = strain.groupBy("user_id").agg(F.avg("strain_score").alias("avg_strain"))
    nights = metrics.groupBy("user_id").agg(F.avg("total_sleep_hours").alias("avg_sleep"))

    def or_zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    return (
        rec.join(act, "user_id", "full_outer")
        .join(nights, "user_id", "full_outer")
        .select(
            "user_id",
            or_zero("avg_recovery").alias("avg_recovery"),
            (or_zero("avg_recovery") - 50).alias("recovery_vs_50"),
            or_zero("green_days").alias("green_days"),
            or_zero("days_tracked").alias("days_tracked"),
            (or_zero("green_days") / F.greatest(or_zero("days_tracked"), F.lit(1)) * 100).alias("green_pct"),
            or_zero("avg_strain").alias("avg_strain"),
            or_zero("avg_sleep").alias("avg_sleep"),
            (or_zero("avg_sleep") - 8).alias("sleep_vs_8h"),
            or_zero("avg_hrv").alias("avg_hrv"),
        )
    )


def run_stats(strain: DataFrame, metrics: DataFrame) -> DataFrame:
    """The figures a Gold run reports, one row per table in long form."""
    nights = metrics.agg(
        F.count_distinct("user_id").cast("double").alias("users"),
        F.avg("total_sleep_hours").alias("avg_sleep_hours"),
        F.avg("sleep_debt_hours").alias("avg_sleep_debt_hours"),
    )
    days = strain.agg(
        F.count("*").cast("double").alias("strain_records"),
        F.avg("strain_score").alias("avg_strain"),
        F.max("strain_score").alias("max_strain"),
    )
    return _long(nights).unionByName(_long(days))


def _long(row: DataFrame) -> DataFrame:
    return row.unpivot([], row.columns, "statistic", "value")


def component_means(recovery: DataFrame, per_user: bool = True) -> DataFrame:
    """Mean component scores in long form, one row per axis of the radar chart."""
    keys = ["user_id"] if per_user else []
    means = recovery.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in COMPONENTS])
    long = means.unpivot(keys, COMPONENTS, "component", "mean_score")
    labels = F.create_map(*[F.lit(x) for pair in zip(COMPONENTS, COMPONENT_LABELS) for x in pair])
    return long.withColumn("label", labels[F.col("component")])


def week_weekday_grid(recovery: DataFrame, min_days: int = 14) -> DataFrame:
    """Mean recovery per user, ISO week and weekday, for users with enough days, in long form."""
    counted = recovery.selectExpr("user_id", "date", "recovery_score", "count(*) over (partition by user_id) as _days")
    return (
        counted.filter(F.col("_days") >= min_days)
        .groupBy(
            "user_id",
            F.extract(F.lit("YEAROFWEEK"), F.col("date")).cast("int").alias("iso_year"),
            F.weekofyear("date").alias("iso_week"),
            (F.weekday("date") + 1).alias("weekday_no"),
            F.date_format("date", "EEEE").alias("day_of_week"),
        )
        .agg(F.avg("recovery_score").alias("avg_recovery"))
    )


def week_weekday_matrix(recovery: DataFrame, min_days: int = 14) -> DataFrame:
    """The grid with one column per weekday, Monday first; a week is a row."""
    grid = week_weekday_grid(recovery, min_days)
    return grid.groupBy("user_id", "iso_year", "iso_week").pivot("day_of_week", WEEKDAYS).agg(F.first("avg_recovery"))


def sleep_stage_hours(sleep: DataFrame) -> DataFrame:
    """Hours per sleep stage in long form."""
    hours = sleep.select(*USER_DAY, *[(F.col(c) / 60).alias(label) for c, label in SLEEP_STAGES.items()])
    return hours.unpivot(USER_DAY, list(SLEEP_STAGES.values()), "stage", "hours")


def ols_strain_recovery(strain: DataFrame, recovery: DataFrame) -> DataFrame:
    """Least-squares line of next-day recovery over strain, all points together."""
    y, x = F.col("recovery_score").cast("double"), F.col("strain_score")
    return _next_day(strain, recovery).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("points"),
    )


def hrv_quartiles(recovery: DataFrame) -> DataFrame:
    """Box-plot figures per user: quartiles and the fences 1.5 interquartile ranges out."""
    box = recovery.groupBy("user_id").agg(
        F.percentile("hrv_rmssd", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"),
        F.count("hrv_rmssd").alias("readings"),
    )
    q1, q2, q3 = (F.col("_q")[i] for i in range(3))
    return box.select(
        "user_id",
        "readings",
        q1.alias("q1"),
        q2.alias("median"),
        q3.alias("q3"),
        (q1 - (q3 - q1) * 1.5).alias("lower_fence"),
        (q3 + (q3 - q1) * 1.5).alias("upper_fence"),
    )


def hrv_outliers(recovery: DataFrame) -> DataFrame:
    """Readings beyond their user's fences, found in one pass over the user's days."""
    quarter = "percentile(hrv_rmssd, {}) over (partition by user_id)"
    boxed = recovery.selectExpr(*USER_DAY, "hrv_rmssd", f"{quarter.format(0.25)} as _q1", f"{quarter.format(0.75)} as _q3")
    return boxed.selectExpr(
        *USER_DAY,
        "hrv_rmssd",
        "case when hrv_rmssd < _q1 - (_q3 - _q1) * 1.5D then 'low' when hrv_rmssd > _q3 + (_q3 - _q1) * 1.5D then 'high' end as side",
    ).filter("side is not null")


def hrv_histogram(recovery: DataFrame, width: float = 5.0) -> DataFrame:
    """Counts per user and fixed-width class, the density of the violin plot."""
    return (
        recovery.filter(F.col("hrv_rmssd").isNotNull())
        .groupBy("user_id", (F.floor(F.col("hrv_rmssd") / width) * width).alias("class_start"))
        .agg(F.count("*").alias("readings"))
    )


# ---- the findings ------------------------------------------------------------------------------


def recovery_state_distribution(recovery: DataFrame) -> DataFrame:
    return _shares(recovery, "recovery_state")


def strain_category_distribution(strain: DataFrame) -> DataFrame:
    return (
        _shares(strain, "strain_category")
        .withColumn("category_no", F.expr(position_in("strain_category", STRAIN_ORDER)))
        .orderBy("category_no")
    )


def sleep_tier_share(metrics: DataFrame) -> DataFrame:
    return _shares(metrics, "sleep_quality_tier")


def _shares(df: DataFrame, label: str) -> DataFrame:
    """Rows per label with the percentage; the total runs over the handful of counted labels."""
    counted = df.groupBy(label).agg(F.count("*").alias("days"))
    return counted.selectExpr("*", f"{half_up('days / sum(days) over () * 100', 1)} as share_pct")


def component_correlations(recovery: DataFrame) -> DataFrame:
    score = F.col("recovery_score").cast("double")
    pairs = {"hrv_rmssd": F.col("hrv_rmssd"), **{c: F.col(c) for c in COMPONENTS}}
    return _long(recovery.agg(*[F.corr(x, score).alias(name) for name, x in pairs.items()])).withColumnsRenamed(
        {"statistic": "measure", "value": "r_with_score"}
    )


def sleep_band_means(metrics: DataFrame, recovery: DataFrame) -> DataFrame:
    """Recovery and HRV by hours slept; nine hours still belong to the third band."""
    label = f"if(total_sleep_hours > 9, 'over 9 h', {band('total_sleep_hours', SLEEP_BANDS, '7 to 9 h')})"
    return (
        metrics.select(*USER_DAY, "total_sleep_hours")
        .join(recovery.select(*USER_DAY, "recovery_score", "hrv_rmssd"), USER_DAY)
        .groupBy(F.expr(label).alias("sleep_band"))
        .agg(
            F.avg("recovery_score").alias("avg_recovery"),
            F.avg("hrv_rmssd").alias("avg_hrv"),
            F.count("*").alias("nights"),
        )
    )


def training_phase_means(recovery: DataFrame, start: Column | None = None) -> DataFrame:
    """Training against recovery weeks of a four-week cycle that begins at ``start``."""
    first = recovery.select(F.min("date")).scalar() if start is None else start
    cycle_day = F.pmod(F.datediff(F.col("date"), first), F.lit(CYCLE_DAYS))
    phase = F.when(cycle_day < TRAINING_DAYS, "training").otherwise("recovery week")
    return recovery.groupBy(phase.alias("phase")).agg(
        F.avg("recovery_score").alias("avg_recovery"), F.count("*").alias("days")
    )


def fitness_level_means(recovery: DataFrame, users: DataFrame) -> DataFrame:
    """Recovery and HRV by fitness level.  Days are summed up per user before the profiles join."""
    per_user = recovery.groupBy("user_id").agg(
        F.sum("recovery_score").alias("_score"),
        F.count("recovery_score").alias("_scored"),
        F.sum("hrv_rmssd").alias("_hrv"),
        F.count("hrv_rmssd").alias("_read"),
        F.count("*").alias("_days"),
    )
    levels = users.groupBy("user_id").agg(F.max("fitness_level").alias("fitness_level"))
    return (
        per_user.join(levels, "user_id")
        .groupBy("fitness_level")
        .agg(
            F.expr(ratio("double(sum(_score))", "double(sum(_scored))")).alias("avg_recovery"),
            F.expr(ratio("sum(_hrv)", "double(sum(_read))")).alias("avg_hrv"),
            F.sum("_days").alias("days"),
        )
    )


def hr_zone_allocation(activity: DataFrame, users: DataFrame) -> DataFrame:
    """Estimated minutes per zone for sessions without reported zones."""
    sessions = with_max_hr(activity, users).selectExpr(
        "*",
        f"{S.zone_of('avg_hr_bpm', 'max_hr')} as _main",
        f"{S.zone_of('peak_hr_bpm', 'max_hr')} as _peak",
    )
    zones = S.allocated_zones("_main", "_peak", "workout_duration_minutes")
    return sessions.selectExpr(
        "record_id",
        *USER_DAY,
        "workout_duration_minutes",
        *[f"{z} as est_zone{i}_minutes" for i, z in enumerate(zones, start=1)],
    )


# ---- trends --------------------------------------------------------------------------------------

#: Calendar weeks that a trend looks at, the current one included.
TREND_WEEKS = 4


def weekly_sleep_trend(sleep: DataFrame) -> DataFrame:
    """Per user and calendar week (from Monday): mean sleep, and the slope of the weekly means over four weeks in hours
    a week.

    A week without a night has no row and no part in a trend, but time goes on: means keep their distance in weeks. A
    slope needs two weeks; without, slope and trend are NULL. A slope of zero counts as declining, like any tie of the
    other trends.
    """
    week = F.date_trunc("week", "date").cast("date")
    weekly = sleep.groupBy("user_id", week.alias("week")).agg(F.count("total_sleep_hours").alias("nights"), F.avg("total_sleep_hours").alias("mean_hours"))
    known = weekly.where("nights > 0").withColumn("_x", (F.datediff("week", F.lit("1970-01-05").cast("date")) / 7).cast("long"))
    frame = f"over (partition by user_id order by _x range between {TREND_WEEKS - 1} preceding and current row)"
    # distances from the current week: small numbers, so that the sums lose nothing
    summed = known.selectExpr(
        "*", f"count(*) {frame} as _n", f"sum(_x) {frame} - count(*) {frame} * _x as _sx", f"sum(mean_hours) {frame} as _sy",
        f"sum(_x * mean_hours) {frame} - _x * sum(mean_hours) {frame} as _sxy",
        f"sum(_x * _x) {frame} - 2 * _x * sum(_x) {frame} + count(*) {frame} * _x * _x as _sxx",
    )
    slope = settle(ratio("(_n * _sxy - _sx * _sy)", "double(nullif(_n * _sxx - _sx * _sx, 0))"))
    sloped = summed.withColumn("slope", F.expr(f"if(_n > 1, {slope}, null)"))
    trend = F.when(F.col("slope") > 0, "Improving").when(F.col("slope").isNotNull(), "Declining")
    return sloped.select("user_id", "week", "nights", "mean_hours", F.col("_n").alias("weeks"), "slope", trend.alias("trend"))


def recovery_sample(recovery: DataFrame, rows: int = 5) -> DataFrame:
    """The newest rows by user, as printed at the end of a Gold run."""
    return recovery.orderBy(F.col("date").desc(), "user_id").limit(rows).select("user_id", "date", "recovery_score", "recovery_state", "hrv_component")
