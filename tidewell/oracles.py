"""DuckDB SQL for the registered queries: an independent statement of each result."""

from __future__ import annotations

from tidewell.sources import sensor_views as V

# Fixed values, written out so that a wrong constant in the library does not agree with itself.
HRV_BOUNDS = {
    "hrv_rmssd_ms": (5, 250),
    "hrv_sdnn_ms": (10, 400),
    "respiratory_rate_brpm": (8, 30),
}
SLEEP_BOUNDS = {
    "total_sleep_hours": (1.0, 14.0),
    "sleep_efficiency_pct": (20.0, 100.0),
    "spo2_avg_pct": (80.0, 100.0),
    "resting_hr_bpm": (25.0, 130.0),
}
ACTIVITY_BOUNDS = {
    "avg_hr_bpm": (30.0, 220.0),
    "peak_hr_bpm": (30.0, 225.0),
    "steps": (0, 100000),
    "active_calories": (0, 5000),
}

# Explanation per column for a value (below, above) its limits.
BOUND_REASONS = {
    "hrv_rmssd_ms": ("rMSSD too low to come from a beating heart", "rMSSD above any plausible autonomic range"),
    "hrv_sdnn_ms": ("SDNN too low to come from a beating heart", "SDNN above any plausible autonomic range"),
    "respiratory_rate_brpm": ("respiratory rate below survivable", "respiratory rate above survivable"),
    "total_sleep_hours": ("too little sleep to be a recorded night", "more sleep than fits in one night"),
    "sleep_efficiency_pct": ("efficiency too low to represent real sleep", "efficiency above 100%"),
    "spo2_avg_pct": ("SpO₂ below what a sleeping adult sustains", "SpO₂ above 100%"),
    "resting_hr_bpm": ("resting HR below human range", "resting HR above human range"),
    "avg_hr_bpm": (
        "session-average HR implies lost skin contact",
        "session-average HR above any real maximum",
    ),
    "peak_hr_bpm": (
        "peak HR implies lost skin contact",
        "peak HR above any real maximum — cadence-lock artifact",
    ),
    "steps": ("negative step count", "step count outside a physical day"),
    "active_calories": ("negative active burn", "active burn outside a physical day"),
}


def _decimal(column: str) -> str:
    return f"cast(round({column}, 9) as decimal(28, 9))"


def half_up(column: str, n: int) -> str:
    return f"(cast(round({_decimal(column)} * {10**n}) as double) / {10**n}.0e0)"


def half_even(column: str, n: int) -> str:
    return f"(round_even(round({column}, 9) * {10**n}.0e0, 0) / {10**n}.0e0)"


def r9(*columns: str) -> str:
    return ", ".join(f"round({c}, 9) as {c.split('.')[-1]}" for c in columns)


def clipped(x: str, low: str, high: str) -> str:
    return f"case when ({x}) is null then null else least(greatest({x}, {low}), {high}) end"


def _view(name: str, view: dict[str, str]) -> str:
    return f"{name} as (select {', '.join(V.select_list(view, 'varchar'))} from ev)"


def _ok(bounds) -> str:
    return " and ".join(f"({c} is null or {c} between {lo} and {hi})" for c, (lo, hi) in bounds.items())


def _reason(bounds) -> str:
    parts = [
        f"case when {c} < {lo} or {c} > {hi} then '{c} out of range [{lo},{hi}]: ' || cast({c} as varchar) end"
        for c, (lo, hi) in bounds.items()
    ]
    return f"concat_ws('; ', {', '.join(parts)})"


def _latest(name: str, source: str, keys: str) -> str:
    return (
        f"{name} as (select * exclude (rn) from (select *, row_number() over (partition by {keys} "
        f"order by _ingest_timestamp desc, ingested_at desc) as rn from {source}) where rn = 1)"
    )


ZONES = [f"zone{i}_minutes" for i in range(1, 7)]


def raw_ctes(when: str | None = None) -> str:
    """The sensor views; with a condition, those delivered under it."""
    until = f" where {when}" if when else ""
    return ",\n".join(
        [
            f"ev as (select event_id, ts, user_id, event_type, value from events{until})",
            _view("hrv_raw", V.HRV_VIEW),
            _view("sleep_raw", V.SLEEP_VIEW),
            _view("activity_raw", V.ACTIVITY_VIEW),
            f"users as (select {', '.join(V.select_list(V.USERS_VIEW, 'varchar'))} from customer)",
            _latest("hrv_last", "hrv_raw", "reading_id"),
            _latest("sleep_last", "sleep_raw", "record_id"),
            _latest("activity_last", "activity_raw", "record_id"),
        ]
    )


def silver_ctes(when: str | None = None) -> str:
    zone_sum = " + ".join(f"coalesce({z}, 0)" for z in ZONES)
    hrv = (
        "hrv_t as (select * replace (round(hrv_rmssd_ms, 2) as hrv_rmssd_ms, round(hrv_sdnn_ms, 2) as hrv_sdnn_ms, "
        f"cast(date as date) as date) from hrv_last where {_ok(HRV_BOUNDS)} and not is_anomaly)"
    )
    sleep = (
        "sleep_t as (select * replace (cast(date as date) as date), round(total_sleep_hours * 60, 0) as total_sleep_minutes, "
        "round(rem_sleep_minutes / round(total_sleep_hours * 60, 0) * 100, 1) as rem_pct, "
        "round(deep_sleep_minutes / round(total_sleep_hours * 60, 0) * 100, 1) as deep_pct "
        f"from sleep_last where {_ok(SLEEP_BOUNDS)} and not is_anomaly)"
    )
    activity = (
        "activity_t as (select * replace (cast(date as date) as date, "
        "upper(substr(workout_type, 1, 1)) || lower(substr(workout_type, 2)) as workout_type), "
        f"cast({zone_sum} as int) as total_zone_minutes from activity_last where {_ok(ACTIVITY_BOUNDS)})"
    )
    return ",\n".join(
        [
            raw_ctes(when),
            hrv,
            sleep,
            activity,
            _latest("hrv_clean", "hrv_t", "user_id, date"),
            _latest("sleep_clean", "sleep_t", "user_id, date"),
            _latest("activity_clean", "activity_t", "user_id, date"),
        ]
    )


def recovery_ctes(hrv: str = "hrv_clean", sleep: str = "sleep_clean", out: str = "rec") -> str:
    before = "(partition by user_id order by date rows between 7 preceding and 1 preceding)"
    whole = "(partition by user_id)"
    h, e, rem, deep, ox = "h", "e", "rem", "deep", "ox"
    rem_share = f"case when {h} > 0 then {rem} / ({h} * 60) * 100 when {h} is not null then 0 end"
    deep_share = f"case when {h} > 0 then {deep} / ({h} * 60) * 100 when {h} is not null then 0 end"
    return f"""{out}_j as (select a.user_id, cast(a.date as date) as date, a.hrv_rmssd_ms as v, b.resting_hr_bpm as r,
  b.total_sleep_hours as h, b.sleep_efficiency_pct as e, b.rem_sleep_minutes as rem, b.deep_sleep_minutes as deep,
  b.spo2_avg_pct as ox from {hrv} a join {sleep} b on a.user_id = b.user_id and a.date = b.date),
{out}_w as (select *, case when count(v) over {before} >= 3 then avg(v) over {before} end as v7,
  case when count(v) over {before} >= 3 then stddev_samp(v) over {before} end as s7,
  case when count(r) over {before} >= 3 then avg(r) over {before} end as r7,
  avg(v) over {whole} as va, stddev_samp(v) over {whole} as sa, avg(r) over {whole} as ra from {out}_j),
{out}_b as (select *, v7 is null as fresh, case when v7 is null then va else v7 end as base,
  case when v7 is null then sa else s7 end as sd0, case when v7 is null then ra else r7 end as rbase from {out}_w),
{out}_s as (select *, case when sd0 >= 1 then sd0 else base * 0.1e0 end as sd,
  {rem_share} as rem_share, {deep_share} as deep_share,
  case when {h} < 4 then 0.0e0 when {h} < 6 then ({h} - 4) / 2 * 70 when {h} <= 9 then 70 + ({h} - 6) / 3 * 30
       when {h} is not null then 100 - ({h} - 9) * 8 end as dur,
  {clipped(f"({e} - 70) / 25 * 100", "0.0e0", "100.0e0")} as eff,
  case when {ox} >= 97 then 100.0e0 when {ox} >= 95 then 80 + ({ox} - 95) * 10 when {ox} >= 90 then 20 + ({ox} - 90) * 12
       when {ox} is not null then greatest(0.0e0, {ox} - 80) * 2 else 0.0e0 end as c_ox from {out}_b),
{out}_c as (select *, {clipped("50 + 45 * tanh((v - base) / nullif(sd, 0) * 0.75e0)", "5.0e0", "98.0e0")} as c_hrv,
  {clipped("75 - (r - rbase) * 5", "5.0e0", "98.0e0")} as c_rhr,
  {clipped("(100 - abs(rem_share - 22.5e0) * 4 + 100 - abs(deep_share - 17.5e0) * 5) / 2", "0.0e0", "100.0e0")} as arch
  from {out}_s),
{out}_t as (select *, {clipped("dur * 0.5e0 + arch * 0.3e0 + eff * 0.2e0", "0.0e0", "100.0e0")} as c_sleep from {out}_c),
{out}_r as (select *, c_hrv * 0.4e0 + c_rhr * 0.25e0 + c_sleep * 0.25e0 + c_ox * 0.1e0 as total from {out}_t),
{out}_f as (select *, cast({clipped(half_even("total", 0), "0.0e0", "100.0e0")} as int) as score from {out}_r),
{out} as (select user_id, date, score as recovery_score,
  case when score < 33 then 'Red' when score < 66 then 'Yellow' when score is not null then 'Green' end as recovery_state,
  {half_even("c_hrv", 2)} as hrv_component, {half_even("c_rhr", 2)} as rhr_component,
  {half_even("c_sleep", 2)} as sleep_component, {half_even("c_ox", 2)} as spo2_component, v as hrv_rmssd,
  {half_even("base", 2)} as hrv_baseline, {half_even("rbase", 2)} as rhr_baseline,
  {half_even("c_sleep", 2)} as sleep_performance, fresh as needs_more_baseline from {out}_f)"""


def strain_ctes() -> str:
    z = [f"coalesce({c}, 0)" for c in ZONES]
    load = " + ".join(f"{m} * {w}" for m, w in zip(z, ["0.25e0", "0.5e0", "1.0e0", "2.5e0", "5.0e0", "10.0e0"]))
    best = f"greatest({', '.join(z)})"
    first = " ".join(f"when {m} = {best} then {i}" for i, m in enumerate(z, start=1))
    return f"""strain_a as (select a.*, coalesce(u.max_hr, 190) as max_hr from activity_clean a
  left join (select user_id, max(max_hr) as max_hr from users group by user_id) u on a.user_id = u.user_id),
strain_b as (select *, least(greatest(21 * ln(1 + ({load}) / 15.0e0) / ln(1 + 400.0e0 / 15.0e0), 0.0e0), 21.0e0) as raw,
  case when max_hr > 0 then peak_hr_bpm / max_hr * 100 else 0.0e0 end as peak from strain_a),
strain as (select user_id, date, {half_even("raw", 2)} as strain_score,
  case when raw < 5 then 'Recovery' when raw < 10 then 'Light' when raw < 14 then 'Moderate' when raw < 18 then 'Hard'
       else 'All Out' end as strain_category,
  cast({" + ".join(z)} as int) as total_active_minutes, {half_even("peak", 1)} as peak_hr_pct_max,
  cast(case {first} end as int) as dominant_zone, {", ".join(f"cast({m} as double) as {c}" for m, c in zip(z, ZONES))}
  from strain_b)"""


def metrics_ctes() -> str:
    w = "over (partition by user_id order by date rows between {} preceding and current row)"
    return f"""sm_a as (select *, 8.0e0 - total_sleep_hours as nightly_deficit,
  greatest(sum(8.0e0 - total_sleep_hours) {w.format(13)}, 0.0e0) as debt,
  coalesce(stddev_samp(total_sleep_hours) {w.format(6)}, 0.0e0) as duration_7d_std,
  avg(sleep_efficiency_pct) {w.format(6)} as eff7,
  rem_sleep_minutes / (total_sleep_hours * 60) * 100 as remp, deep_sleep_minutes / (total_sleep_hours * 60) * 100 as deepp
  from sleep_clean),
sm_b as (select *, least(greatest((1 - duration_7d_std / 2.0e0) * 100, 0.0e0), 100.0e0) as cons from sm_a),
sm_c as (select * exclude (rem_pct, deep_pct), {half_even("remp", 1)} as rem_pct, {half_even("deepp", 1)} as deep_pct,
  {half_even("debt", 2)} as sleep_debt_hours, {half_even("eff7", 1)} as efficiency_7d_avg,
  {half_even("cons", 1)} as sleep_consistency_score from sm_b),
sm_p as (select *, case when total_sleep_hours between 7 and 9 then 3 when total_sleep_hours >= 6 and total_sleep_hours <= 10 then 1 else 0 end
  + case when sleep_efficiency_pct >= 90 then 2 when sleep_efficiency_pct >= 80 then 1 else 0 end
  + case when rem_pct between 18 and 26 then 1 else 0 end + case when deep_pct between 15 and 25 then 1 else 0 end as pts from sm_c),
sm as (select *, case when pts >= 7 then 'Excellent' when pts >= 5 then 'Good' when pts >= 3 then 'Fair' else 'Poor' end
  as sleep_quality_tier from sm_p)"""


def bench_ctes() -> str:
    return f"""bm_a as (select user_id, avg(recovery_score) as avg_recovery, avg(hrv_rmssd) as avg_hrv,
  avg(hrv_baseline) as avg_hrv_baseline, count(*) as days_tracked from rec group by user_id),
bm_b as (select *, percent_rank() over (order by avg_recovery nulls first) * 100 as pr from bm_a),
bm as (select *, {half_up("pr", 1)} as recovery_percentile from bm_b)"""


def _quarantine() -> str:
    def rows(table: str, key: str, bounds, source: str) -> str:
        return (
            f"select '{source}' as source_table, {key} as record_id, user_id, date, {_reason(bounds)} as rejection_reason "
            f"from {table} where not ({_ok(bounds)})"
        )

    return "quarantine as (" + " union all ".join(
        [
            rows("hrv_last", "reading_id", HRV_BOUNDS, "bronze.hrv_readings"),
            rows("sleep_last", "record_id", SLEEP_BOUNDS, "bronze.sleep_records"),
            rows("activity_last", "record_id", ACTIVITY_BOUNDS, "bronze.activity_records"),
        ]
    ) + ")"


def _violations() -> str:
    rows = []
    for table, key, bounds, source in [
        ("hrv_raw", "reading_id", HRV_BOUNDS, "bronze.hrv_readings"),
        ("sleep_raw", "record_id", SLEEP_BOUNDS, "bronze.sleep_records"),
        ("activity_raw", "record_id", ACTIVITY_BOUNDS, "bronze.activity_records"),
    ]:
        for c, (lo, hi) in bounds.items():
            low, high = BOUND_REASONS[c]
            rows.append(
                f"select '{source}' as source_table, {key} as record_id, '{c} ∈ [{lo}, {hi}]' as failed_rule, "
                f"{half_even(f'cast({c} as double)', 1)} as value, case when {c} < {lo} then 'low' else 'high' end as side, "
                f"case when {c} < {lo} then '{low}' else '{high}' end as why_it_fails from {table} where {c} < {lo} or {c} > {hi}"
            )
    return "violations as (" + "\nunion all ".join(rows) + ")"


def _gate() -> str:
    rows = []

    def add(table: str, raw: str, checks: list[tuple]) -> None:
        for no, (kind, column, *limits) in enumerate(checks, start=1):
            if kind == "not_null":
                text, fails, what = "to not be null", f"count(*) filter (where {column} is null)", "null values found"
            elif kind == "between":
                lo, hi = limits
                text = f"to be between {lo} and {hi}"
                fails, what = f"count(*) filter (where {column} < {lo} or {column} > {hi})", "out-of-range values"
            else:
                text, what = "to be unique", "duplicates found"
                fails = f"count(*) - count(distinct {column}) - coalesce(max(case when {column} is null then 1 else 0 end), 0)"
            rows.append(
                f"select '{table}' as table_name, {no} as rule_no, 'column ''{column}'' {text}' as expectation, "
                f"cast({fails} as bigint) as failing_rows, '{what}' as what from {raw}"
            )

    add("hrv_readings", "hrv_raw", [
        ("not_null", "reading_id"), ("not_null", "user_id"), ("not_null", "date"),
        ("between", "hrv_rmssd_ms", 5, 250), ("between", "hrv_sdnn_ms", 10, 400),
        ("between", "respiratory_rate_brpm", 8, 30), ("unique", "reading_id"),
    ])
    add("sleep_records", "sleep_raw", [
        ("not_null", "record_id"), ("not_null", "user_id"), ("between", "total_sleep_hours", 0, 16),
        ("between", "sleep_efficiency_pct", 0, 100), ("between", "spo2_avg_pct", 80, 100),
        ("between", "resting_hr_bpm", 25, 140), ("unique", "record_id"),
    ])
    add("activity_records", "activity_raw", [
        ("not_null", "record_id"), ("not_null", "user_id"), ("between", "steps", 0, 100000),
        ("between", "avg_hr_bpm", 30, 220), ("between", "peak_hr_bpm", 30, 225), ("unique", "record_id"),
    ])
    return (
        "gate_n as (" + "\nunion all ".join(rows) + "),\ngate as (select table_name, rule_no, expectation, failing_rows = 0 as passed, "
        "case when failing_rows = 0 then 'OK' else cast(failing_rows as varchar) || ' ' || what end as details, failing_rows from gate_n)"
    )


def _raw(select: str) -> str:
    return f"with {raw_ctes()}\n{select}"


def _silver(select: str, *more: str) -> str:
    return "with " + ",\n".join([silver_ctes(), *more]) + f"\n{select}"


def _gold(select: str, *more: str) -> str:
    return _silver(select, recovery_ctes(), *more)


HRV_COLS = "reading_id, user_id, date, hrv_rmssd_ms, hrv_sdnn_ms, respiratory_rate_brpm, is_anomaly, ingested_at"
SLEEP_COLS = (
    "record_id, user_id, date, total_sleep_hours, deep_sleep_minutes, rem_sleep_minutes, light_sleep_minutes, "
    "awake_minutes, sleep_efficiency_pct, spo2_avg_pct, resting_hr_bpm, is_anomaly, ingested_at"
)
ACTIVITY_COLS = (
    "record_id, user_id, date, workout_type, workout_duration_minutes, steps, active_calories, total_calories, "
    "avg_hr_bpm, peak_hr_bpm, zone1_minutes, zone2_minutes, zone3_minutes, zone4_minutes, zone5_minutes, "
    "zone6_minutes, ingested_at"
)
REC_COLS = (
    "user_id, date, recovery_score, recovery_state, hrv_component, rhr_component, sleep_component, spo2_component, "
    "hrv_rmssd, hrv_baseline, rhr_baseline, sleep_performance, needs_more_baseline"
)
MIDWAY = "(select min(cast(ts as date)) + cast((max(cast(ts as date)) - min(cast(ts as date))) // 2 as int) from events)"


def _shares(table: str, label: str) -> str:
    return (
        f"sh as (select {label}, count(*) as days from {table} group by {label}), "
        f"sh2 as (select *, days * 100.0e0 / sum(days) over () as p from sh)"
    )


def _raw_record() -> str:
    """The JSON text of an HRV record as Spark writes it: NULLs left out, times cut to milliseconds."""
    parts = [
        """'"reading_id":"' || reading_id || '"'""",
        """'"user_id":"' || user_id || '"'""",
        """'"date":"' || date || '"'""",
        *[f"""'"{c}":' || cast({c} as varchar)""" for c in HRV_BOUNDS],
        """'"is_anomaly":' || case when is_anomaly then 'true' else 'false' end""",
        """'"ingested_at":"' || ingested_at || '"'""",
        """'"_ingestion_run_id":"' || _ingestion_run_id || '"'""",
        """'"_ingest_timestamp":"' || strftime(_ingest_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || '"'""",
    ]
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _zone_allocation() -> str:
    def zone(hr: str) -> str:
        floors = [(6, "0.95e0"), (5, "0.9e0"), (4, "0.8e0"), (3, "0.7e0"), (2, "0.6e0")]
        return "case " + " ".join(f"when {hr} >= max_hr * {f} then {z}" for z, f in floors) + " else 1 end"

    zones = ", ".join(
        f"case when given > 0 then cast(trunc((case when zm = {i} then m45 else 0 end + case when greatest(zm - 1, 1) = {i} then m30 else 0 end "
        f"+ case when least(zm + 1, 6) = {i} then m15 else 0 end + case when greatest(zp, zm) = {i} then m10 else 0 end) "
        f"* (cast(d as double) / given)) as int) else 0 end as est_zone{i}_minutes"
        for i in range(1, 7)
    )
    return f"""za as (select a.*, coalesce(u.max_hr, 190) as max_hr from activity_last a
  left join (select user_id, max(max_hr) as max_hr from users group by user_id) u on a.user_id = u.user_id),
zb as (select *, workout_duration_minutes as d, {zone("avg_hr_bpm")} as zm, {zone("peak_hr_bpm")} as zp,
  cast(trunc(workout_duration_minutes * 0.45e0) as int) as m45, cast(trunc(workout_duration_minutes * 0.3e0) as int) as m30,
  cast(trunc(workout_duration_minutes * 0.15e0) as int) as m15, cast(trunc(workout_duration_minutes * 0.1e0) as int) as m10 from za),
zc as (select *, m45 + m30 + m15 + m10 as given from zb)
select record_id, user_id, date, workout_duration_minutes, {zones} from zc"""


def oracle_sql() -> dict[str, str]:
    rec, strain, sm, bm = recovery_ctes(), strain_ctes(), metrics_ctes(), bench_ctes()
    nextday = (
        "nx as (select s.user_id, s.date, s.strain_score, s.strain_category, r.recovery_score, r.recovery_state "
        "from strain s join rec r on s.user_id = r.user_id and r.date = cast(s.date + interval 1 day as date))"
    )
    box = (
        "bx as (select user_id, count(hrv_rmssd) as readings, quantile_cont(hrv_rmssd, 0.25) as q1, "
        "quantile_cont(hrv_rmssd, 0.5) as median, quantile_cont(hrv_rmssd, 0.75) as q3 from rec group by user_id), "
        "bf as (select *, q1 - (q3 - q1) * 1.5e0 as lower_fence, q3 + (q3 - q1) * 1.5e0 as upper_fence from bx)"
    )
    weeks = "qw as (select *, cast(date_trunc('week', cast(date as date)) as date) as week from quarantine)"
    enough = "en as (select * from rec where user_id in (select user_id from rec group by user_id having count(*) >= 14))"
    grid = (
        "gr as (select user_id, cast(isoyear(date) as int) as iso_year, cast(weekofyear(date) as int) as iso_week, "
        "cast(isodow(date) as int) as weekday_no, dayname(date) as day_of_week, avg(recovery_score) as avg_recovery from en "
        "group by user_id, isoyear(date), weekofyear(date), isodow(date), dayname(date))"
    )
    violations = _violations()
    quarantine = _quarantine()
    early = (
        silver_ctes(f"cast(ts as date) <= {MIDWAY}") + ",\n" + recovery_ctes()
    )
    q: dict[str, str] = {}

    # sources and table management
    q["json_scan_typed"] = _raw(f"select {HRV_COLS} from hrv_raw")
    q["json_array_split"] = q["json_scan_typed"]
    q["audit_stamp"] = _raw(f"select {HRV_COLS}, 'run-7' as _ingestion_run_id, true as stamped from hrv_raw")
    q["upsert_single_key"] = _raw(f"select {HRV_COLS} from hrv_last")
    first, second = (
        f"select * from (with {silver_ctes(when)} select {SLEEP_COLS} from sleep_clean)"
        for when in ("extract(hour from ts) < 18", "extract(hour from ts) >= 12")
    )
    q["upsert_composite_key"] = (
        f"with b1 as ({first}), b2 as ({second}) select * from b2 union all select * from b1 "
        "where not exists (select 1 from b2 where b2.user_id = b1.user_id and b2.date = b1.date)"
    )
    q["table_create_replace"] = _silver(f"select {ACTIVITY_COLS}, total_zone_minutes from activity_clean")
    q["quarantine_append"] = _silver("select source_table, record_id, user_id, date, rejection_reason from quarantine", quarantine)
    q["recovery_then_vs_now"] = (
        f"with {early},\nthen_avg as materialized (select user_id, avg(recovery_score) as historical_avg from rec group by user_id),\n"
        f"now_avg as (select * from ({_gold('select user_id, avg(recovery_score) as current_avg from rec group by user_id')}))\n"
        "select coalesce(t.user_id, n.user_id) as user_id, round(historical_avg, 9) as historical_avg, round(current_avg, 9) as current_avg, "
        "round(current_avg - historical_avg, 9) as change from then_avg t full join now_avg n on t.user_id = n.user_id"
    )
    q["compacted_table"] = _silver("select date, count(*) as rows, true as compacted from hrv_clean group by date")

    # cleaning
    q["dedup_latest"] = _raw(f"select {HRV_COLS} from hrv_last")
    q["bounds_split_valid"] = _raw(f"select {SLEEP_COLS} from sleep_last where {_ok(SLEEP_BOUNDS)}")
    q["bounds_split_quarantine"] = _raw(
        "select 'bronze.hrv_readings' as source_table, reading_id as record_id, user_id, date, "
        f"{_reason(HRV_BOUNDS)} as rejection_reason, {_raw_record()} as raw_record from hrv_last where not ({_ok(HRV_BOUNDS)})"
    )
    q["quarantine_union"] = _silver("select source_table, record_id, user_id, date, rejection_reason from quarantine", quarantine)
    rates = []
    for table, bounds, source in [
        ("hrv_last", HRV_BOUNDS, "bronze.hrv_readings"),
        ("sleep_last", SLEEP_BOUNDS, "bronze.sleep_records"),
        ("activity_last", ACTIVITY_BOUNDS, "bronze.activity_records"),
    ]:
        rates.append(
            f"select '{source}' as source_table, count(*) filter (where {_ok(bounds)}) as valid_count, "
            f"count(*) filter (where not ({_ok(bounds)})) as invalid_count, "
            f"round(count(*) filter (where not ({_ok(bounds)})) * 100.0e0 / count(*), 1) as rejection_pct from {table}"
        )
    q["rejection_rate"] = _raw(" union all ".join(rates))
    q["silver_hrv"] = _silver(f"select {HRV_COLS} from hrv_clean")
    q["silver_sleep"] = _silver(f"select {SLEEP_COLS}, total_sleep_minutes, rem_pct, deep_pct from sleep_clean")
    q["silver_activity"] = _silver(f"select {ACTIVITY_COLS}, total_zone_minutes from activity_clean")

    # scores
    q["hrv_component"] = _gold(f"select user_id, date, {r9('base', 'sd0')}, fresh, {r9('c_hrv')} from rec_f")
    q["rhr_component"] = _gold(f"select user_id, date, {r9('rbase', 'c_rhr')} from rec_f")
    q["sleep_component"] = _gold(f"select user_id, date, {r9('c_sleep')} from rec_f")
    q["spo2_component"] = _gold("select user_id, date, round(c_ox, 9) as c_spo2 from rec_f")
    q["daily_recovery"] = _gold(f"select {REC_COLS} from rec")
    q["strain_scores"] = _silver("select * from strain", strain)
    q["sleep_metrics"] = _silver(
        f"select {SLEEP_COLS}, total_sleep_minutes, {r9('nightly_deficit')}, sleep_debt_hours, {r9('duration_7d_std')}, "
        "sleep_consistency_score, efficiency_7d_avg, rem_pct, deep_pct, sleep_quality_tier from sm",
        sm,
    )
    report = {
        "avg_sleep_hours": "avg(total_sleep_hours)",
        "avg_sleep_efficiency": "avg(sleep_efficiency_pct)",
        "avg_rem_pct": "avg(rem_pct)",
        "avg_deep_pct": "avg(deep_pct)",
        "max_sleep_debt": "max(sleep_debt_hours)",
        "avg_consistency_score": "avg(sleep_consistency_score)",
    }
    q["sleep_debt_report"] = _silver(
        "select user_id, " + ", ".join(f"{half_even('x_' + c, 2)} as {c}" for c in report)
        + ", excellent_nights, poor_nights, total_nights from dr",
        sm,
        "dr as (select user_id, " + ", ".join(f"{e} as x_{c}" for c, e in report.items())
        + ", count(*) filter (where sleep_quality_tier = 'Excellent') as excellent_nights, "
        "count(*) filter (where sleep_quality_tier = 'Poor') as poor_nights, count(total_sleep_hours) as total_nights from sm group by user_id)",
    )
    q["cohort_benchmarks"] = _gold(
        f"select user_id, {r9('avg_recovery', 'avg_hrv', 'avg_hrv_baseline')}, days_tracked, recovery_percentile from bm", bm
    )
    q["percent_rank_scaled"] = _gold(
        "select user_id, date, recovery_score, round(percent_rank() over (order by recovery_score nulls first), 9) as score_rank from rec"
    )
    q["level_benchmarks"] = _gold(
        f"select user_id, avg_recovery, days_tracked, fitness_level, {half_up('pr', 1)} as level_percentile from lv",
        "lv as (select user_id, round(a, 9) as avg_recovery, n as days_tracked, fitness_level, "
        "percent_rank() over (partition by fitness_level order by a nulls first) * 100 as pr from "
        "(select user_id, avg(recovery_score) as a, count(*) as n from rec group by user_id) r left join "
        "(select user_id as uid, min(fitness_level) as fitness_level from users group by user_id) u on r.user_id = u.uid)",
    )
    q["profile_scan"] = _raw("select * from users")
    q["late_sensor"] = _raw("select reading_id as record_id, user_id, date, respiratory_rate_brpm / 10 as skin_temp_delta_c, ingested_at from hrv_raw")
    q["gold_export"] = _gold("select r.user_id, r.date, r.recovery_score, s.strain_score from rec r join strain s on r.user_id = s.user_id and r.date = s.date", strain)
    q["user_date_uniqueness"] = _raw(
        " union all ".join(
            f"select '{name}' as table_name, cast(sum(n - 1) as bigint) as surplus_rows, count(*) filter (where n > 1) as user_days_affected, "
            f"sum(n - 1) = 0 as passed from (select count(*) as n from {view} group by user_id, date)"
            for name, view in (("hrv_readings", "hrv_raw"), ("sleep_records", "sleep_raw"), ("activity_records", "activity_raw"))
        )
    )
    q["hr_zone_allocation"] = _raw("").rstrip() + ",\n" + _zone_allocation()
    q["gold_from_raw"] = f"with {raw_ctes()},\n{recovery_ctes('hrv_last', 'sleep_last')}\nselect {REC_COLS} from rec"
    q["gold_from_silver"] = q["daily_recovery"]
    own = f"sleep_debt_hours, {r9('duration_7d_std')}, sleep_consistency_score, efficiency_7d_avg, sleep_quality_tier"
    averages = f"user_id, {r9('avg_recovery', 'avg_hrv', 'avg_hrv_baseline')}, days_tracked, recovery_percentile"
    q["gold_incremental"] = _gold(
        f"select * from (select {REC_COLS} from rec) full join strain using (user_id, date) "
        f"full join (select user_id, date, {own} from sm) using (user_id, date) left join (select {averages} from bm) using (user_id)",
        strain,
        sm,
        bm,
    )

    q["sketched_quartiles"] = _gold(
        "select user_id, count(hrv_rmssd) as readings, quantile_disc(hrv_rmssd, 0.25) as q1, quantile_disc(hrv_rmssd, 0.5) as median, "
        "quantile_disc(hrv_rmssd, 0.75) as q3, null::boolean as within_bound from rec where hrv_rmssd is not null group by user_id "
        "union all select null, null, null, null, null, true"
    )
    q["active_users"] = _raw(
        " union all ".join(
            f"select '{name}' as source_table, '{period}' as period, cast(date_trunc('{period}', cast(date as date)) as date) as first_day, "
            f"count(distinct user_id) as users from {view} group by all"
            for name, view in (("hrv_readings", "hrv_raw"), ("sleep_records", "sleep_raw"), ("activity_records", "activity_raw"))
            for period in ("day", "week", "month")
        )
    )
    q["colocated_recovery"] = q["daily_recovery"]
    q["zordered_table"] = _gold(
        " union all ".join(
            f"select '{c}' as filter_on, count(*) as rows, true as most_files_skipped from rec where {c} = (select min({c}) from rec)" for c in ("user_id", "date")
        )
    )
    four_weeks = "(partition by user_id order by x range between 3 preceding and current row)"
    q["weekly_sleep_trend"] = _silver(
        "select user_id, week, nights, round(mean_hours, 9) as mean_hours, weeks, round(s, 9) as slope, "
        "case when round(s, 9) > 0 then 'Improving' when s is not null then 'Declining' end as trend from tr",
        "wk as (select user_id, cast(date_trunc('week', date) as date) as week, count(total_sleep_hours) as nights, "
        "avg(total_sleep_hours) as mean_hours from sleep_clean group by all having count(total_sleep_hours) > 0)",
        "wx as (select *, (week - date '1970-01-05') // 7 as x from wk)",
        f"tr as (select *, count(*) over {four_weeks} as weeks, regr_slope(mean_hours, x) over {four_weeks} as s0, "
        f"case when count(*) over {four_weeks} > 1 then regr_slope(mean_hours, x) over {four_weeks} end as s from wx)",
    )
    q["recovery_sample"] = _gold("select user_id, date, recovery_score, recovery_state, hrv_component from rec order by date desc, user_id limit 5")

    # three deliveries to the streams; every 17th user delivers the first days with the last, when they are closed
    first_day = "(select min(cast(ts as date)) from events)"
    held_back = f"user_id % 17 = 3 and cast(ts as date) - {first_day} < 5"
    held = "cast(substr(user_id, 2) as bigint) % 17 = 3 and cast(date as date) - (select min(cast(ts as date)) from ev) < 5"
    q["silver_stream"] = _silver(
        "select reading_id, user_id, cast(date as varchar) as date, hrv_rmssd_ms, null::varchar as rejection_reason from hrv_clean "
        f"where not ({held}) union all select reading_id, user_id, date, null, concat_ws('; ', nullif({_reason(HRV_BOUNDS)}, ''), "
        f"case when {held} then 'day was closed: ' || date end) from hrv_last where ({held}) or not ({_ok(HRV_BOUNDS)})"
    )
    closed = "cast(date as date) < least((select max(date) from hrv_clean), (select max(date) from sleep_clean)) - 3"
    q["gold_stream"] = (
        f"with {silver_ctes(f'not ({held_back})')},\nhrv_closed as (select * from hrv_clean where {closed}),\n"
        f"sleep_closed as (select * from sleep_clean where {closed}),\n{recovery_ctes('hrv_closed', 'sleep_closed')},\n"
        f"{sm.replace('from sleep_clean', 'from sleep_closed')}\nselect * from (select {REC_COLS} from rec) "
        f"full join (select user_id, date, {own} from sm) using (user_id, date)"
    )

    # the eight analytics queries
    q["recovery_last_30d"] = _gold(
        "select user_id, date, recovery_score, recovery_state, hrv_component, sleep_component, rhr_component, "
        f"{half_up('hrv_rmssd', 1)} as hrv_rmssd_ms, {half_up('hrv_baseline', 1)} as hrv_7d_baseline_ms from rec "
        "where date >= (select max(date) from rec) - 30"
    )
    q["strain_vs_next_day"] = _gold(
        "select user_id, date as strain_date, strain_score, strain_category, recovery_score as next_day_recovery, "
        "recovery_state as next_day_state, recovery_score - lag(recovery_score) over (partition by user_id order by date) "
        "as recovery_delta from nx",
        strain,
        nextday,
    )
    q["weekday_pattern"] = _gold(
        f"select day_of_week, dow_num, {half_up('a', 1)} as avg_recovery, {half_up('b', 1)} as avg_hrv_ms, sample_days, "
        f"{half_up('c', 1)} as pct_green_days from wd",
        "wd as (select dayname(date) as day_of_week, cast(dayofweek(date) as int) as dow_num, avg(recovery_score) as a, "
        "avg(hrv_rmssd) as b, count(*) as sample_days, sum(case when recovery_state = 'Green' then 1.0e0 else 0 end) / count(*) * 100 as c "
        "from rec group by dayname(date), dayofweek(date))",
    )
    q["hrv_trend"] = _gold(
        f"select user_id, date, hrv_rmssd, {r9('hrv_7d_avg', 'hrv_28d_avg')}, "
        "case when round(hrv_7d_avg, 9) > round(hrv_28d_avg, 9) then 'Improving' else 'Declining' end as hrv_trend from ht",
        "ht as (select user_id, date, hrv_rmssd, avg(hrv_rmssd) over (partition by user_id order by date rows between 6 preceding and current row) as hrv_7d_avg, "
        "avg(hrv_rmssd) over (partition by user_id order by date rows between 27 preceding and current row) as hrv_28d_avg from rec)",
    )
    q["sleep_vs_recovery"] = _gold(
        "select s.user_id, s.date, s.total_sleep_hours, s.sleep_efficiency_pct, s.sleep_debt_hours, s.sleep_quality_tier, "
        "r.recovery_score, r.recovery_state from sm s join rec r on s.user_id = r.user_id and s.date = r.date",
        sm,
    )
    q["performance_tiers"] = _gold(
        f"select user_id, {half_up('avg_recovery', 1)} as avg_recovery_score, {half_up('avg_hrv', 1)} as avg_hrv_ms, days_tracked, "
        "recovery_percentile, case when recovery_percentile >= 75 then 'Elite' when recovery_percentile >= 50 then 'Above Average' "
        "when recovery_percentile >= 25 then 'Average' when recovery_percentile is not null then 'Below Average' end as performance_tier from bm",
        bm,
    )
    q["quarantine_weekly"] = _silver(
        "select w.source_table, w.week, quarantined_records, affected_users, broken_rules from "
        "(select source_table, week, count(*) as quarantined_records, count(distinct user_id) as affected_users from qw group by source_table, week) w "
        "left join (select source_table, week, string_agg(distinct rule, ' | ' order by rule) as broken_rules from "
        "(select source_table, week, regexp_extract(unnest(string_split(rejection_reason, '; ')), '^[a-z_0-9]+') as rule from qw) group by source_table, week) r "
        "on w.source_table = r.source_table and w.week is not distinct from r.week",
        quarantine,
        weeks,
    )
    q["quarantine_weekly_reasons"] = _silver(
        "select source_table, week, rejection_reason, count(*) as records from qw where rejection_reason != '' "
        "group by source_table, week, rejection_reason",
        quarantine,
        weeks,
    )

    # panels and findings
    q["user_date_slice"] = _gold(
        f"select {REC_COLS} from rec, mid where user_id = (select min(user_id) from hrv_raw) and date between m and m + 7",
        "mid as (select cast(min(cast(ts as date)) + cast(floor((max(cast(ts as date)) - min(cast(ts as date))) / 2) as int) as date) as m from events)",
    )
    q["recovery_last_7d"] = q["recovery_last_30d"].replace("- 30", "- 7")
    q["kpi_summary"] = _gold(
        "select coalesce(a.user_id, b.user_id, c.user_id) as user_id, round(coalesce(ar, 0.0e0), 9) as avg_recovery, "
        "round(coalesce(ar, 0.0e0) - 50, 9) as recovery_vs_50, coalesce(green, 0) as green_days, coalesce(n, 0) as days_tracked, "
        "round(coalesce(green, 0) / cast(greatest(coalesce(n, 0), 1) as double) * 100, 9) as green_pct, "
        "round(coalesce(st, 0.0e0), 9) as avg_strain, round(coalesce(sl, 0.0e0), 9) as avg_sleep, "
        "round(coalesce(sl, 0.0e0) - 8, 9) as sleep_vs_8h, round(coalesce(hv, 0.0e0), 9) as avg_hrv "
        "from (select user_id, avg(recovery_score) as ar, count(*) filter (where recovery_state = 'Green') as green, count(*) as n, "
        "avg(hrv_rmssd) as hv from rec group by user_id) a "
        "full join (select user_id, avg(strain_score) as st from strain group by user_id) b on a.user_id = b.user_id "
        "full join (select user_id, avg(total_sleep_hours) as sl from sm group by user_id) c on coalesce(a.user_id, b.user_id) = c.user_id",
        strain,
        sm,
    )
    q["run_stats"] = _silver(
        "select 'users' as statistic, cast(count(distinct user_id) as double) as value from sm "
        "union all select 'avg_sleep_hours', round(avg(total_sleep_hours), 9) from sm "
        "union all select 'avg_sleep_debt_hours', round(avg(sleep_debt_hours), 9) from sm "
        "union all select 'strain_records', cast(count(*) as double) from strain "
        "union all select 'avg_strain', round(avg(strain_score), 9) from strain "
        "union all select 'max_strain', max(strain_score) from strain",
        strain,
        sm,
    )
    labels = [
        ("hrv_component", "HRV (40%)"),
        ("rhr_component", "Resting HR (25%)"),
        ("sleep_component", "Sleep (25%)"),
        ("spo2_component", "SpO2 (10%)"),
    ]
    q["component_means"] = _gold(
        " union all ".join(
            f"select user_id, '{c}' as component, round(avg({c}), 9) as mean_score, '{label}' as label from rec group by user_id"
            for c, label in labels
        )
    )
    q["week_weekday_grid"] = _gold(
        "select user_id, iso_year, iso_week, weekday_no, day_of_week, round(avg_recovery, 9) as avg_recovery from gr", enough, grid
    )
    days = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    q["week_weekday_matrix"] = _gold(
        "select user_id, iso_year, iso_week, "
        + ", ".join(f"round(max(case when day_of_week = '{d}' then avg_recovery end), 9) as {d}" for d in days)
        + " from gr group by user_id, iso_year, iso_week",
        enough,
        grid,
    )
    stages = [
        ("deep_sleep_minutes", "Deep Sleep"),
        ("rem_sleep_minutes", "REM"),
        ("light_sleep_minutes", "Light Sleep"),
        ("awake_minutes", "Awake"),
    ]
    q["sleep_stage_long"] = _silver(
        " union all ".join(
            f"select user_id, date, '{label}' as stage, round({c} / 60, 9) as hours from sleep_clean" for c, label in stages
        )
    )
    q["ols_strain_recovery"] = _gold(
        "select round(regr_slope(y, x), 9) as slope, round(regr_intercept(y, x), 9) as intercept, round(regr_r2(y, x), 9) as r2, "
        "cast(regr_count(y, x) as bigint) as points from (select cast(recovery_score as double) as y, strain_score as x from nx)",
        strain,
        nextday,
    )
    q["hrv_quartiles"] = _gold(
        f"select user_id, readings, {r9('q1', 'median', 'q3', 'lower_fence', 'upper_fence')} from bf", box
    )
    q["hrv_outliers"] = _gold(
        "select r.user_id, r.date, r.hrv_rmssd, case when r.hrv_rmssd < b.lower_fence then 'low' else 'high' end as side "
        "from rec r join bf b on r.user_id = b.user_id where r.hrv_rmssd < b.lower_fence or r.hrv_rmssd > b.upper_fence",
        box,
    )
    q["hrv_histogram"] = _gold(
        "select user_id, floor(hrv_rmssd / 5.0e0) * 5.0e0 as class_start, count(*) as readings from rec where hrv_rmssd is not null "
        "group by user_id, floor(hrv_rmssd / 5.0e0)"
    )
    q["recovery_state_distribution"] = _gold(
        f"select recovery_state, days, {half_up('p', 1)} as share_pct from sh2", _shares("rec", "recovery_state")
    )
    q["strain_category_distribution"] = _silver(
        f"select strain_category, days, {half_up('p', 1)} as share_pct, cast(case strain_category when 'Recovery' then 1 "
        "when 'Light' then 2 when 'Moderate' then 3 when 'Hard' then 4 else 5 end as int) as category_no from sh2",
        strain,
        _shares("strain", "strain_category"),
    )
    q["sleep_tier_share"] = _silver(
        f"select sleep_quality_tier, days, {half_up('p', 1)} as share_pct from sh2", sm, _shares("sm", "sleep_quality_tier")
    )
    q["component_correlations"] = _gold(
        " union all ".join(
            f"select '{c}' as measure, round(corr({c}, cast(recovery_score as double)), 9) as r_with_score from rec"
            for c in ["hrv_rmssd", "hrv_component", "rhr_component", "sleep_component", "spo2_component"]
        )
    )
    q["sleep_band_means"] = _gold(
        "select case when s.total_sleep_hours > 9 then 'over 9 h' when s.total_sleep_hours < 6 then 'under 6 h' "
        "when s.total_sleep_hours < 7 then '6 to 7 h' when s.total_sleep_hours is not null then '7 to 9 h' end as sleep_band, "
        "round(avg(recovery_score), 9) as avg_recovery, round(avg(hrv_rmssd), 9) as avg_hrv, count(*) as nights "
        "from sleep_clean s join rec r on s.user_id = r.user_id and s.date = r.date group by 1"
    )
    q["training_phase_means"] = _gold(
        "select case when datediff('day', (select min(date) from rec), date) % 28 < 21 then 'training' else 'recovery week' end as phase, "
        "round(avg(recovery_score), 9) as avg_recovery, count(*) as days from rec group by 1"
    )
    q["fitness_level_means"] = _gold(
        "select fitness_level, round(avg(recovery_score), 9) as avg_recovery, round(avg(hrv_rmssd), 9) as avg_hrv, "
        "cast(count(*) as bigint) as days from rec r join users u on r.user_id = u.user_id group by fitness_level"
    )

    # data quality
    q["rule_violations"] = _silver("select * from violations", violations)
    q["rule_overlap"] = _silver(
        "select source_table, failed_rule, count(*) as violations, count(distinct record_id) as records, "
        "count(distinct record_id) filter (where record_id in (select record_id from violations v where v.source_table = o.source_table "
        "group by record_id having count(distinct failed_rule) > 1)) as records_breaking_several "
        "from violations o group by source_table, failed_rule",
        violations,
    )
    q["pass_rate"] = _silver(
        "select scanned as records_scanned, bad as quarantined, round((scanned - bad) / cast(scanned as double) * 100, 2) as pass_rate_pct, "
        "11 as rules_enforced from (select (select count(*) from hrv_raw) + (select count(*) from sleep_raw) + (select count(*) from activity_raw) "
        "as scanned, (select count(distinct record_id) from violations) as bad)",
        violations,
    )
    gate = _gate()
    q["quality_gate"] = _silver("select * from gate", gate)
    q["quality_gate_summary"] = _silver(
        "select table_name, count(*) filter (where passed) as rules_passed, count(*) as rules_total, "
        "round(count(*) filter (where passed) * 100.0e0 / count(*), 1) as pass_rate_pct, "
        "(select bool_and(passed) from gate) as overall_passed from gate group by table_name",
        gate,
    )
    q["quality_report"] = q["quality_gate_summary"]
    return q
