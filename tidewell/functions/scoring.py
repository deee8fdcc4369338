"""Recovery, strain and sleep scores."""

from __future__ import annotations

import math
from collections.abc import Sequence

from tidewell.functions.numeric import band, clip, half_even, line_through, number, ratio

# These decide the published scores.
RECOVERY_WEIGHTS = {"hrv": 0.40, "rhr": 0.25, "sleep": 0.25, "spo2": 0.10}
BASELINE_ROWS = 7
BASELINE_MIN_ROWS = 3
SCORE_FLOOR, SCORE_CEILING = 5, 98
RECOVERY_STATES = [(33, "Red"), (66, "Yellow")]
RECOVERY_TOP_STATE = "Green"
SLEEP_HOURS_CURVE = [(4, 0), (6, 70), (9, 100)]
OVERSLEEP_SLOPE = -8
SPO2_CURVE = [(80, 0), (90, 20), (95, 80), (97, 100)]
ZONE_WEIGHTS = [0.25, 0.5, 1.0, 2.5, 5.0, 10.0]
MAX_STRAIN = 21.0
ALL_OUT_LOAD = 400.0
LOAD_KNEE = 15.0
STRAIN_CATEGORIES = [(5, "Recovery"), (10, "Light"), (14, "Moderate"), (18, "Hard")]
STRAIN_TOP_CATEGORY = "All Out"
DEFAULT_MAX_HR = 190
IDEAL_SLEEP_HOURS = 8.0
DEBT_ROWS = 14
CONSISTENCY_ROWS = 7
SLEEP_TIERS = [(3, "Poor"), (5, "Fair"), (7, "Good")]
SLEEP_TOP_TIER = "Excellent"
PERFORMANCE_TIERS = [(25, "Below Average"), (50, "Average"), (75, "Above Average")]
PERFORMANCE_TOP_TIER = "Elite"
ZONE_FLOORS = [0.50, 0.60, 0.70, 0.80, 0.90, 0.95]
ZONE_SHARES = {"main": 0.45, "below": 0.30, "above": 0.15, "peak": 0.10}


def usable_deviation(deviation: str, baseline: str) -> str:
    """A spread below one (or unknown) says nothing; ten percent of the baseline stands in."""
    return f"if({deviation} >= 1, {deviation}, {baseline} * 0.1D)"


def hrv_score(today: str, baseline: str, deviation: str) -> str:
    z = ratio(f"{today} - {baseline}", usable_deviation(deviation, baseline))
    return clip(f"50D + 45D * tanh(0.75D * {z})", SCORE_FLOOR, SCORE_CEILING)


def rhr_score(today: str, baseline: str) -> str:
    return clip(f"75D - 5D * ({today} - {baseline})", SCORE_FLOOR, SCORE_CEILING)


def _stage_share(minutes: str, hours: str) -> str:
    return f"case when {hours} > 0 then {minutes} / ({hours} * 60D) * 100D when {hours} is not null then 0D end"


def sleep_score(hours: str, efficiency: str, rem: str, deep: str) -> str:
    duration = line_through(hours, SLEEP_HOURS_CURVE, OVERSLEEP_SLOPE)
    rem_fit = f"100D - 4D * abs({_stage_share(rem, hours)} - 22.5D)"
    deep_fit = f"100D - 5D * abs({_stage_share(deep, hours)} - 17.5D)"
    stages = clip(f"(({rem_fit}) + ({deep_fit})) / 2D", 0, 100)
    in_bed = clip(f"({efficiency} - 70D) / 25D * 100D", 0, 100)
    return clip(f"({duration}) * 0.5D + ({stages}) * 0.3D + ({in_bed}) * 0.2D", 0, 100)


def spo2_score(saturation: str) -> str:
    """No reading counts as no points, unlike the other components."""
    return f"coalesce({line_through(saturation, SPO2_CURVE)}, 0D)"


def recovery_score(hrv: str, rhr: str, sleep: str, spo2: str) -> str:
    parts = {"hrv": hrv, "rhr": rhr, "sleep": sleep, "spo2": spo2}
    total = " + ".join(f"{parts[name]} * {number(weight)}" for name, weight in RECOVERY_WEIGHTS.items())
    return f"int({clip(half_even(total, 0), 0, 100)})"


def recovery_state(score: str) -> str:
    return band(score, RECOVERY_STATES, RECOVERY_TOP_STATE)


def strain_raw(zone_minutes: Sequence[str]) -> str:
    """Strain on 0..21, not rounded.  The load is linear in minutes, the score logarithmic in load."""
    load = " + ".join(f"{m} * {number(w)}" for m, w in zip(zone_minutes, ZONE_WEIGHTS))
    per_unit = MAX_STRAIN / math.log1p(ALL_OUT_LOAD / LOAD_KNEE)
    return clip(f"log1p(({load}) / {number(LOAD_KNEE)}) * {number(per_unit)}", 0, MAX_STRAIN)


def strain_category(raw_score: str) -> str:
    return band(raw_score, STRAIN_CATEGORIES, STRAIN_TOP_CATEGORY)


def dominant_zone(zone_minutes: Sequence[str]) -> str:
    """The lowest zone holding the most minutes, 1-based."""
    minutes = f"array({', '.join(zone_minutes)})"
    return f"int(array_position({minutes}, array_max({minutes})))"


def peak_share(peak_hr: str, max_hr: str) -> str:
    return f"if({max_hr} > 0, {half_even(f'{ratio(peak_hr, max_hr)} * 100D', 1)}, 0D)"


def sleep_consistency(deviation: str) -> str:
    return half_even(clip(f"(1D - {deviation} / 2D) * 100D", 0, 100), 1)


def sleep_tier(hours: str, efficiency: str, rem_pct: str, deep_pct: str) -> str:
    points = (
        f"(case when {hours} between 7 and 9 then 3 when {hours} between 6 and 10 then 1 else 0 end"
        f" + case when {efficiency} >= 90 then 2 when {efficiency} >= 80 then 1 else 0 end"
        f" + if({rem_pct} between 18 and 26, 1, 0) + if({deep_pct} between 15 and 25, 1, 0))"
    )
    return band(points, SLEEP_TIERS, SLEEP_TOP_TIER)


def performance_tier(percentile: str) -> str:
    return band(percentile, PERFORMANCE_TIERS, PERFORMANCE_TOP_TIER)


def zone_of(heart_rate: str, max_hr: str) -> str:
    """Highest zone whose floor the heart rate reaches; below every floor it is zone 1."""
    floors = list(enumerate(ZONE_FLOORS, start=1))[:0:-1]
    pieces = [f"when {heart_rate} >= {max_hr} * {number(floor)} then {zone}" for zone, floor in floors]
    return f"case {' '.join(pieces)} else 1 end"


def allocated_zones(main: str, peak: str, duration: str) -> list[str]:
    """Minutes per zone for a session known only by the zones of its average and its peak.

    Fixed shares of the session go to the zone of the average, its neighbours and the zone of the
    peak; whole minutes lost to truncation are given back by one common factor.
    """
    share = {name: f"int({duration} * {number(part)})" for name, part in ZONE_SHARES.items()}
    target = {
        "main": main,
        "below": f"greatest({main} - 1, 1)",
        "above": f"least({main} + 1, 6)",
        "peak": f"greatest({peak}, {main})",
    }
    given = f"({' + '.join(share.values())})"
    factor = ratio(f"double({duration})", f"double({given})")
    zones = []
    for number_ in range(1, 7):
        minutes = " + ".join(f"if({target[name]} = {number_}, {share[name]}, 0)" for name in share)
        zones.append(f"if({given} > 0, int(({minutes}) * {factor}), 0)")
    return zones
