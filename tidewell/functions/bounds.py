"""Physiological limits of the readings, and the expressions that apply them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

# Inclusive limits per column.  How a limit is written (5 or 5.0) is how it is
# printed in a rejection reason.
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

Bounds = Mapping[str, tuple[float, float]]


def present(bounds: Bounds, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """The limits that apply to a table: columns it does not have are skipped."""
    return {name: limits for name, limits in bounds.items() if name in columns}


def within(name: str, low: float, high: float) -> str:
    """Inside the closed range; no reading is not a bad reading."""
    return f"({name} is null or {name} between {low} and {high})"


def all_within(bounds: Bounds) -> str:
    return " and ".join(within(name, *limits) for name, limits in bounds.items()) or "true"


def breach_text(bounds: Bounds) -> str:
    """Every broken limit of a row in one text; empty when nothing is broken."""
    parts = [
        f"if(not {within(name, low, high)}, concat('{name} out of range [{low},{high}]: ', string({name})), null)"
        for name, (low, high) in bounds.items()
    ]
    return f"concat_ws('; ', {', '.join(parts)})" if parts else "''"


def side_reason(name: str, low: float, high: float) -> str:
    below, above = BOUND_REASONS.get(name, ("", ""))
    return f"case when {name} < {low} then '{below}' when {name} > {high} then '{above}' end"
