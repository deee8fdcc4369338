"""Golden values of the formulas."""

import pytest

from tidewell.functions import scoring as S
from tidewell.functions.numeric import clip, half_even, line_through


@pytest.mark.parametrize(
    "today, base, spread, expected",
    [
        (60, 60, 10, 50.0),
        (90, 60, 10, 94.0112),
        (30, 60, 10, 5.9888),
        (60, 60, 0, 50.0),
        (5, 80, 10, 5.0012),
        (200, 40, 8, 95.0),
        (75, 60, 8, 89.9013),
        (20, 65, 8, 5.0195),
        (60, 60, None, 50.0),
        (None, 60, 10, None),
        (60, 0, 0, None),
    ],
)
def test_hrv_score(evaluate, today, base, spread, expected):
    got = evaluate(S.hrv_score("v", "b", "s"), v=today, b=base, s=spread)
    assert got is None if expected is None else got == pytest.approx(expected, abs=1e-4)


@pytest.mark.parametrize(
    "today, base, expected", [(60, 60, 75), (55, 65, 98), (75, 60, 5), (30, 90, 98), (130, 40, 5), (60, None, None)]
)
def test_rhr_score(evaluate, today, base, expected):
    assert evaluate(S.rhr_score("v", "b"), v=today, b=base) == expected


@pytest.mark.parametrize(
    "hours, efficiency, rem, deep, expected",
    [
        (8, 90, 100, 90, 89.0625),
        (4, 90, 100, 90, 19.5),
        (6, 90, 100, 90, 72.2083),
        (8, 95, 110, 90, 93.8125),
        (3.5, 60, 20, 15, 14.4464),
        (8.5, 93, 110, 95, 94.4956),
        (4.5, 65, 40, 25, 27.9583),
        (0, 95, 0, 0, 0 * 0.5 + 11.25 * 0.3 + 20),
        (None, 90, 100, 90, None),
        (8, None, 100, 90, None),
    ],
)
def test_sleep_score(evaluate, hours, efficiency, rem, deep, expected):
    got = evaluate(S.sleep_score("h", "e", "r", "d"), h=hours, e=efficiency, r=rem, d=deep)
    assert got is None if expected is None else got == pytest.approx(expected, abs=1e-4)


@pytest.mark.parametrize(
    "saturation, expected",
    [(98, 100), (97, 100), (95, 80), (94.5, 74), (90, 20), (88, 16), (85, 10), (80, 0), (70, 0), (None, 0)],
)
def test_spo2_score(evaluate, saturation, expected):
    assert evaluate(S.spo2_score("s"), s=saturation) == pytest.approx(expected)


@pytest.mark.parametrize(
    "parts, score, state",
    [
        ((89.9013, 95, 94.4956, 100), 93, "Green"),
        ((5.0195, 5, 27.9583, 74), 18, "Red"),
        ((32.5, 32.5, 32.5, 32.5), 32, "Red"),
        ((33.5, 33.5, 33.5, 33.5), 34, "Yellow"),
        ((33, 33, 33, 33), 33, "Yellow"),
        ((66, 66, 66, 66), 66, "Green"),
        ((65.49, 65.49, 65.49, 65.49), 65, "Yellow"),
        ((50, None, 50, 50), None, None),
    ],
)
def test_recovery_score_and_state(evaluate, parts, score, state):
    values = dict(zip("abcd", parts))
    text = S.recovery_score("a", "b", "c", "d")
    assert evaluate(text, **values) == score
    assert evaluate(S.recovery_state(f"({text})"), **values) == state


@pytest.mark.parametrize(
    "zones, score, category",
    [
        ((0, 0, 0, 0, 0, 0), 0, "Recovery"),
        ((0, 0, 0, 0, 30, 90), 21, "All Out"),
        ((5, 20, 30, 15, 5, 0), 13.09, "Moderate"),
        ((60, 20, 10, 5, 0, 0), 9.03, "Light"),
        ((5, 10, 20, 30, 20, 10), 19.28, "All Out"),
        ((0, 0, 0, 0, 0, 40), 21, "All Out"),
    ],
)
def test_strain(evaluate, zones, score, category):
    names = [f"z{i}" for i in range(6)]
    values = dict(zip(names, zones))
    raw = S.strain_raw(names)
    assert evaluate(half_even(raw, 2), **values) == score
    assert evaluate(S.strain_category(raw), **values) == category


@pytest.mark.parametrize(
    "score, category",
    [(4.999, "Recovery"), (5, "Light"), (10, "Moderate"), (14, "Hard"), (17.999, "Hard"), (18, "All Out"), (21, "All Out")],
)
def test_strain_category_limits(evaluate, score, category):
    assert evaluate(S.strain_category("s"), s=score) == category


def test_dominant_zone_is_the_lowest_of_equals(evaluate):
    names = [f"z{i}" for i in range(6)]
    assert evaluate(S.dominant_zone(names), **dict.fromkeys(names, 0)) == 1
    assert evaluate(S.dominant_zone(names), **dict(zip(names, (1, 7, 3, 7, 0, 0)))) == 2


def test_peak_share(evaluate):
    assert evaluate(S.peak_share("p", "m"), p=171, m=190) == 90.0
    assert evaluate(S.peak_share("p", "m"), p=171, m=0) == 0.0
    assert evaluate(S.peak_share("p", "m"), p=None, m=190) is None


@pytest.mark.parametrize(
    "hours, efficiency, rem, deep, tier",
    [
        (8, 92, 20, 20, "Excellent"),
        (7, 90, 18, 15, "Excellent"),
        (9, 85, 26, 25, "Good"),
        (9.01, 92, 20, 20, "Good"),
        (6, 80, 18, 10, "Fair"),
        (10.01, 92, 10, 10, "Poor"),
        (5, 79, None, None, "Poor"),
        (None, None, None, None, "Poor"),
    ],
)
def test_sleep_tier(evaluate, hours, efficiency, rem, deep, tier):
    assert evaluate(S.sleep_tier("h", "e", "r", "d"), h=hours, e=efficiency, r=rem, d=deep) == tier


@pytest.mark.parametrize("p, tier", [(100, "Elite"), (75, "Elite"), (50, "Above Average"), (25, "Average"), (24.9, "Below Average")])
def test_performance_tier(evaluate, p, tier):
    assert evaluate(S.performance_tier("p"), p=p) == tier


def _zones(evaluate, avg_hr, peak, minutes, max_hr):
    main, top = S.zone_of("a", "m"), S.zone_of("p", "m")
    texts = S.allocated_zones(f"({main})", f"({top})", "int(d)")
    return [evaluate(t, a=avg_hr, p=peak, d=minutes, m=max_hr) for t in texts]


def test_zone_allocation(evaluate):
    # average in zone 3, peak in zone 5: 27 + 18 + 9 + 6 of 60 minutes
    assert _zones(evaluate, 145, 185, 60, 200) == [0, 18, 27, 9, 6, 0]
    # at the top the neighbour above is the zone itself
    assert _zones(evaluate, 195, 200, 60, 200) == [0, 0, 0, 0, 18, 42]
    # below every floor
    assert _zones(evaluate, 60, 70, 40, 200) == [34, 6, 0, 0, 0, 0]
    # lost minutes are given back: 4 + 3 + 1 + 1 = 9 of 10
    assert _zones(evaluate, 145, 185, 10, 200) == [0, 3, 4, 1, 1, 0]
    assert _zones(evaluate, 145, 185, 1, 200) == [0] * 6
    assert _zones(evaluate, 145, 185, 0, 200) == [0] * 6


def test_numeric_helpers(evaluate):
    assert evaluate(clip("x", 0, 10), x=None) is None
    assert evaluate(clip("x", 0, 10), x=-1) == 0.0
    assert evaluate(half_even("x", 0), x=2.5) == 2.0
    assert evaluate(half_even("x", 2), x=0.125) == 0.12
    assert evaluate(line_through("x", [(0, 0), (1, 10)], -1), x=3) == 8.0
