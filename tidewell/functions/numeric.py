"""Numeric building blocks of the formulas."""

from __future__ import annotations

from collections.abc import Sequence

# Window and partial sums add doubles in no fixed order.  Cutting at nine decimals first takes that
# noise away, so a rounded result does not depend on how the rows were split over tasks.
# Scaling and rint stay in plain double arithmetic; round() on doubles goes through decimal text.
NOISE_DECIMALS = 9


def _to_even(x: str, decimals: int) -> str:
    return f"(rint(({x}) * 1e{decimals}D) / 1e{decimals}D)" if decimals else f"rint({x})"


def number(x: float) -> str:
    """A double literal: a bare 0.25 would be a decimal."""
    return f"{float(x)!r}D"


def settle(x: str) -> str:
    return _to_even(x, NOISE_DECIMALS)


def half_up(x: str, decimals: int) -> str:
    return f"round({settle(x)}, {decimals})"


def half_even(x: str, decimals: int) -> str:
    return _to_even(settle(x), decimals)


def clip(x: str, low: float | None = None, high: float | None = None) -> str:
    """Limit to [low, high]; NULL stays NULL (plain least/greatest would turn it into a bound)."""
    limited = x
    if low is not None:
        limited = f"greatest({limited}, {number(low)})"
    if high is not None:
        limited = f"least({limited}, {number(high)})"
    return f"if(({x}) is null, null, {limited})"


def ratio(a: str, b: str) -> str:
    """a / b, NULL when b is zero (the session may run in ANSI mode)."""
    return f"try_divide({a}, {b})"


def line_through(x: str, anchors: Sequence[tuple[float, float]], tail_slope: float = 0.0) -> str:
    """Continuous broken line: first y left of the first anchor, ``tail_slope`` right of the last one."""
    (x0, y0), (xn, yn) = anchors[0], anchors[-1]
    pieces = [f"when {x} < {number(x0)} then {number(y0)}"]
    for (xa, ya), (xb, yb) in zip(anchors, anchors[1:]):
        slope = (yb - ya) / (xb - xa)
        pieces.append(f"when {x} < {number(xb)} then {number(ya)} + ({x} - {number(xa)}) * {number(slope)}")
    pieces.append(f"when {x} is not null then {number(yn)} + ({x} - {number(xn)}) * {number(tail_slope)}")
    return f"case {' '.join(pieces)} end"


def band(x: str, upper_limits: Sequence[tuple[float, str]], last: str) -> str:
    """Label of the first band whose exclusive upper limit lies above x; NULL for NULL."""
    pieces = [f"when {x} < {limit} then '{label}'" for limit, label in upper_limits]
    return f"case {' '.join(pieces)} when {x} is not null then '{last}' end"


def position_in(x: str, ordered_labels: Sequence[str]) -> str:
    """1-based place of a label in a fixed order, for sorting by it."""
    return f"int(array_position(array({', '.join(repr(label) for label in ordered_labels)}), {x}))"
