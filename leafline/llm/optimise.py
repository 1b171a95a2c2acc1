"""A small limited-memory BFGS for models that fit one task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 100, memory: int = 8, tolerance: float = 1e-7) -> np.ndarray:
    """f gives value and gradient. Stops when a step gains less than tolerance of the value."""
    value, slope = f(x)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        d, back = slope.copy(), []
        for s, y in reversed(pairs):
            a = s @ d / (s @ y)
            d -= a * y
            back.append(a)
        if pairs:
            s, y = pairs[-1]
            d *= (s @ y) / (y @ y)
        else:
            d /= max(1.0, float(np.abs(slope).sum()))
        for (s, y), a in zip(pairs, reversed(back), strict=True):
            d += (a - y @ d / (s @ y)) * s
        step, down = 1.0, float(slope @ d)
        while True:
            tried = x - step * d
            new, new_slope = f(tried)
            if new <= value - 1e-4 * step * down or step < 1e-8:
                break
            step /= 2
        if (s := tried - x) @ (y := new_slope - slope) > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        gain, x, value, slope = value - new, tried, new, new_slope
        if gain <= tolerance * abs(value):
            break
    return x
