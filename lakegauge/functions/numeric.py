"""Rounding and shares that do not depend on how the data was partitioned."""

from __future__ import annotations


def rounded(x: str, digits: int) -> str:
    """Round half up to ``digits``, absorbing summation noise.

    A distributed sum of doubles ends in different last bits with different
    partitionings, which flips values lying on a rounding tie. Going through
    ``decimal(28,10)`` first removes noise below 1e-10. Values that do not
    fit the decimal (infinities, beyond 1e18) are rounded as doubles.
    """
    exact = f"CAST(round(try_cast({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"
    return f"coalesce({exact}, round({x}, {digits}))"


def share(part: str, whole: str) -> str:
    """``part / whole`` as a double, NULL when ``whole`` is 0."""
    return f"try_divide(CAST({part} AS DOUBLE), CAST({whole} AS DOUBLE))"


def percent(part: str, whole: str) -> str:
    """Percentage to one decimal, NULL on an empty input."""
    return rounded(f"100D * {share(part, whole)}", 1)
