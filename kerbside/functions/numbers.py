"""Numeric expressions as Spark SQL text."""

from __future__ import annotations

# 2**20 steps per unit: integer parts of validated miles and mph add up exactly.
FRACTION_STEPS = 1 << 20


def is_finite(value: str) -> str:
    return f"(NOT isnan({value}) AND abs({value}) < double('Infinity'))"


def coarse_part(value: str) -> str:
    """``value`` in whole steps of 1/2**20, as a bigint whose sums are exact."""
    return f"CAST(floor({value} * {FRACTION_STEPS}D) AS BIGINT)"


def fine_part(value: str) -> str:
    """What :func:`coarse_part` left over, in [0, 1/2**20)."""
    return f"({value} - {coarse_part(value)} / {FRACTION_STEPS}D)"


def join_parts(coarse: str, fine: str) -> str:
    return f"({coarse} / {FRACTION_STEPS}D + {fine})"


def speed_mph(miles: str, seconds: str) -> str:
    return f"({miles} / ({seconds} / 3600D))"


def mae_improvement_pct(candidate: str, reference: str) -> str:
    """Relative MAE gain in percent; a perfect reference can only be equalled."""
    return (
        f"CASE WHEN {reference} = 0 THEN CASE WHEN {candidate} = 0 THEN 0D ELSE -100D END "
        f"ELSE ({reference} - {candidate}) / {reference} * 100 END"
    )


def relative_close(left: str, right: str, tolerance: float) -> str:
    return f"(abs({left} - {right}) <= {tolerance!r}D * greatest(abs({left}), abs({right})))"


def bucket_name(lower: float, upper: float) -> str:
    return "[" + ",".join(f"{edge:g}" for edge in (lower, upper)) + ")"


def bucket_label(value: str, edges: list[float]) -> str:
    """``[a,b)`` label of the half-open bucket that holds ``value``; NULL outside all."""
    cases = []
    for lower, upper in zip(edges, edges[1:]):
        # An infinite upper edge also keeps NaN out, which compares above it.
        limit = "double('Infinity')" if upper == float("inf") else f"{upper!r}D"
        cases.append(
            f"WHEN {value} >= {lower!r}D AND {value} < {limit} THEN '{bucket_name(lower, upper)}'"
        )
    return f"CASE {' '.join(cases)} END"
