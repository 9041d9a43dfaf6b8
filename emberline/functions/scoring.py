"""Site scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A median ratio below this is likely glint; a cell is clear up to this cloud fraction.
GLINT_RATIO, CLEAR_MAX = 1.25, 0.10


def glint_angle(sun_elevation: Column) -> Column:
    return F.lit(90.0) - sun_elevation


def glint_score(sun_elevation: Column) -> Column:
    """1 at an angle of up to 25 degrees, 0 from 65 on, linear between; null stays null."""
    angle = glint_angle(F.when(~F.isnan(sun_elevation), sun_elevation))
    return F.when(angle <= 25, 1.0).when(angle >= 65, 0.0).when(angle.isNotNull(), (65.0 - angle) / 40.0)


def _clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def ratio_score(ratio: Column) -> Column:
    return F.when(ratio.isNull() | F.isnan(ratio), 0.0).otherwise(_clamp((ratio - 1.1) / 0.6))


def persistence_score(n_dates: Column, n_observed: Column) -> Column:
    return F.when(n_observed > 0, F.least(F.lit(1.0), n_dates / n_observed)).otherwise(0.0)


def glint_penalty(min_glint: Column) -> Column:
    """-0.4 times the glint; 0 without any."""
    return F.when(min_glint > 0, _clamp(min_glint) * -0.4).otherwise(0.0)


def total_score(ratio: Column, persistence: Column, penalty: Column) -> Column:
    return 0.5 * ratio + 0.4 * persistence * (0.1 + 0.9 * ratio) + penalty


def glint_suspect(min_glint: Column, max_ratio: Column, n_dates: Column) -> Column:
    """Glint that one look can't tell from a flare."""
    return F.coalesce((min_glint >= 0.6) & (max_ratio < 1.3) & (n_dates <= 1), F.lit(False))


def finite(x: Column) -> Column:
    """``x``, or null if it isn't a number or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def peak_ratio(stored: Column, max_b12: Column, peak_b11: Column) -> Column:
    """The stored ratio if finite, else max_b12 / peak_b11 for a positive peak."""
    return F.coalesce(finite(stored), finite(F.when(peak_b11 > 0, max_b12 / peak_b11)))


def in_season(date: Column) -> Column:
    """Whether a date lies in April to August; what isn't a month counts as January."""
    return F.coalesce(F.substring(date, 6, 2).try_cast("int"), F.lit(1)).between(4, 8)


def scores(ratio: Column, n_dates: Column, n_observed: Column, min_glint: Column) -> dict[str, Column]:
    r, p, g = ratio_score(ratio), persistence_score(n_dates, n_observed), glint_penalty(min_glint)
    return {"ratio_score": r, "persistence_score": p, "glint_penalty": g, "total_score": total_score(r, p, g)}
