"""Directions, vectors and phases.  Angles are compass degrees unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def signed_angle(model: Column, obs: Column) -> Column:
    """Smallest turn from ``obs`` to ``model`` in (-180, 180]; a half turn is +180."""
    raw = model - obs
    size = F.abs(raw) % 360
    size = F.least(size, 360 - size)
    clockwise = raw.between(0, 180) | raw.between(-360, -180)
    return F.when(clockwise, size).otherwise(-size)


def east(speed: Column, direction: Column) -> Column:
    return speed * F.sin(F.radians(direction))


def north(speed: Column, direction: Column) -> Column:
    return speed * F.cos(F.radians(direction))


def speed_of(u: Column, v: Column) -> Column:
    return F.hypot(u, v)


def direction_of(u: Column, v: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(u, v)), F.lit(360.0))


def rotate_east(u: Column, v: Column, angle_rad: Column) -> Column:
    return u * F.cos(angle_rad) - v * F.sin(angle_rad)


def rotate_north(u: Column, v: Column, angle_rad: Column) -> Column:
    return u * F.sin(angle_rad) + v * F.cos(angle_rad)


def vector_gap(u1: Column, v1: Column, u2: Column, v2: Column) -> Column:
    """Length of the difference between two (u, v) vectors."""
    return F.hypot(u1 - u2, v1 - v2)


def phase_gap(model: Column, reference: Column) -> Column:
    """Phase difference folded into [-180, 180)."""
    return F.pmod(model - reference + 180, F.lit(360.0)) - 180


def phasor_gap(amp_m: Column, phase_m: Column, amp_r: Column, phase_r: Column) -> Column:
    """Distance between two amplitude/phase phasors (law of cosines)."""
    gap2 = (
        amp_m * amp_m
        + amp_r * amp_r
        - 2 * amp_m * amp_r * F.cos(F.radians(phase_gap(phase_m, phase_r)))
    )
    return F.sqrt(F.when(gap2 < 0, 0.0).otherwise(gap2))


def mean_angle(angle: Column) -> Column:
    """Aggregate: circular mean in [-180, 180]; NULL when the resultant vanishes."""
    return angle_of_sums(F.avg(F.sin(F.radians(angle))), F.avg(F.cos(F.radians(angle))))


def angle_of_sums(s: Column, c: Column) -> Column:
    """Direction of a resultant from its sine and cosine sums; NULL when it vanishes."""
    return F.when((s != 0) | (c != 0), F.degrees(F.atan2(s, c)))


def compass_sector(direction: Column, sectors: int = 16) -> Column:
    """Sector number 1..n, right-closed edges; sector 1 is north and wraps.

    Zero lies outside every right-closed bin and gives NULL.
    """
    width = 360.0 / sectors
    wrapped = F.ceil((direction - width / 2) / width) % sectors + 1
    return F.when((direction > 0) & (direction <= 360), wrapped.cast("int"))
