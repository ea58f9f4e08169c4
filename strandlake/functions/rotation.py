"""Quaternions (x, y, z, w), rotation vectors and matrices as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vector as V


def _parts(a: Column, n: int) -> list[Column]:
    return [F.get(a, F.lit(i)) for i in range(n)]


def normalised(q: Column) -> Column:
    n = V.norm(q)
    return F.transform(q, lambda x: x / n)


def axis_angle(q: Column) -> Column:
    """Rotation vector of a unit quaternion: w is clamped, a null rotation gives zeros."""
    x, y, z, w = _parts(q, 4)
    w = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), w))
    den = F.sqrt(F.greatest(F.lit(0.0), 1 - w * w))
    k = F.when(den <= 1e-10, F.lit(0.0)).otherwise(2 * F.acos(w) / F.when(den <= 1e-10, F.lit(1.0)).otherwise(den))
    return F.array(x * k, y * k, z * k)


def from_rotation_vector(v: Column) -> Column:
    angle = V.norm(v)
    k = F.when(angle < 1e-12, F.lit(0.5)).otherwise(F.sin(angle / 2) / F.when(angle < 1e-12, F.lit(1.0)).otherwise(angle))
    return F.concat(F.transform(v, lambda x: x * k), F.array(F.cos(angle / 2)))


def to_matrix(q: Column) -> Column:
    """Nine elements, row after row."""
    x, y, z, w = _parts(q, 4)
    return F.array(
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    )


def from_matrix(m: Column) -> Column:
    """Unit quaternion with w >= 0 of a rotation matrix; signs come from its skew part."""
    a = _parts(m, 9)
    half = lambda e: F.sqrt(F.greatest(F.lit(0.0), e)) / 2
    signed = lambda size, d: F.when(d < 0, -size).otherwise(size)
    return F.array(signed(half(1 + a[0] - a[4] - a[8]), a[7] - a[5]), signed(half(1 - a[0] + a[4] - a[8]), a[2] - a[6]), signed(half(1 - a[0] - a[4] + a[8]), a[3] - a[1]), half(1 + a[0] + a[4] + a[8]))


def inverse(q: Column) -> Column:
    x, y, z, w = _parts(q, 4)
    return F.array(-x, -y, -z, w)


def compose(p: Column, q: Column) -> Column:
    """First q, then p."""
    a, b, c, d = _parts(p, 4)
    x, y, z, w = _parts(q, 4)
    return F.array(d * x + a * w + b * z - c * y, d * y - a * z + b * w + c * x, d * z + a * y - b * x + c * w, d * w - a * x - b * y - c * z)


def apply(q: Column, v: Column) -> Column:
    m, (x, y, z) = _parts(to_matrix(q), 9), _parts(v, 3)
    return F.array(*(m[3 * i] * x + m[3 * i + 1] * y + m[3 * i + 2] * z for i in range(3)))


def pose_state(position: Column, q: Column, gripper: Column) -> Column:
    return F.concat(position, axis_angle(q), gripper)
