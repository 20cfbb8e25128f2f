"""Rotations as column expressions. Quaternions are lists of four columns with the real part first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Quat = list[Column]


def unit(q: Quat) -> Quat:
    n = F.sqrt(sum((x * x for x in q), F.lit(0.0)))
    return [x / n for x in q]


def conjugate(q: Quat) -> Quat:
    return [q[0], -q[1], -q[2], -q[3]]


def multiply(a: Quat, b: Quat) -> Quat:
    aw, ax, ay, az = a
    bw, bx, by, bz = b
    return [
        aw * bw - ax * bx - ay * by - az * bz,
        aw * bx + ax * bw + ay * bz - az * by,
        aw * by - ax * bz + ay * bw + az * bx,
        aw * bz + ax * by - ay * bx + az * bw,
    ]


def positive(q: Quat) -> Quat:
    """The same rotation with a real part that isn't negative."""
    return [F.when(q[0] < 0, -x).otherwise(x) for x in q]


def matrix(q: Quat) -> list[list[Column]]:
    """Rotation matrix of a quaternion of any length but zero."""
    w, x, y, z = q
    s = F.lit(2.0) / sum((v * v for v in q), F.lit(0.0))
    return [
        [1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w)],
        [s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w)],
        [s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y)],
    ]


def rotate(q: Quat, v: list[Column]) -> list[Column]:
    m = matrix(q)
    return [m[i][0] * v[0] + m[i][1] * v[1] + m[i][2] * v[2] for i in range(3)]


def six(q: Quat) -> list[Column]:
    """The first two rows of the matrix."""
    m = matrix(q)
    return [*m[0], *m[1]]


def from_six(d: list[Column]) -> list[list[Column]]:
    """Matrix of six numbers by Gram-Schmidt."""
    n = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    a = [x / n for x in d[:3]]
    dot = a[0] * d[3] + a[1] * d[4] + a[2] * d[5]
    b = [d[3 + i] - dot * a[i] for i in range(3)]
    m = F.sqrt(b[0] * b[0] + b[1] * b[1] + b[2] * b[2])
    b = [x / m for x in b]
    c = [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]
    return [a, b, c]


def axis_angle(q: Quat) -> list[Column]:
    """Axis times angle; zero where there is no rotation."""
    w = F.least(F.greatest(q[0], F.lit(-1.0)), F.lit(1.0))
    den = F.sqrt(1 - w * w)
    k = F.when(den < 1e-12, F.lit(0.0)).otherwise(2 * F.acos(w) / den)
    return [x * k for x in q[1:]]


def euler_matrix(roll: Column, pitch: Column, yaw: Column) -> list[list[Column]]:
    """Rotation about x, then y, then z."""
    cr, sr, cp, sp, cy, sy = F.cos(roll), F.sin(roll), F.cos(pitch), F.sin(pitch), F.cos(yaw), F.sin(yaw)
    return [
        [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr],
        [sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr],
        [-sp, cp * sr, cp * cr],
    ]


def euler_of(m: list[list[Column]]) -> list[Column]:
    """Roll, pitch and yaw of a matrix."""
    return [F.atan2(m[2][1], m[2][2]), F.asin(F.least(F.greatest(-m[2][0], F.lit(-1.0)), F.lit(1.0))), F.atan2(m[1][0], m[0][0])]
