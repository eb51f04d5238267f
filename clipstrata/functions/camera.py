"""Cameras as column expressions: intrinsics, rotations, poses. Matrices are arrays of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fov_x(fx: Column) -> Column:
    """Horizontal field of view in degrees from a focal length in image widths; null unless it is positive."""
    return F.when((fx > 0) & ~F.isnan(fx), F.degrees(2 * F.atan(1 / (2 * fx))))


def of_fov(width: Column, height: Column, fov: Column) -> Column:
    """3 x 3 intrinsics of an image size and a horizontal field of view in degrees."""
    focal = width / 2 / F.tan(F.radians(fov) / 2)
    return matrix(focal, focal, width / 2, height / 2)


def matrix(fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    zero, d = F.lit(0.0), lambda x: x.cast("double")
    return F.array(F.array(d(fx), zero, d(cx)), F.array(zero, d(fy), d(cy)), F.array(zero, zero, F.lit(1.0)))


# Camera models with one focal length for both axes, and with two.
ONE_FOCAL = ("SIMPLE_PINHOLE", "SIMPLE_RADIAL", "SIMPLE_RADIAL_FISHEYE", "RADIAL", "RADIAL_FISHEYE")
TWO_FOCALS = ("PINHOLE", "OPENCV", "OPENCV_FISHEYE", "FULL_OPENCV", "FOV", "THIN_PRISM_FISHEYE")


def intrinsics(model: Column, params: Column) -> Column:
    """3 x 3 intrinsics of a camera model; distortion is dropped, a model in neither list is refused."""
    p = lambda k: F.get(params, F.lit(k)).cast("double")
    refused = F.raise_error(F.concat(F.lit("unsupported camera model: "), F.coalesce(model, F.lit("-")))).cast("array<array<double>>")
    return F.when(model.isin(*ONE_FOCAL), matrix(p(0), p(0), p(1), p(2))).when(model.isin(*TWO_FOCALS), matrix(p(0), p(1), p(2), p(3))).otherwise(refused)


def rotation(w: Column, x: Column, y: Column, z: Column) -> Column:
    """The rotation of a quaternion, brought to length one; length zero is refused, null stays null."""
    n = F.sqrt(w * w + x * x + y * y + z * z)
    a, b, c, d = (F.try_divide(v, n) for v in (w, x, y, z))
    rows = (
        (1 - 2 * (c * c + d * d), 2 * (b * c - a * d), 2 * (b * d + a * c)),
        (2 * (b * c + a * d), 1 - 2 * (b * b + d * d), 2 * (c * d - a * b)),
        (2 * (b * d - a * c), 2 * (c * d + a * b), 1 - 2 * (b * b + c * c)),
    )
    refused = F.raise_error(F.lit("a quaternion of length zero")).cast("array<array<double>>")
    return F.when(n > 0, F.array(*[F.array(*r) for r in rows])).when(n == 0, refused)


def to_camera(pose: Column) -> Column:
    """4 x 4 world-to-camera matrix of a camera-to-world pose: rotation transposed, translation turned back."""
    at = lambda i, j: pose[i][j]
    rows = [F.array(*[at(j, i) for j in range(3)], -(at(0, i) * at(0, 3) + at(1, i) * at(1, 3) + at(2, i) * at(2, 3))) for i in range(3)]
    return F.array(*rows, F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)]))


def relative(one: Column, other: Column) -> Column:
    """4 x 4 matrix that takes a point in the first camera to the second, of camera-to-world poses."""
    # the inverse is worked out once, as the one element of an array
    product = lambda back: F.array(*[F.array(*[sum((back[i][k] * one[k][j] for k in range(1, 4)), back[i][0] * one[0][j]) for j in range(4)]) for i in range(4)])
    return F.transform(F.array(to_camera(other)), product)[0]


def centre(rot: Column, t: Column) -> Column:
    """The camera's place in the world, -(R transposed) t, of a world-to-camera pose."""
    at = lambda i: -(rot[0][i] * t[0] + rot[1][i] * t[1] + rot[2][i] * t[2])
    return F.array(at(0), at(1), at(2))
