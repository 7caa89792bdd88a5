"""Arrays as vectors: products, levels, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = 0.0


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision; the cosine of unit vectors."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(ZERO), lambda s, x: s + x)


def level_db(samples: Column) -> Column:
    """Root mean square level in decibels."""
    mean = F.aggregate(samples, F.lit(ZERO), lambda s, x: s + x * x) / F.size(samples)
    return 10 * F.log10(mean + F.lit(1e-10))


def shared_prefix(a: Column, b: Column) -> Column:
    """Elements at the start that two arrays have in common."""
    n = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), n - 1), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))
    return F.when(n == 0, 0).otherwise(F.coalesce(F.try_element_at(differ, F.lit(1)), n))


def prefix_labels(ids: Column, prefix: Column, longest: int, ignore: int = -100) -> Column:
    """Training labels: the prefix is masked; null if the example is too long."""
    labels = F.concat(F.array_repeat(F.lit(ignore), prefix), F.slice(ids, prefix + 1, F.greatest(F.size(ids) - prefix, F.lit(0))))
    return F.when(F.size(ids) <= longest, labels)


def padded(values: Column, width: Column, fill: int) -> Column:
    return F.concat(values, F.array_repeat(F.lit(fill), width - F.size(values)))


def path_length(points: Column) -> Column:
    """Length of a path of ``x``, ``y`` points."""
    n = F.size(points)
    steps = F.zip_with(F.slice(points, 1, F.greatest(n - 1, F.lit(0))), F.slice(points, 2, F.greatest(n - 1, F.lit(0))), lambda p, q: F.sqrt(F.pow(p["x"] - q["x"], 2) + F.pow(p["y"] - q["y"], 2)))
    return F.aggregate(steps, F.lit(ZERO), lambda s, x: s + x)


def normalised_path(points: Column) -> Column:
    """Points moved to the middle of their box and scaled by its longer side."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    side = F.greatest(F.array_max(xs) - F.array_min(xs), F.array_max(ys) - F.array_min(ys), F.lit(1e-5))
    cx, cy = (F.array_max(xs) + F.array_min(xs)) / 2, (F.array_max(ys) + F.array_min(ys)) / 2
    return F.transform(points, lambda p: F.struct(((p["x"] - cx) / side).alias("x"), ((p["y"] - cy) / side).alias("y")))


def path_distance(a: Column, b: Column, norm: int) -> Column:
    """Mean distance of two paths point by point: by axes (1) or straight (2)."""
    each = (lambda p, q: F.abs(p["x"] - q["x"]) + F.abs(p["y"] - q["y"])) if norm == 1 else (lambda p, q: F.sqrt(F.pow(p["x"] - q["x"], 2) + F.pow(p["y"] - q["y"], 2)))
    return F.aggregate(F.zip_with(a, b, each), F.lit(ZERO), lambda s, x: s + x) / F.size(a)


def gaussian(value: Column, mean: float, deviation: float) -> Column:
    return F.exp(-F.pow((value - mean) / deviation, 2) / 2) / (deviation * F.sqrt(2 * F.pi()))
