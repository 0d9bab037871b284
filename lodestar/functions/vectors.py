"""Dense-vector column functions (F12-F15) as higher-order SQL functions.

Vectors are ``array<double>`` columns; the arithmetic is a fold over
``zip_with`` so it runs in the JVM, element by element, in index order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_doubles(col: Column | str) -> Column:
    """Cast an ``array<float|int>`` to ``array<double>``."""
    return _c(col).cast("array<double>")


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def l2_squared(a: Column | str, b: Column | str) -> Column:
    """squared Euclidean distance (no square root)."""
    return _fold(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)))


def l1_distance(a: Column | str, b: Column | str) -> Column:
    """Manhattan distance."""
    return _fold(F.zip_with(_c(a), _c(b), lambda x, y: F.abs(x - y)))


def dot(a: Column | str, b: Column | str) -> Column:
    """dot product."""
    return _fold(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def squared_norm(a: Column | str) -> Column:
    """squared L2 norm of one vector."""
    return _fold(F.transform(_c(a), lambda x: x * x))


def scale(a: Column | str, k: Column | float) -> Column:
    """Multiply every element by a scalar."""
    k = k if isinstance(k, Column) else F.lit(float(k))
    return F.transform(_c(a), lambda x: x * k)


def literal_vector(values) -> Column:
    """A bounded model vector (centroid, weights) as one array literal."""
    return F.lit([float(v) for v in values])


DISTANCES = {"l2": l2_squared, "l1": l1_distance}


def distance(name: str):
    """Choose the distance by name; unknown names are rejected."""
    try:
        return DISTANCES[name.lower()]
    except KeyError:
        raise ValueError(f"unknown distance {name!r}; use one of {sorted(DISTANCES)}")


# Higher-order functions (transform / zip_with / aggregate) are evaluated
# row by row without code generation.  When one side is a model of known,
# modest width, the arithmetic is written out term by term instead, which
# whole-stage code generation compiles; above UNROLL_MAX terms the
# higher-order form is kept so plans stay small.
UNROLL_MAX = 8192


def _terms(col: Column | str, values, term) -> Column:
    c = _c(col)
    acc = F.lit(0.0)
    for d, v in enumerate(values):
        acc = acc + term(c[d], F.lit(float(v)))
    return acc


def dot_const(col: Column | str, values) -> Column:
    """Dot product with a constant vector (model weights)."""
    if len(values) > UNROLL_MAX:
        return dot(col, literal_vector(values))
    return _terms(col, values, lambda x, v: x * v)


def distance_const(name: str, col: Column | str, center) -> Column:
    """``l2`` (squared) or ``l1`` distance to a constant vector (a centroid)."""
    distance(name)                                  # validates the name (X8)
    if len(center) > UNROLL_MAX:
        return distance(name)(col, literal_vector(center))
    if name.lower() == "l2":
        return _terms(col, center, lambda x, v: (x - v) * (x - v))
    return _terms(col, center, lambda x, v: F.abs(x - v))


def dot_width(a: Column | str, b: Column | str, width: int) -> Column:
    """Dot product of two vector columns of known width."""
    if width > UNROLL_MAX:
        return dot(a, b)
    x, y = _c(a), _c(b)
    acc = F.lit(0.0)
    for d in range(width):
        acc = acc + x[d] * y[d]
    return acc


def significant(col: Column | str, digits: int) -> Column:
    """``col`` rounded to ``digits`` significant digits, whatever its size."""
    x = F.col(col) if isinstance(col, str) else col
    scale = F.pow(F.lit(10.0), F.lit(digits - 1.0) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, x).otherwise(F.round(x * scale) / scale)
