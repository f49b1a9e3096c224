"""Scalar column functions (F1-F10).  All return Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["ipv4_to_long", "long_to_ipv4", "sq_distance", "euclidean", "dot",
           "clip", "logistic", "grid_corner", "cell_index", "rect_contains",
           "rect_almost_contains", "rect_shrink", "recode_pm1", "invalid_label",
           "parse_fields", "col_of"]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1 --------------------------------------------------------------------------
def ipv4_to_long(c) -> Column:
    """Dotted IPv4 text -> big-endian 32-bit value; anything but 4 octets raises."""
    parts = F.split(F.trim(col_of(c)), r"\.")
    octs = [F.expr(f"try_cast(element_at(split(trim({_sql(c)}), '[.]'), {i}) as bigint)") for i in range(1, 5)]
    ok = (F.size(parts) == 4)
    for o in octs:
        ok = ok & o.isNotNull() & (o >= 0) & (o <= 255)
    value = (octs[0] * 16777216 + octs[1] * 65536 + octs[2] * 256 + octs[3])
    return F.when(col_of(c).isNull(), F.lit(None).cast("bigint")) \
            .when(ok, value) \
            .otherwise(F.raise_error(F.concat(F.lit("not an IPv4 address: "), col_of(c).cast("string"))).cast("bigint"))


def _sql(c) -> str:
    if isinstance(c, str):
        return f"`{c}`"
    raise TypeError("ipv4_to_long needs a column name")


# F2 --------------------------------------------------------------------------
def long_to_ipv4(c) -> Column:
    """Low 32 bits of a long as dotted IPv4 text."""
    v = col_of(c).cast("bigint")
    octets = [F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


# F3 / F4 ---------------------------------------------------------------------
def sq_distance(a, b) -> Column:
    """Squared Euclidean distance of two equal-length double arrays."""
    diffs = F.zip_with(col_of(a), col_of(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, v: acc + v)


def euclidean(a, b) -> Column:
    return F.sqrt(sq_distance(a, b))


def dot(a, b) -> Column:
    prods = F.zip_with(col_of(a), col_of(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, v: acc + v)


# F5 --------------------------------------------------------------------------
def clip(c, lo, hi) -> Column:
    return F.least(F.greatest(col_of(c), F.lit(lo)), F.lit(hi))


def logistic(c) -> Column:
    return 1.0 / (1.0 + F.exp(-col_of(c)))


# F6 --------------------------------------------------------------------------
def cell_index(c, size: float) -> Column:
    """Integer cell of a coordinate on a grid of side ``size`` (floor)."""
    return F.floor(col_of(c) / F.lit(size)).cast("bigint")


def grid_corner(c, size: float) -> Column:
    """Lower corner of the grid cell holding the coordinate.

    Uses floor, so an exact negative multiple of ``size`` is its own corner
    (the reference's shift-then-truncate puts it one cell lower).
    """
    return cell_index(c, size) * F.lit(size)


# F7 --------------------------------------------------------------------------
def rect_contains(x, y, x1, y1, x2, y2) -> Column:
    """Closed-bounds containment of point (x, y) in [x1,x2] x [y1,y2]."""
    x, y, x1, y1, x2, y2 = map(col_of, (x, y, x1, y1, x2, y2))
    return (x >= x1) & (x <= x2) & (y >= y1) & (y <= y2)


def rect_almost_contains(x, y, x1, y1, x2, y2) -> Column:
    """Open-bounds containment (strictly inside)."""
    x, y, x1, y1, x2, y2 = map(col_of, (x, y, x1, y1, x2, y2))
    return (x > x1) & (x < x2) & (y > y1) & (y < y2)


def rect_shrink(x1, y1, x2, y2, amount: float):
    """Rectangle moved inwards by ``amount`` on all sides (negative grows it)."""
    a = F.lit(amount)
    return (col_of(x1) + a, col_of(y1) + a, col_of(x2) - a, col_of(y2) - a)


# F8 / F9 ---------------------------------------------------------------------
def recode_pm1(c) -> Column:
    """label > 0 -> 1.0, otherwise -1.0 (classification recoding for FM)."""
    return F.when(col_of(c) > 0, 1.0).otherwise(-1.0)


def invalid_label(c) -> Column:
    """True when a label is fractional or negative (not a class index)."""
    v = col_of(c).cast("double")
    return (v != F.floor(v)) | (v < 0)


# F10 -------------------------------------------------------------------------
def parse_fields(line, sep: str = ",") -> Column:
    """Split a delimited line and trim each field."""
    return F.transform(F.split(col_of(line), sep), lambda s: F.trim(s))
