"""Range values and relations (int4/int8/num/date/ts/tstz ranges).

A range is ``struct<lower, upper, lower_inc, upper_inc>``; a NULL bound is
unbounded.  Integer and date ranges are normalised to ``[lo, hi)`` first, as
discrete ranges are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# element type per range type (fixed values)
RANGE_ELEMENT_TYPES = {
    "int4range": "int",
    "int8range": "bigint",
    "numrange": "decimal(38,9)",
    "daterange": "date",
    "tsrange": "timestamp_ntz",
    "tstzrange": "timestamp",
}
DISCRETE = {"int4range", "int8range", "daterange"}

_RANGE_TEXT = r"^\s*([\[(])\s*([^,]*?)\s*,\s*([^\])]*?)\s*([\])])\s*$"


def make_range(lower, upper, lower_inc=True, upper_inc=False) -> Column:
    lo = lower if isinstance(lower, Column) else F.lit(lower)
    hi = upper if isinstance(upper, Column) else F.lit(upper)
    li = lower_inc if isinstance(lower_inc, Column) else F.lit(lower_inc)
    ui = upper_inc if isinstance(upper_inc, Column) else F.lit(upper_inc)
    return F.struct(lo.alias("lower"), hi.alias("upper"), li.alias("lower_inc"), ui.alias("upper_inc"))


def parse_range(text: Column, range_type: str = "int4range") -> Column:
    """Range text such as ``(10, 12]`` or ``[5,)`` → normalised range struct.

    Quotes around bounds are dropped, ``empty`` is NULL (it holds nothing), and
    text that is no range raises.
    """
    et = RANGE_ELEMENT_TYPES[range_type]
    text = F.trim(F.replace(text, F.lit('"'), F.lit("")))
    text = F.when(F.lower(text) == "empty", F.lit(None).cast("string")).when(
        ~text.rlike(_RANGE_TEXT), F.raise_error(F.concat(F.lit("not a range: "), text))).otherwise(text)
    lo = F.regexp_extract(text, _RANGE_TEXT, 2)
    hi = F.regexp_extract(text, _RANGE_TEXT, 3)
    r = make_range(F.when(lo != "", lo).cast(et), F.when(hi != "", hi).cast(et),
                   F.regexp_extract(text, _RANGE_TEXT, 1) == "[", F.regexp_extract(text, _RANGE_TEXT, 4) == "]")
    return normalize(r, range_type)


def normalize(r: Column, range_type: str) -> Column:
    if range_type not in DISCRETE:
        return r
    step = (lambda c: F.date_add(c, 1)) if range_type == "daterange" else (lambda c: c + 1)
    lo = F.when(r["lower"].isNotNull() & ~r["lower_inc"], step(r["lower"])).otherwise(r["lower"])
    hi = F.when(r["upper"].isNotNull() & r["upper_inc"], step(r["upper"])).otherwise(r["upper"])
    return make_range(lo, hi, r["lower"].isNotNull() | F.lit(True), F.lit(False))


def _above_lower(r: Column, v: Column) -> Column:
    return r["lower"].isNull() | F.when(r["lower_inc"], v >= r["lower"]).otherwise(v > r["lower"])


def _below_upper(r: Column, v: Column) -> Column:
    return r["upper"].isNull() | F.when(r["upper_inc"], v <= r["upper"]).otherwise(v < r["upper"])


def contains_value(r: Column, v: Column) -> Column:
    """The range holds the value (NULL value or range → false)."""
    return F.coalesce(r.isNotNull() & v.isNotNull() & _above_lower(r, v) & _below_upper(r, v), F.lit(False))


def _lower_le(a: Column, b: Column) -> Column:
    """lower bound of a starts at or before lower bound of b."""
    return (a["lower"].isNull() | (b["lower"].isNotNull() & (
        (a["lower"] < b["lower"]) | ((a["lower"] == b["lower"]) & (a["lower_inc"] | ~b["lower_inc"])))))


def _upper_ge(a: Column, b: Column) -> Column:
    """upper bound of a ends at or after upper bound of b."""
    return (a["upper"].isNull() | (b["upper"].isNotNull() & (
        (a["upper"] > b["upper"]) | ((a["upper"] == b["upper"]) & (a["upper_inc"] | ~b["upper_inc"])))))


def _starts_before_end(a: Column, b: Column) -> Column:
    """a's lower bound lies before b's upper bound (they can share a point)."""
    return (a["lower"].isNull() | b["upper"].isNull() | (a["lower"] < b["upper"]) |
            ((a["lower"] == b["upper"]) & a["lower_inc"] & b["upper_inc"]))


def is_empty(r: Column) -> Column:
    """The range holds no value."""
    return (r["lower"].isNotNull() & r["upper"].isNotNull() &
            ((r["lower"] > r["upper"]) | ((r["lower"] == r["upper"]) & ~(r["lower_inc"] & r["upper_inc"]))))


def intersects(a: Column, b: Column) -> Column:
    return F.coalesce(a.isNotNull() & b.isNotNull() & ~is_empty(a) & ~is_empty(b) &
                      _starts_before_end(a, b) & _starts_before_end(b, a), F.lit(False))


def contains(a: Column, b: Column) -> Column:
    """a contains all of b."""
    return F.coalesce(a.isNotNull() & b.isNotNull() & (is_empty(b) | (_lower_le(a, b) & _upper_ge(a, b))), F.lit(False))


def within(a: Column, b: Column) -> Column:
    """a lies inside b."""
    return contains(b, a)


RELATIONS = {"Intersects": intersects, "Contains": contains, "Within": within}


def range_term(r: Column, value: Column, relation: str | None = None) -> Column:
    """``rangeTerm``: with no relation the value is an element, else a range."""
    if relation is None:
        return contains_value(r, value)
    return RELATIONS[relation](r, value)
