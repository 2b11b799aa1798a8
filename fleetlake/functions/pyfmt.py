"""Render numbers the way the reference's error messages print them.

The reference formats values with Python's ``repr``: integers plainly,
floats in the shortest round-trip form, plain notation for decimal
exponents -4..15 and ``1e+16`` / ``1.5e-05`` style outside it.  Spark's
``cast(double as string)`` uses Java's form (``1.0E7``).  These helpers
convert with column expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def py_float_repr(x: Column) -> Column:
    s = x.cast("string")
    has_exp = F.instr(s, "E") > 0
    mant = F.substring_index(s, "E", 1)
    exp = F.substring_index(s, "E", -1).try_cast("int")
    mant_short = F.regexp_replace(mant, r"\.0$", "")
    sci = F.concat(
        mant_short,
        F.lit("e"),
        F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad(F.abs(exp).cast("string"), 2, "0"),
    )
    plain_dec = F.regexp_replace(s.try_cast("decimal(38,20)").cast("string"), r"0+$", "")
    plain = F.when(plain_dec.endswith("."), F.concat(plain_dec, F.lit("0"))).otherwise(plain_dec)
    return (
        F.when(x.isNull(), F.lit(None))
        .when(F.isnan(x), F.lit("nan"))
        .when(x == float("inf"), F.lit("inf"))
        .when(x == float("-inf"), F.lit("-inf"))
        .when(~has_exp, s)
        .when((exp >= -4) & (exp < 16), plain)
        .otherwise(sci)
    )


def py_number_repr(raw: Column, value: Column) -> Column:
    """``raw`` is the JSON text of the number; integers print as written."""
    return F.when(raw.rlike(r"^-?[0-9]+$"), raw).otherwise(py_float_repr(value))
