"""Rounding of the exact binary value, half to even, as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double into two halves of 26 bits whose products are exact.
_SPLIT = 134217729.0


def _halves(x: float) -> tuple[float, float]:
    high = _SPLIT * x - (_SPLIT * x - x)
    return high, x - high


def rounded(x: Column, digits: int) -> Column:
    """The double nearest to x rounded to `digits` decimals (0 to 22), where x stands for the exact value of its bits; a value half way between two goes to the even one.

    x * 10^digits is taken as a rounded product and its error, both doubles, without loss: only where the product seems to lie half way, the
    error tells on which side the value is. What is too large to have such decimals stays as it is, as do NaN, infinities and null.
    """
    scale = 10.0**digits
    high, low = _halves(scale)

    def product(v: Column) -> Column:
        return F.struct(v.alias("v"), (v * _SPLIT - (v * _SPLIT - v)).alias("high"), (v * scale).alias("p"))

    def error(s: Column) -> Column:
        rest = s["v"] - s["high"]
        return F.struct(s["v"].alias("v"), s["p"].alias("p"), F.rint(s["p"]).alias("near"), (((s["high"] * high - s["p"]) + s["high"] * low + rest * high) + rest * low).alias("error"))

    def whole(s: Column) -> Column:
        rest = s["p"] - s["near"]
        out = F.when((rest == 0.5) & (s["error"] > 0), s["near"] + 1.0).when((rest == -0.5) & (s["error"] < 0), s["near"] - 1.0).otherwise(s["near"])
        return F.when(F.abs(s["p"]) < float(1 << 53), out / scale).otherwise(s["v"])

    # an array of one, so that each step names the one before as a variable instead of repeating it
    return F.get(F.transform(F.transform(F.transform(F.array(x), product), error), whole), F.lit(0))
