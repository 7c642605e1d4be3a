"""Array statistics expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from camstat.functions.ids import ColLike, _c


def softmax(arr: ColLike) -> Column:
    """numerically stable softmax of an array of scores."""
    a = _c(arr)
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(arr: ColLike) -> Column:
    """0-based position of the largest value; ties go to the first position."""
    a = _c(arr)
    best = F.array_max(F.transform(a, lambda x, i: F.struct(x.alias("v"), (-i).alias("p"))))
    return -best["p"]
