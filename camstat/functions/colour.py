"""Colour expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from camstat.functions.ids import ColLike, _c


def hue_degrees(r: ColLike, g: ColLike, b: ColLike) -> Column:
    """HSV hue in degrees [0, 360) from RGB; grey pixels give 0."""
    r, g, b = _c(r).cast("double"), _c(g).cast("double"), _c(b).cast("double")
    mx = F.greatest(r, g, b)
    mn = F.least(r, g, b)
    d = mx - mn
    h = (F.when(d == 0, F.lit(0.0))
         .when(mx == r, F.pmod((g - b) / d, F.lit(6.0)))
         .when(mx == g, (b - r) / d + 2)
         .otherwise((r - g) / d + 4))
    return h * 60.0
