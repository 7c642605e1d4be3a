"""Box and geographic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from camstat.functions.ids import ColLike, _c

EARTH_RADIUS_KM = 6371.0


def pct_to_pixels(v: ColLike, size: ColLike) -> Column:
    """a percent-of-image coordinate to pixels."""
    return _c(v) * _c(size) / F.lit(100.0)


def box_area(w: ColLike, h: ColLike) -> Column:
    """F21."""
    return _c(w) * _c(h)


def iou(ax: ColLike, ay: ColLike, aw: ColLike, ah: ColLike,
        bx: ColLike, by: ColLike, bw: ColLike, bh: ColLike) -> Column:
    """intersection over union of two ``(x, y, w, h)`` boxes."""
    ax, ay, aw, ah, bx, by, bw, bh = map(_c, (ax, ay, aw, ah, bx, by, bw, bh))
    iw = F.greatest(F.lit(0.0), F.least(ax + aw, bx + bw) - F.greatest(ax, bx))
    ih = F.greatest(F.lit(0.0), F.least(ay + ah, by + bh) - F.greatest(ay, by))
    inter = iw * ih
    union = aw * ah + bw * bh - inter
    return F.when(union > 0, inter / union).otherwise(F.lit(0.0))


def haversine_km(lon1: ColLike, lat1: ColLike, lon2: ColLike, lat2: ColLike,
                 radius: float = EARTH_RADIUS_KM) -> Column:
    """great-circle distance in km."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dp = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * radius) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))
