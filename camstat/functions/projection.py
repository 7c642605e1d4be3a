"""Map projections as column expressions: transverse Mercator (UTM) and Lambert's conformal conic, both ways.

Everything is closed-form arithmetic on columns (series of fixed length, no iteration over rows), so a
projected join or filter stays inside code generation.  Null coordinates stay null.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Ellipsoid(NamedTuple):
    """Half the major axis and the flattening."""

    a: float
    f: float


#: Ellipsoids of the common datums.
WGS84 = Ellipsoid(6378137.0, 1 / 298.257223563)
GRS80 = Ellipsoid(6378137.0, 1 / 298.257222101)
CLARKE_1866 = Ellipsoid(6378206.4, 1 / 294.978698214)


def _atanh(x: Column) -> Column:
    return 0.5 * F.log((1 + x) / (1 - x))


def _conformal(lat: Column, e: float) -> Column:
    """Sine of the latitude -> sinh of the isometric latitude."""
    s = F.sin(lat)
    return F.sinh(_atanh(s) - e * _atanh(e * s))


class TransverseMercator(NamedTuple):
    """Krueger's series of the sixth order in the third flattening: far below a millimetre within 30 degrees
    of the central meridian."""

    lon0: float
    lat0: float = 0.0
    k0: float = 0.9996
    east0: float = 500_000.0
    north0: float = 0.0
    ellipsoid: Ellipsoid = WGS84

    def _series(self) -> tuple[float, float, list[float], list[float]]:
        """(eccentricity, radius of the rectifying sphere, forward terms, inverse terms)."""
        f = self.ellipsoid.f
        n = f / (2 - f)
        radius = self.ellipsoid.a / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
        alpha = [
            n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
            13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
            61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
            49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
            34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
            212378941 * n**6 / 319334400]
        beta = [
            n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360 - 81 * n**5 / 512 + 96199 * n**6 / 604800,
            n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440 + 46 * n**5 / 105 - 1118711 * n**6 / 3870720,
            17 * n**3 / 480 - 37 * n**4 / 840 - 209 * n**5 / 4480 + 5569 * n**6 / 90720,
            4397 * n**4 / 161280 - 11 * n**5 / 504 - 830251 * n**6 / 7257600,
            4583 * n**5 / 161280 - 108847 * n**6 / 3991680,
            20648693 * n**6 / 638668800]
        return math.sqrt(f * (2 - f)), radius, alpha, beta

    def _origin(self) -> float:
        """Northing of the origin's latitude on the rectifying sphere."""
        e, _, alpha, _ = self._series()
        s = math.sin(math.radians(self.lat0))
        xi = math.atan(math.sinh(math.atanh(s) - e * math.atanh(e * s)))
        return xi + sum(c * math.sin(2 * (k + 1) * xi) for k, c in enumerate(alpha))

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """(easting, northing) in units of the ellipsoid's axis, from degrees."""
        e, radius, alpha, _ = self._series()
        t = _conformal(F.radians(lat), e)
        dl = F.radians(lon - self.lon0)
        xi = F.atan2(t, F.cos(dl))
        eta = F.asinh(F.sin(dl) / F.sqrt(t * t + F.cos(dl) * F.cos(dl)))
        x, y = eta, xi
        for k, c in enumerate(alpha, 1):
            x = x + c * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
            y = y + c * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        return self.east0 + self.k0 * radius * x, self.north0 + self.k0 * radius * (y - self._origin())

    def inverse(self, east: Column, north: Column) -> tuple[Column, Column]:
        """(longitude, latitude) in degrees."""
        e, radius, _, beta = self._series()
        eta, xi = (east - self.east0) / (self.k0 * radius), (north - self.north0) / (self.k0 * radius) + self._origin()
        x, y = eta, xi
        for k, c in enumerate(beta, 1):
            x = x - c * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
            y = y - c * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        chi = F.asin(F.sin(y) / F.cosh(x))
        lat = _geographic(chi, e)
        return F.degrees(F.atan2(F.sinh(x), F.cos(y))) + self.lon0, F.degrees(lat)


def _geographic(chi: Column, e: float) -> Column:
    """Conformal latitude -> geographic latitude: the series in the squared eccentricity, to its fifth power."""
    q = e * e
    terms = [
        q / 2 + 5 * q**2 / 24 + q**3 / 12 + 13 * q**4 / 360 + 3 * q**5 / 160,
        7 * q**2 / 48 + 29 * q**3 / 240 + 811 * q**4 / 11520 + 81 * q**5 / 2240,
        7 * q**3 / 120 + 81 * q**4 / 1120 + 3029 * q**5 / 53760,
        4279 * q**4 / 161280 + 883 * q**5 / 20160,
        2087 * q**5 / 161280]
    out = chi
    for k, c in enumerate(terms, 1):
        out = out + c * F.sin(2 * k * chi)
    return out


class LambertConic(NamedTuple):
    """Lambert's conformal conic with two standard parallels (equal ones make it tangent)."""

    lon0: float
    lat0: float
    lat1: float
    lat2: float
    east0: float = 0.0
    north0: float = 0.0
    ellipsoid: Ellipsoid = GRS80

    def _cone(self) -> tuple[float, float, float, float]:
        """(eccentricity, cone constant, scale, radius of the origin's parallel)."""
        e = math.sqrt(self.ellipsoid.f * (2 - self.ellipsoid.f))

        def m(lat):
            p = math.radians(lat)
            return math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)

        def t(lat):
            s = math.sin(math.radians(lat))
            return math.exp(-(math.atanh(s) - e * math.atanh(e * s)))

        if self.lat1 == self.lat2:
            n = math.sin(math.radians(self.lat1))
        else:
            n = math.log(m(self.lat1) / m(self.lat2)) / math.log(t(self.lat1) / t(self.lat2))
        scale = m(self.lat1) / (n * t(self.lat1) ** n)
        return e, n, scale, self.ellipsoid.a * scale * t(self.lat0) ** n

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        e, n, scale, origin = self._cone()
        s = F.sin(F.radians(lat))
        r = self.ellipsoid.a * scale * F.exp(-n * (_atanh(s) - e * _atanh(e * s)))
        angle = n * F.radians(lon - self.lon0)
        return self.east0 + r * F.sin(angle), self.north0 + origin - r * F.cos(angle)

    def inverse(self, east: Column, north: Column) -> tuple[Column, Column]:
        e, n, scale, origin = self._cone()
        sign = math.copysign(1.0, n)
        dx, dy = sign * (east - self.east0), sign * (origin - (north - self.north0))
        r = sign * F.sqrt(dx * dx + dy * dy)
        t = F.pow(r / (self.ellipsoid.a * scale), 1 / n)
        chi = math.pi / 2 - 2 * F.atan(t)
        return F.degrees(F.atan2(dx, dy) / n) + self.lon0, F.degrees(_geographic(chi, e))


def utm(zone: int, north: bool = True, ellipsoid: Ellipsoid = WGS84) -> TransverseMercator:
    """The UTM projection of a zone (1 to 60)."""
    return TransverseMercator(6.0 * zone - 183, 0.0, 0.9996, 500_000.0, 0.0 if north else 10_000_000.0, ellipsoid)


#: The two-parallel conics of the Canadian atlas and of statistical boundary files.
CANADA_ATLAS = LambertConic(-95.0, 49.0, 49.0, 77.0)
STATISTICS_CANADA = LambertConic(-91.866666666666667, 63.390675, 49.0, 77.0, 6_200_000.0, 3_000_000.0)
