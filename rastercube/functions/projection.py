"""Geographic to transverse Mercator coordinates as column expressions (Krueger's series, WGS 84)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS 84's semi-major axis and flattening, and the scale and false easting of UTM (fixed values).
_A, _F, _K, _EAST, _SOUTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0


def utm(lon: Column, lat: Column, zone: int, north: bool = True) -> tuple[Column, Column]:
    """(easting, northing) in metres of longitude and latitude in degrees."""
    n = _F / (2 - _F)
    radius = _A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    phi, lam = F.radians(lat), F.radians(lon - F.lit(float(6 * zone - 183)))
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - c * F.atanh(c * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east, along = eta, xi
    for j, a in enumerate(alpha, 1):
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        along = along + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return _EAST + _K * radius * east, (0.0 if north else _SOUTH) + _K * radius * along


def utm_zone(crs: str) -> tuple[int, bool] | None:
    """(zone, north) of EPSG:326zz and EPSG:327zz, else None."""
    code = crs.removeprefix("EPSG:")
    if code.isdigit() and len(code) == 5 and code[:3] in ("326", "327") and 1 <= int(code[3:]) <= 60:
        return int(code[3:]), code[2] == "6"
    return None
