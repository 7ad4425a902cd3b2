"""Units of mass change, areas and their uncertainties as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firn.functions.dates import _col
from firn.functions.dims import ICE, OCEAN_KM2, WATER


def metres_to_gt(v, area, ice: float = ICE) -> Column:
    return _col(v) * ice * (_col(area) / 1e6)


def gt_to_metres(v, area, ice: float = ICE) -> Column:
    return F.try_divide(_col(v) * 1e6, _col(area) * ice)


def metres_to_mwe(v, water: float = WATER, ice: float = ICE) -> Column:
    return _col(v) / water * ice


def mwe_to_metres(v, water: float = WATER, ice: float = ICE) -> Column:
    return _col(v) * water / ice


def mwe_to_gt(v, area, water: float = WATER) -> Column:
    return _col(v) * water * (_col(area) / 1e6)


def gt_to_mwe(v, area, water: float = WATER) -> Column:
    return F.try_divide(_col(v) * 1e6, _col(area) * water)


def gt_to_sea_level(v, ocean: float = OCEAN_KM2) -> Column:
    """Millimetres; the sign is lost."""
    return F.abs(_col(v) / ocean) * 1e6


def density_uncertainty(years) -> Column:
    """kg/m3 by the length of a survey in years."""
    t = _col(years)
    return F.when(t < 1, 480.0).when(t < 5, 240.0).when(t < 10, 120.0).otherwise(60.0)


def adjusted_area(start, end, area, area_change, reference_year) -> Column:
    """Area at the middle of a period; area_change in percent a year since the reference year."""
    return _col(area) + ((_col(start) + _col(end)) / 2 - _col(reference_year)) * (_col(area_change) / 100) * _col(area)


def quadrature(*parts) -> Column:
    total = _col(parts[0]) * _col(parts[0])
    for p in parts[1:]:
        total = total + _col(p) * _col(p)
    return F.sqrt(total)


def mwe_error_of_metres(change, error, years, ice: float = ICE) -> Column:
    """Error in mwe of a change in mwe with that of the density; null where the change is 0."""
    change = _col(change)
    return F.abs(change) * quadrature(F.try_divide(_col(error), change), density_uncertainty(years) / ice)


def without_area_error(change, error, area, percent) -> Column:
    """Error of a Gt change without the part that the area's uncertainty has in it."""
    c, e, a = _col(change), _col(error), _col(area)
    u = a * _col(percent)
    return F.try_divide(F.abs(c * F.sqrt(F.abs(e * e * a * a - c * c * u * u))), F.abs(c) * a)


def with_area_error(change, error, area, percent) -> Column:
    """Error of a Gt change with that of the area."""
    c = _col(change)
    return F.abs(c) * quadrature(F.try_divide(_col(error), c), _col(percent))
