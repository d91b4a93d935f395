"""Distances and grid cells of lon/lat points, in degrees and metres."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS = 6_371_008.8


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS) * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


# Grid levels: level k cuts the circle into 2^k columns (and as many degrees per row).
FINEST_LEVEL = 24


def cell_size(level: Column) -> Column:
    return F.lit(360.0) / F.pow(F.lit(2.0), level)


def cell_x(lon: Column, level: Column) -> Column:
    """Column of the grid, wrapped around the date line."""
    return F.pmod(F.floor((lon + 180) / cell_size(level)).cast("long"), F.pow(F.lit(2.0), level).cast("long"))


def cell_y(lat: Column, level: Column) -> Column:
    return F.floor((lat + 90) / cell_size(level)).cast("long")


def _half_widths(lat: Column, radius: Column) -> tuple[Column, Column]:
    """Half-widths in degrees of a cap of `radius` metres. That of the longitude grows towards
    the poles and is the whole circle once the cap contains one."""
    angle = radius / F.lit(EARTH_RADIUS)
    dlat = F.degrees(angle)
    reach = F.sin(angle) / F.cos(F.radians(lat))
    polar = (lat + dlat >= 90) | (lat - dlat <= -90) | (reach >= 1)
    return dlat, F.when(polar, 180.0).otherwise(F.degrees(F.asin(F.least(reach, F.lit(1.0)))))


def level_of(lat: Column, radius: Column) -> Column:
    """The finest level whose cells are as wide as the cap's half-widths: a cap touches three
    cells a side at most, whatever its radius."""
    dlat, dlon = _half_widths(lat, radius)
    wide = F.greatest(dlat, dlon, F.lit(360.0 / (1 << FINEST_LEVEL)))
    return F.greatest(F.floor(F.log2(F.lit(360.0) / wide)), F.lit(0)).cast("int")


def covering_cells(lon: Column, lat: Column, radius: Column, level: Column) -> Column:
    """Array of (x, y) cells of a level that a cap of `radius` metres may touch."""
    dlat, dlon = _half_widths(lat, radius)
    size = cell_size(level)
    columns = F.pow(F.lit(2.0), level).cast("long")
    x0 = F.floor((lon - dlon + 180) / size).cast("long")
    x1 = F.least(F.floor((lon + dlon + 180) / size).cast("long"), x0 + (columns - 1))
    y0 = F.floor((F.greatest(lat - dlat, F.lit(-90.0)) + 90) / size).cast("long")
    y1 = F.floor((F.least(lat + dlat, F.lit(90.0)) + 90) / size).cast("long")
    xs = F.transform(F.sequence(x0, x1), lambda x: F.pmod(x, columns))
    return F.flatten(
        F.transform(xs, lambda x: F.transform(F.sequence(y0, y1), lambda y: F.struct(x.alias("x"), y.alias("y"))))
    )


def in_box(lon: Column, lat: Column, lon_min: float, lat_min: float, lon_max: float, lat_max: float) -> Column:
    """Inclusive box; lon_min > lon_max crosses the date line."""
    across = (lon >= lon_min) | (lon <= lon_max) if lon_min > lon_max else (lon >= lon_min) & (lon <= lon_max)
    return across & (lat >= lat_min) & (lat <= lat_max)
