"""Great-circle distance, distance filter and geohash as Column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

EARTH_RADIUS_M = 6371008.8

# The geohash alphabet.
_BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def geo_distance_m(lon: Column, lat: Column, to_lon: float, to_lat: float) -> Column:
    """Haversine distance in metres from each row to one point."""
    half_lat = F.sin(F.radians(lat - F.lit(float(to_lat))) / 2)
    half_lon = F.sin(F.radians(lon - F.lit(float(to_lon))) / 2)
    cos_to = F.lit(math.cos(math.radians(to_lat)))
    h = half_lat * half_lat + cos_to * F.cos(F.radians(lat)) * half_lon * half_lon
    # rounding can lift h of antipodal points a hair over 1, where asin is NaN
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def bounding_box(lon: float, lat: float, distance_m: float):
    """(lat_low, lat_high, lon ranges) that holds every point within the distance.

    The list of longitude ranges is None where all longitudes can match: when a
    pole is inside the circle. Two ranges are given when it crosses 180 degrees.
    """
    slack = 1e-7  # degrees; covers rounding of the distance itself
    angle = distance_m / EARTH_RADIUS_M
    low, high = lat - math.degrees(angle) - slack, lat + math.degrees(angle) + slack
    if low <= -90 or high >= 90:
        return max(low, -90.0), min(high, 90.0), None
    width = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + slack
    west, east = lon - width, lon + width
    if east - west >= 360:
        return low, high, None
    if west < -180:
        return low, high, [(west + 360, 180.0), (-180.0, east)]
    if east > 180:
        return low, high, [(west, 180.0), (-180.0, east - 360)]
    return low, high, [(west, east)]


def within_distance(lon: Column, lat: Column, to_lon: float, to_lat: float, distance_m: float) -> Column:
    """Rows within `distance_m` metres. The box in front reaches the Parquet scan."""
    if isinstance(distance_m, bool) or not isinstance(distance_m, (int, float)):
        raise ValueError("the distance must be a number of metres")
    if not (-180 <= to_lon <= 180 and -90 <= to_lat <= 90):
        raise ValueError("the point must be (longitude, latitude) in degrees")
    low, high, lon_ranges = bounding_box(to_lon, to_lat, distance_m)
    box = (lat >= low) & (lat <= high)
    if lon_ranges is not None:
        box = box & reduce(lambda a, b: a | b, [(lon >= w) & (lon <= e) for w, e in lon_ranges])
    return box & (geo_distance_m(lon, lat, to_lon, to_lat) <= F.lit(float(distance_m)))


def geohash(lon: Column, lat: Column, precision: int = 12) -> Column:
    """Geohash text of a point: 5 bits per character, longitude bit first."""
    if not 1 <= precision <= 12:
        raise ValueError("geohash precision must be 1 to 12")
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2

    def cell(value: Column, low: float, span: float, n: int) -> Column:
        index = F.floor((value - F.lit(low)) / F.lit(span) * F.lit(float(2**n)))
        return F.least(F.greatest(index, F.lit(0)), F.lit(2**n - 1)).cast("bigint")

    x, y = cell(lon, -180.0, 360.0, lon_bits), cell(lat, -90.0, 180.0, lat_bits)
    chars = []
    for i in range(precision):
        code = F.lit(0).cast("bigint")
        for j in range(5 * i, 5 * i + 5):
            # even positions hold longitude bits, odd ones latitude bits, high bits first
            source, left = (x, lon_bits - 1 - j // 2) if j % 2 == 0 else (y, lat_bits - 1 - j // 2)
            bit = F.shiftright(source, left).bitwiseAND(F.lit(1))
            code = F.shiftleft(code, 1).bitwiseOR(bit)
        chars.append(F.substring(F.lit(_BASE32), code.cast("int") + 1, F.lit(1)))
    return F.concat(*chars)


def covering_cells(lon: float, lat: float, distance_m: float, most: int = 64) -> list[tuple[str, str | None]]:
    """Ranges `[first, end)` of geohash text that hold every point within the distance; None is open.

    Cells of the greatest precision of which no more than `most` meet the circle's box, neighbours in
    geohash order as one range. The box is that of `bounding_box`, so a pole or the 180th meridian inside the
    circle is covered.
    """
    low, high, lon_ranges = bounding_box(lon, lat, distance_m)
    cells: list[str] = [""]
    for precision in range(1, 13):
        bits = 5 * precision
        columns, rows = 2 ** ((bits + 1) // 2), 2 ** (bits // 2)
        spans = [_span(w, e, -180.0, 360.0, columns) for w, e in lon_ranges or [(-180.0, 180.0)]]
        first, last = _span(low, high, -90.0, 180.0, rows)
        if sum(b - a + 1 for a, b in spans) * (last - first + 1) > most:
            break
        cells = sorted({_text(x, y, precision) for a, b in spans for x in range(a, b + 1) for y in range(first, last + 1)})
    ranges: list[tuple[str, str | None]] = []
    for cell in cells:
        if ranges and ranges[-1][1] == cell:
            ranges[-1] = (ranges[-1][0], _next(cell))
        else:
            ranges.append((cell, _next(cell)))
    return ranges


def in_cells(cell: Column, lon: float, lat: float, distance_m: float) -> Column:
    """Rows whose geohash, of at least the precision that the circle calls for, is in a covering cell."""
    tests = [(cell >= F.lit(first)) if end is None else (cell >= F.lit(first)) & (cell < F.lit(end))
             for first, end in covering_cells(lon, lat, distance_m)]
    return reduce(lambda a, b: a | b, tests)


def _span(first: float, last: float, low: float, width: float, n: int) -> tuple[int, int]:
    place = lambda v: max(0, min(n - 1, math.floor((v - low) / width * n)))
    return place(first), place(last)


def _text(x: int, y: int, precision: int) -> str:
    """The geohash of a column and row of cells: their bits in turn, the column's first."""
    bits = 5 * precision
    lon_bits, lat_bits = (bits + 1) // 2, bits // 2
    number = 0
    for j in range(bits):
        bit = (x >> (lon_bits - 1 - j // 2)) & 1 if j % 2 == 0 else (y >> (lat_bits - 1 - j // 2)) & 1
        number = number << 1 | bit
    return "".join(_BASE32[number >> 5 * i & 31] for i in reversed(range(precision)))


def _next(cell: str) -> str | None:
    """The least text above all that start with this one, as far as geohashes go."""
    cell = cell.rstrip(_BASE32[-1])
    return cell[:-1] + _BASE32[_BASE32.index(cell[-1]) + 1] if cell else None
