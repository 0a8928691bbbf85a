"""The 500 m grid: cell ids as "x.y" strings, x growing east, y growing south,
cell 1.1 centred on the grid origin."""

from pyspark.sql import Column, functions as F

from cabgrid.schema import (
    CELL_STEP_LAT,
    CELL_STEP_LON,
    LAT_MAX,
    LAT_MIN,
    LON_MAX,
    LON_MIN,
    ORIGIN_LAT,
    ORIGIN_LON,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grid_x(lon, origin_lon: float = ORIGIN_LON, step: float = CELL_STEP_LON) -> Column:
    """Column index: 1 + floor(1/2 + (lon - origin) / step)."""
    return F.lit(1) + F.floor(F.lit(0.5) + (_col(lon) - F.lit(origin_lon)) / F.lit(step))


def grid_y(lat, origin_lat: float = ORIGIN_LAT, step: float = CELL_STEP_LAT) -> Column:
    """Row index: 1 + floor(1/2 + (origin - lat) / step) (rows grow southwards)."""
    return F.lit(1) + F.floor(F.lit(0.5) + (F.lit(origin_lat) - _col(lat)) / F.lit(step))


def grid_cell(lon, lat) -> Column:
    """Cell id string ``"x.y"`` of a point."""
    return F.concat_ws(".", grid_x(lon).cast("string"), grid_y(lat).cast("string"))


def inside_grid(lon, lat) -> Column:
    """Inclusive bounding-box test; NaN and NULL coordinates are outside."""
    return _col(lon).between(LON_MIN, LON_MAX) & _col(lat).between(LAT_MIN, LAT_MAX)
