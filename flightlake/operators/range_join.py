"""Range joins: points strictly inside axis-aligned boxes (J7, J8).

One plan at every size: a grid of levels. A box belongs to the finest level whose cells
are no smaller than the box, so it touches at most two cells each way and
becomes at most MAX_CELLS_PER_BOX rows, whatever its size. A point has one cell on each level
that any box is on (the levels in use come from a scalar subquery of the same plan, so nothing
runs while the plan is built), the join is an equi-join on (level, cell), and the
exact test follows. A box is on one level and a point in one cell of it, so no
pair comes twice.

Cells are numbered on coordinates clamped to the globe; the exact test sees the
coordinates as they are. Clamping keeps order, so a point inside a box shares a cell
with it even where either lies beyond the globe.

The coarse levels have few cells, so all points would meet in a few join keys. There a point takes one of
several salts of its cell, from a hash of its row, and a box stands under each: a level has about as many
keys as many tasks need, without the runtime's skew rule.

No side is broadcast by a hint. Catalyst broadcasts the cells only if the boxes'
estimated size is under its threshold, and they are at most MAX_CELLS_PER_BOX times as many, times the salts on coarse levels;
else the join is a sort-merge join whose hot cells AQE splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.functions.geo import circle_half_widths, haversine_km, strictly_inside

#: level k has cells of 360 / 2^k degrees, from the globe down to 0.0055 degrees
LEVELS = 17
MAX_CELLS_PER_BOX = 4


def _check_names(points: DataFrame, boxes: DataFrame) -> None:
    clash = set(points.columns) & set(boxes.columns)
    if clash:
        raise ValueError(f"point and box columns must differ, both have {sorted(clash)}")


def level_of(extent: Column) -> Column:
    """Finest level whose cells are as large as extent (degrees); 0 for anything larger than the globe."""
    level = F.lit(0)
    for k in range(1, LEVELS):
        level = F.when(extent <= F.lit(360.0 / 2 ** k), F.lit(k)).otherwise(level)
    return level


def cell_of(value: Column, limit: float, level: Column) -> Column:
    """Number of the level's cell that holds value, clamped to -limit .. limit."""
    clamped = F.least(F.greatest(value.cast("double"), F.lit(-limit)), F.lit(limit))
    return F.floor((clamped + F.lit(limit)) * F.pow(F.lit(2.0), level) / F.lit(360.0)).cast("int")


#: keys on a level for each shuffle partition, and at most
KEYS_PER_PARTITION, MAX_KEYS = 16, 1 << 16


def salts_of(level: Column, keys: int) -> Column:
    """Salts of a cell on a level: coarse levels have few cells, which salts make up to about ``keys`` keys."""
    cells = F.pow(F.lit(2.0), level) * F.greatest(F.lit(1.0), F.pow(F.lit(2.0), level - 1))
    return F.greatest(F.lit(1), F.ceil(F.lit(float(keys)) / cells).cast("int"))


def _hashable(df: DataFrame) -> list[str]:
    """Columns a row can be told apart by (maps and variants have no hash)."""
    return [f"`{f.name}`" for f in df.schema.fields if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]


def point_in_box_join(points: DataFrame, boxes: DataFrame, lat: str = "latitude",
                      lon: str = "longitude", corners=("tl_y", "tl_x", "br_y", "br_x"), wrap: bool = False,
                      keys: int | None = None) -> DataFrame:
    """All (point, box) pairs with the point strictly inside the box.

    ``wrap``: a box that reaches over longitude 180 or -180 holds the points beyond it. ``keys``: about how many
    join keys a level has at least (default: KEYS_PER_PARTITION for each shuffle partition)."""
    _check_names(points, boxes)
    tl_y, tl_x, br_y, br_x = corners
    lo_y, hi_y = F.least(tl_y, br_y), F.greatest(tl_y, br_y)
    lo_x, hi_x = F.least(tl_x, br_x), F.greatest(tl_x, br_x)
    if keys is None:
        keys = min(MAX_KEYS, KEYS_PER_PARTITION * int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def clamp(c: Column, limit: float) -> Column:
        return F.least(F.greatest(c.cast("double"), F.lit(-limit)), F.lit(limit))

    if wrap:
        # the part beyond the line, a turn away: the two can't hold one point, so no pair comes twice
        turns = F.array_compact(F.array(F.lit(0.0), F.when((lo_x < -180.0) & (hi_x - lo_x < 360.0), F.lit(360.0)),
                                        F.when((hi_x > 180.0) & (hi_x - lo_x < 360.0), F.lit(-360.0))))
        boxes = boxes.withColumn("_turn", F.explode(turns))
        lo_x, hi_x = lo_x + F.col("_turn"), hi_x + F.col("_turn")
    extent = F.greatest(clamp(hi_y, 90.0) - clamp(lo_y, 90.0), clamp(hi_x, 180.0) - clamp(lo_x, 180.0))
    levelled = boxes.withColumns({"_level": level_of(extent), "_lo_x": lo_x, "_hi_x": hi_x}).where(extent.isNotNull())
    level = F.col("_level")
    cells = (
        levelled
        .withColumn("_cy", F.explode(F.sequence(cell_of(lo_y, 90.0, level), cell_of(hi_y, 90.0, level))))
        .withColumn("_cx", F.explode(F.sequence(cell_of(F.col("_lo_x"), 180.0, level), cell_of(F.col("_hi_x"), 180.0, level))))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts_of(level, keys) - 1)))
    )
    used = levelled.select(F.collect_set("_level")).scalar()
    names = _hashable(points)
    placed = points.withColumn("_plevel", F.explode(used))
    pts = placed.withColumns({"_py": cell_of(F.col(lat), 90.0, F.col("_plevel")),
                              "_px": cell_of(F.col(lon), 180.0, F.col("_plevel")),
                              "_psalt": F.pmod(F.xxhash64(*names), salts_of(F.col("_plevel"), keys).cast("long")).cast("int")})
    cond = (
        (pts["_plevel"] == cells["_level"]) & (pts["_py"] == cells["_cy"]) & (pts["_px"] == cells["_cx"]) & (pts["_psalt"] == cells["_salt"])
        & strictly_inside(pts[lat], pts[lon], cells[tl_y], cells["_lo_x"], cells[br_y], cells["_hi_x"])
    )
    return pts.join(cells, cond, "inner").drop("_plevel", "_py", "_px", "_psalt", "_level", "_cy", "_cx", "_salt", "_lo_x", "_hi_x", "_turn")


def within_radius_join(points: DataFrame, centres: DataFrame, radius_m: Column | str | float, lat: str = "latitude",
                       lon: str = "longitude", centre_lat: str = "centre_latitude", centre_lon: str = "centre_longitude",
                       distance: str = "distance_km") -> DataFrame:
    """All (point, centre) pairs within a radius on the globe, with their great-circle distance.

    The circle's box finds the candidates, over the date line and around the poles too, and the
    distance decides."""
    radius = F.col(radius_m) if isinstance(radius_m, str) else radius_m if isinstance(radius_m, Column) else F.lit(float(radius_m))
    half_lat, half_lon = circle_half_widths(radius, F.col(centre_lat))
    boxes = centres.withColumns({"_radius_km": radius / 1000.0, "_wt": F.col(centre_lat) + half_lat, "_wl": F.col(centre_lon) - half_lon,
                                 "_wb": F.col(centre_lat) - half_lat, "_wr": F.col(centre_lon) + half_lon})
    pairs = point_in_box_join(points, boxes, lat, lon, ("_wt", "_wl", "_wb", "_wr"), wrap=True)
    pairs = pairs.withColumn(distance, haversine_km(F.col(lat), F.col(lon), F.col(centre_lat), F.col(centre_lon)))
    return pairs.where(F.col(distance) <= F.col("_radius_km")).drop("_radius_km", "_wt", "_wl", "_wb", "_wr")
