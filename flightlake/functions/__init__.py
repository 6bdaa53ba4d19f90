"""Column expressions (all built-in Spark functions, no UDFs)."""

from flightlake.functions.geo import (  # noqa: F401
    EARTH_RADIUS_KM, METERS_PER_DEGREE, box_around, haversine_km,
    radius_to_half_widths, strictly_inside,
)
from flightlake.functions.text import first_char, first_word  # noqa: F401
from flightlake.functions.time import epoch_seconds, layout_columns  # noqa: F401
