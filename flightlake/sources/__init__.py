"""Sources: Parquet snapshots (S1, S2), driver rows (S3), landed JSON (S4)."""

from flightlake.sources.landed_json import landing_rank, read_landed_json, stitch_details  # noqa: F401
from flightlake.sources.parquet import latest_snapshot, read_snapshots, read_table  # noqa: F401
from flightlake.sources.rows import rows_to_df  # noqa: F401
