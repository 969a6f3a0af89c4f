"""Sources and sinks."""

from pitlane.sources.laps import (  # noqa: F401
    DEFAULT_2024_RACES, TIME_COLUMNS, bronze_laps, from_pandas, load_season, season_2024, to_seconds,
)
from pitlane.sources.sinks import EXPORT_COLUMNS, export_columns, export_laps, write_table  # noqa: F401
