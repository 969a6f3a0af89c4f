"""Column helpers and grouped statistics shared by every operator."""

from pitlane.functions.scalar import (  # noqa: F401
    DEFAULT_RECORD_SOURCE, DRY_COMPOUNDS, KNOWN_COMPOUNDS, PROGRESS_BINS, TYRE_LIFE_BINS,
    as_seconds, interval_seconds, nan_to_null, right_closed_bins, round_doubles, safe_div,
)
from pitlane.functions.stats import (  # noqa: F401
    group_mode, group_quantiles, null_safe_join, grouped_stats,
)
