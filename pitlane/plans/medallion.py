"""Bronze -> silver -> gold as one lazy plan, with layer row counts observed.

The reference counts each layer with its own action, re-running the growing
plan each time.  Here ``DataFrame.observe`` attaches the counts to the plan:
they are filled in by whatever single action runs the gold table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pitlane.functions.scalar import DEFAULT_RECORD_SOURCE
from pitlane.operators import clean, gold
from pitlane.sources.laps import bronze_laps


@dataclass
class Medallion:
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    observations: dict[str, Observation]

    def counts(self) -> dict[str, int]:
        """Layer row counts; available after an action on ``gold`` has run."""
        return {name: obs.get["rows"] for name, obs in self.observations.items()}


def medallion(laps_raw: DataFrame, source: str = DEFAULT_RECORD_SOURCE) -> Medallion:
    obs = {"bronze": Observation("bronze"), "silver": Observation("silver")}
    bronze = bronze_laps(laps_raw, source).observe(obs["bronze"], F.count(F.lit(1)).alias("rows"))
    silver = clean.silver_laps(bronze, lazy=True).observe(obs["silver"], F.count(F.lit(1)).alias("rows"))
    return Medallion(bronze, silver, gold.driver_stats(silver), obs)
