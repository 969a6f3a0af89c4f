"""Lap-shaped views over the driver's synthetic tables (FIXTURES.md §C).

Each view is one SQL text with ``{table}`` placeholders.  Spark runs it through
``spark.sql(text, lineitem=df, ...)`` so no global temp view is registered; the
DuckDB oracle substitutes the bare table names and pastes it as a CTE.  The
same text on both sides keeps the inputs row-identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The view definitions from FIXTURES.md §C, verbatim.
LAPS_SQL = """
WITH base AS (
  SELECT n.n_name AS GrandPrix, r.r_name AS Circuit,
    CASE WHEN l.l_linestatus = 'F' THEN 'Race' ELSE 'Qualifying' END AS Session,
    concat('D', CAST(s.s_suppkey AS VARCHAR(10))) AS Driver,
    CAST(s.s_suppkey AS VARCHAR(10)) AS DriverNumber,
    12 + CAST(s.s_suppkey % 4 AS INT) * 11 AS len, l.*
  FROM {lineitem} l JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
  JOIN {nation} n ON s.s_nationkey = n.n_nationkey
  JOIN {region} r ON n.n_regionkey = r.r_regionkey),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY GrandPrix, Session, Driver
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS n0 FROM base),
stinted AS (
  SELECT *, CAST(floor(n0 / len) AS INT) + 1 AS stint_no, CAST(n0 % len AS INT) + 1 AS age FROM numbered),
tyred AS (
  SELECT *, CASE (stint_no + l_suppkey) % 8 WHEN 0 THEN 'SOFT' WHEN 1 THEN 'SOFT'
      WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'MEDIUM' WHEN 4 THEN 'HARD' WHEN 5 THEN 'HARD'
      WHEN 6 THEN CASE WHEN Session = 'Race' THEN 'INTERMEDIATE' ELSE 'WET' END
      ELSE CASE WHEN Session = 'Race' THEN 'C3' END END AS Compound FROM stinted)
SELECT GrandPrix, Circuit, Session, Driver, DriverNumber,
  CAST(n0 + 1 AS DOUBLE) AS LapNumber,
  CAST((n0 + 1) * 90 AS DOUBLE) AS Time,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL
       WHEN l_orderkey % 211 = 0 THEN CAST(160 AS DOUBLE)
       ELSE CAST(80 AS DOUBLE) + l_extendedprice / 9973 + age * CAST(0.05 AS DOUBLE)
         + CAST(CASE Compound WHEN 'MEDIUM' THEN 0.4 WHEN 'HARD' THEN 0.8 ELSE 0.0 END AS DOUBLE) END AS LapTime,
  CASE WHEN l_orderkey % 89 = 0 THEN NULL ELSE CAST(25 AS DOUBLE) + l_extendedprice / 29919 END AS Sector1Time,
  CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE CAST(27 AS DOUBLE) + l_extendedprice / 29919 END AS Sector2Time,
  CAST(28 AS DOUBLE) + l_extendedprice / 29919 + age * CAST(0.05 AS DOUBLE)
    + CAST(CASE Compound WHEN 'MEDIUM' THEN 0.4 WHEN 'HARD' THEN 0.8 ELSE 0.0 END AS DOUBLE)
    + CAST(CASE WHEN l_linenumber = 6 THEN 0.3 ELSE 0.0 END AS DOUBLE) AS Sector3Time,
  Compound,
  CAST(CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 211 = 1 THEN age + 3 ELSE age END AS DOUBLE) AS TyreLife,
  CAST(stint_no AS DOUBLE) AS Stint, age <= 2 AS FreshTyre, l_returnflag <> 'R' OR age > 20 AS IsAccurate,
  CAST(CASE WHEN age = len THEN (n0 + 1) * 90 END AS DOUBLE) AS PitInTime,
  CAST(CASE WHEN age = 1 AND stint_no > 1 THEN n0 * 90 + 25 WHEN age = len AND l_tax < 0.03 THEN (n0 + 1) * 90 + 25 END AS DOUBLE) AS PitOutTime
FROM tyred
"""

LAPS_DUP_SQL = """
SELECT * FROM {laps} UNION ALL SELECT * FROM {laps} WHERE CAST(LapNumber AS INT) % 37 = 0
"""

WEATHER_SQL = """
SELECT concat('NATION_', CAST(user_id % 25 AS VARCHAR(10))) AS GrandPrix,
  CASE WHEN event_id % 40 = 0 THEN 'Race' ELSE 'Qualifying' END AS Session, event_id AS WeatherId,
  CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS DOUBLE) / 3 AS Time,
  CAST(15 AS DOUBLE) + value / 20 AS AirTemp, CAST(20 AS DOUBLE) + value / 10 AS TrackTemp,
  event_type = 'error' AS Rainfall
FROM {events}
"""
# FIXTURES.md §C.3 as written: one event in 20, which its J1/J2 anchors were
# measured on.  Used only to reproduce those anchors; registered queries read
# every event (the weather operators never materialise the fan-out).
WEATHER_SAMPLE_SQL = WEATHER_SQL.rstrip() + " WHERE event_id % 20 = 0\n"

TELEMETRY_SQL = """
SELECT event_id AS SampleId, value AS Speed, CASE WHEN event_type = 'view' THEN NULL ELSE value / 4 END AS Throttle,
  CAST(event_id % 103 AS DOUBLE) AS Brake, CAST(event_id % 10 AS INT) AS nGear, value * 45 AS RPM FROM {events}
"""

STRATEGIES_SQL = """
SELECT Strategy, StintNo, Compound, StintLength FROM (VALUES
  ('Conservative (1-stop)', 1, 'HARD', 78),
  ('Standard (1-stop)', 1, 'MEDIUM', 40), ('Standard (1-stop)', 2, 'HARD', 38),
  ('Aggressive (2-stop)', 1, 'SOFT', 25), ('Aggressive (2-stop)', 2, 'MEDIUM', 28), ('Aggressive (2-stop)', 3, 'MEDIUM', 25),
  ('Alternative (2-stop)', 1, 'MEDIUM', 30), ('Alternative (2-stop)', 2, 'SOFT', 20), ('Alternative (2-stop)', 3, 'MEDIUM', 28),
  ('Unknown tyre', 1, 'MEDIUM', 40), ('Unknown tyre', 2, 'HYPERSOFT', 38)
) AS t(Strategy, StintNo, Compound, StintLength)
UNION ALL
SELECT concat('grid-', CAST(p_partkey AS VARCHAR(10))), 1,
  CASE WHEN p_size % 2 = 0 THEN 'SOFT' ELSE 'MEDIUM' END, p_size + 5 FROM {part}
UNION ALL
SELECT concat('grid-', CAST(p_partkey AS VARCHAR(10))), 2, 'HARD', 73 - p_size FROM {part}
"""

# view name -> (sql template, base tables or views it reads)
VIEWS = {
    "laps": (LAPS_SQL, ("lineitem", "supplier", "nation", "region")),
    "laps_dup": (LAPS_DUP_SQL, ("laps",)),
    "weather": (WEATHER_SQL, ("events",)),
    "weather_sample": (WEATHER_SAMPLE_SQL, ("events",)),
    "telemetry": (TELEMETRY_SQL, ("events",)),
    "strategies": (STRATEGIES_SQL, ("part",)),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of one task when laps are dealt by driver session.
DEAL_ROWS = 500_000


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one fixture view as a lazy Spark plan over the parquet tables."""
    text, deps = VIEWS[name]
    frames = {
        d: view(spark, sf_dir, d) if d in VIEWS else read_table(spark, sf_dir, d)
        for d in deps
    }
    return spark.sql(text, **frames)


def dealt_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view ``laps``, its rows dealt by ranges of (GrandPrix, Session, Driver).

    The same text, cut after its joins.  One shuffle serves the window that numbers
    the laps and whoever writes them by (GrandPrix, Session); the ranges follow the
    number of rows, so a task's memory doesn't grow with the input.
    """
    text, deps = VIEWS["laps"]
    joins, rest = text.split("),\nnumbered AS (")
    frames = {d: read_table(spark, sf_dir, d) for d in deps}
    rows = frames["lineitem"].count()  # from the footers
    few = min(spark.sparkContext.defaultParallelism, 1 + rows // 20_000)
    base = spark.sql(joins + ") SELECT * FROM base", **frames).repartitionByRange(
        max(few, -(-rows // DEAL_ROWS)), "GrandPrix", "Session", "Driver")
    return spark.sql("WITH numbered AS (" + rest.replace("FROM base", "FROM {base}"), base=base)


def oracle_ctes(*names: str) -> str:
    """``WITH`` prefix defining the named views (and what they need) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order or n not in VIEWS:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = []
    for n in order:
        text, deps = VIEWS[n]
        parts.append(f"{n} AS ({text.format(**{d: d for d in deps}).strip()})")
    return "WITH " + ",\n".join(parts) + "\n"
