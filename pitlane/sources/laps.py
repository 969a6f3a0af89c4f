"""Lap sources: season loading, in-memory tables and the bronze layer."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitlane.functions.scalar import DEFAULT_RECORD_SOURCE, as_seconds
from pitlane.schema import LAPS_SCHEMA

# The reference's default race list for a season load (first half of 2024).
DEFAULT_2024_RACES = (
    "Bahrain", "Saudi Arabia", "Australia", "Japan",
    "China", "Miami", "Emilia Romagna", "Monaco",
    "Canada", "Spain", "Austria", "Great Britain",
    "Hungary", "Belgium", "Netherlands", "Italy",
)
TIME_COLUMNS = ("LapTime", "Sector1Time", "Sector2Time", "Sector3Time")


def _plain(uri: str) -> str:
    """An address with one spelling of local files."""
    return re.sub(r"^file:/+", "/", uri).rstrip("/")


def _broken_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(address, reason) of the parquet files among (address, content) that don't open."""
    for batch in batches:
        found = []
        for address, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            try:
                pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata
            except Exception as e:  # noqa: BLE001  whatever a broken file makes of it is the reason
                found.append((address, str(e).strip().split("\n")[0][:200]))
        yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], names=["address", "reason"])


def unreadable_paths(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> dict[str, str]:
    """{path: reason} of the paths that don't exist, are empty or hold a file that can't be read as ``fmt``.

    Three jobs at most for any number of paths: one finds the files that have rows
    (footers only for parquet), passing over broken ones; one lists the others, which are
    empty or broken; one opens those.
    """
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
    out, there = {}, {}
    for path in paths:
        at = hadoop(path)
        fs = at.getFileSystem(conf)
        if not fs.exists(at):
            out[path] = "the path does not exist"
        elif not fs.getContentSummary(at).getFileCount():
            out[path] = "no file there"
        else:
            there[path] = _plain(fs.makeQualified(at).toString())
    if not there or fmt != "parquet":  # files of other formats open in any state
        return out
    read = lambda f: spark.read.format(f).option("recursiveFileLookup", "true")
    address = F.col("_metadata.file_path").alias("address")
    full = read(fmt).schema("_none int").option("ignoreCorruptFiles", "true").load(list(there)).select(address).distinct()
    doubtful = [r["address"] for r in read("binaryFile").load(list(there)).select(address).join(full, "address", "left_anti").collect()
                if not re.search(r"/[_.][^/]*$", r["address"])]
    if not doubtful:
        return out
    opened = read("binaryFile").load([unquote(d) for d in doubtful]).select(address, "content").mapInArrow(
        _broken_footers, "address string, reason string").collect()
    owners = {prefix: path for path, prefix in there.items()}
    for r in opened:
        at = _plain(unquote(r["address"]))
        while at and at not in owners:
            at = at.rpartition("/")[0]
        if at:
            out[owners[at]] = r["reason"]
    return out


def load_season(spark: SparkSession, source: DataFrame | str | Sequence[str],
                races: Sequence[str] | None = None, session: str | None = None, fmt: str = "parquet",
                schema: StructType | None = LAPS_SCHEMA, skipped: list[tuple[str, str]] | None = None) -> DataFrame | None:
    """Union the laps of many races into one table.

    ``source`` is a DataFrame, one dataset path (ideally partitioned by
    GrandPrix/Session so the filter prunes partitions), or a list of per-race
    paths: plain folders or partition folders (``.../GrandPrix=Monaco``), whose
    partition values become columns.  ``races`` filters GrandPrix (None = all races
    present; ``DEFAULT_2024_RACES`` is the reference's season); ``session`` filters
    Session.  A path that is missing or can't be read is left out, and (path, reason)
    is appended to ``skipped``; nothing left gives None.  ``schema`` is declared, not
    merged from the files; a column that a dataset lacks is NULL.
    """
    if isinstance(source, DataFrame):
        df = source
    else:
        df = None
        # one scan per common root: partition values of a folder's path are columns only below a base path
        roots: dict[str, list[str]] = {}
        paths = [source] if isinstance(source, str) else list(source)
        bad = unreadable_paths(spark, paths, fmt)
        for path in paths:
            if path not in bad:
                root = re.split(r"/[^/=]+=[^/]*", path, maxsplit=1)[0]
                roots.setdefault(root if root != path else "", []).append(path)
            elif skipped is not None:
                skipped.append((path, bad[path]))
        for root, paths in roots.items():
            reader = spark.read.format(fmt)
            reader = reader.schema(schema) if schema is not None else reader
            part = (reader.option("basePath", root) if root else reader).load(paths)
            df = part if df is None else df.unionByName(part, allowMissingColumns=True)
        if df is None:
            return None
    if races is not None:
        df = df.where(F.col("GrandPrix").isin(list(races)))
    if session is not None:
        df = df.where(F.col("Session") == F.lit(session))
    return df


def season_2024(spark: SparkSession, source: DataFrame | str | Sequence[str], session: str = "Race", **kw) -> DataFrame | None:
    """The reference's default season: ``DEFAULT_2024_RACES``, one session."""
    return load_season(spark, source, DEFAULT_2024_RACES, session, **kw)


def from_pandas(spark: SparkSession, pdf, schema: StructType | None = None) -> DataFrame:
    """In-memory pandas table to a DataFrame with a declared schema.

    Arrow transfer maps NaN/NaT to NULL; pandas timedeltas arrive as day-time
    intervals.  Only for small driver-side tables (fixtures, parameters).
    """
    return spark.createDataFrame(pdf, schema=schema) if schema is not None else spark.createDataFrame(pdf)


def to_seconds(df: DataFrame, columns: Iterable[str] = TIME_COLUMNS) -> DataFrame:
    """Turn interval (or float) time columns into double seconds, NaN -> NULL."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: as_seconds(df, c) for c in present}) if present else df


def bronze_laps(df: DataFrame, source: str = DEFAULT_RECORD_SOURCE,
                columns: Iterable[str] = TIME_COLUMNS) -> DataFrame:
    """Bronze layer (S3): seconds for lap and sector times plus ingestion metadata.

    Returns a new plan; the caller's frame is never mutated.
    """
    return to_seconds(df, columns).withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "record_source": F.lit(source),
    })
