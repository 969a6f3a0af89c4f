"""Promised checks of the reference and nearest weather, against plain versions on awkward rows."""

import math
import random

import pytest

from pitlane.operators import enrich, quality

LAP = ("GrandPrix string, Session string, Driver string, LapNumber double, Time double, LapTime double, Stint double, "
       "TyreLife double, Compound string, PitInTime double, PitOutTime double")
KEYS = ("GrandPrix", "Session", "Driver")


def lap_rows(seed=3, n=160):
    """Drivers with gaps in lap numbers, nulls, pit stops that do and don't agree with stints and tyre ages."""
    rng, rows = random.Random(seed), []
    for d in ("A", "B", "C", None):
        stint, age, comp, number, t = 1, 1, "SOFT", 0, 0.0
        for _ in range(n if d != "C" else 1):
            number += rng.choice([1, 1, 1, 7])
            took = rng.uniform(70, 95)
            t += took
            pit = rng.random() < 0.15
            rows.append(("g", "s", d, float(number), rng.choice([t, t, None]), rng.choice([took, took, took, 0.0]),
                         rng.choice([float(stint)] * 8 + [None]), rng.choice([float(age)] * 8 + [None]), rng.choice([comp] * 8 + [None]),
                         t if pit else None, t + rng.choice([3.0, 25.0]) if rng.random() < 0.2 else t - rng.choice([60, 75, 200]) if rng.random() < 0.3 else None))
            age += 1
            if pit and rng.random() < 0.8:
                age, comp = rng.choice([1, 3]), rng.choice(["SOFT", "HARD", "WET"])
            if (pit and rng.random() < 0.8) or rng.random() < 0.05:
                stint += 1
            if rng.random() < 0.06:
                comp = rng.choice(["SOFT", "HARD", "WET"])
            if rng.random() < 0.06:
                age = 1
    rows.append(("g", "s", "A", None, 1.0, 1.0, 1.0, 1.0, "SOFT", 1.0, 2.0))
    return rows


@pytest.fixture(scope="module")
def laps(spark):
    return lap_rows(), spark.createDataFrame(lap_rows(), LAP).repartition(5).checkpoint()


def by_driver(rows):
    out = {}
    for r in rows:
        if r[2] is not None and r[3] is not None:
            out.setdefault(r[:3], []).append(r)
    return {k: sorted(v, key=lambda r: r[3]) for k, v in out.items()}


def test_tyre_rule_breaks(laps):
    rows, df = laps
    want = []
    for key, own in by_driver(rows).items():
        derived = 1
        for was, now in zip([None, *own], own):
            found = []
            if was:
                pit = was[9] is not None
                moved = None not in (was[8], now[8]) and was[8] != now[8]
                derived += pit or moved
                stints, ages = None not in (was[6], now[6]), None not in (was[7], now[7])
                found = [name for name, hit in [
                    ("stint change without pit stop", not pit and stints and now[6] != was[6]),
                    ("pit stop without stint change", pit and stints and now[6] == was[6]),
                    ("compound change without pit stop", not pit and moved),
                    ("tyre life not reset after pit stop", pit and ages and now[7] > was[7]),
                    ("tyre life reset without pit stop", not pit and ages and now[7] < was[7])] if hit]
            want += [(*key, now[3], derived, now[6], now[7], f) for f in found]
    assert len({w[-1] for w in want}) == 5
    for width in (1.0, 10.0, 1e6):  # a bucket per lap number, several, one
        got = [tuple(r) for r in quality.tyre_rule_breaks(df, width=width).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_pit_durations(laps):
    rows, df = laps
    want = []
    for key, own in by_driver(rows).items():
        for now, after in zip(own, [*own[1:], None]):
            if now[9] is not None:
                out = now[10] if now[10] is not None and now[10] >= now[9] else after[10] if after else None
                took = None if out is None else out - now[9]
                verdict = "open" if took is None else "negative" if took < 0 else "short" if took < 15 else "ok"
                want.append((*key, now[3], now[9], out, took, verdict))
    assert {w[-1] for w in want} == {"open", "negative", "short", "ok"}
    for width in (1.0, 16.0, 1e6):
        got = [tuple(r) for r in quality.pit_durations(df, width=width).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


SAMPLES = "GrandPrix string, Session string, WeatherId long, Time double, AirTemp double, Rainfall boolean"


def sample_rows():
    rng = random.Random(8)
    rows = [("g", "s", i, rng.choice([float(rng.randint(0, 9000)), rng.uniform(0, 9000)]), float(i), rng.random() < 0.4) for i in range(90)]
    rows += [("g", "s", 200 + i, rows[i][3], -1.0, rng.random() < 0.5) for i in range(20)]  # ties on time
    return rows + [("g", "s", 300, None, 0.0, True), ("g", "s", 301, 50.0, 0.0, None), ("other", "s", 302, 1.0, 0.0, True)]


def test_weather_nearest(spark, laps):
    rows, df = laps
    samples = sample_rows()
    weather = spark.createDataFrame(samples, SAMPLES)
    extra = spark.createDataFrame([("none", "s", "A", 1.0, 5.0, *[None] * 6)], LAP)
    for tolerance, bucket in ((None, 4), (30.0, 1 << 15)):
        got = enrich.weather_nearest(df.union(extra), weather, tolerance=tolerance, bucket_values=bucket).collect()
        assert len(got) == len(rows) + 1
        for r in got:
            near = [(abs(s[3] - r.Time), s[3], -s[2]) for s in samples if s[:2] == (r.GrandPrix, r.Session) and s[3] is not None] \
                if r.Time is not None else []
            best = min(near, default=None)
            if best is None or tolerance is not None and best[0] > tolerance:
                assert r.WeatherId is None and r.AirTemp is None
            else:
                assert (r.WeatherTime, r.WeatherId) == (best[1], -best[2])


def test_track_conditions(spark, laps):
    rows, df = laps
    samples = sample_rows()
    weather = spark.createDataFrame(samples, SAMPLES)
    latest = {}
    for s in sorted((s for s in samples if s[0] == "g" and s[3] is not None and s[5] is not None), key=lambda s: s[2]):
        latest[s[3]] = s[5]
    times = sorted(latest)
    spans = [(a, b, latest[a]) for a, b in zip(times, [*times[1:], math.inf])]
    some = spark.createDataFrame([("dry", "s", "A", 1.0, 100.0, 90.0, *[None] * 5)], LAP)
    for seconds, share in ((60.0, 1024), (1e5, 2), (700.0, 40)):  # fine bins, one hot bin that is split, some of them hot
        got = enrich.track_conditions(df.union(some), weather, bin_seconds=seconds, share=share).collect()
        assert len(got) == len(rows) + 1
        for r in got:
            met = [] if r.Time is None or r.GrandPrix != "g" or not r.LapTime > 0 else [
                (min(b, r.Time) - max(a, r.Time - r.LapTime), wet) for a, b, wet in spans if a < r.Time and b > r.Time - r.LapTime]
            kinds = {w for _, w in met}
            condition = "unknown" if not met else "mixed" if len(kinds) == 2 else "wet" if True in kinds else "dry"
            assert r.Condition == condition
            if met:
                assert abs(r.CoveredSeconds - sum(s for s, _ in met)) < 1e-6
                assert abs(r.WetSeconds - sum(s for s, w in met if w)) < 1e-6
            else:
                assert r.CoveredSeconds is None
            wet_tyre = r.Compound in ("WET", "INTERMEDIATE")
            want = None if r.Compound is None else "dry-weather tyre on a wet track" if condition == "wet" and not wet_tyre else \
                "wet-weather tyre on a dry track" if condition == "dry" and wet_tyre else None
            assert r.TyreIssue == want


def test_no_nested_loop_join(spark, laps):
    weather = spark.createDataFrame(sample_rows(), SAMPLES)
    plan = enrich.track_conditions(laps[1], weather)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_tables(spark):
    none, weather = spark.createDataFrame([], LAP), spark.createDataFrame(sample_rows(), SAMPLES)
    assert quality.tyre_rule_breaks(none).count() == quality.pit_durations(none).count() == 0
    assert enrich.track_conditions(none, weather).count() == enrich.weather_nearest(none, weather).count() == 0
    one = spark.createDataFrame([("g", "s", "A", 1.0, 5.0, 4.0, *[None] * 5)], LAP)
    assert enrich.track_conditions(one, weather.limit(0)).first().Condition == "unknown"
    assert enrich.weather_nearest(one, weather.limit(0)).first().WeatherId is None
