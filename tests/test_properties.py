"""Property tests: the skew-safe helpers against numpy / pandas on random data."""

import math

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pitlane.functions import group_quantiles, scan

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.integers(0, 30).map(float))), min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, bucket_values=st.sampled_from([1, 2, 5, 1 << 20]))
def test_quantiles_match_numpy(spark, rows, bucket_values):
    df = spark.createDataFrame(rows, "k string, v double")
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.k: r for r in group_quantiles(df, ["k"], "v", probs, bucket_values=bucket_values).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "v"]).dropna()
    want = {k: g["v"].to_numpy() for k, g in pdf.groupby("k")}
    assert set(got) == set(want)
    for k, vals in want.items():
        for name, p in probs.items():
            assert math.isclose(got[k][name], float(np.quantile(vals, p)), rel_tol=1e-12, abs_tol=1e-9)


SEQ = st.lists(st.tuples(st.sampled_from(["x", "y"]), st.one_of(st.none(), st.integers(50, 99).map(float))),
               min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=SEQ, width=st.sampled_from([1.0, 3.0, 1000.0]))
def test_scans_match_pandas(spark, rows, width):
    data = [(g, float(i), v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, o double, v double")
    out = scan.rolling_mean(df, ["g"], ["o"], "v", "r", 3, width)
    out = scan.running(out, ["g"], "o", "v", "min", "m", width)
    out = scan.lag(out, ["g"], ["o"], "v", "l", width)
    got = {r.o: r for r in out.collect()}
    pdf = pd.DataFrame(data, columns=["g", "o", "v"]).sort_values("o")
    grp = pdf.groupby("g")["v"]
    pdf["r"] = grp.transform(lambda s: s.rolling(3, min_periods=1).mean())
    pdf["m"] = grp.transform(lambda s: s.cummin().ffill().astype(float))
    pdf["l"] = grp.shift(1)

    def eq(a, b):
        a_nan = a is None or (isinstance(a, float) and math.isnan(a))
        b_nan = b is None or (isinstance(b, float) and math.isnan(b))
        return (a_nan and b_nan) or (not a_nan and not b_nan and math.isclose(a, b, rel_tol=1e-12))

    for _, row in pdf.iterrows():
        r = got[row.o]
        assert eq(r.r, row.r) and eq(r.m, row.m) and eq(r.l, row.l), (row.to_dict(), r)


LAPS = st.lists(st.tuples(st.sampled_from(["s1", "s2"]), st.one_of(st.none(), st.integers(0, 50).map(float))),
                min_size=1, max_size=30)
WX = st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.integers(0, 50).map(float)), min_size=0,
              max_size=20)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(laps=LAPS, wx=WX, bucket_values=st.sampled_from([1, 3, 1000]))
def test_asof_matches_brute_force(spark, laps, wx, bucket_values):
    from pitlane.operators import enrich
    lap_rows = [("G", s, f"D{i}", float(i), t) for i, (s, t) in enumerate(laps)]
    wx_rows = [("G", s, i, t, float(i)) for i, (s, t) in enumerate(wx)]
    ldf = spark.createDataFrame(lap_rows, "GrandPrix string, Session string, Driver string, LapNumber double, "
                                          "Time double")
    wdf = spark.createDataFrame(wx_rows, "GrandPrix string, Session string, WeatherId long, Time double, "
                                         "AirTemp double")
    got = {r.LapNumber: r.WeatherId for r in enrich.weather_asof(ldf, wdf, bucket_values=bucket_values).collect()}
    for _, s, _, n, t in lap_rows:
        cands = [(wt, wid) for _, ws, wid, wt, _ in wx_rows if ws == s and t is not None and wt <= t]
        assert got[n] == (max(cands)[1] if cands else None), (n, s, t)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ages=st.lists(st.integers(1, 30), min_size=1, max_size=8, unique=True),
       asks=st.lists(st.integers(0, 40), min_size=1, max_size=10))
def test_predict_pace_matches_numpy(spark, ages, asks):
    from pitlane.operators import strategy
    ages = sorted(ages)
    meds = [80.0 + 0.1 * a + (0.3 if a % 3 == 0 else 0.0) for a in ages]
    curve = spark.createDataFrame([("SOFT", float(a), m) for a, m in zip(ages, meds)],
                                  "Compound string, TyreLife double, MedianLapTime double")
    req = spark.createDataFrame([("SOFT", i, a) for i, a in enumerate(asks)], "Compound string, id int, TyreAge int")
    got = {r.id: r.PredictedLapTime for r in strategy.predict_pace(req, curve).collect()}
    for i, a in enumerate(asks):
        want = meds[-1] + 0.05 * (a - ages[-1]) if a > ages[-1] else float(np.interp(a, ages, meds))
        assert math.isclose(got[i], want, rel_tol=1e-12), (a, got[i], want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.one_of(st.integers(60, 120).map(float), st.floats(60, 120)), min_size=1, max_size=40),
       bins=st.sampled_from([3, 7, 30]))
def test_histogram_matches_numpy(spark, vals, bins):
    from pitlane.operators import compare
    df = spark.createDataFrame([("G", v) for v in vals], "GrandPrix string, LapTime double")
    got = [r.Count for r in compare.laptime_histogram(df, bins=bins).orderBy("Bin").collect()]
    want, _ = np.histogram(np.array(vals), bins=bins)
    assert got == list(want), (vals, bins)
