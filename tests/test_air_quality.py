from __future__ import annotations

from datetime import UTC, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.functions.instants import instant_micros
from loamline.operators.spikes import flag_implausible
from loamline.operators.time_grid import regular_grid

READINGS = "reading_id long, sensor_id long, timestamp string, pm10 double, pm2_5 double, humidity_pct double, temp_c double"


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2021-01-04 00:00:17", "2021-01-04T00:00:17"), ("2021-01-04T03:08:12+03:00", "2021-01-04T00:08:12"), ("20210104T000656Z", "2021-01-04T00:06:56"),
        ("04.01.2021 00:06:54", "2021-01-04T00:06:54"), ("1609719047000", "2021-01-04T00:10:47"), ("1609718764", "2021-01-04T00:06:04"), ("2021-01-04 05", "2021-01-04T05:00:00"),
        ("2021/1/4 5:06:07 EAT", "2021-01-04T02:06:07"), ("2021-01-04T03:08:12-03", "2021-01-04T06:08:12"), ("2021-01", None), ("2021-01-04", None), ("", None), ("n/a", None),
        (None, None), ("2023-13-45T99:00:00", None), ("31.02.2021 10:00:00", None),
    ],
)
def test_instants(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(instant_micros("t").alias("m")).first()["m"]
    assert got == (None if want is None else int(datetime.fromisoformat(want).replace(tzinfo=UTC).timestamp() * 1e6))


def test_grid_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = int(datetime(2021, 5, 1, tzinfo=UTC).timestamp())
    rows = [(int(s), int(base + rng.integers(0, 60) * 3600 + rng.integers(0, 3600)), float(rng.normal())) for s in (1, 2, 2, 2) for _ in range(15)]
    rows += [(1, base, float("nan")), (1, None, 1.0), (None, base, 1.0), (1, 3, 5.0), (3, base, None)]
    df = spark.createDataFrame(rows, "s long, t long, v double").withColumns({"value": F.lit("x"), "_k": F.lit(1), "status": F.lit(0)})
    got = {(r["s"], r["slot"]): (r["status"], r["n_readings"], r["value"]) for r in regular_grid(df, "s", F.col("t") * 1_000_000, F.col("v"), max_gap_steps=2).collect()}
    want = {}
    for s in (1, 2):
        held: dict[int, list[float]] = {}
        for a, t, v in rows:
            if a == s and t is not None and t >= 1609459200 and v is not None and not np.isnan(v):
                held.setdefault(t // 3600, []).append(v)
        last = None
        for k in range(min(held), max(held) + 1):
            last = k if k in held else last
            status = "observed" if k in held else "filled" if k - last <= 2 else "missing"
            value = np.mean(held[last]) if status != "missing" else None
            want[(s, datetime.fromtimestamp(k * 3600, UTC).replace(tzinfo=None))] = (status, len(held.get(k, [])), value)
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert all((got[k][2] is None) == (want[k][2] is None) and (want[k][2] is None or abs(got[k][2] - want[k][2]) < 1e-9) for k in want)


def test_grid_of_nothing(spark):
    assert regular_grid(spark.createDataFrame([], "s long, t long, v double"), "s", F.col("t"), F.col("v")).count() == 0


def series(n: int = 3000, sensor: int = 1, seed: int = 0):
    rng = np.random.default_rng(seed)
    base = int(datetime(2021, 5, 1, tzinfo=UTC).timestamp())
    level = 20 * np.exp(0.4 * np.sin(np.arange(n) / 90) + rng.normal(0, 0.1, n))
    temp = 20 + 5 * np.sin(np.arange(n) / 90) + rng.normal(0, 0.2, n)
    return [
        [sensor * 100_000 + i, sensor, str(base + i * 300), float(level[i] * 1.6), float(level[i]), float(50 + rng.normal()), float(temp[i])] for i in range(n)
    ]


def planted():
    rows, want = series(), set()
    for i in (200, 700, 701, 1500, 1501, 1502):
        rows[i][4] *= 12
        want.add((rows[i][0], "pm2_5"))
    for i in range(900, 904):  # four high readings are a rise, not a spike
        rows[i][6] += 1.0
    for i in range(2000, 2020):
        rows[i][5] = 47.25
        want.add((rows[i][0], "humidity_pct"))
    rows[2500][6] = -999.0
    want.add((rows[2500][0], "temp_c"))
    rows[2600][2] = "never"  # no place in the order, but impossible all the same
    rows[2600][3] = -5.0
    want.add((rows[2600][0], "pm10"))
    rows[100][4] = None
    rows[101][4] = float("nan")
    again = list(rows[200])  # sent twice: both count
    again[0] = 999_999
    want.add((999_999, "pm2_5"))
    return [*rows, again, [None, 1, "1620000000", -1.0, None, None, None], [5, None, "1620000000", -1.0, None, None, None]], want


def flagged(df, **how):
    return {(r["reading_id"], r["measure"]) for r in flag_implausible(df, "sensor_id", "reading_id", instant_micros("timestamp"), **how).collect()}


def test_planted_faults_are_found_whatever_the_blocks(spark):
    rows, want = planted()
    df = spark.createDataFrame(rows, READINGS).withColumns({"far": F.lit("x"), "_block": F.lit(7), "kind": F.lit("k")})
    assert flagged(df) == want
    assert flagged(df, rows_per_block=300) == want  # cut into ten blocks with halos


@pytest.mark.parametrize("rows_per_block", [300, 20_000])
def test_the_sources_own_fence_decides(spark, rows_per_block):
    quiet, loud, want = series(sensor=1), series(sensor=2, seed=1), set()
    rng = np.random.default_rng(5)
    for r in loud:  # a sensor that varies so much that the same jumps are usual
        r[3], r[4], r[5], r[6] = float(30 * np.exp(rng.normal(0, 0.8))), float(20 * np.exp(rng.normal(0, 0.8))), float(50 + rng.normal(0, 12)), float(20 + rng.normal(0, 6))
    for rows in (quiet, loud):
        rows[400][4], rows[600][3] = rows[399][4] * 3.5, rows[599][3] * 3.5
        rows[800][6] = rows[799][6] + 9
        rows[1000][5] = rows[999][5] + 22
    want = {(quiet[i][0], m) for i, m in ((400, "pm2_5"), (600, "pm10"), (800, "temp_c"), (1000, "humidity_pct"))}
    for n, at in ((4, 1300), (5, 1400), (6, 1500), (7, 1600)):  # more than three readings are a rise
        for i in range(at, at + n):
            quiet[i][6] += 9
    got = flagged(spark.createDataFrame(quiet + loud, READINGS), rows_per_block=rows_per_block)
    assert {x for x in got if x[0] < 200_000} == want
    assert not {(loud[i][0], m) for i, m in ((400, "pm2_5"), (600, "pm10"), (800, "temp_c"), (1000, "humidity_pct"))} & got


def test_the_blocks_never_decide(spark):
    """Sparse measures, long stuck runs, nulls, repeated rows: the same verdicts however the time line is cut."""
    rng, rows = np.random.default_rng(11), series(1200)
    for i, r in enumerate(rows):
        if i % 10:
            r[5] = None  # a measure in every tenth row only
        elif 300 <= i < 460:
            r[5] = 44.5  # 16 equal values of it
        if 100 <= i < 500:
            r[6] = 21.25
        if i in (99, 501, 640, 641):
            r[6] = 35.0
        if rng.random() < 0.02:
            r[4] *= 9
    rows += [[900_000 + i, *r[1:]] for i, r in enumerate(rows) if i % 7 == 0]
    rows += [[800_000 + i, 1, None, 20.0, 20.0, 50.0, 20.0] for i in range(900)]  # more rows without an instant than a block holds
    df = spark.createDataFrame(rows, READINGS)
    whole = flagged(df)
    assert sum(m == "humidity_pct" for _, m in whole) == 16 + 2  # two of the rows were sent twice
    assert flagged(df, rows_per_block=90) == whole
    assert flagged(df, rows_per_block=400) == whole


def test_a_finer_slot_cuts_a_crowded_hour(spark):
    rows = series(2500)
    for i, r in enumerate(rows):
        r[2] = str(1620000000 + i)  # a reading each second
    rows[1000][6] += 15
    df = spark.createDataFrame(rows, READINGS)
    assert flagged(df, rows_per_block=200) == flagged(df) == {(rows[1000][0], "temp_c")}


def test_spikes_of_nothing(spark):
    assert flagged(spark.createDataFrame([], READINGS)) == set()
    assert flagged(spark.createDataFrame([[1, 1, None, None, None, None, None], [2, 1, "1620000000", 1.0, 1.0, 1.0, 1.0]], READINGS)) == set()
