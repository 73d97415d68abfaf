"""Nearest place against brute force, and what it holds while it runs."""

from __future__ import annotations

import numpy as np
import pytest

from loamline.operators import places
from loamline.plans.soil import nearest


def brute(lat, lon, site_lat, site_lon):
    """Number and squared distance of every point's nearest site."""
    d2 = (lat[:, None] - site_lat) ** 2 + (lon[:, None] - site_lon) ** 2
    return d2.argmin(axis=1), d2.min(axis=1)


def tables(spark, lat, lon, site_lat, site_lon):
    points = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(zip(lat, lon))], "id long, lat double, lon double")
    return points, spark.createDataFrame([(100 + i, *map(float, x)) for i, x in enumerate(zip(site_lat, site_lon))], "site long, lat double, lon double")


def wanted(lat, lon, site_lat, site_lon):
    number, d2 = brute(lat, lon, site_lat, site_lon)
    return {i: (100 + n, d) for i, (n, d) in enumerate(zip(number.tolist(), np.sqrt(d2).tolist()))}


def found(df):
    return {r["id"]: (r["site"], r["distance"]) for r in df.collect()}


def memory_of_stages(spark, since=-1):
    """Number of the last stage, and the most execution memory that the tasks of a later stage than ``since`` held together."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    stages = [stages.apply(i) for i in range(stages.size())]
    return max((s.stageId() for s in stages), default=-1), max((s.peakExecutionMemory() for s in stages if s.stageId() > since), default=0)


def test_crowded_sites_form_no_pairs(spark):
    """All within one cell of 10 degrees, as 1,111 sites a cell are at 60 times sf0.1: pairs, four million here, were sorted by point and filled the disk."""
    rng = np.random.default_rng(5)
    lat, lon, site_lat, site_lon = rng.integers(0, 900, (4, 2000)) / 100
    points, sites = tables(spark, lat, lon, site_lat, site_lon)
    last, _ = memory_of_stages(spark)
    assert found(nearest(points, sites, 10.0)) == wanted(lat, lon, site_lat, site_lon)
    assert 0 < memory_of_stages(spark, last)[1] < 100_000_000


@pytest.mark.parametrize("block", [500_000, 40])
def test_ties_go_to_the_lower_site_in_any_block(spark, monkeypatch, block):
    monkeypatch.setattr(places, "MAX_BLOCK_SITES", block)
    rng = np.random.default_rng(6)
    lat, lon, site_lat, site_lon = (rng.integers(-9, 9, n) / 2 for n in (300, 300, 150, 150))
    assert found(nearest(*tables(spark, lat, lon, site_lat, site_lon))) == wanted(lat, lon, site_lat, site_lon)


def test_ids_that_are_missing_or_repeated(spark):
    points = spark.createDataFrame([(None, 0.0, 0.0), (1, 0.0, 3.0), (1, 50.0, 0.0), (1, 0.0, 7.0)], "id long, lat double, lon double")
    sites = spark.createDataFrame([(7, 0.0, 1.0), (8, 0.0, 8.5)], "site long, lat double, lon double")
    assert found(nearest(points, sites, 1.0)) == {None: (7, 1.0), 1: (8, 1.5)}


@pytest.mark.parametrize("pairs", [250_000, 50])
@pytest.mark.parametrize("n", [1, 8, 9, 17, 1000])
def test_boxes_equal_brute_force(monkeypatch, n, pairs):
    monkeypatch.setattr(places, "MAX_PAIRS", pairs)
    rng = np.random.default_rng(n)
    circle = rng.uniform(0, 2 * np.pi, n)
    for site_lat, site_lon in (
        (rng.uniform(-30, 30, n), rng.uniform(-45, 45, n)), (rng.integers(-9, 9, n) / 0.3, rng.integers(-9, 9, n) / 0.3),
        (40 + rng.random(n) * 1e-6, rng.random(n) * 1e-6), (np.zeros(n), rng.random(n) ** 9), (np.cos(circle), np.sin(circle)), (np.full(n, 2.0), np.full(n, 3.0)),
    ):
        lat, lon = np.r_[rng.uniform(-30, 30, 60), np.zeros(5), site_lat[:5]], np.r_[rng.uniform(-45, 45, 60), np.zeros(5), site_lon[:5]]
        for got, want in zip(places.Boxes(site_lat, site_lon).nearest(lat, lon), brute(lat, lon, site_lat, site_lon)):
            assert (got == want).all()
