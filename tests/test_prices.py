from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loamline.catalog import Sources
from loamline.operators.measure_units import convert_prices, harmonise_prices, impute_units
from loamline.plans.market_prices import PRICES, REFERENCE

CASES = [  # unit, series name, currency, country -> factor to the common unit, factor to whole local currency
    ("50 kg", None, "KES", "KE", 50.0, 1.0), ("bag", None, "KES", "KE", 90.0, 1.0), ("sack of 25kg", None, "KES", "KE", 25.0, 1.0), ("1 sack (bag)", None, "KES", "UG", 100.0, None),
    ("2,5_kilogram", None, "senti", "KE", 2.5, 0.01), ("½ kg", None, "KES", "KE", 0.5, 1.0), ("1/2-litres", None, "UGX '000", "UG", 0.5, 1000.0), ("33 cl", None, "USD", "KE", 0.33, 130.0),
    ("per US gal", None, None, "KE", 3.785412, 1.0), ("jerrycan (5 L)", None, "Ksh.", "KE", 5.0, 1.0), ("5-litre jerrycan", None, "KES (senti)", "KE", 5.0, 0.01), ("dz", None, "KES", "KE", 12.0, 1.0),
    ("handful", "X, Retail, Maize, 2 kg, KES", "KES", "KE", None, 1.0), (" - ", "X, Retail, Maize grain, white per 25 kilo pack / KES", "KES", "KE", 25.0, 1.0),
    (None, "X, Retail, Beans, mixed - bag (60 kg), ZMW", "thousand ZMW", "ZM", 60.0, 1000.0), ("debe", None, "KES", "NG", None, None), ("6 x 500 ml", None, "KES", "KE", 3.0, 1.0), ("", "", "", "KE", None, 1.0),
    ("1,000 g", None, "KES", "KE", 1.0, 1.0), ("MT", None, "MT", "MZ", 1000.0, 1.0),
]


@pytest.fixture(scope="module")
def reference(spark, data):
    return Sources(spark, data).table(REFERENCE)


def test_units_and_currencies(spark, reference):
    rows = [(i, 100.0, u, n, c, cc, 130.0) for i, (u, n, c, cc, *_) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id int, value double, unit string, dataseries_name string, currency string, country_code string, exchange_rate double")
    df = df.withColumns({"status": F.lit("x"), "symbol": F.lit(1), "factor": F.lit(2), "measure": F.lit(3)})
    got = {r["id"]: r for r in convert_prices(df, reference).collect()}
    assert len(got) == len(CASES)
    for i, (*_, factor, money) in enumerate(CASES):
        r = got[i]
        assert (r["unit_factor"] is None) == (factor is None), CASES[i]
        assert factor is None or abs(r["unit_factor"] - factor) < 1e-6 * factor, CASES[i]
        assert (r["currency_factor"] is None) == (money is None), CASES[i]
        assert money is None or abs(r["currency_factor"] - money) < 1e-6 * money, CASES[i]
        if factor and money:
            assert abs(r["converted_price"] - 100 * money / factor) < 1e-6 * money / factor * 100 and r["status"] == "converted"


def test_most_prices_agree_and_the_others_are_far_off(spark, data, reference):
    df = convert_prices(Sources(spark, data).table(PRICES), reference).where("status = 'converted' and common_unit_price is not null")
    off = [abs(r["r"] - 1) for r in df.select((F.col("common_unit_price") / F.col("converted_price")).alias("r")).collect()]
    assert len(off) > 100 and sum(x < 0.006 for x in off) > 0.9 * len(off) and not [x for x in off if 0.006 <= x < 0.045]


def test_missing_units_are_decided_or_routed(spark, reference):
    at = Sources(spark, "/root/testdata/sf0.01")
    converted = convert_prices(at.table(PRICES), reference)
    rows = impute_units(converted).select("unit_factor", "model_factor", "decision").collect()
    sure = [r for r in rows if r["decision"] == "convert" and r["unit_factor"]]
    assert len(sure) > 20 and sum(abs(r["unit_factor"] / r["model_factor"] - 1) < 0.01 for r in sure) > 0.85 * len(sure)
    assert {r["decision"] for r in rows} <= {"convert", "review"}


def test_prices_of_nothing(spark, reference):
    empty = Sources(spark, "/root/testdata/sf0.001").table(PRICES).limit(0)
    assert convert_prices(empty, reference).count() == 0 and harmonise_prices(empty, reference).count() == 0
    assert impute_units(convert_prices(empty, reference)).count() == 0
