"""Permit classification on hand-made permits."""

import pytest

from leadpanel.functions.permit_rules import FLAGS
from leadpanel.operators.permits import classify, explode_types

# (category, description, value, types)
CASES = [
    # Photovoltaics, with and without a word for it.
    ("building misc", "Photovoltaic system on a detached barn", 18250.0, "solar"),
    ("energy efficient system", "Rooftop PV, string inverter in the laundry", 14120.0, "solar"),
    ("building misc", "Rails and inverter rated 3.84 kw", 11240.0, "solar"),
    ("building misc", "Enphase gear on the carport", 13333.0, "solar"),
    ("building misc", "Ground frame with 17 modules", 10110.0, "solar"),
    ("building misc", "Feed of 14 kw for the kiln shed", 2750.0, "other"),
    ("building misc", "Solar array of 2.2 kw on a tiny house", 2750.0, "solar"),
    # The category alone counts only for a blank text and a likely amount.
    ("energy efficient system", None, 6999.0, "other"),
    ("energy efficient system", "   ", 34999.0, "solar"),
    ("energy efficient system", "", 35001.0, "other"),
    ("energy efficient system", None, None, "other"),
    # Heat from the sun is no photovoltaics.
    ("plumbing", "Solar thermal loop for the bath house", 6100.0, "water_heater,remodel"),
    ("plumbing", "Thermal collector beside PV strings", 16400.0, "other"),
    # Storage.
    ("building misc", "Photovoltaic system plus energy storage", 52100.0, "solar,battery"),
    ("building misc", "Battery of 9.7 kwh in the cellar", 8800.0, "battery"),
    ("building misc", "Solar system of 6.1 kw, no battery", 15750.0, "solar"),
    ("building misc", "Board and batten over battery shed door", 1900.0, "envelope"),
    # Vehicles, engines, service.
    ("building misc", "Wallbox in the left bay", 1150.0, "ev_charger"),
    ("building misc", "Genset of 11 kw behind the fence", 7300.0, "generator"),
    ("building misc", "Meter socket and service upgrade", 3150.0, "electrical"),
    ("building misc", "Relocate one small panel", 1250.0, "electrical"),
    # Roofs by category or by text.
    ("reroof", "Slate, north side", 21100.0, "roof"),
    (None, "Slate, south side", 21100.0, "other"),
    (None, "New underlayment over the porch", 5150.0, "roof"),
    # Heat and hot water.
    ("heating system", "", 5150.0, "hvac"),
    ("heating system", "Boiler exchange", 6150.0, "hvac"),
    ("heating system", "Minisplit for the loft", 6150.0, "heat_pump"),
    ("plumbing", "HPWH in the pantry", 4150.0, "water_heater"),
    ("plumbing", "Tankless on the outer wall", 2890.0, "water_heater"),
    ("plumbing", "Swamp cooler exchange", 1790.0, "hvac"),
    # Rooms, shells, water.
    ("building misc", "Genuine accessory dwelling over the garage", 91500.0, "construction"),
    ("building misc", "Renovation of the upper floor", 31500.0, "remodel"),
    ("building misc", "Weatherization of the crawl space", 3690.0, "envelope"),
    ("building misc", "Spa set on the terrace", 9450.0, "pool"),
    ("building misc", "Outlet for a spa", 640.0, "other"),
    ("building misc", "Lap lane, pool of 12 metres", 61500.0, "pool"),
    (None, None, None, "other"),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(i, f"home{i}", c, d, v) for i, (c, d, v, _) in enumerate(CASES)]
    df = spark.createDataFrame(
        rows, "i int, strap string, permit_category string, description string, estimated_value double")
    return {r["i"]: r for r in classify(df).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_types(classified, i):
    assert classified[i]["permit_type"] == CASES[i][3], CASES[i]


def test_flags_are_zero_or_one(classified):
    assert all(r[f] in (0, 1) for r in classified.values() for f in FLAGS)


def test_heat_pump_water_heater_is_not_a_heat_pump(classified):
    row = next(r for r in classified.values() if r["description"] == "HPWH in the pantry")
    assert (row["heat_pump"], row["water_heater_electric"]) == (0, 1)


def test_explode_and_empty(spark):
    df = spark.createDataFrame([("a", "solar, battery"), ("b", "other")], "permit_num string, permit_type string")
    assert sorted(map(tuple, explode_types(df).collect())) == [("a", "battery"), ("a", "solar"), ("b", "other")]
    assert explode_types(df.limit(0)).count() == 0
