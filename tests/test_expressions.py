"""Expressions on literal cases."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from leadpanel.functions import dates as D
from leadpanel.functions import geo as G
from leadpanel.functions import roof as R
from leadpanel.functions import text as X
from leadpanel.operators import features as W


def each(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(df.select("i", make(F.col("v")).alias("o")).collect())]


def test_sale_year(spark):
    values = ["6/4/13", "6/4/95", "6/4/1987", "2015-03-02", "3.4.49", "3-4-50", "6/4", "x/y/z", "", None, "1850-01-60", "2101-01-01", "6/4/2101"]
    assert each(spark, values, D.sale_year) == [2013, 1995, 1987, 2015, 2049, 1950, None, None, None, None, 1960, None, None]


def test_effective_year(spark):
    assert each(spark, ["1999", "7/1/2004", "3.4.12", "", None, "1800"], D.effective_year) == [1999, 2004, 2012, None, None, None]


def test_issue_dates(spark):
    clean = lambda v: D.clean_issue_date(v, 2020)
    assert each(spark, ["2019-05-06", "5/6/2019", "1899-12-30", "2021-01-01", "soon", None], clean) == [
        datetime.date(2019, 5, 6), datetime.date(2019, 5, 6), None, None, None, None]


OWNERS = {
    "SMITH JOHN": ("Smith, John", None),
    "SMITH JOHN & MARY": ("Smith, John", "Smith, Mary"),
    "SMITH JOHN & MARY K": ("Smith, John", "Smith, Mary K"),
    "SMITH JOHN & MARY JONES": ("Smith, John", "Jones, Mary"),
    "SMITH JOHN & ANN B. COLE": ("Smith, John", "Cole, Ann B."),
    "ACME HOLDINGS LLC": ("ACME HOLDINGS LLC", None),
    "SMITH LIVING TRUST": ("SMITH LIVING TRUST", None),
    "CHER": ("Cher", None),
    "  ": (None, None),
    None: (None, None),
}


def test_owner_pair(spark):
    got = each(spark, list(OWNERS), X.owner_pair)
    assert [tuple(g) for g in got] == list(OWNERS.values())


PEOPLE = {
    "SMITH, JOHN Q": [("John", "Q", "Smith")],
    "SMITH, JOHN & MARY": [("John", "", "Smith"), ("Mary", "", "Smith")],
    "SMITH, JOHN & DOE, JANE R": [("John", "", "Smith"), ("Jane", "R", "Doe")],
    "SMITH, JOHN & ANN B COLE": [("John", "", "Smith"), ("Ann", "B", "Cole")],
    "SMITH JOHN AND MARY": [("John", "", "Smith"), ("Mary", "", "Smith")],
    "SMITH JOHN & MARY K": [("John", "", "Smith"), ("Mary", "K", "Smith")],
    "SMITH JOHN & MARY JONES": [("John", "", "Smith"), ("Mary", "", "Jones")],
    "SMITH JOHN & MARY ANN SMITH": [("John", "", "Smith"), ("Mary", "Ann", "Smith")],
    "SMITH JOHN & MARY ANN LEE": [("John", "", "Smith"), ("Mary", "Ann Lee", "Smith")],
    "O'NEIL PAT": [("Pat", "", "O'Neil")],
    "CHER": [("", "", "Cher")],
    "SMITH FAMILY TRUST": [], "": [], None: [],
}


def test_owner_people(spark):
    assert [[tuple(p) for p in g] for g in each(spark, list(PEOPLE), X.owner_people)] == list(PEOPLE.values())


def test_subdivision(spark):
    got = each(spark, ["OAK HILL FILING 3", "heart of", "Park Place West End", "A B C", "", None], X.subdivision_name)
    assert got == ["Oak Hill", "Heart", "Park Place West", "", "", None]


def test_index_from_file(spark):
    got = each(spark, ["42_original_index.png", "COUNTY_CO_17.png", "pic9z.jpg", "none.png"], X.index_from_file)
    assert got == [42, 17, 9, None]


def test_display_text(spark):
    assert each(spark, ["1234567", "12.6", "x", "", None], X.money) == ["$1,234,567", "$13", "$x", "—", "—"]


def test_haversine(spark):
    row = spark.range(1).select(
        G.miles(F.lit(40.0), F.lit(-105.0), F.lit(41.0), F.lit(-105.0)).alias("north"),
        G.miles(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("half"),
        G.metres(F.lit(40.0), F.lit(-105.0), F.lit(40.0), F.lit(-105.0)).alias("none")).first()
    assert row["north"] == pytest.approx(math.radians(1) * 3958.8)
    assert row["half"] == pytest.approx(math.pi * 3958.8)
    assert row["none"] == 0


SEGMENT = "array<struct<azimuth:double,area:double,avg_sun:double>>"


def roofs(spark, *lists):
    return spark.createDataFrame([(i, l) for i, l in enumerate(lists)], f"i int, s {SEGMENT}")


def test_orientations(spark):
    df = roofs(spark, [(140.0, 50.0, 1500.0)], [(220.0, 20.0, 1500.0)], [(20.0, 50.0, 1500.0)], [(None, 9.0, 1.0)], [])
    rows = df.select("i", R.orientations_inclusive(F.col("s")), R.orientations_inclusive(F.col("s"), 30.0), R.orientations_exclusive(F.col("s"))).collect()
    assert [tuple(r)[1:] for r in sorted(rows)] == [
        ("East, South", "East, South", "South"), ("South, West", "", "South"), ("", "", ""), ("", "", ""), ("", "", "")]


def test_roof_score(spark):
    df = roofs(spark, [], [(180.0, 100.0, 1800.0)], [(180.0, 1.0, None)], [(180.0, 100.0, 1800.0), (90.0, 100.0, 1800.0)])
    got = [r[1] for r in sorted(df.select("i", R.roof_score(F.col("s"))).collect())]
    assert got[0] == 10 and got[2] == 10
    assert got[1] == pytest.approx(min(100, 100**0.55 / 14 * 100), abs=0.01)
    east = 1 - 0.65 * 0.9**1.2
    assert got[3] == pytest.approx((100 * (1 + east)) ** 0.55 * 0.875 / 14 * 100, abs=0.01)


def test_solar_score(spark):
    df = roofs(spark, [(180.0, 60.0, 1800.0)], [(180.0, 15.0, 1800.0)], [(10.0, 60.0, 1800.0)])
    got = [r[1] for r in sorted(df.select("i", R.solar_score(F.col("s"), F.lit(3))).collect())]
    assert got == [pytest.approx(100 + 150 - 9 / 15), pytest.approx((250 - 9 / 15) / 2, abs=0.01), 10]


def test_response_cells(spark):
    cells = ['{"Avg": 5}', '{"Avg": 0, "avg": 7}', '{"avg": 0}', "broken", None]
    assert each(spark, cells, R.stat_average) == [5, 7, 0, None, None]


def test_model_answers(spark):
    texts = ['```json\n{"solar": "Yes", "solar_confidence": 3}\n```', '{"solar_panels": "maybe", "roof_condition": "Poor"}', "", None]
    got = each(spark, texts, W.read_model_response)
    assert [(g["solar_panels"], g["solar_confidence"], g["roof_condition"]) for g in got] == [
        ("Yes", 1.0, "Unknown"), ("No", 0.0, "Poor"), ("No", 0.0, "Unknown"), ("No", 0.0, "Unknown")]


def test_top_segments_of_a_hot_roof(spark):
    """A third of all rows on one roof: the 25 largest are kept, the count is whole."""
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("original_index"), F.col("id").alias("idx"),
        F.lit(180.0).alias("azimuth"), F.col("id").cast("double").alias("area"), F.lit(1500.0).alias("avg_sun"), F.col("id").alias("tie"))
    row = W.roofs_from_segments(rows).where("original_index = 0").first()
    assert row["segment_count"] == 1000
    assert sorted(s["area"] for s in row["segments"]) == [float(3 * i) for i in range(975, 1000)]


def test_scores_of_segment_rows_are_those_of_segment_arrays(spark):
    """All 40 segments of a roof count, odd azimuths, areas and nulls among them."""
    rows = [(roof, i, float(az), area, sun, i) for roof in range(4) for i, (az, area, sun) in enumerate(
        [(az, 7.0 * i - 3 * roof, 900.0 + 11 * i) for i, az in enumerate(range(0, 360, 10))]
        + [(140, 30.0, 1500.0), (220, 29.0, None), (180, None, 1400.0), (80, 30.0, 1000.0)])]
    rows += [(9, 0, None, 10.0, 1.0, 0), (9, 1, 20.0, 10.0, 1.0, 1)]
    table = spark.createDataFrame(rows, "original_index bigint, idx int, azimuth double, area double, avg_sun double, tie int")
    arrays = table.groupBy("original_index").agg(F.collect_list(F.struct("azimuth", "area", "avg_sun")).alias("s"))
    found = R.matching(F.col("s"))
    want = arrays.select(
        "original_index", R.orientations_inclusive(F.col("s")).alias("inclusive"),
        R.orientations_inclusive(F.col("s"), R.MIN_AREA).alias("large"), R.orientations_exclusive(F.col("s")).alias("exclusive"),
        F.size(found).alias("n_matching"), F.round(R.area_sum(found), 2).alias("area_sum"), F.round(R.area_max(found), 2).alias("area_max"),
        R.roof_score(F.col("s")).alias("roof_score"), R.solar_score(F.col("s"), F.size("s")).alias("solar_score")).orderBy("original_index")
    got = W.roof_profiles(table).join(W.solar_scores(table), "original_index").select(*want.columns).orderBy("original_index")
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
    plan = W.roof_profiles(table)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "Window" not in plan
