"""Yearly features, joins and upserts on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from leadpanel.operators import filters as L
from leadpanel.operators import joins as J
from leadpanel.operators import sampling as SA
from leadpanel.operators import windows as Y
from leadpanel.plans import panel as PL
from leadpanel.sources import io as IO


def series(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_roof_age_and_rate_follow_a_plain_loop(spark):
    rng = random.Random(11)
    years = list(range(2000, 2012))
    homes, want = [], {}
    rates = [round(rng.uniform(2, 8), 2) for _ in years]
    for i in range(60):
        built, sale = rng.choice([None, 1990, 2005, 2011]), rng.choice([None, 1999, 2003, 2010])
        events = [int(rng.random() < 0.2) for _ in years]
        age = held = None
        for y, e, r in zip(years, events, rates):
            if age is None:
                age, held = (0 if e or built is None else max(0, y - built)), r
            else:
                age = 0 if e else age + 1
                held = r if y == sale or r <= held - 0.75 else held
            want[(i, y)] = (age, held)
            homes.append((str(i), y, e, float(built) if built else None, sale))
    df = series(spark, homes, "strap string, year int, event int, built double, sale int")
    path = Y.held_rate(F.array(*[F.lit(r) for r in rates]), F.array(*[F.lit(y) for y in years]), F.col("sale"))
    got = df.select("strap", "year", Y.years_since_reset(F.col("event") == 1, "built").alias("a"),
                    F.get(path, F.col("year") - years[0]).alias("r")).collect()
    assert {(int(r["strap"]), r["year"]): (r["a"], r["r"]) for r in got} == want


def test_persistence_velocity_and_slope(spark):
    flags = [0, 1, 0, 0, 0, 1]
    values = [5.0, 7.0, 4.0, 4.0, 9.0, 1.0]
    df = series(spark, [("a", 2000 + i, f, v) for i, (f, v) in enumerate(zip(flags, values))], "strap string, year int, f int, v double")
    out = df.select("year", F.max("f").over(Y.last_rows(3)).alias("p"), Y.velocity(df, ["f"]).alias("s"),
                    Y.yearly_change("v").alias("d"), Y.three_year_slope("v").alias("k")).orderBy("year").collect()
    assert [r["p"] for r in out] == [0, 1, 1, 1, 0, 1]
    assert [r["s"] for r in out] == [0, 1, 1, 1, 0, 1]
    assert [r["d"] for r in out] == [0, 2, -3, 0, 5, -8]
    assert [r["k"] for r in out] == [0, 2, -0.5, -1.5, 2.5, -1.5]


def test_next_event_label(spark):
    df = series(spark, [(2001, y) for y in range(1999, 2003)] + [(None, 2000)], "f int, y int")
    assert [r[0] for r in df.select(Y.next_event_label(F.col("f"), F.col("y"))).collect()] == [0, 1, 2, 2, 0]


def test_upsert_last_wins_on_a_hot_key(spark):
    old = series(spark, [("a", 9, "old"), ("b", 1, "keep")], "k string, v int, t string")
    batch = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("v"), F.concat(F.lit("n"), F.col("id")).alias("t"))
    got = {r["k"]: (r["v"], r["t"]) for r in IO.upsert(old, batch, ["k"], "v").collect()}
    assert got == {"a": (999, "n999"), "b": (1, "keep")}
    assert IO.upsert(old, batch.limit(0), ["k"], "v").count() == 2


def test_upsert_columns(spark):
    old = series(spark, [("a", "x", None), ("b", "y", 1)], "k string, name string, s int")
    new = series(spark, [("a", "z", 5), ("c", "w", 6)], "k string, name string, s int")
    got = sorted(map(tuple, IO.upsert_columns(old, new, ["k"], keep_old=["name"]).collect()))
    assert got == [("a", "x", 5), ("b", "y", 1), ("c", "w", 6)]


def test_sources(spark):
    a = series(spark, [(" 12 ", "2001-01-01"), ("0", "x"), (None, "y")], "strap string, issue_dt string")
    b = series(spark, [(12.0, 5.0), (None, 1.0)], "parcel double, cost double")
    parts = [IO.load_source(a, IO.PermitSource("one")),
             IO.load_source(b, IO.PermitSource("two", {"strap": "parcel", "estimated_value": "cost"}, True))]
    got = sorted((r["strap"], r["_source"], r["estimated_value"]) for r in IO.union_sources(parts).collect())
    assert got == [("12", "one", None), ("12", "two", 5.0)]


def test_validation_and_columns(spark):
    df = series(spark, [("a",)], "strap string")
    got = sorted(map(tuple, IO.validation_report(spark, {"homes": df}, {"homes": ["strap", "lat"], "census": ["x"]}).collect()))
    assert got == [("census", "table not found"), ("homes", "missing column lat")]
    assert IO.ensure_columns(df, {"lat": "double", "strap": "string"}).dtypes == [("strap", "string"), ("lat", "double")]


def test_first_per_key_takes_null_keys(spark):
    df = series(spark, [(None, 2, "b"), (None, 1, "a"), ("k", 3, None)], "k string, o int, v string")
    got = sorted(J.first_per_key(df, ["k"], [F.col("o")]).collect(), key=lambda r: r["o"])
    assert [tuple(r) for r in got] == [(None, 1, "a"), ("k", 3, None)]


def test_rule_filter(spark):
    df = series(spark, [("A", "rural res", 5.0), ("B", None, 9.0), ("A", "RURAL", None)], "usedesc string, zoning_description string, saleprice double")
    assert L.apply_rules(df, {"usedesc": ["A"], "zoning_description_contains": "rural", "saleprice_min": 1}).count() == 1
    assert L.apply_rules(df, {}).count() == 3


def test_optional_conditions_leave_the_plan(spark, tmp_path):
    df = series(spark, [("x", 1.0)], "city string, lat double")
    df.write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    plan = read.where(L.given(city=("x", lambda v: F.col("city") == v), lat=(None, lambda v: F.col("lat") >= v)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(city,x)" in text and "GreaterThan" not in text


def test_samples(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in SA.class_aware(df, "y", "id", 500, min_positives=50, positive_share=0.1).groupBy("y").count().collect()}
    assert counts == {0: 450, 1: 50}
    train, test = SA.split_by_group(df.withColumn("home", F.col("id") % 100), "home")
    assert train.select("home").distinct().join(test.select("home").distinct(), "home").count() == 0
    assert train.count() + test.count() == 2000


def test_stratified(spark):
    df = spark.range(900).select(F.col("id").cast("string").alias("permit_num"), F.when(F.col("id") % 3 == 0, "solar,roof").otherwise("other").alias("permit_type"))
    got = SA.stratified_by_type(df, 5)
    counts = {r["permit_type"]: r["count"] for r in got.groupBy("permit_type").count().collect()}
    assert counts["other"] == 5 and 5 <= counts["solar,roof"] <= 10
    assert SA.other_only(df, 4).count() == 20


def test_roof_score_coverage(spark):
    homes = spark.range(100).select(F.col("id").alias("original_index"))
    few = series(spark, [(i, 50.0 + i) for i in range(9)], "original_index bigint, roof_score double")
    assert PL.with_roof_score(homes, few).where("roof_score IS NOT NULL").count() == 0
    enough = series(spark, [(i, 50.0) for i in range(9)] + [(9, 70.0)], "original_index bigint, roof_score double")
    assert {r[0] for r in PL.with_roof_score(homes, enough).select("roof_score").collect()} == {50.0, 70.0, 52.0}


def test_price_series_state():
    assert PL.price_series_applies("Average price, California (ca)", "CA")
    assert not PL.price_series_applies("Average price, Colorado", "NM")
    assert PL.price_series_applies("anything", "CO")


def small_panel(spark, homes, schema, permits, **more):
    from leadpanel.functions.permit_rules import FLAGS
    from leadpanel.plans import panel as PL

    flags = ", ".join(f"{f} int" for f in FLAGS)
    rows = [(strap, f"{year}-06-01", *(int(f == flag) for f in FLAGS)) for strap, year, flag in permits]
    inputs = PL.PanelInputs(homes=spark.createDataFrame(homes, schema), permits=spark.createDataFrame(rows, f"strap string, issue string, {flags}"),
                            issue_date="issue", **more)
    return PL.build_panel(inputs)


def test_panel_without_optional_columns(spark):
    homes = [("a", 40.0, -105.0), ("b", 40.0001, -105.0)]
    got = small_panel(spark, homes, "strap string, lat double, lon double", [("a", 2003, "solar_pv")], year_min=2000, year_max=2005).collect()
    assert {(r["strap"], r["year"]): r["solar_next_year"] for r in got}[("a", 2002)] == 1
    assert all(r["saleprice"] is None and r["roof_score_coverage"] == 0 for r in got)


def test_adopted_neighbours_expire(spark):
    homes = [("a", 40.0, -105.0), ("b", 40.0001, -105.0)]
    permits = [("a", 1985, "solar_pv"), ("a", 2014, "solar_pv"), ("b", 1990, "roof_new_or_replace")]
    got = small_panel(spark, homes, "strap string, lat double, lon double", permits, year_min=1984, year_max=2016).collect()
    own = {r["year"]: r["solar_pv"] for r in got if r["strap"] == "a"}
    seen = {r["year"]: r["count_0_05mi"] for r in got if r["strap"] == "b"}
    share = {r["year"]: r["closest_fifty_percentage"] for r in got if r["strap"] == "b"}
    last = {r["year"]: r["last_year_neighbors_w_solar_0_05mi"] for r in got if r["strap"] == "b"}
    assert seen == own and share == {y: 100.0 * v for y, v in own.items()}
    assert own[2009] == 1 and own[2010] == 0 and own[2014] == 1
    assert [y for y, v in last.items() if v] == [1986]


def test_known_roof_score_beats_a_null_one(spark):
    from leadpanel.plans import panel as PL

    homes = spark.createDataFrame([(1,), (2,)], "original_index bigint")
    scores = spark.createDataFrame([(1, None), (1, 80.0), (2, 40.0)], "original_index bigint, roof_score double")
    assert sorted(r["roof_score"] for r in PL.with_roof_score(homes, scores).collect()) == [40.0, 80.0]
    few = PL.with_roof_score(homes, scores.where("original_index = 2"), min_coverage=0.6).collect()
    assert [(r["roof_score"], r["roof_score_coverage"]) for r in few] == [(None, 0.5)] * 2


def test_price_series_of_another_state_is_left_out(spark):
    homes = [("a", 40.0, -105.0)]
    prices = spark.createDataFrame([(2001, 0.1, 0.0)], "year int, avg_price double, year_trend double")
    with_prices = lambda described: small_panel(
        spark, homes, "strap string, lat double, lon double", [], year_min=2000, year_max=2002, prices=prices,
        price_description=described, state="NM").columns
    assert "avg_electricity_price" in with_prices("Average price, NM") and "avg_electricity_price" not in with_prices("Average price, AZ")


def test_no_shuffle_moves_home_years(spark):
    homes = [("a", 40.0, -105.0), ("b", 40.0001, -105.0)]
    panel = small_panel(spark, homes, "strap string, lat double, lon double", [("a", 2003, "solar_pv")], year_min=2000, year_max=2005)
    plan = panel._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "Exchange" not in above, above


def test_first_in_hash_order(spark):
    """The same rows as a sort and a limit, at every size, without a sort; a key that repeats is cut inside."""
    df = spark.range(9000).select((F.col("id") % 8500).alias("id"), F.col("id").alias("row"))
    unique = df.where("row < 8500")
    for k in (1, 2, 37, 4096, 8499, 8500, 10**6):
        got = SA.first_in_hash_order(unique, "id", k)
        want = unique.orderBy(SA.hash_order("id", 42), "id").limit(k)
        assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "Sort" not in plan
    hot = spark.range(9000).select(F.lit(5).alias("id"), F.col("id").alias("row"))
    assert SA.first_in_hash_order(hot, "id", 4000).count() == 4000 and SA.first_in_hash_order(df, "id", 0).count() == 0
    for k in (100, 5000, 8999):
        assert SA.first_in_hash_order(df.withColumn("id", F.when(F.col("id") % 9 > 0, F.col("id"))), "id", k).count() == k
