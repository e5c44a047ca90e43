from pyspark.sql import functions as F

from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.tidy import tidy
from leadpanel.catalog.timeline import ADOPTED, SPEND, Y0, Y1, adopted_panel, spend
from leadpanel.operators import windows as Y
from leadpanel.operators.information import neighbour_information, unpivoted
from leadpanel.operators.isotonic import isotonic_curve, isotonic_values
from leadpanel.plans import models as M
from leadpanel.plans import search as S
from leadpanel.plans import survival as V
from leadpanel.session import pin

c = F.col
NUMERIC = ("saleprice", "area_building", "mainfloorsf", "sqft", "numrooms", "spend", "n_orders", "home_age")
TEXT = ("heatingdscr", "county")


def frame(t):
    """Home-years with label, home columns and yearly spending."""
    homes = t.homes.select("strap", "saleprice", "area_building", "mainfloorsf", "sqft", "numrooms", "heatingdscr", "county", "yearbuilt")
    yearly = t.orders.groupBy(c("o_custkey").cast("string").alias("strap"), F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.sum("o_totalprice").alias("spend"), F.count(F.lit(1)).alias("n_orders"))
    panel = adopted_panel(t).withColumn("solar_next_year", Y.next_event_label(c("first_year"), c("year")))
    return panel.join(yearly, ["strap", "year"], "left").join(homes, "strap").withColumns({
        "home_age": c("year") - c("yearbuilt"), "row_id": F.concat_ws("-", "strap", c("year").cast("string")),
        "spend": F.coalesce("spend", F.lit(0.0)), "n_orders": F.coalesce("n_orders", F.lit(0)),
    }).drop("first_year", "yearbuilt")


def job(t):
    return M.Job(pin(frame(t)), NUMERIC, TEXT, Y0, Y1)


def prepared(t):
    valid = pin(frame(t).where(c("solar_next_year") < 2))
    prep = M.Preprocessor(list(NUMERIC), list(TEXT)).fit(valid)
    data = prep.transform(valid).withColumn("label", c("solar_next_year").cast("int"))
    return pin(data.select("strap", "year", "row_id", "label", "features")), prep


# Sizes of the models in all queries below: a job argument. The library's defaults are the tuned
# sizes (100 trees of depth 16, 200 rounds of depth 7), which only make each fit longer here.
FOREST = dict(numTrees=20, maxDepth=6)
BOOST = dict(maxIter=10, maxDepth=4, stepSize=0.1)
forest, boost = (lambda **more: M.forest(**{**FOREST, **more})), (lambda **more: M.boost(**{**BOOST, **more}))


# Scaled numbers have mean 0 and deviation 1; a level's mean is its share.
PROFILE = " UNION ALL ".join(
    [f"SELECT '{n}' AS feature, 0.0e0 AS mean, 1.0e0 AS std" for n in NUMERIC]
    + [f"""SELECT '{n}=' || level, round(k / n, 6), round(sqrt(k * (n - k) / n / (n - 1)), 6) FROM (SELECT coalesce({n}, 'MISSING') AS level,
    count(*) * 1.0e0 AS k, (SELECT count(*) * 1.0e0 FROM valid) AS n FROM valid GROUP BY 1)""" for n in TEXT])


@query("m1_preprocess", oracle("homes adoptions", PROFILE, g=ADOPTED, valid="""
SELECT h.heatingdscr, h.county FROM g JOIN homes h USING (strap) WHERE NOT coalesce(g.year >= g.first_year, false)"""))
def m1(t):
    data, prep = prepared(t)
    return tidy(M.vector_profile(data, prep.names))


FLAGS3 = ["f_few", "f_some", "f_many", "amount"]
FLAG_SQL = "SELECT CAST(o_orderkey % 997 = 0 AS INT) AS f_few, CAST(o_orderkey % 60 = 0 AS INT) AS f_some, CAST(o_orderkey % 3 = 0 AS INT) AS f_many, o_totalprice AS amount FROM orders"


@query("m2_low_count_filter", oracle("", " UNION ALL ".join(
    f"""SELECT '{n}' AS feature, count(*) FILTER ({n} = 1) AS ones, round(avg(CASE WHEN {n} <> 0 THEN 1.0e0 ELSE 0 END), 6) AS prevalence,
    CAST(bool_and({n} IN (0, 1)) AND count(*) FILTER ({n} = 1) < 100 AS BIGINT) AS dropped, CAST(avg(CASE WHEN {n} <> 0 THEN 1.0e0 ELSE 0 END) < 0.02 AS BIGINT) AS rare FROM f""" for n in FLAGS3), f=FLAG_SQL))
def m2(t):
    k = c("o_orderkey")
    flags = t.orders.select((k % 997 == 0).cast("int").alias("f_few"), (k % 60 == 0).cast("int").alias("f_some"),
                            (k % 3 == 0).cast("int").alias("f_many"), c("o_totalprice").alias("amount"))
    return tidy(M.low_count_flags(flags.select(*[c(n).cast("double").alias(n) for n in FLAGS3]), FLAGS3))


def table(t, values, schema):
    return M.rows(t.spark, values, schema)


@query("m3_linear_importance")
def m3(t):
    data, prep = prepared(t)
    return table(t, [(n, float(v)) for n, v in M.linear_importance(data, "label", prep.names).items()], "feature string, importance double")


@query("m4_permutation_lift")
def m4(t):
    data, prep = prepared(t)
    return M.permutation_lift(data, "label", prep.names)


@query("m5_correlation_filter")
def m5(t):
    data, prep = prepared(t)
    importance = M.linear_importance(data, "label", prep.names)
    ranked = sorted(importance, key=lambda n: (-importance[n], n))
    chosen = M.drop_correlated(data, prep.names, ranked, 12, group_cap=M.GROUP_CAP)
    return table(t, [(i + 1, n) for i, n in enumerate(chosen)], "rank int, feature string")


@query("m6_five_way_selection")
def m6(t):
    data, prep = prepared(t)
    return M.five_way_selection(data, "label", prep.names, keep=8, ridge_top=10)


INFORMED = ("sqft", "numrooms", "saleprice", "area_building")
PSI = ("(ln({n} + 6) - 0.5e0 / ({n} + 6) - 1 / (12e0 * ({n} + 6) ** 2) + 1 / (120e0 * ({n} + 6) ** 4) - 1 / (252e0 * ({n} + 6) ** 6)"
       " + 1 / (240e0 * ({n} + 6) ** 8) - 1 / (132e0 * ({n} + 6) ** 10) - 1e0 / {n} - 1e0 / ({n} + 1) - 1e0 / ({n} + 2) - 1e0 / ({n} + 3) - 1e0 / ({n} + 4) - 1e0 / ({n} + 5))")


@query("m6_neighbour_information", oracle("homes", f"""
SELECT feature, round(greatest(0, {PSI.format(n='max(total)')} + avg({PSI.format(n='k')}) - avg({PSI.format(n='ny')}) - avg({PSI.format(n='m')})), 6) AS mi
FROM (SELECT p.feature, p.ny, p.total, p.k, count(*) FILTER (abs(q.x - p.x) < p.d OR q.x = p.x) AS m
      FROM reach p JOIN sized q USING (feature) GROUP BY p.feature, p.id, p.ny, p.total, p.k)
GROUP BY 1""", long=" UNION ALL ".join(
    f"SELECT '{n}' AS feature, strap AS id, solar_panels = 'Yes' AS y, CAST({n} AS DOUBLE) AS x FROM homes WHERE {n} IS NOT NULL AND solar_panels IS NOT NULL" for n in INFORMED),
    sized="""SELECT *, count(*) OVER (PARTITION BY feature) AS total, least(3, ny - 1) AS k
    FROM (SELECT *, count(*) OVER (PARTITION BY feature, y) AS ny FROM long) WHERE ny > 1""",
    reach="""SELECT a.feature, a.id, a.x, a.ny, a.total, a.k, list(abs(b.x - a.x) ORDER BY abs(b.x - a.x))[a.k] AS d
    FROM sized a JOIN sized b ON a.feature = b.feature AND a.y = b.y AND a.id <> b.id GROUP BY a.feature, a.id, a.x, a.ny, a.total, a.k"""))
def m6_information(t):
    """How much the size, rooms and prices of a home tell about the target, as they are."""
    homes = t.homes.where("solar_panels IS NOT NULL").withColumn("_y", (c("solar_panels") == "Yes").cast("int"))
    found = neighbour_information(unpivoted(homes, INFORMED, "_y", "strap", noise=0.0))
    return tidy(found.select(F.get(F.array(*[F.lit(n) for n in INFORMED]), c("f")).alias("feature"), "mi"))


@query("m7_fold_sizes", oracle("homes adoptions", f"""
SELECT i AS install_year, count(*) FILTER (year < i - 1) AS train_n, CAST(coalesce(sum(l) FILTER (year < i - 1), 0) AS BIGINT) AS train_pos,
  count(*) FILTER (year = i - 1) AS test_n, CAST(sum(l) FILTER (year = i - 1) AS BIGINT) AS test_pos
FROM (SELECT year, CAST(CASE WHEN year >= first_year THEN 2 WHEN year = first_year - 1 THEN 1 ELSE 0 END AS BIGINT) AS l FROM g), (SELECT unnest(range({Y0 + 1}, {Y1 + 1})) AS i)
WHERE l < 2 AND year >= i - 5 AND year <= i - 1 GROUP BY 1""", g=ADOPTED))
def m7(t):
    panel = adopted_panel(t).withColumn("solar_next_year", Y.next_event_label(c("first_year"), c("year")))
    return tidy(M.fold_sizes(panel, Y0, Y1))


@query("m8_sample_weights", oracle("", "SELECT strap, year, round(pow(0.85e0, (SELECT max(year) FROM s) - year), 6) AS weight FROM s", s=SPEND))
def m8(t):
    return tidy(M.decay_weight(spend(t)).select("strap", "year", "weight"))


@query("m9_walk_forward")
def m9(t):
    out = M.walk_forward(job(t), {"forest": forest, "boost": boost}, selection=M.Selection(keep=8, candidates=12))
    return tidy(out.metrics())


@query("m10_isotonic_calibration")
def m10(t):
    train, test, _ = M.fold(job(t), Y1)
    return M.calibrated(forest, train, test).select("strap", "label", "score")


# Every block from every pair of its ends: the largest of the smallest means that reach past a price.
@query("m10_isotonic_curve", oracle("homes", """
SELECT x, round(max(low), 6) AS value FROM (
  SELECT a, x, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS low FROM (
    SELECT j.i AS a, k.i AS b, k.x, (k.cy - j.cy + j.y) / (k.cn - j.cn + j.n) AS mean FROM cum j JOIN cum k ON j.i <= k.i))
GROUP BY x""", counted="""
SELECT sqft AS x, count(*) * 1.0e0 AS n, count(*) FILTER (solar_panels = 'Yes') * 1.0e0 AS y FROM homes WHERE sqft IS NOT NULL AND solar_panels IS NOT NULL GROUP BY 1""",
    cum="SELECT *, row_number() OVER w AS i, sum(n) OVER w AS cn, sum(y) OVER w AS cy FROM counted WINDOW w AS (ORDER BY x)"))
def m10_curve(t):
    """How the share of adopters rises with size, at every size there is."""
    points = t.homes.select(F.lit(0).cast("bigint").alias("fold"), c("sqft").cast("double").alias("x"),
                            (c("solar_panels") == "Yes").cast("double").alias("y"), F.lit(1.0).alias("w"))
    points = pin(points.where("x IS NOT NULL AND y IS NOT NULL"))
    return tidy(isotonic_values(isotonic_curve(points), points.select("fold", "x").distinct()).select("x", "value"))


@query("m12_final_list")
def m12(t):
    return tidy(M.final_list(job(t), {"forest": forest, "boost": boost}, Y1))


@query("m13_fast_walk_forward")
def m13(t):
    out = M.fast_walk_forward(job(t), keep=["spend", "n_orders", "home_age", "saleprice", "sqft"], **BOOST)
    return tidy(M.lift_table(out, ["model", "install_year"]))


@query("m14_out_of_sample")
def m14(t):
    return M.out_of_sample(job(t), boost, Y1 - 1)


@query("m14_everyone_scored", oracle("homes adoptions", f"""
SELECT strap, coalesce({Y1 - 1} >= first_year, false) AS adopter FROM g WHERE year = {Y1 - 1}""", g=ADOPTED))
def m14_everyone(t):
    return M.out_of_sample(job(t), boost, Y1 - 1).select("strap", "adopter")


@query("m14_adopters_by_decile")
def m14_deciles(t):
    return tidy(M.adopters_by_decile(M.out_of_sample(job(t), boost, Y1 - 1)))


@query("m15_parameter_search")
def m15(t):
    return M.parameter_search(job(t), forest, {"numTrees": [10, 20], "maxDepth": [3, 6], "minInstancesPerNode": [1, 20]}, [Y1 - 1, Y1])


# The library's ranges with fewer and smaller trees, as in the other queries here.
SEARCHED = {**S.FOREST_SPACE, "numTrees": S.Whole(5, 20, 5), "maxDepth": S.Whole(2, 6)}


@query("m15_random_search")
def m15_random(t):
    return tidy(S.random_search(job(t), lambda **own: M.forest(**own), SEARCHED, [Y1 - 2, Y1 - 1, Y1], trials=12, calibrate=False, startup=4))


@query("m16_interaction_screen")
def m16(t):
    pairs = [("spend", "n_orders"), ("home_age", "saleprice"), ("sqft", "numrooms")]
    return M.interaction_screen(job(t), pairs, ["raw", "log_both"], boost, range(Y0 + 1, Y1 + 1))


@query("m17_coefficient_report")
def m17(t):
    data, prep = prepared(t)
    return tidy(M.coefficient_report(data, "label", prep.names))


@query("m18_bake_off")
def m18(t):
    data, _ = prepared(t)
    sizes = {"tree": dict(maxDepth=FOREST["maxDepth"]), "forest": FOREST, "boost": dict(maxIter=BOOST["maxIter"], maxDepth=BOOST["maxDepth"])}
    return tidy(M.bake_off(data, sizes=sizes))


# ---- survival ------------------------------------------------------------------------
TIMES = """SELECT strap, min(first_year) AS event_year, CAST(greatest(1, coalesce(min(first_year), max(year)) - min(year)) AS BIGINT) AS duration,
  CAST(min(first_year) IS NOT NULL AS BIGINT) AS event FROM g GROUP BY 1"""


def times(t):
    return V.durations(adopted_panel(t))


@query("v1_durations", oracle("homes adoptions", "SELECT strap, duration, event FROM times", g=ADOPTED, times=TIMES))
def v1(t):
    return tidy(times(t).drop("event_year"))


@query("v2_person_periods", oracle("homes adoptions", """
SELECT g.strap, g.year, CAST(coalesce(g.year = g.first_year, false) AS BIGINT) AS hazard FROM g WHERE g.first_year IS NULL OR g.year <= g.first_year""", g=ADOPTED))
def v2(t):
    panel = adopted_panel(t)
    return tidy(V.person_periods(panel.select("strap", "year"), V.durations(panel)))


GROUPED = """SELECT t.*, CASE WHEN h.sqft >= (SELECT median(sqft) FROM homes) THEN 'high' ELSE 'low' END AS risk_group, h.sqft FROM times t JOIN homes h USING (strap)"""


@query("v3_kaplan_meier", oracle("homes adoptions", """
SELECT risk_group, duration, at_risk, events, round(CASE WHEN min(s) OVER w <= 0 THEN 0 ELSE exp(sum(CASE WHEN s > 0 THEN ln(s) ELSE 0 END) OVER w) END, 6) AS survival FROM
 (SELECT *, 1 - events / at_risk AS s FROM (SELECT risk_group, duration, CAST(sum(sum(1)) OVER (PARTITION BY risk_group ORDER BY duration DESC) AS BIGINT) AS at_risk, CAST(sum(event) AS BIGINT) AS events
  FROM grouped GROUP BY 1, 2)) WINDOW w AS (PARTITION BY risk_group ORDER BY duration)""", g=ADOPTED, times=TIMES, grouped=GROUPED))
def v3(t):
    with_risk = times(t).join(t.homes.select("strap", "sqft"), "strap")
    return tidy(V.kaplan_meier(V.split_at_median(with_risk, "sqft"), "risk_group"))


@query("v5_concordance", oracle("homes adoptions", """
SELECT round(sum(CASE WHEN a.sqft > b.sqft THEN 1.0e0 WHEN a.sqft = b.sqft THEN 0.5e0 ELSE 0 END) / count(*), 6) AS c_index
FROM grouped a JOIN grouped b ON a.event = 1 AND (b.duration > a.duration OR (b.duration = a.duration AND b.event = 0))""", g=ADOPTED, times=TIMES, grouped=GROUPED))
def v5(t):
    return tidy(V.concordance(times(t).join(t.homes.select("strap", "sqft"), "strap"), "sqft"))


@query("v4_cox_hazard_ratios")
def v4(t):
    data = times(t).join(t.homes.select("strap", F.coalesce("numrooms", F.lit(6.0)).alias("numrooms"), "sqft"), "strap")
    found = V.cox_fit(data, ["numrooms", "sqft"])
    return table(t, [(r["feature"], r["coef"], r["hazard_ratio"], r["std_error"]) for r in found],
                 "feature string, coef double, hazard_ratio double, std_error double")


def cox(t):
    panel = frame(t)
    return V.cox_report(times(t), panel, COX, ["saleprice", "sqft", "spend"])


COX = ("saleprice", "sqft", "numrooms", "spend", "n_orders")


@query("v4_cox_report")
def v4_report(t):
    return cox(t).features


@query("v4_cox_concordance")
def v4_concordance(t):
    return cox(t).concordance


# Every pair of homes, for a risk with as many values as there are homes.
@query("v5_concordance_of_amounts", oracle("homes adoptions", """
SELECT round(sum(CASE WHEN a.risk > b.risk THEN 1.0e0 WHEN a.risk = b.risk THEN 0.5e0 ELSE 0 END) / count(*), 6) AS c_index
FROM risky a JOIN risky b ON a.event = 1 AND (b.duration > a.duration OR (b.duration = a.duration AND b.event = 0))""", g=ADOPTED, times=TIMES,
    risky="SELECT t.duration, t.event, h.saleprice / nullif(h.sqft, 0) AS risk FROM times t JOIN homes h USING (strap) WHERE h.saleprice / nullif(h.sqft, 0) IS NOT NULL"))
def v5_amounts(t):
    risky = times(t).join(t.homes.select("strap", F.try_divide("saleprice", "sqft").alias("risk")), "strap")
    return tidy(V.concordance(risky, "risk"))


def hazard(t):
    panel = frame(t).drop("solar_next_year")
    periods = pin(V.person_periods(panel, V.durations(panel)).withColumn("time_at_risk", c("year") - Y0))
    return V.discrete_hazard(periods, [*NUMERIC, "time_at_risk"])


@query("v6_hazard_ratios")
def v6(t):
    return hazard(t)["ratios"]


@query("v6_hazard_lift")
def v6l(t):
    return hazard(t)["lift"]


@query("v6_risk_list")
def v6r(t):
    return hazard(t)["risk"]
