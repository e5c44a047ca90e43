from pyspark.sql import functions as F

from leadpanel.catalog.expressions import AGED, ROOF_SCORE, TOP, sql_distance
from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.spatial import NEAREST, PAIRS
from leadpanel.catalog.sql_parts import EXPLODED, FLAGGED, TYPED, number, sale_year, widened
from leadpanel.catalog.tidy import tidy
from leadpanel.functions import permit_rules as R
from leadpanel.operators import features as W
from leadpanel.functions.dates import sale_year as sale_year_of
from leadpanel.operators import aggs as A
from leadpanel.operators import permits as P
from leadpanel.operators import windows as Y
from leadpanel.operators.ranking import exact_medians
from leadpanel.plans import panel as PL

c = F.col
Y0, Y1 = 1995, 2001
RATES_SQL = f"""SELECT CAST(year(observation_date) AS BIGINT) AS year, avg(TRY_CAST(rate_text AS DOUBLE) / 100) AS rate FROM rates
  WHERE year(observation_date) BETWEEN {Y0} AND {Y1} GROUP BY 1"""


def yearly_rates(t):
    rates = t.rates.withColumn("rate", c("rate_text").try_cast("double") / 100)
    return A.yearly_mean(rates, "observation_date", "rate", Y0, Y1)


@query("a1_yearly_mean", oracle("rates", "SELECT year, round(rate, 6) AS average_rate FROM r", r=RATES_SQL))
def a1(t):
    return tidy(yearly_rates(t))


def wide_prices(t):
    """One row with a column per month, as such series are published."""
    month = F.date_format("l_shipdate", "MMM-yy")
    labels = [f"{m}-{str(y)[2:]}" for y in range(Y0, Y1 + 1) for m in A.MONTHS]
    rows = t.lineitem.select(F.lit("CO price").alias("description"), month.alias("m"), "l_extendedprice")
    return rows.groupBy("description").pivot("m", labels).avg("l_extendedprice")


PRICES_SQL = """SELECT year, avg(price) AS avg_price, CASE WHEN count(*) >= 2 THEN regr_slope(price, month) END AS year_trend FROM
 (SELECT CAST(year(l_shipdate) AS BIGINT) AS year, month(l_shipdate) AS month, avg(l_extendedprice) AS price FROM lineitem
  WHERE year(l_shipdate) BETWEEN 1995 AND 2001 GROUP BY 1, 2) GROUP BY 1"""


@query("a2_yearly_price_trend", oracle("", "SELECT year, round(avg_price, 3) AS avg_price, round(year_trend, 3) AS year_trend FROM p", p=PRICES_SQL))
def a2(t):
    return tidy(A.yearly_price_trend(A.unpivot_months(wide_prices(t), ["description"])), 3)


ROLLED = f"""SELECT strap, CAST(year(issue_date) AS BIGINT) AS year, {', '.join(f'max({f}) AS {f}' for f in R.FLAGS)} FROM flagged GROUP BY 1, 2"""


def rolled(t):
    return A.roll_up_flags(P.compute_flags(t.permits), "strap", F.year("issue_date"))


@query("a3_flag_roll_up", oracle("permits", f"SELECT strap, year, {', '.join(R.FLAGS)} FROM rolled", flagged=FLAGGED, rolled=ROLLED))
def a3(t):
    return tidy(rolled(t))


@query("a4_first_event_year", oracle("permits", "SELECT strap, min(year) AS first_year FROM rolled WHERE solar_pv = 1 GROUP BY 1", flagged=FLAGGED, rolled=ROLLED))
def a4(t):
    return tidy(A.first_event_year(rolled(t), "strap", "solar_pv"))


@query("a5_group_share", oracle("homes", """
SELECT strap, city, round(100 * avg(CASE WHEN lower(trim(solar_panels)) = 'yes' THEN 1 ELSE 0 END) OVER (PARTITION BY city), 2) AS city_pct FROM homes"""))
def a5(t):
    yes = F.coalesce(F.lower(F.trim("solar_panels")) == "yes", F.lit(False))
    return tidy(A.group_share(t.homes.select("strap", "city", "solar_panels"), "city", yes, "city_pct").drop("solar_panels"))


@query("a6_exact_medians", """
SELECT l_returnflag, round(median(l_extendedprice), 6) AS l_extendedprice, round(median(l_quantity), 6) AS l_quantity FROM lineitem GROUP BY 1""")
def a6(t):
    return tidy(exact_medians(t.lineitem, ["l_extendedprice", "l_quantity"], ["l_returnflag"]))


ADOPTED = "SELECT h.strap, y.year, CAST(coalesce(a.first_year <= y.year, false) AS BIGINT) AS adopted, a.first_year FROM homes h CROSS JOIN (SELECT unnest(range(1995, 2002)) AS year) y LEFT JOIN adoptions a ON a.strap = h.strap"


def adopted_panel(t):
    homes = t.homes.select("strap").join(t.adoptions, "strap", "left")
    years = homes.withColumn("year", F.explode(F.sequence(F.lit(Y0).cast("bigint"), F.lit(Y1).cast("bigint"))))
    return years.withColumn("adopted", F.coalesce(c("first_year") <= c("year"), F.lit(False)).cast("int"))


@query("a7_adoption_by_year", oracle("homes adoptions", """
SELECT year, count(DISTINCT strap) AS homes, count(*) FILTER (first_year = year) AS new_adopters, CAST(sum(adopted) AS BIGINT) AS adopters,
  round(100 * sum(adopted) / count(*), 6) AS penetration_pct FROM g GROUP BY 1""", g=ADOPTED))
def a7(t):
    return tidy(A.adoption_by_year(adopted_panel(t).drop("first_year")))


@query("a13_permit_cards", oracle("permits", """
SELECT strap, day, description, string_agg(DISTINCT permit_type, ',' ORDER BY permit_type) AS types FROM
 (SELECT strap, CAST(issue_date AS VARCHAR) AS day, coalesce(description, '') AS description, permit_type FROM exploded) GROUP BY 1, 2, 3""",
    flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def a13(t):
    rows = P.explode_types(P.classify(t.permits)).select("strap", "issue_date", "description", "permit_type", "permit_num")
    cards = A.permit_cards(rows, [c("strap"), c("issue_date").cast("string"), F.coalesce("description", F.lit(""))], ["strap", "day", "description"])
    return cards.select("strap", "day", "description", F.array_join("types", ",").alias("types"))


@query("a14_type_counters", oracle("permits", """
SELECT count(*) AS n_cards, count(*) FILTER (list_contains(t, 'solar')) AS n_solar, count(*) FILTER (list_contains(t, 'roof')) AS n_roof
FROM (SELECT permit_num, list(permit_type) AS t FROM exploded GROUP BY 1)""", flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def a14(t):
    rows = P.explode_types(P.classify(t.permits)).select("permit_num", "permit_type", "strap")
    return A.type_counters(A.permit_cards(rows, [c("permit_num")], ["permit_num"]), ["solar", "roof"])


@query("a15_filter_options", oracle("homes", "SELECT DISTINCT trim(szip5) AS value FROM homes WHERE trim(szip5) <> ''"))
def a15(t):
    return A.filter_options(t.homes, "szip5")


@query("a16_flag_from_events", oracle("homes permits", """
SELECT strap, CAST(strap IN (SELECT strap FROM exploded WHERE permit_type = 'solar') AS BIGINT) AS has_solar FROM homes""",
    flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def a16(t):
    events = P.explode_types(P.classify(t.permits))
    return tidy(A.flag_from_events(t.homes.select("strap"), events, "strap", c("permit_type") == "solar", "has_solar"))


NUMERIC = ["saleprice", "area_building", "mainfloorsf", "sqft", "numrooms"]


@query("a18_missing_counts", oracle("homes", " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", count(*) FILTER ({n} IS NULL) AS n_missing FROM homes" for n in NUMERIC)))
def a18m(t):
    return A.missing_counts(t.homes, NUMERIC)


@query("a18_rate_by_bin", oracle("homes", f"""
SELECT CAST(floor(2000 - yearbuilt) AS BIGINT) AS bin, count(*) AS n, round(avg(CASE WHEN lower(trim(solar_panels)) = 'yes' THEN 1 ELSE 0 END), 6) AS rate
FROM homes WHERE yearbuilt IS NOT NULL GROUP BY 1"""))
def a18r(t):
    rows = t.homes.withColumn("y", F.coalesce(F.lower(F.trim("solar_panels")) == "yes", F.lit(False)).cast("int"))
    return tidy(A.rate_by_bin(rows, 2000 - c("yearbuilt"), "y"))


@query("a18_label_correlations", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS \"column\", round(corr({n}, CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END), 6) AS correlation FROM lineitem"
    for n in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")) + ")")
def a18c(t):
    rows = t.lineitem.withColumn("y", (c("l_returnflag") == "R").cast("int"))
    return tidy(A.label_correlations(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "y"))


@query("a18_correlation_pairs", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
    for a, b in (("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount"))) + ")")
def a18p(t):
    return tidy(A.correlation_pairs(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"]))


@query("a18_histogram", """
SELECT CAST(least(floor((o_totalprice - lo) / (hi - lo) * 50), 49) AS BIGINT) AS bin, count(*) AS n FROM orders,
 (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders) GROUP BY 1""")
def a18h(t):
    return A.histogram(t.orders, "o_totalprice")


@query("u4_consensus", """
SELECT "column" FROM (SELECT * FROM (SELECT l_suppkey AS "column", sum(l_quantity) AS s FROM lineitem GROUP BY 1 ORDER BY s DESC, 1 LIMIT 40)
 UNION ALL SELECT * FROM (SELECT l_suppkey, sum(l_extendedprice) AS s FROM lineitem GROUP BY 1 ORDER BY s DESC, 1 LIMIT 40)
 UNION ALL SELECT * FROM (SELECT l_suppkey, count(*) AS s FROM lineitem GROUP BY 1 ORDER BY s DESC, 1 LIMIT 40)) GROUP BY 1 HAVING count(*) >= 2""")
def u4(t):
    from leadpanel.plans.selection import consensus

    picks = [
        t.lineitem.groupBy(c("l_suppkey").alias("column")).agg(s.alias("s")).orderBy(F.desc("s"), "column").limit(40).select("column")
        for s in (F.sum("l_quantity"), F.round(F.sum("l_extendedprice"), 4), F.count(F.lit(1)))
    ]
    return consensus(picks, "column", 2)


# ---- windows over the dense panel -----------------------------------------------------
DENSE = f"""SELECT h.strap, y.year, {', '.join(f'coalesce({f}, 0) AS {f}' for f in R.FLAGS)} FROM homes h CROSS JOIN (SELECT unnest(range({Y0}, {Y1 + 1})) AS year) y
LEFT JOIN rolled r ON r.strap = h.strap AND r.year = y.year"""


def dense(t):
    grid = t.homes.select("strap").withColumn("year", F.explode(F.sequence(F.lit(Y0), F.lit(Y1))))
    return grid.join(rolled(t), ["strap", "year"], "left").na.fill(0, R.FLAGS)


@query("w1_persistence", oracle("homes permits", "SELECT strap, year, " + ", ".join(
    f"max({f}) OVER (PARTITION BY strap ORDER BY year ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS {f}" for f, n in R.PERSISTENCE.items()) + " FROM dense",
    flagged=FLAGGED, rolled=ROLLED, dense=DENSE))
def w1(t):
    return tidy(Y.persist_flags(dense(t)))


OTHERS = " + ".join(PL.OTHER_FLAGS)


@query("w2_velocity", oracle("homes permits", f"""
SELECT strap, year, CAST(sum({OTHERS}) OVER (PARTITION BY strap ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS velocity FROM dense""",
    flagged=FLAGGED, rolled=ROLLED, dense=DENSE))
def w2(t):
    d = dense(t)
    return tidy(d.select("strap", "year", Y.velocity(d, PL.OTHER_FLAGS).alias("velocity")))


SPEND = "SELECT o_custkey AS strap, CAST(year(o_orderdate) AS BIGINT) AS year, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1, 2"


def spend(t):
    return t.orders.groupBy(c("o_custkey").alias("strap"), F.year("o_orderdate").cast("bigint").alias("year")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("v"))


@query("w3_yearly_change", oracle("", "SELECT strap, year, round(coalesce(v - lag(v) OVER (PARTITION BY strap ORDER BY year), 0), 3) AS change FROM s", s=SPEND))
def w3(t):
    return tidy(spend(t).select("strap", "year", Y.yearly_change("v").alias("change")), 3)


@query("w4_three_year_slope", oracle("", """
SELECT strap, year, CASE WHEN rn = 1 THEN 0 ELSE round(regr_slope(v, rn) OVER (PARTITION BY strap ORDER BY year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) END AS slope
FROM (SELECT *, row_number() OVER (PARTITION BY strap ORDER BY year) AS rn FROM s)""", s=SPEND))
def w4(t):
    return tidy(spend(t).select("strap", "year", Y.three_year_slope("v").alias("slope")), 3)


ROOF_AGE = f"""SELECT d.strap, d.year, roof_new_or_replace AS event, greatest(yearbuilt, year_built_effective_date) AS built FROM dense d JOIN homes h ON h.strap = d.strap"""
AGE_WALK = f"""SELECT strap, year, CAST(CASE WHEN event = 1 THEN 0 ELSE coalesce(greatest(0, CAST(trunc(year - built) AS BIGINT)), 0) END AS BIGINT) AS age FROM base WHERE year = {Y0}
UNION ALL SELECT b.strap, b.year, CASE WHEN b.event = 1 THEN 0 ELSE w.age + 1 END FROM walk w JOIN base b ON b.strap = w.strap AND b.year = w.year + 1"""


@query("w5_years_since_reset", oracle("homes permits", "SELECT strap, year, age FROM walk",
    flagged=FLAGGED, rolled=ROLLED, dense=DENSE, base=ROOF_AGE, walk=AGE_WALK))
def w5(t):
    built = t.homes.select("strap", F.greatest("yearbuilt", "year_built_effective_date").alias("built"))
    d = dense(t).select("strap", "year", "roof_new_or_replace").join(built, "strap")
    return tidy(d.select("strap", "year", Y.years_since_reset(c("roof_new_or_replace") == 1, "built").alias("age")))


HELD_BASE = f"""SELECT h.strap, r.year, coalesce(r.rate, (SELECT median(rate) FROM r)) AS rate, h.sy FROM aged h CROSS JOIN r"""
HELD_WALK = f"""SELECT strap, year, rate AS held FROM base WHERE year = {Y0}
UNION ALL SELECT b.strap, b.year, CASE WHEN b.sy IS NOT DISTINCT FROM b.year OR b.rate <= w.held - 0.75 THEN b.rate ELSE w.held END
FROM walk w JOIN base b ON b.strap = w.strap AND b.year = w.year + 1"""
BIG_RATES = RATES_SQL.replace("/ 100", "% 100")


@query("w6_held_rate", oracle("homes rates", "SELECT strap, year, round(held, 6) AS held FROM walk", r=BIG_RATES, aged=AGED, base=HELD_BASE, walk=HELD_WALK))
def w6(t):
    rates = A.yearly_mean(t.rates.withColumn("rate", c("rate_text").try_cast("double") % 100), "observation_date", "rate", Y0, Y1)
    series = PL.yearly_values(rates, "average_rate")
    years = list(range(Y0, Y1 + 1))
    path = Y.held_rate(F.array(*[F.lit(series[y]) for y in years]), F.array(*[F.lit(y) for y in years]), c("sy"))
    homes = t.homes.select("strap", sale_year_of(c("saledate")).alias("sy"))
    return tidy(homes.select("strap", F.posexplode(path).alias("i", "held")).select("strap", (c("i") + Y0).alias("year"), "held"))


@query("w7_next_event_label", oracle("homes adoptions", """
SELECT strap, year, CAST(CASE WHEN year >= first_year THEN 2 WHEN year = first_year - 1 THEN 1 ELSE 0 END AS BIGINT) AS label FROM g""", g=ADOPTED))
def w7(t):
    return tidy(adopted_panel(t).select("strap", "year", Y.next_event_label(c("first_year"), c("year")).alias("label")))


@query("w8_page_with_total", oracle("homes", "SELECT strap, count(*) OVER () AS total_count FROM homes WHERE city = 'NATION_3' ORDER BY strap LIMIT 10"))
def w8(t):
    from leadpanel.plans.serve import with_total

    return with_total(t.homes.where(c("city") == "NATION_3").select("strap"), lambda df: df.orderBy("strap").limit(10))


@query("w13_latest_comment", oracle("notes", """
SELECT home_index, turn, md5(body) AS body FROM notes QUALIFY row_number() OVER (PARTITION BY home_index ORDER BY turn DESC, body DESC) = 1"""))
def w13(t):
    from leadpanel.sources.io import latest_per_key

    rows = t.notes.select("home_index", "turn", "body")
    return latest_per_key(rows, ["home_index"], [c("turn"), c("body")]).withColumn("body", F.md5("body"))


# ---- panel ---------------------------------------------------------------------------------
@query("p5_neighbour_start_year", oracle("adoptions", "SELECT greatest(1990, min(first_year) - 1) AS start_year FROM adoptions"))
def p5(t):
    return PL.neighbour_start_year(t.adoptions, 1990)


def classified(t):
    return P.compute_flags(t.permits)


def panel_inputs(t, roofs_too=True):
    from leadpanel.operators.features import clean_demographics

    regions = clean_demographics(t.demographics).select(
        "block_fips", "median_household_income", "median_home_value", "median_year_built", "pct_college_educated")
    scores = W.roof_profiles(t.segments).select("original_index", "roof_score")
    return PL.PanelInputs(
        homes=t.homes, permits=classified(t), issue_date="issue_date", year_min=Y0, year_max=Y1, rates=yearly_rates(t),
        prices=A.yearly_price_trend(A.unpivot_months(wide_prices(t), ["description"])), regions=regions,
        roof_scores=scores,
    )


PANEL_CTES = dict(
    flagged=FLAGGED, rolled=ROLLED, dense=DENSE, aged=AGED,
    fy="SELECT strap, min(year) AS first_year FROM rolled WHERE solar_pv = 1 GROUP BY 1",
    near="SELECT strap, first_year, " + ", ".join(f"count(*) FILTER (d <= {r}e0) AS {PL.radius_name(r)}" for r in PL.RADII)
    + " FROM (" + PAIRS.replace("JOIN adoptions ad", "JOIN fy ad") + ") GROUP BY 1, 2",
    nearest=NEAREST,
    fifty="SELECT n.strap, a.first_year, count(*) AS n FROM nearest n JOIN fy a ON a.strap = n.other GROUP BY 1, 2",
    others="SELECT strap, count(*) AS n_others FROM nearest GROUP BY 1",
    spread="SELECT d.*, a.first_year, " + ", ".join(
        f"(SELECT coalesce(sum({PL.radius_name(r)}), 0) FROM near WHERE near.strap = d.strap AND near.first_year <= d.year) AS {PL.radius_name(r)}" for r in PL.RADII)
    + ", " + ", ".join(
        f"(SELECT coalesce(sum({PL.radius_name(r)}), 0) FROM near WHERE near.strap = d.strap AND near.first_year = d.year - 1) AS {n}" for n, r in zip(PL.LAST_COUNTS, PL.LAST_YEAR_RADII))
    + ", coalesce(100.0e0 * (SELECT sum(n) FROM fifty WHERE fifty.strap = d.strap AND fifty.first_year <= d.year) / o.n_others, 0) AS pct"
    + " FROM dense d LEFT JOIN fy a ON a.strap = d.strap LEFT JOIN others o ON o.strap = d.strap",
    base=ROOF_AGE, walk=AGE_WALK, r=RATES_SQL, hb=HELD_BASE, hw=HELD_WALK.replace("base", "hb").replace("walk", "hw"),
    p=PRICES_SQL, top=TOP, rs=ROOF_SCORE,
    home="""SELECT h.*, d.inc, d.val, d.myb, s.roof_score FROM aged h LEFT JOIN (SELECT block_fips, median_household_income AS inc,
  CASE WHEN median_home_value >= 0 THEN median_home_value END AS val, median_year_built AS myb FROM demographics) d ON d.block_fips = h.block_fips
  LEFT JOIN rs s ON s.original_index = h.original_index""",
    filled="""SELECT *, coalesce(inc, (SELECT median(inc) FROM home)) AS inc2, coalesce(val, (SELECT median(val) FROM home)) AS val2,
  coalesce(myb, (SELECT median(myb) FROM home)) AS myb2, coalesce(roof_score, (SELECT avg(roof_score) FROM home)) AS roof2,
  coalesce(mainfloorsf, area_building, (SELECT median(coalesce(mainfloorsf, area_building)) FROM home)) AS floor2 FROM home""",
)


def win(flag):
    return f"max({flag}) OVER (PARTITION BY s.strap ORDER BY s.year ROWS BETWEEN {R.PERSISTENCE[flag] - 1} PRECEDING AND CURRENT ROW)"


PANEL_SELECT = f"""SELECT * EXCLUDE (b_heat, b_ac, b_ev, floor2, pool, evc, bat, whe, price, rn),
  round(greatest(floor2, 100) * (1 + 0.15e0 * b_heat + 0.25e0 * b_ac + 0.05e0 * b_ev + 0.2e0 * pool + 0.3e0 * evc + 0.1e0 * bat + 0.1e0 * whe), 3) AS electricity_use_proxy,
  round(greatest(floor2, 100) * (1 + 0.15e0 * b_heat + 0.25e0 * b_ac + 0.05e0 * b_ev + 0.2e0 * pool + 0.3e0 * evc + 0.1e0 * bat + 0.1e0 * whe) * price / 1000, 1) AS est_cost_thousands
FROM (SELECT s.strap, s.year, {', '.join(f'CAST({win(f)} AS BIGINT) AS {f}' for f in R.FLAGS)},
  {', '.join(f'CAST({n} AS BIGINT) AS {n}' for n in PL.COUNTS + PL.LAST_COUNTS)}, round(pct, 3) AS closest_fifty_percentage,
  round(coalesce(pct - lag(pct) OVER (PARTITION BY s.strap ORDER BY s.year), 0), 3) AS solar_neighbor_momentum,
  CASE WHEN s.year = {Y0} THEN 0 ELSE round(regr_slope(pct, s.year) OVER (PARTITION BY s.strap ORDER BY s.year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 3) END AS neighbor_solar_slope_3yr,
  CAST(sum({OTHERS}) OVER (PARTITION BY s.strap ORDER BY s.year ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS permit_velocity_3yr,
  w.age AS calculated_roof_age, round(f.roof2, 3) AS roof_score, round(f.inc2, 3) AS median_household_income,
  round(coalesce(f.inc2 / nullif(f.mainfloorsf, 0), (SELECT median(inc2 / nullif(mainfloorsf, 0)) FROM filled)), 3) AS income_per_sqft,
  coalesce(f.myb2 - f.built, 0) AS census_vs_property_age,
  CAST(CASE WHEN s.year - f.sy >= 0 THEN s.year - f.sy END AS BIGINT) AS time_since_sale, CAST(trunc(s.year - f.built) AS BIGINT) AS time_since_build,
  CAST(coalesce(s.year - f.built <= 7, false) AS BIGINT) AS recent_build, CAST(coalesce(f.sy <= s.year AND f.sy >= s.year - 3, false) AS BIGINT) AS recent_purchase,
  round(f.saleprice / nullif(f.sqft, 0), 3) AS land_price_sqft, round(hw.held, 6) AS likely_mortgage_rate,
  CAST(CASE WHEN s.year >= s.first_year THEN 2 WHEN s.year = s.first_year - 1 THEN 1 ELSE 0 END AS BIGINT) AS solar_next_year,
  f.floor2, CAST(coalesce(regexp_matches(upper(f.heatingdscr), 'ELECTRIC|HEAT PUMP'), false) OR {win('heat_pump')} = 1 AS INTEGER) AS b_heat,
  CAST(coalesce(contains(upper(f.acdscr), 'WHOLE HOUSE'), false) OR {win('ac')} = 1 AS INTEGER) AS b_ac,
  CAST(coalesce(contains(upper(f.acdscr), 'EVAPORATIVE'), false) OR {win('evaporative_cooler')} = 1 AS INTEGER) AS b_ev,
  {win('pool_hot_tub')} AS pool, {win('ev_charger')} AS evc, {win('battery')} AS bat, {win('water_heater_electric')} AS whe, p.avg_price AS price, 1 AS rn
 FROM spread s JOIN walk w ON w.strap = s.strap AND w.year = s.year JOIN filled f ON f.strap = s.strap
 JOIN hw ON hw.strap = s.strap AND hw.year = s.year LEFT JOIN p ON p.year = s.year)
WHERE year >= greatest({Y0}, (SELECT min(first_year) - 1 FROM fy))"""
THREE = ["closest_fifty_percentage", "solar_neighbor_momentum", "neighbor_solar_slope_3yr", "roof_score", "median_household_income",
         "income_per_sqft", "land_price_sqft", "electricity_use_proxy"]


@query("p6_build_panel", oracle("homes permits rates demographics segments", PANEL_SELECT, **PANEL_CTES))
def p6(t):
    p = PL.build_panel(panel_inputs(t))
    return tidy(p.select(
        "strap", "year", *R.FLAGS, *PL.COUNTS, *PL.LAST_COUNTS, "permit_velocity_3yr", "calculated_roof_age",
        *[F.round(n, 3).alias(n) for n in THREE], "census_vs_property_age", "time_since_sale", "time_since_build",
        "recent_build", "recent_purchase", "likely_mortgage_rate", "solar_next_year",
        F.round(c("est_annual_electricity_cost") / 1000, 1).alias("est_cost_thousands"),
    ))


@query("p7_roof_score_join", oracle("homes segments", """
SELECT strap, round(coalesce(roof_score, (SELECT avg(roof_score) FROM homes JOIN rs USING (original_index))), 4) AS roof_score
FROM homes LEFT JOIN rs USING (original_index)""", top=TOP, rs=ROOF_SCORE))
def p7(t):
    scores = W.roof_profiles(t.segments).select("original_index", "roof_score")
    return tidy(PL.with_roof_score(t.homes.select("strap", "original_index"), scores).select("strap", "roof_score"), 4)


@query("p8_trim_years", oracle("homes adoptions", "SELECT strap, year FROM g WHERE year >= (SELECT greatest(1995, min(first_year) - 1) FROM adoptions)", g=ADOPTED))
def p8(t):
    start = PL.neighbour_start_year(t.adoptions, Y0)
    return adopted_panel(t).crossJoin(F.broadcast(start)).where(c("year") >= c("start_year")).select("strap", "year")


THIRD = number("string_split_regex(trim(saledate), '[/.-]')[3]")
LAST = number("string_split_regex(trim(effective_text), '[/.-]')[-1]")
DIST = sql_distance("3958.8e0", "a", "b")


@query("p9_derived_columns", oracle("homes", f"""
SELECT h.strap, {', '.join(f"coalesce(n.{PL.radius_name(r, 'neighbors_w_solar_')}, 0) AS {PL.radius_name(r, 'neighbors_w_solar_')}" for r in (1.0, 0.5, 0.25, 0.1))},
  CAST(2003 - {widened(THIRD)} AS BIGINT) AS time_since_sale, CAST(trunc(2003 - greatest(yearbuilt, year_built_effective_date)) AS BIGINT) AS time_since_build,
  CAST(coalesce({widened(LAST)} BETWEEN 1998 AND 2100, false) AS BIGINT) AS recent_rebuild, CAST(coalesce({widened(THIRD)} >= 1998, false) AS BIGINT) AS recent_purchase,
  CAST(coalesce(yearbuilt >= 1998, false) AS BIGINT) AS recent_build, CAST(coalesce(regexp_matches(lower(heatingdscr), 'electric|heat pump'), false) AS BIGINT) AS electric_heating,
  round(100 * avg(CASE WHEN lower(trim(solar_panels)) = 'yes' THEN 1 ELSE 0 END) OVER (PARTITION BY city), 2) AS city_solar_percentage
FROM homes h LEFT JOIN (SELECT a.strap, {', '.join(f"count(*) FILTER ({DIST} <= {r}e0) AS {PL.radius_name(r, 'neighbors_w_solar_')}" for r in (1.0, 0.5, 0.25, 0.1))}
  FROM homes a, homes b WHERE a.strap <> b.strap AND lower(trim(b.solar_panels)) = 'yes' AND {DIST} <= 1.0e0 GROUP BY 1) n ON n.strap = h.strap"""))
def p9(t):
    out = PL.derived_columns(t.homes, 2003)
    return tidy(out.select(
        "strap", *[PL.radius_name(r, "neighbors_w_solar_") for r in (1.0, 0.5, 0.25, 0.1)], "time_since_sale", "time_since_build",
        "recent_rebuild", "recent_purchase", "recent_build", "electric_heating", "city_solar_percentage"))


@query("p10_region_lookup", oracle("homes home_scores demographics", """
SELECT strap, median_household_income FROM homes LEFT JOIN demographics USING (block_fips)
WHERE lat IS NOT NULL AND strap NOT IN (SELECT home_index FROM home_scores)"""))
def p10(t):
    done = t.home_scores.select(c("home_index").alias("strap"))
    codes = t.homes.select("strap", "block_fips")
    return PL.region_lookup(t.homes, done, codes, t.demographics).select("strap", "median_household_income")
