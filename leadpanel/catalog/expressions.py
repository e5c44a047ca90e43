from pyspark.sql import functions as F

from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.sql_parts import parsed_date, sale_year, number, widened
from leadpanel.catalog.tidy import tidy
from leadpanel.functions import dates as D
from leadpanel.functions import geo as G
from leadpanel.functions import roof as R
from leadpanel.functions import text as X
from leadpanel.operators import features as W
from leadpanel.operators.ranking import median_scalars

c = F.col


@query("x1_sale_year", oracle("homes", f"SELECT strap, CAST({sale_year('saledate')} AS BIGINT) AS sale_year FROM homes"))
def x1(t):
    return tidy(t.homes.select("strap", D.sale_year(c("saledate")).alias("sale_year")))


THIRD = number("string_split_regex(trim(saledate), '[/.-]')[3]")
LAST = number("string_split_regex(trim(effective_text), '[/.-]')[-1]")


@query("x2_simple_years", oracle("homes", f"""
SELECT strap, CAST({widened(THIRD)} AS BIGINT) AS sale_year,
  CAST(CASE WHEN {widened(LAST)} BETWEEN 1900 AND 2100 THEN {widened(LAST)} END AS BIGINT) AS effective_year FROM homes"""))
def x2(t):
    return tidy(t.homes.select(
        "strap", D.sale_year_simple(c("saledate")).alias("sale_year"),
        D.effective_year(c("effective_text")).alias("effective_year"),
    ))


@query("x3_issue_dates", oracle("permits", f"""
SELECT permit_num, CAST(CASE WHEN d <> DATE '1899-12-30' AND year(d) <= 2001 THEN d END AS VARCHAR) AS cleaned,
  CAST(CASE WHEN year(d) BETWEEN 1990 AND 1999 THEN d END AS VARCHAR) AS bounded
FROM (SELECT permit_num, {parsed_date('issue_dt')} AS d FROM permits)"""))
def x3(t):
    return tidy(t.permits.select(
        "permit_num", D.clean_issue_date(c("issue_dt"), 2001).alias("cleaned"),
        D.bounded_issue_date(c("issue_dt"), 1999).alias("bounded"),
    ))


@query("x4_parcel_id", oracle("homes", """
SELECT strap, nullif(CAST(CAST(area_building AS BIGINT) AS VARCHAR), '0') AS from_number,
  nullif(trim(strap), '0') AS from_text FROM homes"""))
def x4(t):
    return t.homes.select(
        "strap", X.parcel_id(c("area_building"), True).alias("from_number"),
        X.parcel_id(c("strap"), False).alias("from_text"),
    )


def _expected(key: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else "'" + v.replace("'", "''") + "'") for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


OWNER_1 = ["Smith, John A", "Smith, John", "Garcia, Luis", "Doe,, Jane Q", "BLUE HERON HOLDINGS LLC",
           "LEE FAMILY TRUST", None, None, "Ng", "Patel, Ravi K", "O'brien, Pat And Kim Lee", "Ward,, Ann B"]
OWNER_2 = [None, "Smith, Mary", "Garcia, Ana M", "Doe,, Richard", None, None, None, None, None,
           "Shah, Meera S", None, "Dan, Cole,"]


@query("x5_owner_pair", oracle("homes", f"""
SELECT strap, {_expected('original_index', OWNER_1)} AS owner_1,
  CASE original_index % 12 WHEN 2 THEN 'Garcia, Ana M' WHEN 11 THEN 'Ward,, Cole, Dan E' ELSE {_expected('original_index', OWNER_2)} END AS owner_2 FROM homes"""))
def x5(t):
    pair = X.owner_pair(c("owner"))
    return t.homes.select("strap", pair["owner_1"].alias("owner_1"), pair["owner_2"].alias("owner_2"))


PEOPLE = ["John/A/Smith", "John//Smith; Mary//Smith", "Luis//Garcia; Ana/M/Garcia", "Jane/Q/Doe; Richard//Doe", "", "",
          "", "", "//Ng", "Ravi/K/Patel; Meera/S Shah/Patel", "Pat//O'Brien; Kim//Lee", "Ann/B/Ward; Dan/E/Cole"]


@query("x6_owner_people", oracle("homes", f"SELECT strap, {_expected('original_index', PEOPLE)} AS people FROM homes"))
def x6(t):
    people = F.transform(X.owner_people(c("owner")), lambda p: F.concat_ws("/", p["first"], p["middle"], p["last"]))
    return t.homes.select("strap", F.array_join(people, "; ").alias("people"))


NAMES = ["Coal Creek", "Village", "Park Place", None, "Oak Grove", "Sunny Slope", "Heart"]


@query("x7_subdivision_name", oracle("homes", f"""
SELECT strap, CASE original_index % 7 WHEN 1 THEN 'Village Of Heather' ELSE {_expected('original_index', NAMES)} END AS subdivision FROM homes"""))
def x7(t):
    return t.homes.select("strap", X.subdivision_name(c("subdivision")).alias("subdivision"))


def sql_distance(radius: float, a: str, b: str, lat="lat", lon="lon") -> str:
    h = f"""pow(sin(radians({b}.{lat} - {a}.{lat}) / 2), 2) + cos(radians({a}.{lat})) * cos(radians({b}.{lat}))
      * pow(sin(radians({b}.{lon} - {a}.{lon}) / 2), 2)"""
    return f"(2 * {radius} * asin(sqrt(least({h}, 1.0e0))))"


@query("x8_haversine", oracle("homes", f"""
SELECT a.strap, round({sql_distance('3958.8e0', 'a', 'b')}, 6) AS miles, round({sql_distance('6371000.0e0', 'a', 'b')}, 2) AS metres
FROM homes a, (SELECT 40.0e0 AS lat, -105.3e0 AS lon) b"""))
def x8(t):
    here = (c("lat"), c("lon"), F.lit(40.0), F.lit(-105.3))
    return tidy(t.homes.select(
        "strap", G.miles(*here).alias("miles"), F.round(G.metres(*here), 2).alias("metres")
    ))


@query("x9_bounding_box", oracle("homes", """
SELECT strap, round(lat - 10.0e0 / 111320.0e0, 6) AS sw_lat, round(lon - dlon, 6) AS sw_lon,
  round(lat + 0.0002e0 + 10.0e0 / 111320.0e0, 6) AS ne_lat,
  round(((lon - dlon) + (lon + 0.0003e0 + dlon)) / 2, 6) AS centre_lon, CAST(5 AS BIGINT) AS corners
FROM (SELECT *, 10.0e0 / (111320.0e0 * cos(radians((lat + lat + 0.0002e0) / 2))) AS dlon FROM homes)"""))
def x9(t):
    box = G.expand_box(c("lat"), c("lon"), c("lat") + 0.0002, c("lon") + 0.0003, 10.0)
    boxed = t.homes.select("strap", box.alias("box"))
    return tidy(boxed.select(
        "strap", "box.sw_lat", "box.sw_lon", "box.ne_lat", G.box_centre(c("box"))["lon"].alias("centre_lon"),
        F.size(G.box_ring(c("box"))).alias("corners"),
    ))


@query("x10_json_cells", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN nullif(k, 0) ELSE k END AS avg_value,
  CASE WHEN event_id % 3 = 0 THEN round(value, 6) END AS lat
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""")
def x10(t):
    number = F.get_json_object("props", "$.k")
    stats = F.when(c("event_id") % 2 == 0, F.concat(F.lit('{"Avg": '), number, F.lit("}"))).otherwise(
        F.concat(F.lit('{"Avg": 0, "avg": '), number, F.lit("}"))
    )
    point = F.when(c("event_id") % 3 == 0, F.concat(F.lit('{"sw": {"latitude": '), c("value").cast("string"), F.lit("}}"))).when(
        c("event_id") % 3 == 1, F.lit("not json")
    )
    return tidy(t.events.select(
        "event_id", R.stat_average(stats).alias("avg_value"), R.point_of(point, "sw")["lat"].alias("lat")
    ))


def payloads(t):
    """One response document per order, as JSON text; every 57th is unreadable."""
    from leadpanel.session import spread_rows

    k = c("o_orderkey")
    n = F.when(k % 40 == 0, 28).otherwise(k % 6).cast("int")
    point = lambda lat, lon: F.struct(lat.alias("latitude"), lon.alias("longitude"))

    def segment(i):
        lat, lon = 40.0 + (k % 100) * 0.001 + i * 0.00001, -105.0 - (k % 50) * 0.001 - i * 0.00002
        sun = F.transform(F.sequence(F.lit(0), F.lit(12)), lambda v: (400 + (k + i * 7 + v * 97) % 1500).cast("double"))
        return F.struct(
            ((k * 37 + i * 53) % 360).cast("double").alias("azimuthDegrees"),
            F.struct(
                F.when((k + i) % 31 != 0, ((k * 13 + i * 29) % 600) / 10).alias("areaMeters2"),
                F.when((k + i) % 5 != 0, sun).alias("sunshineQuantiles"),
            ).alias("stats"),
            point(lat, lon).alias("center"),
            F.struct(point(lat, lon).alias("sw"), point(lat + 0.0001, lon + 0.0001).alias("ne")).alias("boundingBox"),
        )

    segments = F.transform(F.slice(F.sequence(F.lit(0), F.lit(27)), F.lit(1), n), segment)
    body = F.struct(
        point(40.0 + (k % 100) * 0.001, -105.0 - (k % 50) * 0.001).alias("center"),
        F.struct((2020 + k % 5).alias("year"), (1 + k % 12).alias("month"), (1 + k % 28).alias("day")).alias("imageryDate"),
        F.struct((1500.0 + k % 400).alias("maxSunshineHoursPerYear"), segments.alias("roofSegmentStats")).alias("solarPotential"),
    )
    return spread_rows(t.orders.select("o_orderkey")).select(
        k.alias("original_index"), F.when(k % 57 == 0, "not json").otherwise(F.to_json(body)).alias("payload")
    )


SEGS = """SELECT k, i, CAST((k * 37 + i * 53) % 360 AS DOUBLE) AS azimuth,
  CASE WHEN (k + i) % 31 <> 0 THEN ((k * 13 + i * 29) % 600) / 10.0e0 END AS area, (k + i) % 5 <> 0 AS has_sun,
  40.0e0 + (k % 100) * 0.001e0 + i * 0.00001e0 AS lat, -105.0e0 - (k % 50) * 0.001e0 - i * 0.00002e0 AS lon,
  row_number() OVER (PARTITION BY k ORDER BY coalesce(CASE WHEN (k + i) % 31 <> 0 THEN ((k * 13 + i * 29) % 600) / 10.0e0 END, 0) DESC, i) AS rn
FROM (SELECT o_orderkey AS k, unnest(range(CASE WHEN o_orderkey % 40 = 0 THEN 28 ELSE o_orderkey % 6 END)) AS i FROM orders WHERE o_orderkey % 57 <> 0)"""

SUN = """SELECT k, i, round(max(v), 2) AS max_sun, round(min(v), 2) AS min_sun, round(avg(v), 2) AS avg_sun
FROM (SELECT k, i, CAST(400 + (k + i * 7 + unnest(range(11)) * 97) % 1500 AS DOUBLE) AS v FROM segs WHERE has_sun) GROUP BY 1, 2"""


@query("x11_flatten_response", oracle("", """
SELECT s.k AS original_index, s.rn AS idx, CAST(2020 + s.k % 5 AS BIGINT) AS year, round(1500.0e0 + s.k % 400, 6) AS sunshine,
  count(*) OVER (PARTITION BY s.k) AS segment_count, s.azimuth, s.area, max_sun, min_sun, avg_sun
FROM segs s LEFT JOIN sun USING (k, i) QUALIFY s.rn <= 25""", segs=SEGS, sun=SUN))
def x11(t):
    flat = R.flatten_responses(payloads(t), "payload")
    return tidy(flat.select(
        "original_index", "year", "sunshine", "segment_count", F.posexplode("segments").alias("i", "s")
    ).select(
        "original_index", (c("i") + 1).alias("idx"), "year", "sunshine", "segment_count", "s.azimuth", "s.area",
        "s.max_sun", "s.min_sun", "s.avg_sun",
    ))


@query("a17_house_box", oracle("", """
SELECT k AS original_index, round(min(lat), 6) AS sw_lat, round(min(lon), 6) AS sw_lon,
  round(max(lat + 0.0001e0), 6) AS ne_lat, round(max(lon + 0.0001e0), 6) AS ne_lon FROM segs WHERE rn <= 25 GROUP BY 1""", segs=SEGS))
def a17(t):
    flat = R.flatten_responses(payloads(t), "payload")
    boxed = flat.select("original_index", R.house_box(F.transform("segments", lambda s: s["bbox"])).alias("b"))
    return tidy(boxed.where(c("b").isNotNull()).select("original_index", "b.*"))


CENTRES = """SELECT strap, area_building AS sqft, lat, lon,
  lat + (original_index % 23) * 0.00001e0 AS lat1, (original_index * 7) % 400 / 1.0e0 AS area1,
  lat + (original_index % 17) * 0.00001e0 AS lat2, (original_index * 11) % 500 / 1.0e0 AS area2 FROM homes WHERE lat IS NOT NULL"""


@query("x12_accept_or_replace", oracle("homes", """
SELECT strap, CASE WHEN used_retry THEN 2 ELSE 1 END::BIGINT AS response, (NOT far1 OR used_retry)::BIGINT AS ok,
  CASE WHEN used_retry THEN area2 WHEN NOT far1 THEN area1 END AS area
FROM (SELECT *, CASE WHEN short THEN NOT far2 AND coalesce(area2 >= sqft * 0.09290304e0 * 0.7e0, false) WHEN far1 THEN NOT far2 ELSE false END AS used_retry
  FROM (SELECT *, NOT far1 AND coalesce(area1 < sqft * 0.09290304e0 * 0.7e0, false) AS short
    FROM (SELECT *, 6371000.0e0 * radians(lat1 - lat) > 15 AS far1, 6371000.0e0 * radians(lat2 - lat) > 15 AS far2 FROM centres)))""",
    centres=CENTRES))
def x12(t):
    k = c("original_index")
    homes = t.homes.where(c("lat").isNotNull())
    first = homes.select("strap", (c("lat") + (k % 23) * 0.00001).alias("lat1"), ((k * 7) % 400 / 1.0).alias("area1"))
    retry = homes.select("strap", (c("lat") + (k % 17) * 0.00001).alias("lat2"), ((k * 11) % 500 / 1.0).alias("area2"))
    both = homes.select("strap", "lat", "lon", c("area_building").alias("sqft")).join(first, "strap").join(retry, "strap", "left")
    far = lambda lat: G.metres(c("lat"), c("lon"), c(lat), c("lon")) > R.MAX_DISTANCE_M
    both = both.withColumns({"far1": far("lat1"), "far2": far("lat2")})
    too_far, short = R.needs_retry(~c("far1"), c("far1"), c("area1"), c("sqft"))
    both = both.withColumn("used", R.use_retry(too_far, short, ~c("far2"), c("area2"), c("sqft")))
    return tidy(both.select(
        "strap", F.when(c("used"), 2).otherwise(1).alias("response"), (~c("far1") | c("used")).alias("ok"),
        F.when(c("used"), c("area2")).when(~c("far1"), c("area1")).alias("area"),
    ))


TOP = """SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY original_index) AS n,
  row_number() OVER (PARTITION BY original_index ORDER BY area DESC, idx, tie) AS rn FROM segments)"""

BANDS = """SELECT original_index, n, azimuth, area, avg_sun, 'East' AS band FROM top WHERE azimuth BETWEEN 80 AND 140
UNION ALL SELECT original_index, n, azimuth, area, avg_sun, 'South' FROM top WHERE azimuth BETWEEN 140 AND 220
UNION ALL SELECT original_index, n, azimuth, area, avg_sun, 'West' FROM top WHERE azimuth BETWEEN 220 AND 280"""


def _labels(cond: str) -> str:
    return "concat_ws(', ', " + ", ".join(f"max(CASE WHEN {cond.format(b=b)} THEN '{b}' END)" for b in ("East", "South", "West")) + ")"


@query("x13_orientations", oracle("segments", f"""
SELECT t.original_index, coalesce(max(inclusive), '') AS inclusive, coalesce(max(large), '') AS large,
  concat_ws(', ', max(CASE WHEN t.azimuth >= 80 AND t.azimuth < 140 THEN 'East' END),
    max(CASE WHEN t.azimuth BETWEEN 140 AND 220 THEN 'South' END), max(CASE WHEN t.azimuth > 220 AND t.azimuth <= 280 THEN 'West' END)) AS exclusive
FROM top t LEFT JOIN (SELECT original_index, {_labels("band = '{b}'")} AS inclusive, {_labels("band = '{b}' AND area >= 30")} AS large
  FROM bands GROUP BY 1) b ON b.original_index = t.original_index GROUP BY 1""", top=TOP, bands=BANDS))
def x13(t):
    return W.roof_profiles(t.segments).select("original_index", "inclusive", "large", "exclusive")


@query("x14_segment_totals", oracle("segments", """
SELECT t.original_index, count(b.band) AS n_matching, round(coalesce(sum(b.area), 0), 2) AS area_sum, round(coalesce(max(b.area), 0), 2) AS area_max
FROM (SELECT DISTINCT original_index FROM segments) t LEFT JOIN bands b ON b.original_index = t.original_index GROUP BY 1""", top=TOP, bands=BANDS))
def x14(t):
    return tidy(W.roof_profiles(t.segments).select("original_index", "n_matching", "area_sum", "area_max"))


SOLAR_SCORE = """SELECT t.original_index, round(CASE WHEN count(b.band) = 0 THEN 10.0e0 ELSE max((b.avg_sun / 1800.0e0 * 100
   + (1 - abs((180 - b.azimuth) / 180.0e0) * CASE WHEN b.azimuth < 180 THEN 1.2e0 ELSE 0.8e0 END) * 150 - b.n * b.n / 15.0e0)
   * least(1.0e0, b.area / 30.0e0)) END, 2) AS solar_score
FROM (SELECT DISTINCT original_index FROM segments) t LEFT JOIN bands b ON b.original_index = t.original_index GROUP BY 1"""


@query("x15_solar_score", oracle("segments", SOLAR_SCORE, top=TOP, bands=BANDS))
def x15(t):
    return tidy(W.solar_scores(t.segments), 2)


ROOF_SCORE = """SELECT original_index, CASE WHEN count(w) = 0 THEN 10.0e0 ELSE round(greatest(10.0e0, least(100.0e0,
   pow(sum(area * w * (avg_sun / 1800.0e0)), 0.55e0) * (0.75e0 + 0.25e0 * max(area) FILTER (w IS NOT NULL) / sum(area) FILTER (w IS NOT NULL)) / 14.0e0 * 100)), 2) END AS roof_score
FROM (SELECT *, CASE WHEN azimuth BETWEEN 80 AND 280 AND avg_sun IS NOT NULL THEN greatest(0.0e0, 1 - 0.65e0 * pow(abs(azimuth - 180) / 100, 1.2e0)
   + CASE WHEN azimuth > 180 THEN 0.05e0 * abs(azimuth - 180) / 100 ELSE 0 END) END AS w FROM top) GROUP BY 1"""


@query("x16_roof_score", oracle("segments", ROOF_SCORE, top=TOP))
def x16(t):
    return tidy(W.roof_profiles(t.segments).select("original_index", "roof_score"), 2)


@query("x17_rescale", oracle("segments", """
SELECT original_index, round(solar_score / (SELECT max(solar_score) FROM sc) * 100, 6) AS solar_score FROM sc""",
    top=TOP, bands=BANDS, sc=SOLAR_SCORE))
def x17(t):
    return tidy(W.rescale_to_max(W.solar_scores(t.segments), "solar_score"))


HYBRID = """CASE WHEN model_score IS NOT NULL AND roof_score IS NOT NULL THEN round(0.6e0 * model_score + 0.4e0 * roof_score{d})
  WHEN model_score IS NOT NULL THEN model_score ELSE roof_score END"""


@query("x18_hybrid_score", oracle("home_scores", f"""
SELECT home_index, CAST({HYBRID.format(d='')} AS DOUBLE) AS whole, round({HYBRID.format(d=', 1')}, 6) AS tenth FROM home_scores"""))
def x18(t):
    return tidy(t.home_scores.select(
        "home_index", W.hybrid(c("model_score"), c("roof_score"), 0).alias("whole"),
        W.hybrid(c("model_score"), c("roof_score"), 1).alias("tenth"),
    ))


@query("x19_ratios", oracle("homes demographics", """
SELECT strap, round(coalesce(ips, (SELECT median(ips) FROM r)), 4) AS income_per_sqft,
  round(coalesce(hvi, (SELECT median(hvi) FROM r)), 6) AS home_value_to_income,
  coalesce(myb - built, 0.0e0) AS census_vs_property_age, round(land, 6) AS land_price_sqft, round(bldg, 6) AS building_price_sqft
FROM r""", r="""SELECT h.strap, d.median_household_income / nullif(h.mainfloorsf, 0) AS ips,
  CASE WHEN d.median_home_value >= 0 THEN d.median_home_value END / nullif(d.median_household_income, 0) AS hvi,
  d.median_year_built AS myb, CASE WHEN h.yearbuilt IS NULL THEN h.year_built_effective_date WHEN h.year_built_effective_date IS NULL THEN h.yearbuilt
    ELSE greatest(h.yearbuilt, h.year_built_effective_date) END AS built,
  h.saleprice / nullif(h.sqft, 0) AS land, h.saleprice / nullif(h.mainfloorsf, 0) AS bldg
  FROM homes h LEFT JOIN demographics d ON h.block_fips = d.block_fips"""))
def x19(t):
    regions = W.clean_demographics(t.demographics)
    joined = t.homes.join(regions, "block_fips", "left")
    return tidy(W.ratios(joined).select(
        "strap", F.round("income_per_sqft", 4).alias("income_per_sqft"), "home_value_to_income",
        "census_vs_property_age", "land_price_sqft", "building_price_sqft",
    ))


AGED = f"""SELECT *, {sale_year('saledate')} AS sy, greatest(yearbuilt, year_built_effective_date) AS built FROM homes"""


@query("x20_recency", oracle("homes", """
SELECT strap, CAST(CASE WHEN 2000 - sy >= 0 THEN 2000 - sy END AS BIGINT) AS time_since_sale, CAST(2000 - built AS BIGINT) AS time_since_build,
  CAST(coalesce(2000 - built <= 7, false) AS BIGINT) AS recent_build,
  CAST(coalesce(sy <= 2000 AND sy >= 1997, false) AS BIGINT) AS recent_purchase FROM aged""", aged=AGED))
def x20(t):
    homes = t.homes.withColumns({
        "sale_year": D.sale_year(c("saledate")),
        "calculated_build_year": F.greatest("yearbuilt", "year_built_effective_date"), "year": F.lit(2000),
    })
    return tidy(W.recency(homes).select("strap", "time_since_sale", "time_since_build", "recent_build", "recent_purchase"))


@query("x21_electricity_proxy", oracle("homes", """
SELECT strap, round(greatest(coalesce(mainfloorsf, area_building, (SELECT median(coalesce(mainfloorsf, area_building)) FROM homes)), 100)
  * (1 + 0.15e0 * CAST(coalesce(regexp_matches(upper(heatingdscr), 'ELECTRIC|HEAT PUMP'), false) AS INT)
  + 0.25e0 * CAST(coalesce(contains(upper(acdscr), 'WHOLE HOUSE'), false) AS INT) + 0.05e0 * CAST(coalesce(contains(upper(acdscr), 'EVAPORATIVE'), false) AS INT)
  + 0.2e0 * (original_index % 2) + 0.3e0 * CAST(original_index % 3 = 0 AS INT)), 4) AS electricity_use_proxy FROM homes"""))
def x21(t):
    k = c("original_index")
    homes = t.homes.withColumns({
        "pool_hot_tub": k % 2, "ev_charger": (k % 3 == 0).cast("int"),
        **{n: F.lit(0) for n in ("heat_pump", "ac", "evaporative_cooler", "battery", "water_heater_electric")},
        "_area": F.coalesce("mainfloorsf", "area_building"),
    })
    median = median_scalars(homes, ["_area"])["_area"]
    return tidy(homes.select("strap", W.electricity_proxy(median).alias("electricity_use_proxy")), 4)


@query("x22_demographics", oracle("demographics", """
SELECT block_fips, median_household_income, CASE WHEN median_home_value >= 0 THEN median_home_value END AS median_home_value,
  round_even((pop_bachelors + pop_masters + pop_professional + CASE WHEN pop_doctorate >= 0 THEN pop_doctorate END) / nullif(pop_25_plus, 0) * 100, 1) AS pct_college_educated,
  substr('0' || block_fips, 2, 12) AS block_group FROM demographics"""))
def x22(t):
    return tidy(W.clean_demographics(t.demographics).select(
        "block_fips", "median_household_income", "median_home_value", "pct_college_educated",
        F.substring("block_fips", 1, 12).alias("block_group"),
    ))


@query("x23_feature_transforms", oracle("homes", """
SELECT strap, round(ln(1 + greatest(coalesce(saleprice, (SELECT median(saleprice) FROM homes)), 1)), 6) AS log_price,
  CASE WHEN age < 10 THEN '0-10' WHEN age < 20 THEN '10-20' WHEN age < 30 THEN '20-30' ELSE '30+' END AS sale_bin,
  CAST(floor(age2 / 10) * 10 AS BIGINT)::VARCHAR || '-' || CAST(floor(age2 / 10) * 10 + 10 AS BIGINT)::VARCHAR AS build_bin,
  CASE trim(carstoragetypedscr) WHEN '0' THEN 'no_garage' WHEN 'ATTACHED GARAGE AREA' THEN 'attached_garage' WHEN 'DETACHED GARAGE' THEN 'detached_garage' ELSE 'other' END AS garage,
  round(a * b, 4) AS raw, round(ln(1 + a) * b, 4) AS log_a, round(ln(1 + a) * ln(1 + b), 6) AS log_both, round(sqrt(a) * sqrt(b), 6) AS sqrt_both
FROM (SELECT *, greatest(coalesce(2000 - sy, (SELECT median(2000 - sy) FROM aged)), 0) AS age,
  greatest(coalesce(2000 - built, (SELECT median(2000 - built) FROM aged)), 0) AS age2,
  coalesce(sqft, 0) AS a, coalesce(area_building, (SELECT median(area_building) FROM homes)) AS b FROM aged)""", aged=AGED))
def x23(t):
    homes = t.homes.withColumns({
        "sale_age": (2000 - D.sale_year(c("saledate"))).cast("double"),
        "build_age": 2000 - F.greatest("yearbuilt", "year_built_effective_date"),
    })
    med = median_scalars(homes, ["saleprice", "sale_age", "build_age", "sqft", "area_building"])
    a, b = W.filled("sqft", med), W.filled("area_building", med)
    return tidy(homes.select(
        "strap", W.log_scaled("saleprice", med).alias("log_price"),
        W.sale_bin(W.filled("sale_age", med)).alias("sale_bin"),
        W.decade_bin(W.filled("build_age", med)).alias("build_bin"),
        W.garage(c("carstoragetypedscr")).alias("garage"),
        F.round(W.interaction(a, b, "raw"), 4).alias("raw"), F.round(W.interaction(a, b, "log_a"), 4).alias("log_a"),
        W.interaction(a, b, "log_both").alias("log_both"), W.interaction(a, b, "sqrt_both").alias("sqrt_both"),
    ))


@query("x24_index_from_file", oracle("", """
SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN NULL WHEN doc_id % 5 = 3 THEN 12 ELSE doc_id END AS home FROM documents"""))
def x24(t):
    k, n = c("doc_id"), c("doc_id").cast("string")
    name = (
        F.when(k % 5 == 0, F.concat(n, F.lit("_original_index.png")))
        .when(k % 5 == 1, F.concat(F.lit("COUNTY_CO_"), n, F.lit(".png")))
        .when(k % 5 == 2, F.concat(F.lit("img"), n, F.lit("x.jpeg")))
        .when(k % 5 == 3, F.lit("a12b7_c.png")).otherwise(F.lit("none.png"))
    )
    return t.documents.select("doc_id", X.index_from_file(name).alias("home"))


@query("x25_model_response", oracle("", """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'Yes' WHEN 1 THEN 'Yes' ELSE 'No' END AS solar_panels,
  round(CASE WHEN event_id % 6 < 3 THEN least(greatest(value / 50, 0), 1) ELSE 0 END, 6) AS solar_confidence,
  CASE event_id % 6 WHEN 0 THEN 'Good' ELSE 'Unknown' END AS roof_condition FROM events"""))
def x25(t):
    k, v = c("event_id"), (c("value") / 50).cast("string")
    body = F.concat(
        F.lit('{"'), F.when(k % 6 == 1, "solar").otherwise("solar_panels"), F.lit('": "'),
        F.when(k % 6 == 2, "Maybe").otherwise(" Yes "), F.lit('", "solar_confidence": '), v,
        F.lit(', "roof_condition": "'), F.when(k % 6 == 0, "Good").otherwise("Fine"), F.lit('"}'),
    )
    text = (
        F.when(k % 6 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```")))
        .when(k % 6 <= 2, body).when(k % 6 == 3, F.lit("")).when(k % 6 == 4, F.lit("{broken"))
    )
    out = t.events.select("event_id", W.read_model_response(text).alias("r"))
    return tidy(out.select("event_id", "r.solar_panels", "r.solar_confidence", "r.roof_condition"))


@query("x26_card_fields", oracle("homes home_scores", """
SELECT strap, coalesce(CASE WHEN trim(o1) <> '' THEN CASE WHEN o2 IS NOT NULL THEN o1 || ' & ' || o2 ELSE o1 END END, '—') AS owners,
  upper(city) || ', ' || upper(state2) || CASE WHEN try_cast(szip5 AS DOUBLE) IS NOT NULL AND szip5 <> 'nan' THEN ' ' || CAST(CAST(floor(try_cast(szip5 AS DOUBLE)) AS BIGINT) AS VARCHAR) ELSE '' END AS place,
  CASE WHEN saleprice IS NULL THEN '—' ELSE '$' || format('{:,}', CAST(trunc(abs(saleprice)) AS BIGINT)) END AS price,
  CASE WHEN solar_panels IN (' Yes ', 'yes') THEN 'N/A' ELSE coalesce(CAST(model_score AS VARCHAR), '—') END AS score
FROM (SELECT *, CASE original_index % 12 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'C' END AS o1,
  CASE WHEN original_index % 2 = 0 THEN 'D' END AS o2 FROM homes LEFT JOIN home_scores ON strap = home_index)"""))
def x26(t):
    k = c("original_index")
    one = F.when(k % 12 == 0, "A").when(k % 12 == 1, "B").when(k % 12 == 2, "").when(k % 12 == 3, F.lit(None)).otherwise("C")
    two = F.when(k % 2 == 0, "D")
    price = F.abs(c("saleprice").cast("bigint")).cast("string")
    return t.homes.join(t.home_scores, c("strap") == c("home_index"), "left").select(
        "strap", X.owners_line(one, two).alias("owners"),
        X.place_line(c("city"), c("state2"), X.zip_text(c("szip5")), k).alias("place"),
        X.money(price).alias("price"),
        X.score_text(F.lower(F.trim("solar_panels")) == "yes", c("model_score")).alias("score"),
    )


@query("x27_map_points", oracle("homes home_scores", """
SELECT strap AS "index", lat, lon, coalesce(nullif(concat_ws(', ', nullif(trim(address), ''), nullif(trim(city), '')), ''), strap) AS label,
  CAST(coalesce(lower(trim(solar_panels)) = 'yes', false) AS BIGINT) AS has_solar, model_score
FROM homes JOIN home_scores ON strap = home_index WHERE lat IS NOT NULL AND lon IS NOT NULL AND model_score >= 20""").replace("lat, lon,", "round(lat, 6) AS lat, round(lon, 6) AS lon,"))
def x27(t):
    points = t.homes.join(t.home_scores, c("strap") == c("home_index")).select(
        c("strap").alias("index"), "lat", "lon", "address", "city", "model_score",
        (F.lower(F.trim("solar_panels")) == "yes").alias("has_solar"),
    )
    return tidy(W.map_points(points, "model_score", 20))


@query("x28_email_order", oracle("", """
SELECT user_id, string_agg(event_type, ',' ORDER BY event_type NOT IN ('view', 'click'), event_type) AS addresses
FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1"""))
def x28(t):
    # Five kinds at most per user, so the set per user stays small.
    sets = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("a"))
    return sets.select(
        "user_id", F.array_join(X.personal_first(c("a"), F.array(F.lit("view"), F.lit("click"))), ",").alias("addresses")
    )


@query("x29_address_text", oracle("homes", """
SELECT strap, trim(coalesce(mailadd, '')) || ', ' || trim(coalesce(city, '')) || ', ' || trim(state2) AS address FROM homes"""))
def x29(t):
    return t.homes.select("strap", X.address_text(c("mailadd"), c("city"), c("state2")).alias("address"))
