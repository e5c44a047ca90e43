from pyspark.sql import functions as F

from leadpanel.catalog.expressions import BANDS, HYBRID, OWNER_1, ROOF_SCORE, SOLAR_SCORE, TOP, _expected
from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.sql_parts import EXPLODED, FLAGGED, TYPED
from leadpanel.catalog.tables import scratch
from leadpanel.catalog.tidy import tidy
from leadpanel.operators import features as W
from leadpanel.operators import permits as P
from leadpanel.operators import topk as K
from leadpanel.plans import serve as S
from leadpanel.sources import versions as V

c = F.col


def served(t):
    return t.homes.select(
        c("strap").alias("index"), "original_index", "address", "city", "county", c("lat").alias("latitude"),
        c("lon").alias("longitude"), (F.lower(F.trim("solar_panels")) == "yes").alias("has_solar"),
        c("subdivision").alias("subdivision_formatted"))


SERVED = """SELECT strap AS "index", original_index, address, city, county, lat AS latitude, lon AS longitude, subdivision AS subdivision_formatted,
  lower(trim(solar_panels)) = 'yes' AS has_solar, model_score, roof_score FROM homes LEFT JOIN home_scores ON home_index = strap"""
WHOLE, TENTH = HYBRID.format(d=""), HYBRID.format(d=", 1")


@query("q1_homes_with_scores", oracle("homes home_scores", f"""SELECT "index", model_score, roof_score, CAST({WHOLE} AS DOUBLE) AS hybrid_score FROM served""", served=SERVED))
def q1(t):
    return tidy(S.homes_with_scores(served(t), t.home_scores).select("index", "model_score", "roof_score", "hybrid_score"))


@query("q2_map_points", oracle("homes home_scores", f"""
SELECT "index", round(latitude, 6) AS latitude, model_score, round({TENTH}, 6) AS hybrid_score, address FROM served
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND city = 'NATION_7' AND latitude >= 40.001 AND has_solar IS NOT TRUE ORDER BY "index" LIMIT 1000""", served=SERVED))
def q2(t):
    area = S.Area(city="NATION_7", south=40.001)
    return tidy(S.map_points(served(t), t.home_scores, area, exclude_solar=True).select(
        "index", "latitude", "model_score", "hybrid_score", "address"))


@query("q3_homes_page", oracle("homes home_scores", f"""
SELECT "index", address, hybrid_score, total_count FROM (SELECT *, count(*) OVER () AS total_count FROM
 (SELECT *, CAST({WHOLE} AS DOUBLE) AS hybrid_score FROM served WHERE county = 'MACHINERY' AND address ILIKE '%elm%' AND has_solar IS NOT TRUE AND roof_score >= 20))
ORDER BY hybrid_score DESC NULLS LAST, "index" LIMIT 40 OFFSET 15""", served=SERVED))
def q3(t):
    out = S.homes_page(served(t), t.home_scores, S.Area(county="MACHINERY"), min_roof=20, address_search="ELM", limit=40, offset=15)
    return tidy(out.select("index", "address", "hybrid_score", "total_count"))


@query("q3_ranked_page", oracle("homes home_scores", f"""
SELECT "index", address, hybrid_score, total_count FROM (SELECT *, count(*) OVER () AS total_count FROM
 (SELECT *, CAST({WHOLE} AS DOUBLE) AS hybrid_score FROM served WHERE county = 'MACHINERY' AND has_solar IS NOT TRUE))
ORDER BY hybrid_score DESC NULLS LAST, "index" LIMIT 40 OFFSET 15""", served=SERVED))
def q3_ranked(t):
    """The same page from a table written once in rank order: matches are counted per run, then one run is read."""
    path = scratch(t.spark, "ranked-homes")
    V.write_ranked(S.homes_with_scores(served(t), t.home_scores), path, "hybrid_score", "index", 2 * t.spark.sparkContext.defaultParallelism)
    wanted = (c("county") == "MACHINERY") & ~F.coalesce(c("has_solar"), F.lit(False))
    return tidy(V.read_page(t.spark, path, 40, 15, wanted).select("index", "address", "hybrid_score", "total_count"))


def filed(t):
    rows = P.explode_types(P.classify(t.permits))
    return rows.select(
        c("permit_key").alias("id"), c("strap").alias("home_index"), c("permit_num").alias("permit_number"),
        "permit_type", "description", c("issue_date").alias("filed_date"), c("estimated_value").alias("valuation"))


@query("q4_recent_permits", oracle("permits homes", """
SELECT e.permit_key AS id, e.strap AS home_index, e.permit_type, CAST(e.issue_date AS VARCHAR) AS filed_date, h.address, h.city FROM
 (SELECT * FROM exploded WHERE issue_date >= DATE '2000-12-31' - 400 AND permit_type IN ('solar', 'roof', 'battery', 'ev_charger')
  ORDER BY issue_date DESC, permit_key, permit_type LIMIT 100) e LEFT JOIN homes h ON h.strap = e.strap""",
    flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def q4(t):
    keyed = filed(t).withColumn("id", F.struct("id", "permit_type"))
    out = S.recent_permits(keyed, served(t), "2000-12-31", 400)
    return tidy(out.select(c("id.id").alias("id"), "home_index", "permit_type", "filed_date", "address", "city"))


@query("t3_recent_events", """
SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-28' - 3 AND event_type IN ('purchase', 'signup')
ORDER BY CAST(ts AS DATE) DESC, event_id LIMIT 150""")
def t3(t):
    rows = t.events.withColumn("day", c("ts").cast("date"))
    return K.recent_events(rows, "day", "2024-01-28", 3, ["purchase", "signup"], "event_id", 150, "event_type").select("event_id", "event_type")


@query("q5_home_permits", oracle("permits", """
SELECT strap AS home_index, permit_num AS card, string_agg(permit_type, ',' ORDER BY permit_type) AS types, CAST(min(issue_date) AS VARCHAR) AS filed_date
FROM exploded GROUP BY 1, 2""", flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def q5(t):
    cards = S.home_permits(filed(t).select("id", "home_index", "permit_number", "permit_type", "filed_date"))
    return tidy(cards.select("home_index", "card", F.array_join("types", ",").alias("types"), "filed_date"))


@query("q6_following_board", oracle("follows homes notes", f"""
SELECT f.user_id, f.home_index, coalesce({_expected('h.original_index', OWNER_1)}, '—') AS owner,
  CASE WHEN h.usedesc = 'SINGLE FAMILY' THEN 'Sam • 555-' || f.home_index ELSE 'No contact information for home' END AS contacts,
  CASE WHEN h.original_index % 4 = 1 THEN 'Call back' ELSE 'No open action items' END AS open_items,
  md5(CASE WHEN trim(n.body) <> '' THEN trim(n.body) ELSE 'No comments yet' END) AS comment
FROM (SELECT DISTINCT user_id, home_index FROM follows) f JOIN homes h ON h.strap = f.home_index
LEFT JOIN (SELECT * FROM notes QUALIFY row_number() OVER (PARTITION BY home_index ORDER BY turn DESC, body DESC) = 1) n ON n.home_index = f.home_index
WHERE (h.original_index % 3 = 0 OR h.original_index % 7 = 0) AND h.original_index % 13 <> 0 AND contains(lower(coalesce(h.address, '')), 'elm street')"""))
def q6(t):
    from leadpanel.catalog.tables import tags
    from leadpanel.functions.text import owner_pair

    k = c("original_index")
    home = t.homes.select(
        c("strap").alias("index"), "address", "city", owner_pair(c("owner"))["owner_1"].alias("owner_1"),
        F.lit(None).cast("string").alias("owner_2"))
    org = tags(t).select(c("strap").alias("home_index"), "tags", "do_not_contact")
    contacts = t.homes.where(c("usedesc") == "SINGLE FAMILY").select(
        c("strap").alias("home_index"), F.lit(" Sam").alias("preferred_name"), F.concat(F.lit("555-"), "strap").alias("phone_number"),
        F.lit("").alias("email"))
    items = t.homes.select(
        c("strap").alias("home_index"), F.lit(" Call back").alias("body"), (k % 4 != 1).alias("completed"))
    board = S.following_board(
        t.follows.select("user_id", "home_index").distinct(), home, org, contacts, items, t.notes, tag="hot",
        hide_do_not_contact=True, query="elm street")
    return board.select("user_id", "home_index", "owner", "contacts", "open_items", F.md5("comment").alias("comment"))


@query("q7_ranked_table", oracle("homes home_scores segments", """
SELECT h.strap, s.model_score, r.roof_score FROM homes h JOIN home_scores s ON s.home_index = h.strap
LEFT JOIN (SELECT h2.strap, h2.lat, h2.lon, rs.roof_score FROM homes h2 JOIN rs USING (original_index)) r ON r.strap = h.strap AND r.lat = h.lat AND r.lon = h.lon""",
    top=TOP, rs=ROOF_SCORE))
def q7(t):
    scores = t.home_scores.select(c("home_index").alias("strap"), "model_score")
    made = W.roof_profiles(t.segments).select("original_index", "roof_score")
    roof = t.homes.select("strap", "lat", "lon", "original_index").join(made, "original_index").drop("original_index")
    return tidy(S.ranked_table(t.homes.select("strap", "lat", "lon"), scores, roof).select("strap", "model_score", "roof_score"))


@query("q8_publish_scores", oracle("homes segments", """
SELECT home_index, r.roof_score, m.model_score, 'v1' AS model_version FROM
 (SELECT 'H_' || strap AS home_index, CAST(round_even(roof_score, 0) AS BIGINT) AS roof_score FROM homes JOIN rs USING (original_index)) r
 FULL JOIN (SELECT 'H_' || strap AS home_index, CAST(greatest(1, round_even((rank() OVER (ORDER BY saleprice) + (count(*) OVER (PARTITION BY saleprice) - 1) / 2.0e0) / count(*) OVER () * 100, 0)) AS BIGINT) AS model_score
  FROM homes WHERE saleprice IS NOT NULL) m USING (home_index)""", top=TOP, rs=ROOF_SCORE))
def q8(t):
    bridge = t.homes.select(F.concat(F.lit("H_"), "strap").alias("home_index"), "strap", "original_index")
    roof = W.roof_profiles(t.segments).select("original_index", "roof_score")
    model = t.homes.select("strap", c("saleprice").alias("gb_score"))
    return tidy(S.publish_scores(bridge, roof, model, "gb_score", "v1"))


@query("q9_delivery", oracle("homes segments", """
SELECT original_index, "index", address, city, building_sqft, count_rooms, round(solar_score / max(solar_score) OVER () * 100, 6) AS solar_score, subdivision_formatted FROM
 (SELECT h.original_index, upper(trim(county)) || '_' || state2 || '_' || CAST(h.original_index AS VARCHAR) AS "index", mailadd AS address, upper(city) AS city,
  area_building AS building_sqft, numrooms AS count_rooms, sc.solar_score,
  CASE h.original_index % 7 WHEN 1 THEN 'Village Of Heather' WHEN 0 THEN 'Coal Creek' WHEN 2 THEN 'Park Place' WHEN 4 THEN 'Oak Grove' WHEN 5 THEN 'Sunny Slope' WHEN 6 THEN 'Heart' END AS subdivision_formatted
 FROM homes h LEFT JOIN sc ON sc.original_index = h.original_index WHERE result_manual_check IS DISTINCT FROM 'Rejected' AND solar_panels = 'No')""",
    top=TOP, bands=BANDS, sc=SOLAR_SCORE))
def q9(t):
    out = S.delivery(t.homes.drop("address").join(W.solar_scores(t.segments), "original_index", "left"))
    return tidy(out.select("original_index", "index", "address", "city", "building_sqft", "count_rooms", "solar_score", "subdivision_formatted"))
