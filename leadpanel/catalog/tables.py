import functools
import os
import uuid

from pyspark.sql import functions as F

from leadpanel.catalog.expressions import sql_distance
from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.tidy import tidy
from leadpanel.functions import text as X
from leadpanel.functions.dates import sale_year
from leadpanel.operators import filters as L
from leadpanel.operators import joins as J
from leadpanel.operators import sampling as SA
from leadpanel.operators import topk as K
from leadpanel.session import ensure_checkpoint_dir
from leadpanel.sources import io as IO
from leadpanel.sources import text_index as X3
from leadpanel.sources import typed_csv as TC
from leadpanel.sources import versions as V

c = F.col
#: Buckets of the keyed tables here: a few for each task.
BUCKETS = 16


def scratch(spark, name):
    """A new folder beside the session's checkpoints, which every executor can reach."""
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


# ---- sources and sinks -------------------------------------------------------------
@query("io1_csv_round_trip", oracle("homes", "SELECT strap, round(lat, 6) AS lat, mainfloorsf, saledate FROM homes"))
def io1(t):
    path = scratch(t.spark, "csv")
    IO.write_table(t.homes.select("strap", "lat", "mainfloorsf", "saledate"), path, "csv")
    return tidy(IO.read_csv(t.spark, path, "strap string, lat double, mainfloorsf double, saledate string"))


def soiled_csv(t):
    """The homes as a file: letters for every thirteenth build year, one cell too few in every seventeenth row."""
    path = scratch(t.spark, "typed")
    year = F.when(c("original_index") % 13 == 0, F.lit("unknown")).otherwise(F.floor("yearbuilt").cast("string"))
    cells = [c("original_index").cast("string"), F.format_string("%06d", "original_index"), F.coalesce(year, F.lit("")),
             F.coalesce(c("saleprice").cast("string"), F.lit("")), F.concat(F.lit('"'), "strap", F.lit(' of\nthe ""list"", as it is"'))]
    line = F.when(c("original_index") % 17 == 5, F.concat_ws(",", *cells[:2])).otherwise(F.concat_ws(",", *cells))
    t.homes.select(line.alias("value")).write.text(path, lineSep="\n")
    # A header of its own in every part, as Spark's own writer gives them, is what the reader expects.
    parts = t.spark.read.text(path, wholetext=True)
    t_path = scratch(t.spark, "typed-parts")
    parts.select(F.concat(F.lit("original_index,code,yearbuilt,saleprice,note\n"), "value").alias("value")).write.text(t_path)
    return TC.read_typed_csv(t.spark, t_path)


@query("io1_typed_csv", oracle("homes", """
SELECT CAST(original_index AS BIGINT) AS original_index, lpad(CAST(original_index AS VARCHAR), 6, '0') AS code, CAST(floor(yearbuilt) AS BIGINT) AS yearbuilt,
  round(saleprice, 6) AS saleprice, strap || ' of' || chr(10) || 'the "list", as it is' AS note
FROM homes WHERE original_index % 13 <> 0 AND original_index % 17 <> 5"""))
def io1_typed(t):
    return tidy(soiled_csv(t).rows)


@query("io1_csv_errors", oracle("homes", """
SELECT CASE WHEN original_index % 17 <> 5 THEN 'yearbuilt' END AS "column", CASE WHEN original_index % 17 <> 5 THEN 'no bigint' ELSE 'wrong number of cells' END AS error,
  count(*) AS n FROM homes WHERE original_index % 13 = 0 OR original_index % 17 = 5 GROUP BY 1, 2"""))
def io1_errors(t):
    return soiled_csv(t).errors.groupBy("column", "error").agg(F.count(F.lit(1)).alias("n"))


@query("io2_pruned_scan", "SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem")
def io2(t):
    return tidy(IO.read_table(t.spark, f"{t.folder}/lineitem.parquet", ["l_orderkey", "l_linenumber"]))


@query("io3_text_keys", oracle("demographics", "SELECT block_fips, CAST(length(block_fips) AS BIGINT) AS n FROM demographics"))
def io3(t):
    path = scratch(t.spark, "keys")
    IO.write_table(t.demographics.select("block_fips"), path, "csv")
    return tidy(IO.read_csv(t.spark, path, "block_fips string").withColumn("n", F.length("block_fips")))


def feeds(t):
    """Two permit feeds with different column names."""
    p = t.permits
    first = p.select("strap", "permit_num", "issue_dt", "permit_category", "description", "estimated_value")
    second = t.events.select(
        c("user_id").cast("double").alias("parcel_id"), c("ts").cast("date").cast("string").alias("permit_date"),
        c("event_type").alias("type"), c("props").alias("work_desc"))
    return [
        IO.load_source(first, IO.PermitSource("city")),
        IO.load_source(second, IO.PermitSource("county", {
            "strap": "parcel_id", "issue_dt": "permit_date", "permit_category": "type", "description": "work_desc"}, True)),
    ]


FEEDS = """SELECT strap, permit_num, issue_dt, permit_category, description, estimated_value, 'city' AS _source FROM permits WHERE strap <> '0'
UNION ALL BY NAME SELECT CAST(user_id AS VARCHAR) AS strap, CAST(CAST(ts AS DATE) AS VARCHAR) AS issue_dt, event_type AS permit_category, props AS description, 'county' AS _source FROM events WHERE user_id <> 0"""


@query("io4_load_source", oracle("permits", "SELECT _source, permit_category, count(*) AS n, count(DISTINCT strap) AS n_straps FROM feeds GROUP BY 1, 2", feeds=FEEDS))
def io4(t):
    return IO.union_sources(feeds(t)).groupBy("_source", "permit_category").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("strap").alias("n_straps"))


@query("u1_union_by_name", oracle("permits", "SELECT strap, permit_num, issue_dt, _source FROM feeds", feeds=FEEDS))
def u1(t):
    return IO.union_sources(feeds(t)).select("strap", "permit_num", "issue_dt", "_source")


@query("io5_table_limit", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100")
def io5(t):
    return IO.read_table(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey"], 100, "o_orderkey")


@query("io6_json_sink", oracle("homes", "SELECT strap, city FROM homes"))
def io6(t):
    path = scratch(t.spark, "json")
    IO.write_table(t.homes.select("strap", "city"), path, "json")
    return t.spark.read.schema("strap string, city string").json(path)


@query("io7_reload_table", oracle("homes", "SELECT strap, county FROM homes"))
def io7(t):
    # The second version is worked out from the first, which stays whole until the manifest names the second.
    path = scratch(t.spark, "reload")
    V.reload(t.homes.select("strap", F.lit("old").alias("county")), path)
    old = V.read_version(t.spark, path).select("strap")
    V.reload(old.join(t.homes.select("strap", "county"), "strap"), path)
    return V.read_version(t.spark, path)


@query("io8_upsert", """
SELECT o_custkey AS home, o_orderpriority AS kind, arg_max(o_orderkey, (is_new, o_orderkey)) AS permit_key, CAST(max(is_new) AS BIGINT) AS is_new
FROM (SELECT *, CAST(o_orderdate >= TIMESTAMP '2000-01-01' AS INTEGER) AS is_new FROM orders) GROUP BY 1, 2""")
def io8(t):
    rows = t.orders.select(
        c("o_custkey").alias("home"), c("o_orderpriority").alias("kind"), c("o_orderkey").alias("permit_key"),
        (c("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).cast("int").alias("is_new"))
    old, new = rows.where(c("is_new") == 0), rows.where(c("is_new") == 1)
    path = scratch(t.spark, "permits")
    V.create_keyed(old, path, ["home", "kind"], BUCKETS, "permit_key")
    V.upsert_keyed(new, path, "permit_key")
    return tidy(V.read_version(t.spark, path))


@query("io9_upsert_columns", oracle("homes home_scores", """
SELECT coalesce(o.strap, n.home_index) AS strap, coalesce(o.image_name, n.image_name) AS image_name, coalesce(n.flag, o.flag) AS flag
FROM (SELECT strap, 'old' || strap AS image_name, solar_panels AS flag FROM homes WHERE designcodedscr <> 'RANCH') o
FULL JOIN (SELECT home_index, 'new' || home_index AS image_name, CASE WHEN model_score > 50 THEN 'Yes' END AS flag FROM home_scores) n ON o.strap = n.home_index"""))
def io9(t):
    old = t.homes.where(c("designcodedscr") != "RANCH").select(
        "strap", F.concat(F.lit("old"), "strap").alias("image_name"), c("solar_panels").alias("flag"))
    new = t.home_scores.select(
        c("home_index").alias("strap"), F.concat(F.lit("new"), "home_index").alias("image_name"),
        F.when(c("model_score") > 50, "Yes").alias("flag"))
    path = scratch(t.spark, "images")
    V.create_keyed(old, path, ["strap"], BUCKETS)
    V.upsert_columns_keyed(new, path, keep_old=["image_name"])
    return V.read_version(t.spark, path)


@query("io10_partial_upsert", oracle("home_scores", """
SELECT home_index, coalesce(n.model_score, o.model_score) AS model_score, o.roof_score AS roof_score
FROM (SELECT home_index, model_score, roof_score FROM home_scores WHERE roof_score >= 30) o
FULL JOIN (SELECT home_index, model_score + 1 AS model_score FROM home_scores WHERE model_score >= 40) n USING (home_index)"""))
def io10(t):
    old = t.home_scores.where(c("roof_score") >= 30)
    new = t.home_scores.where(c("model_score") >= 40).select("home_index", (c("model_score") + 1).alias("model_score"))
    path = scratch(t.spark, "scores")
    V.create_keyed(old, path, ["home_index"], BUCKETS)
    V.upsert_columns_keyed(new, path)
    return tidy(V.read_version(t.spark, path))


@query("io11_validation_report", oracle("homes permits", """
SELECT 'homes' AS "check", 'missing column not_there' AS error UNION ALL SELECT 'census', 'table not found'
UNION ALL SELECT 'homes', 'no value in column strap' FROM homes HAVING count(strap) = 0
UNION ALL SELECT 'homes', 'no value in column lat' FROM homes HAVING count(lat) = 0
UNION ALL SELECT 'homes', 'no value in column lon' FROM homes HAVING count(lon) = 0
UNION ALL SELECT 'permits', 'no value in column strap' FROM permits HAVING count(strap) = 0
UNION ALL SELECT 'permits', 'no value in column issue_dt' FROM permits HAVING count(issue_dt) = 0"""))
def io11(t):
    return IO.validation_report(t.spark, {"homes": t.homes, "permits": t.permits}, {
        "homes": ["strap", "lat", "lon", "not_there"], "permits": ["strap", "issue_dt"], "census": ["strap"]})


# ---- filters -------------------------------------------------------------------------
BUILT = "greatest(yearbuilt, year_built_effective_date)"


@query("f1_rule_filter", oracle("homes", f"""
SELECT strap FROM homes WHERE usedesc IN ('SINGLE FAMILY', 'DUPLEX') AND regexp_matches(zoning_description, 'residential', 'i')
  AND designcodedscr IN ('RANCH', '2-3 STORY') AND mainfloorsf >= 600 AND saleprice >= 100 AND {BUILT} >= 1955"""))
def f1(t):
    return L.apply_rules(t.homes, {
        "usedesc": ["SINGLE FAMILY", "DUPLEX"], "zoning_description_contains": "residential",
        "designcodedscr": ["RANCH", "2-3 STORY"], "mainfloorsf_min": 600, "saleprice_min": 100,
        "calculated_build_year_min": 1955,
    }).select("strap")


@query("f2_owner_occupied", oracle("homes", "SELECT strap FROM homes WHERE substr(coalesce(mailadd, 'nan'), 1, 6) = substr(coalesce(address, 'nan'), 1, 6)"))
def f2(t):
    return L.apply_rules(t.homes, {"owner_occupied": True}).select("strap")


@query("f3_build_year", oracle("homes", f"SELECT strap, {BUILT} AS built FROM homes WHERE {BUILT} >= 1980"))
def f3(t):
    return t.homes.select("strap", L.build_year("yearbuilt", "year_built_effective_date").alias("built")).where(c("built") >= 1980)


@query("f4_true_text", "SELECT event_id FROM events WHERE event_type IN ('view', 'click')")
def f4(t):
    text = F.when(c("event_type") == "view", " True ").when(c("event_type") == "click", "TRUE").when(c("event_type") == "error", "no")
    return t.events.withColumn("ok", text).where(L.is_true_text("ok")).select("event_id")


@query("f5_distance_gate", "SELECT event_id FROM events WHERE value <= 8.5 AND event_id % 5 <> 0")
def f5(t):
    return L.distance_gate(t.events.withColumn(
        "center_distance_m", F.when(c("event_id") % 5 != 0, c("value")))).select("event_id")


@query("f6_review_filter", oracle("homes", """
SELECT strap FROM homes WHERE result_manual_check IS DISTINCT FROM 'Rejected' AND solar_panels = 'No'"""))
def f6(t):
    return t.homes.where(L.is_not("result_manual_check", "Rejected") & (c("solar_panels") == "No")).select("strap")


@query("f7_year_range", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def f7(t):
    return t.orders.where(F.year("o_orderdate").between(1996, 1998)).select("o_orderkey")


@query("f8_since_or_unknown", oracle("homes", "SELECT strap FROM homes WHERE yearbuilt IS NULL OR yearbuilt >= 1985"))
def f8(t):
    return t.homes.where(L.since_or_unknown(c("yearbuilt"), 1985)).select("strap")


@query("f9_optional_predicates", oracle("homes", """
SELECT strap FROM homes WHERE city = 'NATION_3' AND lat >= 40.01 AND lon <= -105.25 AND address ILIKE '%elm%'
  AND coalesce(lower(trim(solar_panels)) = 'yes', false) = false"""))
def f9(t):
    chosen = L.given(
        county=(None, lambda v: c("county") == v), city=("NATION_3", lambda v: c("city") == v),
        search=("elm", lambda v: c("address").ilike(f"%{v}%")),
    )
    not_solar = ~F.coalesce(F.lower(F.trim("solar_panels")) == "yes", F.lit(False))
    return t.homes.where(chosen & L.box("lat", "lon", south=40.01, east=-105.25) & not_solar).select("strap")


def tags(t):
    """Tag list, contact flag and texts per home, from its scores and name."""
    k = c("original_index")
    return t.homes.select(
        "strap", F.array_compact(F.array(
            F.when(k % 3 == 0, " Hot lead"), F.when(k % 5 == 0, "visited"), F.when(k % 7 == 0, "HOTEL"))).alias("tags"),
        (k % 13 == 0).alias("do_not_contact"), "address", "city", "owner")


@query("f10_tag_filter", oracle("homes", """
SELECT strap FROM homes WHERE (original_index % 3 = 0 OR original_index % 7 = 0) AND original_index % 5 <> 0 AND original_index % 13 <> 0"""))
def f10(t):
    return tags(t).where(
        L.any_tag(c("tags"), " HOT") & ~L.any_tag(c("tags"), "visit") & ~F.coalesce("do_not_contact", F.lit(False))
    ).select("strap")


@query("f11_card_search", oracle("homes", """
SELECT strap FROM homes WHERE contains(lower(concat_ws(' ', address, city, owner)), '2 elm street 0 nation_1')"""))
def f11(t):
    return t.homes.where(L.search("2 Elm Street 0 Nation_1 ", "address", "city", "owner")).select("strap")


@query("f11_indexed_search", oracle("homes", """
SELECT strap, address, city FROM homes WHERE contains(lower(concat_ws(' ', address, city, owner)), 'elm street 0 n')"""))
def f11_indexed(t):
    """The same search from a table of trigrams written once."""
    fields = ["address", "city", "owner"]
    path = scratch(t.spark, "cards")
    X3.write_index(t.homes.select("strap", *fields), path, "strap", fields, BUCKETS)
    return X3.indexed_search(t.spark, path, "strap", fields, " ELM Street 0 N").select("strap", "address", "city")


@query("f12_clean_prices", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'CO' WHEN 'click' THEN 'DC' END AS state, round(value, 4) AS price FROM events
WHERE event_type IN ('view', 'click') AND event_id % 7 <> 0 AND value > 0""")
def f12(t):
    state = F.when(c("event_type") == "view", "CO").when(c("event_type") == "click", "DC").when(c("event_type") == "error", "PR")
    text = F.when(c("event_id") % 7 == 0, "NA").otherwise(c("value").cast("string"))
    return L.clean_prices(t.events.select("event_id", state.alias("state"), text.alias("price")), "state", "price")


@query("f13_delivery_projection", oracle("homes", """
SELECT original_index, upper(county) || '_' || state2 || '_' || CAST(original_index AS VARCHAR) AS "index", mailadd AS address,
  upper(city) AS city, area_building AS building_sqft FROM homes"""))
def f13(t):
    homes = t.homes.withColumns({
        "city": F.upper("city"), "index": X.home_index(c("county"), c("state2"), c("original_index"))}).drop("address")
    return L.keep_existing(homes, ["original_index", "index", "mailadd", "city", "area_building", "not_there"],
                           {"mailadd": "address", "area_building": "building_sqft"})


@query("f14_serving_projection", oracle("homes", """
SELECT CAST(CAST(trunc(saleprice) AS BIGINT) AS VARCHAR) AS saleprice, CAST(CAST(numrooms AS BIGINT) AS VARCHAR) AS count_rooms,
  nullif(regexp_replace(szip5, '\\.0$', ''), 'nan') AS zip_code, CAST(original_index AS VARCHAR) AS original_index FROM homes"""))
def f14(t):
    return t.homes.select(
        X.whole_text(c("saleprice")).alias("saleprice"), X.whole_text(c("numrooms")).alias("count_rooms"),
        X.zip_text(c("szip5")).alias("zip_code"),
        X.trailing_digits(F.concat(F.lit("R00x"), c("original_index").cast("string"))).alias("original_index"))


HOME_NUMBERS = ["lat", "lon", "saleprice", "yearbuilt", "year_built_effective_date", "area_building", "mainfloorsf", "sqft", "numstories",
                "numrooms", "num_bath", "num_bath_partial", "num_bedrooms"]
HOME_TEXTS = ["saledate", "effective_text", "address", "mailadd", "county", "state2", "szip5", "owner", "subdivision", "usedesc",
              "zoning_description", "designcodedscr", "sales_cd", "heatingdscr", "acdscr", "carstoragetypedscr", "roof_coverdscr",
              "solar_panels", "result_manual_check", "block_fips"]


@query("f15_feature_columns", oracle("homes", " UNION ALL ".join(
    [f"SELECT '{n}' AS feature" for n in HOME_NUMBERS]
    + [f"SELECT '{n}' AS feature FROM homes HAVING count(DISTINCT {n}) <= 20" for n in HOME_TEXTS])))
def f15(t):
    names = L.feature_columns(t.homes, ["strap", "original_index", "city"])
    return t.spark.createDataFrame([(n,) for n in names], "feature string")


ALLOWED = ["strap", "original_index", "yearbuilt", "saleprice", "area_building", "sqft", "garage_count"]


@query("f16_allowlist", oracle("homes", "SELECT strap, original_index, yearbuilt, round(saleprice, 6) AS saleprice, area_building, sqft FROM homes"))
def f16(t):
    return tidy(L.keep_existing(t.homes, ALLOWED))


# ---- joins ------------------------------------------------------------------------------
@query("j1_left_join", oracle("homes home_scores", "SELECT strap, model_score FROM homes LEFT JOIN home_scores ON strap = home_index"))
def j1(t):
    return t.homes.join(t.home_scores, c("strap") == c("home_index"), "left").select("strap", "model_score")


@query("j2_panel_join", oracle("homes permits", """
SELECT g.strap, g.year, coalesce(n, 0) AS n FROM (SELECT strap, unnest(range(1995, 2002)) AS year FROM homes) g
LEFT JOIN (SELECT strap, CAST(year(issue_date) AS BIGINT) AS year, count(*) AS n FROM permits GROUP BY 1, 2) p ON p.strap = g.strap AND p.year = g.year"""))
def j2(t):
    grid = t.homes.select("strap").crossJoin(F.broadcast(t.spark.range(1995, 2002).toDF("year")))
    counts = t.permits.groupBy("strap", F.year("issue_date").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return grid.join(counts, ["strap", "year"], "left").na.fill(0, ["n"])


@query("u3_home_year_grid", oracle("homes", "SELECT strap, unnest(range(1995, 2002)) AS year FROM homes"))
def u3(t):
    # The year side has a fixed handful of rows.
    return t.homes.select("strap").crossJoin(F.broadcast(t.spark.range(1995, 2002).toDF("year")))


@query("j3_dimension_join", oracle("homes demographics", "SELECT strap, median_household_income FROM homes LEFT JOIN demographics USING (block_fips)"))
def j3(t):
    return J.add_dimension(t.homes, t.demographics, ["block_fips"]).select("strap", "median_household_income")


@query("j4_bridge_join", oracle("homes home_scores", """
SELECT h.strap, round(h.lat, 6) AS lat, s.model_score, r.roof_score FROM homes h JOIN home_scores s ON h.strap = s.home_index
LEFT JOIN (SELECT strap, lat, lon, CAST(original_index % 90 AS BIGINT) AS roof_score FROM homes WHERE roof_coverdscr = 'Asphalt') r
  ON r.strap = h.strap AND r.lat = h.lat AND r.lon = h.lon"""))
def j4(t):
    roofs = t.homes.where(c("roof_coverdscr") == "Asphalt").select("strap", "lat", "lon", (c("original_index") % 90).alias("roof_score"))
    bridged = t.homes.select("strap", "lat", "lon").join(t.home_scores.select(c("home_index").alias("strap"), "model_score"), "strap")
    return tidy(bridged.join(roofs, ["strap", "lat", "lon"], "left").drop("lon"))


@query("j5_first_per_key", oracle("", """
SELECT o_custkey, o_orderkey, o_orderpriority FROM orders JOIN customer ON c_custkey = o_custkey
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) = 1"""))
def j5(t):
    joined = t.orders.join(t.customer, c("o_custkey") == c("c_custkey")).select("o_custkey", "o_orderkey", "o_orderpriority")
    return J.first_per_key(joined, ["o_custkey"], [c("o_orderpriority"), c("o_orderkey")])


@query("w14_last_per_key", """
SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""")
def w14(t):
    rows = t.orders.select("o_custkey", "o_orderkey", c("o_orderdate").cast("date").alias("day"))
    return tidy(IO.latest_per_key(rows, ["o_custkey"], [c("day"), c("o_orderkey")]))


@query("j6_outer_scores", oracle("home_scores", """
SELECT home_index, m.model_score, r.roof_score FROM (SELECT home_index, model_score FROM home_scores WHERE model_score IS NOT NULL) m
FULL JOIN (SELECT home_index, roof_score FROM home_scores WHERE roof_score IS NOT NULL) r USING (home_index)"""))
def j6(t):
    kind = lambda n: t.home_scores.where(c(n).isNotNull()).select("home_index", n)
    return kind("model_score").join(kind("roof_score"), "home_index", "outer")


@query("j7_semi_join", oracle("permits home_scores", "SELECT permit_num FROM permits WHERE strap IN (SELECT home_index FROM home_scores)"))
def j7(t):
    return J.known_only(t.permits, t.home_scores.withColumnRenamed("home_index", "strap"), "strap").select("permit_num")


@query("j8_append_unseen", oracle("homes home_scores", """
SELECT home_index AS strap, model_score FROM home_scores UNION ALL SELECT strap, NULL FROM homes WHERE strap NOT IN (SELECT home_index FROM home_scores)"""))
def j8(t):
    stored = t.home_scores.select(c("home_index").alias("strap"), "model_score")
    return J.append_unseen(stored, t.homes.select("strap"), "strap")


@query("u2_unseen_keys", oracle("homes home_scores", "SELECT strap FROM homes WHERE strap NOT IN (SELECT home_index FROM home_scores)"))
def u2(t):
    return J.unseen_only(t.homes.select("strap"), t.home_scores.withColumnRenamed("home_index", "strap"), "strap")


@query("r1_resume", oracle("homes home_scores", """
SELECT strap FROM homes WHERE strap NOT IN (SELECT home_index FROM home_scores WHERE model_score IS NOT NULL)"""))
def r1(t):
    # Done and successful keys are skipped; failed ones (no score) are tried again.
    done = t.home_scores.where(c("model_score").isNotNull()).select(c("home_index").alias("strap"))
    return J.unseen_only(t.homes.select("strap"), done, "strap")


@query("r2_append_new_ids", oracle("homes home_scores", """
SELECT home_index AS strap, roof_score FROM home_scores UNION ALL SELECT strap, NULL FROM homes WHERE strap NOT IN (SELECT home_index FROM home_scores)"""))
def r2(t):
    return J.append_unseen(t.home_scores.select(c("home_index").alias("strap"), "roof_score"), t.homes.select("strap"), "strap")


@query("r3_continue_from_last", """
SELECT event_id FROM events e LEFT JOIN (SELECT event_type, max(CAST(ts AS DATE)) AS last FROM events
  WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'error' GROUP BY 1) s USING (event_type) WHERE last IS NULL OR CAST(ts AS DATE) > last""")
def r3(t):
    # A series with nothing stored yet is filled from its start.
    feed = t.events.select("event_id", c("event_type").alias("series"), c("ts").cast("date").alias("period"))
    stored = feed.where((c("period") < "2024-01-20") & (c("series") != "error"))
    return J.continue_series(feed, stored, "series", "period").select("event_id")


@query("j9_map_keys", oracle("permits home_scores", """
SELECT permit_num, 'H' || home_index AS home_index FROM permits JOIN home_scores ON home_index = strap"""))
def j9(t):
    lookup = t.home_scores.select(c("home_index").alias("strap"), F.concat(F.lit("H"), "home_index").alias("home_index"))
    return J.map_keys(t.permits, lookup, "strap", "home_index").select("permit_num", "home_index")


@query("j12_serving_join", oracle("permits homes", "SELECT permit_num, address, city FROM permits LEFT JOIN homes USING (strap)"))
def j12(t):
    return t.permits.join(t.homes, "strap", "left").select("permit_num", "address", "city")


@query("j13_follows", oracle("follows homes", """
SELECT DISTINCT f.user_id, f.home_index, h.address, h.city FROM follows f JOIN homes h ON h.strap = f.home_index"""))
def j13(t):
    follows = t.follows.select("user_id", "home_index").distinct()
    return follows.join(t.homes.select(c("strap").alias("home_index"), "address", "city"), "home_index")


@query("j14_fill_missing", oracle("homes home_scores", """
SELECT strap, coalesce(mainfloorsf, CAST(roof_score AS DOUBLE)) AS mainfloorsf FROM homes LEFT JOIN home_scores ON strap = home_index"""))
def j14(t):
    source = t.home_scores.select(c("home_index").alias("strap"), c("roof_score").cast("double").alias("mainfloorsf"))
    return J.fill_missing(t.homes.select("strap", "mainfloorsf"), source, "strap", "mainfloorsf")


@query("j15_label_from_lists", oracle("homes", """
SELECT strap, CASE WHEN label IS NULL OR trim(label) = '' THEN CASE WHEN usedesc = 'SINGLE FAMILY' THEN 'No' WHEN designcodedscr = 'RANCH' THEN 'Yes' ELSE label END ELSE label END AS label
FROM (SELECT *, CASE original_index % 3 WHEN 0 THEN ' ' WHEN 1 THEN NULL ELSE 'Maybe' END AS label FROM homes)"""))
def j15(t):
    k = c("original_index")
    labelled = t.homes.select("strap", F.when(k % 3 == 0, " ").when(k % 3 == 2, "Maybe").alias("label"))
    return J.label_from_lists(
        labelled, t.homes.where(c("designcodedscr") == "RANCH"), t.homes.where(c("usedesc") == "SINGLE FAMILY"), "strap", "label")


@query("j16_suffix_join", """
SELECT c_custkey AS key, c_acctbal AS amount, o_totalprice AS amount_test, o_orderkey FROM customer LEFT JOIN
  (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) ON o_custkey = c_custkey""")
def j16(t):
    left = t.customer.select(c("c_custkey").cast("string").alias("key"), c("c_acctbal").alias("amount"))
    right = t.orders.select(c("o_custkey").alias("key"), c("o_totalprice").alias("amount"), "o_orderkey")
    return J.join_with_suffix(left, right.withColumn("key", c("key").cast("string")), "key", [c("o_orderkey")], "_test")


# ---- ordered results ---------------------------------------------------------------------
@query("t1_most_complete", oracle("homes", """
SELECT address, original_index FROM homes QUALIFY row_number() OVER (PARTITION BY address ORDER BY
  (CASE WHEN area_building IS NULL THEN 0 ELSE 1 END + CASE WHEN num_bedrooms IS NULL THEN 0 ELSE 1 END
   + CASE WHEN num_bath IS NULL THEN 0 ELSE 1 END + CASE WHEN numrooms IS NULL THEN 0 ELSE 1 END) DESC, original_index) = 1"""))
def t1(t):
    narrow = t.homes.select("address", "original_index", *K.COMPLETENESS)
    return K.most_complete(narrow).select("address", "original_index")


@query("t2_page", oracle("homes home_scores", """
SELECT strap, model_score FROM homes LEFT JOIN home_scores ON strap = home_index ORDER BY model_score DESC NULLS LAST, strap LIMIT 50 OFFSET 20"""))
def t2(t):
    scored = t.homes.join(t.home_scores, c("strap") == c("home_index"), "left").select("strap", "model_score")
    return K.page(scored, "model_score", "strap", 50, 20)


@query("t2_deep_page", oracle("homes home_scores", """
SELECT strap, model_score, (SELECT count(*) FROM homes LEFT JOIN home_scores ON strap = home_index) AS total_count FROM homes LEFT JOIN home_scores ON strap = home_index
ORDER BY model_score DESC NULLS LAST, strap LIMIT 40 OFFSET (SELECT CAST(count(*) * 3 // 4 AS BIGINT) FROM homes)"""))
def t2_deep(t):
    """Three quarters down the list: only the runs that hold the page are read."""
    scored = t.homes.join(t.home_scores, c("strap") == c("home_index"), "left").select("strap", "model_score")
    path = scratch(t.spark, "ranked")
    V.write_ranked(scored, path, "model_score", "strap", 2 * t.spark.sparkContext.defaultParallelism)
    total = sum(V.manifest(t.spark, path).counts.values())
    return tidy(V.read_page(t.spark, path, 40, total * 3 // 4))


@query("t4_map_points", oracle("homes", """
SELECT strap, round(lat, 6) AS lat, round(lon, 6) AS lon FROM homes WHERE lat >= 40.005 AND lon <= -105.27 ORDER BY strap LIMIT 200"""))
def t4(t):
    return tidy(t.homes.where(L.box("lat", "lon", south=40.005, east=-105.27)).select("strap", "lat", "lon").orderBy("strap").limit(200))


@query("t5_head", "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 25")
def t5(t):
    return t.orders.select("o_orderkey", "o_orderpriority").orderBy("o_orderkey").limit(25)


@query("t8_class_aware_sample", oracle("scored", """
SELECT id, y, round(score, 6) AS score FROM
 (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h, id) AS rn, least(count(*) FILTER (y = 1) OVER (), 100) AS positives
  FROM (SELECT id, CAST(y AS BIGINT) AS y, score, CAST('0x' || substr(md5(concat(id, '-42')), 1, 12) AS BIGINT) AS h FROM scored))
WHERE rn <= CASE y WHEN 1 THEN positives ELSE 200 - positives END"""))
def t8(t):
    return tidy(SA.class_aware(t.scored.select("id", "y", "score"), "y", "id", 200, 50))


@query("t9_folds", oracle("permits", """
SELECT CAST('0x' || substr(md5(concat(strap, '-42')), 1, 12) AS BIGINT) % 5 AS fold, count(*) AS n FROM (SELECT DISTINCT strap FROM permits) GROUP BY 1"""))
def t9(t):
    return tidy(t.permits.select("strap", SA.fold_of("strap", 5).alias("fold")).distinct().groupBy("fold").agg(F.count(F.lit(1)).alias("n")))


@query("t10_ranked_images", oracle("", """
SELECT CAST(floor(page_id / 2) AS BIGINT) AS home_id, arg_min(url, (folder <> 'yes', url)) AS name, round(coalesce(max(s.score), 0), 6) AS score
FROM (SELECT *, CASE page_id % 3 WHEN 0 THEN 'yes' ELSE 'no' END AS folder FROM pages) p
LEFT JOIN (SELECT doc_id, (n_chars % 997) / 997.0e0 AS score FROM documents) s ON s.doc_id = floor(page_id / 2) GROUP BY 1""").replace("WITH RECURSIVE ", ""))
def t10(t):
    images = t.pages.select(
        F.floor(c("page_id") / 2).cast("bigint").alias("home_id"), c("url").alias("name"), F.when(c("page_id") % 3 == 0, "yes").otherwise("no").alias("folder"))
    scores = t.documents.select(c("doc_id").alias("home_id"), ((c("n_chars") % 997) / 997.0).alias("score"))
    return tidy(K.rank_images(images, scores).drop("folder"))
