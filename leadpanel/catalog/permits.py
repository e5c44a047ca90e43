from pyspark.sql import functions as F

from leadpanel.catalog.registry import oracle, query
from leadpanel.catalog.sql_parts import EXPLODED, FLAGGED, TYPED, any_in, has, parsed_date
from leadpanel.catalog.tables import scratch
from leadpanel.catalog.tidy import tidy
from leadpanel.functions import permit_rules as R
from leadpanel.functions.dates import clean_issue_date
from leadpanel.operators import permits as P
from leadpanel.operators import quality as Q
from leadpanel.operators.sampling import stratified_by_type
from leadpanel.sources import versions as V

FLAG_LIST = ", ".join(R.FLAGS)


@query("c1_permit_flags", oracle("permits", f"SELECT permit_num, {FLAG_LIST} FROM flagged", flagged=FLAGGED))
def c1(t):
    return tidy(P.compute_flags(t.permits).select("permit_num", *R.FLAGS))


@query("c2_category_and_text_match", oracle("permits", f"""
SELECT permit_num, CAST({any_in("lower(coalesce(permit_category, ''))", R.CATEGORY_KEYWORDS['windows_doors'])} AS BIGINT) AS category_hit,
  CAST(regexp_matches(txt, '{R.PATTERNS["pool_hot_tub"]}') AND NOT regexp_matches(txt, '{R.PATTERNS["pool_hot_tub_not"]}') AS BIGINT) AS text_hit
FROM (SELECT *, lower(coalesce(description, '')) AS txt FROM permits)"""))
def c2(t):
    text = F.lower(F.coalesce("description", F.lit("")))
    return tidy(t.permits.select(
        "permit_num",
        P.category_has(F.col("permit_category"), R.CATEGORY_KEYWORDS["windows_doors"]).alias("category_hit"),
        P.text_matches(text, "pool_hot_tub", "pool_hot_tub_not").alias("text_hit"),
    ))


@query("c3_target_rule", oracle("permits", """
SELECT coalesce(permit_category, '') AS category, coalesce(description, '') AS description,
  CAST(sum(solar_pv) AS BIGINT) AS n_target, count(*) AS n FROM flagged GROUP BY ALL""", flagged=FLAGGED))
def c3(t):
    flags = P.compute_flags(t.permits)
    return tidy(flags.groupBy(
        F.coalesce("permit_category", F.lit("")).alias("category"),
        F.coalesce("description", F.lit("")).alias("description"),
    ).agg(F.sum("solar_pv").alias("n_target"), F.count(F.lit(1)).alias("n")))


@query("c4_permit_type", oracle("permits", "SELECT permit_num, permit_type FROM typed", flagged=FLAGGED, typed=TYPED))
def c4(t):
    return P.classify(t.permits).select("permit_num", "permit_type")


@query("c5_explode_types", oracle(
    "permits", "SELECT permit_num, permit_type FROM exploded", flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def c5(t):
    return P.explode_types(P.classify(t.permits)).select("permit_num", "permit_type")


AS_OF = 2001


@query("c6_parse_stage", oracle("permits", f"""
SELECT strap, permit_num, permit_type, {FLAG_LIST}, CAST(CASE WHEN d <> DATE '1899-12-30' AND year(d) <= {AS_OF} THEN d END AS VARCHAR) AS issue_dt
FROM (SELECT *, {parsed_date('issue_dt')} AS d FROM typed)""", flagged=FLAGGED, typed=TYPED))
def c6(t):
    # Output order is presentation only, so no global sort is paid for.
    staged = P.classify(t.permits).withColumn("issue_dt", clean_issue_date(F.col("issue_dt"), AS_OF))
    return tidy(staged.select("strap", "permit_num", "permit_type", *R.FLAGS, "issue_dt"))


RULES = "concat_ws(', ', " + ", ".join(
    f"CASE WHEN {any_in('lower(category)', words)} THEN '{rule}' END" for rule, words in R.CATEGORY_KEYWORDS.items()
) + ")"


@query("d1_category_coverage", oracle("permits", f"""
SELECT category, n_permits, {RULES} AS rules, CAST({RULES} = '' AND n_permits > 50 AS BIGINT) AS needs_rule
FROM (SELECT coalesce(permit_category, '(empty)') AS category, count(*) AS n_permits FROM permits GROUP BY 1)"""))
def d1(t):
    return tidy(Q.category_coverage(t.permits))


DIST = """SELECT e.permit_type, count(*) AS n, (SELECT count(*) FROM typed) AS total,
  100.0e0 * count(*) / (SELECT count(*) FROM typed) AS pct FROM exploded e GROUP BY 1"""


def saved_baseline(t):
    """The report over the permits issued up to 1997, stored as a run of that year leaves it, and read again."""
    path = scratch(t.spark, "baseline")
    V.reload(Q.type_distribution(P.classify(t.permits.where(F.year("issue_date") <= 1997))), path)
    return V.read_version(t.spark, path)


@query("d2_type_distribution", oracle("permits", """
SELECT coalesce(d.permit_type, b.permit_type) AS permit_type, n, total, round(d.pct, 6) AS pct,
  round(b.pct, 6) AS baseline_pct, round(d.pct - b.pct, 6) AS delta_pct
FROM dist d FULL JOIN (SELECT e.permit_type, 100.0e0 * count(*) / (SELECT count(*) FROM typed WHERE year(issue_date) <= 1997) AS pct
  FROM exploded e WHERE year(issue_date) <= 1997 GROUP BY 1) b ON d.permit_type = b.permit_type""",
    flagged=FLAGGED, typed=TYPED, exploded=EXPLODED, dist=DIST))
def d2(t):
    return tidy(Q.type_distribution(P.classify(t.permits), saved_baseline(t)))


@query("d2_distribution_warnings", oracle("permits", """
SELECT 'other high' AS warning, round(pct, 6) AS pct FROM dist WHERE permit_type = 'other' AND pct > 50
UNION ALL SELECT 'solar high', round(pct, 6) FROM dist WHERE permit_type = 'solar' AND pct > 5
UNION ALL SELECT 'solar low', round(coalesce(max(CASE WHEN permit_type = 'solar' THEN pct END), 0), 6) FROM dist
  HAVING coalesce(max(CASE WHEN permit_type = 'solar' THEN pct END), 0) < 0.1 AND max(total) > 1000""",
    flagged=FLAGGED, typed=TYPED, exploded=EXPLODED, dist=DIST))
def d2w(t):
    return tidy(Q.distribution_warnings(Q.type_distribution(P.classify(t.permits))))


PAIRS = """SELECT coalesce(permit_category, '(no category)') AS category,
  coalesce(description, '(no description)') AS description, count(*) AS n
FROM typed WHERE trim(permit_type) = 'other' GROUP BY 1, 2 ORDER BY n DESC, category, description LIMIT 30"""


@query("d3_unclassified_pairs", oracle("permits", PAIRS, flagged=FLAGGED, typed=TYPED))
def d3(t):
    return Q.unclassified_pairs(P.classify(t.permits))


@query("t6_top_categories", oracle("permits", """
SELECT coalesce(permit_category, '(empty)') AS category, count(*) AS n FROM typed WHERE permit_type = 'other'
GROUP BY 1 ORDER BY n DESC, category LIMIT 20""", flagged=FLAGGED, typed=TYPED))
def t6(t):
    return (
        P.explode_types(P.classify(t.permits)).where(F.col("permit_type") == "other")
        .groupBy(F.coalesce("permit_category", F.lit("(empty)")).alias("category"))
        .agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category").limit(20)
    )


@query("d4_shared_texts", oracle("permits", """
SELECT description, count(DISTINCT strap) AS n_homes, count(*) AS n_permits FROM permits
WHERE trim(description) <> '' AND length(description) > 30 GROUP BY 1 HAVING count(DISTINCT strap) > 2"""))
def d4(t):
    return Q.shared_texts(t.permits)


@query("d4_shared_document_texts", oracle("", """
SELECT md5(text) AS text_key, count(DISTINCT doc_id) AS n_homes, count(*) AS n_permits FROM documents
WHERE trim(text) <> '' AND length(text) > 30 GROUP BY text HAVING count(DISTINCT doc_id) > 2"""))
def d4_documents(t):
    docs = t.documents.select(F.col("text").alias("description"), F.col("doc_id").cast("string").alias("strap"))
    return Q.shared_texts(docs).select(F.md5("description").alias("text_key"), "n_homes", "n_permits")


@query("d5_valuation_stats", oracle("permits", """
SELECT permit_type, count(*) AS n, round(avg(estimated_value), 6) AS mean, round(min(estimated_value), 6) AS min,
  round(max(estimated_value), 6) AS max, round(100.0e0 * count(*) FILTER (estimated_value IS NULL) / count(*), 6) AS pct_null,
  round(median(estimated_value), 6) AS median FROM exploded GROUP BY 1""",
    flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def d5(t):
    return tidy(Q.valuation_stats(P.classify(t.permits)))


@query("d5_cheap_target", oracle("permits", """
SELECT permit_num, round(estimated_value, 6) AS estimated_value FROM exploded
WHERE permit_type = 'solar' AND estimated_value < 3000""", flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def d5c(t):
    return tidy(Q.cheap_target(P.classify(t.permits)).select("permit_num", "estimated_value"))


@query("d6_match_counts", oracle("permits homes", """
SELECT count(*) AS n_rows, count(h.strap) AS n_matched, count(*) FILTER (h.saleprice IS NULL) AS n_without_value
FROM permits p LEFT JOIN homes h ON p.strap = h.strap"""))
def d6(t):
    return Q.match_counts(t.permits, t.homes, "strap", "saleprice")


AGREE = """SELECT *, list_contains(list_transform(string_split(permit_type, ','), lambda x: trim(x)), ai_type) AS agrees
FROM typed JOIN reviews USING (permit_num)"""


def _section(kind, rule, other, where="true"):
    return f"""SELECT '{kind}' AS section, {rule} AS rule_type, {other} AS ai_type, count(*) AS n,
  CAST(sum(CAST(agrees AS BIGINT)) AS BIGINT) AS n_agree FROM agree WHERE {where} GROUP BY ALL"""


@query("e7_reviewer_agreement", oracle("permits reviews", " UNION ALL ".join([
    f"SELECT 'overall' AS section, '*' AS rule_type, '*' AS ai_type, count(*) AS n, CAST(sum(CAST(agrees AS BIGINT)) AS BIGINT) AS n_agree FROM agree",
    _section("by_type", "permit_type", "'*'"),
    _section("pair", "permit_type", "ai_type", "NOT agrees"),
    _section("confident", "permit_type", "ai_type", "NOT agrees AND ai_confidence = 'high'"),
    _section("missed", "permit_type", "ai_type", "NOT agrees AND trim(permit_type) = 'other'"),
]), flagged=FLAGGED, typed=TYPED, agree=AGREE))
def e7(t):
    return tidy(Q.agreement_report(Q.reviewer_agreement(P.classify(t.permits), t.reviews)))


@query("t7_stratified_sample", oracle("permits", """
SELECT permit_num, permit_type FROM typed WHERE permit_num IN (SELECT permit_num FROM
 (SELECT permit_num, row_number() OVER (PARTITION BY permit_type ORDER BY CAST('0x' || substr(md5(concat(permit_num, '-42')), 1, 12) AS BIGINT), permit_num) AS rn
  FROM exploded) WHERE rn <= 20)""", flagged=FLAGGED, typed=TYPED, exploded=EXPLODED))
def t7(t):
    return tidy(stratified_by_type(P.classify(t.permits), 20).select("permit_num", "permit_type"))
