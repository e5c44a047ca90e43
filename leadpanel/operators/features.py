"""Derived home, roof and model-input columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadpanel.functions import roof as R
from leadpanel.functions import text as X
from leadpanel.operators.ranking import median_scalars

c = F.col


def roofs_from_segments(segments: DataFrame, key: str = "original_index") -> DataFrame:
    """The delivered layout, one row per roof: the number of its segments and the 25 largest of them.

    ``row_number() <= 25`` is cut inside each task before the shuffle, so a roof
    with very many segments never gathers in one task; the count is combined map-side.
    """
    largest = Window.partitionBy(key).orderBy(c("area").desc(), "idx", "tie")
    top = segments.withColumn("_rn", F.row_number().over(largest)).where(c("_rn") <= R.MAX_SEGMENTS)
    arrays = top.groupBy(key).agg(F.collect_list(F.struct("azimuth", "area", "avg_sun")).alias("segments"))
    return arrays.join(segment_counts(segments, key), key)


def segment_counts(segments: DataFrame, key: str = "original_index") -> DataFrame:
    return segments.groupBy(key).agg(F.count(F.lit(1)).alias("segment_count"))


def roof_profiles(segments: DataFrame, key: str = "original_index") -> DataFrame:
    """Facings, totals and the roof score of all segments of a roof, from map-side sums and maxima."""
    return segments.groupBy(key).agg(*[col.alias(name) for name, col in R.profile(c("azimuth"), c("area"), c("avg_sun")).items()])


def solar_scores(segments: DataFrame, key: str = "original_index") -> DataFrame:
    """Best segment's score per roof, over all its segments; their number is counted first."""
    sized = segments.join(segment_counts(segments, key), key)
    best = F.max(R.segment_score(c("azimuth"), c("area"), c("avg_sun"), c("segment_count")))
    return sized.groupBy(key).agg(best.alias("_best"), F.max(R.faces(c("azimuth"), c("area"))).alias("_faces")).select(
        key, F.when(c("_faces"), F.round("_best", 2)).otherwise(R.FLOOR).alias("solar_score"))


def rescale_to_max(df: DataFrame, score: str) -> DataFrame:
    """Scores as a share of the largest, times 100; unchanged when the largest is not positive."""
    top = df.agg(F.max(score).alias("_top"))  # one row
    return df.crossJoin(F.broadcast(top)).withColumn(
        score, F.when(c("_top") > 0, c(score) / c("_top") * 100).otherwise(c(score))
    ).drop("_top")


# Score blend.
MODEL_SHARE, ROOF_SHARE = 0.6, 0.4


def hybrid(model: Column, roof: Column, digits: int = 0) -> Column:
    """Blend of both scores, rounded half up; whichever exists when one is missing."""
    return F.when(
        model.isNotNull() & roof.isNotNull(), F.round(MODEL_SHARE * model + ROOF_SHARE * roof, digits)
    ).otherwise(F.coalesce(model, roof).cast("double"))


SENTINEL_COLUMNS = [
    "median_household_income", "median_home_value", "median_year_built", "pop_bachelors", "pop_masters",
    "pop_professional", "pop_doctorate", "pop_25_plus",
]


def share(parts: list[str], whole: str) -> Column:
    """Percent of the whole with one decimal, half to even; a zero whole gives null."""
    total = sum((c(p) for p in parts[1:]), c(parts[0]))
    return F.bround(total / F.nullif(c(whole), F.lit(0.0)) * 100, 1)


def clean_demographics(regions: DataFrame) -> DataFrame:
    """Negative sentinels become null; education share is derived."""
    cleaned = regions.withColumns({n: F.when(c(n) >= 0, c(n)) for n in SENTINEL_COLUMNS})
    return cleaned.withColumn(
        "pct_college_educated",
        share(["pop_bachelors", "pop_masters", "pop_professional", "pop_doctorate"], "pop_25_plus"),
    )


def per(a: str, b: str) -> Column:
    return c(a) / F.nullif(c(b), F.lit(0.0))


def ratios(df: DataFrame, area: str = "mainfloorsf") -> DataFrame:
    """Income, value, age and price ratios; the first two filled with their medians."""
    out = df.withColumns({
        "calculated_build_year": F.greatest("yearbuilt", "year_built_effective_date"),
        "income_per_sqft": per("median_household_income", area),
        "home_value_to_income": per("median_home_value", "median_household_income"),
        "land_price_sqft": per("saleprice", "sqft"),
        "building_price_sqft": per("saleprice", area),
    })
    med = median_scalars(out, ["income_per_sqft", "home_value_to_income"])
    return out.withColumns({
        **{n: F.coalesce(c(n), F.lit(v)) for n, v in med.items()},
        "census_vs_property_age": F.coalesce(c("median_year_built") - c("calculated_build_year"), F.lit(0.0)),
    })


# Years that count as recent.
RECENT_BUILD, RECENT_PURCHASE = 7, 3


def recency(df: DataFrame) -> DataFrame:
    """Columns from year, sale_year, calculated_build_year; a sale after the year is not yet known."""
    year, sale = c("year"), c("sale_year")
    flag = lambda cond: F.coalesce(cond, F.lit(False)).cast("int")
    since_build = (year - c("calculated_build_year")).cast("int")
    return df.withColumns({
        "time_since_sale": F.when(year >= sale, year - sale),
        "time_since_build": since_build,
        "recent_build": flag(since_build <= RECENT_BUILD),
        "recent_purchase": flag(sale.between(year - RECENT_PURCHASE, year)),
    })


# Load factors per appliance.
LOADS = {
    "pool_hot_tub": 0.20, "ev_charger": 0.30, "battery": 0.10, "water_heater_electric": 0.10,
}
HEAT_LOAD, COOLING_LOAD, EVAPORATIVE_LOAD = 0.15, 0.25, 0.05


def electricity_proxy(median_area: float | None, area: tuple[str, ...] = ("mainfloorsf", "area_building")) -> Column:
    """Floor area times the load factors of heating, cooling and appliances."""
    base = F.greatest(F.coalesce(*[c(a) for a in area], F.lit(median_area)), F.lit(100.0))
    words = lambda name, pattern: F.coalesce(F.upper(name).rlike(pattern), F.lit(False))
    one = lambda cond: cond.cast("int")
    load = (
        1.0 + HEAT_LOAD * one(words("heatingdscr", "ELECTRIC|HEAT PUMP") | (c("heat_pump") == 1))
        + COOLING_LOAD * one(words("acdscr", "WHOLE HOUSE") | (c("ac") == 1))
        + EVAPORATIVE_LOAD * one(words("acdscr", "EVAPORATIVE") | (c("evaporative_cooler") == 1))
    )
    for name, weight in LOADS.items():
        load = load + weight * F.coalesce(c(name), F.lit(0))
    return base * load


# ---- model inputs --------------------------------------------------------------------
def filled(name: str, medians: dict[str, float | None]) -> Column:
    return F.coalesce(c(name).cast("double"), F.lit(medians.get(name)))


def log_scaled(name: str, medians: dict[str, float | None]) -> Column:
    return F.log1p(F.greatest(filled(name, medians), F.lit(1.0)))


def sale_bin(age: Column) -> Column:
    age = F.greatest(age, F.lit(0.0))
    return F.when(age < 10, "0-10").when(age < 20, "10-20").when(age < 30, "20-30").otherwise("30+")


def decade_bin(age: Column, width: int = 10) -> Column:
    low = (F.floor(F.greatest(age, F.lit(0.0)) / width) * width).cast("bigint")
    return F.concat(low.cast("string"), F.lit("-"), (low + width).cast("string"))


# Garage recode; everything else is "other".
GARAGE = {
    "0": "no_garage", "ATTACHED GARAGE AREA": "attached_garage", "DETACHED GARAGE": "detached_garage",
}


def garage(text: Column) -> Column:
    recode = F.create_map(*[F.lit(x) for pair in GARAGE.items() for x in pair])
    return F.coalesce(F.try_element_at(recode, F.coalesce(F.trim(text), F.lit(""))), F.lit("other"))


def interaction(a: Column, b: Column, kind: str = "raw") -> Column:
    """Product of two columns, either side optionally on a log or root scale."""
    def scaled(x: Column, side: str) -> Column:
        positive = F.greatest(x, F.lit(0.0))
        if kind in (f"log_{side}", "log_both"):
            return F.log1p(positive)
        if kind in (f"sqrt_{side}", "sqrt_both"):
            return F.sqrt(positive)
        return x

    return scaled(a, "a") * scaled(b, "b")


# ---- model answers ----------------------------------------------------------------------
# Allowed answers and defaults.
ANSWERS = {
    "solar_panels": (["Yes", "No"], "No"),
    "roof_condition": (["Good", "Poor", "Unknown"], "Unknown"),
    "image_quality": (["Good", "Blurry", "Other"], "Other"),
}
CONFIDENCES = ["solar_confidence", "roof_confidence", "image_quality_confidence"]


def read_model_response(text: Column) -> Column:
    """Answer text (maybe fenced JSON) as a struct of allowed answers and confidences in 0..1."""
    body = F.regexp_replace(F.trim(text), r"^```(?i:json)?\s*", "")
    body = F.regexp_replace(body, r"\s*```$", "")
    field = lambda name: F.get_json_object(body, f"$.{name}")

    def answer(name: str) -> Column:
        allowed, default = ANSWERS[name]
        given = F.trim(F.coalesce(field(name), field("solar")) if name == "solar_panels" else field(name))
        return F.when(given.isin(allowed), given).otherwise(F.lit(default)).alias(name)

    def confidence(name: str) -> Column:
        value = F.coalesce(field(name).try_cast("double"), F.lit(0.0))
        return F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)).alias(name)

    return F.struct(*[answer(n) for n in ANSWERS], *[confidence(n) for n in CONFIDENCES])


def map_points(points: DataFrame, score: str, minimum: float) -> DataFrame:
    """Points with finite coordinates and at least the minimum score, labelled for a map."""
    return points.where(
        c("lat").isNotNull() & ~F.isnan("lat") & c("lon").isNotNull() & ~F.isnan("lon") & (c(score) >= minimum)
    ).select(
        "index", "lat", "lon", X.point_label(c("address"), c("city"), c("index")).alias("label"),
        F.coalesce("has_solar", F.lit(False)).alias("has_solar"), score,
    )
