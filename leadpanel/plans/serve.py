"""Serving queries over homes, scores, permits and the organisation's own records."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.functions import text as X
from leadpanel.operators import filters as L
from leadpanel.operators.aggs import permit_cards
from leadpanel.operators.features import hybrid, rescale_to_max
from leadpanel.operators.joins import first_per_key
from leadpanel.operators.metrics import published_percentile
from leadpanel.operators.topk import page, recent_events
from leadpanel.sources.io import latest_per_key, upsert_columns

c = F.col


def with_total(filtered: DataFrame, cut: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A page of the rows, each with the count of all of them (one counted row, not a global window)."""
    total = filtered.agg(F.count(F.lit(1)).alias("total_count"))
    return cut(filtered).crossJoin(F.broadcast(total))


def homes_with_scores(homes: DataFrame, scores: DataFrame, digits: int = 0) -> DataFrame:
    """Homes (key ``index``) with both scores and their blend."""
    joined = homes.join(scores.withColumnRenamed("home_index", "index"), "index", "left")
    return joined.withColumn("hybrid_score", hybrid(c("model_score"), c("roof_score"), digits))


def not_solar() -> Column:
    return ~F.coalesce("has_solar", F.lit(False))


@dataclass(frozen=True)
class Area:
    """Optional place filters; what is not given does not reach the plan."""

    county: str | None = None
    city: str | None = None
    south: float | None = None
    north: float | None = None
    west: float | None = None
    east: float | None = None

    def condition(self) -> Column:
        same = L.given(
            county=(self.county, lambda v: c("county") == v), city=(self.city, lambda v: c("city") == v))
        return same & L.box("latitude", "longitude", self.south, self.north, self.west, self.east)


def map_points(homes: DataFrame, scores: DataFrame, area: Area = Area(), limit: int = 1000, exclude_solar: bool = False) -> DataFrame:
    """Points for a map, in key order; homes without coordinates are left out."""
    chosen = homes.where(c("latitude").isNotNull() & c("longitude").isNotNull() & area.condition())
    chosen = chosen.where(not_solar()) if exclude_solar else chosen
    first = chosen.orderBy("index").limit(limit)
    return homes_with_scores(first, scores, 1).select(
        "index", "latitude", "longitude", "model_score", "roof_score", "hybrid_score", "address", "city", "has_solar")


def homes_page(
    homes: DataFrame, scores: DataFrame, area: Area = Area(), sort_by: str = "hybrid", min_model: float | None = None,
    min_roof: float | None = None, subdivision: str | None = None, address_search: str | None = None,
    show_solar: bool = False, limit: int = 100, offset: int = 0,
) -> DataFrame:
    """One page of homes by the chosen score, with the number of all matching homes."""
    where = area.condition() & L.given(
        subdivision=(subdivision, lambda v: c("subdivision_formatted") == v),
        address=(address_search, lambda v: c("address").ilike(f"%{v}%")))
    chosen = homes.where(where if show_solar else where & not_solar())
    scored = homes_with_scores(chosen, scores).where(L.given(
        model=(min_model, lambda v: c("model_score") >= v), roof=(min_roof, lambda v: c("roof_score") >= v)))
    sort = sort_by if sort_by in ("model_score", "roof_score") else "hybrid_score"
    return with_total(scored, lambda df: page(df, sort, "index", limit, offset))


# Types shown by default.
RECENT_TYPES = ["solar", "roof", "battery", "ev_charger"]


def recent_permits(permits: DataFrame, homes: DataFrame, as_of, days: int = 30, types: list[str] = RECENT_TYPES,
                   limit: int = 100) -> DataFrame:
    """Newest permits of the wanted types with the home's address; the limit comes before the join."""
    chosen = recent_events(permits, "filed_date", as_of, days, types, "id", limit)
    places = homes.select(c("index").alias("home_index"), "address", "city")
    return chosen.join(places, "home_index", "left")


def home_permits(permits: DataFrame) -> DataFrame:
    """Each home's permits as cards: one per permit number, or per row without a number."""
    return permit_cards(
        permits, [c("home_index"), F.coalesce("permit_number", c("id").cast("string"))], ["home_index", "card"])


def following_board(
    follows: DataFrame, homes: DataFrame, org: DataFrame, contacts: DataFrame, items: DataFrame, notes: DataFrame,
    tag: str | None = None, without_tag: str | None = None, hide_do_not_contact: bool = False, query: str | None = None,
) -> DataFrame:
    """Followed homes with tags, contacts, open items and the latest comment, filtered and searched."""
    lines = contacts.select("home_index", F.concat_ws(" • ", *[
        F.when(~X.blank(c(n)), F.trim(n)) for n in ("preferred_name", "phone_number", "email")]).alias("line"))
    contact = _joined(lines.where(c("line") != ""), "contacts")
    todo = _joined(items.where(~F.coalesce("completed", F.lit(False)) & ~X.blank(c("body"))).select(
        "home_index", F.trim("body").alias("line")), "open_items")
    latest = latest_per_key(notes.select("home_index", "turn", "body"), ["home_index"], [c("turn"), c("body")])
    board = (
        follows.join(homes.withColumnRenamed("index", "home_index"), "home_index")
        .join(org, "home_index", "left").join(contact, "home_index", "left").join(todo, "home_index", "left")
        .join(latest.select("home_index", F.trim("body").alias("comment")), "home_index", "left")
    )
    if tag:
        board = board.where(L.any_tag(c("tags"), tag))
    if without_tag:
        board = board.where(~L.any_tag(c("tags"), without_tag))
    if hide_do_not_contact:
        board = board.where(~F.coalesce("do_not_contact", F.lit(False)))
    board = board.select(
        *[n for n in follows.columns if n != "home_index"], "home_index",
        X.owners_line(c("owner_1"), c("owner_2")).alias("owner"),
        F.coalesce("contacts", F.lit("No contact information for home")).alias("contacts"),
        F.coalesce("open_items", F.lit("No open action items")).alias("open_items"),
        F.when(~X.blank(c("comment")), c("comment")).otherwise("No comments yet").alias("comment"),
        F.when(F.size("tags") > 0, F.array_join("tags", ", ")).otherwise(X.DASH).alias("tags"),
        "address", "city",
    )
    if query:
        board = board.where(L.search(query, "address", "city", "owner", "contacts", "open_items", "comment", "tags"))
    return board


def _joined(lines: DataFrame, name: str) -> DataFrame:
    """A home's own lines as one sorted text; these are a few typed-in lines per home."""
    return lines.groupBy("home_index").agg(F.array_join(F.array_sort(F.collect_set("line")), "\n").alias(name))


def ranked_table(parcels: DataFrame, scores: DataFrame, roofs: DataFrame) -> DataFrame:
    """Scored parcels only, with the roof record at the same coordinates where there is one."""
    bridged = parcels.join(scores, "strap")
    return bridged.join(roofs, ["strap", "lat", "lon"], "left")


def publish_scores(bridge: DataFrame, roof: DataFrame, model: DataFrame, score: str, version: str) -> DataFrame:
    """Whole roof scores and model percentiles per home index, one row per home, tagged with the version."""
    by_index = lambda df, value: first_per_key(df.select("home_index", value).where(c(value).isNotNull()), ["home_index"], [c(value)])
    roofs = bridge.join(roof, "original_index").withColumn("roof_score", F.bround("roof_score", 0).cast("bigint"))
    models = bridge.join(published_percentile(model, score).select("strap", "model_score"), "strap")
    out = upsert_columns(by_index(roofs, "roof_score"), by_index(models, "model_score"), ["home_index"], [])
    return out.withColumn("model_version", F.lit(version))


# Delivered columns in order, and their published names.
DELIVERED = [
    "original_index", "index", "roof_orientation", "saleprice", "saledate", "owner", "owner_1", "owner_2", "mailadd",
    "city", "county", "state2", "szip5", "subdivision_formatted", "area_building", "roof_coverdscr",
    "calculated_build_year", "latitude", "longitude", "numstories", "numrooms", "num_bath", "num_bath_partial",
    "num_bedrooms", "solar_panels", "solar_score",
]
PUBLISHED = {
    "mailadd": "address", "state2": "state", "owner": "owner_unaltered", "roof_orientation": "qualified_orientations",
    "szip5": "zip_code", "area_building": "building_sqft", "numstories": "count_stories", "numrooms": "count_rooms",
    "num_bath": "count_bath", "num_bath_partial": "count_bath_partial", "num_bedrooms": "count_bedrooms",
    "roof_coverdscr": "roof_type",
}


def delivery(homes: DataFrame) -> DataFrame:
    """Reviewed homes without panels in the delivered columns, scores rescaled to 100."""
    out = homes
    if "result_manual_check" in out.columns:
        out = out.where(L.is_not("result_manual_check", "Rejected"))
    if "solar_panels" in out.columns:
        out = out.where(c("solar_panels") == "No")
    out = out.withColumns({n: F.upper(n) for n in ("city", "county") if n in out.columns})
    if {"county", "state2"} <= set(out.columns):
        out = out.withColumn("index", X.home_index(c("county"), c("state2"), c("original_index")))
    if "owner" in out.columns:
        pair = X.owner_pair(c("owner"))
        out = out.withColumns({"owner_1": pair["owner_1"], "owner_2": pair["owner_2"]})
    if "subdivision" in out.columns:
        out = out.withColumn("subdivision_formatted", X.subdivision_name(c("subdivision")))
    out = out.select(*[n for n in DELIVERED if n in out.columns])
    if "solar_score" in out.columns:
        out = rescale_to_max(out, "solar_score")
    return out.withColumnsRenamed(PUBLISHED)
