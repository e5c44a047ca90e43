"""Permit text classification as native column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from leadpanel.functions import permit_rules as R
from leadpanel.functions.once import once


def category_has(category: Column, keywords: list[str]) -> Column:
    """Any keyword as literal text, whatever its case; the keywords hold no regex signs."""
    return F.coalesce(category, F.lit("")).rlike("(?i)" + "|".join(keywords))


def text_matches(text: Column, pattern: str, unless: str | None = None) -> Column:
    hit = text.rlike(R.PATTERNS[pattern])
    return hit & ~text.rlike(R.PATTERNS[unless]) if unless else hit


def flag_columns(category: Column, text: Column, blank: Column, value: Column | None) -> dict[str, Column]:
    """Boolean column per flag. ``text`` is lower case and already joins category and description."""
    def cat(*words: str) -> Column:
        return category_has(category, list(words))

    def desc(name: str, unless: str | None = None) -> Column:
        return text_matches(text, name, unless)

    efficient = category_has(category, R.EFFICIENT_SYSTEM)
    power = desc("power_rating")
    solar = (
        (efficient & (desc("solar_word") | power))
        | desc("solar_pv")
        | (power & ~desc("generator"))
        | desc("solar_equipment")
        | desc("solar_hardware")
    )
    if value is not None:
        in_range = F.coalesce(value.between(*R.BLANK_TEXT_VALUE), F.lit(False))
        solar = solar | (efficient & blank & in_range)
    solar = solar & (~desc("solar_thermal_suspected") | desc("explicit_pv"))
    if value is not None:
        strong = text.rlike("|".join(R.STRONG_WORDS))
        solar = solar & ~(F.coalesce(value < R.MIN_VALUE, F.lit(False)) & ~strong)

    heat_pump = desc("heat_pump", "heat_pump_not")
    furnace_text = desc("furnace")
    keywords = R.CATEGORY_KEYWORDS
    return {
        "solar_pv": solar,
        "battery": desc("battery", "battery_not"),
        "ev_charger": desc("ev_charger"),
        "roof_new_or_replace": cat(*keywords["roof_new_or_replace"]) | desc("roof_new_or_replace"),
        "electrical_service_upgrade": desc("electrical_service_upgrade"),
        "heat_pump": heat_pump,
        "ac": cat(*keywords["ac"]) | desc("ac"),
        "furnace": (category_has(category, R.HEATING_SYSTEM) & (furnace_text | blank))
        | (furnace_text & ~heat_pump),
        "water_heater": cat(*keywords["water_heater"]) | desc("water_heater"),
        "water_heater_electric": desc("water_heater_electric"),
        "water_heater_gas": desc("water_heater_gas"),
        "water_heater_solar_thermal": desc("water_heater_solar_thermal"),
        "windows_doors": cat(*keywords["windows_doors"]) | desc("windows_doors"),
        "insulation_airseal": desc("insulation_airseal"),
        "generator": desc("generator"),
        "addition_new_build": category_has(category, R.BUILDING) | desc("addition_new_build"),
        "kitchen_bath_remodel": desc("kitchen_bath_remodel"),
        "pool_hot_tub": cat(*keywords["pool_hot_tub"]) | desc("pool_hot_tub", "pool_hot_tub_not"),
        "evaporative_cooler": cat(*keywords["evaporative_cooler"]) | desc("evaporative_cooler"),
    }


def compute_flags(
    permits: DataFrame, category: str = "permit_category", description: str = "description",
    value: str | None = "estimated_value",
) -> DataFrame:
    """Add the 19 flags (0/1) to each permit; one narrow pass, no shuffle."""
    desc = F.coalesce(F.col(description), F.lit(""))
    staged = permits.withColumns({
        "_text": F.lower(F.concat(F.coalesce(F.col(category), F.lit("")), F.lit(" "), desc)),
        "_blank": F.trim(desc) == "",
    })
    amount = F.col(value).cast("double") if value else None
    flags = flag_columns(F.col(category), F.col("_text"), F.col("_blank"), amount)
    flagged = staged.select(*permits.columns, *[flags[f].cast("int").alias(f) for f in R.FLAGS])
    # Filters on the flags stay above this point instead of repeating the regexes.
    return once(flagged, {f: F.col(f) for f in R.FLAGS}, keep=permits.columns)


def permit_type() -> Column:
    """Comma list of the types whose flags are set, or ``other``."""
    names = [
        F.when(reduce(or_, [F.col(f) == 1 for f in flags]), F.lit(name))
        for name, flags in R.TYPES.items()
    ]
    joined = F.concat_ws(",", *names)
    return F.when(joined == "", "other").otherwise(joined)


def classify(permits: DataFrame, **columns) -> DataFrame:
    return compute_flags(permits, **columns).withColumn("permit_type", permit_type())


def explode_types(permits: DataFrame, column: str = "permit_type") -> DataFrame:
    """One row per (permit, type)."""
    return permits.withColumn(column, F.explode(F.split(F.col(column), ","))).withColumn(
        column, F.trim(column)
    )
