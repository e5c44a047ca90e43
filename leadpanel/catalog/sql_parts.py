"""SQL fragments shared by several checks."""

from leadpanel.functions import permit_rules as R


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def any_in(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {q(w)})" for w in words) + ")"


def has(pattern: str, column: str = "txt") -> str:
    return f"regexp_matches({column}, {q(R.PATTERNS[pattern])})"


def flagged(source: str, extra: str = "") -> str:
    """The 19 flags over ``source`` with permit_category, description, estimated_value."""
    kw = R.CATEGORY_KEYWORDS
    efficient = "contains(cat, 'energy efficient system')"
    solar = f"""(({efficient} AND ({has('solar_word')} OR {has('power_rating')})) OR {has('solar_pv')}
      OR ({has('power_rating')} AND NOT {has('generator')}) OR {has('solar_equipment')} OR {has('solar_hardware')}
      OR ({efficient} AND blank AND coalesce(val >= 7000 AND val <= 35000, false)))
      AND (NOT {has('solar_thermal_suspected')} OR {has('explicit_pv')})
      AND NOT (coalesce(val < 3000, false) AND NOT {any_in('txt', R.STRONG_WORDS)})"""
    pump = f"({has('heat_pump')} AND NOT {has('heat_pump_not')})"
    rules = {
        "solar_pv": solar,
        "battery": f"{has('battery')} AND NOT {has('battery_not')}",
        "ev_charger": has("ev_charger"),
        "roof_new_or_replace": f"{any_in('cat', kw['roof_new_or_replace'])} OR {has('roof_new_or_replace')}",
        "electrical_service_upgrade": has("electrical_service_upgrade"),
        "heat_pump": pump,
        "ac": f"contains(cat, 'air conditioner') OR {has('ac')}",
        "furnace": f"(contains(cat, 'heating system') AND ({has('furnace')} OR blank)) OR ({has('furnace')} AND NOT {pump})",
        "water_heater": f"contains(cat, 'water heater') OR {has('water_heater')}",
        "water_heater_electric": has("water_heater_electric"),
        "water_heater_gas": has("water_heater_gas"),
        "water_heater_solar_thermal": has("water_heater_solar_thermal"),
        "windows_doors": f"{any_in('cat', kw['windows_doors'])} OR {has('windows_doors')}",
        "insulation_airseal": has("insulation_airseal"),
        "generator": has("generator"),
        "addition_new_build": f"contains(cat, 'addition') OR contains(cat, 'new construction') OR {has('addition_new_build')}",
        "kitchen_bath_remodel": has("kitchen_bath_remodel"),
        "pool_hot_tub": f"{any_in('cat', kw['pool_hot_tub'])} OR ({has('pool_hot_tub')} AND NOT {has('pool_hot_tub_not')})",
        "evaporative_cooler": f"contains(cat, 'evaporative cooler') OR {has('evaporative_cooler')}",
    }
    columns = ",\n".join(f"CAST(({rules[f]}) AS BIGINT) AS {f}" for f in R.FLAGS)
    return f"""SELECT * EXCLUDE (cat, txt, blank, val), {columns} FROM (
      SELECT *, lower(coalesce(permit_category, '')) AS cat,
        lower(coalesce(permit_category, '') || ' ' || coalesce(description, '')) AS txt,
        trim(coalesce(description, '')) = '' AS blank, estimated_value AS val FROM {source}) s {extra}"""


def typed(source: str) -> str:
    """Adds permit_type over a relation with the 19 flags."""
    arms = ", ".join(
        f"CASE WHEN {' OR '.join(f'{f} = 1' for f in flags)} THEN '{name}' END"
        for name, flags in R.TYPES.items()
    )
    return f"SELECT *, coalesce(nullif(concat_ws(',', {arms}), ''), 'other') AS permit_type FROM {source}"


def exploded(source: str) -> str:
    return f"SELECT * EXCLUDE (permit_type), trim(unnest(string_split(permit_type, ','))) AS permit_type FROM {source}"


FLAGGED = flagged("permits")
TYPED = typed("flagged")
EXPLODED = exploded("typed")

# Year of a sale date text, as in functions.dates.sale_year.
def number(token: str) -> str:
    return f"CASE WHEN regexp_matches(trim({token}), '^[+-]?[0-9]+$') THEN TRY_CAST(trim({token}) AS INTEGER) END"


def widened(expr: str) -> str:
    return f"(CASE WHEN {expr} < 50 THEN {expr} + 2000 WHEN {expr} < 100 THEN {expr} + 1900 ELSE {expr} END)"


def sale_year(column: str) -> str:
    parts = f"string_split_regex(trim({column}), '[/.-]')"
    first, last = number(f"{parts}[1]"), number(f"{parts}[-1]")
    return f"""(CASE WHEN len({parts}) < 3 THEN NULL
      WHEN {first} >= 1900 THEN CASE WHEN {first} <= 2100 THEN {first} END
      WHEN {first} IS NULL THEN NULL
      WHEN {widened(last)} BETWEEN 1900 AND 2100 THEN {widened(last)} END)"""


def parsed_date(column: str) -> str:
    return f"""CAST(coalesce(try_strptime(trim({column}), '%Y-%m-%d'), try_strptime(trim({column}), '%m/%d/%Y'),
      try_strptime(trim({column}), '%Y/%m/%d'), try_strptime(trim({column}), '%m-%d-%Y')) AS DATE)"""
