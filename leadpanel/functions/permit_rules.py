"""Fixed values for permit classification: keywords, patterns, thresholds, type order.

Patterns use no lookaround, so that any SQL engine's regex can run them.
"""

# ---- fixed values: flag order --------------------------------------------------
FLAGS = [
    "solar_pv", "battery", "ev_charger", "roof_new_or_replace", "electrical_service_upgrade",
    "heat_pump", "ac", "furnace", "water_heater", "water_heater_electric", "water_heater_gas",
    "water_heater_solar_thermal", "windows_doors", "insulation_airseal", "generator",
    "addition_new_build", "kitchen_bath_remodel", "pool_hot_tub", "evaporative_cooler",
]

# ---- fixed values: category keywords (literal, case-insensitive) ---------------
CATEGORY_KEYWORDS = {
    "solar_pv": ["energy efficient system", "solar", "photovoltaic", "pv system"],
    "roof_new_or_replace": ["re-roof", "reroof", "residential re-roof", "commercial re-roof"],
    "ac": ["air conditioner"],
    "water_heater": ["water heater"],
    "windows_doors": ["windows or doors", "windows", "doors", "siding"],
    "evaporative_cooler": ["evaporative cooler"],
    "pool_hot_tub": ["pool", "hot tub", "spa"],
    "electrical_mechanical": ["electrical/mechanical", "electrical"],
}
EFFICIENT_SYSTEM = ["energy efficient system"]
HEATING_SYSTEM = ["heating system"]
BUILDING = ["addition", "new construction"]

# ---- fixed values: text patterns ------------------------------------------------
PATTERNS = {
    "solar_pv": r"\b(?:solar\s*(?:pv|panel|array|system|installation|mount)|pv\s*(?:solar|system|array)|photov\w*|photo\-voltaic|solar\s*electric|grid[\s\-]*tie[d]?|modules?\s*[\-\s]*roof\s*mount)\b",
    "solar_word": r"solar|pv|photovoltaic",
    "solar_thermal_suspected": r"solar\s*(?:water|hot\s*water|thermal)\s*heater|solar\s*heater\s*tank|solar\s*thermal|solar\s*hot\s*water|solar\s*heating|thermal\s*panel|thermal\s*collector|solar\s*thermal\s*panel",
    "explicit_pv": r"\b(?:pv|photov\w*|photo\-voltaic)\b",
    "power_rating": r"\d+\.?\d*\s*kw(?:[^h]|$)",
    "solar_equipment": r"\b(?:solaredge|enphase|sunpower|meyer\s*burger|rec\s*alpha|q\s*cells|jinko|trina|longi|canadian\s*solar|hanwha|silfab|mission\s*solar|sma\s*(?:sunny|inverter)|fronius|generac\s*pwrcell)\b",
    "solar_hardware": r"\bpanels?\s+\d{2,3}\s*w\b|\b\d+\s+(?:\w+\s+){0,3}panels?\s+\d{2,3}\s*w|\b\d+\s+modules?\b",
    "battery": r"\b(?:powerwall|battery|batteries|energy\s*storage|ess|bms)\b|inverter[\s\-]*batt",
    "battery_not": r"no\s*batter|board\s*and\s*batten|batten\b",
    "ev_charger": r"\b(?:ev\s*charg\w*|electric\s*vehicle\s*charger|tesla\s*(?:wall\s*)?connector|chargepoint|juicebox|wallbox|level\s*2\s*charg|evse|car\s*charg\w*)\b",
    "roof_new_or_replace": r"\b(?:roof\s*replace|re\-roof|reroof|roofing|new\s*roof|tear\s*off|shingle|underlayment|tear\s*off\s*&?\s*reroof)\b",
    "electrical_service_upgrade": r"\b(?:service\s*upgrade|panel\s*upgrade|main\s*panel|meter\s*main|new\s*panel|electrical\s*service|200\s*a(?:mp)?|solar\s*ready|meter\s*socket|(?:replace|relocate)\s*(?:\w+\s+){0,3}panel)\b",
    "heat_pump": r"\b(?:heat\s*pump|mini\s*split|minisplit|ductless)\b",
    "heat_pump_not": r"heat\s*pump\s*water\s*heater|hpwh",
    "ac": r"\b(?:air\s*condition(?:er|ing)|\ba/c\b|a\.c\.|ac\s*unit|condenser)\b",
    "furnace": r"\b(?:furnace|boiler)\b",
    "water_heater": r"\b(?:water\s*heater|tankless|on\-demand|h/?w\s*h(?:ea)?t(?:e)?r)\b",
    "water_heater_electric": r"\b(?:electric\s*water\s*heater|heat\s*pump\s*water\s*heater|hpwh|hybrid\s*water\s*heater|electric\s*(?:\d+\s*gal\s*)?water\s*heater)\b",
    "water_heater_gas": r"\b(?:gas\s*water\s*heater|ng\s*water\s*heater|natural\s*gas\s*water\s*heater|propane\s*water\s*heater|\d+\s*gal\s*gas\s*water\s*heater|water\s*heater\s*gas)\b",
    "water_heater_solar_thermal": r"\b(?:solar\s*water\s*heater|solar\s*hot\s*water|solar\s*thermal)\b",
    "windows_doors": r"\b(?:windows?|doors?|patio\s*door|sliding\s*door|siding)\b",
    "insulation_airseal": r"\b(?:insulation|air\s*seal|air\-seal|weatherization|attic\s*insulation)\b",
    "generator": r"\b(?:generator|genset)\b",
    "addition_new_build": r"\b(?:addition|adding\s+\d+|new\s*construction|new\s*build|new\s*(?:single\s*family|residence|home|house|sfr|sfd)|adu|accessory\s*dwelling)\b",
    "kitchen_bath_remodel": r"\b(?:kitchen|bath(?:room)?|remodel|renovation|basement\s*finish|finish\w*\s+(?:\S+\s+){0,3}basement)\b",
    "pool_hot_tub": r"\b(?:pool|hot\s*tub|spa)\b",
    "pool_hot_tub_not": r"gas\s*line|gasline|wiring|wire\s|outlet|demolition|deconstruct|fill\s*in",
    "evaporative_cooler": r"\b(?:evaporative\s*cooler|swamp\s*cooler)\b",
}

# ---- fixed values: valuation rules ----------------------------------------------
MIN_VALUE = 3000
STRONG_WORDS = [
    "solar", "photovoltaic", "pv system", "pv array", "pv install",
    "solaredge", "enphase", "sunpower", "meyer burger",
]
BLANK_TEXT_VALUE = (7000, 35000)

# ---- fixed values: permit type -> flags that give it, in output order -----------
TYPES = {
    "solar": ["solar_pv"],
    "battery": ["battery"],
    "ev_charger": ["ev_charger"],
    "heat_pump": ["heat_pump"],
    "generator": ["generator"],
    "roof": ["roof_new_or_replace"],
    "hvac": ["ac", "furnace", "evaporative_cooler"],
    "electrical": ["electrical_service_upgrade"],
    "water_heater": [
        "water_heater", "water_heater_electric", "water_heater_gas", "water_heater_solar_thermal",
    ],
    "construction": ["addition_new_build"],
    "remodel": ["kitchen_bath_remodel"],
    "envelope": ["windows_doors", "insulation_airseal"],
    "pool": ["pool_hot_tub"],
}

# ---- fixed values: years a flag stays on after its permit ------------------------
PERSISTENCE = {
    "solar_pv": 25, "battery": 15, "ev_charger": 25, "roof_new_or_replace": 7,
    "electrical_service_upgrade": 10, "heat_pump": 15, "ac": 15, "furnace": 20,
    "water_heater": 15, "water_heater_electric": 15, "water_heater_gas": 15,
    "water_heater_solar_thermal": 20, "windows_doors": 25, "insulation_airseal": 20,
    "generator": 15, "addition_new_build": 999, "kitchen_bath_remodel": 15,
    "pool_hot_tub": 25, "evaporative_cooler": 15,
}
