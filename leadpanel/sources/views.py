"""Views that map the given star-schema tables to homes, permits, segments and scores.

Each text runs unchanged in Spark SQL and in DuckDB. ``{name}`` marks an input.
The given tables hold no nulls, odd dates or dirty text, so key arithmetic adds them.
"""

from __future__ import annotations

# Permit texts used as (category, description) for order keys modulo the list length.
PHRASES: list[tuple[str | None, str | None]] = [
    ("building misc", "Photovoltaic strings over the west wing"),
    ("energy efficient system", None),
    ("energy efficient system", "Solar thermal loop for the wash house"),
    ("energy efficient system", "String inverter and rails, 3.84 kw"),
    ("building misc", "Energy storage cabinet of 11 kwh"),
    ("ELECTRICAL/MECHANICAL", "Wallbox and cable in the left bay"),
    ("electrical/mechanical", "Energy storage beside the meter main"),
    ("electrical/mechanical", "Service upgrade for the workshop"),
    ("electrical/mechanical", "Relocate one small panel"),
    ("Reroof", "Slate over the north side"),
    ("residential re-roof", None),
    ("water heater", "Propane water heater, tall model"),
    ("water heater", "HPWH in the pantry"),
    ("plumbing", "Tankless on the outer wall"),
    ("air conditioner", "Outdoor condenser on a new pad"),
    ("heating system", ""),
    ("heating system", "Boiler exchange"),
    ("plumbing", "New h/w htr in the loft"),
    (None, "Minisplit for the library"),
    (None, "Genset of 11 kw behind the fence"),
    (None, "Swamp cooler exchange"),
    (None, None),
    ("Windows or Doors", "Sliding door to the terrace"),
    ("siding", None),
    (None, "Weatherization of the crawl space"),
    ("addition", "Glass porch toward the garden"),
    ("new construction", "Accessory dwelling over the garage"),
    ("building misc", "Renovation of the upper floor"),
    ("building misc", "Bathroom tiles and a new tub"),
    ("pool", "Lap lane of 12 metres"),
    ("building misc", "Outlet for a spa"),
    ("building misc", "Gasline to a fire bowl by the pool"),
    ("building misc", "Stone wall along the lane"),
    ("building misc", "Ground frame with 17 modules"),
    ("building misc", "Kiln shed with a feed of 14 kw"),
    ("siding", "Board and batten over the battery shed"),
    ("building misc", "Solar system of 6.1 kw, no battery"),
    ("building misc", "11 dark panels 415w, garage side"),
    ("demolition", "Take down a barn"),
    ("commercial re-roof", "Solar ready pipes under new sheets"),
]

OWNERS: list[str | None] = [
    "SMITH JOHN A", "SMITH JOHN & MARY", "GARCIA LUIS & ANA M", "DOE, JANE Q & RICHARD",
    "BLUE HERON HOLDINGS LLC", "LEE FAMILY TRUST", None, "", "NG", "PATEL RAVI K & MEERA S SHAH",
    "O'BRIEN PAT AND KIM LEE", "WARD, ANN B & COLE, DAN E",
]

SUBDIVISIONS: list[str | None] = [
    "COAL CREEK FILING 2", "Village of Heather Ridge", "PARK PLACE PUD", None, "OAK GROVE PHASE 3",
    "Sunny Slope 4TH", "HEART OF",
]


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(key: str, values: list[str | None]) -> str:
    """CASE that picks a text by ``key`` modulo the list length."""
    arms = " ".join(f"WHEN {i} THEN {_literal(v)}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


# Apostrophes inside Spark SQL literals: '' is read as string concatenation there, so keep to chr(39).
def _owner_pick(key: str) -> str:
    arms = []
    for i, v in enumerate(OWNERS):
        if v is not None and "'" in v:
            a, b = v.split("'")
            arms.append(f"WHEN {i} THEN concat('{a}', chr(39), '{b}')")
        else:
            arms.append(f"WHEN {i} THEN {_literal(v)}")
    return f"CASE {key} % {len(OWNERS)} {' '.join(arms)} END"


K = "c_custkey"

HOMES = f"""
SELECT
  CAST({K} AS STRING) AS strap,
  {K} AS original_index,
  CASE WHEN {K} % 211 = 7 THEN NULL ELSE
    40.0e0 + ({K} % 40) * ({K} % 40) * 0.00004e0
    + (floor(floor({K} / 1600) / 500) % 200) * 0.1e0 END AS lat,
  -105.3e0 + (floor({K} / 40) % 40) * (floor({K} / 40) % 40) * 0.00005e0
    + (floor({K} / 1600) % 500) * 0.1e0 AS lon,
  CASE WHEN {K} % 17 = 0 THEN NULL ELSE c_acctbal END AS saleprice,
  CASE {K} % 7
    WHEN 0 THEN concat(CAST(1 + {K} % 12 AS STRING), '/', CAST(1 + {K} % 28 AS STRING), '/0', CAST({K} % 10 AS STRING))
    WHEN 1 THEN concat(CAST(1 + {K} % 12 AS STRING), '/', CAST(1 + {K} % 28 AS STRING), '/9', CAST({K} % 10 AS STRING))
    WHEN 2 THEN concat('199', CAST({K} % 10 AS STRING), '-0', CAST(1 + {K} % 9 AS STRING), '-1', CAST({K} % 9 AS STRING))
    WHEN 3 THEN concat(CAST(1 + {K} % 12 AS STRING), '-', CAST(1 + {K} % 28 AS STRING), '-', CAST(1990 + {K} % 14 AS STRING))
    WHEN 4 THEN NULL
    WHEN 5 THEN 'unknown'
    ELSE concat('200', CAST({K} % 2 AS STRING), '.0', CAST(1 + {K} % 9 AS STRING), '.05') END AS saledate,
  CASE WHEN {K} % 19 = 0 THEN NULL ELSE CAST(1940 + ({K} * 7) % 60 AS DOUBLE) END AS yearbuilt,
  CASE WHEN {K} % 3 = 0 THEN NULL ELSE CAST(1950 + ({K} * 11) % 52 AS DOUBLE) END AS year_built_effective_date,
  CASE {K} % 5 WHEN 0 THEN concat('06/', CAST(10 + {K} % 18 AS STRING), '/', CAST(1960 + {K} % 70 AS STRING))
    WHEN 1 THEN CAST(1950 + {K} % 60 AS STRING) WHEN 2 THEN '' WHEN 3 THEN 'n/a'
    ELSE concat('3.4.', CAST(10 + {K} % 90 AS STRING)) END AS effective_text,
  CASE WHEN {K} % 101 = 0 THEN NULL
    ELSE concat(CAST(100 + {K} % 420 AS STRING), ' Elm Street ', CAST(floor({K} / 4200) AS BIGINT)) END AS address,
  CASE WHEN {K} % 4 = 0 THEN concat('PO BOX ', CAST({K} AS STRING)) WHEN {K} % 101 = 0 THEN NULL
    ELSE concat(CAST(100 + {K} % 420 AS STRING), ' ELM ST') END AS mailadd,
  n_name AS city, c_mktsegment AS county, 'CO' AS state2,
  CASE WHEN {K} % 6 = 0 THEN concat(CAST(80000 + {K} % 900 AS STRING), '.0') WHEN {K} % 6 = 1 THEN 'nan'
    ELSE CAST(80000 + {K} % 900 AS STRING) END AS szip5,
  CASE WHEN {K} % 13 = 0 THEN NULL ELSE CAST(600 + ({K} * 37) % 4000 AS DOUBLE) END AS area_building,
  CASE WHEN {K} % 11 = 0 THEN NULL ELSE CAST(500 + ({K} * 29) % 2500 AS DOUBLE) END AS mainfloorsf,
  CASE WHEN {K} % 29 = 0 THEN 0.0e0 ELSE CAST(3000 + ({K} * 53) % 9000 AS DOUBLE) END AS sqft,
  CASE WHEN {K} % 8 = 0 THEN NULL ELSE CAST(1 + {K} % 3 AS DOUBLE) END AS numstories,
  CASE WHEN {K} % 9 = 0 THEN NULL ELSE CAST(3 + {K} % 8 AS DOUBLE) END AS numrooms,
  CASE WHEN {K} % 10 = 0 THEN NULL ELSE CAST(1 + {K} % 4 AS DOUBLE) END AS num_bath,
  CASE WHEN {K} % 12 = 0 THEN NULL ELSE CAST({K} % 2 AS DOUBLE) END AS num_bath_partial,
  CASE WHEN {K} % 7 = 0 THEN NULL ELSE CAST(1 + {K} % 6 AS DOUBLE) END AS num_bedrooms,
  {_owner_pick(K)} AS owner,
  {_pick(K, SUBDIVISIONS)} AS subdivision,
  CASE {K} % 4 WHEN 0 THEN 'SINGLE FAMILY' WHEN 1 THEN 'DUPLEX' WHEN 2 THEN 'CONDO' ELSE NULL END AS usedesc,
  CASE {K} % 5 WHEN 0 THEN 'Low Density Residential' WHEN 1 THEN 'AGRICULTURE' WHEN 2 THEN 'rural residential' WHEN 3 THEN NULL ELSE 'Commercial' END AS zoning_description,
  CASE {K} % 3 WHEN 0 THEN 'RANCH' WHEN 1 THEN '2-3 STORY' ELSE 'BI-LEVEL' END AS designcodedscr,
  CASE {K} % 4 WHEN 0 THEN 'Q' WHEN 1 THEN 'U' WHEN 2 THEN 'V' ELSE NULL END AS sales_cd,
  CASE {K} % 6 WHEN 0 THEN 'Electric Baseboard' WHEN 1 THEN 'HEAT PUMP' WHEN 2 THEN NULL ELSE 'FORCED AIR' END AS heatingdscr,
  CASE {K} % 5 WHEN 0 THEN 'Whole House' WHEN 1 THEN 'EVAPORATIVE COOLER' WHEN 2 THEN NULL ELSE 'none' END AS acdscr,
  CASE {K} % 6 WHEN 0 THEN 'ATTACHED GARAGE AREA' WHEN 1 THEN 'DETACHED GARAGE' WHEN 2 THEN '0' WHEN 3 THEN ' CARPORT AREA ' WHEN 4 THEN NULL ELSE 'BARN' END AS carstoragetypedscr,
  CASE {K} % 3 WHEN 0 THEN 'Asphalt' WHEN 1 THEN 'Metal' ELSE NULL END AS roof_coverdscr,
  CASE {K} % 9 WHEN 0 THEN ' Yes ' WHEN 1 THEN 'yes' WHEN 2 THEN NULL ELSE 'No' END AS solar_panels,
  CASE {K} % 10 WHEN 0 THEN 'Rejected' WHEN 1 THEN 'Approved' ELSE NULL END AS result_manual_check,
  concat('0', CAST(8000 + n_nationkey AS STRING), '001', '0002', CAST(n_regionkey AS STRING)) AS block_fips
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey
"""

P = "o_orderkey"

PERMITS = f"""
SELECT
  CAST(o_custkey AS STRING) AS strap,
  CAST({P} AS STRING) AS permit_num,
  {P} AS permit_key,
  {_pick(P, [c for c, _ in PHRASES])} AS permit_category,
  {_pick(P, [d for _, d in PHRASES])} AS description,
  CAST(o_orderdate AS DATE) AS issue_date,
  CASE {P} % 8
    WHEN 0 THEN concat(CAST(month(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING))
    WHEN 1 THEN '1899-12-30' WHEN 2 THEN '2098-04-01' WHEN 3 THEN 'not a date' WHEN 4 THEN NULL
    ELSE substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 10) END AS issue_dt,
  CASE WHEN {P} % 23 = 0 THEN NULL WHEN {P} % 9 = 0 THEN o_totalprice / 200.0e0
    ELSE o_totalprice / 10.0e0 END AS estimated_value
FROM {{orders}}
"""

# First year in which a home adopted; homes absent here never did.
ADOPTIONS = """
SELECT CAST(o_custkey AS STRING) AS strap, CAST(min(year(o_orderdate)) AS BIGINT) AS first_year
FROM {orders} WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY o_custkey
"""

# A dated rate series with "." for a missing reading.
RATES = """
SELECT CAST(o_orderdate AS DATE) AS observation_date,
  CASE WHEN o_orderkey % 31 = 0 THEN '.' ELSE CAST(CAST(2 + (o_orderkey * 13) % 700 AS BIGINT) AS STRING) END AS rate_text
FROM {orders}
"""

SEGMENTS = """
SELECT l_orderkey AS original_index, CAST(l_linenumber AS BIGINT) AS idx,
  CAST((l_partkey * 7) % 360 AS DOUBLE) AS azimuth, l_quantity AS area,
  CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(1000 + l_suppkey % 800 AS DOUBLE) END AS avg_sun,
  l_partkey AS tie
FROM {lineitem}
"""

# Scores for labelled documents: the model's, a second model's, and the truth.
SCORED = """
SELECT d.doc_id AS id, d.lang AS model, CAST(2020 + d.doc_id % 5 AS BIGINT) AS install_year,
  CAST(CASE WHEN l.quality = 1 OR l.toxic = 1 THEN 1 ELSE 0 END AS BIGINT) AS y,
  (d.n_chars % 997) / 997.0e0 AS score, ((d.n_chars * 31 + d.doc_id) % 499) / 499.0e0 AS score_b
FROM {documents} d JOIN {labels} l ON d.doc_id = l.doc_id
"""

# Published scores per home: model 1..100, roof 10..100, each missing for some homes.
HOME_SCORES = f"""
SELECT CAST({K} AS STRING) AS home_index,
  CASE WHEN {K} % 5 = 0 THEN NULL ELSE CAST(1 + ({K} * 17) % 100 AS BIGINT) END AS model_score,
  CASE WHEN {K} % 7 = 3 THEN NULL ELSE CAST(10 + ({K} * 23) % 91 AS BIGINT) END AS roof_score
FROM {{customer}} WHERE c_acctbal >= 0
"""

FOLLOWS = """
SELECT DISTINCT user_id, CAST(CAST(floor(event_id / 7) AS BIGINT) AS STRING) AS home_index, event_type AS org
FROM {events}
"""

NOTES = """
SELECT CAST(conv_id AS STRING) AS home_index, turn, role AS author, text AS body FROM {conversations}
"""

REVIEWS = """
SELECT CAST(o_orderkey AS STRING) AS permit_num,
  CASE o_orderkey % 6 WHEN 0 THEN 'solar' WHEN 1 THEN 'roof' WHEN 2 THEN 'other' WHEN 3 THEN 'hvac'
    WHEN 4 THEN 'battery' ELSE 'electrical' END AS ai_type,
  CASE o_orderkey % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS ai_confidence
FROM {orders}
"""

DEMOGRAPHICS = """
SELECT concat('0', CAST(8000 + n_nationkey AS STRING), '001', '0002', CAST(n_regionkey AS STRING)) AS block_fips,
  CAST(40000 + n_nationkey * 3100 AS DOUBLE) AS median_household_income,
  CASE WHEN n_nationkey % 6 = 0 THEN -666666666.0e0 ELSE CAST(210000 + n_nationkey * 9700 AS DOUBLE) END AS median_home_value,
  CASE WHEN n_nationkey % 9 = 0 THEN NULL ELSE CAST(1960 + n_nationkey AS DOUBLE) END AS median_year_built,
  CAST(100 + n_nationkey * 13 AS DOUBLE) AS pop_bachelors, CAST(40 + n_nationkey * 5 AS DOUBLE) AS pop_masters,
  CAST(n_nationkey % 4 AS DOUBLE) AS pop_professional,
  CASE WHEN n_nationkey % 7 = 3 THEN -666666666.0e0 ELSE CAST(n_nationkey % 3 AS DOUBLE) END AS pop_doctorate,
  CASE WHEN n_nationkey % 11 = 4 THEN 0.0e0 ELSE CAST(900 + n_nationkey * 31 AS DOUBLE) END AS pop_25_plus
FROM {nation}
"""

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "homes": (HOMES, ("customer", "nation")),
    "permits": (PERMITS, ("orders",)),
    "adoptions": (ADOPTIONS, ("orders",)),
    "rates": (RATES, ("orders",)),
    "segments": (SEGMENTS, ("lineitem",)),
    "scored": (SCORED, ("documents", "labels")),
    "home_scores": (HOME_SCORES, ("customer",)),
    "follows": (FOLLOWS, ("events",)),
    "notes": (NOTES, ("conversations",)),
    "reviews": (REVIEWS, ("orders",)),
    "demographics": (DEMOGRAPHICS, ("nation",)),
}

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table_names() -> list[str]:
    return _TABLES


def view_order(names: list[str]) -> list[str]:
    """The views needed, inputs first, each once; plain tables left out."""
    out: list[str] = []

    def visit(name: str) -> None:
        if name in VIEWS and name not in out:
            for need in VIEWS[name][1]:
                visit(need)
            out.append(name)

    for name in names:
        visit(name)
    return out
