"""Declarative row filters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

c = F.col


def owner_occupied(mail: str = "mailadd", site: str = "address", n: int = 6) -> Column:
    """Mailing and site address share their first characters; a missing text reads "nan" on both sides."""
    head = lambda name: F.substring(F.coalesce(c(name), F.lit("nan")), 1, n)
    return head(mail) == head(site)


def build_year(*columns: str) -> Column:
    """Largest known year; unknown ones are skipped."""
    return F.greatest(*[c(n).cast("double") for n in columns])


def apply_rules(df: DataFrame, rules: dict) -> DataFrame:
    """Keys: ``<col>`` list = one of, ``<col>_contains`` = pattern, ``<col>_min`` = at least, ``owner_occupied``."""
    out = df
    for key, value in rules.items():
        if key == "owner_occupied":
            out = out.where(owner_occupied()) if value else out
        elif key == "calculated_build_year_min":
            out = out.withColumn("calculated_build_year", build_year("yearbuilt", "year_built_effective_date"))
            out = out.where(c("calculated_build_year") >= value)
        elif key.endswith("_contains"):
            out = out.where(c(key.removesuffix("_contains")).rlike(f"(?i){value}"))
        elif key.endswith("_min"):
            out = out.where(c(key.removesuffix("_min")) >= value)
        else:
            out = out.where(c(key).isin(value))
    return out


def is_true_text(name: str) -> Column:
    return F.lower(F.trim(c(name))) == "true"


def distance_gate(df: DataFrame, name: str = "center_distance_m", limit: float = 8.5) -> DataFrame:
    """Keep near responses; without the column nothing is dropped."""
    return df.where(c(name) <= limit) if name in df.columns else df


def is_not(name: str, value) -> Column:
    """Differs from the value; missing counts as different."""
    return ~c(name).eqNullSafe(F.lit(value))


def since_or_unknown(year: Column, first: int) -> Column:
    return year.isNull() | (year >= first)


def given(**parts) -> Column:
    """All the conditions whose parameter was given; true when none was.

    ``parts`` maps a name to (parameter, condition maker); only given ones reach the scan.
    """
    conditions = [make(p) for p, make in parts.values() if p is not None]
    return reduce(and_, conditions, F.lit(True))


def box(lat: str, lon: str, south=None, north=None, west=None, east=None) -> Column:
    return given(
        south=(south, lambda v: c(lat) >= v), north=(north, lambda v: c(lat) <= v),
        west=(west, lambda v: c(lon) >= v), east=(east, lambda v: c(lon) <= v),
    )


def any_tag(tags: Column, prefix: str) -> Column:
    """Some tag starts with the prefix, ignoring case and outer blanks; missing tags match nothing."""
    wanted = prefix.strip().lower()
    return F.coalesce(F.exists(tags, lambda t: F.lower(F.trim(t)).startswith(wanted)), F.lit(False))


def card_text(*columns: str) -> Column:
    return F.lower(F.concat_ws(" ", *[c(n) for n in columns]))


def search(query: str, *columns: str) -> Column:
    """All fields joined contain the query, ignoring case."""
    return card_text(*columns).contains(query.strip().lower())


# State codes with their own price series (the capital district included).
STATES = (
    "AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE NV NH NJ "
    "NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY"
).split()


def clean_prices(df: DataFrame, state: str, price: str) -> DataFrame:
    """Known states and positive readable prices, rounded to four places."""
    number = c(price).try_cast("double")
    return df.where(c(state).isin(STATES) & (number > 0)).withColumn(price, F.round(number, 4))


def keep_existing(df: DataFrame, columns: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """The listed columns that exist, in list order, renamed."""
    return df.select(*[n for n in columns if n in df.columns]).withColumnsRenamed(rename or {})


def feature_columns(df: DataFrame, exclude: list[str], max_levels: int = 20) -> list[str]:
    """Numeric columns plus text columns with few levels, counted in one pass."""
    text = [n for n, t in df.dtypes if t == "string" and n not in exclude]
    levels = df.agg(*[F.count_distinct(n).alias(n) for n in text]).first() if text else {}
    numeric = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [
        n for n, t in df.dtypes
        if n not in exclude and (t in numeric or (n in text and levels[n] <= max_levels))
    ]
