"""Per-entity yearly features. Each entity has one row per year, so its window is short."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadpanel.functions import permit_rules as R

c = F.col


def by_year(key: str = "strap", year: str = "year"):
    return Window.partitionBy(key).orderBy(year)


def last_rows(n: int, key: str = "strap"):
    return by_year(key).rowsBetween(-(n - 1), 0)


def persist_flags(panel: DataFrame, years: dict[str, int] = R.PERSISTENCE) -> DataFrame:
    """A flag stays 1 for its number of yearly rows; all flags share one sort."""
    return panel.withColumns({f: F.max(f).over(last_rows(n)) for f, n in years.items()})


def velocity(panel: DataFrame, flags: list[str], rows: int = 3) -> Column:
    """Sum of raw flags over the last rows."""
    return F.sum(sum((c(f) for f in flags[1:]), c(flags[0]))).over(last_rows(rows))


def yearly_change(value: str) -> Column:
    """Difference to the year before; the first year has none."""
    return F.coalesce(c(value) - F.lag(value).over(by_year()), F.lit(0.0))


def three_year_slope(value: str) -> Column:
    """Least-squares slope over up to three rows, in closed form."""
    one, two = F.lag(value, 1).over(by_year()), F.lag(value, 2).over(by_year())
    return F.when(two.isNotNull(), (c(value) - two) / 2).when(one.isNotNull(), c(value) - one).otherwise(0.0)


def years_since_reset(event: Column, built: str, year: str = "year") -> Column:
    """Age that starts at year - built (0 if unknown), returns to 0 on an event and grows by one a year."""
    last = F.last(F.when(event, c(year)), ignorenulls=True).over(by_year())
    first = F.first(year).over(by_year())
    start = F.coalesce(F.greatest(F.lit(0), (first - c(built)).cast("int")), F.lit(0))
    return F.coalesce(c(year) - last, start + c(year) - first).cast("int")


# Fixed value: percentage points below the held rate that trigger a refinance.
REFINANCE_DROP = 0.75


def held_rate(rates: Column, years: Column, sale_year: Column) -> Column:
    """Rate path as an array over the sorted years: reset in the sale year, follow drops of 0.75 or more.

    ``rates`` and ``years`` are equal-length arrays, one entry per year.
    """
    points = F.arrays_zip(rates.alias("r"), years.alias("y"))

    def step(path: Column, point: Column) -> Column:
        held = F.try_element_at(path, F.lit(-1))
        rate = point["r"]
        moves = F.coalesce(point["y"] == sale_year, F.lit(False)) | (rate <= held - REFINANCE_DROP)
        return F.concat(path, F.array(F.when((F.size(path) == 0) | moves, rate).otherwise(held)))

    return F.aggregate(points, F.filter(rates, lambda _: F.lit(False)), step)


def next_event_label(first_year: Column, year: Column) -> Column:
    """1 in the year before the first event, 2 from it on, else 0."""
    return F.when(year >= first_year, 2).when(year == first_year - 1, 1).otherwise(0)
