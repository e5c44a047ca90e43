"""Connected components of links, as joins: large-star and small-star steps in turn.

Each step points a vertex's neighbours at the smallest of them, found with a
map-side minimum, so a vertex with very many links is never gathered. A number
and a hash sum of the links tell when nothing changes any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from leadpanel.session import pin


#: Links one task handles; a step never has more tasks than that takes, so that few links make few files.
LINKS_PER_TASK = 200_000


def _sized(df: DataFrame, links: int) -> DataFrame:
    return df.coalesce(max(1, -(-links // LINKS_PER_TASK)))


def _to_smallest(links: DataFrame, size: int) -> DataFrame:
    """Links ``(a, b)``, each with ``least``: the smallest of ``a`` and all its ``b``."""
    least = links.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("least"))
    return _sized(links.join(_sized(least, size), "a"), size)


def _large_star(links: DataFrame, size: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    star = _to_smallest(both, 2 * size).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _sized(star.distinct(), size)


def _small_star(links: DataFrame, size: int) -> DataFrame:
    """``links`` lead from the larger to the smaller vertex."""
    star = _to_smallest(links, size)
    others = star.select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = star.select("a", F.col("least").alias("b"))
    return _sized(others.unionByName(own).where("a <> b").distinct(), size)


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``(node, component)`` for every vertex with a link to another; the component is its smallest vertex.

    Vertices are whole numbers and not null; links may repeat, point both ways or at themselves.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    links = pin(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    )
    state = _state(links)
    while True:
        size = state[0]
        links = pin(_small_star(_large_star(_sized(links, size), size), size))
        now = _state(links)
        if now == state:
            break
        state = now
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
