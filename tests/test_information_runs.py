import random

import pytest
from test_information import brute, found

from leadpanel.operators import information as N
from leadpanel.operators import ranking, runs


def test_no_table_of_more_rows_than_there_are_values(spark, monkeypatch):
    """One sorted table of the values is written, not their interval ends as well."""
    sizes = []

    def counted(df, pin=runs.pin):
        out = pin(df)
        sizes.append(out.count())
        return out

    for module in (N, runs, ranking):
        if hasattr(module, "pin"):
            monkeypatch.setattr(module, "pin", counted)
    rng = random.Random(3)
    rows = [(f, int(rng.random() < 0.2), rng.random()) for f in range(2) for _ in range(1000)]
    got, want = found(spark, rows), brute(rows)
    assert got == pytest.approx(want, abs=1e-9)
    assert max(sizes) == len(rows) and sum(sizes) < 1.5 * len(rows)


@pytest.mark.parametrize("k", [1, 3])
def test_intervals_that_reach_over_several_runs(spark, k):
    """A rare class, values that many rows of all classes share, and features of few rows."""
    rng = random.Random(k)
    rows = [(0, 0, float(i)) for i in range(400)] + [(0, 1, float(x) + 0.5) for x in (3, 150, 390, 399)]
    rows += [(1, rng.randrange(3), float(rng.choice([0, 0, 0, 1, 2]))) for _ in range(400)]
    rows += [(2, 0, 1.0), (2, 0, 2.0), (2, 1, 1.5), (3, 0, -1.0), (3, 0, -1.0), (3, 1, 5.0), (3, 1, 6.0)] + [(0, 9, 17.0)]
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got, want = found(spark, rows, k), brute(rows, k)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == pytest.approx(want, abs=1e-9)
