import random

import pytest
from pyspark.sql import functions as F

from leadpanel.operators.filters import search
from leadpanel.sources import text_index as X
from leadpanel.sources import versions as V

SCHEMA = "strap string, address string, city string, owner string"
COLUMNS = ["address", "city", "owner"]


@pytest.fixture(scope="module")
def cards(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = [(f"s{i}", f"{i} {rng.choice(['Elm', 'Oak', '100% Pine', 'É_lan'])} Street", rng.choice(["Boulder", None, "Lyons "]),
             "".join(rng.choice("abc ") for _ in range(rng.randrange(12)))) for i in range(600)]
    rows += [("none", None, None, None), ("short", "ab", None, None), ("odd", "a%b_c", "%%%", "日本語テキスト")]
    table = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path_factory.mktemp("index") / "cards")
    X.write_index(table, path, "strap", COLUMNS, 32)
    return table, path


@pytest.mark.parametrize("query", ["elm street", " ELM ", "17 oak", "é_lan", "100%", "%", "%%%", "a%b_c", "ab", "a", "", "   ", "abc", "bca b", "日本語", "本語テ", "der a", "lyons  ", "nowhere at all"])
def test_equals_a_scan(spark, cards, query):
    """Any length, case, blanks, signs of patterns, text over the border of two fields."""
    table, path = cards
    got = X.indexed_search(spark, path, "strap", COLUMNS, query)
    assert sorted(r["strap"] for r in got.collect()) == sorted(r["strap"] for r in table.where(search(query, *COLUMNS)).collect())
    assert got.columns == table.columns


def test_only_candidates_reach_the_texts(spark, cards):
    """The postings come from the query's buckets, the cards from the candidates', and the search stands above the join."""
    _, path = cards
    query = "17 oak street"
    asked = X.candidates(spark, path, "strap", query)
    grams = {f.split("_bucket=")[1].split("/")[0] for f in asked.inputFiles() if "_bucket=" in f}
    every = V.manifest(spark, f"{path}/grams").folders
    assert grams and len(grams) <= len(X.query_grams(query)) < len(every)
    found = X.indexed_search(spark, path, "strap", COLUMNS, query)
    read = {f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles() if "_bucket=" in f}
    assert len(read) <= asked.count() < 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Contains") < plan.index("LeftSemi") and plan.count("Contains") == 1


def test_an_index_of_no_cards(spark, tmp_path):
    path = str(tmp_path / "empty")
    X.write_index(spark.createDataFrame([], SCHEMA), path, "strap", COLUMNS, 4)
    assert X.indexed_search(spark, path, "strap", COLUMNS, "elm").count() == 0 and X.indexed_search(spark, path, "strap", COLUMNS, "").count() == 0


def test_grams(spark):
    row = spark.createDataFrame([("abcab",), ("ab",), (None,)], "t string").select(X.grams(F.col("t")).alias("g")).collect()
    assert [sorted(r["g"] or []) for r in row] == [["abc", "bca", "cab"], [], []] and X.query_grams(" ABCAB ") == ["abc", "bca", "cab"]
