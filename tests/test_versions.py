import re

import pytest
from pyspark.sql import functions as F

from leadpanel.sources import io as IO
from leadpanel.sources import versions as V

SCHEMA = "strap string, kind string, at int, note string"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_reader_never_sees_half_a_table(spark, path):
    """Between data and manifest, and in the midst of the data, the old version counts."""
    assert V.read_version(spark, path) is None
    assert V.reload(spark.range(5), path) == 1
    before = V.read_version(spark, path)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        V.reload(broken, path)
    spark.range(3).write.parquet(f"{path}/{V.DATA}/v2-never-named")
    assert rows(V.read_version(spark, path)) == [(i,) for i in range(5)]
    assert V.reload(spark.range(2), path) == 2
    assert rows(V.read_version(spark, path)) == [(0,), (1,)] and rows(before) == [(i,) for i in range(5)]
    assert rows(V.read_version(spark, path, 1)) == [(i,) for i in range(5)] and V.read_version(spark, path, 9) is None


def test_a_table_is_rebuilt_from_itself(spark, path):
    V.reload(spark.range(4), path)
    V.reload(V.read_version(spark, path).select((F.col("id") * 10).alias("id")), path)
    V.reload(V.read_version(spark, path).limit(0), path)
    assert V.read_version(spark, path).count() == 0 and V.read_version(spark, path).columns == ["id"]
    assert rows(V.read_version(spark, path, 2)) == [(0,), (10,), (20,), (30,)]


def test_two_writers_of_one_version(spark, path):
    V.reload(spark.range(4), path)
    now = V.manifest(spark, path)
    with pytest.raises(V.VersionConflict):
        V.publish(spark, path, now)
    assert V.versions(spark, path) == [1]


def test_vacuum_keeps_what_is_named(spark, path):
    for n in (3, 4, 5):
        V.reload(spark.range(n), path)
    spark.range(3).write.parquet(f"{path}/{V.DATA}/v9-never-named")
    assert V.vacuum(spark, path, keep=2) == 3  # a manifest and two folders
    assert V.versions(spark, path) == [2, 3] and V.read_version(spark, path, 2).count() == 4 and V.read_version(spark, path).count() == 5


def table(spark, n=2000):
    return spark.range(n).select(F.concat(F.lit("s"), "id").alias("strap"), F.lit("solar").alias("kind"), F.lit(1).alias("at"), F.lit("old").alias("note"))


def test_an_upsert_touches_only_its_buckets(spark, path):
    """One key in a hundred, all in a few of 64 buckets: the plan scans those, the manifest keeps the other folders."""
    stored = table(spark)
    V.create_keyed(stored, path, ["strap", "kind"], 64, "at")
    before = V.manifest(spark, path)
    hit = stored.where(V.bucket_of(["strap", "kind"], 64).isin(3, 17)).limit(20)
    batch = V.pin(hit.withColumns({"at": F.lit(2), "note": F.lit("new")}))
    scanned = []

    def merge(old, new):
        out = IO.upsert(old, new, ["strap", "kind"], "at")
        scanned.extend(re.findall(r"_bucket=(\d+)", " ".join(old.inputFiles())))
        return out

    V.merge_buckets(batch, path, merge)
    after = V.manifest(spark, path)
    changed = {b for b in after.folders if after.folders[b] != before.folders.get(b)}
    assert set(scanned) == changed and changed <= {"3", "17"} and changed
    assert rows(V.read_version(spark, path)) == rows(IO.upsert(stored, batch, ["strap", "kind"], "at"))
    assert rows(V.read_version(spark, path, 1)) == rows(stored)
    V.vacuum(spark, path)
    assert rows(V.read_version(spark, path)) == rows(IO.upsert(stored, batch, ["strap", "kind"], "at"))


def test_a_lookup_reads_only_its_buckets(spark, path):
    V.create_keyed(table(spark), path, ["strap", "kind"], 64, "at")
    found = V.lookup(spark.createDataFrame([("s5", "solar", 1), ("s5", "solar", 2), ("none", "solar", 3)], "strap string, kind string, more int"), path)
    assert rows(found) == [("s5", "solar", 1, "old")]
    assert len({re.search(r"_bucket=(\d+)", f).group(1) for f in found.inputFiles() if "_bucket=" in f}) <= 2


def test_upserts_equal_those_of_whole_tables(spark, path):
    """Null keys, repeated keys in the first table and in a batch, new and stored keys, an empty batch."""
    first = spark.createDataFrame([("a", "x", 1, "1"), ("a", "x", 3, "3"), ("b", None, 1, None), (None, None, 5, "n"), ("c", "x", 9, "c")], SCHEMA)
    batches = [[("a", "x", 2, "new")], [(None, None, 1, "again"), (None, None, 2, "last"), ("d", "x", 1, "d")], [], [("b", None, 0, "b")]]
    V.create_keyed(first, path, ["strap", "kind"], 4, "at")
    whole = IO.latest_per_key(first, ["strap", "kind"], [F.col("at")])
    for batch in batches:
        more = spark.createDataFrame(batch, SCHEMA)
        V.upsert_keyed(more, path, "at")
        whole = IO.upsert(whole, more, ["strap", "kind"], "at")
    assert rows(V.read_version(spark, path)) == rows(whole)
    assert V.manifest(spark, path).version == 4  # the empty batch made none


def test_partial_upserts_and_new_columns(spark, path):
    first = spark.createDataFrame([(i, i / 2, None) for i in range(50)], "home bigint, model double, image string")
    V.create_keyed(first, path, ["home"], 8)
    batch = spark.createDataFrame([(3, "new", 7.0), (99, "new", 8.0)], "home bigint, image string, roof double")
    V.upsert_columns_keyed(batch, path, keep_old=["image"])
    got = {r["home"]: (r["model"], r["image"], r["roof"]) for r in V.read_version(spark, path).collect()}
    assert len(got) == 51 and got[3] == (1.5, "new", 7.0) and got[99] == (None, "new", 8.0) and got[4] == (2.0, None, None)
    V.upsert_columns_keyed(spark.createDataFrame([(3, "newer")], "home bigint, image string"), path, keep_old=["image"])
    assert V.lookup(spark.createDataFrame([(3,)], "home bigint"), path).first()["image"] == "new"


def test_no_keyed_table(spark, path):
    V.reload(spark.range(2), path)
    with pytest.raises(ValueError):
        V.upsert_keyed(spark.range(2), path, "id")


# ---- ranked tables ---------------------------------------------------------------------------
def scored(spark, n=3000):
    """Many ties and unknown scores."""
    score = F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") * 37 % 50).cast("double"))
    return spark.range(n).select(F.format_string("h%05d", "id").alias("strap"), score.alias("score"), (F.col("id") % 3).alias("kind"))


def sql_page(df, limit, offset, where=None):
    df = df if where is None else df.where(where)
    total = df.count()
    return [(*r, total) for r in df.orderBy(*V.page_order("score", "strap")).offset(offset).limit(limit).collect()]


def test_a_deep_page_reads_its_runs_alone(spark, path):
    table = scored(spark)
    V.write_ranked(table, path, "score", "strap", 12)
    counts = V.manifest(spark, path).counts
    assert sum(counts.values()) == 3000 and len(counts) > 6
    for offset in (0, 1, 700, 1499, 2570, 2990, 2999):
        page = V.read_page(spark, path, 40, offset)
        assert [tuple(r) for r in page.collect()] == sql_page(table, 40, offset)
        read = {f.split("_run=")[1].split("/")[0] for f in page.inputFiles()}
        assert len(read) <= 2
    assert V.read_page(spark, path, 40, 3000).collect() == [] and V.read_page(spark, path, 40, 10**9).collect() == []


def test_filtered_pages_count_before_they_read(spark, path):
    table = scored(spark)
    V.write_ranked(table, path, "score", "strap", 12)
    for where in (F.col("kind") == 1, F.col("score") > 45, F.col("score").isNull(), F.col("strap") == "none"):
        for offset in (0, 150, 900):
            assert [tuple(r) for r in V.read_page(spark, path, 25, offset, where).collect()] == sql_page(table, 25, offset, where)
    assert len({f for f in V.read_page(spark, path, 25, 0, F.col("score") > 45).inputFiles()}) <= 2


def test_ranked_tables_of_no_rows(spark, path):
    V.write_ranked(scored(spark).limit(0), path, "score", "strap", 4)
    assert V.read_page(spark, path, 10).collect() == [] and V.read_page(spark, path, 10, 0, F.col("kind") == 1).collect() == []
    with pytest.raises(ValueError):
        V.read_page(spark, path + "-none", 10)
